"""Rule statistics against a plain version; the forest and its threshold."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from editpulse.llm import anomaly
from editpulse.llm import queries as Q
from test_dealt import EDGE, SCHEMA, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else None
    if many is None:
        from collections import Counter
        many = {w for w, n in Counter(windows).items() if n > 1}
    hit = {p for i, w in enumerate(windows) if w in many for p in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n)


NAMES = (*anomaly.COUNTS, "base_failed")


def test_query_brute_force(spark):
    docs = {d.doc_id: d.text for d in Q.documents(spark, SMALL).collect()}
    rows = Q.op12_rules(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r[c] for c in NAMES) == plain(docs[r.doc_id])
        assert not (r.kept and r.base_failed) and 0 <= r.score <= 1


LONG = [" ".join(f"w{i}" for i in range(9)) + " " + " ".join(f"w{i}" for i in range(9)), "a b " * 40, "x " * 30, "one\ntwo\r\none\n \n \ntwo\rone", "é\x1cé \x85 　# <|> $",
        "lorem ipsum dolor sit amet " * 60_000, " ".join(f"w{i % 50_021}" for i in range(200_000))]


def test_edge_cases(spark):
    texts = [*EDGE, *LONG]
    docs = spark.createDataFrame([(i if i else None, t, "en", None, None, 0.5, "clash") for i, t in enumerate(texts)] * 2, SCHEMA).withColumn("kept", F.lit("x"))
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (999, 1), (9, 1), (9, 0)], "doc_id bigint, quality int")
    rows = anomaly.judge(docs, labels).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert tuple(r[c] for c in NAMES) == plain(texts[r.doc_id or 0])
        assert r.kept == (not r.base_failed)  # no good labels: the forest drops nothing
    verdicts = {r.doc_id: (r.score, r.kept) for r in rows}
    assert all(verdicts[r.doc_id] == (r.score, r.kept) for r in rows)
    assert anomaly.judge(docs.limit(0), labels).count() == 0
    assert anomaly.judge(docs, labels.limit(0)).count() == 2 * len(texts)


def test_path_lengths():
    """A leaf's length is its depth and what is expected of the rows in it, by a walk."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    forest = anomaly.Forest(x, trees=5, per_tree=64)
    probe = rng.normal(size=(50, 3)) * 3
    for tree in forest.trees:
        feature, cut, left, right, length = tree
        assert (feature < 0).sum() == (feature >= 0).sum() + 1
    want = []
    for row in probe:
        total = 0.0
        for feature, cut, left, right, length in forest.trees:
            node, depth = 0, 0
            while feature[node] >= 0:
                node, depth = (left if row[feature[node]] <= cut[node] else right)[node], depth + 1
            assert length[node] >= depth
            total += length[node]
        want.append(2 ** (-total / 5 / anomaly.path_length(64)))
    assert np.allclose(forest.score(probe), want)
    far = forest.score(np.array([[50.0, -50, 50], [0, 0, 0]]))
    assert far[0] > far[1]
    assert abs(anomaly.path_length(256) - sum(2 / i for i in range(2, 257)) + 2 * (1 - 1 / 256) - 2 * (1 - 1 / 256)) < 0.02
    same = anomaly.Forest(np.ones((10, 3)))
    assert len(set(same.score(probe))) == 1 and anomaly.Forest(np.zeros((0, 3))).score(probe).tolist() == [0] * 50


def test_threshold_is_the_best_allowed_cut(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(s)) for i, s in enumerate(np.concatenate([rng.beta(4, 6, 400), rng.beta(7, 3, 100)]))]
    scores = spark.createDataFrame(rows, "doc_id bigint, score double")
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(500)], "doc_id bigint, quality int")
    for allowed in (0.0, 0.01, 0.2):
        best = max(((sum(s >= t for _, s in rows[400:]) / 100 - sum(s >= t for _, s in rows[:400]) / 400, t) for t in np.arange(2002) / 2000
                    if sum(s >= t for _, s in rows[:400]) / 400 <= allowed + 1e-12))
        assert anomaly.threshold(scores, labels, allowed) == pytest.approx(best[1])


def test_labelled_rows(spark):
    """Of good rows few go beyond those that fail by rule (3 of 100, mostly short); bad ones go."""
    path = "/root/testdata/sf0.1"
    rows = Q.op12_rules(spark, path).join(Q.table(spark, path, "labels"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] > 0.95 and kept[0] < 0.1
