"""Token alignment against a plain version of its contract."""

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from editpulse.llm import alignment
from editpulse.llm import queries as Q
from test_dealt import EDGE, SCHEMA, SMALL

A_FILE, B_FILE = (public_tokenizers.path(n) for n in (Q.VOCABULARY, Q.PIECES))


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(A_FILE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
        ranks = dict(map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")))
        self.spelt = {int(i): base64.b64decode(t) for t, i in ranks.items()}

    def spell_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes.fromhex(piece[3:5]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        """[(A ids, B ids)] of the groups, by cutting at common ends."""
        if not text:
            return []
        a = [(i, self.spelt[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.spell_b(i)) for i in self.b.encode(text)]
        raw = (" " + text).encode()
        if not b"".join(t for _, t in a) == b"".join(t for _, t in b) == raw:
            return []
        ends = []
        for side in (a, b):
            at, places = 0, []
            for _, t in side:
                at += len(t)
                places.append(at)
            ends.append(places)
        common = sorted(set(ends[0]) & set(ends[1]))
        out = [([], []) for _ in common]
        for k, side in enumerate((a, b)):
            g = 0
            for (i, _), end in zip(side, ends[k]):
                out[g][k].append(i)
                g += end == common[g]
        return out


def expected(texts):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of ``texts``."""
    plain = Plain()
    groups = [plain.groups(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for g, c in zip(groups, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        yield (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), sum(n for p, n in c.items() if held[p] == most[p[0]]),
               sum(n * held[p] for p, n in c.items()), hashlib.sha256(written.encode()).hexdigest() if g else "")


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_brute_force(spark):
    docs = Q.documents(spark, SMALL).collect()
    found = {r.doc_id: r for r in Q.op11_alignment(spark, SMALL).collect()}
    assert len(found) == len(docs)
    for d, row in zip(docs, expected([d.text for d in docs])):
        assert tuple(found[d.doc_id][c] for c in COLUMNS) == row


MORE = [*EDGE, "日本語 текст ǆ́ \U0001f9d1‍\U0001f680 " * 5, "<s> </s> <unk> <0x41> ▁ ▁▁x", "１２３ ﬁ", "a\r\n\tb  c   d", "0123456789" * 30]


@pytest.mark.parametrize(("frequent", "part"), [(alignment.FREQUENT, alignment.PART_LINKS), (40, 7), (0, 7)])
def test_edge_cases(spark, monkeypatch, frequent, part):
    """Null, empty, long and odd texts, repeated rows and clashing columns, with
    all pairs in the broadcast table, some, and none; and with dense expansion."""
    texts = [*MORE, "same", "Cc By cc by"]
    rows = [(i % 7 if i else None, t, "en", None, None, 0.5, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("pairs", F.lit(1)).withColumn("rid", F.lit("x")).repartition(3)
    monkeypatch.setattr(alignment, "PART_LINKS", part)
    monkeypatch.setattr(alignment, "DENSE", 8 if part > 7 else 0)
    got = [(r.doc_id, *(r[c] for c in COLUMNS)) for r in alignment.align(docs, A_FILE, B_FILE, frequent=frequent).collect()]
    want = [(row[0], *e) for row, e in zip(rows, expected(texts))]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert alignment.align(docs.limit(0), A_FILE, B_FILE).count() == 0


def _aligner():
    with open(A_FILE, encoding="utf-8") as f, open(B_FILE, "rb") as g:
        return alignment.Aligner(f.read(), g.read())


def _rows(aligner, texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], names=["rid", "doc_id", "text"])
    return [r for t in alignment._rows(aligner, batch) for r in t.to_pylist()]


@pytest.mark.parametrize("part", [1, 50, 1000])
def test_dense_groups(monkeypatch, part):
    """A long group leaves as several rows that together hold each pair once."""
    aligner = _aligner()
    rng = np.random.default_rng(2)
    found = [(list(rng.integers(0, 40, 300)), list(rng.integers(0, 30, 200)))]
    monkeypatch.setattr(aligner, "size_a", np.full(aligner.n_a, 2))
    monkeypatch.setattr(aligner, "size_b", np.full(aligner.n_b, 3))
    monkeypatch.setattr(alignment, "PART_LINKS", part)
    monkeypatch.setattr(alignment, "DENSE", 0)
    (groups, links, _, parts), = alignment._block(aligner, found)
    want = Counter()
    for g in range(100):  # ends meet at multiples of six bytes
        for x in found[0][0][3 * g : 3 * g + 3]:
            for y in found[0][1][2 * g : 2 * g + 2]:
                want[int(x) * aligner.n_b + int(y)] += 1
    got = Counter()
    for pairs, times in parts:
        assert not set(pairs.tolist()) & set(got)
        got.update(dict(zip(pairs.tolist(), times.tolist())))
    assert (groups, links, got) == (100, 600 * 1, want)


def test_very_long_texts():
    """Texts above the block size, among them runs that the splitter cannot take."""
    aligner = _aligner()
    texts = ["Über words, and 123 more. " * 50_000, " " * 1_100_000 + "x", "\n" * 20_000, "ab" * 600_000]
    rows = _rows(aligner, texts)
    plain = Plain()
    for i, t in enumerate(texts):
        mine = [r for r in rows if r["rid"] == i]
        groups = plain.groups(t)
        assert mine[0]["n_groups"] == len(groups)
        assert sum(sum(r["links"]) for r in mine) == mine[0]["n_links"] == sum(len(a) * len(b) for a, b in groups)


def test_rare_pairs_join_without_broadcast(spark):
    counts = spark.createDataFrame([(i, 1 << (i % 5), True) for i in range(100)], "pair bigint, n bigint, best boolean")
    assert alignment.least_frequent_count(counts, 1000) == 1
    assert alignment.least_frequent_count(counts, 45) == 8
    assert alignment.least_frequent_count(counts, 0) > 16
    assert alignment.least_frequent_count(counts.limit(0), 5) > 16
