"""Each query against a brute-force version on the smallest tables, and each
operator on small tables of edge cases."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from editpulse.llm import bpe, chat, decontamination, exact_dedup, langid, licenses, quality, secret_scan, simhash
from editpulse.llm import queries as Q
from editpulse.llm.components import components

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, h string"

EDGE = [None, "", " ", "\n\n", "\x00", "A", "a", "é", "É", "word " * 3000, "x" * 5000, "Cc By cc by", "ALL rights\nreserved all rights reserved",
        "token = \"abcdef123\"", "😀 AKIA" + "A" * 16 + " " + "a1" * 12, "ünï cödé", "same", "same", "\\ </s>[INST] <|im_end|>\n<|im_start|>", "<|endoftext|>x<|endoftext|>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(A_TO_Z))


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None, 0.5, "clash") for i, t in enumerate(EDGE)]
    rows += [(None, "no id", "en", "s", 5, 0.5, "clash"), (3, "\n\n", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return Q.documents(spark, SMALL).collect()


def by_id(df):
    rows = df.collect()
    return {r.doc_id: r for r in rows}, len(rows)


# 1 ---------------------------------------------------------------------------

def brute_hits(text, items, width=10):
    w = words(text)
    hit, found = set(), set()
    for item, source in items:
        s = words(source)
        k = min(width, len(s))
        for j in range(len(s) - k + 1) if k else ():
            for i in range(len(w) - k + 1):
                if w[i : i + k] == s[j : j + k]:
                    hit.update(range(i, i + k))
                    found.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_pairs", [1_000_000, 2])
def test_decontamination(spark, edge, block_pairs):
    items = [(1, "all rights RESERVED"), (2, "word " * 12), (None, "ünï"), (4, None), (5, "!"), (11, "same"), (10, "Same")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.report(edge, bench, block_pairs=block_pairs)
    rows = {(r.doc_id, r.n_words): r for r in found.collect()}
    assert found.count() == edge.count()
    for d in edge.collect():
        n, hit, ids = brute_hits(d.text, items)
        r = rows[d.doc_id, n]
        assert (r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (hit, len(ids), sha(",".join(ids)), hit > 0)


def test_decontamination_removes(spark, edge, nothing):
    bench = spark.createDataFrame([(1, "rights reserved all"), (2, "cc by")], "item_id bigint, text string")
    kept = decontamination.remove_documents(edge, bench)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 2
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(edge, bench).collect()}
    assert cut[12] == "ALL  rights reserved" and cut[11] == "" and cut[9] == EDGE[9] and cut[0] is None
    assert decontamination.remove_documents(nothing, bench).count() == 0
    assert decontamination.remove_documents(edge, bench.limit(0)).count() == edge.count()


# 2 ---------------------------------------------------------------------------

@pytest.mark.parametrize("text", ["", "plain", "a\\", "\\<|im_end|>", "<<|im_end|>", "</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "\n", "\\\\n"])
@pytest.mark.parametrize("role", ["user", "", "a\nb", "<|im_end|>", "\\"])
def test_chat_turn_round_trip(role, text):
    out = chat.render_turn(role, text)
    assert chat.read_back(out * 2) == [(role, text)] * 2
    inner = out[len(chat.START) : -len(chat.END) - 1]
    assert not any(c in inner for c in chat.CONTROL)


def test_chat_edge_cases(spark, monkeypatch):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (None, 1, None, "x"), (1, None, "system", "s"), (1, 2, "assistant", "b"), (2, 1, "assistant", "y" * 10)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit("clash"))
    for size in (1 << 20, 3):
        monkeypatch.setattr(chat, "PART_CHARS", size)
        found = {r.conv_id: r for r in chat.digests(turns).collect()}
        assert found[1].turns_sha256 == sha("system\ns\nuser\n\nassistant\nb\nassistant\nb\n") and found[1].n_turns == 4
        assert (found[1].loss_chars, found[1].loss_sha256) == (2, sha("bb"))
        assert found[None].turns_sha256 == sha("\nx\n") and found[None].loss_sha256 == sha("")
        assert found[2].loss_chars == 10 and len(found) == 3
    assert chat.digests(turns.limit(0)).count() == 0


def test_chat_output_is_held_to_a_part():
    """Conversations just below a part leave the task one or two at a time."""
    text = "x" * 900_000
    source = (pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array(["user"]), pa.array([text])], names=["conv_id", "role", "text"]) for i in range(40))
    sizes = [b.num_rows for b in chat._format(source)]
    assert sum(sizes) == 40 and max(sizes) <= 2


# 3 ---------------------------------------------------------------------------

def test_language_held_out(spark):
    rows = Q.op3_language(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in Q.documents(spark, "/root/testdata/sf0.01").collect()}
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.95 and len(rows) == len(lang)


def test_language_tables_equal_convolution():
    net = langid.ByteNet(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (3, langid.WINDOW)).astype(np.uint8)
    e = net.p["E"][x]
    r = sum(np.einsum("nld,df->nlf", e[:, k : langid.WINDOW - 3 + k], net.p["W"][k]) for k in range(4)) + net.p["b"]
    assert np.allclose(net.pooled(x, net.tables()), r.max(1), atol=1e-4)


def test_language_edge_cases(spark, edge, nothing):
    net = langid.train(edge.filter("text <> ''"))
    found, n = by_id(langid.predict(edge, net, keep=["doc_id"]))
    assert n == edge.count() and found[0].lang_pred == found[1].lang_pred == found[4].lang_pred == "und" and found[9].lang_pred == "en"
    assert langid.predict(edge, net).columns == [*edge.columns, "lang_pred", "score_"]
    none = langid.train(nothing)
    assert {r.lang_pred for r in langid.predict(edge, none, keep=["doc_id"]).collect()} == {"und"}


# 4 ---------------------------------------------------------------------------

def test_exact_dedup_edge_cases(edge, nothing):
    groups = defaultdict(list)
    for d in edge.collect():
        groups[(d.text or "").translate(A_TO_Z)].append(d.doc_id)
    expected = sorted((str(i), max((x for x in ids if x is not None), default=None), len(ids), sha(t)) for t, ids in groups.items() for i in ids)
    rows = exact_dedup.deduplicate(edge, bucket_bytes=100).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)
    assert exact_dedup.deduplicate(nothing).count() == 0


def test_collisions_are_chained_by_bytes():
    import pyarrow as pa
    rows = [(1, b"a"), (1, b"b"), (1, b"a"), (2, b"a"), (3, b"c"), (3, b"d"), (3, b"c")]
    batch = pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows]), pa.array([0] * 7), pa.array([b for _, b in rows]),
                                        *[pa.array([0] * 7)] * 4], names=["h", "slot", "body", "sha", "keep", "n", "ids"])
    halves = exact_dedup._chain([batch.slice(0, 2), batch.slice(2)])
    assert [x for b in halves for x in b.column(2).to_pylist()] == [0, 1, 0, 0, 0, 1, 0]


def test_directory_doubles():
    d = exact_dedup.build_directory({0: 60, 1: 60, 5: 10, 7: 20}, 100, max_depth=3)
    assert d.tolist() == [0, 1, 2, 2, 3, 3, 3, 3]
    assert exact_dedup.build_directory({3: 900}, 100, max_depth=3).tolist() == [0, 0, 1, 2, 3, 3, 3, 3]
    assert exact_dedup.build_directory({}, 100, max_depth=3).tolist() == [0]


# 5 ---------------------------------------------------------------------------

# is in test_lines.py


# 6 ---------------------------------------------------------------------------

def test_bpe_against_library(spark, edge):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(Q.vocabulary_path())
    t.no_truncation(), t.no_padding()
    extra = spark.createDataFrame([(100, "x²Ⅷ ½ don't    we'll\r\n\t  end  "), (101, "aaaa" * 200 + "!?" * 300), (102, "\x1c\x1d a\x85b 👩‍👩‍👧 " * 20)], "doc_id bigint, text string")
    df = edge.select("doc_id", "text").union(extra).union(Q.documents(spark, SMALL).select(F.col("doc_id") + 1000, "text"))
    found = {r.doc_id: r for r in bpe.encode(df, Q.vocabulary_path()).collect()}
    for d in df.collect():
        ids = t.encode(d.text or "", add_special_tokens=False).ids
        r = found[d.doc_id]
        if d.doc_id != 3:
            assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == sha(",".join(map(str, ids)))
            assert r.decoded_sha256 == sha(t.decode(ids, skip_special_tokens=False))
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(extra, Q.vocabulary_path()), Q.vocabulary_path()).collect()}
    assert back == {r.doc_id: r.text for r in extra.collect()}


# 7 ---------------------------------------------------------------------------

def brute_base(text):
    w, out = words(text), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), out


def test_licenses_base(spark, edge, nothing, docs):
    for rows, df in ((edge.collect(), edge), (docs, Q.documents(spark, SMALL))):
        found = sorted(licenses.scan(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
        for d, r in zip(sorted(rows, key=lambda d: (d.doc_id is None, d.doc_id)), found, strict=True):
            n, base = brute_base(d.text)
            at = [i for i, _ in base]
            assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(at, default=None), max(at, default=None))
            assert r.base_labels == ",".join(sorted({x for _, x in base})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert licenses.scan(nothing).count() == 0


def test_licenses_sections(spark):
    text = licenses.TEMPLATES
    permission = words(text["mit/permission"])
    holed = " ".join(permission[:20] + ["changed"] + permission[22:60])
    whole = "\n\n".join(v for k, v in text.items() if k.startswith("mit/") and k != "mit/line")
    rows = [holed.upper(), " ".join(permission[:8]), " ".join(reversed(permission)), "own words\n" + text["mit/disclaimer"], whole,
            "code before " + text["bsd/disclaimer"].replace("the copyright holders and contributors", "the regents of a place"), "x " * 600_000 + text["apache-2.0/notice"]]
    found, _ = by_id(licenses.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")))
    assert [found[i].labels for i in range(7)] == ["mit", "", "", "mit", "mit", "bsd", "apache-2.0"]
    chain = {i: {c.section: c for c in found[i].chains} for i in found}
    assert chain[0]["mit/permission"].share == pytest.approx((20 + min(60, len(permission)) - 22) / len(permission))
    assert [tuple(x) for x in chain[0]["mit/permission"].spans] == [(0, 19), (21, min(60, len(permission)) - 2)]
    n = len(words(text["mit/disclaimer"]))
    assert chain[3]["mit/disclaimer"].share == 1 and [tuple(x) for x in chain[3]["mit/disclaimer"].spans] == [(2, n + 1)] and "mit/permission" not in chain[3]
    assert {k: c.share for k, c in chain[4].items() if k.startswith("mit/") and k != "mit/line"} == {"mit/permission": 1, "mit/conditions": 1, "mit/disclaimer": 1}
    assert [tuple(x) for x in chain[6]["apache-2.0/notice"].spans] == [(600_000, 600_000 + len(words(text["apache-2.0/notice"])) - 1)]


def test_licenses_repeated_phrase():
    s = licenses.Scanner(templates={"t": "a b c d x a b c d y"})
    words_of = {w.decode(): i for i, w in enumerate(s.words)}
    ids = lambda text: [(0, [words_of[w] for w in text.split()])]
    assert s.covered(s.read(ids("a b c d"))[1]) == {"t": (0.4, [(0, 3)])}
    assert s.covered(s.read(ids("a b c d a b c d"))[1]) == {"t": (0.8, [(0, 7)])}


def brute_chain(template, text, least):
    """Longest ascending sequence of matched words that stand in common runs of ``least``."""
    runs = set()
    for i in range(len(text)):
        for j in range(len(template)):
            n = 0
            while i + n < len(text) and j + n < len(template) and text[i + n] == template[j + n]:
                n += 1
            if n >= least:
                runs.update((i + k, j + k) for k in range(n))
    best = [[0] * (len(template) + 1) for _ in range(len(text) + 1)]
    for i in range(len(text)):
        for j in range(len(template)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + ((i, j) in runs))
    return best[-1][-1]


def test_licenses_chain_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(150):
        templates = {f"t{k}": " ".join(rng.choice(list("abc"), rng.integers(5, 25))) for k in range(3)}
        s = licenses.Scanner(phrases={"a a": "p"}, templates=templates, min_run=3)
        number = {w.decode(): i for i, w in enumerate(s.words)}
        text = [w for w in rng.choice(list("abc"), 30) if w in number]
        found = s.covered(s.read([(7, [number[w] for w in text])])[1])
        for name, template in templates.items():
            share, spans = found.get(name, (0, []))
            assert round(share * len(template.split())) == brute_chain(template.split(), text, 3) == sum(b - a + 1 for a, b in spans)
            assert all(7 <= a <= b < 37 for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_matching_statistics():
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 4, 30).tolist() for _ in range(4)]
    a = licenses.Automaton(sequences)
    runs = {tuple(s[i:j]): None for s in sequences for i in range(30) for j in range(i + 1, 31)}
    text = rng.integers(0, 4, 300).tolist()
    for end, (size, state) in enumerate(a.statistics(text), 1):
        assert size == max(n for n in range(31) if n == 0 or (n <= end and tuple(text[end - n : end]) in runs))
        places = {(t, at) for t, s in enumerate(sequences) for at in range(size - 1, 30) if s[at + 1 - size : at + 1] == text[end - size : end]}
        assert not size or set(a.place[state]) == places


# 8 ---------------------------------------------------------------------------

def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in prints}


def test_simhash_query(spark, docs):
    prints = {d.doc_id: brute_fingerprint(d.text) for d in docs}
    root, least = brute_components(set(prints.values())), {}
    for i, f in sorted(prints.items()):
        least.setdefault(root[f], i)
    found, n = by_id(Q.op8_simhash(spark, SMALL))
    assert n == len(docs)
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == {i: (f"{f:016x}", least[root[f]]) for i, f in prints.items()}


def test_simhash_links_of_every_distance(spark):
    rng = np.random.default_rng(1)
    prints = set()
    for _ in range(60):
        base = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for k in range(6):
            prints.add(base)
            for b in rng.choice(64, k, replace=False):
                base ^= 1 << int(b)
    prints = sorted(prints)
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    ties = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in ties)
    expected, root = brute_components(prints), {p: p for p in prints}
    for _ in prints:
        for a, b in ties:
            root[a] = root[b] = min(root[a], root[b])
    groups = lambda m: {frozenset(p for p in prints if m[p] == v) for v in m.values()}
    assert groups(root) == groups(expected)


def test_simhash_edge_cases(spark, edge, nothing):
    found = simhash.classes(edge).collect()
    assert len(found) == edge.count()
    assert {r.component_id for r in found if r.doc_id in (0, 1, 2, 3)} == {0} and {r.component_id for r in found if r.doc_id in (16, 17)} == {16}
    kept = [r.doc_id for r in simhash.keep_one(edge).collect()]
    assert kept.count(None) == 1 and len(kept) == len(set(kept)) and not {1, 2, 3, 17} & set(kept) and {0, 16, 12} <= set(kept)
    assert simhash.classes(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
    twice = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "entirely different words here")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(twice).collect()) == [1, 2]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 130)] + [(-5, 129), (7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: -5 for i in range(100, 130)}, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 9 ---------------------------------------------------------------------------

def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in Q.table(spark, d, "labels").collect()}
    rows = Q.op9_quality(spark, d).collect()
    out = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([a == b for a, b in out]) > 0.9 and len(rows) == 1000


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8])
def test_quality_prior_of_mixtures(share):
    """The share of the positive kind, from positives and unlabelled rows alone."""
    rng = np.random.default_rng(4)
    positive = lambda n: rng.normal(0, 1, (n, quality.N_FEATURES))
    other = lambda n: rng.normal(np.where(np.arange(quality.N_FEATURES) < 12, 1.5, 0), 1, (n, quality.N_FEATURES))
    mixed = np.concatenate([positive(int(4000 * share)), other(4000 - int(4000 * share))])
    trusted = positive(2000)
    assert abs(quality.estimate_prior(trusted, mixed, caution=0) - share) < 0.05
    assert share - 0.1 < quality.estimate_prior(trusted, mixed) < share + 0.01


def test_quality_edge_cases(spark, edge, nothing):
    labels = spark.createDataFrame([(5, 1), (9, 0), (6, None), (999, 1), (5, 1), (9, 1), (None, 1)], "doc_id bigint, quality int")
    for marks in (labels, labels.limit(0)):
        rows = quality.score(edge, quality.train(edge, marks)).collect()
        assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(nothing, quality.train(nothing, labels)).count() == 0


# 10 --------------------------------------------------------------------------

def brute_secrets(text):
    text, out = text or "", []
    assign = re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)))""")
    for kind, name, pattern, group, least in ((0, "assign", assign, 2, 6), (1, "access", re.compile("AKIA[A-Z0-9]+"), 0, 20), (2, "hex", re.compile("[0-9a-f]+"), 0, 24)):
        out += [(m.start(), kind, m.end(), name) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(out)


def test_secrets_base(spark, edge, nothing, docs):
    tricky = ["secret: token: abcdefgh", "Api_Key='abc' PASSWORD=\"token=zzzzzz\"", "AKIAAKIA" + "B" * 14 + " AKIA123", "é😀token=abcdef " + "ab" * 20 + "g" + "0" * 24, "secret = token = abcdef"]
    more = spark.createDataFrame([(i + 50, t, "s") for i, t in enumerate(tricky)], "doc_id bigint, text string, source string")
    for df in (edge, more, Q.documents(spark, SMALL)):
        found = sorted(secret_scan.scan(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
        for d, r in zip(sorted(df.collect(), key=lambda d: (d.doc_id is None, d.doc_id)), found, strict=True):
            base = brute_secrets(d.text)
            shown = ",".join(f"{n}:{a}:{b}" for a, _, b, n in base)
            assert r.base_sha256 == sha(shown) and (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _, _ in base) for i in range(3))
            assert set(filter(None, shown.split(","))) <= set(r.spans.split(","))
    assert secret_scan.scan(nothing).count() == 0


def test_secrets_many_in_one_text(spark):
    """More matches than are summed together: the places stay exact."""
    for n in (secret_scan.SUMMED - 1, secret_scan.SUMMED, 3 * secret_scan.SUMMED + 1):
        text = "".join(f"é{'x' * (i % 7)} token=abcdef{i} " for i in range(n))
        r = secret_scan.scan(spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string")).first()
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in brute_secrets(text))) and r.n_assign == n


def test_secrets_ownership(spark):
    own, copied = "bearer " + "q7" * 15, "bearer " + "EXAMPLE" * 4
    rows = [(i, f"{own if i == 0 else ''} {copied}", f"owner{i}") for i in range(5)]
    found, _ = by_id(secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string, source string")))
    assert found[0].spans == f"bearer:0:{len(own)}" and (found[0].n_live, found[0].n_copied) == (1, 1)
    assert all(found[i].spans == "" and found[i].n_copied == 1 for i in range(1, 5))


# pipeline ----------------------------------------------------------------------

def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline as P
    now = Q.documents(spark, SMALL)
    columns, clean = now.columns, []
    for name, stage in P.STAGES:
        done = stage(spark, now, SMALL)
        done.write.parquet(f"{tmp_path}/{name}")
        now, before = spark.read.parquet(f"{tmp_path}/{name}"), now
        if name != "bpe":
            assert now.columns == columns
        clean.append(now.count())
    assert clean[0] > 0.95 * len(docs) and clean[0] == clean[1] > clean[2] > clean[3] == clean[4]
    assert sorted(P.run(spark, SMALL).drop("ids").collect()) == sorted(now.drop("ids").collect())
    items = [(r.item_id, r.text) for r in Q.table(spark, SMALL, "benchmark").collect()]
    assert not any(brute_hits(r.text, items)[1] for r in before.collect())


def test_pipeline_edge_cases(spark, edge, nothing, tmp_path):
    import corpus_pipeline as P
    for i, df in enumerate((edge, nothing)):
        for name, stage in P.STAGES:
            stage(spark, df, SMALL).write.parquet(f"{tmp_path}/{i}{name}")
            df = spark.read.parquet(f"{tmp_path}/{i}{name}")
