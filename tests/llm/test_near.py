"""Near copies against brute force over pairs of shingle sets."""

import random

from pyspark.sql import functions as F

from editpulse.llm import near


def shingle_set(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def planted(rng, groups=40):
    """Texts of 60 to 200 words, each with edited copies around similarity 0.8."""
    texts = []
    for g in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 200))]
        texts.append(" ".join(base))
        for edits in range(1, 6):
            words = list(base)
            for at in rng.sample(range(len(words)), edits):
                words[at] = f"edit{rng.randrange(9999)}"
            texts.append(" ".join(words))
    return texts


def test_near_copies_of_similarity_08_go(spark):
    import corpus_pipeline as P
    texts = planted(random.Random(3))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    kept = sorted(r.doc_id for r in P.near_dedup(spark, df, "").collect())
    sets = [shingle_set(t) for t in texts]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(sets[a], sets[b]) >= 0.8]
    assert len(pairs) > 100 and not [p for p in pairs if set(p) <= set(kept)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert set(kept) == {find(i) for i in range(len(texts))}


def test_near_large_group_of_dissimilar_texts_in_one_bucket(spark, monkeypatch):
    """More unlike texts in a bucket than hubs of a round: later pairs are met all the same."""
    monkeypatch.setattr(near, "HUBS", 2)
    rng = random.Random(4)
    common = " ".join(f"c{i}" for i in range(60))
    texts = [f"{common} " + " ".join(f"t{rng.randrange(10**6)}" for _ in range(30)) for _ in range(10)]
    texts += [t + " end" for t in texts[5:]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted(r.doc_id for r in near.keep_one(df).collect()) == list(range(10))


def test_texts_near_only_to_texts_that_have_left(spark):
    """The last text is near to all, which are not near to each other: one class, though
    the last text leaves in the first round."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(8, 92, 7), 2):
            words[at] = f"edit{i}at{at}"
        texts.append(" ".join(words))
    texts.append(" ".join(base))
    sets = [shingle_set(t) for t in texts]
    assert all(jaccard(s, sets[-1]) >= 0.8 for s in sets) and jaccard(sets[0], sets[1]) < 0.8
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert [r.doc_id for r in near.keep_one(df).collect()] == [0]


def test_other_text_of_a_repeated_id_keeps_its_links(spark):
    """One text of id 5 is a copy, the other is near to id 7: all three are one class."""
    one, two = (" ".join(f"{c}{i}" for i in range(80)) for c in "xy")
    df = spark.createDataFrame([(1, one), (5, one), (5, two), (7, two + " end")], "key bigint, text string")
    assert sorted(map(tuple, near.classes(df).collect())) == [(5, 1), (7, 1)]


def test_near_edges(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "entirely different words here"), (3, None), (4, " \n"), (None, "a b c d"), (5, "A B\tc d"), (6, "a b c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [r.doc_id for r in near.keep_one(df).collect()]
    assert sorted(kept, key=lambda x: (x is None, x)) == [1, 2, 3, 6, None]
    assert near.keep_one(df.limit(0)).count() == 0


def test_texts_of_one_id_stay(spark):
    """Of rows with one id each different text stays, once, whatever the partitions."""
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long, "a"), (1, "some other words in this text", "b"), (1, long, "a"), (1, long, "b"), (2, long + " x", "c"), (3, "third", "d")]
    for n in (1, 4):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, place string").repartition(n)
        assert sorted(tuple(r) for r in near.keep_one(df).collect()) == [(1, "some other words in this text", "b"), (1, long, "a"), (3, "third", "d")]


def test_texts_are_not_shuffled(spark, monkeypatch):
    """Sets are made where the texts are read, and rounds join sets."""
    plans, real = {}, near.stored

    def watched(df, label):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)
    monkeypatch.setattr(near, "stored", watched)
    df = spark.createDataFrame(list(enumerate(planted(random.Random(1), 4))), "key bigint, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert near.classes(df).count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plans["near-sets"][0] and "Exchange" not in plans["near-sketch"][0]
    for label in ("near-ties", "near-buckets", "near-pairs", "near-hubs"):
        assert all("text#" not in p for p in plans[label])


def test_wanted_sets_pass_a_full_table(spark, monkeypatch):
    """A table of bits too small for its keys lets more sets pass, and loses none."""
    texts = planted(random.Random(8), 12)
    df = spark.createDataFrame(list(enumerate(texts)), "key bigint, text string").repartition(3)
    want = sorted(map(tuple, near.classes(df).collect()))
    monkeypatch.setattr(near, "FILTER_BITS", (1 << 15, 1 << 15))
    assert len(want) > 10 and sorted(map(tuple, near.classes(df).collect())) == want
    keys = spark.range(3000, 3100).select(F.col("id").alias("key"))
    bits = near._key_bits(keys)
    assert len(bits) == 1 << 12 and 90 <= sum(bin(b).count("1") for b in bits.tolist()) <= 100
