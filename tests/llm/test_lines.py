"""Line de-duplication: independent brute force, copies, boilerplate, numbers and code."""

import itertools
import re
from collections import defaultdict

import pytest

from editpulse.llm import lines
from editpulse.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


def prose(i, n=12):
    """A line of n words that only text i has."""
    return " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(n))


def dropped(spark, texts, limit=lines.BROADCAST_TEMPLATES, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    rows = lines.drop_recurring(df, broadcast_templates=limit, **more).collect()
    assert len(rows) == len(texts)
    return [r.text for r in sorted(rows)]


# brute force: templates as tuples, similarity on true sets ----------------------

def brute_templates(line):
    tokens = ["<*>" if re.search("[0-9]", t) else t for t in re.split("[\t-\r ]+", line.strip("\t\n\x0b\x0c\r "))]
    if tokens == [""]:
        return set()
    n, found = len(tokens), {tuple(tokens)}
    if n >= 6:
        size = (n - 2) // 3
        for a, b in ((2, 2 + size), (2 + size, 2 + 2 * size), (2 + 2 * size, n)):
            found.add((a, b, *tokens[:a], "<*>", *tokens[b:]))
    return {(n, t, sum(bool(re.search("[A-Za-z\x80-\U0010ffff]", str(w))) for w in t)) for t in found}


def needed(words):
    return 3 if words >= 20 else 10 if words >= 5 else 40 if words >= 3 else 1 << 60


def brute_shingles(text):
    w = re.findall("[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def brute_drop(texts):
    different = sorted({t for t in texts if t})
    of = {t: [(line, brute_templates(line)) for line in t.split("\n")] for t in different}
    held = defaultdict(set)
    for t in different:
        for _, found in of[t]:
            for x in found:
                held[x].add(t)
    some = {x for x, ts in held.items() if len(ts) >= needed(x[2])}
    size = {t: [(len(line.split()), bool(found & some)) for line, found in of[t]] for t in different}
    suspects = [t for t in different if 2 * sum(n for n, x in size[t] if x) > sum(n for n, _ in size[t])]
    root = {t: t for t in different}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t
    sets = {t: brute_shingles(t) for t in suspects}
    for a, b in itertools.combinations(suspects, 2):
        s = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        assert not 0.6 < s < 0.8, "a pair that the sketch may judge either way"
        if s >= 0.8:
            root[find(a)] = find(b)
    recurs = {x for x in some if len({find(t) for t in held[x]}) >= needed(x[2])}
    return [t and "\n".join(line for line, found in of[t] if not found & recurs) for t in texts]


def test_query_brute_force(spark):
    docs = sorted(Q.documents(spark, SMALL).collect(), key=lambda r: r.doc_id)
    found = sorted(Q.op5_line_dedup(spark, SMALL).collect(), key=lambda r: r.doc_id)
    expected = brute_drop([d.text for d in docs])
    assert [r.text for r in found] == expected and [r.n_chars for r in found] == [len(t) for t in expected]
    assert any(t != d.text for t, d in zip(expected, docs))


@pytest.mark.parametrize("limit", [1000, 0])
def test_mixture_brute_force(spark, limit):
    """Boilerplate, passages, copies and near copies together, by both plans."""
    base = "\n".join(prose(300 + k, 30) for k in range(6))
    texts = [f"{prose(i)}\nprinted on day {i} of the year by machine\n\nshort" for i in range(11)]
    texts += [None, "", "short", "one two three four five\n42\n}"] * 3
    texts += [base.replace(f"word{chr(97 + 300 // 26)}{chr(97 + 300 % 26)}a{chr(97 + k)}", "edited" + chr(97 + k)) for k in range(12)] + [base] * 4
    texts += [f"{prose(20 + i, 40)}\n{prose(99, 55)}" for i in range(4)]
    assert dropped(spark, texts, limit) == brute_drop(texts)


# named cases --------------------------------------------------------------------

@pytest.mark.parametrize("limit", [1000, 0])
def test_boilerplate_goes_whatever_its_share(spark, limit):
    plate = "read the terms of use before you go on\nall of the rights in this page are kept by us"
    texts = [f"{prose(i, 10)}\n{plate}" for i in range(12)] + [plate, f"{plate}\n\n"]
    assert dropped(spark, texts, limit) == [prose(i, 10) for i in range(12)] + ["", "\n"]


def test_copies_stay_whole(spark):
    text = "\n".join(prose(k, 25) for k in range(8))
    texts = [text] * 15 + [f"{text}\nedited by {prose(50 + i, 2)}" for i in range(15)]
    assert dropped(spark, texts) == texts


def test_copies_count_once(spark):
    shared = "this line stands in copies and in one more text"
    texts = [f"{prose(0)}\n{shared}"] * 11 + [f"{prose(1, 40)}\n{shared}"]
    assert dropped(spark, texts) == texts


def test_numbers_and_code_stay(spark):
    texts = [f"{prose(i)}\n{i * 37}\n3.{i} {i}\nint x{i};\n}}\nelse {{\n| 1{i} | a{i} |" for i in range(60)]
    assert dropped(spark, texts) == texts


@pytest.mark.parametrize("n", range(2, 10))
def test_planted_passages(spark, n):
    passage = prose(200, 55)
    texts = [f"{prose(i, 30)}\n{passage}\n{prose(100 + i, 30)}" for i in range(n)]
    gone = [t.replace(f"\n{passage}", "") for t in texts]
    assert dropped(spark, texts) == (gone if n >= 3 else texts)


def test_long_texts_and_columns(spark):
    plate = "read the terms of use before you go on"
    long = "\n".join(prose(i, 20) for i in range(600)) * 14
    assert len(long) > 1 << 20
    rows = [(i, f"{prose(i)}\n{plate}", 3, "k") for i in range(12)] + [(12, f"{long}\n{plate}", 4, None), (None, None, None, None), (14, "", 0, "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int, template string").withColumnRenamed("template", "key")
    for limit in (1000, 0):
        out = lines.drop_recurring(df, broadcast_templates=limit)
        found = {r.doc_id: r for r in out.collect()}
        assert out.columns == df.columns and found[0].text == prose(0) and found[0].n_chars == len(prose(0))
        assert found[12].text == long and found[None].text is None and found[None].n_chars is None and (found[14].text, found[14].n_chars) == ("", 0)
    assert lines.drop_recurring(df.limit(0)).count() == 0
