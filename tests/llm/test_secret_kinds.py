"""Private keys by their body, ownership by owners first, tokens of any length."""

import random
import string

import pytest

from editpulse.llm import secret_scan

SCHEMA = "doc_id bigint, text string, source string"


def scanned(spark, rows, **more):
    return {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(rows, SCHEMA), **more).collect()}


def base64_lines(rng, n=6):
    return "\n".join("".join(rng.choices(string.ascii_letters + string.digits + "+/", k=64)) for _ in range(n))


def pem(body, label="RSA "):
    return f"-----BEGIN {label}PRIVATE KEY-----\n{body}\n-----END {label}PRIVATE KEY-----"


def test_private_keys_of_many_owners(spark):
    rng = random.Random(1)
    own = [pem(("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC,00FF\n\n" if i % 3 else "") + base64_lines(rng)) for i in range(14)]
    rows = [(i, f"é {k} end", f"owner{i}") for i, k in enumerate(own)]
    shared, cut = pem(base64_lines(rng), "EC "), f"-----BEGIN PRIVATE KEY-----\n{base64_lines(rng)}"
    rows += [(100 + i, shared, f"owner{i}") for i in range(3)] + [(200, cut + ", and more prose", "x"), (201, "-----BEGIN PRIVATE KEY----- only named", "y")]
    rows += [(300, f"{own[0]}\n{own[1]}", "owner0")]
    found = scanned(spark, rows)
    assert all(found[i].spans.split(",").count(f"key:2:{2 + len(k)}") == 1 and found[i].n_live >= 1 for i, k in enumerate(own))
    assert all("key" not in found[100 + i].spans and found[100 + i].n_copied == 1 for i in range(3))
    assert f"key:0:{len(cut)}" in found[200].spans.split(",") and "key" not in found[201].spans
    assert f"key:0:{len(own[0])}" in found[300].spans and f"key:{len(own[0]) + 1}:{len(own[0]) + 1 + len(own[1])}" in found[300].spans


def test_many_headers_without_footer(spark):
    text = "-----BEGIN PRIVATE KEY----- " * 20000
    assert scanned(spark, [(1, text, "s")])[1].spans == ""


def test_one_owner_in_many_documents(spark):
    own, two, copies = ("bearer " + c * 30 for c in "qrs")
    rows = [(i, f"{own} number {i}", "a") for i in range(15)]
    rows += [(100 + i, f"{two} number {i}", f"b{i % 2}") for i in range(15)]
    rows += [(200 + i, copies, f"c{i % 2}") for i in range(15)]
    found = scanned(spark, rows)
    assert all(found[i].spans == f"bearer:0:{len(own)}" for i in range(15))
    assert all(found[100 + i].spans == "" and found[100 + i].n_copied == 1 for i in range(15))
    assert all(found[200 + i].spans == f"bearer:0:{len(copies)}" for i in range(15))


@pytest.mark.parametrize("n", [64, 1000, 5000])
def test_long_tokens(spark, n):
    kinds = {"bearer": "bearer {}", "vendor": "sk_live_{}", "url": "://{}:pass{}@"}
    rows = []
    for k, form in enumerate((*kinds.values(), "xoxb-{}", "ghp_{}", "AIza{}")):
        # different tokens of many owners with one prefix
        rows += [(10 * k + i, form.format("x" * n + str(i), "z" * n + str(i)), f"owner{i}") for i in range(4)]
    found = scanned(spark, rows)
    name = [*kinds, "vendor", "vendor", "vendor"]
    assert all(found[d].spans == f"{name[d // 10]}:0:{len(t)}" and found[d].n_live == 1 for d, t, _ in rows)
