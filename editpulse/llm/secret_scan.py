"""Secret scan with corpus-wide ownership frequency; built-in functions only.

Each kind is one regular expression. Its matches are taken leftmost and without
overlap; places follow from the lengths of the pieces between them (code points,
end exclusive). A candidate's hash is then counted over the corpus by distinct
owners and by distinct repositories: a value found with more than ``max_owners``
owners, or with several owners in more than ``max_repos`` repositories, is a widely
copied example; any other looks live, and so does a value of one owner however
often it stands there. Base kinds (assign, access, hex) are always reported; further
kinds only where they look live. Where the table names no repositories, distinct
texts are counted for them, so that copies of one document are one.

A private key is reported from header to footer and hashed by its body; one cut off
before the footer ends with its base64 lines, and a header without either is none.

Counting goes by distinct (hash, owner), (hash, repository) and partial sums, so a
value in a third of all rows costs a row per task. Texts are read once and not shuffled.

A null text is empty and has no secrets; a null owner or repository is one of its
own; repeated rows are one repository but rows of their own in the result. Further
columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.session import stored

MAX_OWNERS, MAX_REPOS = 2, 10

# Base patterns of the contract (name, pattern, secret's group,
# least characters of it), then kinds of the method.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
_LABEL = "[A-Z ]*PRIVATE KEY-----"
FURTHER = (
    ("bearer", r"(?i)bearer\x20+([A-Za-z0-9._~+/-]{20,}+)", 1, 20),
    ("vendor", r"gh[opsru]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35,}+", 0, 14),
    ("url", r"://[^\s/:@]++:([^\s/:@]{4,}+)@", 1, 4),
    ("key", f"-----BEGIN {_LABEL}((?>[\\s\\S]*?(?=-----))(?=-----END {_LABEL})|\\s*+[A-Za-z0-9+/=\\r\\n]{{40,}}+)(?:-----END {_LABEL})?+", 1, 1),
)
KINDS = BASE + FURTHER


#: Entries of an array that are summed up together, see ``_ends``.
SUMMED = 256


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _ends(lengths: Column) -> Column:
    """Running sums of an array of integers. Each step of ``aggregate`` copies the
    sums so far, so they run inside blocks first and then over the blocks."""
    none = F.array().cast("array<int>")
    last = lambda sums: F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0))
    sums = lambda xs: F.aggregate(xs, none, lambda acc, n: F.concat(acc, F.array(last(acc) + n)))
    blocks = lambda xs: F.transform(
        F.sequence(F.lit(0), (F.size(xs) / SUMMED).cast("int")), lambda b: sums(F.slice(xs, b * SUMMED + 1, F.lit(SUMMED))))
    joined = lambda inner: F.flatten(F.zip_with(
        inner, sums(F.transform(inner, last)), lambda own, upto: F.transform(own, lambda x: x + upto - last(own))))
    return _let(lengths, lambda xs: _let(blocks(xs), joined))


def _spans(text: Column, number: int) -> Column:
    """Array of (start, kind, end, hash) of one kind's matches."""
    _, pattern, group, least = KINDS[number]
    kind = "array<struct<start:int,kind:int,end:int,hash:string>>"

    def spans(whole: Column) -> Column:
        value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        size = F.transform(whole, F.char_length)
        ends = _ends(F.zip_with(size, F.slice(F.split(text, pattern, -1), 1, F.size(whole)), lambda n, gap: n + F.char_length(gap)))
        places = F.zip_with(ends, whole, lambda end, match: F.struct((end - F.char_length(match)).alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        rows = F.zip_with(places, value, lambda at, v: F.struct(at["start"], at["kind"], at["end"], v.alias("value")))
        kept = F.filter(rows, lambda x: F.char_length(x["value"]) >= least)
        return F.transform(kept, lambda x: F.struct(x["start"], x["kind"], x["end"], F.sha2(x["value"].cast("binary"), 256).alias("hash"))).cast(kind)
    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).otherwise(F.array().cast(kind))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """(row_no, doc_id, owner, repo, found): every candidate of every text, kept
    in the shared folder without the texts."""
    c = lambda name: F.col(f"`{name}`")
    text, owner = F.coalesce(c(text_col), F.lit("")), c(owner_col).cast("string")
    repo = F.to_json(F.struct(owner.alias("o"), c(repo_col).cast("string").alias("r"))) if repo_col else F.sha2(text.cast("binary"), 256)
    return stored(docs.select(
        F.monotonically_increasing_id().alias("row_no"), c(id_col).alias("doc_id"), owner.alias("owner"),
        repo.alias("repo"), F.concat(*[_spans(text, i) for i in range(len(KINDS))]).alias("found")), "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repos): distinct owners and repositories of each value."""
    each = found.select(F.explode("found").alias("x"), "owner", "repo").select("x.hash", "owner", "repo").distinct()
    count = lambda what: each.select("hash", what).distinct().groupBy("hash").agg(F.count("*").alias(f"{what}s"))
    return count("owner").join(count("repo"), "hash")


def scan(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS, **columns) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, and
    how many of them look live or are widely copied."""
    found = candidates(docs, **columns)
    live = ownership(found).select("hash", ((F.col("owners") == 1) | ((F.col("owners") <= max_owners) & (F.col("repos") <= max_repos))).alias("live"))
    judged = found.filter("size(found) > 0").select("row_no", "doc_id", F.explode("found").alias("x")).select("row_no", "doc_id", "x.*").join(live, "hash")
    rows = judged.groupBy("row_no").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("s"))
    empty = found.filter("size(found) = 0").select("row_no", "doc_id", F.array().cast(rows.schema["s"].dataType).alias("s"))
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    shown = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("s", lambda x: x["kind"] < len(BASE))
    count = lambda test: F.size(F.filter("s", test)).cast("bigint")
    of_kind = lambda i: count(lambda x: x["kind"] == i)
    return rows.unionByName(empty).select(
        "doc_id", *[of_kind(i).alias(f"n_{k[0]}") for i, k in enumerate(BASE)],
        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"),
        shown(F.filter("s", lambda x: (x["kind"] < len(BASE)) | x["live"])).alias("spans"),
        count(lambda x: x["live"]).alias("n_live"), count(lambda x: ~x["live"]).alias("n_copied"))
