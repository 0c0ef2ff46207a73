"""Per-page and per-user history that deliveries extend.

The ordered features of a revision (size change, positions, gaps, revert candidates)
depend on the revision before it on its page, and by its user. The last row of every
page and user is kept as a carry; a delivery whose revisions come after it is
computed from its own rows and the carries of the keys it touches. A key that a
delivery reaches with an earlier revision is computed again from all its rows, and
only such keys: their older rows are marked as superseded. All tables lie in
buckets of the key, so a delivery reads only the buckets it touches, and become
visible together (see ``sources.deliveries``).

Revisions are known by their id: a second delivery of an id changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.operators.clean import dedup_revisions, size_change
from editpulse.operators.features import page_sequence, user_sequence
from editpulse.operators.keysplit import MAX_ROWS
from editpulse.session import stored
from editpulse.sources import deliveries as D
from editpulse.sources.id_index import add_ids, not_indexed

BUCKETS = 256
BASE = ["page_title", "user", "revid", "timestamp", "size_bytes"]
_BASE_DDL = "page_title string, user string, revid bigint, timestamp timestamp, size_bytes bigint"


@dataclass(frozen=True)
class Side:
    """One of the two histories: its key, and the columns it derives."""
    name: str
    key: str
    sequence: str
    derived: str

    @property
    def schema(self) -> str:
        return f"{_BASE_DDL}, {self.derived}, bucket int"

    @property
    def columns(self) -> list[str]:
        return [c.split(" ")[0] for c in self.derived.split(", ")]


PAGES = Side("pages", "page_title", "page_edit_sequence", "size_change bigint, size_change_abs bigint, page_edit_sequence bigint, is_revert_candidate int")
USERS = Side("users", "user", "user_edit_sequence", "user_edit_sequence bigint, time_since_last_edit_sec bigint, user_is_rapid_editor int")


def _derived(rows: DataFrame, side: Side, max_rows: int | None) -> DataFrame:
    """Rows with the side's features; carries among them (``held`` set) keep the
    size change they are stored with, and number the rows after them."""
    if side is USERS:
        out = user_sequence(rows, max_rows=max_rows)
    else:
        changed = size_change(rows, max_rows=max_rows).withColumn("size_change", F.coalesce("held.size_change", "size_change"))
        out = page_sequence(stored(changed, "history-changes"), max_rows=max_rows)
    return out


def _with_carries(new: DataFrame, carries: DataFrame, side: Side, max_rows: int | None) -> DataFrame:
    """Features of revisions that come after the carries of their keys."""
    held = F.struct(F.col(side.sequence).cast("bigint").alias("sequence"), *([F.col("size_change")] if side is PAGES else []))
    before = carries.select(*BASE, held.alias("held"))
    none = F.lit(None).cast(before.schema["held"].dataType)
    rows = stored(before.unionByName(new.select(*BASE, none.alias("held"))), "history-rows")
    out = _derived(rows, side, max_rows).filter("held IS NULL").drop("held")
    offsets = carries.select(side.key, (F.col(side.sequence) - 1).alias("offset"))
    return out.join(offsets, side.key, "left").withColumn(side.sequence, F.col(side.sequence) + F.coalesce("offset", F.lit(0)))


def _bucket(side: Side, buckets: int):
    return F.pmod(F.xxhash64(side.key), F.lit(buckets)).cast("int")


def current_rows(spark: SparkSession, path: str, side: Side, buckets: list[int] | None = None, numbers: list[int] | None = None) -> DataFrame:
    """The valid rows of one side, of some buckets if given: those of deliveries
    after which their key was not computed again."""
    numbers = D.committed(spark, path) if numbers is None else numbers
    rows = D.read_parts(spark, path, side.name, side.schema, numbers)
    again = D.read_parts(spark, path, f"{side.name}-again", f"{side.key} string, bucket int", numbers)
    if buckets is not None:
        rows, again = (df.filter(F.col("bucket").isin(buckets)) for df in (rows, again))
    newest = again.groupBy(F.col(side.key).alias("key")).agg(F.max("delivery").alias("since"))
    return rows.join(newest, F.col(side.key) == F.col("key"), "left").filter("since IS NULL OR delivery >= since").drop("key", "since", "delivery")


def _carries(spark: SparkSession, path: str, side: Side, keys: DataFrame, buckets: list[int], numbers: list[int]) -> DataFrame:
    """The last row of each of the keys, from the buckets they lie in."""
    rows = D.read_parts(spark, path, f"{side.name}-last", side.schema, numbers).filter(F.col("bucket").isin(buckets))
    values = [c for c in rows.columns if c not in (side.key, "delivery", "bucket")]
    last = rows.join(keys.select(side.key), side.key, "left_semi").groupBy(side.key).agg(F.max_by(F.struct(*values), "delivery").alias("r"))
    return last.select(side.key, "r.*")


def _extend(spark: SparkSession, path: str, side: Side, new: DataFrame, number: int, numbers: list[int], max_rows: int | None, n_buckets: int) -> None:
    keys = stored(new.groupBy(side.key).agg(F.min(F.struct("timestamp", "revid")).alias("first")).withColumn("bucket", _bucket(side, n_buckets)), "history-keys")
    buckets = [r.bucket for r in keys.select("bucket").distinct().collect()]
    carries = stored(_carries(spark, path, side, keys, buckets, numbers), "history-carries")
    late = stored(keys.join(carries, side.key).filter(F.col("first") < F.struct("timestamp", "revid")).select(side.key, "bucket"), "history-late")
    on_time = _with_carries(new.join(late, side.key, "left_anti"), carries.join(late, side.key, "left_anti"), side, max_rows)
    parts = [on_time]
    late_buckets = [r.bucket for r in late.select("bucket").distinct().collect()]
    if late_buckets:
        older = current_rows(spark, path, side, late_buckets, numbers).join(late, side.key, "left_semi").select(*BASE)
        rows = stored(older.unionByName(new.join(late, side.key, "left_semi").select(*BASE)), "history-again")
        parts.append(_derived(rows.withColumn("held", F.lit(None).cast("struct<sequence bigint, size_change bigint>")), side, max_rows))
    typed = [F.expr(f"cast({c} as {k}) as {c}") for c, k in (x.split(" ") for x in side.derived.split(", "))]
    rows = reduce(DataFrame.unionByName, [p.select(*BASE, *typed) for p in parts]).withColumn("bucket", _bucket(side, n_buckets))
    D.write_part(rows, path, side.name, number, by="bucket")
    D.write_part(late.select(side.key, "bucket"), path, f"{side.name}-again", number, by="bucket")
    written = D.read_parts(spark, path, side.name, side.schema, [number])
    values = [c for c in written.columns if c not in (side.key, "delivery")]
    last = written.groupBy(side.key).agg(F.max_by(F.struct(*values), F.struct("timestamp", "revid")).alias("r")).select(side.key, "r.*")
    D.write_part(last, path, f"{side.name}-last", number, by="bucket")


def extend_history(spark: SparkSession, path: str, incoming: DataFrame, *, max_rows: int | None = MAX_ROWS, buckets: int = BUCKETS) -> int:
    """Add a delivery of cleaned revisions (BASE columns); returns its number. A
    delivery that broke off before is written again. ``buckets`` stays the same for
    all deliveries of one history."""
    numbers = D.committed(spark, path)
    number = max(numbers, default=-1) + 1
    new = stored(not_indexed(incoming.select(*BASE).filter("revid IS NOT NULL"), path), "history-new")
    for side in (PAGES, USERS):
        _extend(spark, path, side, new, number, numbers, max_rows, buckets)
    add_ids(new, path, number)
    D.commit(spark, path, number)
    return number


def history_features(spark: SparkSession, path: str) -> DataFrame:
    """revid and the ordered features of every revision delivered so far."""
    pages = current_rows(spark, path, PAGES).select("revid", *PAGES.columns)
    return pages.join(current_rows(spark, path, USERS).select("revid", *USERS.columns), "revid")


def rebuilt(revisions: DataFrame, *, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """The same from all revisions at once."""
    rows = dedup_revisions(revisions.select(*BASE).filter("revid IS NOT NULL"))
    changed = size_change(rows, max_rows=max_rows)
    out = user_sequence(page_sequence(changed, max_rows=max_rows), max_rows=max_rows)
    return out.select("revid", *PAGES.columns, *USERS.columns)
