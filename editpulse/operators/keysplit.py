"""Ordered per-key computations that survive hot keys.

``lag`` and ``row_number`` over a page or a user need all rows of the key in
one task. When one key holds a large part of the table that task never ends.
``split_hot_keys`` counts rows per key first. If no key exceeds the limit the
callers build an ordinary window. Otherwise the rows of hot keys, and only
these, are range-partitioned by key and position, so they are cut by rank: a
burst, a flood within one second or a mass of rows without a time is cut like
anything else. The partition number is stored with the rows as their segment,
the window is partitioned by (key, segment), and every segment but a key's
first receives one *carry* row that stands for everything before it: the last
row of the previous segment and the number of rows so far. Results are the
same as those of the plain window.

Sizes are bounded by construction: a key is hot only above
``max(max_rows, total / MAX_SEGMENTS)`` rows, so there are fewer than
``MAX_SEGMENTS`` hot keys and at most ``4 * MAX_SEGMENTS`` segments however
large the data is; only the hot keys themselves are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from editpulse.session import stored

MAX_ROWS = 5_000_000
MAX_SEGMENTS = 50_000

SEGMENT = "_segment"
CARRY = "_carry"
WEIGHT = "_weight"


@dataclass
class KeySplit:
    """How the rows of one key column are spread over window partitions."""

    key: str
    hot: DataFrame | None = None      # hot keys
    n_ranges: int = 1

    @property
    def partition_by(self) -> list[str]:
        return [self.key] if self.hot is None else [self.key, SEGMENT]

    def order_by(self, order: list[str]) -> list[Column]:
        """Carry rows come before all rows of their segment, ties included."""
        columns = [F.col(c) for c in order]
        return columns if self.hot is None else [F.desc(CARRY), *columns]

    def place(self, df: DataFrame, order: list[str]) -> DataFrame:
        """Add the segment number: 0 for ordinary keys, by rank for hot ones.

        Reads ``df`` twice. Hot rows are stored with their segment, so every
        reader and every retried task sees the same cuts. Rows that tie in the
        order are cut by their contents.
        """
        contents = [f.name for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
        hot = (
            _lookup(df, self.hot, [self.key], "left_semi")
            .repartitionByRange(self.n_ranges, self.key, *order, F.xxhash64(*contents))
            .withColumn(SEGMENT, F.spark_partition_id() + 1)
        )
        rest = _lookup(df, self.hot, [self.key], "left_anti").withColumn(SEGMENT, F.lit(0))
        return rest.unionByName(stored(hot, "hot-rows"))

    def carries(self, placed: DataFrame, last: list[Column]) -> DataFrame:
        """One row per hot (key, segment) that has a successor: the aggregates
        ``last`` of the segment, its rows, and ``_next``, the segment after."""
        return (
            placed.filter(F.col(SEGMENT) > 0)
            .groupBy(self.key, SEGMENT)
            .agg(F.count(F.lit(1)).alias("_rows"), *last)
            .withColumn("_next", F.lead(SEGMENT).over(self._along()))
        )

    def _along(self):
        return Window.partitionBy(self.key).orderBy(SEGMENT)

    def spread(self, stats: DataFrame, placed: DataFrame) -> DataFrame:
        """Repeat per-key rows for each segment, so a join can use
        (key, segment) and stay balanced."""
        cuts = placed.filter(F.col(SEGMENT) > 0).groupBy(self.key).agg(
            F.collect_set(SEGMENT).alias("_cuts"))
        return (
            _lookup(stats, cuts, [self.key], "left")
            .withColumn(SEGMENT, F.explode(F.coalesce("_cuts", F.array(F.lit(0)))))
            .drop("_cuts")
        )


def _lookup(df: DataFrame, table: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with one of the bounded lookup tables; a NULL key matches itself,
    as it does in a window partition."""
    return _null_safe(df, F.broadcast(table), on, how)


def _null_safe(df: DataFrame, table: DataFrame, on: list[str], how: str) -> DataFrame:
    other = table.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return df.join(other, same, how).drop(*[f"_on_{c}" for c in on])


def _key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def hot_limit(counts: DataFrame, max_rows: int | None) -> int | None:
    """Rows above which a key is hot, or None when no key is."""
    if max_rows is None:
        return None
    summary = counts.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("largest")).first()
    limit = max(max_rows, (summary.total or 0) // MAX_SEGMENTS)
    return limit if (summary.largest or 0) > limit else None


def has_hot_keys(df: DataFrame, key: str, max_rows: int | None = MAX_ROWS) -> bool:
    return hot_limit(_key_counts(df, key), max_rows) is not None


def split_hot_keys(df: DataFrame, key: str, max_rows: int | None = MAX_ROWS) -> KeySplit:
    """Find the hot keys of ``df``.

    Runs one counting job whose map-side combine leaves one row per key and
    map task. ``max_rows=None`` skips it for keys known to be small. Ranges are
    planned at half the limit, so that with sampled bounds a segment stays well
    below twice the limit.
    """
    counts = _key_counts(df, key)
    limit = hot_limit(counts, max_rows)
    if limit is None:
        return KeySplit(key)
    hot = stored(counts.filter(F.col("_rows") > limit), "hot-keys")
    ranges = hot.agg(F.sum(F.ceil(2 * F.col("_rows") / F.lit(limit)))).first()[0]
    return KeySplit(key, hot.select(key), int(ranges))


def with_sequence(df: DataFrame, split: KeySplit, order: list[str],
                  values: tuple[str, ...] = (), *, stats: DataFrame | None = None,
                  source: DataFrame | None = None) -> DataFrame:
    """Prepare ``df`` for ordered windows over ``split.partition_by``.

    Adds the carry rows (hot keys only) and joins per-key ``stats`` on the same
    keys the window uses, so the join and the window share one shuffle.
    ``values`` are the columns whose previous value the windows look at; carry
    rows hold these and the order, nothing else. With ``source``, a table that
    has the same rows, ``df`` is taken to be dear and is stored before it is
    read twice. The caller ends with ``drop_carry``.
    """
    if split.hot is None:
        return df if stats is None else df.join(stats, split.key, "left")
    placed = split.place(df if source is None else stored(df, "rows"), order)
    narrow = list(dict.fromkeys([*order, *values]))
    last = F.max_by(F.struct(*narrow), F.struct(*order)).alias("_last")
    carry = (
        split.carries(placed, [last])
        .withColumn(WEIGHT, F.sum("_rows").over(split._along()))
        .filter("_next IS NOT NULL")
        .select(split.key, *[F.col(f"_last.{c}").alias(c) for c in narrow if c != split.key],
                F.col("_next").alias(SEGMENT), F.lit(True).alias(CARRY), WEIGHT)
    )
    rows = placed.select("*", F.lit(False).alias(CARRY), F.lit(1).cast("bigint").alias(WEIGHT))
    out = rows.unionByName(carry, allowMissingColumns=True)
    if stats is not None:
        out = out.join(split.spread(stats, placed), split.partition_by, "left")
    return out


def row_sequence(split: KeySplit, order: list[str]) -> Column:
    """1, 2, 3 … within the key, as BIGINT: a hot key may pass two billion."""
    w = Window.partitionBy(*split.partition_by).orderBy(*split.order_by(order))
    if split.hot is None:
        return F.row_number().over(w).cast("bigint")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(WEIGHT).over(running)


def previous(column, split: KeySplit, order: list[str]) -> Column:
    """Value of the row before, within the key."""
    w = Window.partitionBy(*split.partition_by).orderBy(*split.order_by(order))
    return F.lag(column).over(w)


def drop_carry(df: DataFrame, split: KeySplit) -> DataFrame:
    if split.hot is None:
        return df
    return df.filter(~F.col(CARRY)).drop(SEGMENT, CARRY, WEIGHT)


def running_counts(key: str, seconds: Column, horizons: dict[str, int]) -> dict[str, Column]:
    """Rows of the same key in the last N seconds, the current second included,
    for keys that fit one task.

    A sliding RANGE frame re-reads its frame for every row. The rows up to now
    less the rows up to N + 1 seconds ago are two frames that only grow, so both
    are one pass. Rows without a time are peers of each other and of nobody else.
    """
    along = Window.partitionBy(key).orderBy(seconds)
    now = F.count(F.lit(1)).over(along.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    before = {n: F.count(F.lit(1)).over(along.rangeBetween(Window.unboundedPreceding, -length - 1))
              for n, length in horizons.items()}
    return {n: now - F.when(seconds.isNull(), 0).otherwise(b) for n, b in before.items()}


def trailing_counts(df: DataFrame, key: str, seconds: Column, horizons: dict[str, int],
                    max_rows: int | None = MAX_ROWS,
                    source: DataFrame | None = None, split: KeySplit | None = None) -> DataFrame:
    """Rows of the same key in the last N seconds, the current second included.

    Without hot keys these are running counts in the key's own window, on the
    shuffle any other window over the key uses. With hot keys (found here, or by
    the caller's ``split``) rows are first counted per (key, second); each
    count enters at its own second and leaves N+1 seconds later, and a running
    sum over these entries and exits gives the same numbers in one sorted pass
    over at most ``1 + len(horizons)`` rows a second. Whole rows take no part
    in it and are joined with their second's counts, so a flood within a second
    costs the window one row. ``source`` may name a cheaper table with the same
    rows to count.
    """
    counted = df if source is None else source
    if (not has_hot_keys(counted, key, max_rows)) if split is None else split.hot is None:
        return df.withColumns(running_counts(key, seconds, horizons))
    # Rows without a time sort first, and leave before every real second.
    long_ago = F.lit(-(2 ** 62)).cast("bigint")
    names = list(horizons)
    deltas = [f"_d{i}" for i in range(len(names))]
    per_second = (
        counted.select(key, seconds.alias("_at"))
        .groupBy(key, "_at").agg(F.count(F.lit(1)).alias("_n")))
    none = F.lit(0).cast("bigint")

    def step(at: Column, own: Column, sign: list[int]) -> Column:
        return F.struct(at.alias("_at"), own.alias("_own"),
                        *[(F.col("_n") * k).alias(d) for k, d in zip(sign, deltas)])

    enter = step(F.col("_at"), F.col("_n"), [1] * len(names))
    leave = [step(F.coalesce(F.col("_at") + length + 1, long_ago), none,
                  [-1 if j == i else 0 for j in range(len(names))])
             for i, length in enumerate(horizons.values())]
    steps = (
        per_second.select(key, F.explode(F.array(enter, *leave)).alias("_step"))
        .select(key, "_step.*")
        .groupBy(key, "_at")
        .agg(*[F.sum(c).alias(c) for c in ("_own", *deltas)])
    )
    split = KeySplit(key)
    if max_rows is not None:
        # Entries and exits are few only per second, so they are counted too.
        if has_hot_keys(per_second, key, max(1, max_rows // (1 + len(names)))):
            steps = stored(steps, "steps")
            split = split_hot_keys(steps, key, max_rows)
    if split.hot is not None:
        placed = split.place(steps, ["_at"])
        carry = (
            split.carries(placed, [F.sum(d).alias(d) for d in deltas])
            .select(key, F.col("_next").alias(SEGMENT), F.lit(True).alias(CARRY),
                    *[F.sum(d).over(split._along()).alias(d) for d in deltas])
            .filter(F.col(SEGMENT).isNotNull())
        )
        steps = placed.withColumn(CARRY, F.lit(False)).unionByName(carry, allowMissingColumns=True)
    running = (
        Window.partitionBy(*split.partition_by).orderBy(*split.order_by(["_at"]))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counts = (
        steps.select(key, "_at", "_own", *[F.sum(d).over(running).alias(n) for d, n in zip(deltas, names)])
        .filter("_own > 0").drop("_own")
    )
    return _null_safe(df.withColumn("_at", seconds), counts, [key, "_at"], "left").drop("_at")
