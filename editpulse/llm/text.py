"""Text columns as bytes: words, hashes and Arrow batches for the operators.

Texts are UTF-8 bytes throughout. Lower-casing A-Z, and the word pattern
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (digits, a-z and everything outside
ASCII) act on single bytes, so bytes give the same words as code points.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TO_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
WORD_BYTE = np.array([48 <= i <= 57 or 97 <= i <= 122 or i >= 128 for i in range(256)])
#: Bytes of text handled at once inside a task; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: Limits of an Arrow batch between Spark and a Python task.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return np.frombuffer(data.tobytes().translate(TO_LOWER), np.uint8)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTE):
    """(start, end) of every run of ``table`` bytes, never across texts, and
    the number of words before each text."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = table[data]
    bound = offsets[:-1][offsets[:-1] < n]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[bound] = inside[bound]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    before = bound[bound > 0] - 1
    ends[before] = inside[before]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice. Callers compare bytes where it matters."""
    powers, inverse = _power_tables(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return h


def window_hashes(h: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, hashes of all runs of k words) for k = 1 … longest."""
    acc, factor = np.zeros(len(h), np.uint64), np.uint64(1)
    for k in range(1, min(longest, len(h)) + 1):
        acc = acc[: len(h) - k + 1] + h[k - 1 :] * factor
        factor = np.uint64((int(factor) * int(_BASE)) % (1 << 64))
        yield k, acc


class HashSet:
    """Membership of many 64-bit hashes in a bounded set: a bit table first,
    then binary search among the few that pass."""

    def __init__(self, values: np.ndarray, bits: int = 20):
        self.values, self.shift = np.unique(values.astype(np.uint64)), np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.values >> self.shift] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Positions in ``h`` that hold a member."""
        at = np.flatnonzero(self.table[h >> self.shift])
        if not len(at):
            return at
        found = np.searchsorted(self.values, h[at])
        found[found == len(self.values)] = 0
        return at[self.values[found] == h[at]]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the given columns under fixed names, so that further columns of
    the input can neither clash nor travel."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def limit_batches(spark) -> None:
    """Hold Arrow batches to BATCH_BYTES, unless the session already asks for
    less: texts are long, and every task holds a few batches at once."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = int(re.match(r"-?\d+", spark.conf.get(key))[0])
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """One output batch for each input batch; rows never leave their task. Workers
    outlive their stage, and what they hold on to is missing in the next one: what
    earlier stages have left goes when a task begins, and memory that Arrow has freed
    after each batch."""
    limit_batches(df.sparkSession)

    def run(batches):
        gc.collect()
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
            del batch, out
            pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
