"""Quality rules with an isolation forest on their statistics.

Every whole text gives rule statistics: words (runs of non-blank bytes), code points
in words, symbols of ``#*$%&|<>``, lines that repeat an earlier line, and words inside
8-word windows that stand more than once in the text. A text of fewer than MIN_WORDS
words, or with more than 30 of 100 words in repeated windows, fails by rule.

Shares made of these and of byte counts go to an isolation forest: TREES trees, each
over PER_TREE sampled texts, cut at random features and values. A text's score is
2 ** -(mean path length / path length expected), so texts that few random cuts
isolate score high. The threshold comes from all labelled rows that pass the rules:
scores are counted in BINS bins by label, and of the cuts that take at most MAX_GOOD of the good rows the one
that best tells bad rows from good ones is taken (the highest such cut in a tie).

The forest is fitted on at most SAMPLE texts, those of least hash, copies once (a
bounded, documented parameter); statistics, threshold counts and verdicts cover all rows.

A null text has no words. Rows are judged by their text alone, so repeated rows and
ties get equal verdicts; labels that are null, or of ids without a document, are
ignored, an id labelled twice counts by its least label. Without good or without bad
labels the forest drops nothing. An empty table gives no rows; further columns
do not matter. A text must fit in its task, with its list of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.session import stored

MIN_WORDS, WINDOW, MAX_REPEATED = 20, 8, 30
SYMBOLS = b"#*$%&|<>"
TREES, PER_TREE, SAMPLE, BINS, MAX_GOOD = 100, 256, 8192, 2000, 0.01

_BLANK = b" \t\n\x0b\x0c\r"
_WITHIN = bytes(range(0x80, 0xC0))
_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_MARKS = b".,;:!?\"'()-"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("words", "mean_word", "symbols", "dup_lines", "repeated", "distinct", "upper", "digits", "marks", "line_words", "commonest", "bare")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more. Windows are told apart by
    ranks of runs of doubling length, so no hash decides."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    rank = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    length = 1
    while length < window:
        step = min(length, window - length)
        _, rank = np.unique(rank[: len(rank) - step] * (len(words) + 1) + rank[step:], return_inverse=True)
        length += step
    again = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[window : window + n] -= again
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def statistics(raw: bytes) -> tuple[tuple[int, ...], list[float]]:
    """(COUNTS, FEATURES) of one text."""
    words = raw.split()
    solid = raw.translate(None, _BLANK)
    chars = len(solid.translate(None, _WITHIN))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(_BLANK)]
    dup_lines = len(lines) - len(set(lines))
    n, size = len(words), max(len(solid), 1)
    repeated = repeated_words(words)
    few = max(n, 1)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    share = lambda kind: (len(solid) - len(solid.translate(None, kind))) / size
    upper, lower = share(_UPPER), share(_LOWER)
    features = [np.log1p(n), chars / few, symbols / few, dup_lines / max(len(lines), 1), repeated / few, len(seen) / few * np.log1p(n), upper / max(upper + lower, 1e-9),
                share(_DIGIT), share(_MARKS), np.log1p(n / max(len(lines), 1)), max(seen.values(), default=0) / few, n / max(len(raw), 1)]
    return (n, chars, symbols, dup_lines, repeated), features


def path_length(n) -> np.ndarray:
    """Mean length of an unsuccessful search among ``n`` values."""
    n = np.asarray(n, float)
    m = np.maximum(n, 3)
    return np.where(n > 2, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Random trees over a sample; arrays of (feature, cut, left, right, length)."""

    def __init__(self, x: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.size = min(per_tree, len(x))
        self.trees = [self._grow(x[rng.choice(len(x), self.size, replace=False)], rng) for _ in range(trees if len(x) > 1 else 0)]

    def _grow(self, x: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        deepest = int(np.ceil(np.log2(max(len(x), 2))))
        feature, cut, left, right, length = [], [], [], [], []
        todo = [(np.arange(len(x)), 0, -1, False)]
        while todo:
            rows, depth, parent, is_right = todo.pop()
            at = len(feature)
            if parent >= 0:
                (right if is_right else left)[parent] = at
            part = x[rows]
            low, high = part.min(0), part.max(0)
            wide = np.flatnonzero(high > low)
            for column, value in ((feature, -1), (cut, 0.0), (left, at), (right, at), (length, depth + float(path_length(len(rows))))):
                column.append(value)
            if depth < deepest and len(rows) > 1 and len(wide):
                f = int(wide[rng.integers(len(wide))])
                value = rng.uniform(low[f], high[f])
                below = part[:, f] <= value
                feature[at], cut[at] = f, value
                todo += [(rows[~below], depth + 1, at, True), (rows[below], depth + 1, at, False)]
        return np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(length)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.zeros(len(x))
        total, every = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, right, length in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                if (f < 0).all():
                    break
                node = np.where(x[every, f] <= cut[node], left[node], right[node])  # a leaf leads to itself
            total += length[node]
        return 2.0 ** (-total / len(self.trees) / max(float(path_length(self.size)), 1e-9))


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, hash of the text, the five counts and the features, of every row."""
    rows = X.named(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.col("text").cast("binary").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(2)]
        counts = [pa.array(list(c), pa.int64()) for c in zip(*(c for c, _ in found))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *counts, pa.array([x for _, x in found], pa.list_(pa.float64()))],
                                          names=["doc_id", "h", *COUNTS, "x"])
    return X.map_batches(rows, run, f"doc_id {rows.schema[0].dataType.simpleString()}, h bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", x array<double>")


def fit(stats: DataFrame, sample: int = SAMPLE) -> Forest:
    """The forest of the ``sample`` different texts of least hash."""
    cut = stats.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if cut is None:
        return Forest(np.zeros((0, len(FEATURES))))
    rows = stats.filter(F.col("h") <= cut).groupBy("h").agg(F.min("x").alias("x")).select("x").toArrow().column("x").to_pylist()
    x = np.array(rows, np.float64)
    return Forest(x[np.lexsort(x.T)])  # tasks end in any order


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """The rows with ``score`` in place of the features."""
    held = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array(batch.column(len(COUNTS) + 1).flatten()).reshape(batch.num_rows, len(FEATURES))
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(COUNTS) + 1)), pa.array(held.value.score(x))], names=["doc_id", *COUNTS, "score"])
    kind = stats.schema["doc_id"].dataType.simpleString()
    return X.map_batches(stats.select("doc_id", *COUNTS, "x"), run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", score double")


def threshold(scores: DataFrame, labels: DataFrame, max_good: float = MAX_GOOD) -> float:
    """The score from which texts are dropped, from counts over all labelled rows.
    ``labels``: doc_id, quality (1 good, 0 bad)."""
    marks = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    level = F.floor(F.col("score") * BINS).cast("int").alias("level")
    counted = scores.select("doc_id", "score").join(marks, "doc_id").groupBy(level, "quality").count().collect()
    n = np.zeros((2, BINS + 2))
    for r in counted:
        n[r.quality, r.level] += r["count"]
    if not n.sum(1).all():
        return 2.0
    bad, good = (row[::-1].cumsum()[::-1] / row.sum() for row in n)  # shares at or above each level
    gain = np.where(good <= max_good, bad - good, -1.0)
    return float(np.flatnonzero(gain == gain.max())[-1]) / BINS


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, max_good: float = MAX_GOOD) -> DataFrame:
    """doc_id, the five counts, base_failed, score and kept of every document."""
    stats = stored(rule_statistics(docs, id_col, text_col), "rule-statistics")
    found = stored(scored(stats, fit(stats, sample)), "rule-scores")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    cut = threshold(found.filter(~failed), labels, max_good)
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") < cut))
