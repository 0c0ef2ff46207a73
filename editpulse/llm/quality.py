"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; the unlabelled side is web text,
labelled or not, whose labels are not looked at. With the class prior p the
non-negative risk  p R+(1) + max(0, Ru(0) - p R+(0))  is minimised (logistic loss,
Adam, numpy) over a small network on features of the whole text: byte shares,
repetition, word and line shapes. The logistic loss makes the output an estimate
of P(good | text).

The prior is estimated from trusted positives and unlabelled texts alone: a network of
the same form learns to tell the two kinds apart on half of each; on the other half
the share of unlabelled texts above a cut, over that of positives above it, bounds
the prior, and the cut is taken where this ratio with its sampling error is least (best
bin estimation). The share enters CAUTION standard errors low, as the ratio is an upper
bound, and a prior above the true one calls bad texts good at once while one below it
changes little. Both halves are used in turn. With fewer than MIN_POSITIVES
positives the prior is ``prior``. Fitting uses at most ``positives`` and ``unlabelled`` rows,
taken by least hash of the text (a bounded, documented sample); every row is scored.

A null text is empty; it is scored like any other. Null labels, and labels of ids
without a document, are ignored; an id labelled twice counts by its least label;
without positives every score is the prior. An empty table has no rows; texts of any
length are read whole, and further columns do not matter. Equal texts get equal scores. Only
the text is an input of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X

POSITIVES, UNLABELLED, PRIOR, THRESHOLD = 3000, 6000, 0.8, 0.3
HIDDEN, MIN_POSITIVES, CAUTION = 24, 50, 3
N_FEATURES = 128 + 16

_TOKEN = np.array([i not in (9, 10, 11, 12, 13, 32) for i in range(256)])
_UPPER = np.array([65 <= i <= 90 for i in range(256)])
_LETTER = np.array([65 <= i <= 90 or 97 <= i <= 122 or i >= 128 for i in range(256)])


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text, from all its bytes."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    share = np.bincount(owner * 128 + np.minimum(data, 127), minlength=n * 128).reshape(n, 128) / np.maximum(size, 1)[:, None]
    starts, ends, first = X.words(data, offsets, _TOKEN)
    tokens = np.diff(first)
    of = np.repeat(np.arange(n), tokens)
    per = lambda x: np.bincount(of, x, minlength=n) / np.maximum(tokens, 1)
    length = ends - starts
    if len(starts):
        h = X.word_hashes(data, starts, ends)
        last = data[ends - 1]
        order = np.lexsort((h, of))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
        distinct = np.bincount(of[order][new], minlength=n) / np.maximum(tokens, 1)
        run = np.flatnonzero(new)
        most = np.zeros(n)
        np.maximum.at(most, of[order][new], np.diff(np.append(run, len(h))))
        same = np.zeros(len(h))
        same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        uppers = np.concatenate([[0], np.cumsum(_UPPER[data])])
        letter_share = (letters[ends] - letters[starts]) / length
        shout = (uppers[ends] - uppers[starts]) == length
        odd_end = ~_LETTER[last] & ~np.isin(last, np.frombuffer(b".,;:!?\"')", np.uint8))
    else:
        distinct = most = np.zeros(n)
        same = letter_share = shout = odd_end = np.zeros(0)
    lines = share[:, 10] * size + 1
    known = np.arange(32, 127)
    upper, lower = share[:, 65:91].sum(1), share[:, 97:123].sum(1) + share[:, 127]
    extra = [np.log1p(size), np.log1p(tokens), np.log1p(lines), per(length), per(length**2) ** 0.5, distinct, most / np.maximum(tokens, 1), per(same),
             per(letter_share), per(shout), per(odd_end), upper, upper / np.maximum(upper + lower, 1e-9), 1 - share[:, known].sum(1),
             distinct * np.log1p(tokens), share[:, 48:58].sum(1)]
    return np.concatenate([share ** 0.5, np.stack(extra, 1)], 1)


class Model:
    """Standardisation and a network with one hidden layer."""

    def __init__(self, prior: float):
        self.prior, self.p = prior, None

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 0.005, seed: int = 5,
            contrast: bool = False) -> None:
        """Minimise the non-negative risk, or, with ``contrast``, tell the two samples apart."""
        rng = np.random.default_rng(seed)
        both = np.concatenate([positive, unlabelled])
        self.mean, self.scale = both.mean(0), np.maximum(both.std(0), 1e-3)
        x, u = self._standard(positive), self._standard(unlabelled)
        self.p = {"A": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), "a": np.zeros(HIDDEN), "B": rng.normal(0, HIDDEN**-0.5, HIDDEN), "b": np.zeros(1)}
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        steps, t = max(1, len(u) // batch), 0
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(u)), steps):
                t += 1
                xp, xu = x[rng.integers(0, len(x), len(at))], u[at]
                gp, gn = self._grad(xp, 1), self._grad(xp, 0)
                gu = self._grad(xu, 0)
                rest = gu[0] - self.prior * gn[0]
                for k, (m, v) in moment.items():
                    if contrast:
                        g = gp[1][k] + gu[1][k]
                    else:
                        # Negative part below zero means over-fitting: step back.
                        g = self.prior * gp[1][k] + gu[1][k] - self.prior * gn[1][k] if rest >= 0 else self.prior * gn[1][k] - gu[1][k]
                    g = g + (1e-3 * self.p[k] if k in "AB" else 0)
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.p[k] -= rate * (1 - epoch / epochs) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def _standard(self, x):
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def _grad(self, x, target):
        """(mean logistic loss of calling ``x`` ``target``, its gradients)."""
        hidden = np.tanh(x @ self.p["A"] + self.p["a"])
        z = hidden @ self.p["B"] + self.p["b"]
        sign = 2 * target - 1
        loss = np.logaddexp(0, -sign * z).mean()
        d = -sign / (1 + np.exp(np.clip(sign * z, -500, 500))) / len(x)
        back = d[:, None] * self.p["B"] * (1 - hidden**2)
        return loss, {"A": x.T @ back, "a": back.sum(0), "B": hidden.T @ d, "b": np.array([d.sum()])}

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.p is None:
            return np.full(len(x), self.prior)
        z = np.tanh(self._standard(x) @ self.p["A"] + self.p["a"]) @ self.p["B"] + self.p["b"]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 7, confidence: float = 0.1, slack: float = 0.01,
                   caution: float = CAUTION) -> float:
    """Share of the positive kind among ``unlabelled`` rows, see above."""
    rng = np.random.default_rng(seed)
    halves = [np.array_split(rows[rng.permutation(len(rows))], 2) for rows in (positive, unlabelled)]
    found = []
    for fitted, rest in ((0, 1), (1, 0)):
        model = Model(0.5)
        model.fit(halves[0][fitted], halves[1][fitted], contrast=True)
        above, among = (np.sort(model.score(side[rest])) for side in halves)
        cuts = np.unique(above)
        share = [1 - np.searchsorted(scores, cuts) / len(scores) for scores in (above, among)]
        error = sum((np.log(4 / confidence) / (2 * len(scores))) ** 0.5 for scores in (above, among))
        best = np.argmin((share[1] + (1 + slack) * error) / share[0])
        under = caution * (share[1][best] * (1 - share[1][best]) / len(among)) ** 0.5
        found.append((share[1][best] - under) / share[0][best])
    return float(np.clip(np.mean(found), 0.01, 0.99))


def _feature_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = X.column_bytes(batch.column(0))
    rows = [features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in X.chunks(offsets)]
    flat = np.concatenate(rows).astype(np.float32)
    return pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), N_FEATURES).cast(pa.list_(pa.float32()))], names=["x"])


def _sample(texts: DataFrame, n: int, marks: DataFrame | None = None) -> np.ndarray:
    """Features of the ``n`` different texts of least hash (all, if there are
    fewer), of the documents in ``marks`` if given. Copies count once; only ids
    and hashes are joined and sorted, and texts move only below the cut."""
    hashed = texts.withColumn("h", F.xxhash64("text", F.lit(9)))
    among = lambda df: df if marks is None else df.join(marks.select("doc_id"), "doc_id", "left_semi")
    cut = among(hashed.select("doc_id", "h")).select("h").distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if cut is None:
        return np.zeros((0, N_FEATURES))
    chosen = among(hashed.filter(F.col("h") <= cut)).groupBy("h").agg(F.min("text").alias("text")).select("text")
    rows = X.map_batches(chosen, _feature_rows, "x array<float>").toArrow().column("x")
    found = np.array(rows.to_pylist(), np.float64).reshape(-1, N_FEATURES)
    return found[np.lexsort(found.T)]  # tasks end in any order


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float = PRIOR) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, quality. Callers leave out held-out labels."""
    good = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    x = _sample(texts, positives, good)
    if not len(x):
        return Model(prior)
    u = _sample(texts, unlabelled)
    model = Model(estimate_prior(x, u) if len(x) >= MIN_POSITIVES else prior)
    model.fit(x, u)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = X.column_bytes(batch.column(1))
        found = np.concatenate([held.value.score(features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in X.chunks(offsets)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])
    rows = X.named(docs, doc_id=id_col, text=text_col)
    return X.map_batches(rows, run, f"doc_id {rows.schema[0].dataType.simpleString()}, score double, predicted int")
