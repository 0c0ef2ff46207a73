"""Language identification with a small byte convolutional network.

Bytes are embedded, filters of several widths run over fixed-length windows,
their maxima over the window go through a softmax. Trained with numpy on labelled
windows on the driver: at most ``per_language`` documents of each language and
``windows`` windows of each (a bounded, documented sample, chosen by hash);
applied to every window of every whole text, in batches. A text's score is the
mean of its windows' probabilities.

For speed the filters are applied as two tables over byte pairs, computed from
embedding and filters: the sum is the convolution exactly.

A text that is null or has no letter is ``und`` with score 0. Ties go to the
first language in sorted order. Without any labelled text everything is ``und``.
Only the text is an input of a prediction; further columns do not matter.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.session import stored

WIDTHS, FILTERS, EMBEDDING, WINDOW = (2, 3, 4), 12, 8, 256
PER_LANGUAGE, WINDOWS = 300, 4
UNKNOWN = "und"
#: Rows (language, hash) of the sample that may be broadcast; beyond, a join.
BROADCAST_SAMPLE = 100_000
#: Shares of a language that are ranked apart before the language as a whole.
SHARES = 16
_LETTER = re.compile(r"[^\W\d_]")


class ByteNet:
    """Embedding, filters of up to four bytes, max pooling and softmax."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        total = FILTERS * len(WIDTHS)
        self.p = {
            "E": rng.normal(0, 0.5, (256, EMBEDDING)),
            "W": rng.normal(0, 0.3, (4, EMBEDDING, total)),
            "b": np.zeros(total),
            "V": rng.normal(0, 0.2, (total, len(languages))),
            "c": np.zeros(len(languages)),
        }
        self.mask = np.zeros((4, 1, total))
        for i, width in enumerate(WIDTHS):
            self.mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
        self.p["W"] *= self.mask

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Filter responses of the byte pairs at offsets 0 and 2."""
        single = np.einsum("bd,kdf->kbf", self.p["E"], self.p["W"])
        both = lambda k: (single[k][:, None] + single[k + 1][None]).reshape(65536, -1).astype(np.float32)
        return both(0) + self.p["b"].astype(np.float32), both(2)

    def pooled(self, windows: np.ndarray, tables, where: bool = False):
        """Maxima over each row of ``windows`` (n, WINDOW), and their places."""
        wide = windows.astype(np.uint16)
        pair = (wide[:, :-1] << 8) | wide[:, 1:]
        r = tables[0][pair[:, :-2]]
        r += tables[1][pair[:, 2:]]
        return (r.max(1), r.argmax(1)) if where else r.max(1)

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.p["V"] + self.p["c"]
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on the cross entropy, classes weighted evenly."""
        rng = np.random.default_rng(seed)
        weight = (len(labels) / np.maximum(np.bincount(labels, minlength=len(self.languages)), 1) / len(self.languages))[labels]
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // batch)):
                step += 1
                x, y = windows[at], labels[at]
                single = np.einsum("bd,kdf->kbf", self.p["E"], self.p["W"]).astype(np.float32)
                r = sum(single[k][x[:, k : WINDOW - 3 + k]] for k in range(4)) + self.p["b"].astype(np.float32)
                place = r.argmax(1)
                top = np.take_along_axis(r, place[:, None], 1)[:, 0]
                d = self.probabilities(top)
                d[np.arange(len(y)), y] -= 1
                d *= (weight[at] / len(y))[:, None]
                g = {k: np.zeros_like(v) for k, v in self.p.items()}
                g["V"], g["c"] = np.maximum(top, 0).T @ d, d.sum(0)
                back = (d @ self.p["V"].T) * (top > 0)
                g["b"] = back.sum(0)
                for k in range(4):
                    byte = np.take_along_axis(x, place + k, 1)
                    g["W"][k] = np.einsum("nfd,nf->df", self.p["E"][byte], back)
                    np.add.at(g["E"], byte, back[..., None] * self.p["W"][k].T[None])
                g["W"] *= self.mask
                now = rate * (1 - epoch / epochs) + 1e-4
                for k, (m, v) in moment.items():
                    m += 0.1 * (g[k] - m)
                    v += 0.001 * (g[k] ** 2 - v)
                    self.p[k] -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def cut_windows(raw: bytes) -> np.ndarray:
    """The whole text as rows of WINDOW bytes; the last one ends with the text
    and a text shorter than a window is filled with blanks."""
    if len(raw) <= WINDOW:
        return np.frombuffer(raw.ljust(WINDOW), np.uint8)[None]
    data = np.frombuffer(raw, np.uint8)
    rest = len(raw) % WINDOW
    whole = data[: len(raw) - rest].reshape(-1, WINDOW)
    return np.concatenate([whole, data[None, -WINDOW:]]) if rest else whole


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, windows: int = WINDOWS) -> ByteNet:
    """Fit on a sample: the ``per_language`` texts of least hash of every
    language, and of each up to ``windows`` windows spread over it."""
    rows = labelled.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    n = F.char_length("text")
    piece = lambda i: F.substring("text", F.greatest(F.lit(1), (i * n / windows).cast("int") + 1), F.lit(WINDOW))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    # The least hashes of each share of a language hold its least hashes, so
    # one task a language ranks at most per_language * SHARES of them.
    least = lambda df, *by: (
        df.withColumn("r", F.row_number().over(Window.partitionBy("lang", *by).orderBy("h"))).filter(F.col("r") <= per_language).drop("r"))
    shares = least(hashed.select("lang", "h").distinct(), F.pmod("h", F.lit(SHARES)))
    picked = stored(least(shares), "language-sample")
    few = picked.count() <= BROADCAST_SAMPLE
    sample = hashed.join(F.broadcast(picked) if few else picked, ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", F.concat(*[
        x for i in range(windows) for x in (F.rpad(F.translate(piece(F.lit(i)), "\x00", " "), WINDOW, " "), F.lit("\x00"))]).alias("cut"))
    found = sorted((r.lang, r.cut) for r in sample.collect())
    languages = sorted({lang for lang, _ in found})
    net = ByteNet(languages)
    x, y = [], []
    for lang, cut in found:
        for text in {t for t in cut.split("\x00") if t.strip()}:
            x.append(cut_windows(text.rstrip().encode())[0])
            y.append(languages.index(lang))
    if len(languages) > 1:
        order = np.lexsort(np.array(x).T)  # the set above has no order
        net.fit(np.array(x)[order], np.array(y)[order])
    return net


def _predict(net: ByteNet, tables, texts: list[str | None]):
    """(language, score) of each text; windows of many texts run together."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    known = [i for i, t in enumerate(texts) if t and net.languages and _LETTER.search(t)]
    cuts = [cut_windows(texts[i].encode()) for i in known]
    if not known:
        return out
    every = np.concatenate(cuts)
    prob = np.concatenate([net.probabilities(net.pooled(every[a : a + 64], tables)) for a in range(0, len(every), 64)])
    edge = np.concatenate([[0], np.cumsum([len(c) for c in cuts])])
    mean = np.add.reduceat(prob, edge[:-1]) / np.diff(edge)[:, None]
    for i, m in zip(known, mean):
        out[i] = net.languages[int(m.argmax())], float(min(1.0, m.max()))
    return out


def predict(docs: DataFrame, net: ByteNet, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default), then lang_pred and score (renamed if
    ``docs`` has such columns)."""
    keep = docs.columns if keep is None else keep
    held = docs.sparkSession.sparkContext.broadcast((net, net.tables()))
    names = [f"k{i}" for i in range(len(keep))]
    at = keep.index(text_col) if text_col in keep else len(keep)  # the text travels once
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, names)], *[F.col(f"`{text_col}`").alias("t")] * (at == len(keep)))
    n = len(keep)
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema[:n]) + "lang_pred string, score double"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column, (model, tables) = batch.column(at), held.value
        _, offsets = X.column_bytes(column)
        out = []
        for lo, hi in X.chunks(offsets):
            out.extend(_predict(model, tables, column.slice(lo, hi - lo).to_pylist()))
        return pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                                          names=[*names, "lang_pred", "score"])
    done = X.map_batches(rows, run, schema)
    base = docs.select(*[f"`{c}`" for c in keep])
    return done.select(*[F.col(k).alias(c) for c, k in zip(keep, names)],
                       F.col("lang_pred").alias(X.fresh(base, "lang_pred")), F.col("score").alias(X.fresh(base, "score")))


def held_out(id_col, parts: int, part: int):
    """True where crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))
