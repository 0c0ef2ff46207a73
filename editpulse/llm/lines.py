"""Line de-duplication with a log-template tree.

A line's path in the tree has fixed depth: number of tokens, leading tokens,
then the rest. Fields with digits become ``<*>``; in lines of at least
SEGMENT_TOKENS tokens one of three segments after the leading tokens may vary as
a whole, so lines that differ inside one segment share a template with ``<*>``
there. Equal paths are equal 64-bit hashes: templates are counted by grouping.
No leaf is ever held in one task.

A template recurs when enough documents hold it that are no copies of each other.
How many depends on its constant words (tokens with a letter and no digit, outside
``<*>``): MIN_TEXTS names the least number for 3, 5 and 20 words. Templates of fewer
words never recur, so tables of numbers, lone brackets and single words stay.

Copies do not make their own lines recur. Rows with one text count once. Of the
texts in which templates held by enough texts exceed SUSPECT_SHARE of the tokens,
64 min-hashes of five-word shingles are taken; such texts are one class where
they share two neighbouring min-hashes and agree in SAME or more of the 64 (a
similarity of about 0.7), and a class counts once. All other texts count alone.
Lines of recurring templates are then dropped from every document, whatever their
share: a text of such lines only keeps its blank lines and may become empty, and
its row stays.

Null texts stay null, empty texts empty; repeated rows are changed alike; no line
order or tie matters. An empty table has no templates. Texts of any length are read
whole. Other columns pass through; ``n_chars`` follows the text where it is given.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.llm.components import components
from editpulse.llm.near import shingles
from editpulse.session import remove_stored, stored

#: (constant words, texts that must hold a template of so many words), longest first.
MIN_TEXTS = ((20, 3), (5, 10), (3, 40))
SUSPECT_SHARE, LEADING, SEGMENT_TOKENS = 0.5, 2, 6
#: Min-hashes of a sketch, pairs of them that make a bucket, equal ones of a copy.
SKETCH, BUCKETS, SAME = 64, 16, 45
#: Recurring templates (8 bytes each) that may be broadcast; beyond, a join.
BROADCAST_TEMPLATES = 4_000_000
_DIGIT = re.compile(rb"\d")
_NO_LETTER = bytes(i for i in range(128) if not chr(i).isalpha() and not bytes([i]).isspace())
_RNG = np.random.default_rng(11)
_XOR, _ODD = (_RNG.integers(0, 1 << 63, SKETCH).astype(np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def _constant_words(part: bytes) -> int:
    return len(part.translate(None, _NO_LETTER).split())


def line_templates(line: bytes, count=_constant_words) -> tuple[int, list[tuple[int, int]]]:
    """(tokens, (hash, constant words) of the line's templates); none for a blank line.
    ``count`` may leave the words out where only hashes are looked up."""
    tokens = line.split()
    n = len(tokens)
    if not n:
        return 0, []
    if _DIGIT.search(line):
        tokens = [b"<*>" if _DIGIT.search(t) else t for t in tokens]
    join, h = b" ".join, xxhash.xxh64_intdigest
    whole = join(tokens)
    words = count(whole)
    out = [(h(whole, n), words)]
    if n >= SEGMENT_TOKENS:
        third = (n - LEADING) // 3
        a, b = LEADING + third, LEADING + 2 * third
        head, first, mid, tail = join(tokens[:LEADING]), join(tokens[LEADING:a]), join(tokens[a:b]), join(tokens[b:])
        out += [(h(join((head, b"<*>", mid, tail)), n + (1 << 32)), words - count(first)),
                (h(join((head, first, b"<*>", tail)), n + (2 << 32)), words - count(mid)),
                (h(join((head, first, mid, b"<*>")), n + (3 << 32)), words - count(tail))]
    return n, out


def _uncounted(part: bytes) -> int:
    return 0


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _text_key(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw)


def _templates(docs: DataFrame, text_col: str, min_texts) -> DataFrame:
    """(key, template, needed): every template of every text that may recur."""
    least = min(words for words, _ in min_texts)

    def listed(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = X.column_bytes(batch.column(0))
        raw = data.tobytes()
        keys, hashes, words = [], [], []
        for text in {raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())}:
            found = {t for line in set(text.split(b"\n")) for t in line_templates(line)[1] if t[1] >= least}
            keys += [_text_key(text)] * len(found)
            for h, w in found:
                hashes.append(h)
                words.append(w)
        w = np.array(words, np.int64)
        needed = np.select([w >= at for at, _ in min_texts], [n for _, n in min_texts], 0).astype(np.int32)
        return pa.RecordBatch.from_arrays([_signed(keys), _signed(hashes), pa.array(needed)], names=["key", "template", "needed"])
    return X.map_batches(docs.select(F.col(f"`{text_col}`").cast("string").alias("t")), listed, "key bigint, template bigint, needed int")


def _with_known(docs: DataFrame, text_col: str, templates: DataFrame, run, schema: str, min_texts, limit: int) -> DataFrame:
    """``run(batch, texts, recurs)`` over ``docs``, where ``recurs(i, lines)`` tells which lines of
    text i hold one of ``templates``: these are broadcast up to ``limit``, and joined beyond."""
    at = docs.columns.index(text_col)
    if templates.count() <= limit:
        known = np.asarray(templates.select("template").toArrow().column(0).to_numpy(), np.int64).view(np.uint64)
        held = docs.sparkSession.sparkContext.broadcast(X.HashSet(known))

        def narrow(batch: pa.RecordBatch) -> pa.RecordBatch:
            def recurs(i, lines):
                flat = np.array([h for _, found in lines for h, _ in found], np.uint64)
                line = np.repeat(np.arange(len(lines)), [len(found) for _, found in lines])
                drop = np.zeros(len(lines), bool)
                drop[line[held.value.find(flat)]] = True
                return drop.tolist()
            return run(batch, batch.column(at).to_pylist(), recurs)
        return X.map_batches(docs, narrow, schema)

    # Too many templates for every task: those of each text are found by a join
    # on the template, and brought to the text by its key.
    pairs = _templates(docs, text_col, min_texts).join(templates.select("template"), "template")
    key, of_text = X.fresh(docs, "key"), X.fresh(docs, "templates")
    per_text = pairs.groupBy(F.col("key").alias(key)).agg(F.collect_set("template").alias(of_text))

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [_text_key((t or "").encode()) for t in batch.column(at).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, _signed(keys)], names=[*batch.schema.names, key])

    def joined(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [{x % (1 << 64) for x in found or ()} for found in batch.column(batch.num_columns - 1).to_pylist()]
        rest = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
        return run(rest, batch.column(at).to_pylist(), lambda i, lines: [any(h in sets[i] for h, _ in found) for _, found in lines])
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    with_key = X.map_batches(docs, keyed, f"{own}, `{key}` bigint").join(per_text, key, "left")
    return X.map_batches(with_key.select(*[f"`{c}`" for c in docs.columns], of_text), joined, schema)


def _sketch(text: str) -> np.ndarray:
    """Lower halves of 64 min-hashes of the text's shingles."""
    h = next(iter(shingles(pa.array([text]))))
    least = np.array([((h ^ x) * m).min() for x, m in zip(_XOR, _ODD)], np.uint64)
    return (least ^ (least >> np.uint64(32))).astype(np.uint32)


def _evidence(docs: DataFrame, text_col: str, templates: DataFrame, min_texts, share: float, limit: int) -> DataFrame:
    """(key, templates, sketch) of every different text that holds one of
    ``templates``; the sketch is null where they make up ``share`` or less of it."""
    known = {"template": pa.list_(pa.int64()), "sketch": pa.list_(pa.int32())}

    def run(batch, texts, recurs):
        rows = []
        for i, text in enumerate(texts):
            if not text:
                continue
            raw = text.encode()
            lines = [line_templates(line, _uncounted) for line in raw.split(b"\n")]
            hit = recurs(i, lines)
            if any(hit):
                found = {h for (_, f), x in zip(lines, hit) if x for h, _ in f}
                suspect = sum(n for (n, _), x in zip(lines, hit) if x) > share * sum(n for n, _ in lines)
                rows.append((_text_key(raw), np.array(list(found), np.uint64).view(np.int64), _sketch(text).view(np.int32) if suspect else None))
        keys, found, sketches = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([_signed(keys), pa.array(found, known["template"]), pa.array(sketches, known["sketch"])], names=["key", "templates", "sketch"])
    one = docs.select(F.col(f"`{text_col}`").cast("string").alias("t"))
    seen = _with_known(one, "t", templates, run, "key bigint, templates array<bigint>, sketch array<int>", min_texts, limit)
    return seen.dropDuplicates(["key"])


def _classes(suspects: DataFrame) -> DataFrame:
    """(node, root) of texts whose sketches agree: each text is compared with the
    least key of every bucket it is in, so a class of k costs BUCKETS k comparisons."""
    pair = [F.xxhash64(F.lit(i), F.col("sketch")[2 * i], F.col("sketch")[2 * i + 1]) for i in range(BUCKETS)]
    buckets = suspects.select("key", F.explode(F.array(*pair)).alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("key").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    pairs = buckets.join(hubs, "bucket").filter("key <> hub").select("key", "hub").distinct()
    both = pairs.join(suspects, "key").join(suspects.select(F.col("key").alias("hub"), F.col("sketch").alias("other")), "hub")
    equal = F.aggregate(F.zip_with("sketch", "other", lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x)
    return components(both.filter(equal >= SAME).select(F.col("key").alias("a"), F.col("hub").alias("b")), "line-classes")


def recurring_templates(docs: DataFrame, text_col: str = "text", min_texts=MIN_TEXTS, suspect_share: float = SUSPECT_SHARE,
                        broadcast_templates: int = BROADCAST_TEMPLATES) -> DataFrame:
    """(template, texts): hashes of the templates that enough texts hold, copies counted once."""
    min_texts = tuple(sorted(min_texts, reverse=True))
    counts = _templates(docs, text_col, min_texts).groupBy("template").agg(F.countDistinct("key").alias("texts"), F.max("needed").alias("needed"))
    candidates = stored(counts.filter("texts >= needed"), "line-templates")
    evidence = stored(_evidence(docs, text_col, candidates, min_texts, suspect_share, broadcast_templates), "line-evidence")
    roots = _classes(evidence.filter("sketch IS NOT NULL").select("key", "sketch"))
    held = evidence.join(roots, F.col("key") == F.col("node"), "left").select(F.coalesce("root", "key").alias("key"), F.explode("templates").alias("template"))
    texts = held.groupBy("template").agg(F.countDistinct("key").alias("texts"))
    found = stored(texts.join(candidates.select("template", "needed"), "template").filter("texts >= needed").select("template", "texts"), "line-recurring")
    remove_stored(candidates, evidence)
    return found


def drop_recurring(docs: DataFrame, text_col: str = "text", min_texts=MIN_TEXTS, suspect_share: float = SUSPECT_SHARE,
                   broadcast_templates: int = BROADCAST_TEMPLATES) -> DataFrame:
    """``docs`` with the lines of recurring templates dropped from the texts."""
    min_texts = tuple(sorted(min_texts, reverse=True))
    recurring = recurring_templates(docs, text_col, min_texts, suspect_share, broadcast_templates)
    names = docs.columns
    at, chars = names.index(text_col), names.index("n_chars") if "n_chars" in names else None

    def run(batch, texts, recurs):
        done = []
        for i, text in enumerate(texts):
            if text:
                raw = text.encode().split(b"\n")
                drop = recurs(i, [line_templates(line, _uncounted) for line in raw])
                if any(drop):
                    text = b"\n".join([line for line, x in zip(raw, drop) if not x]).decode()
            done.append(text)
        columns = list(batch.columns)
        columns[at] = pa.array(done, pa.string())
        if chars is not None:
            kept = columns[chars].to_pylist()
            columns[chars] = pa.array([n if a == b else len(b) for n, a, b in zip(kept, texts, done)], columns[chars].type)
        return pa.RecordBatch.from_arrays(columns, names=names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return _with_known(docs, text_col, recurring, run, schema, min_texts, broadcast_templates)
