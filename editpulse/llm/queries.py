"""Registered queries of the operators, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from editpulse.llm import alignment, anomaly, bpe, chat, decontamination, exact_dedup, langid, licenses, lines, quality, repair, secret_scan, simhash
from editpulse.llm.text import table

VOCABULARY, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def documents(spark, d):
    return table(spark, d, "documents")


def op1_decontamination(spark, d):
    return decontamination.report(documents(spark, d), table(spark, d, "benchmark"))


def op2_chat(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    rows = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return chat.digests(turns.unionByName(rows))


def op3_language(spark, d):
    docs = documents(spark, d)
    out = langid.held_out(F.col("doc_id"), 4, 2)
    net = langid.train(docs.filter(~out))
    return langid.predict(docs.select("doc_id", "text"), net, keep=["doc_id"]).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op4_exact_dedup(spark, d):
    return exact_dedup.deduplicate(documents(spark, d))


def op5_line_dedup(spark, d):
    done = lines.drop_recurring(documents(spark, d))
    return done.select("doc_id", "text", "lang", "source", "n_chars")


def op6_bpe(spark, d):
    return bpe.encode(documents(spark, d), vocabulary_path(), with_ids=False)


def op7_licenses(spark, d):
    return licenses.scan(documents(spark, d))


def op8_simhash(spark, d):
    return simhash.classes(documents(spark, d))


def op9_quality(spark, d):
    docs = documents(spark, d)
    out = langid.held_out(F.col("doc_id"), 5, 0)
    model = quality.train(docs, table(spark, d, "labels").filter(~out))
    return quality.score(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


def op10_secrets(spark, d):
    return secret_scan.scan(documents(spark, d))


def op11_alignment(spark, d):
    return alignment.align(documents(spark, d), vocabulary_path(), vocabulary_path(PIECES))


def op12_rules(spark, d):
    return anomaly.judge(documents(spark, d), table(spark, d, "labels"))


def op13_repair(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(repair.damage(turns), known=turns)


def pipeline(spark, d):
    import corpus_pipeline
    return corpus_pipeline.run(spark, d)


LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = f"regexp_extract_all({LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP1 = f"""WITH b AS (
  SELECT coalesce(cast(item_id AS varchar), 'null') AS item, {WORDS} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents
), pos AS (
  SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)
), hits AS (SELECT rid, i, k, item FROM pos JOIN win USING (k, s)),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hits) GROUP BY rid),
m AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid)"""

_TEXT = "coalesce(text, '')"
_EXTRA = " + ".join(f"(length({_TEXT}) - length(replace({_TEXT}, '{c}', ''))) // {len(c)}" for c in ("\\", *chat.CONTROL))
OP2 = f"""WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || {_TEXT} || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(coalesce(sum(length({_TEXT})) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg({_TEXT}, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(length(role) + length({_TEXT}) + {len(chat.START) + len(chat.END) + 2} + {_EXTRA}) AS bigint) AS formatted_chars
FROM t GROUP BY conv_id"""

OP4 = f"""WITH d AS (SELECT doc_id, {LOW} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body)"""

QUERIES = {
    "op1_decontamination": (op1_decontamination, OP1),
    "op2_chat": (op2_chat, OP2),
    "op3_language": (op3_language, None),
    "op4_exact_dedup": (op4_exact_dedup, OP4),
    "op5_line_dedup": (op5_line_dedup, None),
    "op6_bpe": (op6_bpe, None),
    "op7_licenses": (op7_licenses, None),
    "op8_simhash": (op8_simhash, None),
    "op9_quality": (op9_quality, None),
    "op10_secrets": (op10_secrets, None),
    "op11_alignment": (op11_alignment, None),
    "op12_rules": (op12_rules, None),
    "op13_repair": (op13_repair, None),
    "pipeline": (pipeline, None),
}
