"""The queries ``opN_<name>``: each applies its operator to its whole table with
production parameters and derives the digest columns from what it returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, decontaminate, html, langid, minhash, pii, secrets, toxicity
from .common import read_table


def vocabulary() -> tuple[str, str]:
    """(path of the rank file, pattern)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    tricky = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), marked.alias("text"))
    return chat.read_back(chat.expand(rows.unionByName(tricky)))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    return _spans(found, pii.KINDS[:4]).withColumn("scores", F.transform("all_spans", lambda x: x["score"])).drop("all_spans")


def _spans(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in base]
    fixed = pii.joined(F.filter("spans", lambda x: x["kind"].isin(*base)))
    return found.select("doc_id", *counts, F.sha2(fixed.cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"), F.col("spans").alias("all_spans"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    texts = docs.select(F.col("doc_id").alias("id"), "text").filter(~langid.held_out(F.col("id")))
    marks = labels.select(F.col("doc_id").alias("id"), "toxic").filter(~langid.held_out(F.col("id")) & F.col("toxic").isNotNull())
    scored = toxicity.score(docs, toxicity.fit(texts, marks))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return scored.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), spans.alias("spans"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), *vocabulary())


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(read_table(spark, sf_dir, "documents"))
    return _spans(found, secrets.KINDS[:3]).drop("all_spans")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    told = langid.predict(docs, langid.fit(langid.training(docs)))
    return told.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["n_words"])), F.lit(0)).cast("long")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items.alias("items_sha256"), (F.col("n_items") >= 2).alias("contaminated"), longest.alias("longest_match"))


QUERIES = {f.__name__: f for f in (op1_chat_formatting, op2_pii, op3_html_extraction, op4_toxicity, op5_byte_bpe, op6_minhash, op7_ann, op8_secrets, op9_language, op10_decontamination)}

_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>')"

ORACLES = {
    "op1_chat_formatting": rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id,
  count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || replace({_ESCAPED.format('role')}, ':', '\:') || ': ' || {_ESCAPED.format('text')} || '</turn>' || chr(10)))::BIGINT AS formatted_chars,
  count(*) FILTER (WHERE role = 'assistant')::BIGINT AS n_examples
FROM said GROUP BY conv_id""",
    "op6_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.h = b.h AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
component AS (SELECT x AS doc_id, least(x, min(y)) AS c FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(c.c, s.doc_id) AS component_id, s.doc_id = coalesce(c.c, s.doc_id) AS kept
FROM sets s LEFT JOIN component c USING (doc_id)""",
    "op10_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS win
  FROM (SELECT item_id, w, least(8, len(w)) AS size, unnest(range(1, len(w) - least(8, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size),
found AS (
  SELECT q.doc_id, q.p, q.size, i.item_id FROM (SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS win FROM places) q
  JOIN windows i ON i.win = q.win AND i.size = q.size),
hit AS (SELECT doc_id, count(DISTINCT k)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id),
runs AS (
  SELECT doc_id, item_id, p - q AS lane, p, size, p - row_number() OVER (PARTITION BY doc_id, item_id, p - q, size ORDER BY p) AS island
  FROM (SELECT f.doc_id, f.item_id, f.p, f.size, t.q FROM found f
        JOIN d USING (doc_id)
        JOIN (SELECT item_id, size, q, array_to_string(w[q:q + size - 1], ' ') AS win FROM (SELECT item_id, w, least(8, len(w)) AS size, unnest(range(1, len(w) - least(8, len(w)) + 2)) AS q FROM b WHERE len(w) > 0)) t
          ON t.item_id = f.item_id AND t.size = f.size AND t.win = array_to_string(d.w[f.p:f.p + f.size - 1], ' '))),
longest AS (SELECT doc_id, max(n)::BIGINT AS longest_match FROM (SELECT doc_id, count(*) - 1 + size AS n FROM runs GROUP BY doc_id, item_id, lane, size, island) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
  sha256(coalesce(n.items, '')) AS items_sha256, coalesce(n.n_items, 0) >= 2 AS contaminated, coalesce(l.longest_match, 0) AS longest_match
FROM d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id) LEFT JOIN longest l USING (doc_id)""",
}
