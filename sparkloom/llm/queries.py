"""The queries of the ten operators, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import chat, decontaminate, html, licenses, line_dedup, near_dup, neighbours, packing, token_files, toxicity
from .store import spread


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination(_read(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_read(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.html_text(_read(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_read(spark, sf_dir, "embeddings"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    one = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    return chat.chat(rows.unionByName(one), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_token_files": op4_token_files,
    "op5_license_scan": op5_license_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_html_text": op7_html_text,
    "op8_packing": op8_packing,
    "op9_neighbours": op9_neighbours,
    "op10_chat": op10_chat,
}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = {
    "op2_decontamination": rf"""
WITH item_words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win, least(len(w), 10) AS m
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM windows),
doc_words AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
places AS (
  SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS win
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc_words, lengths WHERE len(w) >= m)),
found AS (SELECT p.r, p.m, p.i, x.item FROM places p JOIN windows x ON p.win = x.win AND p.m = x.m),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h USING (r) LEFT JOIN items t USING (r)""",
    "op3_near_duplicates": rf"""
WITH RECURSIVE doc_words AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
shingles AS (
  SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS s, count(*) AS n
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0) GROUP BY ALL),
totals AS (SELECT doc_id, sum(n) AS t FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS x FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN totals p ON p.doc_id = a JOIN totals q ON q.doc_id = b WHERE x / CAST(p.t + q.t - x AS DOUBLE) >= 0.8),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(n, m) AS (SELECT doc_id, doc_id FROM doc_words UNION SELECT e.b, r.m FROM reached r JOIN edges e ON e.a = r.n)
SELECT n AS doc_id, min(m) AS group_id, min(m) = n AS kept FROM reached GROUP BY n""",
    "op10_chat": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
turns AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
         12 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g')) + 1
         + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11 AS formatted FROM said)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(learned)) AS BIGINT) AS loss_chars, sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""",
}
