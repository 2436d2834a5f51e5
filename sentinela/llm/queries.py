"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator to its whole table and derives the contract's
columns.  Operators without an entry in ``ORACLE_SQL`` compute what SQL cannot
express; ``tests/llm`` holds them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_repair, decontaminate, hard_negatives, html_extract, license_scan, line_dedup
from . import onebit_search, quality_classifier, quality_rules, ring_shard, simhash, token_pack


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _fold(id_col: str = "doc_id"):
    """crc32 of the id's text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels, usable=_fold() != 1)
    return quality_classifier.score(docs, model).select(
        "doc_id", (_fold() == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"),
                      F.char_length("main_text").cast("long").alias("n_chars"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op4_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_pack.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"))


def op5_ring_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ring_shard.shard_rows(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[F.col(f"__quality.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_common_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__lines.n_lines").alias("n_lines"), F.col("__lines.n_dropped").alias("n_dropped"),
                      F.sha2(F.col("__lines.kept").cast("binary"), 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("runs", F.lit(0), lambda n, r: n + r["finish"] - r["begin"]).cast("long")
    return found.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, _tokenizer("word_bpe_49k.json")).drop("text")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                       F.col("component").alias("component_id"))


def op11_onebit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit_search.search(_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), label=label)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_html_extract, op3_license_scan, op4_token_pack, op5_ring_shard, op6_quality_rules,
    op7_line_dedup, op8_decontamination, op9_bpe, op10_simhash, op11_onebit_search, op12_hard_negatives,
    op13_conversation_repair, pipeline)}

_STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_FORMS)

ORACLE_SQL = {
    "op6_quality_rules": rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents),
grams AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len([x FOR x IN ws IF x IN ({_STOP})]) AS n_stop, length(t) - length(replace(t, '!', '')) AS n_bang,
         length(regexp_replace(t, '[^A-Za-z\x{{C0}}-\x{{24F}}\x{{400}}-\x{{4FF}}]', '', 'g')) AS n_listed
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND 10 * word_chars >= 25 * n_words AND word_chars <= 12 * n_words
       AND 100 * n_symbols <= 10 * n_words AND (100 * n_stop >= 4 * n_words OR 2 * n_listed < word_chars) AND 100 * n_bang <= 20 * n_words
       AND 100 * n_dup_lines <= 50 * n_lines AS kept
FROM b""",
    "op7_line_dedup": r"""
WITH l AS (
  SELECT doc_id, i, ls[i] AS line,
         translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
f AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.key = f.key GROUP BY doc_id""",
    "op8_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0))),
spots AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n)),
hits AS (SELECT doc_id, item_id, s.n, i FROM spots s JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op12_hard_negatives": """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, list_inner_product(a.v, o.v)::BIGINT AS score
  FROM e a JOIN e o ON a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score,
       s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3""",
}
