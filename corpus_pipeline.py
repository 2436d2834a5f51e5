"""A training-text pipeline over ``documents``: five stages, each one operator of ``sentinela.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  The first four
return the columns of ``documents``; the last returns token ids.

Each stage takes nulls in any column, empty and very long texts, repeated rows and
further columns of any name (but for the last, which reads ``doc_id`` and ``text``, these
come back as they were); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentinela.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from sentinela.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.  Null and empty texts have too few words
    and go; repeated rows stay or go together."""
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more of the documents share go from all of them, and ``n_chars``
    follows.  Null texts stay null, a document may end up empty; repeated rows count
    as documents of their own, so their lines may go."""
    return line_dedup.without_common_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id
    (nulls last).  Texts without words are near duplicates of each other; of repeated
    rows one stays."""
    return simhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go.  Null and empty texts hold none;
    repeated rows stay or go together; an empty benchmark takes nothing."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256`` of every document left.  Null and
    empty texts have no ids; repeated rows give equal rows."""
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs.select("doc_id", "text"), path, with_digests=True).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("bpe encoding and decoding", token_stage),
]

#: SQL cannot express the last two stages' tokenizer and the fingerprints; tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return made
        path = scratch_path(spark, f"pipeline-{i}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
