"""Gene abundance and annotation.

All samples go through one plan keyed by sample: filter -> count per
(sample, gene) with map-side partial aggregation -> taxonomy join ->
patient join -> row-count guard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import lineage_label
from ..sources.files import INFECTION_SEED_SCHEMA, empty_frame
from .joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from .partitions import pin
from .rows import row_index

# Fixed value: accession marker of reference genes kept by the reference.
GENE_MARKER = "NC_"


def gene_counts(hits: DataFrame, keys=("sample",), gene: str = "gene",
                marker: str | None = GENE_MARKER, out: str = "otu") -> DataFrame:
    """Count of non-null ``gene`` per ``keys`` + gene, after the substring
    filter ``marker in gene`` (P6, A1, A2).  The filter reaches the Parquet scan
    as ``StringContains``; the count is partial before the shuffle, so a hot
    sample or gene costs one row per task, not one row per hit."""
    kept = hits.filter(F.col(gene).contains(marker)) if marker else hits
    return kept.groupBy(*keys, gene).agg(F.count(gene).alias(out))


def taxonomy_labels(taxonomy: DataFrame, gene: str = "gene", lineage: str = "lineage",
                    out: str = "bacteria") -> DataFrame:
    """Taxonomy table (gene, lineage array) -> (gene, ``'_'``-joined label)."""
    return taxonomy.select(gene, lineage_label(lineage).alias(out))


def annotate(counts: DataFrame, labels: DataFrame, gene: str = "gene",
             max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Inner join counts to taxonomy labels; genes without taxonomy vanish."""
    return counts.join(broadcast_if_small(labels, max_broadcast_rows), gene, "inner")


def unknown_genes(counts: DataFrame, labels: DataFrame, gene: str = "gene") -> DataFrame:
    """Genes counted but absent from the taxonomy (J2 report, left anti join)."""
    return counts.select(gene).distinct().join(labels.select(gene), gene, "left_anti")


def attach_patient(infection: DataFrame, patients: DataFrame, index: str = "index",
                   offset: int = 0, broadcast: bool | None = None,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join to the patient table on ``index`` and drop it.

    Sample ``i`` pairs with patient ``i + offset``; ``offset=-1`` reproduces the
    reference as written (sample 0 unmatched, sample n to patient n-1).

    ``broadcast=None`` checks the size of ``patients`` itself; a caller that
    derived ``patients`` expensively can pass the answer of a check made on
    its cheap source instead (same row count)."""
    if broadcast is None:
        side = broadcast_if_small(patients, max_broadcast_rows)
    else:
        side = F.broadcast(patients) if broadcast else patients
    if offset:
        infection = infection.withColumn(index, F.col(index) + F.lit(offset))
    return infection.join(side, index, "inner").drop(index)


def infection_seed(spark) -> DataFrame:
    """Typed empty infection frame, ``index INT, bacteria STRING, otu INT``."""
    return empty_frame(spark, INFECTION_SEED_SCHEMA)


def typed_union(seed: DataFrame, *frames: DataFrame) -> DataFrame:
    """Union by column name onto a typed seed; numeric types widen (INT with
    BIGINT gives BIGINT) (U1)."""
    out = seed
    for f in frames:
        out = out.unionByName(f.select(*seed.columns))
    return out


def rows_per_key(df: DataFrame, keys, min_rows: int = 2, out: str = "n") -> DataFrame:
    """Keys with at least ``min_rows`` rows, and their count (A4); one pass for
    all keys, partial counting before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) >= min_rows)


def min_rows_guard(df: DataFrame, keys, min_rows: int = 2,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows of the keys that have at least ``min_rows`` rows (K2: a one-row
    result is not written).  The per-key counts are semi-joined back, broadcast
    when proven small, else shuffled with AQE skew splitting."""
    ok = pin(rows_per_key(df, keys, min_rows).select(*keys))
    return df.join(broadcast_if_small(ok, max_broadcast_rows), list(keys), "left_semi")


def number_samples(hits: DataFrame, sample: str = "sample") -> DataFrame:
    """0-based sample numbers in name order, the reference's listing order:
    ``sample, index``.  One row per sample, numbered by ``row_index``."""
    return row_index(hits.select(sample).distinct(), [sample], name="index", unique=True)


def positional_pairs(hits: DataFrame, patients: DataFrame, sample: str = "sample",
                     offset: int = 0) -> DataFrame:
    """``sample, record_id`` pairing sample ``i`` with patient ``i + offset``
    (``patients``: ``record_id, index``); ``offset=-1`` is the reference as written."""
    numbered = number_samples(hits, sample).withColumn("index", F.col("index") + F.lit(offset))
    return numbered.join(patients, "index", "inner").select(sample, "record_id")


def infection_from_hits(hits: DataFrame, labels: DataFrame, sample_patients: DataFrame,
                        sample: str = "sample", gene: str = "gene", min_rows: int = 2,
                        marker: str | None = GENE_MARKER,
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The annotation job for all samples in one plan: mapping hits ->
    ``infection(sample, bacteria, otu, record_id)``.

    Counts per (sample, gene) after the marker filter, annotated from
    ``labels`` (gene, bacteria); samples with fewer than ``min_rows`` annotated
    rows are left out (the reference writes only when ``count() > 1``); each
    sample gets its patient from ``sample_patients`` (sample, record_id)."""
    counts = gene_counts(hits.select(sample, gene), keys=[sample], gene=gene, marker=marker)
    rows = annotate(counts, labels, gene, max_broadcast_rows).select(sample, "bacteria", "otu")
    # counted already, a sample holds at most a row a gene here: one window instead of a second scan
    n = F.count(F.lit(1)).over(Window.partitionBy(sample))
    kept = rows.withColumn("_rows", n).filter(F.col("_rows") >= min_rows).drop("_rows") if min_rows > 1 else rows
    pairs = broadcast_if_small(sample_patients.select(sample, "record_id"), max_broadcast_rows)
    return kept.join(pairs, sample, "inner")
