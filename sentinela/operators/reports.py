"""Dashboard lookups built over all patients at once.

The single-patient form of each is ``.filter(col(key) == value)`` on the
result; on a Parquet table that filter reaches the scan as a pushed filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS

# Display labels of the patient metadata panel, in panel order.
METADATA_LABELS = [
    ("admit_date", "Admit Date"),
    ("campus_name", "Hospital"),
    ("gender", "Gender"),
    ("age", "Age"),
    ("diagnosis_count", "Diagnosis Count"),
    ("icd_title", "ICD Title"),
    ("patient_type", "Patient Type"),
    ("icu_flag", "ICU Flag"),
]


def distinct_ids(df: DataFrame, key: str = "record_id") -> DataFrame:
    """Distinct patient ids."""
    return df.select(key).distinct()


def first_id(df: DataFrame, key: str = "record_id") -> DataFrame:
    """The smallest id, the dashboard's default (L3): a global ``min``, partial
    per task, instead of a sort."""
    return df.agg(F.min(key).alias(key))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Equality lookup on the key."""
    return df.filter(F.col(key) == F.lit(value))


def latest_per_key(df: DataFrame, key: str, order_by: list[str], columns: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (L5, "last row
    wins" made deterministic).  ``max_by`` is a plain aggregate with partial
    merge, so a key with many rows is folded before the shuffle."""
    pick = F.max_by(F.struct(*columns), F.struct(*order_by)).alias("_r")
    return df.groupBy(key).agg(pick).select(key, *[F.col(f"_r.{c}").alias(c) for c in columns])


def labelled(df: DataFrame, labels=METADATA_LABELS, key: str | None = "record_id") -> DataFrame:
    """Select and rename to display labels."""
    cols = ([F.col(key)] if key else []) + [F.col(c).alias(lbl) for c, lbl in labels if c in df.columns]
    return df.select(*cols)


def patient_report(patients: DataFrame, *facts: DataFrame, key: str = "record_id") -> DataFrame:
    """Patient rows left-joined with per-patient fact tables.

    Each fact table must already hold one row per key (pre-aggregated), so the
    joins never multiply rows; they are key-to-key joins the planner can run as
    sort-merge joins on co-partitioned inputs or broadcast when small.
    """
    out = patients
    for fact in facts:
        out = out.join(fact, key, "left")
    return out


def totals_per_key(df: DataFrame, key: str, amount: str, out: str, count_out: str | None = None) -> DataFrame:
    """Exact money sum per key: cast to DECIMAL(18,2) before summing, so the
    result does not depend on row order; returned as DOUBLE."""
    aggs = [F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias(out)]
    if count_out:
        aggs.append(F.count(F.lit(1)).alias(count_out))
    return df.groupBy(key).agg(*aggs)


__all__ = ["DEFAULT_BROADCAST_ROWS", "distinct_ids", "first_id", "lookup", "latest_per_key",
           "labelled", "patient_report", "totals_per_key", "METADATA_LABELS"]
