"""Per-patient infection profile (A3, L1, T6), its decoding (C15, Q3), top-k
shares (L2, A6, Q4) and level bands (C16, Q5).

The profile is one aggregation per patient over already-counted (patient,
bacterium) rows, so a patient's list has one entry per bacterium, however many
reads it had.  Ordering is ``otu desc, bacteria`` in every output; NULL
bacteria are dropped first so that the two lists stay aligned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import level_band, share_rounded, split_list, split_long_list


def profile_arrays(infection: DataFrame, key: str = "record_id", label: str = "bacteria",
                   value: str = "otu", by_label: bool = False) -> DataFrame:
    """``key, labels ARRAY<STRING>, values ARRAY<BIGINT>`` ordered by value desc,
    then label.  ``by_label=True`` sums rows of one label first (a bacterium
    with two accessions appears once)."""
    rows = infection.filter(F.col(label).isNotNull())
    if by_label:
        rows = rows.groupBy(key, label).agg(F.sum(value).alias(value))
    entry = F.struct((-F.col(value)).alias("k"), F.col(label).alias("l"),
                     F.col(value).cast("bigint").alias("v"))
    ordered = rows.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_p"))
    return ordered.select(key, F.transform("_p", lambda x: x["l"]).alias("labels"),
                          F.transform("_p", lambda x: x["v"]).alias("values"))


def profile_strings(arrays: DataFrame, key: str = "record_id") -> DataFrame:
    """``agg_infection``: ``key, all_bacteria, all_otu`` as comma strings (A3)."""
    return arrays.select(key, F.array_join("labels", ",").alias("all_bacteria"),
                         F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
                         .alias("all_otu"))


def explode_profile(strings: DataFrame, key: str = "record_id") -> DataFrame:
    """Comma strings back to rows ``key, pos (0-based INT), bacteria, otu``."""
    zipped = F.arrays_zip(split_list("all_bacteria").alias("b"),
                          split_long_list("all_otu").alias("o"))
    exploded = strings.select(key, F.posexplode(zipped).alias("pos", "z"))
    return exploded.select(key, "pos", F.col("z.b").alias("bacteria"), F.col("z.o").alias("otu"))


def top_share(arrays: DataFrame, k: int = 10, key: str = "record_id") -> DataFrame:
    """First ``k`` entries of each profile with their percent share of the
    shown slice, rounded to 4 places (L2, A6).  Works on the per-patient row:
    no window, no extra shuffle."""
    top = arrays.select(key, F.slice("labels", 1, k).alias("l"), F.slice("values", 1, k).alias("v"))
    # the slice total is computed before the explode: an expression listed
    # next to a generator would be evaluated once per generated row
    total = F.aggregate("v", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    staged = (top.select(key, "l", "v", total.alias("_t"))
              .select(key, "_t", F.posexplode(F.arrays_zip("l", "v")).alias("pos", "z")))
    return staged.select(key, "pos", F.col("z.l").alias("bacteria"), F.col("z.v").alias("otu"),
                         share_rounded(F.col("z.v"), F.col("_t")).alias("share"))


def level_bands(df: DataFrame, value: str, n_bands: int = 9) -> DataFrame:
    """Rows per level band ``floor(value)`` clamped to ``0..n_bands-1`` (C16);
    rows without a number are in no band."""
    band, label = level_band(F.col(value), n_bands)
    return (df.select(band.alias("band"), label.alias("label")).filter("band IS NOT NULL")
            .groupBy("band", "label").agg(F.count(F.lit(1)).alias("n")))
