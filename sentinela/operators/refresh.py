"""Tables kept up to date by the keys that change.

Rows are dealt into ``buckets`` folders by a hash of their key.  An append touches
some buckets; only those are read and written again, the others are neither listed
into the scan nor opened.  Every append has a number and overwrites its own folders,
so one that is repeated changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import profile as P
from .partitions import pin


def bucket_of(key: str, buckets: int) -> Column:
    """A row's bucket (NULL keys have one too)."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def touched_buckets(df: DataFrame) -> list[int]:
    """Buckets in ``df``: at most as many numbers as there are buckets."""
    return sorted(r.bucket for r in df.select("bucket").distinct().collect())


def _overwrite(df: DataFrame, path: str, *folders: str) -> None:
    """Replace the folders that ``df`` has rows for and leave the others as they are.
    A bucket's rows are written by one task each (they were shuffled by it)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path))


def append_rows(df: DataFrame, path: str, key: str, buckets: int, batch: int) -> list[int]:
    """Append ``df`` to the bucketed rows at ``path`` as append number ``batch`` and
    return the buckets it touched.  The same number again replaces the same rows."""
    rows = df.withColumn("bucket", bucket_of(key, buckets)).withColumn("batch", F.lit(batch))
    # dealt by bucket and a hash of the row: few files a bucket, and a hot key over several tasks
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(4))
    _overwrite(rows.repartition(parts, "bucket", spread), path, "bucket", "batch")
    written = df.sparkSession.read.parquet(path).filter(F.col("batch") == batch)
    return touched_buckets(written)


def bucket_rows(spark, path: str, buckets: list[int]) -> DataFrame:
    """The rows of some buckets; the filter is on the folder, so others are not read."""
    return spark.read.parquet(path).filter(F.col("bucket").isin(*buckets))


def refresh_profiles(new_rows: DataFrame, rows_path: str, profile_path: str, batch: int, buckets: int = 64,
                     key: str = "record_id", label: str = "bacteria", value: str = "otu") -> list[int]:
    """Append ``new_rows`` (``key, label, value``) and bring the profiles at
    ``profile_path`` (``key, all_bacteria, all_otu``) up to date; returns the buckets
    that were made anew.  Equal to a rebuild over all rows: counts of one label from
    several appends add up, rows without a label are left out."""
    spark = new_rows.sparkSession
    touched = append_rows(new_rows.select(key, label, value), rows_path, key, buckets, batch)
    if touched:
        rows = bucket_rows(spark, rows_path, touched)
        made = P.profile_strings(P.profile_arrays(rows, key, label, value, by_label=True), key)
        _overwrite(made.withColumn("bucket", bucket_of(key, buckets)).repartition(len(touched), "bucket"),
                   profile_path, "bucket")
    return touched


def read_profiles(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def append_new_keys(df: DataFrame, path: str, key: str, batch: int, buckets: int = 64) -> DataFrame:
    """Append the rows of ``df`` whose key the table at ``path`` lacks (T1, M2) and return
    the violations: ``key, n, reason`` with ``exists`` (the table has the key from another
    append), ``repeated`` (several rows of ``df`` share a new key; the smallest row by all
    columns is kept) and ``null`` (never appended), one row per key.

    Stored keys are read from the touched buckets only, the key column alone.  A repeated
    append number is judged against the other appends, so it writes the same rows again."""
    spark = df.sparkSession
    rows = pin(df.withColumn("bucket", bucket_of(key, buckets)))
    found = touched_buckets(rows)
    stored = _stored_keys(spark, path, key, found, batch)
    other = [F.col(f"`{c}`") for c in df.columns if c != key]
    # one row a key: partial, so a key repeated any number of times is one row a task
    once = (rows.filter(F.col(key).isNotNull()).groupBy(key, "bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*other)).alias("row")))
    known = once.join(stored, key, "left_semi")
    fresh = once.join(stored, key, "left_anti")
    violations = pin(known.select(key, "n", F.lit("exists").alias("reason"))
                     .unionByName(fresh.filter("n > 1").select(key, "n", F.lit("repeated").alias("reason")))
                     .unionByName(rows.filter(F.col(key).isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                                  .withColumn("reason", F.lit("null"))))
    out = fresh.select(*[F.col(f"`{key}`") if c == key else F.col(f"row.`{c}`").alias(c) for c in df.columns], "bucket")
    _overwrite(out.withColumn("batch", F.lit(batch)), path, "bucket", "batch")
    return violations


def _stored_keys(spark, path: str, key: str, buckets: list[int], batch: int) -> DataFrame:
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm)
    if not there:
        return spark.range(0).select(F.col("id").alias(key))
    return bucket_rows(spark, path, buckets).filter(F.col("batch") != batch).select(key)
