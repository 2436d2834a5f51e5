"""Sinks and table maintenance.

Tables are Parquet folders (or catalog tables over them) in the shared
folder; the warehouse engine of the reference is replaced by Spark's own
writers and SQL DDL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Append to a table: a catalog name, or a folder when ``target`` holds a
    ``/`` (K1, U3).  The ``target`` argument is honoured."""
    writer = df.write.mode("append").format(fmt)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def write_chunks(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "text",
                 value: str | None = None, max_records_per_file: int | None = None) -> None:
    """One folder per chunk key, e.g. (sample, mate, chunk), holding ``part-*``
    files (K3; read back with ``read_parts``).

    No shuffle by the chunk key: every task writes its own rows of each chunk,
    sorted by the key within the task so that one file is open at a time.  A
    chunk of hundreds of millions of records is thus written by many tasks,
    never funnelled through one."""
    out = df.select(*partition_cols, value) if value else df
    writer = out.sortWithinPartitions(*partition_cols).write.mode("overwrite").partitionBy(*partition_cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.format(fmt).save(path)


def write_record_chunks(records: DataFrame, path: str, size: int, sample, mate, lines: list[str],
                        number: str = "record", options: dict[str, str] | None = None) -> None:
    """Framed records as text files in folders ``sample=/mate=/chunk=`` of ``size``
    records each (K3, W2): ``records`` hold one record a row, its ``lines`` in columns and
    its 0-based ``number`` within (sample, mate).

    A record is one value of the text writer, so no record is cut between files.  Rows
    are range-partitioned by sample, mate and number, so a chunk of any size is written
    by as many tasks as it needs and its part files, in name order, hold its records in
    order.  All shuffle partitions write: folders and files cost more than their bytes, by which
    Spark would merge partitions.  Lines that a record lacks (the last of a cut-off file) are left out.
    ``options`` go to the writer."""
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.concat_ws("\n", *[F.col(c) for c in lines])
    out = records.select(sample.alias("sample"), mate.alias("mate"),
                         F.expr(f"{number} div {size} + 1").alias("chunk"), F.col(number).alias("_number"), value.alias("value"))
    order = ["sample", "mate", "_number"]
    (out.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_number")
     .write.options(**(options or {})).partitionBy("sample", "mate", "chunk").text(path))


def write_mapping_result(rows: DataFrame, path: str, options: dict[str, str] | None = None) -> None:
    """Mapping results as tab-separated files, a folder per ``sample`` (read back with
    ``sources.files.read_mapping_result``).  Rows are dealt by sample and a hash of the
    read, so a large sample is several part files and a small one is few.  ``options`` go to
    the writer."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartition(parts, "sample", F.pmod(F.xxhash64("id"), F.lit(4))).sortWithinPartitions("sample")
     .write.options(**(options or {})).partitionBy("sample").option("sep", "\t").csv(path))


def create_keyed_table(spark: SparkSession, name: str, df: DataFrame, key: str,
                       buckets: int, location: str | None = None) -> None:
    """A table bucketed and sorted by its key (T1): later joins and lookups on
    the key read co-located, sorted buckets without a shuffle.  The rows are dealt by
    bucket before the write, so a bucket is one file, not one a task."""
    writer = (df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, key).sortBy(key))
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def write_lookup_table(df: DataFrame, path: str, key: str, distinct: int, row_group_bytes: int = 16 << 20) -> None:
    """A table for lookups by ``key`` (P7): ranges of the key in sorted files, with a
    Parquet Bloom filter on it sized for ``distinct`` keys a file.  A lookup's equality
    filter skips files and row groups by their bounds and filters, so it reads about one
    row group, however large the table."""
    (df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", str(max(1, distinct)))
     .option("parquet.block.size", str(row_group_bytes)).parquet(path))


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names and types of a table."""
    return spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "data_type")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")  # T3


def create_table_as(spark: SparkSession, name: str, select_sql: str,
                    location: str | None = None) -> None:
    """CTAS, e.g. with casts (T4) or over an aggregate."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} USING parquet{loc} AS {select_sql}")


def recast(spark: SparkSession, name: str, types: dict[str, str], location: str | None = None) -> None:
    """Replace table ``name`` by one whose columns named in ``types`` have those
    types (T3 to T5): renamed aside, created anew from a typed select in the same
    column order, and the old one dropped.  A column that ``types`` names and the
    table lacks raises."""
    columns = spark.table(name).columns
    if missing := set(types) - set(columns):
        raise ValueError(f"no such columns in {name}: {sorted(missing)}")
    aside = f"{name}_untyped"
    rename_table(spark, name, aside)
    chosen = ", ".join(f"CAST(`{c}` AS {types[c]}) AS `{c}`" if c in types else f"`{c}`" for c in columns)
    create_table_as(spark, name, f"SELECT {chosen} FROM {aside}", location)
    drop_table(spark, aside)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # T5


def duplicate_keys(df: DataFrame, keys, out: str = "n") -> DataFrame:
    """Key values held by more than one row, with their count (M2); partial
    counting per task before the shuffle."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def null_keys(df: DataFrame, keys) -> DataFrame:
    """Rows whose key is NULL (M2 with ``NOT NULL``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.filter(cond)
