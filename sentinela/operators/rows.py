"""Positional operators: row numbers without a single-task window (W1), skipping
leading rows (P5), fixed-size chunks (W2) and 4-line record framing (S6).

A DataFrame has no order, so every position is defined by an explicit order:
either a key (tables) or the byte offset of a line in its file (text sources).
Neither method routes all rows, or all rows of one group, through one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import SMALL_FILES, scratch_path, shared_root
from .joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from .partitions import pin


def row_index(df: DataFrame, order_by: list[str], partition_by: list[str] | tuple = (),
              name: str = "idx", n_buckets: int | None = None,
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, unique: bool = False) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_by`` order, counted
    within each ``partition_by`` group (W1; ``row_number() - 1`` semantics).

    The rows are range-partitioned by group and the whole order, sorted within
    their range and kept in the shared folder, so neither a hot group nor a hot
    value of the first order key lands in one task: the further order columns
    split it.  A row's position is its place in its range, plus the group's rows
    in earlier ranges, known from one counted row per (range, group).  Columns
    of any orderable type will do; NULLs sort first, NaN last, and NULL groups
    are groups.  Rows equal in all ``order_by`` columns take neighbouring
    positions in any order, and are split over ranges as well: every task numbers its
    rows and the number is the last range key.  ``unique`` promises that the order
    tells all rows apart and saves that step.
    """
    spark = df.sparkSession
    shared_root(spark)  # checkpoint folder must exist before checkpoint()
    part = list(partition_by)
    ranges = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in [*part, *order_by]]
    own = "_row"
    while any(c.startswith(own) for c in df.columns):   # helper columns must not clash with the caller's
        own = f"_{own}"
    numbered, by = df, keys
    if not unique:
        # sorted first, with a hash of the row after the keys: a task that runs again gives
        # its rows the same numbers (but for rows equal in all columns, which may change places)
        whole = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        numbered = df.sortWithinPartitions(*keys, F.xxhash64(*whole)).withColumn(f"{own}_tie", F.monotonically_increasing_id())
        by = [*keys, F.col(f"{own}_tie")]
    held = numbered.repartitionByRange(ranges, *by).sortWithinPartitions(*by).checkpoint(eager=True)
    at, mid, first, off = (f"{own}_{c}" for c in ("range", "mid", "first", "off"))
    placed = held.withColumn(at, F.spark_partition_id()).withColumn(mid, F.monotonically_increasing_id())
    cells = placed.groupBy(at, *[F.col(f"`{c}`") for c in part]).agg(F.min(mid).alias(first), F.count(F.lit(1)).alias(off))
    # without groups: one window over one row per range
    before = Window.partitionBy(*[F.col(f"`{c}`") for c in part]).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pin(cells.select(F.col(at).alias(f"{own}_cell"),
                               *[F.col(f"`{c}`").alias(f"{own}_cell_{i}") for i, c in enumerate(part)], first,
                               F.coalesce(F.sum(off).over(before), F.lit(0)).cast("bigint").alias(off)))
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"{own}_cell_{i}")) for i, c in enumerate(part)],
                  F.col(at) == F.col(f"{own}_cell"))
    joined = placed.join(broadcast_if_small(offsets, max_broadcast_rows), same, "inner")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         (F.col(off) + F.col(mid) - F.col(first)).cast("bigint").alias(name))


def line_index(lines: DataFrame, name: str = "idx", per_file: bool = True,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """0-based line number within its file for a text scan (W1 over files).

    ``lines`` must carry ``file`` and ``block`` (from ``_metadata.file_path`` and
    ``_metadata.file_block_start``) and be a direct, filtered-or-not projection of
    a file scan.  Inside one split, lines are contiguous and
    ``monotonically_increasing_id`` counts up by one, so the position is that id
    minus the split's first id plus the line count of the file's earlier splits.

    The files are read once: every line is kept in the shared folder together with
    its split and id, and both the counts per split and the result come from there.
    However the files are split later (other settings or parallelism), the numbers
    stay those of the one pass.  Only the per-split table (one row per split) is joined.
    ``per_file=False`` numbers all lines of all
    files in (file path, offset) order, like ``zipWithIndex`` over a sorted
    listing; the running count then spans the small per-split table only.
    """
    spark = lines.sparkSession
    path = scratch_path(spark, "lines")
    with_id = lines.withColumn("_mid", F.monotonically_increasing_id())
    with_id.write.options(**SMALL_FILES).parquet(path)
    held = spark.read.schema(with_id.schema).parquet(path)
    per_split = held.groupBy("file", "block").agg(F.min("_mid").alias("_first"),
                                                  F.count(F.lit(1)).alias("_n"))
    earlier = (Window.partitionBy("file").orderBy("block") if per_file
               else Window.orderBy("file", "block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pin(per_split.select("file", "block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off")))
    joined = held.join(broadcast_if_small(offsets, max_broadcast_rows), ["file", "block"])
    return (joined.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint"))
            .drop("_mid", "_first", "_off"))


def first_rows(df: DataFrame, k: int, partition_by: list[str], order_by: list[str]) -> DataFrame:
    """The first ``k`` rows of each group by ``order_by`` (``row_number() <= k``).

    Planned as a partial ``WindowGroupLimit`` before the shuffle, so at most ``k``
    rows per group and input partition cross the network, however hot the group.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def skip_leading(df: DataFrame, k: int, partition_by: list[str], order_by: list[str],
                 row_key: list[str] | None = None,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Drop the first ``k`` rows of each group (P5 for keyed tables).

    The dropped rows are found with ``first_rows`` (k per group) and removed by a
    NULL-safe anti join on the group and ``row_key`` (``order_by`` unless given,
    which with the group must tell rows apart), so no group is ever sorted whole.
    """
    key = list(dict.fromkeys([*partition_by, *(row_key or order_by)]))
    cols = list(dict.fromkeys([*key, *order_by]))
    head = pin(first_rows(df.select(*cols), k, partition_by, order_by)
               .select(*[F.col(c).alias(f"_skip_{c}") for c in key]))
    same = reduce(and_, [df[c].eqNullSafe(F.col(f"_skip_{c}")) for c in key])
    return df.join(broadcast_if_small(head, max_broadcast_rows), same, "left_anti")


def skip_leading_lines(lines: DataFrame, k: int, idx: str = "idx") -> DataFrame:
    """Drop the first ``k`` lines of every file (P5 for text sources, after ``line_index``)."""
    return lines.filter(F.col(idx) >= k)


def chunk_numbers(df: DataFrame, size: int, partition_by: list[str], order_by: list[str],
                  name: str = "chunk", **kw) -> DataFrame:
    """1-based chunk number of ``size`` consecutive rows per group; the last chunk
    may be shorter (W2)."""
    indexed = row_index(df, order_by, partition_by, name="_ci", **kw)
    return indexed.withColumn(name, (F.floor(F.col("_ci") / size) + 1).cast("bigint")).drop("_ci")


def _role_is(i: int):
    return lambda e: e["r"] == i


def frame_records(lines: DataFrame, width: int = 4, idx: str = "idx",
                  group: list[str] | tuple = ("file",), value: str = "value",
                  names: list[str] | None = None) -> DataFrame:
    """Fold ``width`` consecutive lines into one record (S6, FASTQ framing).

    Line ``i`` of a file belongs to record ``i div width`` in role ``i % width``;
    records that straddle a split meet in the aggregation shuffle, and partial
    aggregation folds the others before it.
    """
    names = names or [f"line{i}" for i in range(width)]
    rec = F.floor(F.col(idx) / width).cast("bigint")
    role = F.pmod(F.col(idx), F.lit(width)).cast("int")
    staged = lines.select(*group, rec.alias("record"), F.struct(role.alias("r"), F.col(value).alias("v")).alias("_e"))
    # collect_list runs as a hash (object) aggregate; at most `width` entries per record
    folded = staged.groupBy(*group, "record").agg(F.collect_list("_e").alias("_l"))
    fields = [F.element_at(F.filter("_l", _role_is(i)), 1)["v"].alias(n) for i, n in enumerate(names)]
    return folded.select(*group, "record", *fields, F.size("_l").alias("n_lines"))
