"""Query rows against all rows, in blocks.

Rows and queries are dealt into bounded blocks by a hash of a row number; every
(row block, query block) pair meets in one group.  A group's size is fixed by
parameters, so more data give more groups, never larger ones, and neither a
value that many rows share nor a query block can fill a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .arrow import ship

#: Bytes of vectors that one block holds at most (about; blocks are dealt by hash).
BLOCK_BYTES = 8 << 20
#: Row blocks there are at least, as a multiple of the cores, so that small tables use all of them.
BLOCKS_PER_CORE = 4


def usable_vectors(df: DataFrame, id_col: str, vec_col: str, *others) -> DataFrame:
    """``row, id, vec`` and ``others`` (columns already named) of the rows whose vector
    is not null, not empty, and holds no null and no non-finite component, written
    to the shared folder.  ``row`` numbers them; vectors are arrays of FLOAT as they
    were, any other number type becomes DOUBLE."""
    spark = df.sparkSession
    kind = df.schema[vec_col].dataType
    vec = F.col(f"`{vec_col}`")
    if not isinstance(kind.elementType, T.FloatType):
        vec = vec.cast("array<double>")
    held = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), vec.alias("vec"), *others)
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # cast: a null vector or component makes the test null, which also leaves the row out
    made = held.filter((F.size("vec") > 0) & ~bad).select(F.monotonically_increasing_id().alias("row"), "*")
    path = scratch_path(spark, "vectors")
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def block_counts(rows: DataFrame, queries: DataFrame) -> tuple[int, int]:
    """Numbers of row and query blocks, from two counts and the longest vector."""
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    per_block = max(1, BLOCK_BYTES // (8 * (width or 1)))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return (max(BLOCKS_PER_CORE * cores, -(-n // per_block)), max(1, -(-queries.count() // per_block)))


def meet(rows: DataFrame, queries: DataFrame, counts: tuple[int, int], kernel, schema: str) -> DataFrame:
    """``kernel(rows, queries)`` (two Arrow tables in, one out) for every pair of
    blocks.  Both frames have a ``row`` column; ``counts`` is ``block_counts``."""
    ship(rows.sparkSession)
    n_rows, n_queries = counts

    def dealt(df, own, other, n_own, n_other):
        # aliases: both sides may come from one table
        return df.select(*[F.col(c).alias(c) for c in df.columns], F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)).groupBy("rows_at", "queries_at")

    left = dealt(rows, "rows_at", "queries_at", n_rows, n_queries)
    right = dealt(queries, "queries_at", "rows_at", n_queries, n_rows)
    return left.cogroup(right).applyInArrow(kernel, schema)


def matrix(column: pa.ChunkedArray, where: np.ndarray, width: int) -> np.ndarray:
    """The vectors of the rows ``where`` (all ``width`` long) as a double matrix."""
    whole = column.take(pa.array(where)).combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks) if whole.num_chunks else pa.array([], column.type)
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(where), width)


def widths(column: pa.ChunkedArray) -> np.ndarray:
    """Length of every vector."""
    import pyarrow.compute as pc
    return pc.list_value_length(column).to_numpy().astype(np.int64)


def longs(column: pa.ChunkedArray, null: int) -> np.ndarray:
    return column.fill_null(null).to_numpy().astype(np.int64)
