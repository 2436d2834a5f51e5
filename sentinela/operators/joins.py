"""Join helpers: broadcast only behind a size check, and the set-difference work list."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds for an explicit broadcast.  Above them the join is left to the
# planner (sort-merge join, AQE skew splitting and runtime broadcast conversion).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


def _row_bytes(df: DataFrame) -> tuple[int, Column | None]:
    """Bytes of a row's fixed part, and an expression for its variable part."""
    fixed, variable = 0, []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        fixed += 16
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            variable.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            variable.append(F.octet_length(F.to_json(F.struct(c))))
    return fixed, reduce(add, variable) if variable else None


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.  One
    partial aggregate: a row per partition is shuffled (for fixed-width columns
    from the footers of a Parquet scan); meant for dimension tables and pinned
    tables, not for wide derived ones (see ``total_at_most``)."""
    fixed, variable = _row_bytes(df)
    if variable is None:
        n = df.count()
        return n <= max_rows and n * fixed <= max_bytes
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(variable.cast("bigint")).alias("b")).first()
    return row["n"] <= max_rows and row["n"] * fixed + (row["b"] or 0) <= max_bytes


def total_at_most(df: DataFrame, measure, max_total: int) -> bool:
    """True when ``sum(measure)`` over ``df`` is at most ``max_total``.

    Used to prove a bound on a table *derived* from ``df`` before it is built,
    e.g. the number of k-grams of a set of sequences is at most their total
    length.  One aggregate pass over ``df``; one number reaches the driver."""
    total = df.agg(F.sum(measure).alias("t")).first()["t"]
    return (total or 0) <= max_total


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its rows and bytes are proven to be within the bounds
    (``fits``); otherwise ``df`` unchanged, so the planner shuffles instead."""
    return F.broadcast(df) if fits(df, max_rows) else df


def new_items(candidates: DataFrame, done: DataFrame, on, how_done=None) -> DataFrame:
    """Rows of ``candidates`` whose key is absent from ``done`` (J4, left anti join).
    ``done`` is made distinct first (partial), so a hot key there is one row per task."""
    if how_done is not None:
        return candidates.join(done, how_done, "left_anti")
    keys = [on] if isinstance(on, str) else list(on)
    return candidates.join(done.select(*keys).distinct(), keys, "left_anti")
