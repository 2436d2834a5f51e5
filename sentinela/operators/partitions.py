"""Input parallelism for CPU-heavy row work.

A scan yields one task per file split; a Parquet file with a single row group
is one split however many cores wait.  ``spread`` adds a round-robin
repartition only when the input has fewer partitions than the session's
default parallelism.  On a large input (thousands of splits) it is a no-op, so
no shuffle is added where the scan is already wide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, keys: list[str] | tuple = (), min_partitions: int | None = None) -> DataFrame:
    """Hash-partition on ``keys`` (round-robin without keys) when the input has
    fewer partitions than the default parallelism.  Hashing on a key avoids the
    per-partition sort that a deterministic round-robin needs, which matters
    for wide rows such as whole texts."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target, *keys) if keys else df.repartition(target)
    return df


def pin(df: DataFrame) -> DataFrame:
    """Compute a (small) derived table once and cut its lineage: a reliable
    checkpoint in the shared folder, so a size check and the join that uses
    the table do not both recompute it, and a lost executor does not force
    recomputing its inputs."""
    from ..session import shared_root
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
