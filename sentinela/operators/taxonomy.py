"""Lineages from a parent table (J2, F1): ``(taxon, parent, name)`` rows to root-first
name arrays, by pointer doubling.

Every round replaces a taxon's pointer by its pointer's pointer, so a tree of depth
``d`` takes about ``log2(d)`` joins, whatever its size.  A round in which no more taxa
reach their root leaves only those on, or below, a cycle: among taxa that have a root
some are always within reach of the next round.  Names are joined only once the
cyclic taxa are out, since their paths would double without end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .partitions import pin


def _one_row_each(parents: DataFrame, taxon: str, parent: str, name: str) -> DataFrame:
    """``t, up, name, status``: one row per taxon; ``up`` is NULL at a root and at an orphan."""
    rows = (parents.filter(F.col(taxon).isNotNull())
            .groupBy(F.col(taxon).alias("t"))
            .agg(F.min(F.struct(F.col(parent).alias("up"), F.col(name).alias("name"))).alias("r"))
            .select("t", F.when(F.col("r.up") != F.col("t"), F.col("r.up")).alias("up"), "r.name"))
    known = rows.select(F.col("t").alias("known"))
    met = rows.join(known, F.col("up") == F.col("known"), "left")
    return met.select("t", F.col("known").alias("up"), "name",
                      F.when(F.col("up").isNotNull() & F.col("known").isNull(), "orphan").otherwise("root").alias("end"))


def _open(state: DataFrame) -> int:
    return state.filter("up IS NOT NULL").count()


def lineages(parents: DataFrame, taxon: str = "taxon", parent: str = "parent", name: str = "name") -> DataFrame:
    """``taxon, lineage ARRAY<STRING>, depth, status`` for every taxon.

    ``lineage`` runs from the root to the taxon's own name and ``depth`` is the number
    of taxa on it.  ``status`` is ``ok``; ``orphan`` when the topmost taxon names a
    parent that the table lacks (the lineage then begins at that taxon); ``cycle`` when
    the parents lead back to a taxon already passed (``lineage`` and ``depth`` are NULL).
    A taxon whose parent is NULL or itself is a root.  Of several rows of a taxon the
    one with the smallest parent, then name, counts (NULLs first); rows without a taxon
    are left out.  NULL names stay in the array."""
    nodes = pin(_one_row_each(parents, taxon, parent, name))
    state, left = nodes.select("t", "up"), None
    while (now := _open(state)) and now != left:
        left = now
        hop = state.select(F.col("t").alias("via"), F.col("up").alias("next"))
        state = pin(state.join(hop, F.col("up") == F.col("via"), "left").select("t", F.col("next").alias("up")))
    cyclic = state.filter("up IS NOT NULL").select("t")
    paths = pin(nodes.join(cyclic, "t", "left_anti").select("t", "up", F.array("name").alias("path"), "end"))
    while _open(paths):
        hop = paths.select(F.col("t").alias("via"), F.col("up").alias("next"), F.col("path").alias("above"),
                           F.col("end").alias("top"))
        paths = pin(paths.join(hop, F.col("up") == F.col("via"), "left").select(
            "t", F.col("next").alias("up"), F.when(F.col("via").isNull(), F.col("path")).otherwise(F.concat("above", "path"))
            .alias("path"), F.coalesce("top", "end").alias("end")))
    found = paths.select(F.col("t").alias("taxon"), F.col("path").alias("lineage"), F.size("path").alias("depth"),
                         F.when(F.col("end") == "orphan", "orphan").otherwise("ok").alias("status"))
    lost = cyclic.select(F.col("t").alias("taxon"), F.lit(None).cast("array<string>").alias("lineage"),
                         F.lit(None).cast("int").alias("depth"), F.lit("cycle").alias("status"))
    return found.unionByName(lost)
