"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points of a 64-bit ring; a row belongs to the
first point clockwise of its key's hash.  A shard takes no more than its
capacity: what an arc holds beyond it moves on clockwise to the next point whose
shard has room.  Capacities add up to the number of rows and differ by at most
one, so the row counts do too (the law ``rows``).

Rows are never walked one by one.  The ring is cut into cells of equal width
inside its arcs; Spark counts the cells, the driver walks the counted ring (its
size is ``shards * virtual_nodes * cells`` whatever the input), and each row
finds its shard from its rank in its cell.  Equal rows are one counted row until
the very end, so no key can overfill a cell.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import scratch_path

SHARDS = 8
VIRTUAL_NODES = 64
CELL_BITS = 14   # the ring's hashes are grouped by their upper bits (16,384 cells)
#: Rows that one row of counts becomes in one task at most.
RUN = 1 << 16
HALF = 1 << 63


def ring_points(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """``(point, shard)`` in clockwise order; points are 0 to 2**64 - 1."""
    points = {}
    for s in range(shards):
        for v in range(virtual_nodes):
            points.setdefault(xxhash.xxh64_intdigest(f"{s}/{v}".encode(), 0), s)
    return sorted(points.items())


def arcs(shards: int, virtual_nodes: int, cell_bits: int = CELL_BITS) -> list[tuple[int, int, int]]:
    """``(cell, first hash, ring point index)`` pieces that cover the ring in order.

    Cells are cut where a ring point falls inside, so a piece has one first owner."""
    points = [p for p, _ in ring_points(shards, virtual_nodes)]
    width = 1 << (64 - cell_bits)
    starts = sorted({c * width for c in range(1 << cell_bits)} | {p + 1 for p in points if p + 1 < 1 << 64})
    return [(i, start, bisect_left(points, start) % len(points)) for i, start in enumerate(starts)]


def walk(counts: dict[int, int], pieces: list[tuple[int, int, int]], points: list[tuple[int, int]],
         shards: int) -> list[tuple[int, int, int, int, int]]:
    """``(piece, from rank, to rank, shard, first slot)`` after filling the shards.

    First every arc's shard keeps its own rows, in clockwise order, up to its
    capacity; then the rows beyond it continue clockwise, in order, to the next
    point whose shard has room."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slots = [0] * shards
    out, over = [], []

    def give(piece: int, lo: int, hi: int, shard: int) -> None:
        out.append((piece, lo, hi, shard, slots[shard]))
        slots[shard] += hi - lo
        room[shard] -= hi - lo

    for piece, _, owner in pieces:
        n, shard = counts.get(piece, 0), points[owner][1]
        own = min(n, room[shard])
        if own:
            give(piece, 0, own, shard)
        if n > own:
            over.append((piece, own, n, owner))
    for piece, lo, hi, at in over:
        while lo < hi:
            at = (at + 1) % len(points)
            shard = points[at][1]
            if take := min(hi - lo, room[shard]):
                give(piece, lo, lo + take, shard)
                lo += take
    return out


def _locate(rows: DataFrame, pieces: list[tuple[int, int, int]], cell_bits: int = CELL_BITS) -> DataFrame:
    """``rows(h)`` plus ``piece``.  Spark orders signed numbers, so hashes are
    compared after taking 2**63 away, which keeps their unsigned order."""
    cells: dict[int, list[int]] = {}
    first: dict[int, int] = {}
    for piece, start, _ in pieces:
        cell = start >> (64 - cell_bits)
        first.setdefault(cell, piece)
        cells.setdefault(cell, []).append(start - HALF)
    table = rows.sparkSession.createDataFrame(
        [(c, first[c], cuts[1:]) for c, cuts in cells.items()], "cell BIGINT, piece0 INT, cuts ARRAY<BIGINT>")
    at = F.col("h").bitwiseXOR(F.lit(-HALF))
    return (rows.withColumn("cell", F.shiftrightunsigned("h", 64 - cell_bits))
            .join(F.broadcast(table), "cell")  # one row per cell: 2**cell_bits
            .withColumn("piece", F.col("piece0") + F.size(F.filter("cuts", lambda c: c <= at)))
            .drop("cell", "piece0", "cuts"))


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
               virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` per row of ``docs``; slots run from 0
    in every shard without gaps, and shard sizes differ by at most one row.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text has none and the
    checksum of the empty text.  The ring key is the id with the text's size and
    checksum, so rows with a null or repeated id still spread; wholly equal rows
    take neighbouring slots.  Fewer rows than shards leave shards empty; an empty
    table gives an empty result.  Only ``id_col`` and ``text_col`` are read."""
    if shards < 1 or virtual_nodes < 1:
        raise ValueError("shards and virtual_nodes must be positive")
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    pieces = arcs(shards, virtual_nodes)
    key = F.xxhash64("id", "size", "text_crc32")
    path = scratch_path(spark, "ring-rows")
    (rows.groupBy("id", "size", "text_crc32").agg(F.count("*").alias("n"))
     .withColumn("h", key).write.parquet(path))
    schema = T.StructType([*rows.schema.fields, T.StructField("n", T.LongType()), T.StructField("h", T.LongType())])
    counted = spark.read.schema(schema).parquet(path)
    located = _locate(counted, pieces)
    per_piece = {r["piece"]: r["n"] for r in located.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    plan = walk(per_piece, pieces, ring_points(shards, virtual_nodes), shards)
    table = F.broadcast(spark.createDataFrame(  # as many rows as pieces and shards at most
        plan, "piece INT, lo BIGINT, hi BIGINT, shard INT, first_slot BIGINT"))
    order = Window.partitionBy("piece").orderBy("h", "id", "size", "text_crc32")
    ranked = located.withColumn("end", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("begin", F.col("end") - F.col("n"))
    cut = (ranked.join(table, "piece").filter("begin < hi AND end > lo")
           .withColumn("a", F.greatest("begin", "lo")).withColumn("b", F.least("end", "hi")))
    cut = cut.select("id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("a") - F.col("lo")).alias("from"),
                     (F.col("first_slot") + F.col("b") - F.col("lo") - 1).alias("to"))
    # equal rows beyond RUN are dealt over tasks in runs before they become rows
    long = F.col("to") - F.col("from") >= RUN
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = (cut.filter(long).select("id", "size", "text_crc32", "shard", "to", F.explode(
        F.sequence("from", "to", F.lit(RUN).cast("bigint"))).alias("from"))
        .withColumn("to", F.least("to", F.col("from") + RUN - 1)).repartition(parts, "shard", "from"))
    every = cut.filter(~long).unionByName(runs)
    return every.select("id", "size", "text_crc32", "shard", F.explode(F.sequence("from", "to")).alias("slot"))
