"""SimHash near-dedup with deletion-variant signatures.

A 64-bit fingerprint is cut into ``d // 2 + 1`` segments, so of two
fingerprints that differ in at most ``d`` bits, one segment differs in at most
one bit.  Every fingerprint is indexed under each segment with each of its bits
left out in turn (a one-wildcard variant: 64 rows); equal variants are joined
and the pairs verified on all 64 bits.

Only distinct fingerprints are indexed: copies meet in one row before.  A
variant that more than ``max_bucket`` fingerprints share is not expanded into
pairs.  Its members are linked through points instead: two fingerprints differ
in at most two bits exactly if some 64-bit point is within one bit of both, so
grouping the points of each member and linking the group's members to its
smallest one keeps every connection, with 65 rows a member.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .columns import passes_columns
from ..session import scratch_path
from .arrow import LOWER_TABLE, map_arrow, utf8
from .components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
BITS = 64
MAX_BUCKET = 4
CHUNK = 1 << 16  # hashes unpacked at once (4 MB)


def fingerprint(words: list[bytes], k: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 of the ``k``-word shingles, as a signed 64-bit number."""
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n < k:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        width = np.fromiter(map(len, words), np.int64, n) + 1
        ends = np.cumsum(width) - 1
        begins = (ends + 1 - width)[: n - k + 1].tolist()
        cut = map(joined.__getitem__, map(slice, begins, ends[k - 1:].tolist()))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), np.uint64, n - k + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 k: int = SHINGLE_WORDS) -> DataFrame:
    """``id, fp BIGINT`` per row of ``docs``: A-Z lower-cased, words split at
    ASCII white space, null text without words (fingerprint 0)."""
    pair = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.translate(LOWER_TABLE).split(), k) for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    schema = T.StructType([T.StructField("id", pair.schema["id"].dataType),
                           T.StructField("fp", T.LongType())])
    return map_arrow(pair, run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _wildcard_masks(segments: int) -> list[int]:
    """One mask per left-out bit: the bit's segment without the bit."""
    masks, low = [], 0
    for s in range(segments):
        width = (BITS - low) // (segments - s)
        whole = ((1 << width) - 1) << low
        masks += [_signed(whole & ~(1 << b)) for b in range(low, low + width)]
        low += width
    return masks


def _distance(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, distance: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``u, v`` edges between the distinct fingerprints of ``fps(fp)`` such that
    two of them are connected exactly if a chain of steps of at most
    ``distance`` bits leads from one to the other.  Every edge is such a step."""
    if not 0 <= distance <= 2:
        raise ValueError("distance must be 0, 1 or 2")
    spark = fps.sparkSession
    masks = F.array(*[F.lit(m) for m in _wildcard_masks(distance // 2 + 1)])
    variants = (fps.select("fp").distinct()
                .select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("slot"))
                .select(F.col("slot").cast("short").alias("slot"), "fp",
                        F.col("fp").bitwiseAND(F.get(masks, F.col("slot"))).alias("masked")))
    shared = variants.withColumn("n", F.count("*").over(Window.partitionBy("masked", "slot"))).filter("n > 1")
    path = scratch_path(spark, "simhash-variants")
    shared.write.parquet(path)
    shared = spark.read.schema("slot SMALLINT, fp BIGINT, masked BIGINT, n BIGINT").parquet(path)

    few = shared.filter(F.col("n") <= max_bucket)
    pairs = (few.select("slot", "masked", F.col("fp").alias("v"))
             .join(few.select("slot", "masked", F.col("fp").alias("u")), ["slot", "masked"])
             .filter((F.col("u") > F.col("v")) & (_distance("u", "v") <= distance))
             .select("u", "v"))

    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in range(BITS if distance else 0)])
    points = (shared.filter(F.col("n") > max_bucket).select("fp").distinct()
              .select("fp", F.explode(flips).alias("flip"))
              .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), (F.col("flip") == 0).alias("own")))
    # the group's centre is within distance // 2 of the point, the others within (distance + 1) // 2
    near = F.lit(True) if distance == 2 else F.col("own")
    centre = points.groupBy("point").agg(F.min(F.when(near, F.col("fp"))).alias("v"), F.count("*").alias("n"))
    stars = (points.join(centre.filter("n > 1 AND v IS NOT NULL"), "point")
             .filter("fp != v").select(F.col("fp").alias("u"), "v"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``id, fp BIGINT, component`` per row of ``docs``; ``component`` is the
    smallest id reachable over links of at most ``distance`` differing bits.

    Null and empty texts have fingerprint 0 and link like any other.  Rows with
    a null id are kept; a null id is never the smallest unless a component has
    no other.  Repeated rows are returned as often as they come.  An empty table
    gives an empty result.  Only ``id_col`` and ``text_col`` are read, so other
    columns cannot clash."""
    spark = docs.sparkSession
    path = scratch_path(spark, "simhash-fingerprints")
    made = fingerprints(docs, id_col, text_col, k)
    made.write.parquet(path)
    rows = spark.read.schema(made.schema).parquet(path)
    nodes = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    member = components(links(rows, distance, max_bucket))
    grouped = member.join(nodes, member["node"] == nodes["fp"]).select("fp", "root", "first_id")
    least = grouped.groupBy("root").agg(F.min("first_id").alias("least_id"))
    linked = grouped.join(least, "root").select("fp", "least_id")
    by_fp = nodes.join(linked, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component"))
    # written first, so that AQE sees two plain join sides and can split a fingerprint that many rows share
    path = scratch_path(spark, "simhash-components")
    by_fp.write.parquet(path)
    by_fp = spark.read.schema(by_fp.schema).parquet(path)
    return rows.join(by_fp, "fp").select("id", "fp", "component")


@passes_columns
def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group: the one
    with the smallest id (nulls last), then the smallest text hash.  All columns
    are kept, whatever their names; of wholly equal smallest rows one stays, of rows
    equal in id and text any.  Null and empty texts are near duplicates of each other;
    an empty table stays empty."""
    spark, own = docs.sparkSession, [F.col(f"`{c}`") for c in docs.columns]
    text_hash = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(text_col).isNull())
    groups = near_duplicates(docs.select(F.struct(F.col(id_col).isNull().alias("a"), F.col(id_col).alias("b"),
                                                  text_hash.alias("c")).alias("__row"),
                                         F.col(text_col).alias("__text")), "__row", "__text", k, distance)
    path = scratch_path(spark, "simhash-kept")
    (groups.filter("id = component").groupBy("id").agg(F.count("*").alias("n"))
     .select(F.col("id.b").alias("__kept_id"), F.col("id.c").alias("__kept_hash"), F.col("n").alias("__kept_n"))
     .write.parquet(path))
    kept = spark.read.parquet(path)
    found = docs.join(kept, docs[id_col].eqNullSafe(kept["__kept_id"]) & (text_hash == kept["__kept_hash"]))
    once = found.filter("__kept_n = 1").select(*own)
    again = (found.filter("__kept_n > 1").dropDuplicates(["__kept_id", "__kept_hash"]).select(*own))
    return once.unionAll(again)
