"""Nearest neighbours with randomly rotated one-bit codes.

Every vector, less a centre and scaled to length 1, is turned by a random
rotation and kept as the signs of its components: packed bits, its length, and
the inner product of the code with the vector it stands for.  The inner product
of a query with a code, divided by that number, estimates the inner product of
the query with the vector without bias, and its error is bounded with high
probability by a term known per vector.  A query is rounded to a few bits, so an
estimate is a handful of AND and bit counts.

Per block of rows a query first measures the ``k`` vectors with the best
estimates.  Their largest distance is a threshold; then every vector whose lower
bound does not exceed it is measured as well, on the original components in
double precision.  All rows are indexed and every query meets all codes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .arrow import map_arrow
from .blocks import block_counts, longs, matrix, meet, usable_vectors, widths

#: Rows that fit the centre: those with the smallest hash of their number, per vector length.
SAMPLE_ROWS = 2_000
#: Width of the error bound, in standard deviations of the estimate.
EPSILON = 2.5
#: Bits that a component of a query is rounded to.
QUERY_BITS = 6
SEED = 20240501

_LAST = np.iinfo(np.int64).max


def rotation(width: int) -> np.ndarray:
    """A random orthogonal matrix of the next multiple of 64, the same in every task."""
    n = -(-width // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng([SEED, n]).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def _unit(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of ``vectors - centre`` and their rotated directions (zero for length 0)."""
    moved = vectors - centre
    size = np.linalg.norm(moved, axis=1)
    aimed = moved / np.where(size > 0, size, 1.0)[:, None]
    return size, np.pad(aimed, ((0, 0), (0, len(turn) - vectors.shape[1]))) @ turn.T


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs (uint64 words a row), lengths, and code-to-vector inner products."""
    size, aimed = _unit(vectors, centre, turn)
    words = np.packbits(aimed > 0, axis=1, bitorder="little").view(np.uint64)
    return words, size, np.abs(aimed).sum(axis=1) / np.sqrt(len(turn))


class Query:
    """A query rounded to bit planes; ``bounds`` gives squared distances from codes alone."""

    def __init__(self, size: float, aimed: np.ndarray):
        self.size, self.n = size, len(aimed)
        self.low = aimed.min()
        self.step = (aimed.max() - self.low) / ((1 << QUERY_BITS) - 1) or 1.0
        level = np.rint((aimed - self.low) / self.step).astype(np.uint64)
        self.planes = [np.packbits((level >> np.uint64(t)) & np.uint64(1) == 1, bitorder="little").view(np.uint64)
                       for t in range(QUERY_BITS)]
        self.total = (self.low + self.step * level).sum()

    def bounds(self, words: np.ndarray, size: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated squared distances to the coded vectors, and lower bounds of them."""
        ones = self.low * np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        for t, plane in enumerate(self.planes):
            ones = ones + self.step * (1 << t) * np.bitwise_count(words & plane).sum(axis=1, dtype=np.int64)
        own = np.where(size > 0, own, 1.0)
        inner = (2 * ones - self.total) / (np.sqrt(self.n) * own)
        spread = np.sqrt(((1 - own * own).clip(0) / max(self.n - 1, 1) + self.step ** 2 / 12) / (own * own))
        both = 2 * size * self.size
        squares = size * size + self.size * self.size
        return squares - both * inner, squares - both * (inner + EPSILON * spread).clip(max=1.0)


def _centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """The mean of a bounded sample of vectors, per vector length."""
    w = Window.partitionBy(F.size("vec")).orderBy(F.xxhash64("row"), "row")
    sample = rows.select("row", "vec", F.row_number().over(w).alias("at")).filter(F.col("at") <= SAMPLE_ROWS)
    table = sample.select("vec").toArrow()["vec"]
    n = widths(table)
    return {int(d): matrix(table, np.flatnonzero(n == d), int(d)).mean(axis=0) for d in np.unique(n)}


def build_index(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, dict]:
    """``row, id, vec, code, size, own`` of every usable row, kept in the shared
    folder, and the centres.  Zero vectors are left out, as are null ones and those
    that hold a null or a non-finite component."""
    spark = df.sparkSession
    rows = usable_vectors(df, id_col, vec_col).filter(F.exists("vec", lambda x: x != 0))
    centres = _centres(rows)

    def run(batches):
        turns = {}
        for b in batches:
            column = pa.chunked_array([b.column("vec")])
            n = widths(column)
            code, size, own = [None] * len(n), np.zeros(len(n)), np.zeros(len(n))
            for d in map(int, np.unique(n)):
                at = np.flatnonzero(n == d)
                if d not in turns:
                    turns[d] = rotation(d)
                words, size[at], own[at] = encode(matrix(column, at, d), centres[d], turns[d])
                for i, w in zip(at, words):
                    code[i] = w.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code, pa.binary()), pa.array(size), pa.array(own)],
                                             names=["row", "id", "vec", "code", "size", "own"])

    schema = T.StructType([*rows.schema.fields]).add("code", "binary").add("size", "double").add("own", "double")
    path = scratch_path(spark, "onebit-index")
    map_arrow(rows, run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path), centres


def _nearest(query: Query, q: np.ndarray, block: dict, skip: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the ``k`` nearest rows of a block, by distance, id, row."""
    guess, low = query.bounds(block["words"], block["size"], block["own"])
    guess[skip], low[skip] = np.inf, np.inf
    open_ = len(guess) - int(skip.sum())
    if not open_:
        return np.empty(0, np.int64), np.empty(0)

    def measured(at):
        return np.sqrt(((block["vec"][at] - q) ** 2).sum(axis=1))

    at = np.argpartition(guess, min(k, open_) - 1)[:min(k, open_)]
    limit = measured(at).max()
    at = np.flatnonzero((low <= limit * limit * (1 + 1e-9)) & ~skip) if open_ > k else np.flatnonzero(~skip)
    far = measured(at)
    if len(far) > k:  # rows as far as the k-th stay for the tie-break
        kept = far <= np.partition(far, k - 1)[k - 1]
        at, far = at[kept], far[kept]
    order = np.lexsort((block["row"][at], block["id"][at], far))[:k]
    return at[order], far[order]


def search(df: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by
    ``every``, the ``k`` rows found nearest by Euclidean distance (all, if fewer),
    nearest first, ties to the smaller id; ``score`` is the distance itself.

    A query meets every usable row but itself.  Rows with a null, zero or empty
    vector, or one with a null or non-finite component, take no part.  A null id is
    never a query; as a candidate it is returned as null, after others as far.
    Vectors of another length than the query's are no candidates.  Repeated rows and
    ids are rows of their own: a repeated query is answered as often as it comes, and
    its copies are candidates at distance 0.  An empty table gives an empty result.
    Only ``id_col`` and ``vec_col`` are read, so other columns cannot clash."""
    index, centres = build_index(df, id_col, vec_col)
    queries = index.filter(F.col("id") % every == 0).select("row", "id", "vec")

    def kernel(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_row": [], "query_id": [], "row": [], "vec_id": [], "score": []}
        n_rows, n_asked = widths(rows["vec"]), widths(asked["vec"])
        ids, numbers = longs(rows["id"], _LAST), longs(rows["row"], 0)
        query_ids, query_rows = longs(asked["id"], 0), longs(asked["row"], 0)
        for d in map(int, np.intersect1d(n_rows, n_asked)):
            here, there = np.flatnonzero(n_rows == d), np.flatnonzero(n_asked == d)
            codes = rows["code"].take(pa.array(here)).to_pylist()
            block = {"vec": matrix(rows["vec"], here, d), "words": np.frombuffer(b"".join(codes), np.uint64)
                     .reshape(len(here), -1), "size": rows["size"].to_numpy()[here], "own": rows["own"].to_numpy()[here],
                     "id": ids[here], "row": numbers[here]}
            vectors = matrix(asked["vec"], there, d)
            sizes, aimed = _unit(vectors, centres[d], rotation(d))
            for i, j in enumerate(there):
                at, far = _nearest(Query(sizes[i], aimed[i]), vectors[i], block, block["row"] == query_rows[j], k)
                out["query_row"] += [int(query_rows[j])] * len(at)
                out["query_id"] += [int(query_ids[j])] * len(at)
                out["row"] += block["row"][at].tolist()
                out["vec_id"] += [None if x == _LAST else x for x in block["id"][at].tolist()]
                out["score"] += far.tolist()
        kinds = {"score": pa.float64()}
        return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    found = meet(index, queries, block_counts(index, queries), kernel,
                 "query_row BIGINT, query_id BIGINT, row BIGINT, vec_id BIGINT, score DOUBLE")
    # planned with a partial limit: k rows a query and task cross the network
    best = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
