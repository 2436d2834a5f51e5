"""Hard negatives by slot-decomposed selection.

An anchor's positives each open a window of allowed negative scores, and the
windows overlap.  The windows' upper limits cut the scores into disjoint slots.
Of every slot only the first ``k`` rows can ever be returned, so the tasks keep
that many per anchor and slot, and a merge keeps as many again.  The answer of a
window is then a walk down the slots from its own limit: the first ``k`` rows of
the suffix, cut at the window's lower limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .blocks import block_counts, longs, matrix, meet, usable_vectors, widths

SCALE = 256.0
#: Anchors whose scores against a block are held at once.
ANCHORS_AT_ONCE = 64

_LAST = np.iinfo(np.int64).max


def whole(vectors: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` of every component, as doubles (exact: each is a whole number)."""
    return np.floor(SCALE * vectors)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact, as BIGINT; one beyond its
    range is the nearest BIGINT."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    # every sum of products below 2^53 is exact in doubles, in any order
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return np.array([[min(max(int(x), low), high) for x in line] for line in exact(a).dot(exact(b).T)], np.int64)


def _first(at: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of the places ``at`` by score down, id, row."""
    if len(at) > k:
        least = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= least]
    return at[np.lexsort((rows[at], ids[at], ~score[at]))][:k]  # ~x orders like -x and cannot overflow


def _kernel(pick):
    """A block kernel: ``pick(anchor, score, other)`` yields ``(slot, places)`` per anchor."""
    def kernel(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor_row": [], "slot": [], "row": [], "id": [], "score": []}
        n_rows, n_anchors = widths(rows["vec"]), widths(anchors["vec"])
        all_ids, all_rows, all_labels = longs(rows["id"], _LAST), longs(rows["row"], 0), longs(rows["label"], 0)
        for d in map(int, np.intersect1d(n_rows, n_anchors)):
            here, there = np.flatnonzero(n_rows == d), np.flatnonzero(n_anchors == d)
            other = {"id": all_ids[here], "row": all_rows[here], "label": all_labels[here]}
            block = whole(matrix(rows["vec"], here, d))
            for begin in range(0, len(there), ANCHORS_AT_ONCE):
                part = there[begin:begin + ANCHORS_AT_ONCE]
                scores = inner(whole(matrix(anchors["vec"], part, d)), block)
                for anchor, score in zip(anchors.drop_columns(["vec"]).take(pa.array(part)).to_pylist(), scores):
                    for slot, at in pick(anchor, score, other):
                        out["anchor_row"] += [anchor["row"]] * len(at)
                        out["slot"] += [slot] * len(at)
                        out["row"] += other["row"][at].tolist()
                        out["id"] += [None if x == _LAST else x for x in other["id"][at].tolist()]
                        out["score"] += score[at].tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return kernel


_FOUND = "anchor_row BIGINT, slot BIGINT, row BIGINT, id BIGINT, score BIGINT"


def _top(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows per anchor and slot (a partial limit before the shuffle)."""
    order = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k)


def mine(df: DataFrame, n_positives: int = 5, k: int = 3, every: int = 50, low_pct: int = 50, high_pct: int = 95,
         id_col: str = "vec_id", vec_col: str = "embedding", label="label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(256 * x)`` and scores are integer inner products.
    Anchors are the rows whose id is divisible by ``every``; an anchor's positives
    are its first ``n_positives`` other rows of its label, by score down, then id.
    For every positive the first ``k`` rows of other labels come back whose score is
    between ``low_pct`` and ``high_pct`` percent of the positive's; ``rank`` counts
    them from 1.  ``label`` is the label column's name or an expression.

    Rows with a null label or a null or empty vector, or a null or non-finite
    component, take no part.  A null id is never an anchor; elsewhere it comes after
    the other ids of a tie and is returned as null.  Vectors of another length than
    the anchor's never meet it.  Repeated rows and ids are rows of their own (a
    repeated anchor is answered as often as it comes, its copies are positives).
    Scores beyond BIGINT are the nearest BIGINT.  An anchor without positives, or
    whose positives all have negative scores (their windows are empty), gives no
    row; an empty table gives none.  Other columns are not read."""
    if not 0 <= low_pct <= high_pct <= 100:
        raise ValueError("0 <= low_pct <= high_pct <= 100 is needed")
    spark = df.sparkSession
    named = F.col(label) if isinstance(label, str) else label
    rows = usable_vectors(df, id_col, vec_col, named.cast("bigint").alias("label")).filter("label IS NOT NULL")
    anchors = rows.filter(F.col("id") % every == 0)
    counts = block_counts(rows, anchors)

    def alike(anchor, score, other):
        at = np.flatnonzero((other["label"] == anchor["label"]) & (other["row"] != anchor["row"]))
        yield 0, _first(at, score, other["id"], other["row"], n_positives)

    best = _top(meet(rows, anchors, counts, _kernel(alike), _FOUND), n_positives).filter("score >= 0")
    # of 0 or more: the limits of percent windows without leaving BIGINT
    hundreds = F.call_function("div", F.col("score"), F.lit(100).cast("bigint"))
    rest = F.col("score") - hundreds * 100
    upper = hundreds * high_pct + F.floor(rest * high_pct / 100).cast("bigint")
    lower = hundreds * low_pct + F.ceil(rest * low_pct / 100).cast("bigint")
    positives = best.select("anchor_row", F.col("at").alias("positive_at"), F.col("id").alias("positive_id"),
                            F.col("score").alias("positive_score"), upper.alias("upper"), lower.alias("lower"))
    path = scratch_path(spark, "positives")
    positives.write.parquet(path)
    positives = spark.read.schema(positives.schema).parquet(path)

    # n_positives limits an anchor at most
    limits = positives.groupBy("anchor_row").agg(F.sort_array(F.collect_set("upper"), False).alias("uppers"),
                                                 F.min("lower").alias("floor"))
    asked = anchors.join(limits, F.col("row") == F.col("anchor_row")).drop("anchor_row")

    def apart(anchor, score, other):
        uppers = anchor["uppers"]
        open_ = np.flatnonzero((other["label"] != anchor["label"]) & (score <= uppers[0]) & (score >= anchor["floor"]))
        for slot, top in enumerate(uppers):
            inside = score[open_] <= top
            if slot + 1 < len(uppers):
                inside &= score[open_] > uppers[slot + 1]
            yield slot, _first(open_[inside], score, other["id"], other["row"], k)

    kept = _top(meet(rows, asked, counts, _kernel(apart), _FOUND), k)
    # at most n_positives * k entries an anchor, in the order of the walk down the slots
    entry = F.struct("slot", "at", "id", "score")
    walks = kept.groupBy("anchor_row").agg(F.sort_array(F.collect_list(entry)).alias("walk"))
    windows = (positives.join(limits.select("anchor_row", "uppers"), "anchor_row").join(walks, "anchor_row")
               .withColumn("slot", F.array_position("uppers", F.col("upper")) - 1))
    below = F.slice(F.filter("walk", lambda e: e["slot"] >= F.col("slot")), 1, k)
    answered = windows.select("anchor_row", "positive_id", "positive_score", F.posexplode(
        F.filter(below, lambda e: e["score"] >= F.col("lower"))).alias("at", "found"))
    names = anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return answered.join(names, "anchor_row").select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("found.id").alias("negative_id"),
        "positive_score", F.col("found.score").alias("negative_score"))
