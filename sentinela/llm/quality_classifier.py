"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its features: hashed words,
hashed character n-grams inside words (with the word's borders), and whether a
word repeats the one before it.  A softmax over the average gives the class.
Vectors and output are trained with numpy stochastic gradient descent on a
bounded sample of labelled rows; scoring runs over all rows in tasks.

Scoring folds the output into the vectors: with the softmax's two columns
subtracted, a document's log-odds are the average of one number per feature, so
a task holds one number per bucket and makes a few array passes over the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .arrow import map_arrow

#: Training reads at most this many labelled rows, and this many of their features in all.
MAX_ROWS = 6_000
MAX_FEATURES = 16_000_000
BUCKET_BITS = 18
NGRAMS = (3, 4)
DIMENSIONS = 8
EPOCHS = 8
RATE = 4.0
SLICE = 1 << 20      # code points hashed at once

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x100000001B3
_POWERS = np.array([pow(_STEP, i, 1 << 64) for i in range(512)], np.uint64)
_AGAIN = np.uint64(0x5851F42D4C957F2D)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(codes: np.ndarray, begins: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(positions, buckets)`` lists of the features of texts given as code points,
    each of which starts and ends with white space; ``begins`` is where they do
    (one text unless given).  Positions are where a feature begins."""
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    c = np.where(blank, 32, codes).astype(np.uint64)
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if not len(starts):
        return []
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    within = np.arange(len(c)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(c)]])))
    mixed = np.where(blank, np.uint64(0), (c + np.uint64(1)) * _POWERS[within % len(_POWERS)])
    words = np.add.reduceat(mixed, starts) + (ends - starts).astype(np.uint64) * _AGAIN
    out = [(starts, _bucket(words))]
    again = words[1:] == words[:-1]
    if begins is not None:
        text = np.searchsorted(begins, starts, side="right")
        again &= text[1:] == text[:-1]
    same = starts[1:][again]
    out.append((same, np.full(len(same), int(_bucket(np.array([_AGAIN]))[0]))))
    for n in NGRAMS:
        m = len(c) - n + 1
        if m <= 0:
            continue
        inner = blank[1:1 + m].copy()
        for k in range(2, n - 1):
            inner |= blank[k:k + m]
        at = np.flatnonzero(~inner)                      # borders may only be first or last
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(_STEP) + c[at + k]
        out.append((at, _bucket(h)))
    return out


def slices(text: str):
    """The text as arrays of code points, each between white space, cut at white
    space after ``SLICE`` code points; no feature reaches over white space but
    the repeat of a word, which a cut leaves out."""
    codes = np.frombuffer(f"\n{text}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
    at = 0
    while at < len(codes):
        to = len(codes)
        if to - at > SLICE:
            tail = codes[at + SLICE:]
            gaps = np.flatnonzero((tail == 32) | ((tail >= 9) & (tail <= 13)))
            to = at + SLICE + int(gaps[0]) + 1
        yield codes[at:to]
        if to == len(codes):
            return
        at = to - 1


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    total = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for codes in slices(text):
        found = [b for _, b in features(codes)]
        if found:
            buckets, n = np.unique(np.concatenate([total[0], *found]), return_inverse=True)
            weights = np.concatenate([total[1], np.ones(len(n) - len(total[0]), np.int64)])
            total = buckets, np.bincount(n, weights).astype(np.int64)
    return total


@dataclass
class Model:
    """Log-odds per bucket and their offset."""

    weight: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        """Chance of label 1 per text; a text without words gets that of the offset alone."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        part, owner, size = [], [], 0

        def add():
            codes = np.concatenate(part)
            begins = np.cumsum([0] + [len(p) for p in part[:-1]])
            points, number = np.zeros(len(codes) + 1), np.zeros(len(codes) + 1)
            for at, buckets in features(codes, begins):
                points[:-1] += np.bincount(at, self.weight[buckets], len(codes))
                number[:-1] += np.bincount(at, minlength=len(codes))
            np.add.at(total, owner, np.add.reduceat(points, begins))
            np.add.at(count, owner, np.add.reduceat(number, begins))

        for i, text in enumerate(texts):
            for codes in slices(text):
                if part and size + len(codes) > SLICE:
                    add()
                    part, owner, size = [], [], 0
                part.append(codes)
                owner.append(i)
                size += len(codes)
        if part:
            add()
        odds = self.bias + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], dimensions: int = DIMENSIONS, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 7) -> Model:
    """Stochastic gradient descent over ``(label, buckets, counts)``, one document a step."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / dimensions, 1 / dimensions, (1 << BUCKET_BITS, dimensions)).astype(np.float32)
    output = np.zeros((dimensions, 2), np.float32)
    ones = sum(label for label, *_ in rows)
    prior = np.log((ones + 1) / (len(rows) - ones + 1))
    offset = np.array([0, prior], np.float32)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            label, buckets, n = rows[i]
            now, done = rate * (1 - done / steps), done + 1
            if not len(buckets):
                continue
            share = (n / n.sum()).astype(np.float32)
            hidden = share @ vectors[buckets]
            raw = hidden @ output + offset
            p = np.exp(raw - raw.max())
            p /= p.sum()
            p[label] -= 1                                     # gradient of the loss by the raw output
            vectors[buckets] -= now * share[:, None] * (output @ p)[None, :]
            output -= now * 0.1 * np.outer(hidden, p)
            offset -= now * 0.01 * p
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float64), float(offset[1] - offset[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    usable: Column, max_rows: int = MAX_ROWS) -> DataFrame:
    """``label, order, size, text, buckets, n`` (``text`` is its hash) of at most ``max_rows``
    labelled ids, smallest id hashes first; rows with one id and text count once."""
    spark = docs.sparkSession
    key = F.col(f"`{id_col}`")
    chosen = (labels.filter(usable & key.isNotNull() & F.col(label_col).isin(0, 1))
              .select(key.alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
              .withColumn("order", F.xxhash64("id")).orderBy("order", "id", "label").limit(max_rows))
    texts = docs.select(key.alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), "id")                                  # max_rows rows are broadcast
    joined = joined.select("id", "label", "order", "text").distinct().select("label", "order", "text")

    def run(batches):
        for b in batches:
            made = [counted(t) for t in b.column(2).to_pylist()]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x[0]) for x in made], pa.int64()), b.column(3),
                 pa.array([x[0].astype(np.int32) for x in made], kind),
                 pa.array([x[1].astype(np.int32) for x in made], kind)],
                names=["label", "order", "size", "text", "buckets", "n"])

    path = scratch_path(spark, "classifier-sample")
    schema = "label INT, order BIGINT, size BIGINT, text BIGINT, buckets ARRAY<INT>, n ARRAY<INT>"
    map_arrow(joined.withColumn("hash", F.xxhash64("text")), run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> Model:
    """A model from the labelled rows for which ``usable`` (a condition on ``labels``) holds.

    At most ``max_rows`` rows and ``max_features`` features are brought to the
    driver, the first by id hash, label, size and text hash, however many texts an
    id has; equal rows count once.  Labels other than 0 and 1, null labels and null ids are left out; an
    id with both labels counts with both.  Without any row the score is 0.5."""
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, usable, max_rows)
    place = ["order", "label", "size", "text"]
    total, last = 0, None
    for r in sample.select(*place).orderBy(*place).limit(max_rows).collect():
        total += r["size"]
        if total > max_features:
            break
        last = r
    if last is None:
        return Model(np.zeros(1 << BUCKET_BITS), 0.0)
    table = (sample.filter(F.struct(*place) <= F.struct(*[F.lit(v).cast(sample.schema[c].dataType) for c, v in zip(place, last)]))
             .orderBy(*place)
             .select("label", "buckets", "n").toArrow().combine_chunks())
    if not table.num_rows:
        return Model(np.zeros(1 << BUCKET_BITS), 0.0)
    columns = [table.column(i).chunk(0) for i in range(3)]
    ends = columns[1].offsets.to_numpy()
    buckets, n = (c.flatten().to_numpy() for c in columns[1:])
    return train([(label, buckets[a - ends[0]:z - ends[0]], n[a - ends[0]:z - ends[0]])
                  for label, a, z in zip(columns[0].to_pylist(), ends[:-1], ends[1:])])


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` plus ``out_col DOUBLE``, the chance of label 1, from the whole text.

    Null and empty texts get the model's offset.  Rows are scored one by one, so
    ties, repeated rows and nulls elsewhere change nothing; an empty table stays
    empty.  ``out_col`` must not be a column already."""
    if out_col in docs.columns:
        raise ValueError(f"column {out_col} is there already")
    known = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))  # one number per bucket
    at = docs.columns.index(text_col)

    def run(batches):
        own = Model(*known.value)
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.score(texts), pa.float64())],
                                             names=[*b.schema.names, out_col])

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())]))
