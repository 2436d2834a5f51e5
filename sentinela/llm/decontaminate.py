"""Benchmark decontamination over a distributed positional inverted index.

The index holds the postings of every training token: per segment of documents
and term, the sorted positions at which the term stands, as Parquet in the
shared folder.  A segment is a run of documents of about ``SEGMENT_BYTES`` of
text in one position space, so the list of a term that all documents share is
cut into one bounded list a segment, and a document or term that is very
frequent stays spread over tasks.  The index knows nothing of a benchmark: it is
made once and searched for any number of them.

A search reads only the lists of the benchmark's terms and groups them by
segment.  There each window starts from its rarest term: that list less the
term's offset gives the candidate starts, and the next rarer terms'
offset-adjusted lists are intersected with them until only exact phrases (or,
with ``slop``, phrases whose words are shifted by at most that much) remain.

The benchmark is taken in blocks of at most ``block_words`` words, so what the
tasks and the driver hold of it is bounded; each block is one search.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import passes_columns
from ..session import scratch_path
from .arrow import lists, map_arrow, ship, utf8, WORD_TABLE

WINDOW = 10
BLOCK_WORDS = 1_000_000
SEGMENT_BYTES = 8 << 20    # text of one segment; one document may hold more
SPACE = 64                 # free positions after each document: no phrase reaches over them
CANDIDATES = 1 << 20       # candidate starts held at once
RUN = "struct<begin:int,finish:int>"
_INTS = pa.list_(pa.int32())


@dataclass
class Windows:
    """Distinct windows of one length, as term numbers, with the items they come from."""

    terms: np.ndarray          # windows x length
    item_from: np.ndarray      # CSR: items of window i are items[item_from[i]:item_from[i + 1]]
    items: np.ndarray


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


def windows_of(items: list[tuple[int, list[int]]], size: int) -> list[Windows]:
    """Group the windows of ``(item number, term numbers)`` by length."""
    tokens = np.array([t for _, terms in items for t in terms], np.int32)
    owner = np.array([item for item, _ in items], np.int64)
    lengths = np.array([len(terms) for _, terms in items], np.int64)
    begins, widths = np.cumsum(lengths) - lengths, np.minimum(lengths, size)
    out = []
    for n in np.unique(widths[widths > 0]).tolist():
        own = np.flatnonzero(widths == n)
        many = lengths[own] - n + 1
        starts = np.repeat(begins[own], many) + _within(many)
        distinct, which = np.unique(tokens[starts[:, None] + np.arange(n)], axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.repeat(owner[own], many)], axis=1), axis=0)
        out.append(Windows(distinct, np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1]))
    return out


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive groups of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def invert(texts: list[bytes]):
    """``(terms, counts, steps, sizes, begins)`` of one segment, given texts in which only
    spaces part words: each term's positions as steps from one to the next, term after
    term, and every document's words and first position.  The first term is empty; its
    positions are where the documents begin, and the end of the last."""
    parts = pc.split_pattern(pa.array(texts, pa.large_binary()), pattern=b" ")
    flat = parts.flatten()
    word = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(word.to_numpy(zero_copy_only=False))])
    sizes = np.diff(before[parts.offsets.to_numpy()])
    begins = np.cumsum(sizes + SPACE) - (sizes + SPACE)
    coded = flat.filter(word).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    places = _within(sizes) + np.repeat(begins, sizes)
    keys = np.sort((codes << 32) | places)
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    edge = np.append(begins, begins[-1] + sizes[-1] + SPACE)
    counts = np.concatenate([[len(edge)], counts])
    places = np.concatenate([edge, keys & 0xFFFFFFFF])
    steps = np.diff(places, prepend=0)
    first = np.cumsum(counts) - counts
    steps[first] = places[first]
    terms = pa.chunked_array([pa.array([b""], pa.binary()), coded.dictionary.cast(pa.binary())]).combine_chunks()
    return terms, counts, steps, sizes, begins


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The index of all rows of ``docs``, kept in the shared folder, in segments that are
    closed once they hold ``segment_bytes`` of text.

    Posting rows ``segment, term, n, steps`` (``n`` positions as steps from one to the
    next; the empty term's are the documents' begins) and document rows ``segment,
    begin, id, t1, t2, n_words``; the columns of the other kind are null.  ``t1, t2``
    hash the text.  Null and empty texts are documents of no words."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("t1"),
                       F.xxhash64(text, F.lit(1)).alias("t2"), text.alias("text"))

    def segment(number, texts, own):
        terms, counts, steps, sizes, begins = invert(texts)
        n, d = len(terms), len(texts)
        ids = pa.Table.from_batches(own).combine_chunks().to_batches()[0]
        none = [pa.nulls(n, kind) for kind in (ids.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.int32())]
        names = ["segment", "term", "n", "steps", "id", "t1", "t2", "n_words", "begin"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), terms, pa.array(counts, pa.int32()),
             lists(np.concatenate([[0], np.cumsum(counts)]), steps, pa.int32()), *none], names=names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d, number)), pa.nulls(d, pa.binary()), pa.nulls(d, pa.int32()), pa.nulls(d, _INTS),
             ids.column(0), ids.column(1), ids.column(2), pa.array(sizes, pa.int64()), pa.array(begins, pa.int32())],
            names=names)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        texts, own, held = [], [], 0
        for b in batches:
            at = 0
            for i, t in enumerate(utf8(b.column(3))):
                texts.append(t.translate(WORD_TABLE))
                held += len(t)
                if held >= segment_bytes:
                    own.append(b.slice(at, i + 1 - at).select([0, 1, 2]))
                    yield from segment(number, texts, own)
                    number, at, texts, own, held = number + 1, i + 1, [], [], 0
            if at < b.num_rows:
                own.append(b.slice(at).select([0, 1, 2]))
        if texts:
            yield from segment(number, texts, own)

    schema = T.StructType([
        T.StructField("segment", T.LongType()), T.StructField("term", T.BinaryType()), T.StructField("n", T.IntegerType()),
        T.StructField("steps", T.ArrayType(T.IntegerType())),
        *[T.StructField(f.name, f.dataType) for f in rows.schema.fields[:3]],
        T.StructField("n_words", T.LongType()), T.StructField("begin", T.IntegerType())])
    path = scratch_path(docs.sparkSession, "positional-index")
    map_arrow(rows, run, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def look_up(keys: np.ndarray, span: int, first: np.ndarray, group: Windows, slop: int = 0):
    """``(starts, window numbers, places of the rarest term)`` of all phrase matches in a
    segment; a start is where the window's first word is due.  ``keys`` are its sorted
    postings, ``term * span + position``, and ``first`` is where each term's begin."""
    sizes = np.diff(first)
    here = np.flatnonzero((sizes[group.terms] > 0).all(axis=1))
    order = np.argsort(sizes[group.terms[here]], axis=1, kind="stable")       # rarest term first
    rarest = np.take_along_axis(group.terms[here], order[:, :1], axis=1)[:, 0].astype(np.int64)
    fan = sizes[rarest]
    ends = np.cumsum(fan)
    none = np.zeros(0, np.int64)
    found, lo = [(none, none, none)], 0
    while lo < len(here):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + CANDIDATES, side="right")))
        n = fan[lo:hi]
        win = np.repeat(np.arange(lo, hi), n)
        place = keys[np.repeat(first[rarest[lo:hi]], n) + _within(n)] - rarest[win] * span
        start = place - order[win, 0]
        for k in range(1, group.terms.shape[1]):
            offset = order[win, k]
            due = group.terms[here[win], offset].astype(np.int64) * span + start + offset
            at = np.minimum(np.searchsorted(keys, due - slop), len(keys) - 1)
            ok = np.abs(keys[at] - due) <= slop
            start, win, place = start[ok], win[ok], place[ok]
        found.append((start, here[win], place))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*found))


def hits_in(number: np.ndarray, ends: np.ndarray, steps: np.ndarray, groups: list[Windows], slop: int):
    """Of one segment: ``(begins of its documents, hit runs, items)``, the last two as rows of
    (document, begin, finish) and (document, item number), from lists of term ``number``
    (0: the documents' begins)."""
    whole, sizes = np.cumsum(steps, dtype=np.int64), np.diff(ends)
    places = whole - np.repeat(np.concatenate([[0], whole])[ends[:-1]], sizes)
    edge = np.sort(places[np.repeat(number == 0, sizes)])
    begins, stops = edge[:-1], edge[1:] - SPACE
    span = int(edge[-1]) + slop + max((g.terms.shape[1] for g in groups), default=0) + 1
    keys = np.sort(np.repeat(number.astype(np.int64), sizes) * span + places)
    last = max((int(g.terms.max()) for g in groups), default=0)
    first = np.searchsorted(keys, np.arange(last + 2) * span)
    change, owner = np.zeros(int(edge[-1]) + 1, np.int32), [np.zeros((0, 2), np.int64)]
    for g in groups:
        starts, win, place = look_up(keys, span, first, g, slop)
        doc = np.searchsorted(begins, place, side="right") - 1
        np.add.at(change, np.maximum(starts, begins[doc]), 1)
        np.add.at(change, np.minimum(starts + g.terms.shape[1], stops[doc]), -1)
        n = np.diff(g.item_from)[win]
        owner.append(np.stack([np.repeat(doc, n), g.items[np.repeat(g.item_from[win], n) + _within(n)]], axis=1))
    step = np.diff((np.cumsum(change[:-1]) > 0).astype(np.int8), prepend=0, append=0)
    run_from, run_to = np.flatnonzero(step > 0), np.flatnonzero(step < 0)
    doc = np.searchsorted(begins, run_from, side="right") - 1
    return begins, np.stack([doc, run_from - begins[doc], run_to - begins[doc]], axis=1), np.unique(np.concatenate(owner), axis=0)


def search(index: DataFrame, block: list[tuple[str, list[bytes]]], window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``segment, begin, runs, items`` of the documents in which a window of ``block``
    (item names and their words) occurs: the maximal runs of hit word positions (begin
    inclusive, finish exclusive) and the sorted names of the items."""
    if 2 * slop + 1 > SPACE:
        raise ValueError(f"slop must be below {SPACE // 2}")
    spark = index.sparkSession
    words = sorted({w for _, ws in block for w in ws})
    vocabulary = {w: i for i, w in enumerate(words, 1)}                        # 0 is the empty term
    names = sorted({name for name, _ in block})
    number = {name: i for i, name in enumerate(names)}
    groups = windows_of([(number[name], [vocabulary[w] for w in ws]) for name, ws in block], window)
    plan = spark.sparkContext.broadcast((groups, names))                       # at most block_words words
    terms = spark.createDataFrame(pa.table({"term": pa.array([b"", *words], pa.binary()),
                                            "number": pa.array(range(len(words) + 1), pa.int32())}))
    schema = f"segment BIGINT, begin INT, runs ARRAY<{RUN}>, items ARRAY<STRING>"

    def run(table: pa.Table) -> pa.Table:
        groups, names = plan.value
        own = table.combine_chunks()
        rows = own.column("steps").combine_chunks()
        ends = rows.offsets.to_numpy()
        begins, found, pairs = hits_in(own.column("number").to_numpy(), ends - ends[0], rows.flatten().to_numpy(), groups, slop)
        runs, items = {}, {}
        for d, a, z in found.tolist():
            runs.setdefault(d, []).append({"begin": a, "finish": z})
        for d, i in pairs.tolist():
            items.setdefault(d, []).append(names[i])
        docs = sorted(items)
        return pa.table({
            "segment": pa.array([own.column("segment")[0].as_py()] * len(docs), pa.int64()),
            "begin": pa.array(begins[np.array(docs, np.int64)], pa.int32()),
            "runs": pa.array([runs.get(d, []) for d in docs], pa.list_(pa.struct([("begin", pa.int32()), ("finish", pa.int32())]))),
            "items": pa.array([sorted(items[d]) for d in docs], pa.list_(pa.string()))})

    ship(spark)
    return (index.filter("term IS NOT NULL").join(F.broadcast(terms), "term").select("segment", "number", "steps")
            .groupBy("segment").applyInArrow(run, schema))


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, block_words: int, window: int = WINDOW):
    """Lists of ``(name, words)`` of at most ``block_words`` words each (one window at least),
    read item by item: the driver holds one item's text and one block.  A longer item is
    taken in pieces that share ``window - 1`` words, so each of its windows is in one."""
    block, words = [], 0
    rows = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"),
                            F.col(f"`{text_col}`").cast("string").alias("text"))
    for r in rows.toLocalIterator():
        whole = words_of((r["text"] or "").encode())
        size = max(block_words, window)
        for at in range(0, max(1, len(whole) - window + 1), size - window + 1):
            own = whole[at:at + size]
            if block and words + len(own) > block_words:
                yield block
                block, words = [], 0
            if own:
                block.append((r["item"], own))
                words += len(own)
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, slop: int = 0) -> DataFrame:
    """``id, t1, t2, n_words, runs, items`` per row of ``docs``: hit word runs and
    the items (as sorted strings) whose windows occur.

    Words are those of the text with A-Z lower-cased, cut at every other ASCII
    character; a null or empty text has none.  An item of fewer words than a
    window is one window; an item without words has none; a null item id is the
    empty string; repeated items and windows count once.  ``t1, t2`` hash the
    text, so a caller can tell rows with one id apart.  An empty benchmark hits
    nothing; empty documents give an empty table.  Other columns are not read."""
    index = build_index(docs, id_col, text_col)
    found = [search(index, block, window, slop)
             for block in blocks_of(benchmark, item_col, item_text_col, block_words, window) if block]
    own = index.filter("n_words IS NOT NULL").select("segment", "begin", "id", "t1", "t2", "n_words")
    empty_runs, empty_items = F.array().cast(f"array<{RUN}>"), F.array().cast("array<string>")
    if not found:
        return own.select("id", "t1", "t2", "n_words", empty_runs.alias("runs"), empty_items.alias("items"))
    hits = found[0]
    if len(found) > 1:
        spots = F.array_sort(F.array_distinct(F.flatten(F.transform(
            F.flatten(F.collect_list("runs")), lambda r: F.sequence(r["begin"], r["finish"] - 1)))))
        hits = reduce(DataFrame.unionByName, found).groupBy("segment", "begin").agg(
            F.transform(spots, lambda p: F.struct(p.alias("begin"), (p + 1).alias("finish"))).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return (own.join(hits, ["segment", "begin"], "left")
            .select("id", "t1", "t2", "n_words", F.coalesce("runs", empty_runs).alias("runs"),
                    F.coalesce("items", empty_items).alias("items")))


@passes_columns
def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that no benchmark window occurs in, with their columns as they were.

    Null and empty texts hold none and stay; repeated rows stay or go together; an
    empty table or benchmark changes nothing.  Extra columns may have any names."""
    text = F.col(f"`{text_col}`").cast("string")
    hit = (contamination(docs, benchmark, id_col, text_col, item_col, item_text_col, window)
           .filter(F.size("items") > 0).select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2")).distinct())
    path = scratch_path(docs.sparkSession, "contaminated-texts")
    hit.write.parquet(path)
    hit = docs.sparkSession.read.schema("__t1 BIGINT, __t2 BIGINT").parquet(path)
    return docs.join(hit, (F.xxhash64(text) == hit["__t1"]) & (F.xxhash64(text, F.lit(1)) == hit["__t2"]), "left_anti")
