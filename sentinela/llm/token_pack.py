"""Token-id output: texts to ids, packed into rows of a fixed length.

Rows of documents are spread by a hash of id and text into groups of about
``group_bytes`` of text; each group is sorted by size in Spark, read as a stream,
tokenized and packed best-fit-decreasing.  A document longer than a row is cut
losslessly: whole rows first, the rest is packed like any other segment.  The
bin with the least sufficient room is found in a segment tree over room sizes,
so a segment costs two walks of the tree however many bins are open.  A group
that outgrows its size (many equal rows) is packed in several goes, so a task
holds a bounded number of tokens besides the longest single document.

Every packed row has its ids as little-endian 16-bit numbers, the cumulative
segment lengths, and position numbers that start again at 0 in every segment.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import broadcast_if_small
from ..operators.partitions import pin
from .arrow import map_arrow

SEQ_LEN = 2048
GROUP_BYTES = 8 << 20
ROW_BYTES = 64             # counted for a row besides its text where copies crowd a group
#: Reducers there are at most, however many groups.
MAX_TASKS = 20_000
#: Tokens held before they are packed, whatever the group.
HOLD_TOKENS = 1 << 23
END_ID = 50256           # the id the rank file leaves free: ends every document, fills every row
WORD_GAP = re.compile(r"(?<=\S) (?=\S)")
SLICE = 1 << 20
LONG = 10_000            # characters of white space that make a run too long for the pattern
# The characters of the Unicode property White_Space.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_BLANK = re.compile(f"[{BLANK}]{{{LONG},}}")
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class RankTokenizer:
    """Byte-level BPE of a rank file.

    No piece of the pattern reaches over a single space between two characters
    that are not white space, so a very long text is cut there and encoded in
    slices without changing an id."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text as 16-bit numbers.

        A very long run of white space would overflow the pattern matcher's stack.
        It is one piece, but for its last character where a word follows, so it is
        taken out and merged without the pattern."""
        out, at = [np.zeros(0, "<u2")], 0
        for run in LONG_BLANK.finditer(text) if len(text) >= LONG else ():
            to = run.end() - (run.end() < len(text))
            out += self._slices(text[at:run.start()])
            out.append(np.array(self.encoding._encode_single_piece(text[run.start():to]), "<u2"))
            at = to
        out += self._slices(text[at:])
        return np.concatenate(out)

    def _slices(self, text: str) -> list[np.ndarray]:
        out, at = [], 0
        while at < len(text):
            gap = WORD_GAP.search(text, at + SLICE) if len(text) - at > SLICE else None
            to = gap.start() if gap else len(text)
            out.append(self.encoding.encode_to_numpy(text[at:to], disallowed_special=()).astype("<u2"))
            at = to
        return out


_LOADED: dict[bytes, RankTokenizer] = {}


def _loaded(ranks: bytes) -> RankTokenizer:
    """One tokenizer per worker process, not per task."""
    key = hashlib.sha256(ranks).digest()
    if key not in _LOADED:
        _LOADED[key] = RankTokenizer(ranks)
    return _LOADED[key]


class RoomTree:
    """Open bins by their room (0 to ``size``): a segment tree over room sizes
    whose nodes count the bins below them."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """``(bin, room)`` of a bin with the least room of at least ``need``, removed; None if there is none."""
        node = need + self.width
        if need >= self.width:
            return None
        while not self.count[node]:
            while node & 1:                # a right child: nothing further right under this parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.width:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.width
        self._change(room, -1)
        return self.bins[room].pop(), room


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Indexes of ``lengths`` (each 1 to ``size``) by bin: longest first, ties in
    order, each into the open bin with the least sufficient room, else a new one."""
    tree, bins = RoomTree(size), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        number, room = found or (len(bins), size)
        if found is None:
            bins.append([])
        bins[number].append(i)
        if room > lengths[i]:
            tree.put(room - lengths[i], number)
    return bins


def segments(n: int, size: int) -> list[tuple[int, int]]:
    """``(begin, end)`` of the pieces of a document of ``n`` tokens: whole rows, then the rest."""
    return [(a, min(a + size, n)) for a in range(0, n, size)]


def grouped(docs: DataFrame, id_col: str, text_col: str, group_bytes: int) -> DataFrame:
    """``grp, id, text`` in ``grp`` order within partitions, longest texts first.

    Copies of one row whose bytes exceed a group's are dealt over so many groups."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    sizes = (rows.groupBy(F.xxhash64("id", "text").alias("key"))
             .agg(F.count("*").alias("copies"), F.sum(F.octet_length("text")).alias("n"),
                  F.sum(F.octet_length("text") + ROW_BYTES).alias("weight")))
    # the crowds stay a table, at most one row for each group_bytes; the total is seen as they are written
    seen = Observation()
    crowds = pin(sizes.observe(seen, F.sum("n").alias("total"))
                 .filter((F.col("copies") > 1) & (F.col("weight") > group_bytes))
                 .select(F.col("key").alias("crowd"), F.ceil(F.col("weight") / group_bytes).alias("parts")))
    groups = max(1, -(-(seen.get["total"] or 0) // group_bytes))
    key = F.xxhash64("id", "text")
    if not crowds.isEmpty():
        rows = rows.join(broadcast_if_small(crowds), key == F.col("crowd"), "left")
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("parts"))
        key = F.when(F.col("parts").isNull(), key).otherwise(F.xxhash64("id", "text", part))
    return (rows.withColumn("grp", F.pmod(key, F.lit(groups)).cast("int"))
            .repartition(min(groups, MAX_TASKS), "grp")     # a task packs its groups one after the other
            .sortWithinPartitions("grp", F.octet_length("text").desc(), "id", F.xxhash64("text"))
            .select("grp", "id", "text"))


def pack(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
         seq_len: int = SEQ_LEN, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per packed sequence: ``grp, row, n_tokens, n_segments, ids BINARY,
    cu_seqlens ARRAY<INT>, positions BINARY, doc_ids ARRAY, doc_offsets ARRAY<INT>``.

    ``ids`` and ``positions`` hold ``seq_len`` little-endian 16-bit numbers, so
    the rows of a group stacked are its id matrix; room at the end holds the end
    id with position 0.  ``cu_seqlens`` runs from 0 to ``n_tokens``; segment i is
    tokens ``doc_offsets[i]`` on of document ``doc_ids[i]``, whose last token is
    the end id.  Null and empty texts are that one token.  Null ids and repeated
    rows are packed like others; an empty table gives an empty result.  Other
    columns are not read."""
    if not 1 <= seq_len <= 65535:
        raise ValueError("seq_len must be 1 to 65535")
    spark = docs.sparkSession
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())   # a fixed vocabulary, under 1 MB
    rows = grouped(docs, id_col, text_col, group_bytes)
    id_type = rows.schema["id"].dataType
    names = ["grp", "row", "n_tokens", "n_segments", "ids", "cu_seqlens", "positions", "doc_ids", "doc_offsets"]

    def flush(grp, first_row, held, id_kind):
        parts = [(i, a, z) for i, (_, ids) in enumerate(held) for a, z in segments(len(ids), seq_len)]
        bins = best_fit([z - a for _, a, z in parts], seq_len)
        for lo in range(0, len(bins), 256):
            out = {n: [] for n in names}
            for k, members in enumerate(bins[lo:lo + 256], lo):
                sizes = [parts[m][2] - parts[m][1] for m in members]
                ids = np.full(seq_len, END_ID, "<u2")
                places = np.zeros(seq_len, "<u2")
                at = 0
                for m, n in zip(members, sizes):
                    doc, a, z = parts[m]
                    ids[at:at + n] = held[doc][1][a:z]
                    places[at:at + n] = np.arange(n, dtype="<u2")
                    at += n
                made = (grp, first_row + k, at, len(members), ids.tobytes(), np.cumsum([0, *sizes]).tolist(),
                        places.tobytes(), [held[parts[m][0]][0] for m in members], [parts[m][1] for m in members])
                for n, v in zip(names, made):
                    out[n].append(v)
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(),
                     pa.list_(id_kind), pa.list_(pa.int32())]
            yield len(bins), pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(names, kinds)], names=names)

    def run(batches):
        model, grp, held, tokens, row = _loaded(ranks.value), None, [], 0, 0
        end = np.array([END_ID], "<u2")
        id_kind = pa.int64()
        for b in batches:
            id_kind = b.column(1).type
            for g, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if held and (g != grp or tokens >= HOLD_TOKENS):
                    n = 0
                    for n, made in flush(grp, row, held, id_kind):
                        yield made
                    row, held, tokens = row + n, [], 0
                if g != grp:
                    grp, row = g, 0
                ids = np.concatenate([model.encode(text), end])
                held.append((key, ids))
                tokens += len(ids)
        for _, made in flush(grp, row, held, id_kind) if held else ():
            yield made

    schema = T.StructType([
        T.StructField("grp", T.IntegerType()), T.StructField("row", T.LongType()),
        T.StructField("n_tokens", T.IntegerType()), T.StructField("n_segments", T.IntegerType()),
        T.StructField("ids", T.BinaryType()), T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("positions", T.BinaryType()), T.StructField("doc_ids", T.ArrayType(id_type)),
        T.StructField("doc_offsets", T.ArrayType(T.IntegerType()))])
    return map_arrow(rows, run, schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet, one folder per write; rows keep their group's order in a file."""
    packed.write.mode("errorifexists").parquet(path)
