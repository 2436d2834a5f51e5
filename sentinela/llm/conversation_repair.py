"""Repair of conversations: the cheapest edits that give them a legal order of roles.

A conversation is a lattice: one layer before each of its rows and one after the
last, four nodes a layer for what the kept text ends with (nothing, ``s``, ``u``,
``a``).  Arcs are edits with whole costs: keep, rerole and delete lead to the next
layer, an insert stays in its layer.  The shortest path is found by auction: a path
grows from the origin; where the price of its last node is below the best arc's
cost plus the price at its other end, the price rises to that and the path
contracts by one node, else it extends along that arc.  At the end the prices are
dual optimal, every arc of every shortest path is tight, and the tight arcs are
traced from the origin, the ASCII-least letter first.

The lattice is worked from its end in blocks of ``BLOCK`` layers, whose last layer
has the prices of the block behind it, so the work is linear in the rows.
A conversation of more than ``SEGMENT`` rows is split: every segment's lattice gives
the distances between its end nodes, one row of 16 numbers a segment is chained per
conversation, and the segments are traced apart.  Only one symbol a row enters a
lattice, never a text.  The repaired text is hashed as it streams by, in order.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rows import row_index
from ..session import scratch_path
from .arrow import map_arrow, ship

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Nodes of a layer: nothing kept yet, then what was kept last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a node's next user or assistant leads.
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "x": {}}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Prices behind the last row: a text may end empty or after an assistant, else inserts complete it.
_ENDS = (0, 2 * INSERT, INSERT, 0)

#: Layers that one auction spans at most.
BLOCK = 32
#: Rows of a segment.
SEGMENT = 4096


def _arcs() -> dict[str, list[tuple]]:
    """Per row symbol and node: ``(letter, cost, next node)`` in ASCII order of the letters.

    Symbols are the role's initial (``x``: none of s, u, a), upper case for a
    truncated row, and ``d`` for one that must go."""
    out = {"d": [(("D", DELETE, n),) for n in range(4)]}
    for role, kept in _KEPT.items():
        for symbol, more in ((role, 0), (role.upper(), TRUNCATED)):
            out[symbol] = [(("D", DELETE, n), *((("K", KEEP + more, kept[n]),) if n in kept else ()),
                            ("R", REROLE + more, _NEXT[n])) for n in range(4)]
    return out


_ARCS = _arcs()


def _auction(symbols: str, begin: int, end: int, prices: list, origin: int, open_: tuple) -> None:
    """Raise ``prices`` (four a layer) until those of node ``origin`` of layer ``begin``
    are its distance; layer ``end`` holds final prices.  None is no way on."""
    path = [(begin, origin)]
    while path[-1][0] < end:
        layer, node = path[-1]
        best, way = None, None
        for _, cost, to in _ARCS[symbols[layer]][node]:
            price = prices[4 * layer + 4 + to]
            if open_[to] and price is not None and (best is None or cost + price < best):
                best, way = cost + price, (layer + 1, to)
        to = _NEXT[node]
        price = prices[4 * layer + to]
        if open_[to] and price is not None and (best is None or INSERT + price < best):
            best, way = INSERT + price, (layer, to)
        if best is None or prices[4 * layer + node] < best:
            prices[4 * layer + node] = best
            if len(path) > 1:
                path.pop()
            elif best is None:
                return
        else:
            path.append(way)


def _prices(symbols: str, ends: tuple, first: tuple) -> tuple[list, tuple]:
    """Prices of all layers, those of block borders and of the ``first`` nodes being
    distances, and which nodes are open (lead to an end at all)."""
    n = len(symbols)
    last = max(i for i in range(4) if ends[i] is not None)
    # after a user there is a way to any later node; START and SYSTEM are never entered again
    open_ = (True, True, True, True) if last >= USER else tuple(i <= last for i in range(4))
    prices = [None] * (4 * n) + list(ends)
    end = n
    while end:
        begin = max(0, end - BLOCK)
        low = min(p for p in prices[4 * end:4 * end + 4] if p is not None)
        prices[4 * begin:4 * end] = [low if open_[i % 4] else None for i in range(4 * (end - begin))]
        for node in (range(4) if begin else first):
            if open_[node]:
                _auction(symbols, begin, end, prices, node, open_)
        end = begin
    return prices, open_


def _trace(symbols: str, prices: list, open_: tuple, node: int) -> tuple[str, int, int]:
    """Letters of the ASCII-least shortest path from ``node``, its cost and the node it ends at."""
    n, letters, total = len(symbols), [], 0
    layer = 0
    while layer < n:
        end = layer + ((n - layer) % BLOCK or BLOCK)  # blocks are counted from the last layer
        good = [[p is not None for p in prices[4 * end:4 * end + 4]]]
        for at in range(end - 1, layer - 1, -1):
            price, ahead, behind = prices[4 * at:4 * at + 4], prices[4 * at + 4:4 * at + 8], good[-1]
            here = [open_[i] and any(behind[to] and price[i] == cost + ahead[to] for _, cost, to in _ARCS[symbols[at]][i])
                    for i in range(4)]
            for _ in range(2):  # an insert leads to a node that may itself go on by an insert
                here = [here[i] or (open_[i] and here[_NEXT[i]] and price[i] == INSERT + price[_NEXT[i]]) for i in range(4)]
            good.append(here)
        good.reverse()
        begin = layer
        while layer < end:
            ways = [(letter, cost, layer + 1, to) for letter, cost, to in _ARCS[symbols[layer]][node]
                    if good[layer + 1 - begin][to] and prices[4 * layer + node] == cost + prices[4 * layer + 4 + to]]
            to = _NEXT[node]
            if open_[to] and good[layer - begin][to] and prices[4 * layer + node] == INSERT + prices[4 * layer + to]:
                ways.append(("I", INSERT, layer, to))
            letter, cost, layer, node = min(ways)
            letters.append(letter)
            total += cost
    return "".join(letters), total, node


def _closing(node: int) -> str:
    return "I" * (_ENDS[node] // INSERT)


@lru_cache(maxsize=1 << 14)
def repair_order(symbols: str) -> tuple[str, int]:
    """The audit of a whole conversation, given one symbol a row, and its cost."""
    prices, open_ = _prices(symbols, _ENDS, (START,))
    letters, total, node = _trace(symbols, prices, open_, START)
    return letters + _closing(node), total + _ENDS[node]


def _between(symbols: str) -> list:
    """Distances from every first to every last node of a segment (None: no way), row by row."""
    out = [[None] * 4 for _ in range(4)]
    for to in range(4):
        prices, open_ = _prices(symbols, tuple(0 if i == to else None for i in range(4)), (0, 1, 2, 3))
        for node in range(4):
            if open_[node] and (to >= USER or node <= to):
                out[node][to] = prices[node]
    return [x for line in out for x in line]


# ----------------------------------------------------------------- in Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the fixed damage: a twentieth of the rows each
    is dropped, emptied, loses its ``[.!?]``, is repeated, becomes a user's.  A null
    role or text is one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    held = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                                F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (held.filter("kind != 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                                                  .otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def judged(conversations: DataFrame, blank: str = r"[^\x20\x09-\x0D]") -> DataFrame:
    """``key, at, turn, role, text, fault, symbol``: rows in their order within a
    conversation, with their first fault.  ``key`` is never null."""
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))
    rows = conversations.select(key.alias("key"), "turn", "role", "text", F.sha2(
        F.concat_ws("\n", F.octet_length("role").cast("string"), "role", "text").cast("binary"), 256).alias("same"))
    rows = _kept(row_index(rows, ["turn", "role", "same"], ["key"], name="at"), "conversation-rows")
    # the first of equal rows; partial, so one hot text is one row a task
    again = (rows.groupBy("key", "same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select(F.col("key").alias("again_key"), F.col("same").alias("again_same"), "first"))
    met = rows.join(again, (F.col("key") == F.col("again_key")) & (F.col("same") == F.col("again_same")), "left")
    end = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (F.when(~F.col("text").rlike(blank), "blank").when(F.col("at") > F.col("first"), "duplicate")
             .when(~end.isin(".", "!", "?"), "truncated").otherwise(""))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    staged = met.select("key", "at", "turn", "role", "text", fault.alias("fault"), initial.alias("initial"))
    return staged.withColumn("symbol", F.when(F.col("fault").isin("blank", "duplicate"), "d")
                             .when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial")))


def _by_row(df: DataFrame, schema, function) -> DataFrame:
    def run(batches):
        for b in batches:
            made = [function(r) for r in b.to_pylist()]
            yield pa.RecordBatch.from_pylist(made, schema=wanted)
    from pyspark.sql.pandas.types import to_arrow_schema
    wanted = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    return map_arrow(df, run, schema)


def _chained(segments: DataFrame) -> DataFrame:
    """``key, segment, ends, node`` of the segments of split conversations: prices behind
    each and the node its trace begins at.  Per conversation one row of numbers a
    segment meets in a task, never rows or texts."""
    ship(segments.sparkSession)
    numbers = _by_row(segments, "key STRING, segment BIGINT, ways ARRAY<BIGINT>", lambda r: {
        "key": r["key"], "segment": r["segment"], "ways": _between(r["symbols"])})

    def backward(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
        ends, out = list(_ENDS), []
        for r in reversed(rows):
            out.append({"key": r["key"], "segment": r["segment"], "ends": ends})
            ways = [r["ways"][4 * i:4 * i + 4] for i in range(4)]
            ends = [min(w + e for w, e in zip(line, ends) if w is not None) for line in ways]
        return pa.Table.from_pylist(out, pa.schema([("key", pa.string()), ("segment", pa.int64()),
                                                    ("ends", pa.list_(pa.int64()))]))

    priced = numbers.groupBy("key").applyInArrow(backward, "key STRING, segment BIGINT, ends ARRAY<BIGINT>")
    priced = _kept(segments.join(priced, ["key", "segment"]), "conversation-prices")

    def leads(r):
        prices, open_ = _prices(r["symbols"], tuple(r["ends"]), (0, 1, 2, 3))
        return {"key": r["key"], "segment": r["segment"], "ends": r["ends"],
                "leads": [_trace(r["symbols"], prices, open_, i)[2] for i in range(4)]}

    led = _by_row(priced, "key STRING, segment BIGINT, ends ARRAY<BIGINT>, leads ARRAY<BIGINT>", leads)

    def forward(table: pa.Table) -> pa.Table:
        node, out = START, []
        for r in sorted(table.to_pylist(), key=lambda r: r["segment"]):
            out.append({"key": r["key"], "segment": r["segment"], "ends": r["ends"], "node": node})
            node = r["leads"][node]
        return pa.Table.from_pylist(out, pa.schema([("key", pa.string()), ("segment", pa.int64()),
                                                    ("ends", pa.list_(pa.int64())), ("node", pa.int64())]))

    return led.groupBy("key").applyInArrow(forward, "key STRING, segment BIGINT, ends ARRAY<BIGINT>, node BIGINT")


def audits(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``key, segment, letters, node, cost`` of all segments of ``size`` rows."""
    cut = rows.select("key", F.expr(f"at div {size}").alias("segment"), "at", "symbol")
    # at most ``size`` entries a group
    symbols = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "symbol"))), lambda e: e["symbol"]), "")
    segments = cut.groupBy("key", "segment").agg(symbols.alias("symbols"))
    split = rows.filter(F.col("at") == size).select(F.col("key").alias("split_key"))
    marked = _kept(segments.join(split, F.col("key") == F.col("split_key"), "left")
                   .select("key", "segment", "symbols", F.col("split_key").isNotNull().alias("split")), "conversation-segments")
    whole = _by_row(marked.filter("NOT split"), "key STRING, segment BIGINT, letters STRING, node BIGINT, cost BIGINT",
                    lambda r: dict(zip(("letters", "cost"), repair_order(r["symbols"])),
                                   key=r["key"], segment=r["segment"], node=START))
    long = marked.filter("split")
    chained = _chained(long.select("key", "segment", "symbols"))

    def piece(r):
        prices, open_ = _prices(r["symbols"], tuple(r["ends"]), (r["node"],))
        letters, cost, to = _trace(r["symbols"], prices, open_, r["node"])
        if r["is_last"]:
            letters, cost = letters + _closing(to), cost + _ENDS[to]
        return {"key": r["key"], "segment": r["segment"], "letters": letters, "node": r["node"], "cost": cost}

    ends = long.groupBy("key").agg(F.max("segment").alias("final"))
    pieces = _by_row(long.join(chained, ["key", "segment"]).join(ends, "key")
                     .select("key", "segment", "symbols", "ends", "node", (F.col("segment") == F.col("final")).alias("is_last")),
                     whole.schema, piece)
    return whole.unionByName(pieces)


class _Text:
    """The repaired text of one conversation, hashed as its rows come by."""

    def __init__(self, key: str):
        self.key, self.hash, self.lines, self.audit = key, hashlib.sha256(), 0, []
        self.before, self.illegal = None, 0
        self.letters, self.at, self.node = "", 0, START

    def add(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def inserts(self) -> None:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.node = _NEXT[self.node]
            self.add(_ROLE[self.node], "")
            self.at += 1

    def segment(self, letters: str, node: int) -> None:
        self.inserts()
        self.letters, self.at, self.node = letters, 0, node
        self.audit.append(letters)

    def row(self, role: str, text: str) -> None:
        initial = role[:1]
        if self.before is not None:
            self.illegal += (self.before + initial) not in ("su", "ua", "au")
        self.before = initial
        self.inserts()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.node = _KEPT[initial][self.node]
            self.add(role, text)
        elif letter == "R":
            self.node = _NEXT[self.node]
            self.add(_ROLE[self.node], text)

    def done(self) -> dict:
        self.inserts()
        return {"key": self.key, "illegal": self.illegal, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def _texts(batches):
    """One result per conversation from rows that come by in order; a segment's letters come before its rows."""
    now = None
    schema = pa.schema([("key", pa.string()), ("illegal", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    for b in batches:
        out = []
        for key, letters, node, role, text in zip(*(b.column(c).to_pylist() for c in ("key", "letters", "node", "role", "text"))):
            if now is None or now.key != key:
                out += [now.done()] if now else []
                now = _Text(key)
            if letters is not None:
                now.segment(letters, node)
            else:
                now.row(role, text)
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if now:
        yield pa.RecordBatch.from_pylist([now.done()], schema=schema)


def repair(conversations: DataFrame, segment_rows: int = SEGMENT) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``, one row per conversation of ``conversations`` before damage.

    Null roles and texts count as one space; rows of a null ``conv_id`` are one
    conversation; null turns come first and do not count in ``gaps``.  Rows of the
    same turn stand by role, then by the hash of role and text, so repeated rows and
    copies are neighbours.  A role whose initial is not s, u or a can only be reroled
    or deleted.  A conversation of which no row is left gives zeros, an empty audit
    and the hash of the empty string.  Texts of any length stream by.  An empty table
    gives an empty result; columns besides the four are not read."""
    spark = conversations.sparkSession
    all_ids = conversations.select("conv_id").distinct()
    rows = _kept(judged(damaged(conversations)), "conversation-faults")
    pieces = _kept(audits(rows, segment_rows), "conversation-audits")
    stats = (rows.groupBy("key", "turn").agg(*[F.sum((F.col("fault") == c).cast("bigint")).alias(c)
                                               for c in ("blank", "duplicate", "truncated")])
             .groupBy("key").agg(
                 F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"),
                 *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]))
    costs = pieces.groupBy("key").agg(F.sum("cost").alias("cost"))
    stream = (rows.select("key", F.expr(f"at div {segment_rows}").alias("segment"), "at", F.lit(None).cast("string").alias("letters"),
                          F.lit(None).cast("bigint").alias("node"), "role", "text")
              .unionByName(pieces.select("key", "segment", F.lit(-1).cast("bigint").alias("at"), "letters", "node",
                                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = map_arrow(stream.repartition(parts, "key").sortWithinPartitions("key", "segment", "at")
                     .select("key", "letters", "node", "role", "text"), _texts,
                     "key STRING, illegal BIGINT, audit STRING, repaired_sha256 STRING")
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))
    joined = (all_ids.withColumn("key", key).join(stats, "key", "left").join(costs, "key", "left").join(told, "key", "left"))
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
