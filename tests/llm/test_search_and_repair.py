"""One-bit search, hard negatives and conversation repair against brute force."""

import hashlib
import heapq
import math
import os
import random
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SMALL  # noqa: E402

from sentinela.llm import blocks, conversation_repair as R, hard_negatives, onebit_search  # noqa: E402
from sentinela.llm import queries as Q  # noqa: E402

VECTORS = "vec_id long, embedding array<double>, label int, row long, vec string, id string, size int"


def vector_frame(spark, rows):
    """Rows ``(id, vector, label)`` beside columns with the operators' own names."""
    return spark.createDataFrame([(i, v, l, 7, "x", "y", 1) for i, v, l in rows], VECTORS)


def usable(v, zero=True):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


# ------------------------------------------------------------ one-bit search


def brute_nearest(rows, k=10, every=100):
    ok = [(n, i, v) for n, (i, v, *_) in enumerate(rows) if usable(v, zero=False)]
    out = []
    for n, i, v in ok:
        if i is not None and i % every == 0:
            far = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), j is None, j or 0, m, j)
                         for m, j, w in ok if m != n and len(w) == len(v))
            out += [(i, at + 1, x[4], x[0]) for at, x in enumerate(far[:k])]
    return out


def told(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_search_recall_on_the_whole_table(spark, sf):
    path = f"/root/testdata/{sf}"
    e = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    want = brute_nearest(list(zip(e.vec_id.tolist(), e.embedding.map(list).tolist())))
    df = Q.op11_onebit_search(spark, path)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got = told(df)
    assert len(got) == len(want)
    pairs = {(q, v): s for q, _, v, s in want}
    hit = [(q, v) for q, _, v, _ in got if (q, v) in pairs]
    assert len(hit) >= 0.98 * len(want)
    assert all(abs(s - pairs[q, v]) < 1e-12 for q, _, v, s in got if (q, v) in pairs)


def test_search_edges(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(5)], 1) for i in range(0, 60)]
    rows += [(100, [1.0] * 5, 1), (100, [1.0] * 5, 1), (200, [1.0] * 5, 1), (7, [1.0] * 5, 1), (None, [1.0] * 5, 1)]
    rows += [(300, None, 1), (400, [0.0] * 5, 1), (500, [1.0, None, 0.0, 0.0, 0.0], 1), (600, [math.nan] * 5, 1), (700, [], 1),
             (800, [math.inf] + [0.0] * 4, 1), (900, [1.0, 2.0], 1), (901, [1.0, 2.5], 1)]
    got = told(onebit_search.search(vector_frame(spark, rows), k=70))
    assert got == sorted(brute_nearest(rows, k=70))   # k of all: every row is measured
    assert not {300, 400, 500, 600, 700, 800} & {x for q, _, v, _ in got for x in (q, v)}
    assert [(r, v) for q, r, v, _ in got if q == 900] == [(1, 901)]
    empty = onebit_search.search(vector_frame(spark, rows[:0]))
    assert empty.collect() == []


def test_search_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 8 * 4 * 16)  # 16 vectors a block, several query blocks
    rnd = random.Random(6)
    rows = [(i, [float(rnd.randrange(3)) for _ in range(4)], 1) for i in range(300)]   # many ties
    got = told(onebit_search.search(vector_frame(spark, rows), k=4, every=5))
    want = brute_nearest(rows, k=4, every=5)
    assert len(got) == len(want)
    near = {(q, r): s for q, r, _, s in want}
    assert sum(near[q, r] == s for q, r, _, s in got) > 0.95 * len(want)


def test_error_bound_holds(spark):
    rng = np.random.default_rng(3)
    x, turn = rng.standard_normal((4000, 64)), onebit_search.rotation(64)
    words, size, own = onebit_search.encode(x, np.zeros(64), turn)
    q = rng.standard_normal((20, 64))
    sizes, aimed = onebit_search._unit(q, np.zeros(64), turn)
    over = biased = 0.0
    for i in range(20):
        guess, low = onebit_search.Query(sizes[i], aimed[i]).bounds(words, size, own)
        real = ((x - q[i]) ** 2).sum(axis=1)
        over += (low > real).mean() / 20
        biased += (guess - real).mean() / 20
    assert over < 0.02 and abs(biased) < 1.0


# ------------------------------------------------------------ hard negatives


def brute_negatives(rows, n=5, k=3, every=50):
    ok = [(m, i, [math.floor(256.0 * x) for x in v], l) for m, (i, v, l) in enumerate(rows) if usable(v) and l is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for m, i, v, l in ok:
        if i is None or i % every:
            continue
        order = lambda c: (-c[0], c[1] is None, c[1] or 0, c[2])
        near = sorted([(dot(v, w), j, o) for o, j, w, y in ok if o != m and y == l and len(w) == len(v)], key=order)
        others = sorted([(dot(v, w), j, o) for o, j, w, y in ok if y != l and len(w) == len(v)], key=order)
        for p, pid, _ in near[:n]:
            inside = [c for c in others if 50 * p <= 100 * c[0] <= 95 * p][:k]
            out += [(i, pid, r + 1, c[1], p, c[0]) for r, c in enumerate(inside)]
    return out


def mined(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect()), key=repr)


def test_negatives_edges(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.uniform(-1, 1) + (i % 3) for _ in range(3)], i % 3) for i in range(120)]
    rows += [(50, rows[7][1], 1), (50, rows[7][1], 1), (None, rows[7][1], 2), (150, None, 1), (200, rows[3][1], None),
             (250, [1.0, math.nan, 0.0], 1), (300, [], 1), (350, [1.0], 1), (351, [1.0], 1), (353, [0.9], 2), (400, [0.0] * 3, 2)]
    rows += [(i, [0.5, 0.5, 0.5], 0) for i in range(1000, 1030)] + [(i, [0.5, 0.45, 0.4], 1) for i in range(2000, 2030)]
    got = mined(hard_negatives.mine(vector_frame(spark, rows)))
    assert got == sorted(brute_negatives(rows), key=repr) and len(got) > 20
    assert hard_negatives.mine(vector_frame(spark, rows[:0])).collect() == []


def test_negatives_with_large_numbers(spark):
    rows = [(i, [float(1 << 24) * (1 + i % 5), 3.0 * i], i % 2) for i in range(0, 100, 5)]
    assert mined(hard_negatives.mine(vector_frame(spark, rows))) == sorted(brute_negatives(rows), key=repr)
    huge = [(0, [1e30, 1.0], 1), (1, [1e30, 0.0], 1), (2, [1e30, 2.0], 2)]
    hard_negatives.mine(vector_frame(spark, huge)).collect()   # scores are the nearest BIGINT


def test_negatives_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 8 * 64 * 20)
    e = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    rows = list(zip(e.vec_id.tolist(), e.embedding.map(list).tolist(), e.label.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert mined(hard_negatives.mine(df)) == sorted(brute_negatives(rows), key=repr)


# ------------------------------------------------------ conversation repair

STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def brute_audit(symbols):
    """Least cost, then least audit, by Dijkstra over (cost, audit)."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        c, a, i, s = heapq.heappop(heap)
        if i == len(symbols) and s in (0, 3):
            return a, c
        if (i, s) in seen:
            continue
        seen.add((i, s))
        turn = 3 if s == 2 else 2
        if i < len(symbols):
            heapq.heappush(heap, (c + 2, a + "D", i + 1, s))
            if symbols[i] != "d":
                more = 5 if symbols[i].isupper() else 0
                to = STEP.get(symbols[i].lower(), {}).get(s)
                if to is not None:
                    heapq.heappush(heap, (c + more, a + "K", i + 1, to))
                heapq.heappush(heap, (c + more + 1, a + "R", i + 1, turn))
        heapq.heappush(heap, (c + 5, a + "I", i, turn))


def brute_repair(rows):
    """The contract row by row in plain Python."""
    found = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    tie = lambda r: hashlib.sha256(f"{len(r[1].encode())}\n{r[1]}\n{r[2]}".encode()).hexdigest()
    out = {}
    for conv, got in found.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), tie(r)))
        turns = {r[0] for r in got if r[0] is not None}
        n, seen, symbols = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), ""
        for _, role, text in got:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "d" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
            if fault:
                n[fault] += 1
        audit, cost = brute_audit(symbols)
        lines, node, rest = [], 0, iter(got)
        for letter in audit:
            turn_node = 3 if node == 2 else 2
            if letter == "I":
                node = turn_node
                lines.append(("user" if node == 2 else "assistant") + ":")
                continue
            _, role, text = next(rest)
            if letter == "K":
                node = STEP[role[:1]][node]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                node = turn_node
                lines.append(("user" if node == 2 else "assistant") + f":{text}")
        firsts = [r[1][:1] for r in got]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_audits_equal_brute_force(monkeypatch):
    rnd = random.Random(4)
    for block in (1, 3, 32):
        monkeypatch.setattr(R, "BLOCK", block)
        R.repair_order.cache_clear()
        for _ in range(300):
            s = "".join(rnd.choice("suaxSUAXduauaua") for _ in range(rnd.randrange(0, 50)))
            assert R.repair_order(s) == brute_audit(s), s
    R.repair_order.cache_clear()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_repair_of_the_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    df = Q.op13_conversation_repair(spark, f"/root/testdata/{sf}")
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {t for _, t in df.dtypes[1:7]} == {"bigint"}
    assert repaired(df) == brute_repair(rows)


def odd_conversations():
    rnd = random.Random(8)
    roles = ["user", "assistant", "system", "tool", "", None, "Über", "ubuntu"]
    texts = ["Hi.", "Yes!", "why", " \t", "", None, "Long " * 3000 + "end?", "Ça va。", "a\nb.", "x.\n "]
    rows = [(c, t, rnd.choice(roles[:3] + roles), rnd.choice(texts)) for c in (1, 2, 3, None) for t in [*range(12), None, 3, 3]]
    rows += [(9, 0, "user", "Hi.")] * 5 + [(9, 1, "assistant", "Hi.")] * 2
    rows += [(10, None, "user", "A."), (10, None, None, None), (11, 5, "user", "B")]
    for c in range(20, 60):   # conversations of one row, some of which the damage drops
        rows.append((c, 0, rnd.choice(roles), rnd.choice(texts)))
    return rows


@pytest.mark.parametrize("size", [4, 4096])
def test_repair_edges_and_split_conversations(spark, size):
    rnd = random.Random(2)
    rows = odd_conversations()
    for t in range(150):   # one conversation that is split into many segments
        rows.append((77, t, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice([f"t{t % 40}.", "no end", "ok."])))
    df = spark.createDataFrame([(*r, "k", 1, "z") for r in rows],
                               "conv_id long, turn long, role string, text string, key string, at int, fault string")
    assert repaired(R.repair(df, segment_rows=size)) == brute_repair(rows)


def test_repair_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair(df).collect() == []
