"""Each operator of the subpackage against brute force on small tables with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from sentinela.llm import bpe, components, decontaminate, html_extract, license_scan, line_dedup
from sentinela.llm import quality_classifier, quality_rules, ring_shard, simhash, token_pack

WORDS = [w for w in ("the of and to in cat dog sun moon tree river stone glass é Été STRASSE ß über niño 日本 x1 99 "
                     "a_b don't").split(" ")]
SPACE = " \t\n\x0b\x0c\r"


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice(WORDS) + rnd.choice(["", ".", "!", ","]) for _ in range(rnd.randint(1, 90))) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 5]) for i in range(15)]                           # copies
    rows += [(200 + i, base[7].replace(" ", rnd.choice([" ", "\n", "\t"]), i)) for i in range(8)]
    rows += [(300, None), (301, ""), (302, " \n\t "), (None, "null id text"), (None, None), (303, "İ Ǆ É \x1c word"), (5, base[5]), (5, base[5])]
    rows += [(400, "Line one\nshared LINE \n\n\nend"), (401, " shared line\nother"), (402, "word " * 3000), (403, "x" * 5000)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "n", "h") for i, t in corpus()]
    # names that operators use inside
    return spark.createDataFrame(rows, "doc_id long, text string, n string, h1 string").cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, n string, h1 string")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def test_quality_rules_match_a_plain_count(spark, docs, none):
    def brute(t):
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if x.strip(SPACE)]
        grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        many = {g for g, c in Counter(grams).items() if c > 1}
        hit = {j for i, g in enumerate(grams) if g in many for j in (i, i + 1, i + 2)}
        return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))

    got = quality_rules.judge(docs)
    assert got.columns == [*docs.columns, "__quality"]
    for r in got.collect():
        q = r["__quality"]
        want = brute(r.text)
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == want
        assert q.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert q.kept == (not q.base_failed and not q.failed_rules)
    kept = sorted((r.doc_id for r in got.collect() if r["__quality"].kept), key=str)
    assert sorted((r.doc_id for r in quality_rules.keep_good(docs).collect()), key=str) == kept
    assert quality_rules.judge(none).count() == 0


def test_line_dedup_matches_a_plain_count_for_any_batching(spark, docs, none):
    def key(line):
        return lowered(line.strip(SPACE))

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(500 + i, f"own {i}\n  Común ÉCOLE\nTail") for i in range(4)] + [(600 + i, "común École \nTAIL") for i in range(3)]
    table = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n int")
    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    for min_docs, batches, fanout in ((2, 4, 2), (4, 1, 2), (4, 5, 3)):
        want = []
        for i, t in rows:
            lines = (t or "").split("\n")
            kept = [x for x in lines if not key(x) or seen[key(x)] < min_docs]
            want.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
        out = line_dedup.drop_common_lines(table, min_docs=min_docs, batches=batches, fanout=fanout)
        assert out.columns == ["doc_id", "text", "n", "__lines"]
        got = [(str(r.doc_id), r["__lines"].n_lines, r["__lines"].n_dropped, r["__lines"].kept) for r in out.collect()]
        assert sorted(got) == sorted(want)
    assert line_dedup.drop_common_lines(none).count() == 0
    back = {r.doc_id: r.text for r in line_dedup.without_common_lines(table, min_docs=2).filter("doc_id = 300").collect()}
    assert back == {300: None}


def test_line_runs_compact_and_report_unseen(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fanout=2)
    for _ in range(4):
        runs.add(spark.createDataFrame([(1, 1, 1), (2, 2, 1)], "h1 long, h2 long, n long"))
    assert {(r.h1, r.h2) for r in runs.frequent().collect()} == {(1, 1), (2, 2)}
    fresh = runs.unseen(spark.createDataFrame([(1, 1, 1), (9, 9, 1)], "h1 long, h2 long, n long"))
    assert [r.h1 for r in fresh.collect()] == [9]
    assert sum(map(len, runs.levels.values())) <= 1


def test_line_runs_merge_and_compact_without_a_shuffle(spark, docs, none):
    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange")

    lines = line_dedup.index_lines(docs, min_docs=3)
    batch = line_dedup.Runs(spark, lines.runs.buckets)
    batch.write(line_dedup.line_counts(docs, batches=2).withColumnRenamed("batch", "run"))
    assert lines.settled
    assert shuffles(lines.unsettled(batch.read([0]))) == 0
    assert shuffles(lines.totals(lines.settled)) == 0
    assert shuffles(lines.frequent()) == 0
    files = [p for p in batch.read([0, 1]).inputFiles()]
    assert len(files) <= 2 * batch.buckets
    seen = {(r.h1, r.h2) for r in lines.frequent().collect()}
    plain = line_dedup.line_counts(docs).filter("n >= 3")
    assert seen == {(r.h1, r.h2) for r in plain.collect()} and seen
    assert line_dedup.index_lines(none).frequent().count() == 0
    lines.close(), batch.close()
    assert not [t for t in spark.catalog.listTables() if t.name in (lines.runs.name, batch.name)]


def brute_fingerprint(text, k=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    grams = [" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] if len(ws) >= k else [" ".join(ws)] if ws else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def roots(values, distance):
    values = sorted(set(values))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if bin(a ^ b).count("1") <= distance:
                parent[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_simhash_components_match_all_pairs(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    root = roots(fps, 2)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted((str(i), f, str(least.get(root[f]))) for (i, _), f in zip(rows, fps))
    got = sorted((str(r.id), r.fp % (1 << 64), str(r.component)) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(root[brute_fingerprint(r.text)] for r in kept.collect()) == {v: 1 for v in set(root.values())}


@pytest.mark.parametrize("distance,max_bucket", [(2, 4), (2, 1), (1, 2), (0, 2)])
def test_links_lose_no_connection_in_dense_groups(spark, distance, max_bucket):
    rnd = random.Random(9)
    values = set()
    for _ in range(6):
        v = rnd.getrandbits(64)
        for _ in range(25):
            values.add(v)
            v ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.5:
                v ^= 1 << rnd.randrange(64)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), distance, max_bucket)
    for r in edges.collect():
        assert bin((r.u ^ r.v) % (1 << 64)).count("1") <= distance
    node = {r.node: r.root for r in components.components(edges).collect()}
    want = roots(values, distance)
    group = {}
    for v in values:
        s = v - (1 << 64) if v >> 63 else v
        group.setdefault(want[v], set()).add(node.get(s, s))
    assert all(len(g) == 1 for g in group.values()) and len({min(g) for g in group.values()}) == len(group)


def test_components_of_chains_and_empty_tables(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("block_words", [1_000_000, 30])
def test_decontamination_matches_a_plain_search(spark, docs, none, block_words):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rnd = random.Random(4)
    items = [(i, " ".join(words_of(rows[i][1])[:rnd.randint(1, 30)])) for i in range(0, 40, 3)]
    items += [(900, "never seen phrase of ten words that is not there at all"), (901, None), (902, ""), (903, "Moon"), (903, "Moon"),
              (None, "null id")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = {}
    for i, t in items:
        ws = words_of(t)
        n = min(10, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            wins.setdefault(tuple(ws[k:k + n]), set()).add("" if i is None else str(i))
    want = []
    for i, t in rows:
        ws, hit, found = words_of(t), set(), set()
        for n in {len(w) for w in wins}:
            for k in range(len(ws) - n + 1):
                if own := wins.get(tuple(ws[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        want.append((str(i), len(ws), len(hit), sorted(found)))
    out = decontaminate.contamination(docs, bench, block_words=block_words)
    got = [(str(r.id), r.n_words, sum(x.finish - x.begin for x in r.runs), list(r["items"])) for r in out.collect()]
    assert sorted(got) == sorted(want)
    clean = Counter(str(r.doc_id) for r in decontaminate.clean_documents(docs, bench).collect())
    assert clean == Counter(i for i, _, n, _ in want if not n)
    assert decontaminate.contamination(none, bench).count() == 0
    assert all(not r["items"] for r in decontaminate.contamination(docs, bench.limit(0)).collect())


def test_a_long_item_is_taken_in_blocks(spark):
    rnd = random.Random(6)
    words = [f"w{rnd.randint(0, 400)}" for _ in range(100)]
    items = [(1, " ".join(words)), (2, "one two"), (3, None), (4, " ".join(words[:25]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (1, 12, 40):
        blocks = list(decontaminate.blocks_of(bench, "item_id", "text", block_words))
        assert max(sum(len(ws) for _, ws in b) for b in blocks) <= max(block_words, decontaminate.WINDOW)
        got = {(n, tuple(w.decode() for w in ws[i:i + 10])) for b in blocks for n, ws in b for i in range(max(1, len(ws) - 9))}
        assert got == {(str(n), tuple(words_of(t)[i:i + 10])) for n, t in items for i in range(max(1, len(words_of(t)) - 9)) if t}
    docs = spark.createDataFrame([(7, " ".join(words[20:60])), (8, " ".join(words[70:79]))], "doc_id long, text string")
    out = {r.id: r for r in decontaminate.contamination(docs, bench, block_words=60).collect()}
    assert sum(x.finish - x.begin for x in out[7].runs) == 40 and out[7]["items"] == ["1"] and not out[8]["items"]


def test_proximity_takes_shifted_words(spark):
    docs = spark.createDataFrame([(1, "a b x c d e"), (2, "a b c d e"), (3, "a b x y z c d e"), (4, "d e")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    hits = lambda slop: {r.id for r in decontaminate.contamination(docs, bench, slop=slop).collect() if r["items"]}
    assert hits(0) == {2} and hits(1) == {1, 2}


def test_inverted_index_holds_every_posting_and_serves_many_searches(spark, docs):
    rows = Counter((str(r.doc_id), tuple(words_of(r.text))) for r in docs.collect())
    found = {}
    for size in (1, 700, 1 << 20):                                             # a segment a document, a few, one a task
        index = decontaminate.build_index(docs, segment_bytes=size).cache()
        places = {}
        for r in index.filter("term IS NOT NULL").collect():
            at = list(np.cumsum(r.steps))
            assert len(at) == r.n and at == sorted(set(at))
            places.setdefault(r.segment, {}).update({int(p): bytes(r.term).decode() for p in at if r.term})
        whole = Counter()
        for r in index.filter("term IS NULL").collect():
            whole[str(r.id), tuple(places[r.segment][r.begin + i] for i in range(r.n_words))] += 1
        assert whole == rows
        for block in ([("a", [b"cat", b"dog"]), ("b", [b"moon"])], [("c", [b"word"] * 12)], [("d", [b"unheard", b"of"])]):
            hit = decontaminate.search(index, block).join(index.filter("term IS NULL"), ["segment", "begin"])
            got = sorted((str(r.id), r["items"], [tuple(x) for x in r.runs]) for r in hit.collect())
            assert found.setdefault(block[0][0], got) == got
        index.unpersist()
    assert found["a"] and [(i, r) for i, _, r in found["c"]] == [("402", [(0, 3000)])] and not found["d"]


def test_bpe_equals_the_tokenizers_library(spark, docs, none):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    rnd = random.Random(2)
    bits = ["a", "the", "'s", "'ll", "'", "É", "é", "ß", "Σ", "ς", "İ", "12", " ", "\n", "<|endoftext|>", "<|", "!!", "日本", "aaaa",
            "ing", "\x1c", "\xa0", "…", "😀"]
    texts = [t for _, t in corpus()] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, names string")
    want = {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    got = bpe.decode(bpe.encode(table, path), path).collect()
    assert {r.doc_id: r.ids for r in got} == want
    assert all(r.decoded == lib.decode(r.ids, skip_special_tokens=False) for r in got)
    for r in bpe.digests(table, path).collect():
        ids = want[r.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(none, path).count() == 0


def test_pieces_do_not_depend_on_slices_and_caches(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    model = bpe.PrefixBpe(open(path, encoding="utf-8").read())
    text = " ".join(t or "" for _, t in corpus(3))
    whole = model.encode(text)
    monkeypatch.setattr(bpe, "SLICE", 50)
    monkeypatch.setattr(bpe, "PIECE_CACHE", 3)
    monkeypatch.setattr(bpe, "PAIR_CACHE", 3)
    assert model.encode(text) == whole


def test_packing_is_lossless_and_best_fit(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    model = token_pack.RankTokenizer(open(path, "rb").read())
    size = 64
    rows = token_pack.pack(docs, path, seq_len=size, group_bytes=8000).collect()
    parts = {}
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(places) == size and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= size
        assert (ids[r.n_tokens:] == token_pack.END_ID).all() and len(r.doc_ids) == r.n_segments
        for d, o, a, z in zip(r.doc_ids, r.doc_offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:z].tolist() == list(range(z - a))
            parts.setdefault(d, []).append((o, ids[a:z].tolist()))
    whole = Counter()
    for d, t in [(r.doc_id, r.text) for r in docs.collect()]:
        want = model.encoding.encode_ordinary(t or "") + [token_pack.END_ID]
        assert model.encode(t or "").tolist() == want[:-1]
        whole[d] += len(want)
        if d not in (None, 5):
            assert [x for _, p in sorted(parts[d]) for x in p] == want
    assert {d: sum(len(p) for _, p in x) for d, x in parts.items()} == dict(whole)
    assert token_pack.pack(none, path).count() == 0


def test_copies_of_one_row_are_packed_in_many_groups(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    text = "the river and the stone " * 5
    rows = [(1, text)] * 600 + [(None, None)] * 300 + [(i, f"own text {i} " * 9) for i in range(1000, 1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_pack.pack(docs, path, seq_len=64, group_bytes=4000).collect()
    own = [(r.grp, z - a) for r in got for d, a, z in zip(r.doc_ids, r.cu_seqlens, r.cu_seqlens[1:]) if d == 1]
    length = len(token_pack.RankTokenizer(open(path, "rb").read()).encode(text)) + 1
    assert sum(n for _, n in own) == 600 * length and sum(r.n_segments for r in got) == 1200
    share = Counter(g for g, _ in own)
    assert len(share) > 8 and max(share.values()) < 200


def test_best_fit_matches_a_linear_search():
    rnd = random.Random(1)
    for _ in range(50):
        size = rnd.randint(1, 40)
        lengths = [rnd.randint(1, size) for _ in range(rnd.randint(0, 60))]
        room, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [r for r in room if r >= lengths[i]]
            room.remove(min(fits)) if fits else None
            room.append((min(fits) if fits else size) - lengths[i])
        bins = token_pack.best_fit(lengths, size)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert sorted(size - sum(lengths[i] for i in b) for b in bins) == sorted(room) and want == {}


def test_ring_law_and_bounded_movement(spark, docs, none):
    rows = ring_shard.shard_rows(docs).collect()
    assert Counter((str(r.id), r.size, r.text_crc32) for r in rows) == Counter(
        (str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    per = Counter(r["shard"] for r in rows)
    assert max(per.values()) - min(per.get(s, 0) for s in range(8)) <= 1
    for s in per:
        assert sorted(r.slot for r in rows if r["shard"] == s) == list(range(per[s]))
    assert ring_shard.shard_rows(none).count() == 0
    same = spark.createDataFrame([(None, "t")] * 50, "doc_id long, text string")
    assert sorted(Counter(r["shard"] for r in ring_shard.shard_rows(same).collect()).values()) == [6] * 6 + [7] * 2
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    a, b = ({r.id: r["shard"] for r in ring_shard.shard_rows(many, shards=n).collect()} for n in (8, 9))
    assert sum(a[i] != b[i] for i in a) < 0.45 * len(a)      # a modulus would move eight of nine


def test_walk_equals_row_by_row_placement():
    points, pieces = ring_shard.ring_points(3, 4), ring_shard.arcs(3, 4, 4)
    rnd = random.Random(6)
    counts = {p: rnd.randint(0, 9) for p, _, _ in pieces}
    total = sum(counts.values())
    room = [total // 3 + (s < total % 3) for s in range(3)]
    place, over = {}, []
    for p, _, owner in pieces:
        for k in range(counts[p]):
            if room[points[owner][1]]:
                room[points[owner][1]] -= 1
                place[p, k] = points[owner][1]
            else:
                over.append((p, k, owner))
    for p, k, at in over:
        while True:
            at = (at + 1) % len(points)
            if room[points[at][1]]:
                break
        room[points[at][1]] -= 1
        place[p, k] = points[at][1]
    got = {(p, k): s for p, lo, hi, s, _ in ring_shard.walk(counts, pieces, points, 3) for k in range(lo, hi)}
    assert got == place


def test_license_base_counts_and_suppression(spark, docs, none):
    texts = ["Under the MIT-License under the mit license.", "Apache License, Version 2.0; APACHE license version 2", "CC BY-NC 4.0 cc by nc sa",
             "Licensed under the GNU General Public License, version 3.", "GNU Lesser General Public License v2.1", "mit und mit",
             "SPDX-License-Identifier: BSD-3-Clause", None, "", "all rights reserved"]
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = {r.id: r for r in license_scan.scan(table).collect()}
    for i, t in enumerate(texts):
        ws = words_of(t)
        at = sorted(k for p, _ in license_scan.BASE_PHRASES for k in range(len(ws)) if ws[k:k + len(p.split())] == p.split())
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(ws), len(at), at[0] if at else None, at[-1] if at else None)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        for d in r.detections:
            assert 0 <= d.first_word and d.first_word + d.n_words <= r.n_words
    labels = {i: r.labels for i, r in got.items()}
    assert labels[0] == "mit" and labels[1] == "apache-2" and labels[3] == "gpl-3" and labels[4] == "lgpl-2.1"
    assert labels[2] == "cc-by-nc,cc-by-nc-sa" and labels[5] == labels[7] == labels[8] == "" and labels[6] == "bsd-3-clause"
    assert license_scan.scan(none).count() == 0 and len(license_scan.signatures()) > 300


def test_suppression_equals_all_pairs():
    rules = license_scan.signatures()
    for t in ["released under the gnu general public license version 3 or the mit license", "gpl v3 gpl v3 bsd 3 clause license bsd license"]:
        canonical = f" {t} ".encode()
        found = [(m.start(), m.end(), o, r) for o, r in enumerate(rules) if r.keyword in canonical for m in r.pattern.finditer(canonical)]
        order = sorted(found, key=lambda x: (-x[3].priority, x[0] - x[1], x[2], x[0]))
        kept = []
        for x in order:
            if not any(k[0] <= x[0] and x[1] <= k[1] for k in kept):
                kept.append(x)
        assert {(d.begin, d.end, d.signature.name) for d in license_scan.detect(canonical, rules)} == {(a, z, r.name) for a, z, _, r in kept}


def texts_of(parsed, way):
    """One text that the parsed pattern matches: the ``way``-th branch everywhere, repeats as few times as allowed."""
    out = []
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            out.append(chr(arg))
        elif kind in ("ANY", "NOT_LITERAL"):
            out.append("x")
        elif kind == "IN":
            out.append("x" if str(arg[0][0]) == "NEGATE" else chr(min(arg[0][1]) if str(arg[0][0]) == "RANGE" else arg[0][1]))
        elif kind == "BRANCH":
            out.append(texts_of(arg[1][way % len(arg[1])], way))
        elif kind == "SUBPATTERN":
            out.append(texts_of(arg[3], way))
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            out.append(texts_of(arg[2], way) * arg[0])
        else:
            assert kind in ("ASSERT", "ASSERT_NOT"), kind
    return "".join(out)


def test_every_license_rule_finds_a_text():
    from re import _parser
    rules, dead = license_scan.signatures(), []
    assert len({r.name for r in rules}) == len(rules)
    for r in rules:
        parsed = _parser.parse(r.pattern.pattern.decode())
        before = "spdx license identifier " if "/joined-id/" in r.name else ""
        for way in range(4):
            canonical = f" {before}{texts_of(parsed, way)} ".encode()
            kept = license_scan.detect(canonical, rules)
            if not (r.keyword in canonical and r.also in canonical and r.pattern.search(canonical)
                    and r.label in {d.signature.label for d in kept}):
                dead.append((r.name, way, canonical, [d.signature.name for d in kept]))
    assert not dead


@pytest.mark.parametrize("text, labels", [
    ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: ISC", "isc"), ("SPDX-License-Identifier: Zlib", "zlib"),
    ("SPDX-License-Identifier: EPL-2.0", "epl-2"), ("SPDX-License-Identifier: BSL-1.0", "bsl-1"),
    ("SPDX-License-Identifier: Artistic-2.0", "artistic-2"), ("SPDX-License-Identifier: Unlicense", "unlicense"),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND Zlib", "apache-2,mit,zlib"), ("License: MIT", "mit"),
    ("licensed under MIT", "mit"), ("Licensed under GPL.", "gpl"), ("Die License mit der Nummer", ""), ("ruby and openssl, mit zlib", ""),
    ("Copyright X. All rights reserved. Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
    ("Copyright X. All rights reserved.\n * Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:\n * 1. The notice.", "bsd-2-clause"),
    ("All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: 1. The notice. 3. Neither the name of X nor", "bsd-3-clause"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or any later version.", "gpl-3"),
    ("All rights reserved. Licensed under the MIT license. Permission is hereby granted, free of charge, to any person obtaining "
     "a copy of this software and associated documentation files", "mit,proprietary"),
])
def test_license_ids_and_bodies(text, labels):
    canonical = f" {' '.join(words_of(text))} ".encode()
    kept = license_scan.detect(canonical, license_scan.signatures())
    assert ",".join(sorted({d.signature.label for d in kept})) == labels


def brute_main_text(paragraphs):
    return "\n\n".join(" ".join(p.split()) for p in paragraphs if p.split())


def test_html_keeps_the_article_alone(spark):
    paragraphs = ["A  title &amp; more", "First\n line with bold and link.", "Price 5 < 6 & é ok", "Cut off"]
    page = ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='</p><article>x</article>';</script></head><body>"
            "<nav><ul><li><a href='/x'>Home</a></li></ul></nav><header>Top</header><!-- <article>no</article> --><div class='ad banner'>Buy</div>"
            f"<article class='post has-sidebar'><h1>{html.escape(paragraphs[0])}</h1><p>First\n line with <b>bo</b>ld and <a href=\"a>b\">link</a>.<br>"
            "<p>Price 5 &lt; 6 &amp; &eacute;&nbsp;ok</p><div class='share'>Tweet</div><aside>Side</aside><form>Name<input></form>"
            "<section class='comments'><article>Nice!</article></section><p>Cut off")
    got = html_extract.article_text(page)
    assert got == brute_main_text([paragraphs[0], *paragraphs[1:]])
    assert html_extract.article_text(None) == html_extract.article_text("") == html_extract.article_text("<article></article>") == ""
    assert html_extract.article_text("<nav>menu<article><p>in</p></article>") == "in"


def test_host_repeats_are_cut_where_no_article_is_marked(spark):
    rnd = random.Random(3)
    boiler = "subscribe to our weekly letter and never miss a single story again"
    own = {i: " ".join(rnd.choice("abcdefghij") + str(rnd.randint(0, 999)) for _ in range(30)) for i in range(12)}
    rows = [(i, f"http://Site.org/{i}", f"<body><nav>a b</nav><div>{own[i]}</div><div>{boiler}</div></body>", "x") for i in range(10)]
    rows += [(10, "http://other.org/1", f"<body><p>{own[10]}</p><p>{boiler}</p></body>", "x"),
             (11, "http://site.org/11", f"<body><article><p>{own[11]}</p><p>{boiler}</p></article></body>", "x"),
             (12, None, None, "x"), (13, "http://site.org/0", rows[0][2], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r.main_text for r in html_extract.extract(pages).collect()}
    want = {i: own[i] for i in range(10)} | {10: f"{own[10]}\n\n{boiler}", 11: f"{own[11]}\n\n{boiler}", 12: "", 13: own[0]}
    assert got == want
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_host_repeats_decide_in_marked_articles_too(spark):
    def words(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n))

    notice, teased, quote = words("n", 60), words("t", 60), words("q", 60)
    short = "one two three four five six seven"
    rows = []
    for i in range(6):
        own = [f"<h1>{short}</h1>", f"<p>{words(f'own{i}x', 30)}</p>"]
        own += [f"<p>{teased}</p>"] if i == 0 else []            # a teaser of it stands beside the others
        own += [f"<p>{quote}</p>"] if i in (1, 2) else []        # two articles quote the same
        own += [f"<p>{notice}</p>"] if i != 3 else [f"<p>{notice} and more</p>"]
        beside = f"<aside>{teased}</aside>" if i else ""
        rows.append((i, "http://h/a", f"<nav>m{i}</nav><article>{''.join(own)}</article>{beside}<div class=ad>{short}</div>"
                                      f"<footer><p>{notice}</p></footer>"))
    rows += [(10, "http://other/a", rows[0][2]), (11, None, None), (12, "http://h/a", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.main_text.split("\n\n") for r in html_extract.extract(pages).collect()}
    for i in range(6):
        want = [short, words(f"own{i}x", 30)] + [teased] * (i == 0) + [quote] * (i in (1, 2)) + [f"{notice} and more"] * (i == 3)
        assert got[i] == want, i
    assert got[10] == [short, words("own0x", 30), teased, notice]     # the only page of its host
    assert got[11] == [""] and got[12] == got[0]


def test_one_menu_and_footer_around_every_article_are_many_pages(spark):
    def words(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n))

    notice, beside = words("n", 60), words("b", 60)
    rows = []
    for i in range(4):
        own = f"<article><p>{words(f'own{i}x', 30)}</p><p>{notice}</p><p>{beside}</p></article>"
        rows += [(i, "http://h/a", f"<nav>the same menu</nav>{own}<footer><p>{notice}</p></footer>")]
        # here the notice stands beside the article, in main
        rows += [(10 + i, "http://g/a", f"<main><p>{notice}</p>{own}</main>")]
    rows += [(20, "http://f/a", rows[0][2]), (21, "http://f/b", rows[0][2])]        # copies are one page
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.main_text.split("\n\n") for r in html_extract.extract(pages).collect()}
    for i in range(4):                             # what only articles share stays
        assert got[i] == got[10 + i] == [words(f"own{i}x", 30), beside], i
    assert got[20] == got[21] == [words("own0x", 30), notice, beside]


def test_every_page_is_asked_for_repeats(spark):
    html_of = {i: f"<nav>menu</nav><article><p>{' '.join(f'w{i}x{k}' for k in range(20 + 40 * i))}</p><p>end {i}</p></article>" for i in range(4)}
    html_of |= {4: "<div>" + " ".join(f"u{k}" for k in range(70)) + "</div><div>a b c d e f</div>", 5: "<article>short</article>"}
    pages = spark.createDataFrame([(f"http://{i}.org/", h) for i, h in html_of.items()], "url string, html string")
    found = html_extract.zones(pages, "url", "html")
    spans = {}
    for r in html_extract.asked_spans(found, 50, 6).collect():
        spans.setdefault(r.host, set()).add((r.marked, r.pos, r.upto, r.n, r.place))
    own = {html_extract._zones(f"http://{i}.org/", [])[0]: i for i in html_of}
    assert {own[h]: s for h, s in spans.items()} == {
        1: {(True, 0, 60, 2, 0), (True, 0, 60, 2, 1), (True, 0, 62, 2, 0), (True, 0, 62, 2, 1)},
        2: {(True, 0, 100, 2, p) for p in (0, 1)} | {(True, 0, 102, 3, p) for p in range(3)},
        3: {(True, 0, 140, 3, p) for p in range(3)} | {(True, 0, 142, 3, p) for p in range(3)},
        4: {(False, k, k + 50, 1, 0) for k in range(27)} | {(False, 0, 70, 1, 0), (False, 70, 76, 1, 0)}}


def test_main_text_matches_brute_force(spark):
    rnd, size, whole = random.Random(11), 5, 3
    pool = [" ".join(rnd.choice("abcdef") + str(rnd.randint(0, 9)) for _ in range(rnd.randint(1, 9))) for _ in range(14)]

    def some(tag):
        return "".join(f"<{tag}>{rnd.choice(pool) if rnd.random() < .7 else ' '.join(rnd.choice('uvwxyz') for _ in range(4))}</{tag}>"
                       for _ in range(rnd.randint(1, 4)))

    rows = [(i, f"http://h{i % 3}/", f"<nav>{some('li')}</nav>" + (f"<article>{some('p')}</article>" if i % 2 else some("p")) +
             f"<footer>{some('p')}</footer>") for i in range(60)]
    rows += [(60, rows[0][1], rows[0][2]), (61, rows[1][1], rows[1][2])]
    tell = {i: html_extract._zones(u, html_extract.blocks(h)) for i, u, h in rows}
    outside, inside = {}, {}
    for host, page, key, is_marked, furniture, rest, main in tell.values():
        for stream in (furniture, rest):
            words = [t.split() for t in stream]
            flat = [w for b in words for w in b]
            for k in range(len(flat) - size + 1):
                outside.setdefault((host, True, tuple(flat[k:k + size])), set()).add(page)
            for a in range(len(words)):
                for b in range(a + 1, len(words) + 1):
                    row = tuple(w for x in words[a:b] for w in x)
                    if len(row) >= whole:
                        outside.setdefault((host, False, row), set()).add(page)

    def spans(main):
        words = [t.split() for t in main]
        flat = [w for b in words for w in b]
        for begin, end in html_extract.border_spans([len(b) for b in words], size).tolist():
            yield begin, end, [tuple(flat[k:k + size]) for k in {*range(begin, end - size, size), end - size}]

    def repeats(host, long, run):
        return len(outside.get((host, long, run), ())) > 1

    for host, _, key, is_marked, _, _, main in tell.values():
        if is_marked:
            for _, _, runs in spans(main):
                for run in runs:
                    if repeats(host, True, run):
                        inside.setdefault((host, run), set()).add(key)
    got = {r.page_id: r.main_text for r in html_extract.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string"), min_tokens=size, block_tokens=whole).collect()}
    cut = [0, 0]
    for i, (host, _, _, is_marked, _, _, main) in tell.items():
        words, gone, pos, kept = [t.split() for t in main], set(), 0, []
        flat = [w for b in words for w in b]
        if is_marked:
            for begin, end, runs in spans(main):
                if all(len(inside.get((host, run), ())) > 1 for run in runs):
                    gone |= {*range(begin, end)}
        else:
            at = [0, *np.cumsum([len(b) for b in words]).tolist()]
            for k in range(len(flat) - size + 1):
                if repeats(host, True, tuple(flat[k:k + size])):
                    gone |= {*range(k, k + size)}
            for a in at:
                for b in at:
                    if b - a >= whole and repeats(host, False, tuple(flat[a:b])):
                        gone |= {*range(a, b)}
        for b in words:
            if left := [w for k, w in enumerate(b, pos) if k not in gone]:
                kept.append(" ".join(left))
            pos += len(b)
        cut[is_marked] += bool(gone)
        assert got[i] == "\n\n".join(kept), (i, rows[i])
    assert min(cut) > 3                            # of marked and of other pages


def test_pages_whose_article_is_not_marked_keep_their_text(spark):
    html_of = {
        "a": "<div id=content><p>the story itself</p></div><aside><article>a teaser</article></aside>",
        "b": "<div class='content sidebar-right'><article>the story itself</article></div><p>end</p>",
        "c": "<main></main><div>the story itself</div>",
        "d": "<div class='sidebar'><article><p>the story itself</p></article></div><div>few words</div>",
        "e": "<div class='sidebar'><article>a teaser</article></div><div>the story itself</div>",
        "f": "<div class='comments'><article>Nice!</article><article>Oh!</article></div><div>the story itself</div>",
        "g": "<!-- <article>no</article> --><div>the story itself</div>",
        "h": "<div class='content sidebar-left'><p>the story itself</p></div>"}
    pages = spark.createDataFrame([(k, f"http://{k}.org/", h) for k, h in html_of.items()], "page_id string, url string, html string")
    got = {r.page_id: r.main_text for r in html_extract.extract(pages).collect()}
    assert got == {k: "the story itself" for k in html_of}


def test_only_scripts_styles_and_form_contents_are_skipped():
    page = ("<article><p>If <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> then<p><noscript>no script</noscript>"
            "<p><object data=a>an object</object><p><canvas>a canvas</canvas><p><svg><title>t</title><path d='M0'/><text>an axis</text></svg>"
            "<p><iframe src='a'/>frame<script>var a</script><style>p{}</style><p>Pick<select><option>one<option>two</select>now"
            "<p>Or <select><option>three<p>not closed<p><option>four<p>end<textarea>typed</textarea></article>")
    assert html_extract.article_text(page).split("\n\n") == [
        "If x=2 then", "no script", "an object", "a canvas", "an axis", "frame", "Pick now", "Or", "not closed", "end"]


def test_ordinary_phrases_of_a_host_stay(spark):
    rnd = random.Random(5)
    word = lambda: rnd.choice("abcdefghij") + str(rnd.randint(0, 9999))
    phrases = [" ".join(word() for _ in range(rnd.randint(6, 20))) for _ in range(5)]
    boiler, menu = "all the news that is fit to read", "<ul><li>Home</li><li>World news</li><li>About us all</li></ul>"
    long_run = " ".join(word() for _ in range(55))
    text, rows = {}, []
    for i in range(40):                                # every page holds two of the five phrases, in mid-sentence
        one, two = (f"{word()} {rnd.choice(phrases)} {word()}" for _ in range(2))
        lead, tail = word(), word()
        text[i] = f"{one}\n\n{two}\n\n{lead} {tail}" if i < 2 else f"{one}\n\n{two}"
        end = f"<p>{lead} {long_run} {tail}</p>" if i < 2 else ""      # a long passage of just two pages
        rows.append((i, f"http://site.org/{i}", f"<div>{one}</div>{menu}<p>{two}</p>{end}<div>{boiler}</div>"))
    got = {r.page_id: r.main_text for r in html_extract.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == text


def test_border_spans_cover_every_row_of_blocks():
    rnd = random.Random(4)
    for _ in range(50):
        lengths, size = [rnd.randint(1, 9) for _ in range(rnd.randint(0, 9))], rnd.randint(1, 12)
        at = [0, *np.cumsum(lengths).tolist()]
        spans = html_extract.border_spans(lengths, size).tolist()
        assert all(b in at and e in at and e - b >= size for b, e in spans)
        for b in at:
            for e in at:
                if e - b >= size:
                    assert {k for x, y in spans if b <= x and y <= e for k in range(x, y)} == set(range(b, e))


def test_suffix_runs_match_all_windows():
    rnd = random.Random(8)
    streams = [np.array([rnd.randint(0, 3) for _ in range(rnd.randint(0, 25))], np.uint64) for _ in range(8)]
    for size in (1, 2, 5, 6):
        order, first = html_extract.suffix_runs(streams, size)
        runs, now = [], None
        for (s, o), f in zip(order.tolist(), first):
            if f:
                now = []
                runs.append(now)
            now.append((s, o))
        want = {}
        for s, x in enumerate(streams):
            for o in range(len(x) - size + 1):
                want.setdefault(tuple(x[o:o + size]), []).append((s, o))
        assert sorted(map(sorted, runs)) == sorted(map(sorted, want.values()))


def test_classifier_learns_and_scores_whole_texts(spark, none, monkeypatch):
    rnd = random.Random(5)

    def text(good):
        ws = [rnd.choice(["river", "stone", "glass", "morning", "letter"]) for _ in range(rnd.randint(5, 60))]
        return " ".join(ws if good else [w + rnd.choice(["***", "###", "!!"]) for w in ws])

    rows = [(i, text(i % 4 > 0), 1 if i % 4 > 0 else 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(None, None, 0.0), (999, "", 0.0)], "doc_id long, text string, size double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels, usable=F.lit(True))
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i % 3 == 0]
    assert sum(held) / len(held) > 0.97 and 0 <= got[999] <= 1 and got[None] == got[999]
    own = quality_classifier.Model(model.weight, model.bias)
    texts = [t for _, t, _ in rows[:20]] + ["", "word\tword", "  x  "]

    def brute(t):
        buckets, n = quality_classifier.counted(t)
        return 1 / (1 + np.exp(-(model.bias + (model.weight[buckets] @ n / n.sum() if len(n) else 0))))

    assert np.allclose(own.score(texts), [brute(t) for t in texts])
    monkeypatch.setattr(quality_classifier, "SLICE", 30)
    assert np.allclose(own.score(["a1 b2 c3 d4 " * 40]), [brute("a1 b2 c3 d4 " * 40)])
    assert quality_classifier.score(none, model).count() == 0
    empty = quality_classifier.fit(docs, labels.limit(0), usable=F.lit(True))
    assert [r.score for r in quality_classifier.score(docs.limit(2), empty).collect()] == [0.5, 0.5]


def test_the_sample_is_bounded_when_an_id_repeats(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_classifier, "train", lambda rows: seen.append(rows) or quality_classifier.Model(np.zeros(1), 0.0))
    rows = [(1, "same text")] * 300 + [(2, f"text number {i}") for i in range(300)] + [(i, f"own {i}") for i in range(3, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, quality int")
    for some in (docs, docs.repartition(7), docs.orderBy(F.desc("text"))):
        quality_classifier.fit(some, labels, usable=F.lit(True), max_rows=20)
        quality_classifier.fit(some, labels.filter("doc_id != 2"), usable=F.lit(True), max_rows=20, max_features=60)
    plain = [[(y, b.tolist(), n.tolist()) for y, b, n in rows] for rows in seen]
    assert plain[0] == plain[2] == plain[4] and len(plain[0]) == 20
    assert plain[1] == plain[3] == plain[5] and 0 < sum(len(b) for _, b, _ in plain[1]) <= 60


def test_feature_buckets_follow_the_definition():
    t = "ab ab\nabc d"
    found = [b for x in quality_classifier.slices(t) for _, b in quality_classifier.features(x)]
    grams = sum(max(0, len(w) + 2 - n + 1) for w in t.split() for n in quality_classifier.NGRAMS)
    assert sum(map(len, found)) == len(t.split()) + 1 + grams
    assert regex.findall(r"\S+", t) == t.split()


def test_pack_tokenizer_equals_library_on_slices_and_long_blanks(monkeypatch):
    model = token_pack.RankTokenizer(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    whole = model.encode("a" + " " * 2_000_000 + "b" + "\n" * 1_500_000)     # the pattern's stack would overflow
    assert model.encoding.decode(whole.tolist()) == "a" + " " * 2_000_000 + "b" + "\n" * 1_500_000
    monkeypatch.setattr(token_pack, "SLICE", 37)
    monkeypatch.setattr(token_pack, "LONG", 3)
    monkeypatch.setattr(token_pack, "LONG_BLANK", re.compile(f"[{token_pack.BLANK}]{{3,}}"))
    rnd = random.Random(6)
    letters = " \n\t   \x1c\x85\u2003abZ9's\u00e9,.!\u6f22\U0001f642"
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 120)))
        assert model.encode(text).tolist() == model.encoding.encode_ordinary(text)
