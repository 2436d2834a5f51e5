"""Read mapping (J5): DNA k-mer voting on toy genomes and the text form."""

import random

from pyspark.sql import functions as F

from conftest import write_text
from sentinela.operators import mapping as M
from sentinela.sources import files as S


def _rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_reads_placed_on_right_reference_strand_and_start(spark, tmp_path):
    rnd = random.Random(3)
    genomes = {f"NC_00{i}": "".join(rnd.choice("ACGT") for _ in range(3000)) for i in range(3)}
    fasta = []
    for name, seq in genomes.items():
        fasta.append(f">{name} toy genome {name}")
        fasta += [seq[i:i + 70] for i in range(0, len(seq), 70)]
    write_text(str(tmp_path / "ref" / "all.fna"), fasta)
    refs = S.read_fasta(spark, str(tmp_path / "ref"))
    assert {r.ref_id: len(r.seq) for r in refs.collect()} == {k: 3000 for k in genomes}

    reads = [("r1", genomes["NC_001"][500:600], "NC_001", "+", 500),
             ("r2", _rc(genomes["NC_002"][2000:2100]), "NC_002", "-", 2000),
             ("r3", genomes["NC_000"][2950:3000], "NC_000", "+", 2950),   # crosses a window edge
             ("r4", "".join(rnd.choice("ACGT") for _ in range(100)), None, None, None)]
    rd = spark.createDataFrame([(a, b) for a, b, *_ in reads], "read_id string, seq string")
    got = {r.read_id: r for r in M.map_reads(rd, refs, k=15, window=400, min_seeds=3).collect()}
    assert set(got) == {"r1", "r2", "r3"}
    for rid, _, gene, strand, start in reads[:3]:
        r = got[rid]
        assert (r.gene, r.strand) == (gene, strand)
        if strand == "+":
            assert r.start == start and r.identity == 1.0
    assert got["r3"].end == 3000


def test_windows_cover_each_kmer_once(spark):
    refs = spark.createDataFrame([("g", "ACGT" * 50)], "ref_id string, seq string")
    win = M.reference_windows(refs, window=37, k=5)
    kmers = M._kmers(win, ["ref_id"], "wseq", 5, base_pos="wstart", limit_col="_wn")
    pos = sorted(r.pos for r in kmers.collect())
    assert pos == list(range(200 - 5 + 1))


def test_shuffle_path_equals_broadcast_path_and_n_bases(spark):
    rnd = random.Random(5)
    g = "".join(rnd.choice("ACGT") for _ in range(2000))
    g = g[:700] + "N" * 30 + g[730:]
    refs = spark.createDataFrame([("NC_9", g)], "ref_id string, seq string")
    reads = spark.createDataFrame([("a", g[100:200]), ("b", _rc(g[1500:1600])), ("c", g[690:760])],
                                  "read_id string, seq string")
    fast = {tuple(r) for r in M.map_reads(reads, refs, k=12, window=300).collect()}
    slow = {tuple(r) for r in M.map_reads(reads, refs, k=12, window=300, max_broadcast_rows=0).collect()}
    assert fast == slow
    got = {r[0]: r for r in fast}
    assert got["a"][3] == 100 and got["b"][2] == "-"
    # read c straddles the N run: only k-mers outside it count
    assert got["c"][6] == max(0, 700 - 690 - 12 + 1) + (760 - 730 - 12 + 1)


def test_shingle_seeds_exact_and_best(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine"),
                                  (2, "Alpha beta gamma delta epsilon zeta eta theta"),
                                  (3, "short text")], "doc_id long, text string")
    refs = spark.createDataFrame([(10, "x one two three four five six seven eight"),
                                  (11, "two three four five six seven eight nine ten"),
                                  (12, "alpha beta gamma delta epsilon zeta eta theta")],
                                 "item_id long, text string")
    seeds = {(r.doc_id, r.item_id): r.seeds for r in M.shingle_seeds(docs, refs, k=8).collect()}
    assert seeds == {(1, 10): 1, (1, 11): 1, (2, 12): 1}
    best = {r.doc_id: (r.item_id, r.seeds) for r in M.best_reference(M.shingle_seeds(docs, refs, k=8)).collect()}
    assert best == {1: (10, 1), 2: (12, 1)}       # tie -> smaller item id
    shuffled = M.shingle_seeds(docs, refs, k=8, max_broadcast_rows=0)  # the shuffle-join path
    assert {(r.doc_id, r.item_id): r.seeds for r in shuffled.collect()} == seeds


def test_shingles_repeat_counted_once(spark):
    t = " ".join(["a b c d e f g h"] * 5)
    docs = spark.createDataFrame([(1, t)], "doc_id long, text string")
    refs = spark.createDataFrame([(7, "a b c d e f g h")], "item_id long, text string")
    r = M.shingle_seeds(docs, refs, k=8).collect()
    assert [(x.doc_id, x.item_id, x.seeds) for x in r] == [(1, 7, 1)]
    assert M.shingles(docs, "doc_id", "text", 8).count() == 40 - 7
    assert M.shingles(docs, "doc_id", "text", 8).filter(F.col("shingle") == "a b c d e f g h").count() == 5


def _brute_map(reads, refs, k, min_seeds):
    """Seed-and-vote by brute force: every read k-mer against every reference
    position, both strands; best by most seeds, then reference, strand, diagonal."""
    ok = set("ACGT")
    out = {}
    for rid, seq in reads:
        n = len(seq)
        votes = {}
        for q in range(n - k + 1):
            km = seq[q:q + k]
            if set(km) - ok:
                continue
            for ref, g in refs:
                for p in range(len(g) - k + 1):
                    rk = g[p:p + k]
                    if set(rk) - ok:
                        continue
                    if km == rk:
                        votes[(ref, "+", p - q)] = votes.get((ref, "+", p - q), 0) + 1
                    if km == _rc(rk):
                        d = p - (n - k - q)
                        votes[(ref, "-", d)] = votes.get((ref, "-", d), 0) + 1
        cands = [(-s, ref, strand, d) for (ref, strand, d), s in votes.items() if s >= min_seeds]
        if cands:
            ns, ref, strand, d = min(cands)
            out[rid] = (ref, strand, d, -ns)
    return out


def test_map_reads_equals_brute_force_with_repeats_and_n(spark):
    rnd = random.Random(11)
    rep = "".join(rnd.choice("ACGT") for _ in range(40))        # shared by two genomes
    g = ["".join(rnd.choice("ACGT") for _ in range(500)) for _ in range(3)]
    g[0] = g[0][:100] + rep + g[0][140:]
    g[2] = g[2][:300] + _rc(rep) + g[2][340:] + "ACGTACGTACGT" * 3
    g[1] = g[1][:250] + "NNNNN" + g[1][255:]
    refs = [(f"NC_{i}", s) for i, s in enumerate(g)]
    reads = []
    for i in range(40):
        src = rnd.randrange(3)
        a = rnd.randrange(0, 440)
        r = list(g[src][a:a + 60])
        for _ in range(rnd.randrange(0, 4)):                  # a few substitutions
            r[rnd.randrange(60)] = rnd.choice("ACGTN")
        r = "".join(r)
        reads.append((f"r{i}", _rc(r) if rnd.random() < 0.4 else r))
    reads.append(("rep", rep + "".join(rnd.choice("ACGT") for _ in range(20))))
    reads.append(("noise", "".join(rnd.choice("ACGT") for _ in range(60))))
    want = _brute_map(reads, refs, k=8, min_seeds=2)
    rd = spark.createDataFrame(reads, "read_id string, seq string")
    rf = spark.createDataFrame(refs, "ref_id string, seq string")
    for bound in (10**6, 0):                                   # broadcast path, shuffle path
        got = {r.read_id: (r.gene, r.strand, r.start, r.seeds)
               for r in M.map_reads(rd, rf, k=8, window=150, min_seeds=2,
                                    max_broadcast_rows=bound).collect()}
        assert got == want, bound
