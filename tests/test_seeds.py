"""Packed k-mers: codes against plain strings, strands, and the prefilter of the large-reference path."""

import random

import pytest
from pyspark.sql import functions as F

from sentinela.operators import mapping as M
from sentinela.operators import seeds as K


def code(kmer):
    n = 0
    for c in kmer:
        n = 4 * n + "ACGT".index(c)
    return n


def pieces(kmer):
    return tuple(code(kmer[i:i + 31]) for i in range(0, len(kmer), 31))


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


@pytest.mark.parametrize("k", [1, 2, 15, 16, 17, 18, 21, 30, 31, 32, 33, 47, 62, 63])
def test_codes_are_the_kmers(spark, k):
    rnd = random.Random(k)
    seqs = {i: "".join(rnd.choice("ACGT") for _ in range(n)) for i, n in enumerate([0, 1, 15, 16, 17, 64, 130])}
    seqs[90] = seqs[6][:40] + "NNn" + seqs[6][43:100] + "-" + seqs[6][101:]
    df = spark.createDataFrame([*seqs.items(), (99, None)], "id int, seq string")
    names = K.code_names(k)
    got = sorted((r.id, r.pos, tuple(r[c] for c in names)) for r in K.kmers(df, ["id"], "seq", k).collect())
    want = sorted((i, p, pieces(s[p:p + k])) for i, s in seqs.items() for p in range(len(s) - k + 1)
                  if not set(s[p:p + k]) - set("ACGT"))
    assert got == want
    assert len(names) == -(-k // 31)


def test_both_strands_of_windows(spark):
    rnd = random.Random(1)
    seq, k = "".join(rnd.choice("ACGT") for _ in range(200)), 9
    refs = spark.createDataFrame([("g", seq)], "ref_id string, seq string")
    got = sorted((r.pos, r.strand, r.code0) for r in
                 K.both_strands(M.reference_windows(refs, window=37, k=k), ["ref_id"], "wseq", k, "wstart").collect())
    want = sorted((p, s, code(x)) for p in range(200 - k + 1) for s, x in (("+", seq[p:p + k]), ("-", rc(seq[p:p + k]))))
    assert got == want


def test_prefilter_keeps_every_shared_kmer(spark):
    reads = spark.range(1000).select("id", (F.col("id") % 50).alias("code0"))
    index = spark.range(30, 200).select(F.col("id").alias("code0"), F.lit("g").alias("ref_id"))
    for bound in (10 ** 6, 5):   # broadcast filter, no filter
        met = K.known_only(reads, index, ["code0"], bound).join(index, "code0")
        assert met.count() == 20 * 20
    assert K.known_only(reads, index, ["code0"], 10 ** 6).count() == 400


def test_no_string_kmer_is_shuffled(spark):
    rnd = random.Random(2)
    seq = "".join(rnd.choice("ACGT") for _ in range(500))
    held = M.held_reads(spark.createDataFrame([("a", seq[10:110])], "read_id string, seq string"), [F.col("read_id")], "seq")
    refs = spark.createDataFrame([("g", seq)], "ref_id string, seq string")
    hits, small = M.seed_hits(held, refs, 16, 200, max_broadcast_rows=0)
    assert not small and hits.count() == 100 - 16 + 1
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert joins and all("code0" in line for line in joins) and "kmer" not in plan


def test_long_kmers_map_like_short_ones(spark):
    rnd = random.Random(3)
    seq = "".join(rnd.choice("ACGT") for _ in range(900))
    reads = spark.createDataFrame([("a", seq[100:250]), ("b", rc(seq[600:800])), ("n", None), ("s", "ACGT")],
                                  "read_id string, seq string")
    refs = spark.createDataFrame([("g", seq)], "ref_id string, seq string")
    for k in (21, 31, 40, 70):
        for bound in (10 ** 6, 0):
            got = {r.read_id: (r.start, r.strand, r.seeds) for r in M.map_reads(reads, refs, k=k, max_broadcast_rows=bound).collect()}
            assert got == {"a": (100, "+", 150 - k + 1), "b": (600, "-", 200 - k + 1)}
