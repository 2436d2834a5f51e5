"""Gapped placement: planted insertions and deletions against plain dynamic programming."""

import random

import pytest
from pyspark.sql import functions as F

from sentinela.operators import alignment as L

W = 4 * L.MAX_SHIFT + 1


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def brute(read, ref, low=None, high=None):
    """(score, matches, start, end, columns) of the best end-to-end alignment, ends of the
    reference free, by plain DP over all of it (or the diagonals low..high only)."""
    n = len(ref)
    low, high = (-len(read), n) if low is None else (low, high)
    ok = lambda i, j: low <= j - i <= high
    key = lambda t: (t[0], t[1], -t[2])
    row = {j: (0, 0, j, 0) for j in range(low, high + 1)}
    for i in range(1, len(read) + 1):
        new = {}
        for j in range(low + i, high + i + 1):
            cand = []
            if j - 1 in row:
                s, m, b, c = row[j - 1]
                hit = 0 <= j - 1 < n and ref[j - 1] == read[i - 1] and read[i - 1] in "ACGT"
                cand.append((s + (1 if hit else -2), m + hit, b, c + 1))
            if j in row and ok(i, j):
                s, m, b, c = row[j]
                cand.append((s - 4, m, b, c + 1))
            if j - 1 in new:
                s, m, b, c = new[j - 1]
                cand.append((s - 4, m, b, c + 1))
            if cand:
                new[j] = max(cand, key=key)
        row = new
    end = max(row, key=lambda j: (*key(row[j]), -j))
    s, m, b, c = row[end]
    return s, m, b, end, c


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(12)
    dna = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    genomes = {f"NC_{i}": dna(1500) for i in range(3)}
    reads = {}
    for i in range(60):
        g = genomes[f"NC_{i % 3}"]
        a = rnd.randrange(50, 1300)
        r = list(g[a:a + 110])
        for _ in range(rnd.randrange(0, 4)):                      # substitutions
            r[rnd.randrange(len(r))] = rnd.choice("ACGT")
        for _ in range(i % 3):                                    # none, one or two gaps of 1 to 4 bases
            at, size = rnd.randrange(25, 85), rnd.randrange(1, 5)
            r[at:at + (size if rnd.random() < 0.5 else 0)] = [] if rnd.random() < 0.5 else list(dna(size))
        reads[f"r{i}"] = rc("".join(r)) if i % 4 == 0 else "".join(r)
    g = genomes["NC_1"]
    reads |= {"over-end": g[1450:] + dna(30), "before": dna(20) + g[:60], "n": g[200:240] + "NN" + g[245:300],
              "exact": g[700:800], "one": g[700:750] + rc(g[750]) + g[751:800], "far": dna(100), "short": "ACG", "null": None}
    return genomes, reads


@pytest.mark.parametrize("bound", [10 ** 6, 0])
def test_planted_gaps_equal_brute_force(spark, planted, bound):
    genomes, reads = planted
    df = spark.createDataFrame(list(reads.items()), "read_id string, seq string")
    refs = spark.createDataFrame([*genomes.items(), ("NC_0", genomes["NC_0"])], "ref_id string, seq string")
    got = {r.read_id: r for r in L.align_reads(df, refs, k=12, max_broadcast_rows=bound).collect()}
    assert set(got) == set(reads) - {"far", "short", "null"}
    gapped = 0
    for name, r in got.items():
        read = reads[name] if r.strand == "+" else rc(reads[name])
        want = brute(read, genomes[r.gene])                       # over the whole genome, no band
        assert (r.score, r.matches, r.start, r.end, r.columns) == want, name
        assert r.identity == round(r.matches / r.columns, 6) and r.nt_length == len(read)
        if name.startswith("r"):
            i = int(name[1:])
            assert r.gene == f"NC_{i % 3}" and r.strand == ("-" if i % 4 == 0 else "+")
        gapped += r.end - r.start != r.nt_length
    assert gapped > 15
    assert (got["exact"].score, got["exact"].identity) == (100, 1.0) and got["one"].score == 97


def test_seeds_of_split_diagonals_count_together(spark):
    rnd = random.Random(3)
    a = "".join(rnd.choice("ACGT") for _ in range(400))
    decoy = "".join(rnd.choice("ACGT") for _ in range(300)) + a[100:135]      # 35 bases in one piece
    read = a[100:130] + "ACGTA"[:3] + a[130:160]                              # 30 + 30 with three bases put between
    refs = spark.createDataFrame([("A", a), ("B", decoy)], "ref_id string, seq string")
    got = L.align_reads(spark.createDataFrame([("x", read)], "read_id string, seq string"), refs, k=12).collect()
    assert [(r.gene, r.start, r.end, r.matches, r.columns, r.score) for r in got] == [("A", 100, 160, 60, 63, 60 - 12)]


def test_eleven_columns(spark, planted):
    genomes, reads = planted
    refs = spark.createDataFrame(list(genomes.items()), "ref_id string, seq string")
    df = spark.createDataFrame([("s", i, q) for i, q in reads.items()], "sample string, id string, seq string")
    rows = L.align_reads(df, refs, k=12, read_id=["sample", "id"])
    labels = spark.createDataFrame([("NC_0", "first strain")], "gene string, strain string")
    out = L.mapping_result(rows, F.col("id"), labels, F.col("sample"))
    from sentinela.sources.files import MAPPING_RESULT_SCHEMA
    assert out.columns == [*MAPPING_RESULT_SCHEMA.fieldNames(), "sample"]
    assert [t for _, t in out.dtypes[:-1]] == [f.dataType.simpleString() for f in MAPPING_RESULT_SCHEMA.fields]
    got = {r.id: r for r in out.collect()}
    assert (got["one"].accuracy, got["one"].strain, got["r0"].strain) == ("99%", "NC_1", "first strain")
    assert all(v is not None for r in got.values() for v in r)
