"""Profile, decoding, shares and bands (A3, C15, L2, A6, C16), with properties."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentinela.operators import abundance as A
from sentinela.operators import profile as P


def test_ties_nulls_and_one_row_patient(spark):
    rows = [(1, "b", 3), (1, "a", 3), (1, "c", 5), (1, None, 9), (2, "z", 1)]
    inf = spark.createDataFrame(rows, "record_id long, bacteria string, otu long")
    got = {r.record_id: (r.all_bacteria, r.all_otu)
           for r in P.profile_strings(P.profile_arrays(inf)).collect()}
    assert got == {1: ("c,a,b", "5,3,3"), 2: ("z", "1")}


def test_by_label_sums_two_accessions(spark):
    rows = [(1, "x", 2), (1, "x", 4), (1, "y", 5)]
    inf = spark.createDataFrame(rows, "record_id long, bacteria string, otu long")
    r = P.profile_strings(P.profile_arrays(inf, by_label=True)).collect()[0]
    assert (r.all_bacteria, r.all_otu) == ("x,y", "6,5")
    r = P.profile_strings(P.profile_arrays(inf)).collect()[0]
    assert (r.all_bacteria, r.all_otu) == ("y,x,x", "5,4,2")


profiles = st.dictionaries(st.integers(0, 20),
                           st.dictionaries(st.text("abcdef", min_size=1, max_size=3),
                                           st.integers(1, 50), min_size=1, max_size=6),
                           min_size=1, max_size=6)


@settings(max_examples=15, deadline=None)
@given(profiles)
def test_explode_is_inverse_and_shares_sum_to_100(spark, data):
    rows = [(rid, b, o) for rid, d in data.items() for b, o in d.items()]
    inf = spark.createDataFrame(rows, "record_id long, bacteria string, otu long")
    arrays = P.profile_arrays(inf)
    back = P.explode_profile(P.profile_strings(arrays)).collect()
    assert sorted((r.record_id, r.bacteria, r.otu) for r in back) == sorted(rows)
    for rid, d in data.items():
        order = sorted(d.items(), key=lambda kv: (-kv[1], kv[0]))
        assert [(r.pos, r.bacteria) for r in sorted((r for r in back if r.record_id == rid),
                                                    key=lambda r: r.pos)] == \
            [(i, b) for i, (b, _) in enumerate(order)]
    shares = P.top_share(arrays, 3).collect()
    for rid, d in data.items():
        mine = [r for r in shares if r.record_id == rid]
        assert len(mine) == min(3, len(d))
        assert abs(sum(r.share for r in mine) - 100.0) <= 0.0001 * len(mine) + 1e-9


def test_share_rounding_is_half_up(spark):
    # 1/128 of 100 = 0.78125 -> 0.7813 ; 127/128 -> 99.21875 -> 99.2188
    rows = [(1, "a", 1), (1, "b", 127)]
    inf = spark.createDataFrame(rows, "record_id long, bacteria string, otu long")
    got = {r.bacteria: r.share for r in P.top_share(P.profile_arrays(inf), 10).collect()}
    assert got == {"a": 0.7813, "b": 99.2188}


def test_level_bands(spark):
    df = spark.createDataFrame([(x,) for x in [-1.0, 0.0, 0.99, 1.0, 4.5, 8.9, 9.0, 20.0]], "d double")
    got = {(r.band, r.label): r.n for r in P.level_bands(df, "d").collect()}
    assert got == {(0, "0-1"): 3, (1, "1-2"): 1, (4, "4-5"): 1, (8, "8-9"): 3}


def test_gene_counts_filter_and_guard(spark):
    hits = spark.createDataFrame(
        [("s1", "NC_1"), ("s1", "NC_1"), ("s1", "XNC_2"), ("s1", "AB_3"), ("s2", "NC_1"), ("s2", None)],
        "sample string, gene string")
    counts = {(r.sample, r.gene): r.otu for r in A.gene_counts(hits).collect()}
    assert counts == {("s1", "NC_1"): 2, ("s1", "XNC_2"): 1, ("s2", "NC_1"): 1}
    guarded = A.min_rows_guard(A.gene_counts(hits), ["sample"], min_rows=2)
    assert {r.sample for r in guarded.collect()} == {"s1"}


def test_annotation_and_patient_join(spark):
    counts = spark.createDataFrame([(0, "NC_1", 4), (0, "NC_9", 1), (1, "NC_1", 2)],
                                   "index int, gene string, otu long")
    tax = spark.createDataFrame([("NC_1", ["Bacteria", "Firmicutes"])], "gene string, lineage array<string>")
    labels = A.taxonomy_labels(tax)
    ann = A.annotate(counts, labels)
    assert {r.bacteria for r in ann.collect()} == {"Bacteria_Firmicutes"}
    assert [r.gene for r in A.unknown_genes(counts, labels).collect()] == ["NC_9"]
    patients = spark.createDataFrame([(0, 501), (1, 502)], "index int, record_id long")
    out = A.attach_patient(ann.select("index", "bacteria", "otu"), patients)
    assert sorted(out.columns) == ["bacteria", "otu", "record_id"]
    union = A.typed_union(A.infection_seed(spark), out.select(F.lit(7).cast("bigint").alias("index"),
                                                              "bacteria", "otu"))
    assert dict(union.dtypes) == {"index": "bigint", "bacteria": "string", "otu": "bigint"}
