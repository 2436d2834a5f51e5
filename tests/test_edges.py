"""Edges of cleaning, sources and mapping: numbers, bands, shares, samples, FASTA headers, read keys."""

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from sentinela.functions import cleaning as C
from sentinela.operators import abundance as A
from sentinela.operators import mapping as M
from sentinela.operators import profile as P
from sentinela.operators import warehouse as H
from sentinela.sources import files as S


def test_numbers_follow_python_float(spark):
    texts = ["1.0d", "2f", "1_000", "1__0", "_1", "1.5e3", " 7 ", ".5", "5.", "1e", "inf", "-Infinity", "NaN", "", "0x10",
             "1_0.2_5e1_0", "+3", "--3", "1L"]

    def py(t):
        try:
            return repr(float(t))
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.parse_double("t").alias("v"))
    assert {r.t: None if r.v is None else repr(r.v) for r in df.collect()} == {t: py(t) for t in texts}


def test_band_and_share_edges(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (0.5,), (42.0,)], "v double")
    assert {(r.band, r.n) for r in P.level_bands(df, "v").collect()} == {(0, 2), (8, 1)}
    big = spark.createDataFrame([(4_600_000_000_000_000, 9_200_000_000_000_000), (1, 3), (2, 3), (0, 5)], "p long, t long")
    assert [r.s for r in big.select(C.share_rounded("p", "t").alias("s")).collect()] == [50.0, 33.3333, 66.6667, 0.0]


def test_sample_is_the_folder_and_the_annotation_job_runs_from_files(spark, tmp_path):
    line = "\t".join(["r1", "100", "x", "1", "1", "0.9", "s", "i", "{gene}", "1", "2"])
    for sample, part, gene in [("S1", 0, "NC_1"), ("S1", 1, "NC_1"), ("S1", 1, "NC_2"), ("S2", 0, "NC_1"), ("S3", 0, "XX_1")]:
        path = tmp_path / "otu" / sample / f"part-{part}-{gene}"
        write_text(str(path), [line.format(gene=gene)])
    write_text(str(tmp_path / "patients.csv"), ["id", "11.0", "12.0", "13.0"])
    hits = S.read_mapping_result(spark, f"{tmp_path}/otu/*")
    labels = spark.createDataFrame([("NC_1", "one"), ("NC_2", "two")], "gene string, bacteria string")
    pairs = A.positional_pairs(hits, S.read_patient_index(spark, f"{tmp_path}/patients.csv"))
    rows = A.infection_from_hits(hits, labels, pairs)
    assert {(r.sample, r.bacteria, r.otu, r.record_id) for r in rows.collect()} == {("S1", "one", 2, 11), ("S1", "two", 1, 11)}


def test_fasta_header_may_hold_the_mark(spark, tmp_path):
    write_text(str(tmp_path / "f" / "a.fna"), [">NC_1 mutation A>G strain", "ACGT", "AC", ">NC_2 other", "GGTT"])
    got = {(r.ref_id, r.description, r.seq) for r in S.read_fasta(spark, f"{tmp_path}/f").collect()}
    assert got == {("NC_1", "NC_1 mutation A>G strain", "ACGTAC"), ("NC_2", "NC_2 other", "GGTT")}


def test_mates_and_repeated_references(spark):
    import random
    random.seed(5)
    genome = "".join(random.choice("ACGT") for _ in range(600))
    refs = spark.createDataFrame([("R", genome), ("R", genome)], "ref_id string, seq string")
    reads = spark.createDataFrame([("s", 1, "x", genome[10:110]), ("s", 2, "x", genome[300:400])],
                                  "sample string, mate int, id string, seq string")
    got = {(r.mate, r.start, r.seeds, r.identity) for r in
           M.map_reads(reads, refs, k=15, read_id=["sample", "mate", "id"]).collect()}
    assert got == {(1, 10, 86, 1.0), (2, 300, 86, 1.0)}


def test_recast_keeps_order_and_refuses_unknown_columns(spark, tmp_path):
    H.drop_table(spark, "recast_t")
    H.create_table_as(spark, "recast_t", "SELECT '1' AS a, 'x' AS b", f"{tmp_path}/t0")
    with pytest.raises(ValueError):
        H.recast(spark, "recast_t", {"zz": "INT"})
    H.recast(spark, "recast_t", {"a": "INT"}, f"{tmp_path}/t1")
    assert spark.table("recast_t").dtypes == [("a", "int"), ("b", "string")]
    H.drop_table(spark, "recast_t")


def test_texts_keep_their_letters(spark):
    df = spark.createDataFrame([("L'été à Ñandú, straße!",)], "t string").select(M.word_tokens(F.col("t")).alias("w"))
    assert df.first().w == ["l", "été", "à", "ñandú", "straße"]
