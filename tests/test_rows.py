"""Positions across files and splits (W1, P5, W2, S6) and distributed row numbers."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from sentinela.operators import rows as W
from sentinela.sources import files as S


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    old_open = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", old_open)


def _files(tmp_path, n_files=3, n_lines=700):
    for f in range(n_files):
        write_text(str(tmp_path / "txt" / f"part-{f:05d}.txt"),
                   [f"file{f};line{i};{'x' * (i % 17)}" for i in range(n_lines)])
    return str(tmp_path / "txt")


def test_line_index_many_splits(spark, tmp_path, small_splits):
    path = _files(tmp_path)
    lines = S.read_lines(spark, path)
    assert lines.rdd.getNumPartitions() > 6  # really several splits per file
    got = W.line_index(lines).select(
        F.split("value", ";")[1].alias("tag"), "idx").collect()
    assert len(got) == 3 * 700
    assert all(r.tag == f"line{r.idx}" for r in got)


def test_line_index_same_for_any_split_size(spark, tmp_path):
    path = _files(tmp_path, 2, 300)
    one = {(r.file, r.value, r.idx) for r in W.line_index(S.read_lines(spark, path)).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        many = {(r.file, r.value, r.idx) for r in W.line_index(S.read_lines(spark, path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert one == many


def test_skip_three_per_file_after_one_field_filter(spark, tmp_path, small_splits):
    for f in range(2):
        write_text(str(tmp_path / "d" / f"f{f}.csv"),
                   ["h;1", "single", "h;2", "h;3"] + [f"{f};{i}" for i in range(400)])
    df = S.read_delimited(spark, str(tmp_path / "d"), sep=";", skip=3)
    rows = df.select(F.col("fields")[0].alias("f"), F.col("fields")[1].cast("int").alias("i"),
                     "line").collect()
    assert len(rows) == 800
    assert all(r.line == r.i + 3 for r in rows)


def test_fastq_framing_with_at_quality_lines(spark, tmp_path, small_splits):
    recs = []
    for i in range(300):
        qual = "@" + "I" * (i % 9)          # quality line starting with '@'
        seq = "ACGT"[i % 4] * (1 + i % 9)
        recs += [f"@read{i} extra", seq, "+", qual]
    write_text(str(tmp_path / "fq" / "s1_1.fastq"), recs[:600])
    write_text(str(tmp_path / "fq" / "s1_2.fastq"), recs[600:])
    got = S.read_fastq(spark, str(tmp_path / "fq")).collect()
    assert len(got) == 300
    for r in got:
        i = int(r.read_id[4:])
        assert r.seq == "ACGT"[i % 4] * (1 + i % 9)
        assert r.qual == "@" + "I" * (i % 9)
        assert r.n_lines == 4


def _brute_rank(rows, part, order):
    out = {}
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[p] for p in part), []).append(r)
    for g in groups.values():
        for i, r in enumerate(sorted(g, key=lambda r: tuple(r[o] for o in order))):
            out[r["id"]] = i
    return out


@pytest.mark.parametrize("n_buckets", [1, 3, 17])
def test_row_index_matches_brute_force_with_hot_group(spark, n_buckets):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{rnd.randrange(20)}"   # one group holds a third
        rows.append({"id": i, "g": g, "k": rnd.randrange(500), "t": rnd.random()})
    df = spark.createDataFrame(rows)
    got = {r.id: r.idx for r in W.row_index(df, ["k", "id"], ["g"], n_buckets=n_buckets).collect()}
    assert got == _brute_rank(rows, ["g"], ["k", "id"])


def test_row_index_global_and_timestamp_key(spark):
    df = spark.range(0, 5000, 7).select(F.col("id"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    got = W.row_index(df, ["ts"], n_buckets=9).collect()
    assert sorted(r.idx for r in got) == list(range(len(got)))
    assert all(r.idx == r.id // 7 for r in got)


def test_chunks_cover_input(spark):
    df = spark.range(0, 2345).select("id", (F.col("id") % 3).alias("g"))
    ch = W.chunk_numbers(df, 100, ["g"], ["id"], n_buckets=5)
    per = ch.groupBy("g", "chunk").count().collect()
    assert sum(r["count"] for r in per) == 2345
    for g in range(3):
        sizes = sorted((r.chunk, r["count"]) for r in per if r.g == g)
        assert all(c == 100 for _, c in sizes[:-1]) and 0 < sizes[-1][1] <= 100
        assert [c for c, _ in sizes] == list(range(1, len(sizes) + 1))


def test_skip_leading_and_first_rows(spark):
    df = spark.range(0, 1000).select("id", (F.col("id") % 4).alias("g"))
    kept = W.skip_leading(df, 3, ["g"], ["id"])
    assert kept.count() == 1000 - 12
    assert kept.filter(F.col("id") < 12).count() == 0
    first = W.first_rows(df, 2, ["g"], ["id"]).orderBy("id").collect()
    assert [r.id for r in first] == list(range(8))


@pytest.mark.parametrize("later", [
    {"spark.sql.leafNodeDefaultParallelism": "7"},
    {"spark.sql.files.maxPartitionBytes": "20000"},
    {"spark.sql.files.openCostInBytes": "4194304", "spark.sql.leafNodeDefaultParallelism": "1"},
])
def test_line_index_never_loses_a_line(spark, tmp_path, later):
    """Settings that change the file splits between the two passes either leave
    the numbering right or raise; the session's settings are left as found."""
    for f in range(2):
        write_text(str(tmp_path / "big" / f"part-{f}.txt"), [f"{f}:{i}" for i in range(20000)])
    first = {"spark.sql.files.openCostInBytes": "0", "spark.sql.leafNodeDefaultParallelism": "2"}
    keys = {*first, *later, "spark.sql.files.minPartitionNum"}
    saved = {k: spark.conf.get(k, None) for k in keys}
    raised = False
    try:
        for k, v in first.items():
            spark.conf.set(k, v)
        before = spark.conf.get("spark.sql.files.minPartitionNum", None)
        numbered = W.line_index(S.read_lines(spark, str(tmp_path / "big")))   # first pass runs here
        assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before
        for k, v in later.items():
            spark.conf.set(k, v)
        try:
            got = {(r.file.rsplit("/", 1)[-1], r.value): r.idx for r in numbered.collect()}
        except Exception as e:
            assert "file splits changed" in str(e)
            raised = True
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if not raised:
        assert got == {(f"part-{f}.txt", f"{f}:{i}"): i for f in range(2) for i in range(20000)}


def test_skip_leading_keeps_other_groups_and_skips_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 2), ("b", 5), ("b", 6), ("c", None), ("c", 9),
                                (None, 4), (None, 7)], "g string, v int")
    kept = sorted(((r.g or "~", r.v) for r in W.skip_leading(df, 1, ["g"], ["v"]).collect()))
    assert kept == [("a", 2), ("a", 3), ("b", 5), ("b", 6), ("c", 9), ("~", 7)]


def test_row_index_sorts_nan_last(spark):
    df = spark.createDataFrame([(float(i),) for i in range(19)] + [(float("nan"),)], "v double")
    got = {str(r.v): r.idx for r in W.row_index(df, ["v"], n_buckets=4).collect()}
    assert got["nan"] == 19 and got["0.0"] == 0 and got["18.0"] == 18
