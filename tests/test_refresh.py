"""Incremental annotation, profile refresh, key-guarded appends, lookups, co-bucketed joins, rejects at the source."""

import glob
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from sentinela.operators import abundance as A
from sentinela.operators import profile as P
from sentinela.operators import records as R
from sentinela.operators import refresh
from sentinela.operators import reports as Q
from sentinela.operators import warehouse as H
from sentinela.sources import files as S
from sentinela.streaming.annotation import SampleLoad


def _drop(root, sample, part, genes):
    rows = ["\t".join(["r", "100", "9%", "1", "1", "0.9", "s", "+", g, "1", "2"]) for g in genes]
    write_text(f"{root}/{sample}/part-{part}.tsv", rows)


def _labels(spark):
    return spark.createDataFrame([(f"NC_{i}", f"B{i}") for i in range(1, 4)], "gene string, bacteria string")


def _rows(load):
    return {(r.sample, r.bacteria, r.otu) for r in load.annotated().collect()}


def test_incremental_annotation_survives_a_failure_after_the_write(spark, tmp_path):
    inbox = f"{tmp_path}/in"

    class Failing(SampleLoad):
        def write(self, hits, batch):
            super().write(hits, batch)
            raise RuntimeError("lost after the write")

    args = (spark, f"{inbox}/*", f"{tmp_path}/store", _labels(spark))
    _drop(inbox, "s1", 0, ["NC_1", "NC_1", "NC_2", "XX_1"])
    _drop(inbox, "s2", 0, ["NC_1"])                                 # one row: not enough yet
    with pytest.raises(Exception, match="lost after the write"):
        Failing(*args).run()
    load = SampleLoad(*args)
    load.run()                                                      # the same batch again
    want = {("s1", "B1", 2), ("s1", "B2", 1)}
    assert _rows(load) == want and len(load.annotated().collect()) == 2
    load.run()                                                      # nothing new
    assert _rows(load) == want
    _drop(inbox, "s2", 1, ["NC_3", "NC_1", "NC_9"])                 # more of s2: counted whole
    _drop(inbox, "s3", 0, ["NC_2", "NC_3"])
    load.run()
    want |= {("s2", "B1", 2), ("s2", "B3", 1), ("s3", "B2", 1), ("s3", "B3", 1)}
    assert _rows(load) == want
    assert len(glob.glob(f"{tmp_path}/store/counts/batch=*")) == 2
    # untouched samples are not made again
    second = spark.read.parquet(f"{tmp_path}/store/infection/batch=1")
    assert {r.sample for r in second.select("sample").collect()} == {"s2", "s3"}


def test_incremental_annotation_by_single_files(spark, tmp_path):
    rnd = random.Random(3)
    want = {}
    for s in range(4):
        for p in range(3):
            genes = [f"NC_{rnd.randrange(1, 5)}" for _ in range(20)]
            _drop(f"{tmp_path}/in", f"s{s}", p, genes)
            for g in genes:
                if g != "NC_4":
                    want[f"s{s}", g.replace("NC_", "B")] = want.get((f"s{s}", g.replace("NC_", "B")), 0) + 1
    load = SampleLoad(spark, f"{tmp_path}/in/*", f"{tmp_path}/store", _labels(spark))
    load.run(max_files_per_trigger=5)
    assert _rows(load) == {(*k, n) for k, n in want.items()}


def _scans(df):
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        found += [node] if node.nodeName().startswith("Scan parquet") else []
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def _infection(spark, rnd, keys, n):
    return spark.createDataFrame([(rnd.choice(keys), rnd.choice(["a", "b", "c", None]), rnd.randrange(1, 5)) for _ in range(n)],
                                 "record_id long, bacteria string, otu long")


def test_refresh_equals_a_rebuild_and_reads_touched_buckets_only(spark, tmp_path):
    rnd = random.Random(1)
    rows, prof = f"{tmp_path}/rows", f"{tmp_path}/profiles"
    appends = [_infection(spark, rnd, list(range(200)), 600), _infection(spark, rnd, [3, 5, 999], 40),
               _infection(spark, rnd, [5, None], 10)]
    for i, df in enumerate(appends):
        before = set(glob.glob(f"{prof}/bucket=*/*.parquet"))
        touched = refresh.refresh_profiles(df, rows, prof, i, buckets=16)
        after = set(glob.glob(f"{prof}/bucket=*/*.parquet"))
        kept = {p for p in before if int(re.search(r"bucket=(\d+)", p)[1]) not in touched}
        assert kept <= after and len(touched) <= (16, 3, 2)[i]
        read = refresh.bucket_rows(spark, rows, touched)
        read.collect()
        scan, = _scans(read)
        assert scan.metrics().apply("numFiles").value() == sum(len(glob.glob(f"{rows}/bucket={b}/*/*.parquet")) for b in touched)
    refresh.refresh_profiles(appends[1], rows, prof, 1, buckets=16)     # the second append again
    everything = appends[0].unionByName(appends[1]).unionByName(appends[2])
    want = P.profile_strings(P.profile_arrays(everything, by_label=True))
    assert {tuple(r) for r in refresh.read_profiles(spark, prof).select(*want.columns).collect()} == {tuple(r) for r in want.collect()}


def test_append_new_keys(spark, tmp_path):
    path = f"{tmp_path}/t"
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (3, "c"), (None, "n")], "k long, v string")

    def told(df):
        return {(r.k, r.n, r.reason) for r in df.collect()}

    def rows():
        return sorted((r.k, r.v) for r in spark.read.parquet(path).collect())

    assert told(refresh.append_new_keys(one, path, "k", 0, buckets=4)) == {(3, 2, "repeated"), (None, 1, "null")}
    assert rows() == [(1, "a"), (2, "b"), (3, "c")]
    assert told(refresh.append_new_keys(one, path, "k", 1, buckets=4)) == {(1, 1, "exists"), (2, 1, "exists"), (3, 2, "exists"),
                                                                           (None, 1, "null")}
    assert rows() == [(1, "a"), (2, "b"), (3, "c")]
    refresh.append_new_keys(one, path, "k", 0, buckets=4)               # append 0 repeated
    two = spark.createDataFrame([(9, "x"), (1, "other")], "k long, v string")
    assert told(refresh.append_new_keys(two, path, "k", 2, buckets=4)) == {(1, 1, "exists")}
    assert rows() == [(1, "a"), (2, "b"), (3, "c"), (9, "x")]


def test_a_bucket_is_one_file_and_joins_move_nothing(spark, tmp_path):
    left = spark.range(5000).select(F.col("id").alias("record_id"), (F.col("id") * 2).alias("a")).repartition(20)
    right = spark.range(0, 5000, 3).select(F.col("id").alias("record_id"), F.lit(1).alias("b"))
    for name, df in (("co_left", left), ("co_right", right)):
        H.drop_table(spark, name)
        H.create_keyed_table(spark, name, df, "record_id", 8, location=f"{tmp_path}/{name}")
        assert len(glob.glob(f"{tmp_path}/{name}/*.parquet")) == 8
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = Q.patient_report(spark.table("co_left"), spark.table("co_right"))
        assert report.count() == 5000 and report.filter("b = 1").count() == 1667
        assert "Exchange" not in report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        for name in ("co_left", "co_right"):
            H.drop_table(spark, name)


def test_a_lookup_reads_few_rows(spark, tmp_path):
    rows = spark.range(200_000).select((F.col("id") * 7 % 200_003).alias("record_id"), F.xxhash64("id").alias("v"))
    H.write_lookup_table(rows, f"{tmp_path}/t", "record_id", 30_000, row_group_bytes=64 << 10)

    def scanned(value):
        df = Q.lookup(spark.read.parquet(f"{tmp_path}/t"), "record_id", value)
        got = df.collect()
        return got, sum(n.metrics().apply("numOutputRows").value() for n in _scans(df))

    got, read = scanned(7 * 1234 % 200_003)
    assert len(got) == 1 and 0 < read <= 60_000
    assert scanned(-5) == ([], 0)


def test_rejects_carry_their_place(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    write_text(f"{tmp_path}/j/x.json", ['{"a": 1, "b": "x"}', '{"a": "no", "b": "y"}', "{broken", "", '{"a": 2}'])
    clean, bad = R.split_rejects(S.read_checked(spark, f"{tmp_path}/j", schema))
    assert sorted((r.a, r.b, r.line) for r in clean.collect()) == [(1, "x", 0), (2, None, 4)]
    assert sorted((r.line, r.raw, r.reject_reason) for r in bad.collect()) == [
        (1, '{"a": "no", "b": "y"}', "malformed"), (2, "{broken", "malformed")]
    assert all(r.file.endswith("x.json") for r in bad.collect())
    write_text(f"{tmp_path}/c/x.tsv", ["1\tx", "two\ty", "3", "4\tz\tmore", "5\tw"])
    clean, bad = R.split_rejects(S.read_checked(spark, f"{tmp_path}/c", schema, sep="\t"))
    assert sorted((r.a, r.line) for r in clean.collect()) == [(1, 0), (5, 4)]
    assert sorted(r.line for r in bad.collect()) == [1, 2, 3]


def test_pharmacy_amounts(spark, tmp_path):
    def rec(i, amount):
        return ('{"Discharge ID": "%d", "Date Of Service": "2020-01-02 03:04:05", "Adj Pharmacy Charges": %s, '
                '"Pharmacy Charges": 2}' % (i, amount))
    write_text(f"{tmp_path}/p/x.json", [rec(1, "1.5"), rec(2, '"1.5"'), rec(3, '"abc"'), rec(4, "null"), rec(5, "1e3"), rec(6, '""')])
    out = R.pharmacy(S.read_json_records(spark, f"{tmp_path}/p", R.PHARMACY_SCHEMA), rejects=True)
    got = {r.record_id: (r.adj_pharmacy_charges, r.pharmacy_charges, r.reject_reason) for r in out.collect()}
    assert got == {1: (1.5, 2.0, None), 2: (1.5, 2.0, None), 3: (None, 2.0, "bad_number"), 4: (None, 2.0, None),
                   5: (1000.0, 2.0, None), 6: (None, 2.0, "bad_number")}


def test_unknown_genes_are_listed(spark):
    counts = spark.createDataFrame([("s", "NC_1", 3), ("s", "NC_9", 1), ("t", "NC_9", 2)], "sample string, gene string, otu long")
    assert [r.gene for r in A.unknown_genes(counts, _labels(spark)).collect()] == ["NC_9"]
