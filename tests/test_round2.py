"""Hot order keys, NULL groups, stepwise cuts, identity, byte bounds, archive, pharmacy rejects."""

import os
import random

from pyspark.sql import functions as F

from sentinela.operators import abundance as A
from sentinela.operators import mapping as M
from sentinela.operators import records as R
from sentinela.operators import rows as W
from sentinela.operators.joins import fits, new_items
from sentinela.streaming.incremental import load_new_files, read_loaded


def test_row_index_spreads_one_hot_first_key(spark):
    df = spark.range(40_000).select(F.lit(7).alias("day"), F.xxhash64("id").alias("code"), "id")
    got = W.row_index(df, ["day", "code"], n_buckets=16)
    tasks = got.groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert len(tasks) == 16 and max(r["count"] for r in tasks) < 8_000
    rows = got.select("code", "idx").collect()
    assert [r.idx for r in sorted(rows, key=lambda r: r.code)] == list(range(40_000))


def test_row_index_null_groups_strings_and_clashing_names(spark):
    df = spark.createDataFrame([(None, "b", 1), (None, "a", 2), ("x", None, 3), ("x", "z", 4), ("y", "q", 5)],
                               "g string, k string, _row_mid int")
    got = {r._row_mid: r.idx for r in W.row_index(df, ["k"], ["g"], n_buckets=3).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 1, 5: 0}
    assert W.row_index(df.limit(0), ["k"], ["g"]).collect() == []


def test_number_samples_in_name_order(spark):
    hits = spark.createDataFrame([("s2",), ("s10",), ("s1",), ("s2",)], "sample string")
    assert {r.sample: r["index"] for r in A.number_samples(hits).collect()} == {"s1": 0, "s10": 1, "s2": 2}


def test_cut_covers_long_and_empty_sequences(spark):
    rnd = random.Random(2)
    seqs = {i: "".join(rnd.choice("ACGT") for _ in range(n)) for i, n in enumerate([0, 1, 99, 100, 101, 9_999, 250_321])}
    df = spark.createDataFrame([*seqs.items(), (99, None)], "id int, seq string")
    got = {}
    for r in M.cut(df, ["id"], "seq", 100, 7).collect():
        got.setdefault(r.id, []).append((r.start, r.piece, r.n))
    for i, seq in [*seqs.items(), (99, "")]:
        want = [(a, seq[a:a + 107], min(100, len(seq) - a)) for a in range(0, max(len(seq), 1), 100)]
        assert sorted(got[i]) == want


def test_identity_counts_bases(spark):
    rnd = random.Random(4)
    g = "".join(rnd.choice("ACGT") for _ in range(1_000))
    swap = {"A": "C", "C": "G", "G": "T", "T": "A"}
    one = g[300:350] + swap[g[350]] + g[351:400]                    # one base of 100 differs
    rc = one[::-1].translate(str.maketrans("ACGT", "TGCA"))
    over = g[950:] + "".join(rnd.choice("ACGT") for _ in range(50))  # half of it lies past the end
    reads = spark.createDataFrame([("a", one), ("b", rc), ("c", over), ("d", g[:100][:40] + "N" + g[41:100])],
                                  "read_id string, seq string")
    refs = spark.createDataFrame([("G", g), ("G", g)], "ref_id string, seq string")
    for bound in (10 ** 6, 0):
        got = {r.read_id: (r.start, r.end, r.strand, r.identity) for r in
               M.map_reads(reads, refs, k=15, max_broadcast_rows=bound).collect()}
        assert got == {"a": (300, 400, "+", 0.99), "b": (300, 400, "-", 0.99), "c": (950, 1050, "+", 0.5),
                       "d": (0, 100, "+", 0.99)}


def test_broadcast_bound_counts_bytes(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit("y")).alias("a"))
    assert fits(wide, 100, max_bytes=20_000) and not fits(wide, 100, max_bytes=9_000)
    assert fits(spark.range(10), 10, max_bytes=160) and not fits(spark.range(10), 10, max_bytes=159)


def test_new_items_with_hot_done_key(spark):
    done = spark.range(5_000).select(F.lit(3).cast("bigint").alias("id"))
    assert sorted(r.id for r in new_items(spark.range(5), done, "id").collect()) == [0, 1, 2, 4]


def test_inbox_is_empty_after_every_load(spark, tmp_path):
    inbox, sink, ckpt, arch = (str(tmp_path / n) for n in ("inbox", "sink", "ckpt", "archive"))
    df = spark.range(6).select("id")

    def left():
        return [n for _, _, names in os.walk(inbox) for n in names if n.endswith(".parquet")]

    for i in range(3):
        if i != 1:                                                  # the second load finds nothing new
            df.filter(F.col("id") % 3 == i).coalesce(1).write.parquet(f"{inbox}/b{i}")
        load_new_files(spark, f"{inbox}/*", sink, ckpt, df.schema, archive_dir=arch)
        assert left() == []
    assert sorted(r.id for r in read_loaded(spark, sink).collect()) == [0, 2, 3, 5]
    assert len([n for _, _, names in os.walk(arch) for n in names if n.endswith(".parquet")]) == 2


def test_pharmacy_rejects(spark):
    rows = [("12.0", "2019-01-02 03:04:05"), ("x", "2019-01-02 03:04:05"), ("13", "junk"), (None, None)]
    raw = spark.createDataFrame([(i, None, None, None, 1.0, 2.0, d) for i, d in rows],
                                "`Discharge ID` string, `Drug Class Title` string, `Therapeutic Category Title` string, "
                                "`Generic Drug Title` string, `Adj Pharmacy Charges` double, `Pharmacy Charges` double, "
                                "`Date Of Service` string")
    clean, bad = R.split_rejects(R.pharmacy(raw, rejects=True))
    assert [r.record_id for r in clean.collect()] == [12] and "reject_reason" not in clean.columns
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_date", "bad_id", "bad_id"]
