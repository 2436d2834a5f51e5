"""Partition and size-check helpers."""

from pyspark.sql import functions as F

from sentinela.operators.joins import broadcast_if_small, fits, total_at_most
from sentinela.operators.partitions import pin, spread
from sentinela.session import scale_conf, scratch_path, shared_root


def test_spread_only_narrow_inputs(spark):
    narrow = spark.range(0, 100, numPartitions=1)
    wide = spark.range(0, 100, numPartitions=64)
    assert spread(narrow, ["id"]).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(wide, ["id"]) is wide


def test_size_checks(spark):
    df = spark.range(1000)
    assert fits(df, 1000) and not fits(df, 999)
    assert total_at_most(df, F.col("id"), 999 * 1000 // 2)
    assert not total_at_most(df, F.col("id"), 999 * 1000 // 2 - 1)
    assert broadcast_if_small(df, 1000).count() == 1000


def test_pin_cuts_lineage_into_shared_folder(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 3)
    pinned = pin(df)
    assert sorted(r.x for r in pinned.collect()) == [3 * i for i in range(10)]
    assert scratch_path(spark, "a").startswith(shared_root(spark))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_scale_conf():
    conf = scale_conf(10 * 2**40, 4000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 81920
    assert scale_conf(10, 8)["spark.sql.shuffle.partitions"] == "16"
