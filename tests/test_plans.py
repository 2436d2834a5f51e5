"""Plan shape checks: no Python, no single-partition exchange,
broadcasts where proven small, pushed filters, partial top-k."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from sentinela.operators import reports as Q


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan(fn(spark, SMALL)) for k, fn in E.QUERIES.items()}


def test_no_python_and_no_single_partition(plans):
    for key, txt in plans.items():
        for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                    "SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in txt, (key, bad)


def test_small_sides_broadcast(plans):
    for key in ("taxonomy_join", "patient_index", "read_mapping", "skip_leading_rows"):
        assert "BroadcastHashJoin" in plans[key], key


def test_partial_top_k(spark):
    from sentinela.operators.rows import first_rows
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    txt = plan(first_rows(docs, 3, ["lang"], ["doc_id"]))
    assert txt.count("WindowGroupLimit") >= 2   # partial before the shuffle, final after


def test_contains_and_lookup_pushed_to_scan(spark, plans):
    assert "StringContains(event_type,i)" in plans["gene_abundance"]
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select(
        F.col("o_custkey").alias("record_id"), "o_orderdate")
    txt = plan(Q.lookup(orders, "record_id", 42))
    assert "EqualTo(o_custkey,42)" in txt


def test_column_pruning(plans):
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plans["gene_abundance"]
    assert "ReadSchema: struct<l_orderkey:bigint>" in plans["key_check"]


def test_no_costly_filter_inferred_into_scans(plans):
    """A join on a derived column infers ``isnotnull(derived)``; when the column
    may be NULL that filter is pushed below the shuffle and computes the
    derivation (tokenizing, bucket search, k-mer cutting) a second time.
    Derived join keys are therefore built non-NULL."""
    for key, txt in plans.items():
        for costly in ("isnotnull(substring", "isnotnull(array_remove", "isnotnull(split",
                       "isnotnull(reverse", "isnotnull(cast(bucketizer"):
            assert costly not in txt, (key, costly)
