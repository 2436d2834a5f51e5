"""Every contract query against its DuckDB oracle (order-insensitive)."""

import math

import pytest

import __spark_entry__ as E
from conftest import SMALL

KEYS = sorted(E.QUERIES)


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        return ("f", repr(v)) if not math.isnan(v) else ("nan",)
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    return (type(v).__name__, str(v))


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(rel.columns, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["record_id", "pos", "bacteria", "otu", "share"]
    assert df.count() > 0
