"""Registered queries: DuckDB where there is SQL, contract columns, held-out quality, the pipeline end to end."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SMALL  # noqa: E402
from test_oracle import _rows  # noqa: E402

import corpus_pipeline  # noqa: E402
import public_tokenizers  # noqa: E402
from sentinela.llm import queries as Q  # noqa: E402
from sentinela.llm import quality_rules  # noqa: E402


def test_the_entry_registers_all():
    import __spark_entry__ as E
    assert set(Q.QUERIES) <= set(E.queries()) and set(Q.ORACLE_SQL) <= set(E.oracle_sql())
    assert [k for k in Q.QUERIES if k.startswith("op")] == sorted(
        (k for k in Q.QUERIES if k.startswith("op")), key=lambda k: int(re.match(r"op(\d+)_", k)[1]))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("key", sorted(Q.ORACLE_SQL))
def test_query_matches_oracle(spark, duck, key):
    df = Q.QUERIES[key](spark, SMALL)
    rel = duck.sql(Q.ORACLE_SQL[key])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, want)


@pytest.mark.parametrize("key", ["op6_quality_rules", "op7_line_dedup"])
def test_native_queries_run_no_python(spark, key):
    plan = Q.QUERIES[key](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|mapIn", plan)


def test_held_out_labels(spark):
    got = {r.doc_id: r for r in Q.op1_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [(got[r.doc_id].predicted, r.quality) for r in labels if r.doc_id in got and got[r.doc_id].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.93
    junk = [p for p, q in held if q == 0]
    assert junk.count(0) > 0.6 * len(junk)


def test_pipeline_equals_its_stages_by_hand(spark):
    """The pipeline's rows against plain Python on sf0.001."""
    import hashlib
    from collections import Counter

    from tokenizers import Tokenizer

    from test_operators import brute_fingerprint, lowered, roots, words_of
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    good = {r.doc_id for r in quality_rules.judge(spark.read.parquet(f"{SMALL}/documents.parquet")).filter("__quality.kept").collect()}
    docs = {i: t for i, t in docs.items() if i in good}
    key = lambda x: lowered(x.strip(" \t\n\x0b\x0c\r"))
    seen = Counter(k for t in docs.values() for k in {key(x) for x in t.split("\n")})
    docs = {i: "\n".join(x for x in t.split("\n") if not key(x) or seen[key(x)] < 10) for i, t in docs.items()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    root = roots(fps.values(), 2)
    first = {}
    for i in sorted(docs):
        first.setdefault(root[fps[i]], i)
    docs = {i: docs[i] for i in first.values()}
    wins = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        ws = words_of(r.text)
        wins |= {tuple(ws[k:k + min(10, len(ws))]) for k in range(len(ws) - min(10, len(ws)) + 1) if ws}
    sizes = {len(w) for w in wins}
    docs = {i: t for i, t in docs.items() if not any(
        tuple(ws[k:k + n]) in wins for ws in [words_of(t)] for n in sizes for k in range(len(ws) - n + 1))}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    lib.no_padding()
    want = {i: lib.encode(t, add_special_tokens=False).ids for i, t in docs.items()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: r.ids for r in rows} == want and len(rows) == len(want) > 20
    assert all(r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() for r in rows)
