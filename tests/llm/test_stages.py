"""The pipeline's stages on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SMALL  # noqa: E402

import corpus_pipeline  # noqa: E402
from sentinela.llm import line_dedup, quality_rules  # noqa: E402

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, __text string, __row int, __t1 long, "
          "__kept_n int, __quality string, `odd.name` int")
STAGE = dict(corpus_pipeline.STAGES)


def sentence(seed, n=80):
    words = "the of and to in that it was for on are with as his they at be this from have river stone cloud lantern".split()
    return " ".join(words[(seed * 7 + i * (seed + 3) + i * i) % len(words)] + (str(i) if i % 3 == 0 else "") for i in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), "t", 1, 2, 3, "q", 4) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    return [(1, None), (2, ""), (3, sentence(1)), (3, sentence(1)), (None, sentence(2)), (None, None), (4, sentence(3) + "\n" + item),
            (5, sentence(4, 60_000)), (6, sentence(1)), (7, sentence(5)), (8, "short")]


@pytest.mark.parametrize("name", list(STAGE))
def test_stage_keeps_columns_and_takes_empty_tables(spark, rows, name):
    df = frame(spark, rows)
    out = STAGE[name](spark, df, SMALL)
    got = out.collect()
    assert STAGE[name](spark, df.limit(0), SMALL).collect() == []
    if name.startswith("bpe"):
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and len(got) == len(rows)
        assert all((r.n_tokens == 0) == (r.ids == []) for r in got)
        return
    assert out.columns == df.columns and out.dtypes == df.dtypes
    assert all(r["odd.name"] == 4 and r.__getitem__("__text") == "t" and r["__kept_n"] == 3 for r in got)
    ids = [(r.doc_id, r.text) for r in got]
    if name.startswith("quality"):
        assert all(t and len(t.split()) >= 50 for _, t in ids) and (5, sentence(4, 60_000)) in ids
        assert ids.count((3, sentence(1))) in (0, 2)
    elif name.startswith("line"):
        assert len(ids) == len(rows) and ids.count((1, None)) == 1
    elif name.startswith("simhash"):
        assert sum(t == sentence(1) for _, t in ids) == 1 and (3, sentence(1)) in ids
        assert sum(not t for _, t in ids) == 1
    else:
        assert not any(i == 4 for i, _ in ids) and len(ids) == len(rows) - 1


def test_the_whole_pipeline_on_odd_rows(spark, rows):
    docs = frame(spark, rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    left = docs.collect()
    assert len({r.doc_id for r in left}) == len(left) and 4 not in {r.doc_id for r in left}


def test_a_clash_with_a_returned_column_raises(spark, rows):
    df = frame(spark, rows)
    with pytest.raises(ValueError):
        quality_rules.judge(df)
    out = line_dedup.drop_common_lines(df)
    assert out.columns == [*df.columns, "__lines"] and out.count() == len(rows)


def test_clean_texts_of_other_languages_and_in_capitals_stay(spark, duck):
    english = "the river runs to the sea and the stones of it are worn by water that was ice on hills "
    texts = {"capitals": english.upper() * 4, "polish": "kot nie jest na dachu i się nie boi że spadnie oraz jak ptak siedzi " * 6,
             "turkish": "bu kedi bir damda ve çok mutlu olarak daha uzun bakar gibi durur için " * 6,
             "russian": "кот и пёс не на крыше в саду что он как дома это из книги сказок " * 6,
             "hindi": "यह एक बिल्ली है जो छत पर बैठी है और आकाश देखती रहती सुबह शाम " * 6,
             "junk": "xkq zzvw qqpr lmnt brrt wvxk plok mnbz qwrt zxcv " * 8}
    # words differ from line to line, so that no window repeats
    texts = {k: " ".join(w + (str(i) if i % 3 == 2 else "") for i, w in enumerate(t.split())) for k, t in texts.items()}
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(texts.items())], "doc_id long, kind string, text string")
    got = {r.kind: r.kept for r in quality_rules.judge(df).select("kind", "__quality.kept").collect()}
    assert got == {k: k != "junk" for k in texts}
    from sentinela.llm.queries import ORACLE_SQL
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t in enumerate(texts.values())])
    told = {r[0]: r[-1] for r in con.sql(ORACLE_SQL["op6_quality_rules"]).fetchall()}
    assert [told[i] for i in range(len(texts))] == [got[k] for k in texts]
