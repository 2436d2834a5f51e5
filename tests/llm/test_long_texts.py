"""Pages and texts that once took time quadratic in their length, and furniture within lines."""

import time

import pytest

from sentinela.llm import html_extract, license_scan

UNITS = ["<div>x ", "<a x ", '<p a="', '<p a=">', "<a", "<title>x", "<title>x</title ", "<nav><article>x", "<li><p>x", "<!-- ", "</p",
         '<span class="sidebar-x content"> y', "<p a=\"'>'\">x", "<p a='\"'> ", "<select>x", "< ", "<svg><path/>"]


@pytest.mark.parametrize("unit", UNITS)
def test_a_page_of_a_megabyte(unit):
    page = unit * (1_000_000 // len(unit))
    t = time.process_time()
    html_extract.blocks(page)
    assert time.process_time() - t < 4


def test_furniture_goes_wherever_it_stands():
    page = ("<article>Hi <span class='advert'>BUY</span> there<span hidden>x</span><span style='display:none'>y</span>"
            "<a class='share'>S</a><button>B</button><label>L</label><p>two</p><article class='comment'>c</article>"
            "<div class='promo-box'>q</div><div class=site-notice>n</div><div class='alert-box'>a</div>"
            "<ol class=commentlist><li>z</ol></article><article class=ad>AD</article><article hidden>H</article>")
    assert html_extract.article_text(page) == "Hi there\n\ntwo"
    # a class alone does not take a page its only article
    assert html_extract.article_text("<nav>m</nav><article class='related'>the story of it</article>") == "the story of it"
    assert html_extract.article_text("<article>a <b class='lead'>b</b> c</article>") == "a b c"


def test_tags_end_where_they_did():
    cases = {"<p title='a>b'>x</p>": "x", '<p title="a>b>x</p>': 'b>x', "a < b <i>c</i>": "a < b c", "x<!-- <p> -->y": "xy",
             "x<!-- y": "x", "<p a=1 b='2\"'>q": "q", "a<b": "a<b", "</>z": "z", "<p/>t": "t", "<a\"b>c": "c"}
    for page, want in cases.items():
        assert [t for _, t in html_extract.blocks(page)] == [want], page


def test_word_numbers_in_a_long_text(spark):
    unit = "all rights reserved foo bar "
    n = 1_100_000 // len(unit)
    df = spark.createDataFrame([(1, unit * n + "under the mit license")], "doc_id long, text string").coalesce(1)
    rows = license_scan.scan(df)
    rows.count()                                                      # starts the worker
    t = time.time()
    r = rows.collect()[0]
    assert time.time() - t < 6
    assert (r.n_words, r.first_word, r.last_word) == (5 * n + 4, 5 * n, 5 * n)
    firsts = [d.first_word for d in r.detections if d.n_words == 3]
    assert firsts[:3] == [0, 5, 10] and len(firsts) >= n


def test_equal_rows_are_dealt_over_tasks(spark):
    from pyspark.sql import functions as F

    from sentinela.llm import ring_shard
    docs = spark.range(3_000_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    out = ring_shard.shard_rows(docs)
    tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 3_000_000 and len(tasks) >= 8 and max(tasks) < 1_000_000
    ends = out.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"),
                                    F.countDistinct("slot").alias("d")).collect()
    assert len(ends) == 8 and all((r.n, r.a, r.b, r.d) == (375_000, 0, 374_999, 375_000) for r in ends)


def test_packing_tasks_do_not_grow_with_the_groups(spark, monkeypatch):
    from sentinela.llm import token_pack
    monkeypatch.setattr(token_pack, "MAX_TASKS", 6)
    docs = spark.createDataFrame([(i, f"text {i} " * 40) for i in range(300)] + [(7, "same row " * 40)] * 200,
                                 "doc_id long, text string")
    made = token_pack.grouped(docs, "doc_id", "text", 2000)
    assert made.rdd.getNumPartitions() == 6
    rows = made.collect()
    assert len(rows) == 500 and len({r.grp for r in rows}) > 50
    assert len({r.grp for r in rows if r.id == 7 and r.text.startswith("same")}) > 10
