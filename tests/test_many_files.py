"""Sources of very many small files: tasks that list them, files a folder, what stands beside them."""

import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from sentinela.llm import line_dedup
from sentinela.operators import rows as W
from sentinela.operators import warehouse as H
from sentinela.plans import contract as TC
from sentinela.plans import file_contract as FC
from sentinela.session import LISTING, OPEN_COST, few_listing_tasks
from sentinela.sources import files as S
from sentinela.streaming.annotation import SampleLoad

FOLDERS = 80


def _tasks(spark, group, work):
    """What ``work`` gives, and the largest number of tasks of a stage that it started by itself."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        made = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    track = spark.sparkContext.statusTracker()
    stages = [s for j in track.getJobIdsForGroup(group) for s in track.getJobInfo(j).stageIds]
    return made, max((i.numTasks for s in stages if (i := track.getStageInfo(s))), default=0)


def _inbox(root):
    for i in range(FOLDERS):
        write_text(f"{root}/sample={i:03}/part-0.tsv", ["\t".join(["r", "100", "9%", "1", "1", "0.9", "s", "+", "NC_1", "1", "2"])])
    return root


@pytest.mark.parametrize("read, rows", [(S.read_lines, FOLDERS), (S.read_mapping_result, FOLDERS), (S.list_objects, FOLDERS)])
def test_folders_are_listed_by_few_tasks(spark, tmp_path, read, rows):
    root, before = _inbox(str(tmp_path / "in")), spark.conf.get(LISTING)
    found, most = _tasks(spark, f"list-{read.__name__}", lambda: read(spark, root))
    assert 0 < most <= 4 * spark.sparkContext.defaultParallelism < FOLDERS
    assert found.count() == rows and spark.conf.get(LISTING) == before


def test_mapping_results_by_root_and_by_glob_are_one(spark, tmp_path):
    root = _inbox(str(tmp_path / "in"))
    by = [sorted(map(tuple, S.read_mapping_result(spark, p).collect())) for p in (root, f"{root}/*/part-*")]
    assert by[0] == by[1] and {r[-1] for r in by[0]} == {f"sample={i:03}" for i in range(FOLDERS)}


def test_sample_load_lists_its_inbox_by_few_tasks(spark, tmp_path):
    root, seen = _inbox(str(tmp_path / "in")), []

    class Load(SampleLoad):
        def write(self, hits, batch):
            seen.append(int(spark.conf.get(LISTING)))
            super().write(hits, batch)

    labels = spark.createDataFrame([("NC_1", "B")], "gene string, bacteria string")
    before = spark.conf.get(LISTING)
    load = Load(spark, f"{root}/*", f"{tmp_path}/store", labels, min_rows=1)
    load.run()
    assert seen == [4 * spark.sparkContext.defaultParallelism] and spark.conf.get(LISTING) == before
    assert load.annotated().count() == FOLDERS


def test_listing_setting_comes_back_after_an_error(spark):
    before = spark.conf.get(LISTING)
    with pytest.raises(ValueError):
        with few_listing_tasks(spark):
            raise ValueError
    assert spark.conf.get(LISTING) == before


def _captured(monkeypatch, name):
    paths, real = [], getattr(S, name)
    monkeypatch.setattr(FC.S, name, lambda spark, path: paths.append(path) or real(spark, path))
    return paths


def test_annotation_job_writes_two_part_files_a_ward(spark, tmp_path, monkeypatch):
    paths = _captured(monkeypatch, "read_mapping_result")
    kinds = F.element_at(F.array(*map(F.lit, ("view", "click", "error", "buy"))), (F.col("id") % 4 + 1).cast("int"))
    spark.range(4000).select(F.col("id").alias("event_id"), (F.col("id") % 120).alias("user_id"), kinds.alias("event_type")) \
        .write.parquet(f"{tmp_path}/events.parquet")
    spark.range(30).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name")).write.parquet(f"{tmp_path}/customer.parquet")
    got = FC.annotation_job(spark, str(tmp_path)).collect()
    assert Counter(r.bacteria for r in got) == {"Bacteria_click": 12, "Bacteria_buy": 12}
    assert sum(r.otu for r in got) == 2000
    root = paths[0].removesuffix("/*/part-*")
    files = glob.glob(f"{root}/*/part-*")
    by_ward = Counter(os.path.dirname(f) for f in files)       # both halves of a ward may fall to one task
    assert len(by_ward) == 12 and max(by_ward.values()) == 2


@pytest.mark.parametrize("query, reader", [(FC.fastq_chunks, "read_fastq"), (FC.sequencing_pipeline, "read_fastq")])
def test_no_checksum_files_beside_small_files(spark, tmp_path, monkeypatch, query, reader):
    paths = _captured(monkeypatch, reader)
    texts = spark.range(130).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("text"))
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    texts.filter("doc_id < 5").select(F.col("doc_id").alias("item_id"), "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.range(3).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    query(spark, str(tmp_path)).collect()
    assert glob.glob(f"{paths[0]}/**/part-*", recursive=True)
    assert not glob.glob(f"{paths[0]}/**/.part-*.crc", recursive=True)


def test_fastq_of_many_small_files_is_read_by_few_tasks(spark, tmp_path, monkeypatch):
    paths, real, size = [], W.scratch_path, "spark.sql.files.maxPartitionBytes"
    monkeypatch.setattr(W, "scratch_path", lambda *a: paths.append(real(*a)) or paths[-1])
    for i in range(FOLDERS):
        write_text(f"{tmp_path}/in/sample={i:03}/part-0.txt", [f"@{i} x", "ACGT", "+", "@III"])
    before = {k: spark.conf.get(k) for k in (OPEN_COST, size)}
    spark.conf.set(size, "1m")
    try:
        got = S.read_fastq(spark, f"{tmp_path}/in").collect()
        assert spark.conf.get(OPEN_COST) == before[OPEN_COST]
    finally:
        spark.conf.set(size, before[size])
    assert sorted(int(r.read_id) for r in got) == [*range(FOLDERS)] and all(r.seq == "ACGT" and r.n_lines == 4 for r in got)
    lines = paths[0].removeprefix("file://")
    assert 0 < len(glob.glob(f"{lines}/part-*")) <= FOLDERS // 3           # a task each before
    assert not glob.glob(f"{lines}/.part-*.crc")


def test_folder_names_are_not_worked_out_for_lines(spark, tmp_path):
    write_text(f"{tmp_path}/in/a=1/x.txt", ["one"])
    write_text(f"{tmp_path}/in/b=2/y.txt", ["two"])          # as columns these two contradict each other
    assert {r.value for r in S.read_lines(spark, f"{tmp_path}/in").collect()} == {"one", "two"}


def test_all_partitions_write_chunks_and_raw_reads(spark, tmp_path, monkeypatch):
    records = spark.range(400).select(F.lit("f").alias("file"), F.col("id").alias("record"), F.lit("@h").alias("header"),
                                      F.lit("AC").alias("seq"))
    H.write_record_chunks(records, f"{tmp_path}/chunks", 15, F.lit("s"), F.lit(1), ["header", "seq"])
    tasks = {os.path.basename(p).split("-")[1] for p in glob.glob(f"{tmp_path}/chunks/**/part-*", recursive=True)}
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = _captured(monkeypatch, "read_fastq_records")
    spark.range(600).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    assert FC.fastq_chunks(spark, str(tmp_path)).agg(F.sum("n")).first()[0] == 600
    made = {}
    for p in glob.glob(f"{paths[0]}/*/*/part-*"):
        made.setdefault(p.split("/")[-3], set()).add(os.path.basename(p).split("-")[1])
    assert len(made) == 6 and all(len(t) == 1 for t in made.values())        # both mates of a sample by one task


def test_bases_are_made_in_one_pass_over_a_text(spark):
    texts = ["Ab\0c\u65e5\u672c\u8a9e 1,2;\u00e9", None, "", "\U0001f9ecx \u0416\u044f \u03a3\u03c2 \u0130I \u00df\u1e9e \u0301e\u00f7\u00d7", "ACGT acgt", "\u00bd \u00b2\u0663 "]

    def base(c):
        return TC.BASES[TC.LETTERS.index(c)] if c in TC.LETTERS else "ACGT"[ord(c) % 4]

    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(F.lower("text").alias("low"), TC._dna("text").alias("dna"))
    assert [r.dna for r in rows.collect()] == [None if r.low is None else "".join(base(c) for c in r.low if c.isalpha()) for r in rows.collect()]
    plan = rows.select("dna")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1                                      # three times before


def test_line_dedup_writes_no_checksum_files(spark, monkeypatch):
    paths, real = [], line_dedup.scratch_path
    monkeypatch.setattr(line_dedup, "scratch_path", lambda *a: paths.append(real(*a)) or paths[-1])
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("all\nown "), F.col("id")).alias("text"))
    assert {r["__lines"].kept for r in line_dedup.drop_common_lines(docs, min_docs=3).collect()} == {f"own {i}" for i in range(40)}
    assert len(paths) == 3                     # the runs, the frequent lines, the dropped lines
    for p in paths:
        p = p.removeprefix("file://")
        assert glob.glob(f"{p}/**/part-*", recursive=True)
        assert not glob.glob(f"{p}/**/.part-*.crc", recursive=True)
