"""File sources (S3, S8-S12), sinks and DDL (K1, K3, T1-T6, M2), incremental load."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import write_text
from sentinela.functions import cleaning as C
from sentinela.operators import warehouse as H
from sentinela.operators.joins import new_items
from sentinela.sources import files as S
from sentinela.streaming.incremental import load_new_files, read_loaded


def test_genome_list_csv_bom_cr_quotes_duplicate(spark, tmp_path):
    rows = ['"Escherichia coli, K-12",https://x/1', '"Listeria, EGD-e",https://x/2',
            '"Escherichia coli, K-12",https://x/1', 'Plain name,https://x/3']
    p = str(tmp_path / "list" / "ref_list.csv")
    os.makedirs(os.path.dirname(p))
    with open(p, "wb") as fh:
        fh.write(b"\xef\xbb\xbf" + "\r".join(rows).encode() + b"\r")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("url", T.StringType())])
    df = S.read_csv_table(spark, p, schema, header=False)
    got = sorted((r.name, r.url) for r in df.dropDuplicates().collect())
    assert got == [("Escherichia coli, K-12", "https://x/1"), ("Listeria, EGD-e", "https://x/2"),
                   ("Plain name", "https://x/3")]


def test_catalogue_filter_tsv(spark, tmp_path):
    def row(level, addr):
        f = [f"c{i}" for i in range(20)]
        f[11], f[19] = level, addr
        return "\t".join(f)
    p = write_text(str(tmp_path / "cat" / "assembly_summary.txt"),
                   ["# comment line", row("Complete Genome", "ftp://a"), row("Contig", "ftp://b"),
                    row("Complete Genome", "ftp://c")])
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(20)])
    cat = S.read_csv_table(spark, p, schema, header=False, sep="\t", comment="#")
    got = sorted(r.c19 for r in cat.filter(F.col("c11") == "Complete Genome").select("c19").collect())
    assert got == ["ftp://a", "ftp://c"]


def test_listing_worklist_and_name_parts(spark, tmp_path):
    for name, size in [("SRS011061_1.fastq", 50), ("SRS011061_2.fastq", 5), ("notes.txt", 80)]:
        write_text(str(tmp_path / "raw" / name), ["x" * size])
    listing = S.list_objects(spark, str(tmp_path / "raw"))
    work = S.worklist(listing, suffix=".fastq", min_bytes=10)
    rows = work.select("name", C.sample_folder("name").alias("folder"), C.mate_digit("name").alias("mate"),
                       C.sample_rest("name").alias("rest"), C.key_prefix("name", ".").alias("key"),
                       C.chunk_name(C.sample_folder("name"), C.mate_digit("name"), F.lit(10)).alias("chunk")
                       ).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.folder, r.mate, r.rest, r.key, r.chunk) == (
        "SRS011061", "1", "1.fastq", "SRS011061_1", "SRS011061_1_10")


def test_read_parts_with_limit(spark, tmp_path):
    for i in range(4):
        write_text(str(tmp_path / "parts" / f"part-{i:05d}"), [f"p{i}a", f"p{i}b"])
    assert S.read_parts(spark, str(tmp_path / "parts")).count() == 8
    got = sorted(r.value for r in S.read_parts(spark, str(tmp_path / "parts"), limit_parts=2).collect())
    assert got == ["p0a", "p0b", "p1a", "p1b"]


def test_mapping_result_tsv(spark, tmp_path):
    lines = ["id\tnt\tacc\tscore\tcount\tident\tstrain\tident2\tgene\tstart\tend",
             "r1\t100\t98%\t90\t1\t0.98\tk12\tx\tNC_000913\t10\t110",
             "r2\t90\t97%\t80\t1\t0.97\tk12\tx\tXX_1\t5\t95",
             "short\tline"]
    p = write_text(str(tmp_path / "map" / "s1.txt"), lines)
    df = S.read_mapping_result(spark, p)
    from sentinela.operators.abundance import gene_counts
    got = [(r.gene, r.otu) for r in gene_counts(df.select("sample", "gene")).collect()]
    assert got == [("NC_000913", 1)]


def test_append_twice_and_ddl_chain(spark, tmp_path):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    target = str(tmp_path / "tbl")
    H.append(df, target)
    H.append(df, target)
    assert spark.read.parquet(target).count() == 10
    spark.createDataFrame([("1", "2019-01-02 03:04:05")], "record_id string, d string") \
        .createOrReplaceTempView("ph_src")
    H.create_table_as(spark, "ph_t", "SELECT * FROM ph_src", location=str(tmp_path / "t1"))
    H.rename_table(spark, "ph_t", "ph_tmp")
    H.create_table_as(spark, "ph_t", "SELECT CAST(record_id AS BIGINT) AS record_id, "
                      "CAST(d AS TIMESTAMP_NTZ) AS d FROM ph_tmp", location=str(tmp_path / "t2"))
    H.drop_table(spark, "ph_tmp")
    desc = {r.col_name: r.data_type for r in H.describe(spark, "ph_t").collect()}
    assert desc == {"record_id": "bigint", "d": "timestamp_ntz"}
    assert not spark.catalog.tableExists("ph_tmp")
    H.drop_table(spark, "ph_t")


def test_keyed_table_and_key_checks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "record_id long, x string")
    assert [(r.record_id, r.n) for r in H.duplicate_keys(df, "record_id").collect()] == [(2, 2)]
    assert H.null_keys(df, "record_id").count() == 1
    H.create_keyed_table(spark, "keyed_demo", df, "record_id", 4, location=str(tmp_path / "keyed"))
    assert spark.table("keyed_demo").count() == 4
    H.drop_table(spark, "keyed_demo")


def test_write_chunks(spark, tmp_path):
    df = spark.range(10).select(F.lit("S1").alias("sample"), (F.col("id") % 2).alias("mate"),
                                (F.col("id") % 3).alias("chunk"), F.col("id").cast("string").alias("value"))
    H.write_chunks(df, str(tmp_path / "chunks"), ["sample", "mate", "chunk"], value="value")
    back = spark.read.text(str(tmp_path / "chunks"))
    assert back.count() == 10
    assert os.path.isdir(str(tmp_path / "chunks" / "sample=S1" / "mate=1" / "chunk=2"))


def test_new_items_anti_join(spark):
    inp = spark.createDataFrame([("a",), ("b",), ("c",)], "sample string")
    done = spark.createDataFrame([("b",)], "sample string")
    assert sorted(r.sample for r in new_items(inp, done, "sample").collect()) == ["a", "c"]


def test_incremental_two_steps_equal_one_load(spark, tmp_path):
    schema = T.StructType([T.StructField("sample", T.StringType()), T.StructField("gene", T.StringType())])
    inbox, sink, ckpt = (str(tmp_path / n) for n in ("inbox", "sink", "ckpt"))
    batches = [[("s1", "NC_1"), ("s1", "NC_2")], [("s2", "NC_1")], [("s3", "NC_3"), ("s3", "AB")]]

    def drop(i):
        spark.createDataFrame(batches[i], schema).coalesce(1).write.parquet(f"{inbox}/b{i}")

    def run():
        load_new_files(spark, f"{inbox}/*", sink, ckpt, schema,
                       transform=lambda s: s.filter(F.col("gene").contains("NC_")),
                       archive_dir=str(tmp_path / "archive"), timeout_s=300)
        return read_loaded(spark, sink).count()

    drop(0)
    drop(1)
    assert run() == 3
    drop(2)
    assert run() == 4
    assert run() == 4          # nothing new: nothing loaded twice
    once = spark.createDataFrame([r for b in batches for r in b], schema).filter(F.col("gene").contains("NC_"))
    assert sorted(read_loaded(spark, sink).collect()) == sorted(once.collect())


def test_patient_index_in_file_order(spark, tmp_path):
    write_text(str(tmp_path / "pid" / "a.csv"), ["Discharge ID,other"] + [f"{900 - i}.0,x" for i in range(5)])
    write_text(str(tmp_path / "pid" / "b.csv"), ["Discharge ID,other"] + [f"{i}.7,y" for i in range(3)])
    got = sorted((r["index"], r.record_id) for r in S.read_patient_index(spark, str(tmp_path / "pid")).collect())
    assert got == [(0, 900), (1, 899), (2, 898), (3, 897), (4, 896), (5, 0), (6, 1), (7, 2)]
    from sentinela.operators.abundance import attach_patient
    inf = spark.createDataFrame([(0, "b1", 3), (1, "b2", 4)], "index long, bacteria string, otu long")
    pats = S.read_patient_index(spark, str(tmp_path / "pid"))
    assert sorted(r.record_id for r in attach_patient(inf, pats).collect()) == [899, 900]
    assert [r.record_id for r in attach_patient(inf, pats, offset=-1).collect()] == [900]
