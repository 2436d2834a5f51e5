"""Queries that go through real files and tables: each first writes the given
tables in the layout of a source (mapping results, FASTA, CSV, TSV, part files,
discharge text) and reads them back through the operator.

Domain mapping as in ``contract``.  Where an id must hold several samples, ten
users make a ward.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as C
from ..operators import abundance as A
from ..operators import alignment
from ..operators import mapping as M
from ..operators import profile as P
from ..operators import records as R
from ..operators import refresh
from ..operators import reports as Q
from ..operators import rows as W
from ..operators import taxonomy
from ..operators import warehouse as H
from ..operators.joins import new_items
from ..operators.partitions import pin, spread
from ..session import SMALL_FILES, scratch_path
from ..sources import files as S
from ..streaming.annotation import SampleLoad
from .contract import CHUNK_ROWS, KMER, LINES_PER_FILE, READ_LEN, SKIP_ROWS, _dna, infection, table

WARD_USERS = 10
CALLS_PER_SAMPLE = 10
BUCKETS = 8
DOCS_PER_SAMPLE = 100
RECORDS_PER_CHUNK = 15


def _text(spark, df, name: str, **writer) -> str:
    path = scratch_path(spark, name)
    df.write.options(**writer).text(path)
    return path


# ----------------------------------------------------- the annotation job

def annotation_job(spark, sf_dir):
    """Mapping results of all samples -> ``infection``: several part files per
    sample folder, marker filter, count, taxonomy, row guard, patient by position."""
    ev = table(spark, sf_dir, "events")
    ward = F.concat(F.lit("W"), F.lpad(F.floor(F.col("user_id") / WARD_USERS).cast("string"), 9, "0"))
    marker = F.when(F.col("event_type") == "error", F.lit("XX_")).otherwise(F.lit("NC_"))
    hit = [F.col("event_id").cast("string"), F.lit("100"), F.lit("98%"), F.lit("90"), F.lit("1"), F.lit("0.98"),
           F.lit("strain"), F.lit("found"), F.concat(marker, F.coalesce("event_type", F.lit("none"))),
           F.lit("10"), F.lit("110")]
    path = scratch_path(spark, "mapping-results")
    # by ward and half: two part files a ward, written by all cores
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (ev.select(ward.alias("ward"), F.concat_ws("\t", *hit).alias("value"))
     .repartition(parts, "ward", F.pmod(F.xxhash64("value"), F.lit(2)))
     .sortWithinPartitions("ward").write.options(**SMALL_FILES).partitionBy("ward").text(path))
    hits = S.read_mapping_result(spark, path)

    gene = F.concat(F.lit("NC_"), F.col("event_type"))
    taxonomy = (ev.filter(F.col("event_type") != "view").select(
        gene.alias("gene"), F.array(F.lit("Bacteria"), F.col("event_type")).alias("lineage")).distinct())
    ids = scratch_path(spark, "patient-ids")
    (table(spark, sf_dir, "customer").orderBy("c_custkey")
     .select(F.col("c_custkey").cast("double").alias("Discharge ID"), "c_name").write.option("header", True).csv(ids))
    pairs = A.positional_pairs(hits, S.read_patient_index(spark, ids))
    return A.infection_from_hits(hits, pin(A.taxonomy_labels(taxonomy)), pin(pairs))


def agg_infection(spark, sf_dir):
    """The aggregate profile as a catalog table made from a select (T6), read by name."""
    tag = scratch_path(spark, "t").rsplit("-", 1)[1]
    view, name = f"profile_src_{tag}", f"agg_infection_{tag}"
    P.profile_strings(P.profile_arrays(infection(spark, sf_dir))).createOrReplaceTempView(view)
    H.create_table_as(spark, name, f"SELECT record_id, all_bacteria, all_otu FROM {view}",
                      location=scratch_path(spark, "agg_infection"))
    made = S.read_table(spark, name)
    H.drop_table(spark, name)          # the files stay: the table is external
    spark.catalog.dropTempView(view)
    return made


# --------------------------------------- reads, chunks, mapping, annotation

def _sample(key):
    """Documents in hundreds as samples: ``SRS`` and six digits."""
    return F.concat(F.lit("SRS"), F.lpad(F.floor(key / DOCS_PER_SAMPLE).cast("string"), 6, "0"))


def _fastq(rows, *folders):
    """Rows of ``id, seq`` and folder columns as 4-line records; a quality line may open like a header."""
    return rows.select(*folders, "at", F.concat_ws("\n", F.concat(F.lit("@"), F.col("id"), F.lit(" sampled")), "seq", F.lit("+"),
                                                   F.rpad(F.lit("@"), F.length("seq"), "I")).alias("value"))


def _benchmark_genomes(spark, sf_dir):
    """Benchmark items as genomes in FASTA files with Windows line ends, read back."""
    path = scratch_path(spark, "genomes")
    items = table(spark, sf_dir, "benchmark").select("item_id", _dna("text").alias("seq"))
    lines = F.regexp_replace("seq", "(.{70})", "$1\r\n")
    items.select(F.concat_ws("\r\n", F.concat(F.lit(">"), _accession("item_id"), F.lit(" item A>G")), lines).alias("value")) \
        .write.text(path)
    return S.read_fasta(spark, path)


def _accession(item):
    return F.concat(F.lit("NC_"), F.lpad(item.cast("string") if not isinstance(item, str) else F.col(item).cast("string"), 9, "0"))


def _taxa(spark, sf_dir):
    """A parent table over the benchmark items: item, one of 7 genera, one of 3 families, the root."""
    item = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("i"), F.lit(1).alias("one"))
    genus, family = F.concat(F.lit("g"), F.pmod("i", F.lit(7))), F.concat(F.lit("f"), F.pmod(F.pmod("i", F.lit(7)), F.lit(3)))
    rows = [(_accession(F.col("i")), genus, F.concat(F.lit("item "), F.col("i"))), (genus, family, F.concat(F.lit("Genus "), genus)),
            (family, F.lit("r"), F.concat(F.lit("Family "), family)), (F.lit("r"), F.lit("r"), F.lit("Bacteria"))]
    made = [item.select(t.alias("taxon"), p.alias("parent"), n.alias("name")).distinct() for t, p, n in rows]
    return made[0].unionByName(made[1]).unionByName(made[2]).unionByName(made[3])


def sequencing_pipeline(spark, sf_dir):
    """FASTQ files of all samples to ``infection``: reads framed, placed with gaps on the
    genomes, written as the 11-column mapping result, read back by sample, counted,
    annotated from lineages and paired with patients by position."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _dna("text").alias("dna"))
    cut = M.cut(spread(docs, ["doc_id"]), ["doc_id"], "dna", READ_LEN).select(
        _sample(F.col("doc_id")).alias("sample"), F.concat_ws("_", "doc_id", "start").alias("id"),
        F.struct("doc_id", "start").alias("at"), F.col("piece").alias("seq"))
    raw = scratch_path(spark, "raw-reads")
    (_fastq(cut, "sample").repartition("sample").sortWithinPartitions("sample", "at").drop("at")
     .write.options(**SMALL_FILES).partitionBy("sample").text(raw))
    reads = S.read_fastq(spark, raw).select(
        F.substring_index(F.element_at(F.split("file", "/"), -2), "=", -1).alias("sample"), "read_id", "seq")
    genomes = _benchmark_genomes(spark, sf_dir)
    placed = alignment.align_reads(reads, genomes, k=KMER, read_id=["sample", "read_id"])
    names = genomes.select(F.col("ref_id").alias("gene"), F.col("description").alias("strain"))
    results = scratch_path(spark, "mapping-results")
    H.write_mapping_result(alignment.mapping_result(placed, F.col("read_id"), names, F.col("sample")), results, SMALL_FILES)
    hits = S.read_mapping_result(spark, results)
    known = taxonomy.lineages(_taxa(spark, sf_dir)).select(F.col("taxon").alias("gene"), "lineage")
    patients = table(spark, sf_dir, "customer").select("c_custkey")
    ids = scratch_path(spark, "patient-ids")
    (patients.orderBy("c_custkey").select(F.col("c_custkey").cast("double").alias("Discharge ID"), F.lit("x").alias("note"))
     .write.option("header", True).csv(ids))
    pairs = A.positional_pairs(hits, S.read_patient_index(spark, ids))
    return A.infection_from_hits(hits, pin(A.taxonomy_labels(known)), pin(pairs))


def fastq_chunks(spark, sf_dir):
    """Raw read files cut into chunk files of whole records and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _dna("text").alias("seq"))
    mate = (F.pmod("doc_id", F.lit(2)) + 1).alias("mate")
    rows = spread(docs, ["doc_id"]).select(_sample(F.col("doc_id")).alias("sample"), mate, F.col("doc_id").alias("at"),
                                           F.col("doc_id").cast("string").alias("id"), "seq")
    raw = scratch_path(spark, "raw-fastq")
    # both mates by one task, so that their sample's folder is made once; all partitions write
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (_fastq(rows, "sample", "mate").repartition(parts, "sample").sortWithinPartitions("sample", "mate", "at").drop("at")
     .write.options(**SMALL_FILES).partitionBy("sample", "mate").text(raw))
    folder = F.split("file", "/")
    records = S.read_fastq_records(spark, raw)
    chunks = scratch_path(spark, "fastq-chunks")
    H.write_record_chunks(records, chunks, RECORDS_PER_CHUNK, F.substring_index(F.element_at(folder, -3), "=", -1),
                          F.substring_index(F.element_at(folder, -2), "=", -1).cast("int"), ["header", "seq", "plus", "qual"],
                          options=SMALL_FILES)
    back = S.read_fastq(spark, chunks)

    def part(i):
        return F.substring_index(F.element_at(folder, i), "=", -1)

    ident = F.col("read_id").cast("bigint")
    return (back.groupBy(C.chunk_name(part(-4), part(-3), part(-2)).alias("chunk"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("first_id"), F.max(ident).alias("last_id"),
                 F.sum(F.length("seq")).alias("bases"), F.sum((F.length("qual") == F.length("seq")).cast("int")).alias("whole")))


def incremental_annotation(spark, sf_dir):
    """The annotation job in three loads as files arrive: half of every third ward's
    files come in the second drop, and the third run finds nothing new (I1, J4, K2)."""
    ev = table(spark, sf_dir, "events")
    ward = F.floor(F.col("user_id") / WARD_USERS)
    hit = [F.col("event_id").cast("string"), F.lit("100"), F.lit("98%"), F.lit("90"), F.lit("1"), F.lit("0.98"), F.lit("strain"),
           F.lit("+"), F.concat(F.lit("NC_"), F.coalesce("event_type", F.lit("none"))), F.lit("10"), F.lit("110")]
    late = (F.pmod(ward, F.lit(3)) == 0) & (F.pmod("event_id", F.lit(2)) == 1)
    rows = ev.select(F.concat(F.lit("W"), ward).alias("ward"), late.alias("late"), F.concat_ws("\t", *hit).alias("value"))
    root = scratch_path(spark, "incremental-annotation")
    gene = F.concat(F.lit("NC_"), F.col("event_type"))
    labels = pin(ev.filter("event_type NOT IN ('view', 'error')").select(gene.alias("gene"), F.upper("event_type").alias("bacteria"))
                 .distinct())
    load = SampleLoad(spark, f"{root}/inbox/*", f"{root}/store", labels)
    for part in (False, True, None):
        if part is not None:
            (rows.filter(F.coalesce("late", F.lit(False)) == part).repartition("ward").select("ward", "value")
             .write.mode("append").options(**SMALL_FILES).partitionBy("ward").text(f"{root}/inbox"))
        load.run()
    return load.annotated()


def pending_chunks(spark, sf_dir):
    """Chunks that are listed among the inputs and have no result yet (S10, J4): two
    listings, told apart by sample, mate and chunk taken from the names."""
    conv = table(spark, sf_dir, "conversations")
    name = C.chunk_name(F.concat(F.lit("SRS"), F.lpad(F.floor(F.col("conv_id") / 40).cast("string"), 6, "0")),
                        F.pmod("turn", F.lit(2)) + 1, F.pmod("conv_id", F.lit(3)) + 1)
    rows = conv.select(name.alias("f"), F.coalesce("text", F.lit("")).alias("value"), "conv_id", "turn")
    root = scratch_path(spark, "work")
    for kind, some in (("in", rows), ("out", rows.filter("(conv_id div 40 + turn % 2 + conv_id % 3) % 2 = 0"))):
        (some.select("f", "value").repartition("f").sortWithinPartitions("f").write.partitionBy("f").text(f"{root}/{kind}"))

    def listed(kind):
        stem = F.substring_index(F.element_at(F.split("path", "/"), -2), "=", -1)
        part = F.split(stem, "_")
        return S.list_objects(spark, f"{root}/{kind}", "part-*").select(
            # never NULL: a join infers no filter that would take the names apart again
            F.coalesce(part[0], F.lit("")).alias("sample"), F.coalesce(part[1].cast("int"), F.lit(0)).alias("mate"),
            F.coalesce(part[2].cast("int"), F.lit(0)).alias("chunk"), "length")

    return new_items(listed("in"), listed("out"), ["sample", "mate", "chunk"]).select("sample", "mate", "chunk", "length")


def taxon_lineages(spark, sf_dir):
    """Lineages from a parent table of customers, nations and regions, with some customers
    whose parent is missing or who are their own (J2, F1, C14)."""
    def taxon(kind, c):
        return F.concat(F.lit(kind), F.col(c).cast("string"))

    parent = (F.when(F.pmod("c_custkey", F.lit(97)) == 0, F.lit("nowhere"))
              .when(F.pmod("c_custkey", F.lit(101)) == 0, taxon("c", "c_custkey")).otherwise(taxon("n", "c_nationkey")))
    rows = (table(spark, sf_dir, "customer").select(taxon("c", "c_custkey").alias("taxon"), parent.alias("parent"),
                                                    F.col("c_name").alias("name"))
            .unionByName(table(spark, sf_dir, "nation").select(taxon("n", "n_nationkey").alias("taxon"), taxon("r", "n_regionkey")
                                                               .alias("parent"), F.col("n_name").alias("name")))
            .unionByName(table(spark, sf_dir, "region").select(taxon("r", "r_regionkey").alias("taxon"), F.lit(None).cast("string")
                                                               .alias("parent"), F.col("r_name").alias("name"))))
    found = taxonomy.lineages(rows)
    return found.select("taxon", C.lineage_label("lineage").alias("label"), "depth", "status")


def profile_refresh(spark, sf_dir):
    """Profiles brought up to date by three appends, one of them repeated."""
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("record_id"), F.col("event_type").alias("bacteria"),
                                               F.pmod("event_id", F.lit(3)).alias("part"))
    root = scratch_path(spark, "profile-refresh")
    for part in (0, 1, 2, 1):
        counts = A.gene_counts(ev.filter(F.col("part") == part), keys=["record_id"], gene="bacteria", marker=None)
        refresh.refresh_profiles(counts, f"{root}/rows", f"{root}/profiles", part, BUCKETS)
    return refresh.read_profiles(spark, f"{root}/profiles")


def keyed_append(spark, sf_dir):
    """Order lines appended by order key in two overlapping loads: one row a key, and how
    many keys each load gave again (T1, M2)."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), "l_linenumber")
    path = scratch_path(spark, "keyed-append")
    first = refresh.append_new_keys(lines.filter("l_linenumber <= 2"), path, "order_key", 0, BUCKETS)
    second = refresh.append_new_keys(lines.filter("l_linenumber >= 2 OR order_key % 5 = 0"), path, "order_key", 1, BUCKETS)
    kept = spark.read.parquet(path).select("order_key", F.col("l_linenumber").cast("long").alias("n"), F.lit("kept").alias("status"))
    return kept.unionByName(first.unionByName(second).select("order_key", "n", F.col("reason").alias("status")))


def patient_lookup(spark, sf_dir):
    """One patient's admissions from a table made for lookups (P7, P12), the patient being
    the dashboard's default (L3)."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record_id"), F.col("o_orderdate").alias("admit_date"),
                                                   F.col("o_orderpriority").alias("campus_name"), "o_orderkey")
    path = scratch_path(spark, "lookup")
    H.write_lookup_table(orders, path, "record_id", 1_000_000)
    made = spark.read.schema(orders.schema).parquet(path)
    default = Q.first_id(made).first()["record_id"]        # one number
    return Q.lookup(made, "record_id", default)


def limited_parts(spark, sf_dir):
    """The rows of the first two files, by name, of a part set of four."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "capped-parts")
    (ev.select(F.concat(F.lit("x"), F.pmod("event_id", F.lit(4))).alias("part"), F.col("event_id").cast("string").alias("value"))
     .repartition("part").write.partitionBy("part").text(path))
    listing = S.worklist(S.list_objects(spark, path, "part-*").withColumn("name", F.element_at(F.split("path", "/"), -2)),
                         limit_parts=2)
    names = [r.path for r in listing.select("path").collect()]   # as many as the limit
    return S.read_lines(spark, names).select(F.col("value").cast("bigint").alias("event_id"))


def source_rejects(spark, sf_dir):
    """Pharmacy JSON lines, some broken and some with bad amounts, told by reason and by
    the lines' own places (M1, I2)."""
    raw = _pharmacy_json(table(spark, sf_dir, "events"))
    ident = F.regexp_extract(F.col("Generic Drug Title"), r"\d+", 0).cast("bigint")
    text = F.to_json(F.struct("*"))
    value = (F.when(F.pmod(ident, F.lit(9)) == 0, F.substring(text, 1, 20))
             .when(F.pmod(ident, F.lit(9)) == 1, F.regexp_replace(text, '"Pharmacy Charges":[^,]*', '"Pharmacy Charges":"n/a"'))
             .otherwise(text))
    path = _text(spark, raw.select(value.alias("value")), "pharmacy-broken")
    told = S.read_checked(spark, path, R.PHARMACY_SCHEMA)
    bad = told.filter("reject_reason IS NOT NULL").select(F.col("reject_reason").alias("status"), "line")
    parsed = R.pharmacy(told.filter("reject_reason IS NULL").drop("file", "line", "raw", "reject_reason"), rejects=True)
    status = bad.select("status").unionByName(parsed.select(F.coalesce("reject_reason", F.lit("ok")).alias("status")))
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def gene_checks(spark, sf_dir):
    """Genes without taxonomy (J2) and rows without a gene (M2)."""
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("sample"), F.when(
        F.pmod("event_id", F.lit(13)) == 0, None).otherwise(F.concat(F.lit("NC_"), "event_type")).alias("gene"))
    labels = ev.filter("gene <> 'NC_error'").select("gene", F.upper("gene").alias("bacteria")).distinct()
    unknown = A.unknown_genes(A.gene_counts(ev), labels).select("gene", F.lit("unknown").alias("problem"))
    missing = H.null_keys(ev, ["sample", "gene"]).groupBy("gene").agg(F.count(F.lit(1)).alias("n")) \
        .select("gene", F.concat(F.lit("null "), "n").alias("problem"))
    return unknown.unionByName(missing)


# ------------------------------------------------------------ file sources

def catalogue_file(spark, sf_dir):
    """A tab-separated catalogue with comment lines, filtered by one column."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    path = scratch_path(spark, "catalogue")
    part.write.option("sep", "\t").csv(path)
    (part.select("p_brand").distinct().select(F.concat(F.lit("# brand "), F.col("p_brand")).alias("value"))
     .write.mode("append").text(path))
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                           T.StructField("p_brand", T.StringType())])
    rows = S.read_csv_table(spark, path, schema, header=False, sep="\t", comment="#")
    return rows.filter(F.col("p_brand") == "Brand#11").select("p_partkey", "p_name")


def id_list_file(spark, sf_dir):
    """Distinct ids of a CSV list with repeats (S9, U2), the default one marked (L3)."""
    path = scratch_path(spark, "ids")
    (table(spark, sf_dir, "events").select(F.col("user_id").alias("record_id"), "event_type")
     .write.option("header", True).option("quoteAll", True).csv(path))
    schema = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("event_type", T.StringType())])
    ids = Q.distinct_ids(S.read_csv_table(spark, path, schema))
    first = pin(Q.first_id(ids)).withColumn("is_default", F.lit(True))   # one row
    return (ids.join(F.broadcast(first), "record_id", "left")
            .select("record_id", F.coalesce("is_default", F.lit(False)).alias("is_default")))


def object_worklist(spark, sf_dir):
    """Objects listed by name and size without reading them, with their name
    parts (S10, P8, P9, C12, C13, C20).  The object is the folder of one part file."""
    conv = table(spark, sf_dir, "conversations")
    sample = F.concat(F.lit("SRS"), F.lpad(F.floor(F.col("conv_id") / CALLS_PER_SAMPLE).cast("string"), 6, "0"))
    name = F.concat(sample, F.lit("_"), F.pmod(F.col("turn"), F.lit(2)).cast("string"), F.lit(".fastq"))
    path = scratch_path(spark, "objects")
    (conv.select(name.alias("f"), F.coalesce("text", F.lit("")).alias("value")).repartition("f")
     .sortWithinPartitions("f").write.partitionBy("f").text(path))
    folder = F.element_at(F.split("path", "/"), -2)
    listing = S.list_objects(spark, path, "part-*").withColumn("name", F.substring_index(folder, "=", -1))
    work = S.worklist(listing, suffix="_1.fastq", min_bytes=500)
    return work.select("name", "length", C.sample_folder("name").alias("sample"), C.mate_digit("name").alias("mate"),
                       C.sample_rest("name").alias("rest"), C.key_prefix("name", ".").alias("stem"),
                       C.chunk_name(C.sample_folder("name"), C.mate_digit("name"), F.lit(1)).alias("chunk"))


def parts_file(spark, sf_dir):
    """All ``part-*`` files of a folder as one text data set."""
    ev = table(spark, sf_dir, "events")
    path = _text(spark, ev.select(F.col("event_id").cast("string").alias("value")).repartition(4, "value"), "parts")
    return S.read_parts(spark, path).select(F.col("value").cast("bigint").alias("event_id"))


def chunk_files(spark, sf_dir):
    """Numbered chunks written as one folder each (W2, K3), counted from the files."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    chunked = W.chunk_numbers(ev, CHUNK_ROWS, ["event_type"], ["event_id"])
    path = scratch_path(spark, "chunks")
    H.write_chunks(chunked.withColumn("value", F.col("event_id").cast("string")), path,
                   ["event_type", "chunk"], value="value")
    back = spark.read.schema("value STRING, event_type STRING, chunk BIGINT").text(path)
    ident = F.col("value").cast("bigint")
    return back.groupBy("event_type", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("first_id"),
                                                   F.max(ident).alias("last_id"))


def keyed_table(spark, sf_dir):
    """A table bucketed and sorted by patient (T1), its columns taken from its
    description (T2); the count per patient needs no shuffle."""
    name = f"admissions_{scratch_path(spark, 't').rsplit('-', 1)[1]}"
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record_id"), "o_orderkey")
    H.create_keyed_table(spark, name, orders, "record_id", BUCKETS, location=scratch_path(spark, "admissions"))
    columns = [r.col_name for r in H.describe(spark, name).collect()]   # one row per column
    made = S.read_table(spark, name).select(*columns)
    counted = made.groupBy("record_id").agg(F.count("o_orderkey").alias("n"), F.max("o_orderkey").alias("last_key"))
    H.drop_table(spark, name)
    return counted


# ------------------------------------------- discharge text, all columns

def _quoted(c, mark='"'):
    return F.concat(F.lit(mark), c, F.lit(mark))


def _discharge_lines(orders):
    """One discharge line per order: every demographic and billing position filled."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def rest(n):
        return F.pmod(key, F.lit(n)).cast("string")

    def stamp(c):
        return F.concat(F.lit('"'), F.date_format(c, C.RECORD_DATETIME), F.lit('" '))

    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    fields = {
        1: _quoted(status), 3: F.concat(F.lit('"'), priority, F.lit('?"')), 4: cust.cast("double").cast("string"),
        5: _quoted(key.cast("string"), "'"), 9: _quoted(status, "'"),
        10: stamp(F.add_months("o_orderdate", -12 * F.pmod(cust, F.lit(90)).cast("int"))), 12: _quoted(rest(2)),
        14: _quoted(rest(5)), 25: stamp(F.col("o_orderdate")), 30: _quoted(F.substring(priority, 1, 1)),
        32: _quoted(rest(3)), 33: _quoted(rest(4)), 38: _quoted(rest(6)), 39: _quoted(rest(7)), 40: _quoted(rest(8)),
        50: _quoted(F.concat(F.lit('"'), F.lpad(rest(1000), 3, "0"), F.lit(" -- "),
                             F.lpad(key.cast("string"), 12, "0"), F.lit('"')), "'"),
        61: _quoted(rest(9)), 63: _quoted(rest(10)), 70: _quoted(rest(11)), 75: F.col("o_totalprice").cast("string"),
        **{p: rest(p) for p in (73, 74, *range(76, 89))}}
    return F.concat_ws(";", *[fields.get(i, F.lit("")) for i in range(R.MIN_FIELDS)])


def _discharge(spark, sf_dir):
    """The discharge files of all orders, read and parsed once (file headers
    skipped); the parsed frame is kept, and the tables and rejects are cut from it."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "discharge-all")
    lines = orders.select(F.floor(F.col("o_orderkey") / LINES_PER_FILE).alias("f"),
                          F.col("o_orderkey").alias("s"), _discharge_lines(orders).alias("value"))
    heads = lines.select("f").distinct().select(
        "f", F.explode(F.sequence(F.lit(-SKIP_ROWS).cast("bigint"), F.lit(-1).cast("bigint"))).alias("s"),
        F.lit("field;names").alias("value"))
    (lines.unionByName(heads).repartition("f").sortWithinPartitions("f", "s").select("f", "value")
     .write.partitionBy("f").text(path))
    parsed = R.parse_discharge(S.read_delimited(spark, path, sep=";", min_fields=2, skip=SKIP_ROWS))
    kept = scratch_path(spark, "discharge-parsed")
    parsed.write.parquet(kept)
    return spark.read.schema(parsed.schema).parquet(kept)


def discharge_demographics(spark, sf_dir):
    return R.split_rejects(R.demographics(_discharge(spark, sf_dir)))[0]


def discharge_billing(spark, sf_dir):
    return R.split_rejects(R.billing(_discharge(spark, sf_dir)))[0]


def patient_panel(spark, sf_dir):
    """The eight labelled metadata fields of every patient's last admission."""
    clean = R.split_rejects(R.demographics(_discharge(spark, sf_dir)))[0]
    fields = [c for c, _ in Q.METADATA_LABELS]
    return Q.labelled(Q.latest_per_key(clean, "record_id", ["admit_date", "icd_title"], fields))


def _pharmacy_json(ev, corrupt: bool = False):
    """Events as raw pharmacy records (the columns of ``PHARMACY_SCHEMA`` that are kept)."""
    ident = F.col("user_id").cast("double").cast("string")
    stamp = F.date_format("ts", C.SERVICE_DATETIME)
    if corrupt:
        ident = F.when(F.pmod("event_id", F.lit(7)) == 0, F.lit("none")).otherwise(ident)
        stamp = F.when(F.pmod("event_id", F.lit(11)) == 0, F.lit("junk")).otherwise(stamp)
    amount = F.from_json("props", "k BIGINT")["k"].cast("double")
    return ev.select(ident.alias("Discharge ID"), F.col("event_type").alias("Drug Class Title"),
                     F.upper("event_type").alias("Therapeutic Category Title"),
                     F.col("props").alias("Generic Drug Title"), amount.alias("Adj Pharmacy Charges"),
                     F.col("value").alias("Pharmacy Charges"), stamp.alias("Date Of Service"))


def pharmacy_rejects(spark, sf_dir):
    """Pharmacy JSON with bad ids and dates: rows by reject reason (M1)."""
    raw = _pharmacy_json(table(spark, sf_dir, "events"), corrupt=True)
    path = _text(spark, raw.select(F.to_json(F.struct("*")).alias("value")), "pharmacy-bad")
    parsed = R.pharmacy(S.read_json_records(spark, path, R.PHARMACY_SCHEMA), rejects=True)
    return (parsed.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("status"))
            .agg(F.count(F.lit(1)).alias("n")))


def patient_facts(spark, sf_dir):
    """Patients with billing, pharmacy and infection facts, one row each (J7), from tables
    bucketed alike, so the report's joins move no row."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record_id"), "c_name")
    bills = R.split_rejects(R.billing(_discharge(spark, sf_dir)))[0]
    billed = Q.totals_per_key(bills, "record_id", "billed_charges", "total_billed", "n_bills")
    drugs = R.split_rejects(R.pharmacy(_pharmacy_json(table(spark, sf_dir, "events")), rejects=True))[0]
    given = Q.totals_per_key(drugs, "record_id", "adj_pharmacy_charges", "total_pharmacy", "n_prescriptions")
    prof = P.profile_strings(P.profile_arrays(infection(spark, sf_dir)))
    frames = [cust, billed, given, prof.select("record_id", "all_bacteria", "all_otu")]
    tag = scratch_path(spark, "t").rsplit("-", 1)[1]
    names = [f"patient_fact_{i}_{tag}" for i in range(len(frames))]
    for name, frame in zip(names, frames):
        H.create_keyed_table(spark, name, frame, "record_id", BUCKETS, location=scratch_path(spark, name))
    report = Q.patient_report(*[S.read_table(spark, name) for name in names])
    for name in names:
        H.drop_table(spark, name)      # external: the files stay
    return report


FILE_QUERIES = {f.__name__: f for f in (
    annotation_job, sequencing_pipeline, fastq_chunks, incremental_annotation, pending_chunks, taxon_lineages, profile_refresh, keyed_append,
    patient_lookup, limited_parts, source_rejects, gene_checks, agg_infection, catalogue_file, id_list_file, object_worklist, parts_file, chunk_files, keyed_table,
    discharge_demographics, discharge_billing, patient_panel, pharmacy_rejects, patient_facts)}
