"""The query contract on the driver's test tables.

Domain mapping: ``events.user_id`` = patient ``record_id``; ``event_type`` =
gene / bacterium; event count = otu; ``nation``/``region`` = taxonomy;
``customer``/``orders``/``lineitem`` = patients, admissions, services;
``documents`` = reads and ``benchmark`` = reference sequences.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Queries that exercise a file source or sink first write Spark-derived
files into a fresh folder under the shared folder and read them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators import abundance as A
from ..operators import mapping as M
from ..operators import profile as P
from ..operators import records as R
from ..operators import reports as Q
from ..operators import rows as W
from ..operators import warehouse as H
from ..operators.joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small, fits, new_items
from ..operators.partitions import spread
from ..session import scratch_path
from ..sources import files as S
from ..streaming.incremental import load_new_files, read_loaded

TOP_K = 3          # events has 5 types, so k=3 makes the top-k cut bite
CHUNK_ROWS = 500
SKIP_ROWS = 3
SHINGLE_WORDS = 8
LINES_PER_FILE = 10_000  # key range per generated text file


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def infection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``record_id, bacteria, otu``: event count per (user, event type)."""
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("record_id"),
                                               F.col("event_type").alias("bacteria"))
    return A.gene_counts(ev, keys=["record_id"], gene="bacteria", marker=None)


# ------------------------------------------------------------ 1. minimum slice

def gene_abundance(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("record_id"),
                                               F.col("event_type").alias("gene"))
    return A.gene_counts(ev, keys=["record_id"], gene="gene", marker="i")


def infection_profile(spark, sf_dir):
    return P.profile_strings(P.profile_arrays(infection(spark, sf_dir)))


def profile_explode(spark, sf_dir):
    return P.explode_profile(infection_profile(spark, sf_dir))


def top_share(spark, sf_dir, k: int = TOP_K):
    return P.top_share(P.profile_arrays(infection(spark, sf_dir)), k)


# ---------------------------------------------------------------- 2. joins

def taxonomy_join(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    tax = (nation.join(broadcast_if_small(region, 100_000), nation.n_regionkey == region.r_regionkey)
           .select(F.col("n_nationkey").alias("gene"), F.array("r_name", "n_name").alias("lineage")))
    sup = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("gene"))
    counts = A.gene_counts(sup, keys=[], gene="gene", marker=None)
    return A.annotate(counts, A.taxonomy_labels(tax))


def new_samples_anti(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record_id"))
    done = (table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
            .select(F.col("o_custkey").alias("record_id")))
    return new_items(cust, done, "record_id")


def min_rows_guard(spark, sf_dir):
    errors = (table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
              .select(F.col("user_id").alias("record_id"), "event_id"))
    kept = A.min_rows_guard(errors, ["record_id"], min_rows=2)
    return kept.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))


def patient_index(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record_id"))
    patients = W.row_index(cust, ["record_id"], name="index")
    inf = infection(spark, sf_dir).select(F.col("record_id").alias("index"), "bacteria", "otu")
    return A.attach_patient(inf, patients, "index", broadcast=fits(cust, DEFAULT_BROADCAST_ROWS))


def typed_union(spark, sf_dir):
    counts = infection(spark, sf_dir).select(F.col("record_id").alias("index"), "bacteria", "otu")
    return A.typed_union(A.infection_seed(spark), counts)


def sink_append(spark, sf_dir):
    target = scratch_path(spark, "infection")
    inf = infection(spark, sf_dir)
    H.append(inf, target)
    H.append(inf, target)
    return S.read_table(spark, target)


# -------------------------------------------------------------- 3. cleaning

def _discharge_fields(orders: DataFrame, corrupt: bool = False) -> list:
    """89 discharge fields built from an order (positions of ``records``)."""
    key = F.col("o_orderkey")
    dob = F.add_months(F.col("o_orderdate"), -12 * F.pmod(F.col("o_custkey"), F.lit(90)).cast("int"))

    def stamp(c):
        return F.concat(F.lit('"'), F.date_format(c, C.RECORD_DATETIME), F.lit('" '))

    rid = key.cast("double").cast("string")
    admit = stamp(F.col("o_orderdate"))
    if corrupt:
        rid = F.when(F.pmod(key, F.lit(7)) == 0, F.lit("")).otherwise(rid)
        admit = F.when(F.pmod(key, F.lit(11)) == 0, F.lit('"junk" ')).otherwise(admit)
    fields = {
        1: F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"')),
        3: F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('?"')),
        4: rid,
        5: F.concat(F.lit("'"), F.col("o_custkey").cast("string"), F.lit("'")),
        9: F.concat(F.lit("'"), F.col("o_orderstatus"), F.lit("'")),
        10: stamp(dob),
        25: admit,
        75: F.col("o_totalprice").cast("string"),
    }
    numbers = {p: F.lit("0") for p in range(73, 89) if p != 75}
    return [fields.get(i, numbers.get(i, F.lit(""))) for i in range(R.MIN_FIELDS)]


def _write_discharge_files(spark, orders: DataFrame) -> str:
    """Discharge text files, one per key range, each opening with three header
    lines and a one-field line (dropped before the header count)."""
    path = scratch_path(spark, "discharge")
    body = orders.select(F.floor(F.col("o_orderkey") / LINES_PER_FILE).alias("f"),
                         (F.col("o_orderkey") + 10).alias("s"),
                         F.concat_ws(";", *_discharge_fields(orders)).alias("value"))
    files = body.select("f").distinct()
    head = files.select("f", F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("s"), F.lit("hospital;discharge;extract").alias("value")),
        F.struct(F.lit(1).cast("bigint").alias("s"), F.lit("----").alias("value")),
        F.struct(F.lit(2).cast("bigint").alias("s"), F.lit("generated;by;sentinela").alias("value")),
        F.struct(F.lit(3).cast("bigint").alias("s"), F.lit("field;names;follow").alias("value")))).alias("h"))
    head = head.select("f", "h.s", "h.value")
    (body.unionByName(head).repartition("f").sortWithinPartitions("f", "s")
     .select("f", "value").write.partitionBy("f").text(path))
    return path


def delimited_project(spark, sf_dir):
    orders = spread(table(spark, sf_dir, "orders"), ["o_orderkey"])
    path = _write_discharge_files(spark, orders)
    split = S.read_delimited(spark, path, sep=";", min_fields=2, skip=SKIP_ROWS)
    clean, _ = R.split_rejects(R.parse_discharge(split, mode=C.QUARANTINE))
    return clean.select("record_id", "hospital_city", "campus_name", "patient_type", "billing_no",
                        "admit_date", "age", "billed_charges")


def string_cleanup(spark, sf_dir):
    p = F.col("o_orderpriority")
    stripped = C.strip_chars(p, "1")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        C.remove_chars(p, "-").alias("no_dash"),
        C.remove_chars(p, "- ").alias("no_dash_space"),
        stripped.alias("stripped"),
        C.py_slice(p, 1, -1).alias("inner1"),
        C.py_slice(p, 1, -2).alias("inner2"),
        C.py_slice(stripped, 1, 4).alias("code"),
        C.py_slice(stripped, 8, -1).alias("title"),
        C.py_slice(p, 0, 1).alias("first"),
        C.py_slice(p, 3).alias("tail"))


def age_at_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = spread(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate"),
                   ["o_orderkey"])
    ages = orders.join(items, "o_orderkey").select(C.completed_years("o_orderdate", "l_shipdate").alias("age"))
    return ages.groupBy("age").agg(F.count(F.lit(1)).alias("n"))


def json_project(spark, sf_dir):
    ev = spread(table(spark, sf_dir, "events"), ["event_id"])
    k = F.from_json("props", "k BIGINT")["k"]
    rec = F.struct(
        F.col("user_id").cast("double").cast("string").alias("Discharge ID"),
        F.col("event_type").alias("Drug Class Title"),
        F.upper("event_type").alias("Therapeutic Category Title"),
        F.col("props").alias("Generic Drug Title"),
        k.cast("double").alias("Adj Pharmacy Charges"),
        F.col("value").alias("Pharmacy Charges"),
        F.date_format("ts", C.SERVICE_DATETIME).alias("Date Of Service"),
        F.dayofweek("ts").cast("string").alias("Day Of Service"),
        F.lit("x").alias("Route Of Administration"))
    path = scratch_path(spark, "pharmacy")
    ev.select(F.to_json(rec).alias("value")).write.text(path)
    return R.pharmacy(S.read_json_records(spark, path, R.PHARMACY_SCHEMA))


def quarantine(spark, sf_dir):
    orders = spread(table(spark, sf_dir, "orders"), ["o_orderkey"])
    split = orders.select(F.array(*_discharge_fields(orders, corrupt=True)).alias("fields"))
    parsed = R.parse_discharge(split, mode=C.QUARANTINE)
    status = F.coalesce(F.col("reject_reason"), F.lit("ok")).alias("status")
    return parsed.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ 4. positional

def skip_leading_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return W.skip_leading(docs, SKIP_ROWS, ["lang"], ["doc_id"])


def record_chunks(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    chunked = W.chunk_numbers(ev, CHUNK_ROWS, ["event_type"], ["event_id"])
    per_chunk = chunked.groupBy("event_type", "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"))
    return per_chunk.select("event_type", "chunk", C.chunk_name("event_type", "chunk").alias("name"),
                            "n", "first_id", "last_id")


def record_framing(spark, sf_dir):
    conv = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"),
                  ["conv_id", "turn"])
    lines = F.array(F.concat(F.lit("@"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")),
                    F.col("role"), F.lit("+"),
                    F.concat(F.lit("@"), F.length("text").cast("string")))
    staged = conv.select(F.floor(F.col("conv_id") / LINES_PER_FILE).alias("f"), "conv_id", "turn",
                         F.posexplode(lines).alias("pos", "value"))
    path = scratch_path(spark, "fastq")
    (staged.repartition("f").sortWithinPartitions("f", "conv_id", "turn", "pos")
     .select("f", "value").write.partitionBy("f").text(path))
    reads = S.read_fastq(spark, path)
    ident = F.split(F.col("read_id"), "/")
    return reads.select(ident[0].cast("bigint").alias("conv_id"), ident[1].cast("bigint").alias("turn"),
                        F.col("seq").alias("role"),
                        F.expr("substr(qual, 2)").cast("bigint").alias("text_len"))


# ------------------------------------------------------- 5. serving and DDL

def catalogue_filter(spark, sf_dir):
    return (table(spark, sf_dir, "part").filter(F.col("p_brand") == "Brand#11")
            .select("p_partkey", "p_name"))


def source_worklist(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    listing = docs.select(F.col("source").alias("name"), F.col("n_chars").alias("length"))
    work = S.worklist(listing, suffix="1", min_bytes=2000)
    return work.groupBy(F.substring("name", 1, 4).alias("prefix"), F.col("name").alias("source")).agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("max_size"))


def distinct_ids(spark, sf_dir):
    return Q.distinct_ids(table(spark, sf_dir, "events").select(F.col("user_id").alias("record_id")))


def patient_metadata(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("record_id"), F.col("o_orderdate").alias("admit_date"), "o_orderkey",
        F.col("o_orderstatus").alias("patient_type"), F.col("o_totalprice").alias("total_charge"))
    return Q.latest_per_key(orders, "record_id", ["admit_date", "o_orderkey"],
                            ["admit_date", "o_orderkey", "patient_type", "total_charge"])


def level_band(spark, sf_dir):
    part = table(spark, sf_dir, "part").select((F.col("p_size") / 5.0).alias("diagnosis_count"))
    return P.level_bands(part, "diagnosis_count")


def patient_report(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record_id"),
                                                   "c_name", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record_id"), "o_totalprice")
    billed = Q.totals_per_key(orders, "record_id", "o_totalprice", "total_billed", "n_orders")
    prof = infection_profile(spark, sf_dir).select("record_id", "all_bacteria")
    return Q.patient_report(cust, billed, prof).select(
        "record_id", "c_name", "c_mktsegment", "n_orders", "total_billed", "all_bacteria")


def ctas_cast(spark, sf_dir):
    """A table made as text, then replaced by one with typed columns."""
    tag = scratch_path(spark, "t").rsplit("-", 1)[1]
    view, name = f"orders_src_{tag}", f"services_{tag}"
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    H.create_table_as(spark, name,
                      f"SELECT string(o_orderkey) AS record_id, o_orderstatus AS drug_class, "
                      f"date_format(o_orderdate, '{C.SERVICE_DATETIME}') AS date_of_service, "
                      f"string(o_totalprice) AS adj_pharmacy_charges FROM {view}",
                      location=scratch_path(spark, "ctas_text"))
    typed = scratch_path(spark, "ctas_typed")
    H.recast(spark, name, {"record_id": "BIGINT", "date_of_service": "TIMESTAMP_NTZ",
                           "adj_pharmacy_charges": "DOUBLE"}, location=typed)
    H.drop_table(spark, name)
    spark.catalog.dropTempView(view)
    return spark.read.parquet(typed)


def key_check(spark, sf_dir):
    return H.duplicate_keys(table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey")


# ------------------------------------------------------------- 6. mapping

def read_mapping(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    refs = table(spark, sf_dir, "benchmark").select("item_id", "text")
    seeds = M.shingle_seeds(docs, refs, "doc_id", "item_id", "text", SHINGLE_WORDS)
    return M.best_reference(seeds, "doc_id", "item_id")


# Letter-to-base map used to derive DNA from the text tables: a-z and the
# accented Latin-1 letters, in code point order, stand for A, C, G, T in turn;
# any other letter stands for the base its code point has modulo 4.
LETTERS = "".join(chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xDF, 0xF7), *range(0xF8, 0x100)])
BASES = "".join("ACGT"[i % 4] for i in range(len(LETTERS)))
READ_LEN = 100
KMER = 16


#: What ASCII has beside letters: goes in the same pass that maps them.
NO_LETTERS = "".join(chr(c) for c in range(128) if not chr(c).isalpha())


def _dna(text_col: str):
    """Bases of the text's letters.  One pass maps or drops what most texts hold alone; the few with
    anything else left go on.  The pass is an argument of ``transform``, so it is done once a text,
    not for the test and the result anew."""
    def bases(most):
        letters = F.split(F.regexp_replace(most, r"[^\p{L}]", ""), "")
        each = F.transform(letters, lambda c: F.when(c.isin("", "A", "C", "G", "T"), c).otherwise(
            F.substring(F.lit("ACGT"), F.ascii(c) % 4 + 1, 1)))
        return F.when(most.rlike("[^ACGT]"), F.array_join(each, "")).otherwise(most)

    return F.transform(F.array(F.translate(F.lower(text_col), LETTERS + NO_LETTERS, BASES)), bases)[0]


def _fasta(spark, refs) -> str:
    """References (``item_id, seq``) as FASTA: an id that sorts like the number, a
    header with a ``>`` inside, lines of 70 bases."""
    path = scratch_path(spark, "fasta")
    header = F.concat(F.lit(">"), F.lpad(F.col("item_id").cast("string"), 12, "0"), F.lit(" item A>G strain"))
    lines = F.regexp_replace("seq", "(.{70})", "$1\n")
    refs.select(F.concat_ws("\n", header, lines).alias("value")).write.text(path)
    return path


def read_mapping_dna(spark, sf_dir):
    """Documents as DNA cut into 100-base reads, placed on benchmark items, which
    are read from FASTA files, by k-mer voting on both strands.  The sample is the
    document's source."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), ["doc_id"]) \
        .select("doc_id", F.col("source").alias("sample"), _dna("text").alias("dna"))
    reads = M.cut(docs, ["sample", "doc_id"], "dna", READ_LEN).select(
        "sample", "doc_id", F.col("start").alias("read_start"), F.col("piece").alias("seq"))
    items = table(spark, sf_dir, "benchmark").select("item_id", _dna("text").alias("seq"))
    refs = S.read_fasta(spark, _fasta(spark, items)).select("ref_id", "seq")
    placed = M.map_reads(reads, refs, k=KMER, min_seeds=2, read_id=["sample", "doc_id", "read_start"])
    return placed.select("sample", "doc_id", "read_start", F.col("gene").cast("bigint").alias("item_id"), "strand",
                         "start", "end", "nt_length", "seeds", "identity")


# --------------------------------------------------------- 7. incremental

def incremental_load(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    root = scratch_path(spark, "incremental")
    inbox, sink = f"{root}/inbox", f"{root}/sink"

    def load():
        load_new_files(spark, f"{inbox}/*", sink, f"{root}/checkpoint", ev.schema,
                       transform=lambda s: s.select(F.col("user_id").alias("record_id"),
                                                    F.col("event_type").alias("bacteria")),
                       archive_dir=f"{root}/archive")

    ev.filter(F.col("event_type").isin("click", "view")).write.parquet(f"{inbox}/part1")
    ev.filter(F.col("event_type").isin("signup", "error")).write.parquet(f"{inbox}/part2")
    load()
    named = F.coalesce(F.col("event_type").isin("click", "view", "signup", "error"), F.lit(False))
    ev.filter(~named).write.parquet(f"{inbox}/part3")
    load()
    load()
    loaded = read_loaded(spark, sink)
    return A.gene_counts(loaded, keys=["record_id"], gene="bacteria", marker=None)


QUERIES = {
    "gene_abundance": gene_abundance,
    "infection_profile": infection_profile,
    "profile_explode": profile_explode,
    "top_share": top_share,
    "taxonomy_join": taxonomy_join,
    "new_samples_anti": new_samples_anti,
    "min_rows_guard": min_rows_guard,
    "patient_index": patient_index,
    "typed_union": typed_union,
    "sink_append": sink_append,
    "delimited_project": delimited_project,
    "string_cleanup": string_cleanup,
    "age_at_date": age_at_date,
    "json_project": json_project,
    "quarantine": quarantine,
    "skip_leading_rows": skip_leading_rows,
    "record_chunks": record_chunks,
    "record_framing": record_framing,
    "catalogue_filter": catalogue_filter,
    "source_worklist": source_worklist,
    "distinct_ids": distinct_ids,
    "patient_metadata": patient_metadata,
    "level_band": level_band,
    "patient_report": patient_report,
    "ctas_cast": ctas_cast,
    "key_check": key_check,
    "read_mapping": read_mapping,
    "read_mapping_dna": read_mapping_dna,
    "incremental_load": incremental_load,
}
