"""File sources.

Every reader declares its schema (no inference pass over the data) and keeps
the source file as a column where positions matter, so that line numbers are
counted per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as C
from ..operators.rows import frame_records, line_index
from ..session import few_listing_tasks, many_files_a_task

# The 11 column names of the read-mapping result, in file order
# (the reference spells the sixth "alignemnt_identity"; the build uses the
# plain spelling).
MAPPING_RESULT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("nt_length", T.IntegerType()),
    T.StructField("accuracy", T.StringType()),
    T.StructField("alignment_score", T.IntegerType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("alignment_identity", T.DoubleType()),
    T.StructField("strain", T.StringType()),
    T.StructField("identification", T.StringType()),
    T.StructField("gene", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
])

# Typed seed of the infection table.
INFECTION_SEED_SCHEMA = T.StructType([
    T.StructField("index", T.IntegerType()),
    T.StructField("bacteria", T.StringType()),
    T.StructField("otu", T.IntegerType()),
])


def read_lines(spark: SparkSession, paths, line_sep: str | None = None) -> DataFrame:
    """Text lines with their file and split start: ``file, block, value``.  Folders below
    ``paths`` are read as they are: what their names say is not worked out on the driver."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    with few_listing_tasks(spark):
        df = reader.text(paths)
    return df.select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"), "value")


def read_delimited(spark: SparkSession, paths, sep: str = ";", min_fields: int = 2,
                   skip: int = 0) -> DataFrame:
    """Delimited lines split on ``sep`` without quote handling.

    Keeps trailing empty fields (like Python ``str.split``), drops lines with
    fewer than ``min_fields`` fields (P4), then drops the first ``skip`` of the
    remaining lines of every file (P5).  Returns ``file, line, fields``.
    """
    lines = read_lines(spark, paths)
    split = lines.select("file", "block", F.split("value", _regex_literal(sep), -1).alias("fields"))
    kept = split.filter(F.size("fields") >= min_fields)
    if skip > 0:
        kept = line_index(kept, name="line").filter(F.col("line") >= skip)
    else:
        kept = line_index(kept, name="line")
    return kept.select("file", "line", "fields")


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)


def read_json_records(spark: SparkSession, paths, schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema."""
    return spark.read.schema(schema).json(paths)


def read_checked(spark: SparkSession, paths, schema: T.StructType, sep: str | None = None) -> DataFrame:
    """JSON lines, or delimited lines when ``sep`` is given, with where each came from:
    the columns of ``schema``, then ``file, line`` (0-based), ``raw`` and ``reject_reason``
    (M1, I2): ``malformed`` when the line does not parse or a field does not fit its type,
    else NULL.  ``records.split_rejects`` cuts the frame.  Blank lines are no records; a
    record is one line."""
    bad = "_malformed"
    while bad in schema.fieldNames():
        bad = f"_{bad}"
    wanted = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    lines = line_index(read_lines(spark, paths)).filter(F.length(F.trim("value")) > 0)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    if sep is None:
        parsed = F.from_json("value", wanted, options)
    else:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields)
        parsed = F.from_csv("value", ddl, {**options, "sep": sep})
    # kept out of one projection with its fields, so a line is parsed once
    rows = lines.select("file", F.col("idx").alias("line"), F.col("value").alias("raw"), F.explode(F.array(parsed)).alias("r"))
    reason = F.when(F.col("r").isNull() | F.col(f"r.{bad}").isNotNull(), "malformed")
    return rows.select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields], "file", "line", "raw",
                       reason.alias("reject_reason"))


def read_csv_table(spark: SparkSession, paths, schema: T.StructType, header: bool = True,
                   sep: str = ",", comment: str | None = None) -> DataFrame:
    """CSV/TSV with a declared schema (S3, S4, S8, S9).  Quotes, a UTF-8 BOM and
    bare-CR line ends are handled by the CSV reader."""
    reader = spark.read.schema(schema).option("header", header).option("sep", sep)
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(paths)


def read_patient_index(spark: SparkSession, paths, id_col: int = 0) -> DataFrame:
    """Patient ids from a CSV with a header, numbered in file order (S3, W1):
    ``record_id BIGINT`` (``int(float(first column))``) and 0-based ``index``."""
    raw = (spark.read.option("header", True).option("inferSchema", False).csv(paths))
    first = raw.columns[id_col]
    rows = raw.select(F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"),
                      C.parse_int_trunc(F.col(f"`{first}`")).alias("record_id"))
    return line_index(rows, name="index", per_file=False).select("record_id", "index")


def read_mapping_result(spark: SparkSession, paths) -> DataFrame:
    """Tab-separated read-mapping result with the 11 named columns (S4, S5);
    short lines give NULL fields, malformed numbers give NULL.  ``sample`` is the
    folder that holds the part files, so all parts of a sample count together.  Folders may be
    named by the one above them: its listing is dealt over tasks, a glob is worked out on the driver."""
    reader = spark.read.schema(MAPPING_RESULT_SCHEMA).option("sep", "\t").option("mode", "PERMISSIVE")
    with few_listing_tasks(spark):
        rows = reader.option("recursiveFileLookup", "true").csv(paths)
    return rows.withColumn("sample", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def read_fasta(spark: SparkSession, paths) -> DataFrame:
    """FASTA genomes, one row per record: ``file, ref_id, description, seq``.

    Records are cut at a ``>`` that opens a line (one inside a header stays), so a
    genome never depends on line order; reading a glob replaces concatenating
    the files.
    """
    raw = spark.read.option("lineSep", "\n>").text(paths)
    opened = raw.withColumn("value", F.regexp_replace("value", r"^\s*>", ""))  # the file's first record
    body = opened.filter(F.length(F.trim("value")) > 0)
    header = F.regexp_replace(F.split_part(F.col("value"), F.lit("\n"), F.lit(1)), r"^\s+|\s+$", "")  # a CR too
    seq = F.upper(F.regexp_replace(
        F.when(F.instr("value", "\n") > 0, F.expr("substr(value, instr(value, '\n') + 1)"))
        .otherwise(F.lit("")), r"\s+", ""))
    return body.select(F.col("_metadata.file_path").alias("file"),
                       F.regexp_extract(header, r"^\S*", 0).alias("ref_id"),
                       header.alias("description"), seq.alias("seq"))


def read_fastq_records(spark: SparkSession, paths) -> DataFrame:
    """FASTQ files framed as 4-line records, the lines as they are: ``file, record,
    header, seq, plus, qual, n_lines`` (S6).

    A quality line may begin with ``@``, so records are framed by line number
    in the file (``line div 4``), not by searching for ``@``.
    """
    with many_files_a_task(spark):      # the lines are read and numbered in here
        lines = line_index(read_lines(spark, paths))
    return frame_records(lines, 4, names=["header", "seq", "plus", "qual"])


def read_fastq(spark: SparkSession, paths) -> DataFrame:
    """FASTQ reads: ``file, record, read_id, seq, qual, n_lines``."""
    return read_fastq_records(spark, paths).select(
        "file", "record", F.split_part(F.expr("substr(header, 2)"), F.lit(" "), F.lit(1)).alias("read_id"),
        "seq", "qual", "n_lines")


def list_objects(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Object listing ``path, name, length`` without reading contents."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    with few_listing_tasks(spark):
        listing = reader.option("recursiveFileLookup", "true").load(path)
    return listing.select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                          "length")


def worklist(listing: DataFrame, suffix: str | None = None, min_bytes: int | None = None,
             limit_parts: int | None = None) -> DataFrame:
    """Filter a listing by suffix (P8) and size (P9); optionally keep the first
    ``limit_parts`` objects by name (S11/L4)."""
    out = listing
    if suffix:
        out = out.filter(F.col("name").endswith(suffix))
    if min_bytes is not None:
        out = out.filter(F.col("length") > min_bytes)
    if limit_parts:
        out = out.orderBy("name").limit(limit_parts)
    return out


def read_parts(spark: SparkSession, base: str, limit_parts: int | None = None) -> DataFrame:
    """Read the ``part-*`` files of ``base`` as one text data set."""
    if not limit_parts:
        return read_lines(spark, f"{base.rstrip('/')}/part-*")
    names = (list_objects(spark, base, "part-*").orderBy("name").limit(limit_parts)
             .select("path").collect())  # at most limit_parts file names
    return read_lines(spark, [r.path for r in names])


def empty_frame(spark: SparkSession, schema: T.StructType = INFECTION_SEED_SCHEMA) -> DataFrame:
    """Typed empty frame used as a union seed (S12).  Built JVM-side from an
    empty range, so no Python worker starts and the optimizer can prune it."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A warehouse table by catalog name, or a folder of ``fmt`` files."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)
