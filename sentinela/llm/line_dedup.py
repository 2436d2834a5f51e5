"""Line dedup over levelled sorted runs of line hashes.

``LineRuns`` keeps, per 128-bit line hash, in how many documents the line was
seen.  A batch of documents becomes one level-0 run sorted by hash.  Before it
is written it is merge-anti-joined with the settled runs: lines already known
from ``min_docs`` documents need no more counting.  When a level holds
``fanout`` runs they are compacted: counts are added, lines that reach
``min_docs`` move to a settled run, the others to one run of the next level.
So each line hash is rewritten a logarithmic number of times, and memory never
holds more than a merge.

All runs have one bucket layout by hash, so merging, compacting and the final count read
matching buckets side by side and shuffle nothing.  A run is a small file a bucket, so
scratch tables are written with ``SMALL_FILES``.

Everything is DataFrame operations.  A line that a third of all documents share
is one row per task before any shuffle.  Documents meet their dropped line
numbers by the hash of the whole text, one row per distinct text, so copies of
one text are a skewed join side that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import passes_columns
from ..session import SMALL_FILES, scratch_path

MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
#: The frequent lines are broadcast only when their counted rows stay within this (16 MB of hashes).
BROADCAST_ROWS = 500_000
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Capital letters that ``lower`` changes and the key must not.
OTHER_CAPITALS = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"

def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(bare.rlike(OTHER_CAPITALS), F.translate(bare, UPPER, LOWER)).otherwise(F.lower(bare))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def _lines(text_col: str) -> Column:
    return F.split(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "\n", -1)


def line_counts(docs: DataFrame, text_col: str = "text", batches: int = 1) -> DataFrame:
    """``h1, h2, batch, n``: in how many rows of ``docs`` each non-empty line key occurs, by
    batch (a row's batch is a hash of its text).  All batches are counted side by side, so
    one shuffle of partial counts serves them and leaves the rows dealt by line hash."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    batch = F.pmod(F.xxhash64(text, F.lit(2)), F.lit(batches)).cast("int").alias("batch")
    keys = F.array_distinct(F.transform(_lines(text_col), line_key))
    one = docs.select(batch, F.explode(keys).alias("key")).filter("key != ''").select("batch", *_hashes(F.col("key")))
    counts = one.groupBy("h1", "h2").agg(*[F.count_if(F.col("batch") == b).alias(f"n{b}") for b in range(batches)])
    each = F.array(*[F.struct(F.lit(b).alias("batch"), F.col(f"n{b}").alias("n")) for b in range(batches)])
    return counts.select("h1", "h2", F.inline(F.filter(each, lambda x: x.n > 0)))


class Runs:
    """Numbered runs of ``h1, h2, n`` in one table of the shared folder: a partition a run,
    every run bucketed and sorted by the hash with the same number of buckets.  Joins and
    counts over any runs read them bucket by bucket, without a shuffle.  The table's name
    lives in the session's catalog until ``close``."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")),
                           int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
        self.path = scratch_path(spark, "line-runs")
        self.name = "line_runs_" + self.path.rsplit("-", 1)[1]
        spark.sql(f"CREATE TABLE {self.name} (h1 BIGINT, h2 BIGINT, n BIGINT, run INT) USING parquet "
                  f"OPTIONS ({', '.join(f"'{k}' '{v}'" for k, v in SMALL_FILES.items())}) "
                  f"PARTITIONED BY (run) CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}'")

    def write(self, rows: DataFrame) -> None:
        """Append ``rows(h1, h2, n, run)``; ``run`` must name new runs."""
        (rows.select("h1", "h2", "n", F.col("run").cast("int")).write.mode("append").format("parquet")
         .partitionBy("run").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(self.name))

    def read(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("run").isin(*runs)).select("h1", "h2", "n")

    def close(self) -> None:
        """Drop the table's name; the files stay, so frames read from it still work."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


class LineRuns:
    """The levelled runs.  Only run numbers live here; the rows are a bucketed table."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT,
                 buckets: int | None = None):
        self.min_docs, self.fanout = min_docs, fanout
        self.runs = Runs(spark, buckets)
        self.levels: dict[int, list[int]] = {}
        self.settled: list[int] = []
        self.made = 0

    def _next(self) -> int:
        self.made += 1
        return self.made

    def _all(self) -> list[int]:
        return self.settled + [r for level in self.levels.values() for r in level]

    def _without(self, counts: DataFrame, runs: list[int]) -> DataFrame:
        return counts.join(self.runs.read(runs).hint("merge"), ["h1", "h2"], "left_anti") if runs else counts

    def unseen(self, counts: DataFrame) -> DataFrame:
        """Rows of ``counts(h1, h2, n)`` whose line is in no run yet."""
        return self._without(counts, self._all())

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """Rows of ``counts(h1, h2, n)`` whose line is not known from ``min_docs`` documents yet."""
        return self._without(counts, self.settled)

    def count(self, docs: DataFrame, text_col: str, batches: int) -> list[int]:
        """The line counts of ``docs`` written as one run a batch, for ``add``."""
        first = self.made + 1
        counts = line_counts(docs, text_col, batches).withColumn("run", F.col("batch") + first)
        self.made += batches
        self.runs.write(counts)
        return list(range(first, first + batches))

    def add(self, counts: DataFrame | int) -> None:
        """Add one batch (``h1, h2, n``, one row a line, or the number of its run from ``count``)
        as a run, then compact full levels.  A written run stays as it is while no line is settled."""
        run = counts
        if self.settled or not isinstance(counts, int):
            rows = self.runs.read([counts]) if isinstance(counts, int) else counts
            run = self._next()
            self.runs.write(self.unsettled(rows).withColumn("run", F.lit(run)))
        self.levels.setdefault(0, []).append(run)
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            self._compact(level)
            level += 1

    def totals(self, runs: list[int]) -> DataFrame:
        return self.runs.read(runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def _compact(self, level: int) -> None:
        done, open_ = self._next(), self._next()
        self.runs.write(self.totals(self.levels.pop(level)).withColumn(
            "run", F.when(F.col("n") >= self.min_docs, done).otherwise(open_)))
        self.settled.append(done)
        self.levels.setdefault(level + 1, []).append(open_)

    def frequent(self) -> DataFrame:
        """``h1, h2`` of the lines seen in at least ``min_docs`` documents.  A settled line's own
        run holds that many already, so one sum over all runs decides."""
        return self.totals(self._all()).filter(F.col("n") >= self.min_docs).select("h1", "h2")

    def close(self) -> None:
        self.runs.close()


def index_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
                batches: int = BATCHES, fanout: int = FANOUT) -> LineRuns:
    """All of ``docs`` added to new runs in ``batches`` batches.  The texts are
    read once; the counted hashes lie in buckets as the runs do, so adding a batch
    and compacting shuffle nothing."""
    lines = LineRuns(docs.sparkSession, min_docs, fanout)
    for run in lines.count(docs, text_col, batches):
        lines.add(run)
    return lines


@passes_columns
def drop_common_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
                      batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` plus a struct ``__lines``: ``n_lines``, ``n_dropped`` and ``kept``
    (the text without the lines whose key occurs in ``min_docs`` documents).

    Null and empty texts are one empty line, never dropped (``kept`` is empty).
    A document that repeats a line counts once; equal rows count each.  Lines
    that differ only in outer white space or A-Z case share a key.  Extra
    columns are passed on.  An empty table stays empty."""
    spark = docs.sparkSession
    own = [F.col(f"`{c}`") for c in docs.columns]
    path = scratch_path(spark, "line-frequent")
    lines = index_lines(docs, text_col, min_docs, batches, fanout)
    lines.frequent().write.options(**SMALL_FILES).parquet(path)
    lines.close()
    frequent = spark.read.schema("h1 BIGINT, h2 BIGINT").parquet(path)
    if frequent.count() <= BROADCAST_ROWS:
        frequent = F.broadcast(frequent)

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    row_key = [F.xxhash64(text).alias("__t1"), F.xxhash64(text, F.lit(1)).alias("__t2")]
    found = (docs.select(*row_key, F.posexplode(_lines(text_col)).alias("pos", "line"))
             .select("__t1", "__t2", "pos", *_hashes(line_key(F.col("line"))))
             .join(frequent, ["h1", "h2"], "left_semi")
             .groupBy("__t1", "__t2").agg(F.collect_set("pos").alias("__drop")))
    # written first, so that AQE sees two plain join sides and can split a text that many rows share
    path = scratch_path(spark, "line-drops")
    found.write.options(**SMALL_FILES).parquet(path)
    found = spark.read.schema("__t1 BIGINT, __t2 BIGINT, __drop ARRAY<INT>").parquet(path)
    both = docs.select(*own, *row_key).join(found, ["__t1", "__t2"], "left")
    both = both.withColumn("__split", _lines(text_col))
    n = F.size("__split")
    kept_at = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__drop"))
    kept = F.when(F.col("__drop").isNull(), text).otherwise(
        F.array_join(F.transform(kept_at, lambda i: F.get(F.col("__split"), i)), "\n"))
    out = F.struct(n.cast("long").alias("n_lines"),
                   F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
    return both.withColumn("__lines", out).select(*own, "__lines")


@passes_columns
def without_common_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
                         batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with the common lines taken out of the text; a null text stays
    null, and ``n_chars``, where there is one, follows the text."""
    out = drop_common_lines(docs, text_col, min_docs, batches, fanout)
    changed = F.col("__lines.n_dropped") > 0
    new = {text_col: F.when(changed, F.col("__lines.kept")).otherwise(F.col(f"`{text_col}`"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.char_length("__lines.kept").cast(kind)).otherwise(F.col("n_chars"))
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
