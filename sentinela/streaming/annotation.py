"""The annotation job on new files only (I1, J4, K2): Structured Streaming over the
mapping results, with every batch's output in folders of its own.

A batch overwrites its folders, so one that failed after writing and runs again
leaves the rows of one run.  What is kept:

``counts/batch=N``     hits per (sample, gene) among the batch's files, the only
                       thing later batches need of them
``infection/batch=N``  annotated rows of every sample that the batch touched, made
                       from all of the sample's counts so far

A sample whose part files arrive in several batches is thus counted whole, and its
newest rows are the valid ones.  Joins, counts and the row guard see touched samples
only; no hit is read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import abundance as A
from ..operators.joins import broadcast_if_small
from ..operators.partitions import pin
from ..session import few_listing_tasks
from ..sources.files import MAPPING_RESULT_SCHEMA

_COUNTS = T.StructType([T.StructField("sample", T.StringType()), T.StructField("gene", T.StringType()),
                        T.StructField("otu", T.LongType()), T.StructField("batch", T.LongType())])
_ROWS = T.StructType([T.StructField("sample", T.StringType()), T.StructField("bacteria", T.StringType()),
                      T.StructField("otu", T.LongType()), T.StructField("batch", T.LongType())])


class SampleLoad:
    """One incremental load: an inbox of mapping results and the folder ``store``.

    ``labels`` is ``gene, bacteria``; samples with fewer than ``min_rows`` annotated
    rows give none (they do once later files bring enough)."""

    def __init__(self, spark: SparkSession, inbox: str, store: str, labels: DataFrame, min_rows: int = 2,
                 marker: str | None = A.GENE_MARKER):
        self.spark, self.inbox, self.store = spark, inbox, store.rstrip("/")
        self.labels, self.min_rows, self.marker = labels, min_rows, marker

    def _stored(self, part: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.store}/{part}")

    def _put(self, df: DataFrame, part: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.store}/{part}/batch={batch}")

    def write(self, hits: DataFrame, batch: int) -> None:
        """One batch of hits (``sample, gene``); safe to repeat with the same number."""
        self._put(A.gene_counts(hits, ["sample"], marker=self.marker), "counts", batch)
        counts = self._stored("counts", _COUNTS).filter(F.col("batch") <= batch)
        touched = pin(counts.filter(F.col("batch") == batch).select("sample").distinct())
        whole = (counts.join(broadcast_if_small(touched), "sample", "left_semi")
                 .groupBy("sample", "gene").agg(F.sum("otu").alias("otu")))
        rows = A.annotate(whole, self.labels).select("sample", "bacteria", "otu")
        self._put(A.min_rows_guard(rows, ["sample"], self.min_rows), "infection", batch)

    def run(self, max_files_per_trigger: int | None = None, timeout_s: float | None = None) -> None:
        """Load the files of the inbox that no earlier run has loaded, then stop."""
        with few_listing_tasks(self.spark):     # the inbox is listed by every batch as well as here
            self._run(max_files_per_trigger, timeout_s)

    def _run(self, max_files_per_trigger: int | None, timeout_s: float | None) -> None:
        reader = self.spark.readStream.schema(MAPPING_RESULT_SCHEMA).format("csv").option("sep", "\t")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        hits = reader.load(self.inbox).select(
            F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("sample"), "gene")
        query = (hits.writeStream.foreachBatch(lambda df, n: self.write(df, n))
                 .option("checkpointLocation", f"{self.store}/checkpoint").trigger(availableNow=True).start())
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            query.stop()
            raise TimeoutError(f"load into {self.store} did not finish in {timeout_s}s")

    def annotated(self) -> DataFrame:
        """``sample, bacteria, otu``: the newest rows of every sample."""
        newest = (self._stored("counts", _COUNTS).groupBy("sample").agg(F.max("batch").alias("batch")))
        return self._stored("infection", _ROWS).join(newest, ["sample", "batch"]).select("sample", "bacteria", "otu")
