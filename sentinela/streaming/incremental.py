"""Incremental loading with Structured Streaming.

Each run reads only files not seen by earlier runs (the file source keeps the
list in its checkpoint), writes them with the exactly-once file sink (its
``_spark_metadata`` log makes a retried batch invisible until committed) and
stops when the inbox is drained (``trigger(availableNow=True)``).  The inputs of a
finished run are moved to an archive folder.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.partitions import pin
from ..session import few_listing_tasks


def load_new_files(spark: SparkSession, inbox: str, sink: str, checkpoint: str,
                   schema: T.StructType, transform: Callable[[DataFrame], DataFrame] | None = None,
                   fmt: str = "parquet", archive_dir: str | None = None,
                   max_files_per_trigger: int | None = None, timeout_s: float | None = None) -> None:
    """Load every file of ``inbox`` not loaded by an earlier run into ``sink``.

    ``transform`` must be a row-level (stateless) function, so the stream can
    append.  With ``archive_dir``, the files that were in ``inbox`` at the start are
    moved there once the run has finished, every one of them being loaded by then.
    A run that fails moves nothing; the next one that finishes does.
    """
    with few_listing_tasks(spark):
        _load(spark, inbox, sink, checkpoint, schema, transform, fmt, archive_dir, max_files_per_trigger, timeout_s)


def _load(spark, inbox, sink, checkpoint, schema, transform, fmt, archive_dir, max_files_per_trigger, timeout_s) -> None:
    waiting = _listing(spark, inbox) if archive_dir else None
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(inbox)
    if transform is not None:
        stream = transform(stream)
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("path", sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"incremental load into {sink} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()
    if archive_dir:
        _move(spark, waiting, archive_dir)


#: Files moved at once.
MOVERS = 16


def _listing(spark: SparkSession, inbox: str) -> DataFrame:
    """Paths of the files in ``inbox``, kept as a table in the shared folder."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inbox)
    return pin(listing.select("path"))


def _move(spark: SparkSession, listing: DataFrame, archive_dir: str) -> None:
    """Move files under ``archive_dir``, keeping their whole path below it.  The names
    come by a partition at a time and several are moved at once; a file that an earlier,
    broken move has taken is passed over."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def move(name: str) -> None:
        source = hadoop.Path(name)
        target = hadoop.Path(f"{archive_dir.rstrip('/')}{source.toUri().getPath()}")
        fs = source.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        if fs.exists(source) and not fs.rename(source, target):
            raise OSError(f"cannot move {name} to {target}")

    names = (r.path for r in listing.toLocalIterator())
    with ThreadPoolExecutor(MOVERS) as pool:
        while some := list(islice(names, 64 * MOVERS)):
            list(pool.map(move, some))    # raises what a move raised


def read_loaded(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows committed to the sink (only files named in its commit log)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(sink)
