"""Session set-up and the shared folder used for checkpoints and scratch tables.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by the
cluster).  Only when it is unset, as in local tests, is a folder created here.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # checkpoint files of pinned tables are removed once no plan refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_LOCAL_ROOT: dict[int, str] = {}


def build_session(master: str = "local[8]", app: str = "sentinela",
                  shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions)}
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def scale_conf(shuffle_bytes: int, total_cores: int, partition_bytes: int = 128 << 20,
               broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings sized to a job: ``shuffle_bytes`` is what its widest stage
    shuffles (after projection and partial aggregation).  Shuffle partitions
    hold about ``partition_bytes`` each (at least two per core); AQE coalesces
    smaller ones and splits skewed ones above four times that size."""
    parts = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


def shared_root(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``, else a test-only temp dir."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    key = id(sc)
    if key not in _LOCAL_ROOT:
        existing = sc.getCheckpointDir()
        if not existing and sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if existing:
            _LOCAL_ROOT[key] = existing.rstrip("/")
        else:
            local = tempfile.mkdtemp(prefix="sentinela-")
            sc.setCheckpointDir(local)
            _LOCAL_ROOT[key] = local
    return _LOCAL_ROOT[key]


#: For scratch tables of very many small files: Hadoop's local file system without the checksum file beside
#: each one.  A file and its checksum are two files and four permission changes, each of them a process where
#: Hadoop's native library is missing.  Other file systems do not read these options.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Within it, folders are listed by at most four tasks a core.  Spark's default is a task
    a folder up to 10,000, and a task costs the driver and its executor far more than
    listing a folder does: its start, the Hadoop settings, its metrics."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


OPEN_COST = "spark.sql.files.openCostInBytes"
SMALL_FILE_BYTES = 256 << 10


@contextmanager
def many_files_a_task(spark: SparkSession) -> Iterator[None]:
    """Within it, scans that run count a file's opening as ``SMALL_FILE_BYTES``.  Spark's
    default of 4 MB makes a task of every 32 small files, and a task that writes makes folders
    and files of its own.  Large files are split as before."""
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, str(SMALL_FILE_BYTES))
    try:
        yield
    finally:
        spark.conf.set(OPEN_COST, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"
