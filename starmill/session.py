"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the plans rely on.  Partition counts are left to adaptive execution, which
# starts from a high number and merges small partitions after each shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Column calls otherwise record their call sites, at several driver round trips each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Row groups of at most 16 MB: a scan cannot divide one, so with larger ones a task reads, and sorts, more
# rows than its split has.
ROW_GROUPS = {"parquet.block.size": str(16 << 20)}

# Options of every stored table and intermediate: they take a fifth to a third less room than by default, and
# whatever is written is read at least once.
STORED = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "6",
    "parquet.writer.version": "v2",  # what has no dictionary is stored as differences
    **ROW_GROUPS,
}

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: dict[str, list[str]] = {}  # scratch folders by application


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starmill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``.  Only a session of one process on this machine may
    do without that setting; a cluster, also a simulated one, must name a shared folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="starmill-")
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this application has written to its scratch folders; returns their number.

    Call it when no result that reads them is needed any more, at the latest at the end of a run.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action in this block go when the action ends.

    By default they stay until the driver happens to collect its garbage, so the disks of a run of many
    steps would hold the exchanges of all of them.
    """
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def written(spark: SparkSession, df, label: str):
    """``df`` stored once in the shared folder and read back.

    Several consumers then read files instead of repeating the plan, and a lost
    executor costs re-reading files, not recomputing the lineage.
    """
    path = scratch_path(spark, label)
    df.write.options(**STORED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
