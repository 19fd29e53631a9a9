"""Session settings, the shared staging folder, and staged (materialised once) frames."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A hash join only where every task's side is measured to be small, else a sort-merge join, which can spill.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Engine settings, read from the session so that a cluster can tune them without code changes.
BROADCAST_BYTES = ("spark.tidemark.broadcast.maxBytes", 10 * 1024 * 1024)
SKEW_MIN_BYTES = ("spark.tidemark.skew.minBytes", 256 * 1024 * 1024)
SKEW_MIN_ROWS = ("spark.tidemark.skew.minRows", 1_000_000)

#: Spark's own setting: does a query delete its shuffle files when it ends?
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int = 8, app: str = "tidemark", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own.

    The broadcast limits are low, as a join of two small files is faster on all cores than in the one task per file.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.autoBroadcastJoinThreshold", str(1024 * 1024))
        .config(BROADCAST_BYTES[0], str(1024 * 1024))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Codec of staged and stored files: rows are written several times on their way, and zstd makes them smaller than snappy.
CODEC = "zstd"


def setting(spark: SparkSession, option: tuple[str, int]) -> int:
    key, default = option
    return int(spark.conf.get(key, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local[...]`` session may go without: it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: later steps see the same rows in the same files, also after an executor is lost.
    """
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A folder for staged frames that is removed at the end of the block."""
    folder = f"{shared_dir(spark)}/load-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """In the block each query deletes its shuffle files when it ends.

    They else stay on the executors' disks until the driver collects its garbage, beside those of the next query. For
    frames that are read once: a second action on the very same frame would have to shuffle again.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
