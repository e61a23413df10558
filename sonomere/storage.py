"""The folder all executors share, for tables that cut lineage."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: list[str] = []
# Paths given out and not released yet.
_paths: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="sonomere-"))
    return _local_folder[0]


def new_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    _paths.append(path)
    return path


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables written so far. Results that read them must have been written or
    collected before: they are lazy, and only their owner knows when they are no longer needed.
    """
    context = spark.sparkContext
    configuration = context._jsc.hadoopConfiguration()
    while len(_paths) > since:
        path = context._jvm.org.apache.hadoop.fs.Path(_paths.pop())
        path.getFileSystem(configuration).delete(path, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end of the block."""
    since = len(_paths)
    try:
        yield
    finally:
        release(spark, since)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed inside are deleted as soon as it ends, instead of when the
    driver happens to collect its garbage. Meant for steps that each end in ``written``: their
    shuffles are of no use afterwards. Other queries of the session that end meanwhile do the same.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
