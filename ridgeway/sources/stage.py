"""Reuse of intermediate tables.

``reused`` keeps a frame in the executors' memory and disk for the length of a
``with`` block; a lost block is recomputed from its lineage. ``staged`` writes
the frame to the folder all executors share, which also cuts the lineage: what
is read back can no longer change when a shuffle is recomputed. A :class:`Scope`
deletes what was staged inside it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting uses a folder of its own; on a
    cluster a machine-local folder would not be seen by the others. The session
    is left as it is.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="ridgeway-")


def _path(spark: SparkSession, folder: str):
    """The folder's file system and path, as Spark sees them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses; it goes when the session's JVM ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    files, path = _path(spark, folder)
    files.deleteOnExit(path)
    if _SCOPES:
        _SCOPES[-1].folders.append(folder)
    return folder


#: Open scopes, the innermost last.
_SCOPES: list[Scope] = []


class Scope:
    """Owns what is staged while it is open, and deletes it at the end.

    ``with Scope(spark) as scope: result = scope.result(operator(df), "name")`` leaves the
    written result and nothing else: operators stage tables that a lazy result still reads,
    so they can go only once the result is written. Scopes nest; a result belongs to the
    scope around.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []

    def __enter__(self) -> Scope:
        _SCOPES.append(self)
        return self

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to a folder that outlives this scope, read back."""
        written = staged(df, name)
        kept = self.folders.pop()
        around = _SCOPES[: _SCOPES.index(self)]
        if around:
            around[-1].folders.append(kept)
        return written

    def __exit__(self, *_) -> None:
        _SCOPES.remove(self)
        for folder in self.folders:
            files, path = _path(self.spark, folder)
            files.delete(path, True)
        self.folders.clear()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of the written table."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_for(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Stage ``df`` for the block and delete the written table afterwards."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    try:
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        files, path = _path(spark, folder)
        files.delete(path, True)


@contextmanager
def reused(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Persist ``df`` inside the block and release it afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
