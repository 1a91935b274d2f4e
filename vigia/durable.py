"""Reliable cut points of a lineage.

Frames that several branches read, or whose partitioning must not change
between two readings, are written to the shared folder of the session, so that
a lost executor costs a re-read and never a different answer. A ``Workspace`` owns
the tables of one job and deletes them when its result no longer reads them.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read, as the session names it.

    Without the setting it is a folder beside the session's warehouse, on the same file system.
    """
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) and re.match(r"(file:|/|[^:]*$)", folder):
            raise ValueError(f"{folder} may be a folder of one machine: set {SETTING} to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Codec of stored text, which is written more often than it is read.
COMPACT = "zstd"


def stored(frame: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The frame written as Parquet under the shared folder and read back.

    Unlike a checkpoint, later reads prune columns and push filters down. ``codec`` is the session's unless given.
    """
    path = scratch_path(frame.sparkSession, name)
    _write(frame, path, codec)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _write(frame: DataFrame, path: str, codec: str | None) -> None:
    (frame.write if codec is None else frame.write.option("compression", codec)).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path, on whatever file system it is, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Workspace:
    """The intermediate tables of one job.

    ``with Workspace(spark) as work``: ``work.stored`` keeps a table until the end of the block or
    until ``work.drop``; ``work.kept`` stores what the job returns. A table may be dropped once
    everything computed from it is stored; then no reader, and no task that is repeated after
    the loss of an executor, goes back to it. A job that fails leaves nothing behind.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._own: list[tuple[DataFrame | None, str]] = []

    def stored(
        self, frame: DataFrame, name: str, instead_of: tuple[DataFrame, ...] = (), codec: str | None = None
    ) -> DataFrame:
        """The stored frame; the tables it replaces are dropped when it is complete."""
        path = scratch_path(self._spark, name)
        self._own.append((None, path))
        _write(frame, path, codec)
        table = self._spark.read.schema(frame.schema).parquet(path)
        self._own[-1] = (table, path)
        self.drop(*instead_of)
        return table

    def kept(self, frame: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        """A table that outlives the block."""
        return stored(frame, name, codec)

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this workspace; others are left alone."""
        for table, path in [own for own in self._own if any(own[0] is t for t in tables)]:
            remove(self._spark, path)
        self._own = [own for own in self._own if not any(own[0] is t for t in tables)]

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        for _, path in self._own:
            remove(self._spark, path)
        self._own = []
