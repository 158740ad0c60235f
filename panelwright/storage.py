"""Intermediate tables and size checks shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# All sides that one operator marks for broadcast hold at most this many stored bytes together.
BROADCAST_BYTES = 32 << 20
# A stored, compressed table takes up to about this many times its size in memory.
_EXPANSION = 8

#: Folders of all tables that no ``scratch`` block holds, and of those of the innermost block. A thread sees the block
#: that it was started in (see ``run_together``), so blocks of different threads do not touch each other's tables.
_KEPT: list[str] = []
_OPEN: ContextVar[list[str]] = ContextVar("open-tables", default=_KEPT)


def one_machine(master: str) -> bool:
    """Whether the driver's process runs all tasks itself."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to every executor.

    The session's ``spark.checkpoint.dir`` decides. Only where it is unset, as in tests, a folder on the session's
    default file system is used; it is deleted when the session's process ends. On a cluster that file system must be a
    shared one: a local folder would be another one on every machine, so it is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"/tmp/panelwright-{context.applicationId}")
            system = path.getFileSystem(spark._jsc.hadoopConfiguration())
            named = system.makeQualified(path).toString()
            if not one_machine(context.master) and named.startswith("file:"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            system.mkdirs(path)
            system.deleteOnExit(path)
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _OPEN.get().append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whichever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete every table stored inside the block when it ends; what the block returns must not read them."""
    mine: list[str] = []
    outer = _OPEN.set(mine)
    try:
        yield
    finally:
        _OPEN.reset(outer)
        for path in mine:
            delete(spark, path)


def clear(spark: SparkSession) -> None:
    """Delete all tables stored so far, once no result that reads them is needed any more."""
    while _KEPT:
        delete(spark, _KEPT.pop())


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and return the stored table, so that several passes do not compute it again.

    With ``partition_by`` a reader that filters on that column opens only its own files. Rebalancing keeps those
    files few and splits a value that holds most of the rows.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if partition_by is None:
        df.write.parquet(path)
    else:
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_bytes(stored: DataFrame, part: str = "") -> int:
    """Bytes of a table that ``materialize`` returned, from the size of its files; ``part`` picks one folder of it."""
    spark = stored.sparkSession
    files = [f for f in stored.inputFiles() if f"/{part}/" in f or not part]
    if not files:
        return 0
    top = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    return sum(system.getFileStatus(path(f)).getLen() for f in files)


class BroadcastBudget:
    """Marks sides for broadcast as long as they fit together; a shuffle join handles the others."""

    def __init__(self, limit: int = BROADCAST_BYTES):
        self.left = limit

    def sized(self, small: DataFrame, size: int) -> DataFrame:
        """``size``: the stored bytes of ``small``, or a bound on them."""
        if size * _EXPANSION > self.left:
            return small
        self.left -= size * _EXPANSION
        return F.broadcast(small)
