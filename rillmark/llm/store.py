"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it
back, so a lost executor costs a reread and no recomputation of earlier passes.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
#: Folders of this session's tables.
_used: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only where the setting is absent and the master local (tests)."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if context.applicationId not in _own_folder:
        folder = tempfile.mkdtemp(prefix="rillmark-")
        context.setCheckpointDir(folder)
        _own_folder[context.applicationId] = f"file://{folder}"
    return _own_folder[context.applicationId]


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names that ``frame`` doesn't have."""
    taken, out = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tables_so_far(spark: SparkSession) -> int:
    """A mark for ``clean``."""
    return len(_used.get(spark.sparkContext.applicationId, []))


def clean(spark: SparkSession, since: int) -> None:
    """Free the tables that operators of this session have begun since a mark: for when every result made of them is written."""
    folders = _used.get(spark.sparkContext.applicationId, [])
    while len(folders) > since:
        delete(spark, folders.pop())


class Scratch:
    """Tables of one run of one operator, below one folder of their own."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{operator}-{uuid.uuid4().hex}"
        _used.setdefault(spark.sparkContext.applicationId, []).append(self.folder)

    def keep(self, name: str, frame: DataFrame) -> DataFrame:
        """Write a table and return it as read back."""
        frame.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{name}")

    def drop(self, name: str = "") -> None:
        """Free a table that nothing later reads, or all of them."""
        delete(self.spark, f"{self.folder}/{name}" if name else self.folder)

    def free_shuffles(self) -> None:
        """Let Spark delete the shuffle files of passes whose tables have been written."""
        free_finished(self.spark)


def free_finished(spark: SparkSession) -> None:
    """Drop what finished passes still hold: their plans in the driver and, through Spark's cleaner, their shuffle files."""
    gc.collect()
    spark._jvm.System.gc()
