"""Intermediate tables that every executor can read, and small expression helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a fresh local one in local mode only."""
    folder = spark.conf.get(_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_KEY} to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(_KEY, folder)
    return folder.rstrip("/")


#: Paths given out since the start of each open scratch() block.
_made: list[list[str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _made:
        made.append(path)
    return path


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends there.

    Operators that stage run jobs while their result is being declared. What they write stays until the session's folder is cleared, or until
    the scratch() block around the call ends.
    """
    path = shared_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables of the shared folder that no plan reads any more."""
    for p in paths:
        if not p.startswith(shared_dir(spark) + "/"):
            raise ValueError(f"{p} isn't in the shared folder")
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession):
    """Delete, at the end of the block, all that was staged in it: for use once an operator's result has been written elsewhere."""
    _made.append(made := [])
    try:
        yield made
    finally:
        _made[:] = [m for m in _made if m is not made]  # by identity: blocks that staged nothing are equal lists
        discard(spark, *made)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` computed once, however often ``body`` uses ``x``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns whose names (in any case) an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
