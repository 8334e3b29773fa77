"""Cutting the lineage of a DataFrame in a way that outlives lost executors, and clearing away what was written for that."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders of the workspaces that are open, the innermost last.
_OPEN: list[str] = []
#: Checkpoint folders of the application that are removed when it ends.
_MARKED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the cluster names in spark.checkpoint.dir, or below it that of the open workspace.

    Where none is named, a folder of our own is made, but on a local master only: executors elsewhere would not see it.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    if (own := context.getCheckpointDir()) not in _MARKED:
        _MARKED.add(own)
        removed_at_exit(spark, own)
    return _OPEN[-1] if _OPEN else spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, for what a result is read from; it goes when the application ends, if not earlier."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    removed_at_exit(spark, path)
    return path


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder, in whatever file system it lies."""
    place, store = _place(spark, path)
    store.delete(place, True)


def removed_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's file system remove a folder when the application ends, after an error as well."""
    place, store = _place(spark, path)
    store.mkdirs(place.getParent())
    exists = store.exists(place)
    if not exists:
        store.mkdirs(place)  # only what exists can be marked
    store.deleteOnExit(place)
    if not exists:
        store.delete(place, True)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """Checkpoints and folders made inside go to one folder, which is removed at the end, after an error as well. Results that are read later have to be written elsewhere."""
    folder = new_folder(spark, "work")
    context = spark.sparkContext
    before = context.getCheckpointDir()
    context.setCheckpointDir(folder)
    _OPEN.append(folder)
    try:
        yield folder
    finally:
        _OPEN.pop()
        _restored(spark, before)
        removed(spark, folder)


def _restored(spark: SparkSession, before: str) -> None:
    """Set the checkpoint folder back. Spark makes a new folder below the one it is given, so the one it had made is not nested deeper each time."""
    parent = before.rstrip("/").rsplit("/", 1)[0]
    spark.sparkContext.setCheckpointDir(parent)
    shared_folder(spark)
