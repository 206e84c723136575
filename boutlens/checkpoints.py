"""Cutting lineage in a folder that all executors can read, and giving back the disk of what led there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from .sources.storage import delete

#: Spark removes the shuffle files of an action when it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders written by the :func:`alone` that runs, if any.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)
#: The folder of each frame that :func:`written` gave.
_FOLDER_OF: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def checkpoint_folder(df: DataFrame) -> str:
    """The shared folder that the session names.

    Where it names none, a session of one machine takes a temporary folder; on a cluster that is an error, since other
    machines could not read it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions on frames made inside leave no shuffle files; the session's setting is as before afterwards."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in :func:`checkpoint_folder`; the shuffle files behind it go."""
    checkpoint_folder(df)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet files in :func:`checkpoint_folder`: for wide rows of which each reader needs a few columns, where a checkpoint
    would be read whole each time. The shuffle files behind it go."""
    path = f"{checkpoint_folder(df)}/{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.select("*").write.parquet(path)
    if (folders := _FOLDERS.get()) is not None:
        folders.append(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDER_OF[kept] = path
    return kept


def dropped(*frames: DataFrame | None) -> None:
    """Deletes the files of frames that :func:`written` gave and that nothing reads any more."""
    for df in frames:
        if df is not None and (path := _FOLDER_OF.pop(df, None)):
            delete(df.sparkSession, path)


def alone(make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` :func:`written`; what was written on the way to it is deleted, for nothing reads it any more.

    What ``make`` returns may rest on those files, but nothing else that outlives it may.
    """
    folders: list[str] = []
    outer = _FOLDERS.set(folders)
    try:
        df = written(make())
    finally:
        _FOLDERS.reset(outer)
    if (above := _FOLDERS.get()) is not None:
        above.append(folders[-1])
    for path in folders[:-1]:
        delete(df.sparkSession, path)
    return df
