"""Intermediate tables in the shared checkpoint folder.

A staged frame cuts the lineage (an executor lost later does not recompute what lies before it),
keeps columnar pruning, and gives Catalyst real file sizes to plan with. The shuffle files behind it are
deleted as soon as it is written: nothing reads them again, and a job of many steps would otherwise hold
those of all its steps until the driver happens to collect its garbage.
"""

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS = 1_000  # whole texts handed to an Arrow function at once
_of_thread = threading.local()


def _open_scopes() -> list[list[str]]:
    if not hasattr(_of_thread, "scopes"):
        _of_thread.scopes = []
    return _of_thread.scopes


def folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or by setCheckpointDir.

    Where none is named, one below the warehouse: what holds the tables is as shared as they are.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def _own_folder(spark: SparkSession) -> str:
    return f"{folder(spark).rstrip('/')}/sensorlake-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    """A path that nothing stands at yet; what is written there belongs to the open scope."""
    path = f"{_own_folder(spark)}/{uuid.uuid4().hex}"
    if _open_scopes():
        _open_scopes()[-1].append(path)
    return path


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of what runs within the block when each execution ends.

    A frame that has run within the block can run again; it then shuffles anew.
    """
    before = spark.conf.get(_FREEING, None)
    spark.conf.set(_FREEING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREEING)
        else:
            spark.conf.set(_FREEING, before)


@contextmanager
def _batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Have Spark hand rows to Arrow functions so many at a time, or fewer where it is set so already."""
    before = spark.conf.get(_BATCH, None)
    if rows is None or before is not None and 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def stage(df: DataFrame, path: str | None = None, *, batch: int | None = None) -> DataFrame:
    """Write `df` once and return a frame that reads it back.

    `batch` rows at most go to an Arrow function at once: whole texts in Spark's 10,000 take both the
    executor and its Python workers a hundred MB and more.
    """
    if path is None:
        path = new_path(df.sparkSession)
    elif _open_scopes():
        _open_scopes()[-1].append(path)
    with freeing(df.sparkSession), _batches_of(df.sparkSession, batch):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a staged frame that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def collecting(paths: list[str]) -> Iterator[None]:
    """Add the paths of all that is staged within the block to `paths`, to be dropped later."""
    _open_scopes().append(paths)
    try:
        yield
    finally:
        _open_scopes().pop()


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete all that is staged within the block when it ends, also when it fails."""
    paths: list[str] = []
    try:
        with collecting(paths):
            yield
    finally:
        for path in paths:
            drop(spark, path)


def sweep(spark: SparkSession) -> None:
    """Delete all that this application staged; for the end of a program."""
    drop(spark, _own_folder(spark))
