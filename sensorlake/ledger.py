"""What has been taken into a table: files, and the batches that brought them.

The ledger is a small table beside its target. A batch is noted before its rows are written, with its
stamp of arrival and its files, and noted as done afterwards. Its rows lie in a partition of their own
(`tables.replace_batch`), so a batch that was cut off in between is written again, in place of whatever
the first attempt left.

A file counts as taken by its path, size and time of modification: one that was changed is taken again.
One writer per table at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import tables

FILES = "files"  # the source of batches that are lists of files; a stream's is the id of its query
_SCHEMA = "source string, batch long, arrival timestamp, path string, size long, modified timestamp, done boolean"
_FILE = ("path", "size", "modified")


@dataclass(frozen=True)
class Batch:
    """A batch of a source; `arrival` in microseconds, which no time zone can shift."""

    source: str
    number: int
    arrival: int

    @property
    def name(self) -> str:
        return f"{self.source}-{self.number}"


def ledger_table(target: str) -> str:
    return f"{target}_files"


def _noted(spark: SparkSession, target: str) -> DataFrame:
    name = ledger_table(target)
    tables.ensure(spark, name, _SCHEMA)
    return spark.table(name)


def _note(spark: SparkSession, target: str, batch: Batch, files: DataFrame | None, done: bool) -> None:
    if files is None:
        files = spark.range(1).select(F.lit(None).alias("path"), F.lit(None).alias("size"), F.lit(None).alias("modified"))
    rows = files.select(
        F.lit(batch.source).alias("source"),
        F.lit(batch.number).cast("long").alias("batch"),
        F.timestamp_micros(F.lit(batch.arrival)).alias("arrival"),
        *[F.col(c).cast(kind).alias(c) for c, kind in zip(_FILE, ("string", "long", "timestamp"))],
        F.lit(done).alias("done"),
    )
    # One file: the note is there as a whole or not at all.
    rows.coalesce(1).write.insertInto(ledger_table(target))


def stamp(spark: SparkSession, target: str, arrival: datetime | str | None, *, rising: bool | None = None) -> int:
    """The arrival of the next batch in microseconds: the given one, or now.

    With `rising` (the default where none is given) it lies after that of every batch noted, also when a
    clock goes back, so that no later job takes the batch for one that it has seen.
    """
    given = F.current_timestamp() if arrival is None else F.lit(arrival).cast("timestamp")
    now, last = _noted(spark, target).agg(F.unix_micros(F.max("arrival"))).select(F.unix_micros(given), "*").first()
    rising = arrival is None if rising is None else rising
    return now if last is None or not rising else max(now, last + 1)


def listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, size, modified of the files of a glob; none of them is opened."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def fresh(spark: SparkSession, target: str, path: str | list[str]) -> DataFrame:
    """The files of the glob that no batch has noted as they are now."""
    noted = _noted(spark, target).where("path IS NOT NULL").select(*_FILE)
    return listed(spark, path).join(noted, list(_FILE), "left_anti")


def unfinished(spark: SparkSession, target: str, source: str = FILES) -> list[Batch]:
    """Batches of a source that were noted, and are not done: one at most, unless several runs overlapped."""
    own = _noted(spark, target).where(F.col("source") == source)
    open_ = own.groupBy("batch").agg(F.unix_micros(F.min("arrival")).alias("arrival"), F.max("done").alias("done"))
    rows = open_.where("NOT done").orderBy("batch").collect()
    return [Batch(source, row["batch"], row["arrival"]) for row in rows]


def open_since(spark: SparkSession, target: str) -> int | None:
    """The arrival of the earliest batch of any source that is not done, in microseconds: what came
    since then may not be complete."""
    if not spark.catalog.tableExists(ledger_table(target)):
        return None
    batches = _noted(spark, target).groupBy("source", "batch")
    open_ = batches.agg(F.min("arrival").alias("arrival"), F.max("done").alias("done")).where("NOT done")
    return open_.agg(F.unix_micros(F.min("arrival"))).first()[0]


def files_of(spark: SparkSession, target: str, batch: Batch) -> list[str]:
    own = (F.col("source") == batch.source) & (F.col("batch") == batch.number) & F.col("path").isNotNull()
    return [row["path"] for row in _noted(spark, target).where(own).select("path").distinct().orderBy("path").collect()]


def begin(
    spark: SparkSession,
    target: str,
    files: DataFrame,
    arrival: int,
    *,
    most: int,
) -> Batch | None:
    """Note a batch of at most `most` of `files`, the oldest first; None if there are none."""
    if files.isEmpty():
        return None
    chosen = files.orderBy("modified", "path").limit(most)
    last = _noted(spark, target).where(F.col("source") == FILES).agg(F.max("batch")).first()[0]
    batch = Batch(FILES, 0 if last is None else last + 1, arrival)
    _note(spark, target, batch, chosen, False)
    return batch


def begin_numbered(spark: SparkSession, target: str, source: str, number: int, arrival: int) -> Batch:
    """Note a batch that has a number of its own. One that was noted before keeps its first arrival, so
    that its rows go where the first attempt put them."""
    own = _noted(spark, target).where((F.col("source") == source) & (F.col("batch") == number))
    first = own.agg(F.unix_micros(F.min("arrival"))).first()[0]
    batch = Batch(source, number, arrival if first is None else first)
    if first is None:
        _note(spark, target, batch, None, False)
    return batch


def finish(spark: SparkSession, target: str, batch: Batch) -> None:
    _note(spark, target, batch, None, True)
