"""The ingest job as a stream that stops when it has read what is there, and the job chain behind it.

The stream's checkpoint remembers the files, so that each is read once. A batch that is repeated after a
crash replaces its rows: it is noted under the id that the checkpoint gives the stream and its number,
with its first stamp of arrival, and has a partition of its own (see `ledger`). A table that was made
without batches is appended to; a repeated batch is then in it twice, and the clean job keeps one row per
key, as it does for any repeated delivery.
"""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sensorlake import ledger, schema, tables
from sensorlake.operators.ingest import stamp_arrival
from sensorlake.plans import jobs
from sensorlake.plans.jobs import RAW
from sensorlake.sources import CORRUPT

_QUERY_ID = "sql.streaming.queryId"  # set by Spark on the thread that runs a batch


def ingest_new_files(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    *,
    table: str = RAW,
    arrival: datetime | str | None = None,
    max_files: int | None = None,
    fmt: str = "parquet",
    then: Callable[[], None] | None = None,
) -> int:
    """Take the files of the glob that no earlier run with this checkpoint has read into the table; returns
    the number of batches.

    A line with a cell that does not fit its type is kept in the column CORRUPT, as by the job. `then` is
    run after each batch, and again after a repeated one; stamps of arrival then rise from batch to batch,
    also given ones.
    """
    exists = spark.catalog.tableExists(table)
    keep = not exists or CORRUPT in spark.table(table).columns
    by_batch = not exists or tables.has_batches(spark, table)
    taken: list[int] = []

    def replace(rows: DataFrame, number: int) -> None:
        source = rows.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        rising = arrival is None or then is not None
        stamp = ledger.stamp(spark, table, arrival, rising=rising)
        batch = ledger.begin_numbered(spark, table, source, number, stamp)
        stamped = jobs.raw_columns(stamp_arrival(rows, arrival=batch.arrival), keep)
        tables.ensure(spark, table, stamped.schema, day_of=schema.ARRIVAL, batches=True, fmt=fmt)
        tables.replace_batch(stamped, table, batch.name, batch.arrival)
        ledger.finish(spark, table, batch)

    def take(rows: DataFrame, number: int) -> None:
        if by_batch:
            replace(rows, number)
        else:
            stamped = jobs.raw_columns(stamp_arrival(rows, arrival=arrival), keep)
            tables.append(stamped, table, day_of=schema.ARRIVAL, fmt=fmt)
        spark.catalog.refreshTable(table)  # written by the stream's own session
        if then is not None:
            then()
        taken.append(number)

    columns = T.StructType(list(schema.MEASUREMENT.fields))
    reader = spark.readStream.schema(columns.add(CORRUPT, T.StringType()) if keep else columns)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.option("header", True).option("enforceSchema", False)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.csv(path)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()
    return len(taken)


def run_new_files(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    *,
    raw: str = jobs.RAW,
    cleaned: str = jobs.CLEANED,
    daily: str = jobs.DAILY,
    arrival: datetime | str | None = None,
    max_files: int | None = None,
    fmt: str = "parquet",
) -> None:
    """The three jobs for each batch of new files: take it in, clean it, roll its dates up.

    Each of them can be repeated: a batch that was cut off anywhere in between leaves the tables, once it
    has run again, as if it had run once. A run without new files makes up for a clean job or a roll-up
    that an earlier one did not come to.
    """

    def refine() -> None:
        jobs.clean(spark, source=raw, target=cleaned, fmt=fmt)
        jobs.roll_up(spark, source=cleaned, target=daily, new_dates_only=True, fmt=fmt)

    batches = ingest_new_files(
        spark, path, checkpoint, table=raw, arrival=arrival, max_files=max_files, fmt=fmt, then=refine
    )
    if not batches and spark.catalog.tableExists(raw):
        refine()
