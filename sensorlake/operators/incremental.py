"""Batch-incremental loading by an arrival-time high-watermark."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions import utc_day
from sensorlake.schema import ARRIVAL


def high_watermark(target: DataFrame, *, column: str = ARRIVAL) -> DataFrame:
    """One row: the latest arrival in `target`, or the epoch when it has none."""
    data_type = target.schema[column].dataType.simpleString()
    epoch = F.timestamp_seconds(F.lit(0))
    if data_type == "timestamp_ntz":
        epoch = F.lit("1970-01-01 00:00:00")
    return target.agg(F.coalesce(F.max(column), epoch.cast(data_type)).alias(column))


def newer_than_target(
    df: DataFrame, target: DataFrame, *, column: str = ARRIVAL, day: str | None = None
) -> DataFrame:
    """Rows that arrived strictly after everything in `target`.

    The watermark is a scalar subquery, so the comparison reaches the file scan. `day` names the
    partition column of `df` holding the UTC day of arrival: older partitions are then skipped.
    """
    return newer_than(df, high_watermark(target, column=column).scalar(), column=column, day=day)


def newer_than(df: DataFrame, watermark: Column, *, column: str = ARRIVAL, day: str | None = None) -> DataFrame:
    """Rows that arrived strictly after `watermark`; a literal leaves out partitions when `df` is planned."""
    newer = F.col(column) > watermark
    if day is not None:
        data_type = df.schema[column].dataType.simpleString()
        newer = newer & (F.col(day) >= utc_day(watermark, data_type))
    return df.where(newer)
