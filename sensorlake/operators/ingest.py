"""Arrival stamp of ingested rows."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.schema import ARRIVAL


def stamp_arrival(
    df: DataFrame, *, column: str = ARRIVAL, arrival: datetime | str | int | None = None
) -> DataFrame:
    """One arrival time for all rows of a run: the given one, or the start of the query.

    A text is read as wall-clock time of the session, a number as microseconds since 1970 in UTC.
    """
    if isinstance(arrival, int):
        stamp = F.timestamp_micros(F.lit(arrival))
    else:
        stamp = F.current_timestamp() if arrival is None else F.lit(arrival).cast("timestamp")
    return df.withColumn(column, stamp)
