"""Daily roll-up."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions import reading, stable_round
from sensorlake.schema import EVENT_TIME, SENSOR


def with_date(df: DataFrame, *, time: str = EVENT_TIME, name: str = "date") -> DataFrame:
    """Calendar date of the event time, in the session time zone."""
    return df.withColumn(name, F.to_date(time))


def daily_metrics(
    df: DataFrame,
    *,
    column: str = "power_output",
    keys: Sequence[str] = (SENSOR,),
    date: str = "date",
    digits: int = 2,
) -> DataFrame:
    """Smallest, largest and rounded mean reading per key and day; missing ones are left out."""
    value = reading(df, column)
    return df.groupBy(*keys, date).agg(
        F.min(value).alias(f"{column}_daily_min"),
        F.max(value).alias(f"{column}_daily_max"),
        stable_round(F.avg(value), digits).alias(f"{column}_daily_mean"),
    )
