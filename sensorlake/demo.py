"""A view of the `events` table as sensor measurements.

The hour of an event is its event time (so that several arrivals share a key), its own time the
arrival, and one power reading in 17 is blank.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    degrees = F.get_json_object("props", "$.k").cast("int") * 360
    return table(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
        (F.col("user_id") % 15).cast("int").alias("turbine_id"),
        (F.col("value") / 10).alias("wind_speed"),
        F.floor(degrees / 100).cast("int").alias("wind_direction"),
        F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("power_output"),
        F.col("ts").alias("date_created"),
    )
