"""Fixed schemas of the three table layers (column names and types are fixed values)."""

from pyspark.sql import types as T

MEASUREMENT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("turbine_id", T.IntegerType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("wind_direction", T.IntegerType()),
        T.StructField("power_output", T.DoubleType()),
    ]
)

CLEAN = T.StructType([*MEASUREMENT.fields, T.StructField("date_created", T.TimestampType())])

DAILY = T.StructType(
    [
        T.StructField("turbine_id", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("power_output_daily_min", T.DoubleType()),
        T.StructField("power_output_daily_max", T.DoubleType()),
        T.StructField("power_output_daily_mean", T.DoubleType()),
    ]
)

# Defaults shared by the operators; every one of them is also an argument.
EVENT_TIME = "timestamp"
SENSOR = "turbine_id"
ARRIVAL = "date_created"
READINGS = ("wind_speed", "wind_direction", "power_output")
READING_KEYS = (SENSOR, EVENT_TIME)
