"""Days and hours without a reading: what a count per day cannot show, as such a day has no row."""

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions import reading
from sensorlake.schema import EVENT_TIME, SENSOR

_N, _NEXT, _BEFORE = "__unit", "__next", "__before"
_HOUR = 3600


def _units(kind: T.DataType, unit: str) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """The number of a time's unit, and the unit of a number. Days are those of the session's time zone,
    hours begin at full hours of UTC; a time without a zone is taken as it is."""
    if unit == "day":
        return lambda t: F.unix_date(F.to_date(t)), lambda n: F.date_from_unix_date(n.cast("int"))
    if unit != "hour":
        raise ValueError("gaps are counted in units of a day or an hour")
    if isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        seconds = lambda t: F.timestamp_diff("SECOND", epoch, t)
        return lambda t: F.floor(seconds(t) / _HOUR), lambda n: F.timestamp_add("HOUR", n.cast("int"), epoch)
    return lambda t: F.floor(F.unix_seconds(t) / _HOUR), lambda n: F.timestamp_seconds(n * _HOUR)


def outages(
    df: DataFrame,
    keys: Sequence[str] = (SENSOR,),
    *,
    time: str = EVENT_TIME,
    unit: str = "day",
    column: str | None = None,
    since: date | datetime | str | None = None,
    until: date | datetime | str | None = None,
    sensors: DataFrame | None = None,
) -> DataFrame:
    """Runs of days or hours without a row: keys, first, last (the missing units), missing (how many).

    Every sensor has a calendar of its own, from its first unit to its last, or from `since` and up to
    `until` where these are given. With `column`, a row whose reading is missing does not count. `sensors`
    (the key columns) adds those without any row; it needs both ends.

    Rows are first reduced to one per sensor and unit, wherever they lie; the calendar itself is never
    made: each unit is compared with the next one of its sensor. Rows without a time are left out; NULL
    keys are one sensor.
    """
    kind = df.schema[time].dataType
    number, unit_of = _units(kind, unit)
    held = df.where(F.col(time).isNotNull())
    if column is not None:
        held = held.where(reading(df, column).isNotNull())
    seen = held.select(*keys, number(F.col(time)).cast("long").alias(_N)).distinct()
    low = None if since is None else number(F.lit(since).cast(kind)).cast("long")
    high = None if until is None else number(F.lit(until).cast(kind)).cast("long")
    if low is not None:
        seen = seen.where(F.col(_N) >= low)
    if high is not None:
        seen = seen.where(F.col(_N) <= high)

    of_sensor = Window.partitionBy(*keys).orderBy(_N)
    after = F.lead(_N).over(of_sensor)
    steps = seen.withColumn(_NEXT, after if high is None else F.coalesce(after, high + 1))
    steps = steps.withColumn(_BEFORE, F.lag(_N).over(of_sensor))
    runs = [F.struct((F.col(_N) + 1).alias("a"), (F.col(_NEXT) - 1).alias("b"))]
    if low is not None:  # before the first unit of a sensor
        runs.append(F.when(F.col(_BEFORE).isNull(), F.struct(low.alias("a"), (F.col(_N) - 1).alias("b"))))
    gaps = steps.select(*keys, F.explode(F.array(*runs)).alias("r")).where("r.a <= r.b").select(*keys, "r.a", "r.b")
    if sensors is not None:
        if low is None or high is None:
            raise ValueError("sensors without any row are missing from `since` until `until`: give both")
        never = sensors.select(*keys).distinct().alias("x")
        same = [F.col(f"x.`{k}`").eqNullSafe(F.col(f"y.`{k}`")) for k in keys]
        never = never.join(seen.select(*keys).distinct().alias("y"), same, "left_anti")
        gaps = gaps.unionByName(never.select(*keys, low.alias("a"), high.alias("b")).where("a <= b"))
    return gaps.select(
        *keys,
        unit_of(F.col("a")).alias("first"),
        unit_of(F.col("b")).alias("last"),
        (F.col("b") - F.col("a") + 1).alias("missing"),
    )


def missing_days(df: DataFrame, keys: Sequence[str] = (SENSOR,), **options) -> DataFrame:
    """The days of `outages`, one row each: keys, day."""
    gaps = outages(df, keys, unit="day", **options)
    return gaps.select(*keys, F.explode(F.sequence("first", "last")).alias("day"))
