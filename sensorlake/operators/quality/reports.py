"""Profiles, counts, freshness and bucketed series."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions import reading
from sensorlake.operators.grouping import ROWS
from sensorlake.operators.quality.gaps import missing_days
from sensorlake.operators.quality.quantiles import EXACT_ROWS, LARGER, QUARTILES, quantiles
from sensorlake.schema import EVENT_TIME, READINGS, SENSOR
from sensorlake.staging import stage


def profile(df: DataFrame, columns: Sequence[str] | None = None, **limits: int) -> DataFrame:
    """One row per column: count, mean, stddev, min, exact quartiles, max.

    Text columns have a count and the first and last text in order (`min_text`, `max_text`, which are
    there when any column is a text). By default all numeric and text columns. One pass gives all but
    the quartiles; a second one gives those, or as many as `quantiles` needs for large tables.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if columns is None:
        columns = [c for c, kind in kinds.items() if isinstance(kind, (T.NumericType, T.StringType))]
    texts = [c for c in columns if isinstance(kinds[c], T.StringType)]
    numbers = [c for c in columns if c not in texts]
    value = {c: reading(df, c).cast("double") for c in numbers}
    none, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def cells(column: str) -> Column:
        v, text = value.get(column), column in texts
        parts = [
            F.count(column if text else v).alias("count"),
            (none if text else F.avg(v)).alias("mean"),
            (none if text else F.stddev_samp(v)).alias("stddev"),
            (none if text else F.min(v)).alias("min"),
            (none if text else F.max(v)).alias("max"),
            (F.min(column) if text else no_text).alias("min_text"),
            (F.max(column) if text else no_text).alias("max_text"),
        ]
        return F.struct(F.lit(column).alias("column"), *parts).alias(f"__{column}")

    def unpivoted(one_row: DataFrame) -> DataFrame:
        return one_row.select(F.explode(F.array(*one_row.columns)).alias("c")).select("c.*")

    basics = stage(unpivoted(df.agg(*[cells(c) for c in columns])))
    inner = None
    if numbers:
        most = basics.where(F.col("mean").isNotNull() | (F.col("count") == 0)).agg(F.max("count")).first()[0]
        if (most or 0) <= limits.get("exact_rows", EXACT_ROWS) * LARGER:
            points = [
                F.struct(F.lit(c).alias("column"), F.percentile(v, list(QUARTILES.values())).alias("p")).alias(f"__{c}")
                for c, v in value.items()
            ]
            inner = unpivoted(df.agg(*points)).select(
                "column", *[F.col("p")[i].alias(name) for i, name in enumerate(QUARTILES)]
            )
        else:
            pairs = [F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in value.items()]
            long = df.select(F.explode(F.array(*pairs)).alias("c")).select("c.*")
            inner = quantiles(long, "value", QUARTILES, ["column"], **limits).drop(ROWS)
        basics = basics.join(inner, "column", "left")
    else:
        basics = basics.withColumns({name: none for name in QUARTILES})
    text_columns = ["min_text", "max_text"] if texts else []
    return basics.select("column", "count", "mean", "stddev", "min", "q1", "median", "q3", "max", *text_columns)


def overall_mean(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(reading(df, column)).alias(f"{column}_mean"))


def null_counts(
    df: DataFrame, columns: Sequence[str] | None = None, *, nans: bool = False
) -> DataFrame:
    """One row with the number of NULLs of each column, in a single pass.

    With `nans` also the number of NaNs of each floating-point column. Both are missing readings.
    """
    columns = df.columns if columns is None else columns
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    floating = [c for c in columns if isinstance(df.schema[c].dataType, T.FractionalType)]
    floating = [c for c in floating if not isinstance(df.schema[c].dataType, T.DecimalType)]
    if nans:
        counts += [F.count_if(F.isnan(c)).alias(f"{c}_nans") for c in floating]
    return df.agg(*counts)


def daily_counts(
    df: DataFrame,
    columns: Sequence[str] = (EVENT_TIME, *READINGS),
    keys: Sequence[str] = (SENSOR,),
    *,
    time: str = EVENT_TIME,
    sort: bool = False,
) -> DataFrame:
    """Readings per day, key and column. Sorting all rows is left to the caller's wish."""
    counts = [F.count(reading(df, c)).alias(f"{c}_count") for c in columns]
    out = df.groupBy(F.to_date(time).alias("day"), *keys).agg(*counts)
    return out.orderBy("day", *keys) if sort else out


def completeness(
    df: DataFrame,
    column: str = "power_output",
    keys: Sequence[str] = (SENSOR,),
    *,
    time: str = EVENT_TIME,
    over: int | None = None,
    under: int | None = None,
    empty_days: bool = False,
) -> DataFrame:
    """Days with more than `over` or fewer than `under` readings.

    A day without any row has no group: `empty_days` adds those between the first and the last day of
    a sensor, with 0 readings, where they are fewer than `under`.
    """
    counts = daily_counts(df, [column], keys, time=time)
    number = F.col(f"{column}_count")
    wrong = F.lit(False)
    if over is not None:
        wrong = wrong | (number > over)
    if under is not None:
        wrong = wrong | (number < under)
    found = counts.where(wrong)
    if empty_days and under is not None and under > 0:
        empty = missing_days(df, keys, time=time).withColumn(f"{column}_count", F.lit(0).cast("long"))
        found = found.unionByName(empty)
    return found


def last_seen(
    df: DataFrame, keys: Sequence[str] = (SENSOR,), *, time: str = EVENT_TIME
) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(time).alias("last_seen"))


def series(
    df: DataFrame,
    column: str,
    *,
    time: str = EVENT_TIME,
    unit: str = "hour",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Readings over time, one row per time bucket, so that its size follows the time span."""
    bucket = F.date_trunc(unit, F.col(time)).cast(df.schema[time].dataType)
    value = reading(df, column)
    return df.groupBy(*keys, bucket.alias(time)).agg(
        F.count(value).alias("count"),
        F.min(value).alias("min"),
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
    )


def series_extremes(
    df: DataFrame,
    column: str,
    *,
    time: str = EVENT_TIME,
    unit: str = "hour",
    keys: Sequence[str] = (),
) -> DataFrame:
    """The first, last, lowest and highest reading of every time bucket: keys, bucket, time, value.

    A line drawn through them keeps its shape, spikes included, with at most four points a bucket. Of
    equal readings the earliest is taken, of readings at one time the lowest as the first and the
    highest as the last. One aggregate; rows without a time or a reading are left out.
    """
    kind = df.schema[time].dataType
    at, value = F.col(time), reading(df, column)
    in_time = F.struct(at.alias("time"), value.alias("value"))
    # The highest reading is the lowest of the negated order: earliest first among equal ones.
    by_value = F.struct(value.alias("value"), at.alias("time"))
    lowest, highest = F.min(by_value), F.max_by(in_time, F.struct(value, F.lit(0) - _instant(at, kind)))
    points = F.array(
        F.min(in_time),
        F.max(in_time),
        F.struct(lowest["time"].alias("time"), lowest["value"].alias("value")),
        highest,
    )
    known = df.where(at.isNotNull() & value.isNotNull())
    grouped = known.groupBy(*keys, F.date_trunc(unit, at).cast(kind).alias("bucket")).agg(points.alias("__points"))
    each = F.explode(F.array_distinct("__points")).alias("__point")
    return grouped.select(*keys, "bucket", each).select(*keys, "bucket", "__point.time", "__point.value")


def _instant(time: Column, kind: T.DataType) -> Column:
    """Microseconds that rise with the time."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time)
    return F.unix_micros(time.cast("timestamp"))
