"""Directions in degrees: 350 and 10 are 20 apart, and their mean is 0."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions import reading
from sensorlake.operators.grouping import ROWS, attach
from sensorlake.schema import SENSOR

_MEAN, _SPREAD = "__direction_mean", "__direction_spread"
NO_DIRECTION = 1e-9  # a shorter mean vector points nowhere


def angular_distance(a: Column, b: Column) -> Column:
    """The smaller angle between two directions, 0 to 180."""
    return F.abs(F.pmod(a - b + F.lit(180.0), F.lit(360.0)) - F.lit(180.0))


def _sums(df: DataFrame, column: str) -> tuple[Column, Column, Column]:
    angle = F.radians(reading(df, column).cast("double"))
    n = F.count(angle)
    return n, F.sum(F.sin(angle)) / n, F.sum(F.cos(angle)) / n


def _length(sine: Column, cosine: Column) -> Column:
    """Of the mean vector; the sums' last bits may lift it beyond 1. NULL without readings."""
    length = F.hypot(sine, cosine)
    return F.when(length > 1, 1.0).otherwise(length)


def circular_stats(df: DataFrame, column: str = "wind_direction", keys: Sequence[str] = (SENSOR,)) -> DataFrame:
    """Per group: n, direction (0 to below 360), strength (1: all the same, 0: no common direction), and
    deviation in degrees.

    One aggregate of sines and cosines. Missing readings are left out. A group without readings, or
    whose readings cancel out, has no direction; without any, no strength and deviation either.
    """
    n, sine, cosine = _sums(df, column)
    held = df.groupBy(*keys).agg(n.alias("n"), sine.alias("__s"), cosine.alias("__c"), F.count(F.lit(1)).alias(ROWS))
    length = _length(F.col("__s"), F.col("__c"))
    heading = F.pmod(F.round(F.degrees(F.atan2("__s", "__c")), 9), F.lit(360.0))
    return held.select(
        *keys,
        "n",
        F.when(length >= NO_DIRECTION, heading).alias("direction"),
        length.alias("strength"),
        F.when(length >= NO_DIRECTION, F.degrees(F.sqrt(-2 * F.log(length)))).alias("deviation"),
        ROWS,
    ).drop(ROWS)


def direction_outliers(
    df: DataFrame, column: str = "wind_direction", keys: Sequence[str] = (SENSOR,), *, k: float = 2, **limits: int
) -> DataFrame:
    """Rows whose direction is more than `k` deviations of their group away from its mean direction.

    Like the other outlier tests, `df` is read twice: hand in a stored or staged frame.
    """
    distance = angular_distance(reading(df, column).cast("double"), F.col(_MEAN))
    return _with_stats(df, column, keys, **limits).where(distance > k * F.col(_SPREAD)).drop(_MEAN, _SPREAD)


def _with_stats(df: DataFrame, column: str, keys: Sequence[str], **limits: int) -> DataFrame:
    _, sine, cosine = _sums(df, column)
    length = _length(sine, cosine)
    points = length >= NO_DIRECTION
    values = {
        _MEAN: F.when(points, F.pmod(F.round(F.degrees(F.atan2(sine, cosine)), 9), F.lit(360.0))),
        _SPREAD: F.when(points, F.degrees(F.sqrt(-2 * F.log(length)))),
    }
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *[v.alias(name) for name, v in values.items()])
    return attach(df, groups, list(keys), **limits)


def repair_direction(
    df: DataFrame, column: str = "wind_direction", keys: Sequence[str] = (SENSOR,), *, k: float = 2, **limits: int
) -> DataFrame:
    """Missing directions, and those more than `k` deviations away, become the mean direction of their group.

    Integer columns stay integer (359.6 becomes 0). Where a group has no direction, its rows stay as they
    are. `df` is read twice: hand in a stored or staged frame.
    """
    kind = df.schema[column].dataType
    found = _with_stats(df, column, keys, **limits)
    value, mean = reading(df, column), F.col(_MEAN)
    if isinstance(kind, T.IntegralType):
        mean = F.pmod(F.round(mean), F.lit(360.0))
    far = angular_distance(value.cast("double"), F.col(_MEAN)) > k * F.col(_SPREAD)
    put = F.when((value.isNull() | far) & mean.isNotNull(), mean.cast(kind)).otherwise(F.col(column))
    return found.withColumn(column, put).drop(_MEAN, _SPREAD)
