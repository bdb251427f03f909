"""Column expressions. All of them are built-in functions, so they stay in generated code."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reading(df: DataFrame, column: str) -> Column:
    """The column with NaN as NULL: one NaN would turn a group's mean, and every test, into NaN."""
    data_type = df.schema[column].dataType.simpleString()
    if data_type not in ("float", "double"):
        return F.col(column)
    return F.nanvl(F.col(column), F.lit(None).cast(data_type))


def stable_round(value: Column, digits: int) -> Column:
    """Round half up after cutting the last-bit noise that the order of summation leaves."""
    return F.round(F.round(value, 9), digits)


def z_score(value: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the mean in standard deviations; NULL for a constant group."""
    return F.abs(F.try_divide(value - mean, stddev))


def sigma_band(mean: Column, stddev: Column, k: float) -> tuple[Column, Column]:
    reach = stddev * F.lit(k)
    return mean - reach, mean + reach


def clamp(value: Column, low: Column, high: Column, replacement: Column) -> Column:
    """Replace a value strictly outside [low, high]; NULL bounds leave it as it is."""
    return F.when((value < low) | (value > high), replacement).otherwise(value)


def utc_day(value: Column, data_type: str) -> Column:
    """Calendar day that does not depend on the session time zone (used as partition value)."""
    if data_type == "timestamp":
        return F.date_from_unix_date(F.floor(F.unix_seconds(value) / 86400).cast("int"))
    return F.to_date(value)
