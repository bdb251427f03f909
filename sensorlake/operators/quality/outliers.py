"""Outlier tests: z-score, sigma band, inter-quartile range, box-plot statistics."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions import reading
from sensorlake.operators.grouping import ROWS, attach
from sensorlake.operators.quality.cleaning import (
    drop_helpers,
    sigma_bounds,
    with_group_stats,
    with_sigma_band,
    with_z_score,
)
from sensorlake.operators.quality.quantiles import QUARTILES, quartiles
from sensorlake.schema import READINGS, SENSOR


def z_outliers(
    df: DataFrame,
    columns: Sequence[str] = READINGS,
    keys: Sequence[str] = (SENSOR,),
    *,
    threshold: float = 3,
) -> DataFrame:
    """Rows with a z-score above the threshold in any of the columns; the scores stay."""
    scored = with_z_score(with_group_stats(df, columns, keys, mark="__"), columns, mark="__")
    beyond = F.greatest(*[F.col(f"{c}_z_score") for c in columns], F.lit(0.0)) > threshold
    return drop_helpers(scored.where(beyond), columns, mark="__")


def sigma_outliers(
    df: DataFrame,
    column: str = "power_output",
    keys: Sequence[str] = (SENSOR,),
    *,
    k: float = 2,
) -> DataFrame:
    """Rows with a reading strictly outside `mean ± k·stddev` of its group."""
    stats = with_group_stats(df, [column], keys, mark="__")
    banded = with_sigma_band(stats, [column], k=k, mark="__")
    low, high = sigma_bounds(column, k, "__")
    value = reading(df, column)
    outside = banded.where((value < F.col(low)) | (value > F.col(high)))
    return drop_helpers(outside, [column], k=k, mark="__")


def _with_fences(
    df: DataFrame, column: str, keys: Sequence[str], reach: float, **limits: int
) -> DataFrame:
    """Quartiles and fences on every row: `__q1`, `__median`, `__q3`, `__low`, `__high`."""
    box = quartiles(df, column, keys, **limits)
    spread = (F.col("q3") - F.col("q1")) * F.lit(reach)
    none = F.lit(None).cast("double")  # infinite quartiles have no fences
    fences = box.select(
        *keys,
        ROWS,
        *[F.col(name).alias(f"__{name}") for name in QUARTILES],
        F.nanvl(F.col("q1") - spread, none).alias("__low"),
        F.nanvl(F.col("q3") + spread, none).alias("__high"),
    )
    if keys:
        return attach(df, fences, keys)
    # One row for the whole table: as literals, the fences can be compared in the file scan.
    row = fences.drop(ROWS).first()
    return df.withColumns({name: F.lit(row[name]).cast("double") for name in row.asDict()})


def _beyond(df: DataFrame, column: str) -> Column:
    """Outside the fences. Spelled with bare comparisons so that it can be pushed down."""
    above = F.col(column) > F.col("__high")
    if df.schema[column].dataType.simpleString() in ("float", "double"):
        above = above & (F.col(column) <= F.lit(float("inf")))  # NaN, a missing reading, is not
    return (F.col(column) < F.col("__low")) | above


def iqr_outliers(
    df: DataFrame,
    column: str = "wind_direction",
    keys: Sequence[str] = (),
    *,
    reach: float = 1.5,
    **limits: int,
) -> DataFrame:
    """Rows beyond `reach` inter-quartile ranges of the quartiles, over all rows by default."""
    fenced = _with_fences(df, column, keys, reach, **limits)
    return fenced.where(_beyond(df, column)).select(*df.columns)


def iqr_summary(
    df: DataFrame,
    column: str = "wind_direction",
    keys: Sequence[str] = (),
    *,
    reach: float = 1.5,
    **limits: int,
) -> DataFrame:
    """Number, largest and smallest of the outliers."""
    outside = iqr_outliers(df, column, keys, reach=reach, **limits)
    return outside.groupBy(*keys).agg(
        F.count(column).alias("outliers"),
        F.max(column).alias("max_outlier"),
        F.min(column).alias("min_outlier"),
    )


def box_stats(
    df: DataFrame,
    column: str,
    keys: Sequence[str] = (),
    *,
    reach: float = 1.5,
    **limits: int,
) -> DataFrame:
    """Quartiles, whisker ends and number of fliers.

    A whisker ends at the outermost reading within the fences, or at the quartile where that
    reading lies inside the box or none is within the fences.
    """
    fenced = _with_fences(df, column, keys, reach, **limits)
    value = reading(df, column)
    above_low, below_high = value >= F.col("__low"), value <= F.col("__high")
    box = [F.col(f"__{name}").alias(name) for name in QUARTILES]
    return fenced.groupBy(*keys, *box).agg(
        F.least(F.min(F.when(above_low, value)), F.col("__q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(below_high, value)), F.col("__q3")).alias("whisker_high"),
        F.count_if(_beyond(df, column)).alias("fliers"),
    )


def with_test_points(df: DataFrame, column: str, points: Sequence[float]) -> DataFrame:
    """The readings of one column with extra readings appended, to try out an outlier test."""
    extra = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(float(point)) for point in points])).alias(column)
    )
    return df.select(F.col(column).cast("double").alias(column)).unionByName(extra)
