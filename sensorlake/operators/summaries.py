"""Daily summaries that are put together over any range of days, without reading the rows again.

A day of a sensor and column is one row: how many readings, their mean and centred sum of squares, the
lowest and highest, a sketch of their quantiles (KLL) and one of their different values (HLL). Days are
small and are summarised anew when their readings change; whole histories are merged from them.

Merged means and deviations are those of all rows: the squares of a day are moved to the common mean by
adding, so nothing cancels; what is lost is the last bit of a day's mean. Merged quantiles lie within `RANK_ERROR` of the wanted rank, with a chance
of 99 % each; numbers of different values within about 2 %.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions import reading
from sensorlake.operators.grouping import ROWS, attach
from sensorlake.operators.quality.quantiles import QUARTILES
from sensorlake.schema import READINGS, SENSOR

K = 400  # size of a quantile sketch: about 8 KB for a long day
LG = 12  # a distinct sketch has 2 ** LG registers
RANK_ERROR = 0.01  # of sketches of size K
_CENTRE = "__centre"


def summarise(
    df: DataFrame,
    columns: Sequence[str] = READINGS,
    keys: Sequence[str] = (SENSOR,),
    *,
    date: str | None = "date",
) -> DataFrame:
    """keys, date, column, rows, n, mean, m2, low, high, quantiles, distinct: one row per day and column.

    Missing readings (NULL or NaN) count in `rows` only. One pass, whatever the number of columns; what a
    task holds of a group does not grow with its rows.
    """
    by = [*keys, *([date] if date else [])]
    cells = {}
    for column in columns:
        v = reading(df, column).cast("double")
        cells[f"__{column}"] = F.struct(
            F.lit(column).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            F.count(v).alias("n"),
            F.avg(v).alias("mean"),
            (F.var_pop(v) * F.count(v)).alias("m2"),
            F.min(v).alias("low"),
            F.max(v).alias("high"),
            F.kll_sketch_agg_double(v, K).alias("quantiles"),
            F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v)), LG).alias("distinct"),
        )
    grouped = df.groupBy(*by).agg(*[cell.alias(name) for name, cell in cells.items()])
    return grouped.select(*by, F.explode(F.array(*cells)).alias("__cell")).select(*by, "__cell.*")


def merged(days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The summaries of `days` put together per key and column: keys, column, rows, n, ..., distinct.

    `days` is read twice; hand in a stored or staged frame. What is merged may be merged again.
    """
    by = [*keys, "column"]
    centres = days.groupBy(*by).agg(
        F.count(F.lit(1)).alias(ROWS),
        (F.sum(F.col("mean") * F.col("n")) / F.sum(F.when(F.col("mean").isNotNull(), F.col("n")))).alias(_CENTRE),
    )
    away = F.col("mean") - F.col(_CENTRE)
    return (
        attach(days, centres, by)
        .groupBy(*by)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("n").alias("n"),
            F.first(_CENTRE, ignorenulls=True).alias("mean"),
            F.sum(F.col("m2") + F.col("n") * away * away).alias("m2"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("quantiles")), K).alias("quantiles"),
            F.hll_union_agg("distinct").alias("distinct"),
        )
    )


def profile_of(days: DataFrame, wanted: Mapping[str, float] = QUARTILES, keys: Sequence[str] = ()) -> DataFrame:
    """Per key and column: count, mean, stddev, min, the wanted quantiles (near their ranks), max, and
    about how many different values."""
    whole = merged(days, keys)
    some = F.col("n") > 0
    points = [
        F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(name)
        for name, p in wanted.items()
    ]
    return whole.select(
        *keys, "column", F.col("n").alias("count"), "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"),
        F.col("low").alias("min"), *points, F.col("high").alias("max"),
        F.when(some, F.hll_sketch_estimate("distinct")).otherwise(0).alias("approx_distinct"),
    )


def with_group_stats(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (SENSOR,),
    *,
    days: DataFrame,
    mark: str = "",
    **limits: int,
) -> DataFrame:
    """`quality.with_group_stats` with the statistics of all summarised days instead of those of `df`.

    A group that no day has seen has NULL statistics.
    """
    whole = merged(days.where(F.col("column").isin(list(columns))), keys)
    stddev = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))

    def of(column: str, value: Column) -> Column:
        return F.max(F.when(F.col("column") == column, value))

    stats = [
        (of(c, F.col("mean")).alias(f"{mark}{c}_mean"), of(c, stddev).alias(f"{mark}{c}_std_dev")) for c in columns
    ]
    groups = whole.groupBy(*keys).agg(F.max("rows").alias(ROWS), *reduce(lambda a, b: a + b, stats))
    return attach(df, groups, list(keys), **limits)
