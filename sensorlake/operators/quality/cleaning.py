"""Keep-latest deduplication, group statistics, imputation and outlier replacement.

Helper columns of a column `c`: `c_mean`, `c_std_dev`, `c_<k>_stddev_lower`, `c_<k>_stddev_upper`
(k = 1.5 is written 1_5) and `c_z_score`. `mark` is put in front of the name, for frames that use
such a name themselves.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions import clamp, reading, sigma_band, stable_round, z_score
from sensorlake.operators.grouping import HOT_ROWS, ROWS, attach, hot_groups, split_hot
from sensorlake.schema import ARRIVAL, READING_KEYS, READINGS, SENSOR
from sensorlake.staging import stage

_POSITION = "__position"
_LATEST = "__latest"


def _mean(column: str, mark: str = "") -> str:
    return f"{mark}{column}_mean"


def _std_dev(column: str, mark: str = "") -> str:
    return f"{mark}{column}_std_dev"


def sigma_bounds(column: str, k: float, mark: str = "") -> tuple[str, str]:
    """Names of the lower and the upper bound."""
    width = f"{k:g}".replace(".", "_")
    return f"{mark}{column}_{width}_stddev_lower", f"{mark}{column}_{width}_stddev_upper"


def dedup_latest(
    df: DataFrame,
    *,
    keys: Sequence[str] = READING_KEYS,
    arrival: str = ARRIVAL,
    keep_ties: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per key, the row of the latest arrival.

    With `keep_ties` all rows of the latest arrival stay. Otherwise one row per key stays: ties
    are settled by the remaining columns, so the choice does not depend on the layout of the data.

    Both forms rank, so losing rows are dropped before the shuffle. Tied rows of one key are not
    losing rows, and a hot key could be made of them; such keys are compared with their latest
    arrival in place instead of being ranked in one task.
    """
    newest_first = [F.col(arrival).desc_nulls_last()]
    if not keep_ties:
        rest = [name for name in df.columns if name not in keys and name != arrival]
        # A missing reading (NULL or NaN) never wins; NaN alone would sort above all numbers.
        newest_first += [reading(df, name).desc_nulls_last() for name in rest]
        newest_first += [F.col(name).desc_nulls_last() for name in rest]
        one = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
        return df.withColumn(_POSITION, one).where(F.col(_POSITION) == 1).drop(_POSITION)

    def ranked(rows: DataFrame) -> DataFrame:
        position = F.rank().over(Window.partitionBy(*keys).orderBy(*newest_first))
        return rows.withColumn(_POSITION, position).where(F.col(_POSITION) == 1).drop(_POSITION)

    hot = hot_groups(df, keys, F.max(arrival).alias(_LATEST), hot_rows=hot_rows)
    if hot is None:
        return ranked(df)
    hot_part, cold_part = split_hot(df, hot, keys)
    hot_latest = hot_part.where(F.col(arrival).eqNullSafe(F.col(_LATEST))).drop(_LATEST)
    return ranked(cold_part).unionByName(hot_latest)


def with_group_stats(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (SENSOR,),
    *,
    mark: str = "",
    **limits: int,
) -> DataFrame:
    """Mean and sample standard deviation of each column over the row's group.

    One aggregate pass and a join back, instead of a window that would shuffle all rows to one
    task per group. `limits` are passed to `attach`.
    """
    stats = {}
    for column in columns:
        stats[_mean(column, mark)] = F.avg(reading(df, column))
        stats[_std_dev(column, mark)] = F.stddev_samp(reading(df, column))
    named = [value.alias(name) for name, value in stats.items()]
    groups = df.groupBy(*keys).agg(F.count("*").alias(ROWS), *named)
    return attach(df, groups, keys, aggregates=list(stats.values()), **limits)


def impute_mean(df: DataFrame, column: str, *, mark: str = "") -> DataFrame:
    """Fill missing readings (NULL or NaN) with the group mean."""
    return df.withColumn(column, F.coalesce(reading(df, column), F.col(_mean(column, mark))))


def with_sigma_band(
    df: DataFrame, columns: Sequence[str], *, k: float = 2, mark: str = ""
) -> DataFrame:
    """Lower and upper bound of `mean ± k·stddev` for each column."""
    bands = {}
    for column in columns:
        mean, std_dev = F.col(_mean(column, mark)), F.col(_std_dev(column, mark))
        bands |= zip(sigma_bounds(column, k, mark), sigma_band(mean, std_dev, k))
    return df.withColumns(bands)


def replace_outliers(
    df: DataFrame, column: str, *, k: float = 2, mark: str = ""
) -> DataFrame:
    """Put the group mean in place of readings strictly outside the band."""
    low, high = sigma_bounds(column, k, mark)
    fixed = clamp(F.col(column), F.col(low), F.col(high), F.col(_mean(column, mark)))
    return df.withColumn(column, fixed)


def drop_helpers(
    df: DataFrame, columns: Sequence[str] = READINGS, *, k: float = 2, mark: str = ""
) -> DataFrame:
    """Drop the helper columns of the named columns, and nothing else."""
    helpers = []
    for column in columns:
        helpers += [_mean(column, mark), _std_dev(column, mark), *sigma_bounds(column, k, mark)]
    return df.drop(*helpers)


def with_z_score(df: DataFrame, columns: Sequence[str], *, mark: str = "") -> DataFrame:
    """Absolute z-score of each column, from its group statistics."""
    return df.withColumns(
        {
            f"{column}_z_score": z_score(
                reading(df, column), F.col(_mean(column, mark)), F.col(_std_dev(column, mark))
            )
            for column in columns
        }
    )


def repair(
    df: DataFrame,
    columns: Sequence[str] = ("power_output",),
    *,
    keys: Sequence[str] = (SENSOR,),
    k: float = 2,
    with_stats: Callable[..., DataFrame] = with_group_stats,
    **limits: int,
) -> DataFrame:
    """Impute, then replace outliers, with statistics of the readings as they came in.

    Integer columns stay integer: what is put in is rounded half up. `df` is read twice
    (statistics, then rows), so hand in a stored or staged frame. `with_stats` attaches other
    statistics, as `summaries.with_group_stats` does with those of a whole history.
    """
    mark = "__"
    readings = df.withColumns({column: reading(df, column) for column in columns})
    out = with_stats(readings, columns, keys, mark=mark, **limits)
    for column in columns:
        out = impute_mean(out, column, mark=mark)
    out = with_sigma_band(out, columns, k=k, mark=mark)
    for column in columns:
        out = replace_outliers(out, column, k=k, mark=mark)
    whole = {
        column: stable_round(F.col(column), 0).cast(df.schema[column].dataType)
        for column in columns
        if isinstance(df.schema[column].dataType, T.IntegralType)
    }
    return drop_helpers(out.withColumns(whole), columns, k=k, mark=mark)


def clean(
    df: DataFrame,
    columns: Sequence[str] = ("power_output",),
    *,
    keys: Sequence[str] = READING_KEYS,
    stats_keys: Sequence[str] = (SENSOR,),
    arrival: str = ARRIVAL,
    k: float = 2,
    keep_ties: bool = True,
) -> DataFrame:
    """Keep the latest readings and repair them. The deduplicated rows are staged once."""
    latest = dedup_latest(df, keys=keys, arrival=arrival, keep_ties=keep_ties)
    return repair(stage(latest), columns, keys=stats_keys, k=k)
