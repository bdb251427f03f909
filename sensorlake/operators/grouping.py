"""Group values brought back to the rows of the group, safe for hot keys and many keys."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.staging import stage

ROWS = "__rows"  # rows per group; every frame given to attach() carries it

HOT_ROWS = 5_000_000  # a key with more rows than this may be hot
HOT_KEYS = 100_000  # a hot key also has over 1 / HOT_KEYS of all rows: there are fewer of them
PROBE_BUCKETS = 1 << 20
BROADCAST_BYTES = 64 * 1024 * 1024


def _lookup(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Null-safe join of `df` with one row per key; the key columns of `df` are kept."""
    other = {key: f"__key_{key}" for key in keys}
    groups = groups.withColumnsRenamed(other)
    equal = [df[key].eqNullSafe(groups[name]) for key, name in other.items()]
    return df.join(groups, reduce(lambda a, b: a & b, equal), how).drop(*other.values())


def _hot_limit(rows: int, hot_rows: int) -> int:
    """Fewer than HOT_KEYS groups exceed it, whatever the data, which bounds their broadcast."""
    return max(hot_rows, rows // HOT_KEYS)


def hot_groups(
    df: DataFrame, keys: Sequence[str], *values: Column, hot_rows: int = HOT_ROWS
) -> DataFrame | None:
    """The hot groups with their aggregate `values`, or None.

    Rows are first counted per hash bucket of the key, a bounded number of counts per task. Only
    keys of a bucket with enough rows for a hot key are counted one by one.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(PROBE_BUCKETS)).alias("__bucket")
    counted = stage(df.groupBy(bucket).agg(F.count("*").alias(ROWS)))
    rows = counted.agg(F.sum(ROWS)).first()[0] or 0
    limit = _hot_limit(rows, hot_rows)
    if rows <= limit:
        return None
    crowded = stage(counted.where(F.col(ROWS) > limit).select("__bucket"))
    if crowded.isEmpty():
        return None
    candidates = df.withColumn("__bucket", bucket).join(
        F.broadcast(crowded), "__bucket", "left_semi"
    )
    exact = candidates.groupBy(*keys).agg(F.count("*").alias(ROWS), *values)
    hot = stage(exact.where(F.col(ROWS) > limit).drop(ROWS))
    return None if hot.isEmpty() else hot


def split_hot(
    df: DataFrame, hot: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows of hot groups, joined map-side with the values of `hot`, and the remaining rows."""
    hot_part = _lookup(df, F.broadcast(hot), keys, "inner")
    cold_part = _lookup(df, F.broadcast(hot.select(*keys)), keys, "left_anti")
    return hot_part, cold_part


def _width(kind: T.DataType) -> int:
    """Bytes of a value in a row, its null bit and offset included; lists are measured by length."""
    if isinstance(kind, T.StructType):
        return 24 + sum(_width(f.dataType) for f in kind.fields)
    return 24 if isinstance(kind, T.ArrayType) else 16


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(16)
    for field in df.schema.fields:
        total = total + F.lit(_width(field.dataType))
        if isinstance(field.dataType, T.ArrayType):
            items = F.greatest(F.size(field.name), F.lit(0))
            total = total + items * F.lit(_width(field.dataType.elementType))
    return total


def attach(
    df: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    *,
    aggregates: Sequence[Column] | None = None,
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    how: str = "left",
) -> DataFrame:
    """Add the columns of `groups` (one row per key, with ROWS) to every row of `df`.

    With `how="inner"` rows whose key is not among the groups are left out.

    The groups are written once and their size is checked. When they fit, `df` is joined map-side
    and is not shuffled at all. Beyond that, hot keys are joined map-side, and only the rows of
    the others are shuffled by key, so that no task gets a hot key. `aggregates` are the
    expressions behind `groups`, in its order of columns, when these are aggregates of `df`
    itself: a window over the shuffled rows then saves shuffling the groups as well.
    """
    values = [name for name in groups.columns if name not in keys and name != ROWS]
    if not keys:
        groups = stage(groups)
        if how == "inner" and groups.isEmpty():
            return df.where(F.lit(False)).withColumns(
                {name: F.lit(None).cast(groups.schema[name].dataType) for name in values}
            )
        return df.withColumns({name: groups.select(name).scalar() for name in values})

    text_bytes = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) for key in keys],
    )
    # Measured while it is written. Rows that a lost task counts twice make it look larger, no worse.
    measured = Observation()
    sizes = F.sum(text_bytes + _row_bytes(groups)).alias("row_bytes"), F.sum(ROWS).alias("rows")
    groups = stage(groups.observe(measured, *sizes))
    size = measured.get
    if (size["row_bytes"] or 0) <= broadcast_bytes:
        return _lookup(df, F.broadcast(groups.drop(ROWS)), keys, how)

    def shuffled(rows: DataFrame) -> DataFrame:
        if aggregates is None:
            return _lookup(rows, groups.drop(ROWS), keys, how)
        group = Window.partitionBy(*keys)
        return rows.withColumns({n: a.over(group) for n, a in zip(values, aggregates)})

    hot = groups.where(F.col(ROWS) > _hot_limit(size["rows"], hot_rows)).drop(ROWS)
    if hot.isEmpty():
        return shuffled(df)
    hot_part, cold_part = split_hot(df, hot, keys)
    return hot_part.unionByName(shuffled(cold_part))
