"""Exact quantiles, interpolated linearly between neighbouring values.

Groups small enough for one task use Spark's `percentile`. Its buffer holds every distinct value
of the group, so for larger groups the wanted rank is narrowed down instead: each pass counts the
readings of the bracket in equal-width buckets (map-side partial counts, a few thousand rows per
task) and keeps the bucket that holds the rank, until that is a single value. Counts, and the
smallest and largest value of a bucket, are exact, and so is the result.
"""

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.functions import reading
from sensorlake.operators.grouping import ROWS, attach
from sensorlake.staging import stage

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}

EXACT_ROWS = 10_000  # readings of a group in a percentile buffer: a task may hold 128 of them
FEW_GROUPS = 8  # this many groups may be larger, up to LARGER times
LARGER = 100
BUCKETS = 4096
MOST_PASSES = 200  # each pass cuts every bracket to one bucket; doubles run out long before
_RAW = "__raw"
_LARGEST = 1.7976931348623157e308

_VALUE = "__value"


def quantiles(
    df: DataFrame,
    column: str,
    wanted: Mapping[str, float],
    keys: Sequence[str] = (),
    *,
    exact_rows: int = EXACT_ROWS,
    buckets: int = BUCKETS,
    approx: bool = False,
) -> DataFrame:
    """One row per group: keys, one column per wanted quantile, and the row count ROWS.

    `approx` takes values near the wanted ranks, in one pass and without interpolation.
    """
    keys = list(keys)
    values = df.select(
        *keys, F.col(column).alias(_RAW), reading(df, column).cast("double").alias(_VALUE)
    )
    if approx:
        return _in_one_pass(values, wanted, keys, F.percentile_approx)
    sizes = values.groupBy(*keys).agg(
        F.count("*").alias(ROWS),
        F.count(_VALUE).alias("__n"),
        F.min(_VALUE).alias("__low"),
        F.max(_VALUE).alias("__high"),
    )
    large = stage(sizes.where(F.col("__n") > exact_rows))
    found = large.agg(F.count("*").alias("groups"), F.max("__n").alias("largest")).first()
    if found["groups"] <= FEW_GROUPS and (found["largest"] or 0) <= exact_rows * LARGER:
        return _in_one_pass(values, wanted, keys, F.percentile)

    narrowed = _by_narrowing(values, large, wanted, keys, exact_rows * LARGER, buckets)
    if not keys:
        return narrowed
    values = values.drop(_RAW)
    flagged = attach(values, large.select(*keys, ROWS, F.lit(True).alias("__large")), keys)
    small = flagged.where(F.col("__large").isNull())
    return narrowed.unionByName(_in_one_pass(small, wanted, keys, F.percentile))


def quartiles(
    df: DataFrame, column: str, keys: Sequence[str] = (), **limits: int
) -> DataFrame:
    return quantiles(df, column, QUARTILES, keys, **limits)


def _in_one_pass(
    values: DataFrame,
    wanted: Mapping[str, float],
    keys: list[str],
    percentile: Callable[[str, list[float]], Column],
) -> DataFrame:
    points = percentile(_VALUE, list(wanted.values())).alias("__points")
    grouped = values.groupBy(*keys).agg(points, F.count("*").alias(ROWS))
    picked = [F.col("__points")[i].alias(name) for i, name in enumerate(wanted)]
    return grouped.select(*keys, *picked, ROWS)


def _by_narrowing(
    values: DataFrame,
    large: DataFrame,
    wanted: Mapping[str, float],
    keys: list[str],
    sorted_rows: int,
    buckets: int,
) -> DataFrame:
    """Quantiles of the groups in `large`. A bracket of at most `sorted_rows` is sorted."""
    points = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in wanted.items()]
    )
    position = F.col("p") * (F.col("__n") - 1)
    open_ranks = (
        large.withColumn("__point", F.explode(points))
        .select("*", "__point.name", "__point.p")
        .select(
            *keys,
            ROWS,
            "name",
            F.floor(position).alias("rank"),
            (position - F.floor(position)).alias("share"),
            F.col("__low").alias("low"),
            F.col("__high").alias("high"),
            F.lit(0).cast("bigint").alias("under"),
            F.col("__n").alias("inside"),
            F.lit(False).alias("stuck"),
        )
    )
    # Missing values take no part; without them, a group of hardly anything else is not a hot one.
    values = values.where(F.col(_VALUE).isNotNull())
    settled = None
    for _ in range(MOST_PASSES):
        near = _within_brackets(values, open_ranks)
        step = stage(_narrow(near, open_ranks, keys, len(wanted), sorted_rows, buckets))
        done = step.where(F.col("value").isNotNull()).select(*keys, ROWS, "name", "value")
        settled = done if settled is None else settled.unionByName(done)
        open_ranks = step.where(F.col("value").isNull()).drop("value")
        if open_ranks.isEmpty():
            break
    else:
        raise RuntimeError(f"quantile brackets did not close in {MOST_PASSES} passes")
    picked = [F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in wanted]
    return settled.groupBy(*keys, ROWS).agg(*picked).select(*keys, *wanted, ROWS)


def _within_brackets(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """Values between the lowest and the highest open bracket, compared as literals in the file scan."""
    kind = values.schema[_RAW].dataType.simpleString()
    if kind not in ("double", "float", "int", "smallint", "tinyint"):  # exact as doubles
        return values.drop(_RAW)
    low, high = ranks.agg(F.min("low"), F.max("high")).first()
    if kind in ("double", "float") or not (math.isfinite(low) and math.isfinite(high)):
        bounds = F.lit(low).cast(kind), F.lit(high).cast(kind)
    else:
        bounds = F.lit(int(low)).cast(kind), F.lit(int(high)).cast(kind)
    return values.where(F.col(_RAW).between(*bounds)).drop(_RAW)


def _finite(value: Column) -> Column:
    """Half the value, with infinities cut off, so that differences do not overflow."""
    return F.greatest(F.least(value, F.lit(_LARGEST)), F.lit(-_LARGEST)) / 2


def _log(value: Column) -> Column:
    """Signed logarithm, moved up so that the smallest magnitude is still above zero."""
    return F.signum(value) * F.coalesce(F.log(F.abs(_finite(value))) + 750, F.lit(0.0))


def _narrow(
    values: DataFrame,
    ranks: DataFrame,
    keys: list[str],
    most_brackets: int,
    sorted_rows: int,
    buckets: int,
) -> DataFrame:
    """One pass over `values`: settle each rank or shrink its bracket to one bucket.

    Buckets have equal width, on a logarithmic scale where the bracket spans orders of magnitude
    and the pass before did not halve it. Both scales keep the order of values, which is all that
    exact counts need.
    """
    low, high = F.col("low"), F.col("high")
    wide = F.col("stuck") & (_log(high) - _log(low) > 5)
    start = F.when(wide, _log(low)).otherwise(_finite(low))
    width = F.when(wide, _log(high)).otherwise(_finite(high)) - start
    bracket = F.struct(
        "low",
        "high",
        wide.alias("wide"),
        start.alias("start"),
        width.alias("width"),
        ((F.col("inside") <= sorted_rows) | (width == 0)).alias("by_value"),
    )
    brackets = ranks.groupBy(*keys, ROWS).agg(F.collect_set(bracket).alias("__brackets"))
    # The brackets of a group are one and the same, or do not overlap: a value is in one at most.
    slots = [F.get("__brackets", F.lit(i)) for i in range(most_brackets)]
    own = F.coalesce(*[F.when(F.col(_VALUE).between(s["low"], s["high"]), s) for s in slots])
    rows = attach(values, brackets, keys, how="inner").select(*keys, _VALUE, own.alias("b"))
    rows = rows.where(F.col("b").isNotNull()).select(*keys, _VALUE, "b.*")
    scaled = F.when(F.col("wide"), _log(F.col(_VALUE))).otherwise(_finite(F.col(_VALUE)))
    place = F.floor((scaled - F.col("start")) / F.col("width") * buckets).cast("double")
    bucket = F.when(F.col("by_value"), F.col(_VALUE)).otherwise(place)
    counted = (
        rows.withColumn("bucket", bucket)
        .groupBy(*keys, "low", "bucket")
        .agg(F.count("*").alias("c"), F.min(_VALUE).alias("first"), F.max(_VALUE).alias("last"))
    )
    in_order = Window.partitionBy(*keys, "low").orderBy("bucket")
    histogram = counted.select(
        *[F.col(key).alias(f"__key_{key}") for key in keys],
        F.col("low").alias("__bracket"),
        (F.sum("c").over(in_order) - F.col("c")).alias("before"),
        "c",
        "first",
        "last",
        F.lead("first").over(in_order).alias("following"),
    )
    begin = F.col("under") + F.col("before")
    hit = (F.col("low") == F.col("__bracket")) & F.col("rank").between(
        begin, begin + F.col("c") - 1
    )
    for key in keys:
        hit = hit & ranks[key].eqNullSafe(histogram[f"__key_{key}"])

    is_last = F.col("rank") == begin + F.col("c") - 1
    lower = F.when(is_last, F.col("last")).when(F.col("first") == F.col("last"), F.col("first"))
    upper = F.when(is_last, F.coalesce("following", "last")).otherwise(F.col("first"))
    value = F.when((F.col("share") == 0) | (lower == upper), lower).otherwise(
        lower * (1 - F.col("share")) + upper * F.col("share")
    )
    return ranks.join(histogram, hit).select(
        *keys,
        ROWS,
        "name",
        "rank",
        "share",
        F.col("first").alias("low"),
        F.col("last").alias("high"),
        begin.alias("under"),
        F.col("c").alias("inside"),
        (F.col("c") * 2 > F.col("inside")).alias("stuck"),
        value.alias("value"),
    )
