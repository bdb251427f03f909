import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from sensorlake.operators import grouping, quality

POWER = "turbine_id int, power_output double"
ARRIVALS = "turbine_id int, timestamp timestamp, date_created timestamp"
READINGS = "turbine_id int, timestamp timestamp, power_output double, date_created timestamp"


def at(day, hour=0):
    return datetime(2024, 3, day, hour)


def test_dedup_keeps_the_latest_arrival(spark):
    df = spark.createDataFrame(
        [(1, at(7, 1), at(8)), (1, at(7, 2), at(8)), (1, at(7, 2), at(9)), (2, at(7, 2), at(8))],
        ARRIVALS,
    )
    expected = spark.createDataFrame(
        [(1, at(7, 1), at(8)), (1, at(7, 2), at(9)), (2, at(7, 2), at(8))], ARRIVALS
    )
    assertDataFrameEqual(quality.dedup_latest(df), expected)
    assertDataFrameEqual(quality.dedup_latest(df, keep_ties=False), expected)
    assertDataFrameEqual(quality.dedup_latest(expected), expected)


def test_dedup_ties_null_keys_and_null_arrivals(spark):
    rows = [
        (1, at(7), 1.0, at(8)),
        (1, at(7), 2.0, at(8)),  # ties with the row above
        (None, at(7), 3.0, at(8)),
        (None, at(7), 4.0, at(9)),  # NULL keys form one group
        (2, at(7), 5.0, None),
        (2, at(7), 6.0, at(1)),  # any arrival is later than none
        (3, at(7), 7.0, None),
    ]
    df = spark.createDataFrame(rows, READINGS)
    kept = {r.power_output for r in quality.dedup_latest(df).collect()}
    assert kept == {1.0, 2.0, 4.0, 6.0, 7.0}
    one = {r.power_output for r in quality.dedup_latest(df, keep_ties=False).collect()}
    assert one == {2.0, 4.0, 6.0, 7.0}


def skewed(spark, rows=4000):
    """A third of the rows has one key, and all of those one arrival; some keys are NULL."""
    n = F.col("id")
    return spark.range(rows).select(
        F.when(n % 3 == 0, 1).when(n % 50 == 1, None).otherwise(n % 97).cast("int").alias("k"),
        F.when(n % 3 == 0, 9).otherwise(n % 7).cast("int").alias("arrived"),
        F.when(n % 11 != 0, F.sin(n)).alias("x"),
        n.alias("row"),
    )


def test_dedup_with_hot_keys_gives_the_same_rows(spark):
    df = skewed(spark)
    plain = quality.dedup_latest(df, keys=["k"], arrival="arrived")
    split = quality.dedup_latest(df, keys=["k"], arrival="arrived", hot_rows=100)
    assert "BroadcastHashJoin" in split._jdf.queryExecution().toString()
    assert plain.count() > 1300
    assertDataFrameEqual(split, plain)


@pytest.mark.parametrize(
    "limits", [{"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 100}, {}]
)
def test_group_stats_by_every_join_strategy(spark, limits):
    df = skewed(spark)
    got = quality.with_group_stats(df, ["x"], ["k"], **limits).toPandas().set_index("row")
    frame = df.toPandas()
    frame["k"] = frame["k"].fillna(-1)
    grouped = frame.groupby("k")["x"]
    frame["mean"], frame["std"] = grouped.transform("mean"), grouped.transform("std")
    frame = frame.set_index("row").loc[got.index]
    assert len(got) == 4000
    np.testing.assert_allclose(got["x_mean"], frame["mean"], rtol=1e-9)
    np.testing.assert_allclose(got["x_std_dev"], frame["std"], rtol=1e-9)


def test_group_stats_values(spark):
    df = spark.createDataFrame([(1, 4.0), (1, 4.5), (2, 0.0), (2, 6.0)], POWER)
    expected = spark.createDataFrame(
        [
            (1, 4.0, 4.25, math.sqrt(0.125)),
            (1, 4.5, 4.25, math.sqrt(0.125)),
            (2, 0.0, 3.0, math.sqrt(18)),
            (2, 6.0, 3.0, math.sqrt(18)),
        ],
        POWER + ", power_output_mean double, power_output_std_dev double",
    )
    assertDataFrameEqual(quality.with_group_stats(df, ["power_output"]), expected)


def test_group_stats_over_the_whole_table(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], POWER)
    rows = quality.with_group_stats(df, ["power_output"], []).collect()
    assert [r.power_output_mean for r in rows] == [2.0, 2.0]


def test_impute_mean(spark):
    schema = "power_output double, power_output_mean double"
    df = spark.createDataFrame([(1.0, 2.5), (5.0, 2.5), (None, 2.5), (None, None)], schema)
    expected = spark.createDataFrame([(1.0, 2.5), (5.0, 2.5), (2.5, 2.5), (None, None)], schema)
    assertDataFrameEqual(quality.impute_mean(df, "power_output"), expected)


def test_sigma_band(spark):
    schema = "power_output double, power_output_mean double, power_output_std_dev double"
    df = spark.createDataFrame([(7.5, 7.0, 0.25), (1.0, 4.0, 2.0), (6.0, 6.0, 0.0)], schema)
    expected = spark.createDataFrame(
        [(7.5, 7.0, 0.25, 6.5, 7.5), (1.0, 4.0, 2.0, 0.0, 8.0), (6.0, 6.0, 0.0, 6.0, 6.0)],
        schema + ", power_output_2_stddev_lower double, power_output_2_stddev_upper double",
    )
    assertDataFrameEqual(quality.with_sigma_band(df, ["power_output"]), expected)


def test_replace_outliers_is_strict(spark):
    schema = (
        "power_output double, power_output_mean double,"
        " power_output_2_stddev_lower double, power_output_2_stddev_upper double"
    )
    rows = [
        (3.5, 2.0, 0.0, 3.0),  # above
        (-0.1, 2.0, 0.0, 3.0),  # below
        (3.0, 2.0, 0.0, 3.0),  # on the bound
        (2.8, 2.0, 0.0, 3.0),
        (2.5, 2.5, 2.5, 2.5),
        (2.5, None, None, None),  # no band
        (None, 2.0, 0.0, 3.0),
    ]
    got = quality.replace_outliers(spark.createDataFrame(rows, schema), "power_output")
    values = [r.power_output for r in got.collect()]
    assert values == [2.0, 2.0, 3.0, 2.8, 2.5, 2.5, None]


def test_drop_helpers_drops_nothing_else(spark):
    df = spark.createDataFrame([(1, 2.0)], POWER)
    other = df.withColumn("power_output_daily_mean", F.lit(1.0))
    helped = quality.with_sigma_band(
        quality.with_group_stats(other, ["power_output"]), ["power_output"]
    )
    assert len(helped.columns) == 7
    assert quality.drop_helpers(helped, ["power_output"]).columns == other.columns
    assert quality.drop_helpers(df, ["power_output"]).columns == df.columns


def test_repair_uses_statistics_of_the_readings_as_they_came(spark):
    values = [10.0] * 9 + [11.0] * 9 + [60.0, None]
    df = spark.createDataFrame([(1, v) for v in values], POWER)
    known = pd.Series(values).dropna()
    mean, std = known.mean(), known.std()
    assert 60 > mean + 2 * std
    got = sorted(r.power_output for r in quality.repair(df).collect())
    np.testing.assert_allclose(got, [10.0] * 9 + [11.0] * 9 + [mean, mean])


def test_repair_edge_groups(spark):
    nan = float("nan")
    rows = [
        (1, None), (1, None),  # no reading at all
        (2, 4.0),  # one reading: no deviation
        (3, 5.0), (3, nan), (3, 7.0),  # NaN counts as missing
        (None, 1.0), (None, 3.0), (None, None),  # NULL key is a group
    ]
    got = quality.repair(spark.createDataFrame(rows, POWER)).collect()
    by_key = {}
    for row in got:
        by_key.setdefault(row.turbine_id, []).append(row.power_output)
    assert by_key[1] == [None, None]
    assert by_key[2] == [4.0]
    assert sorted(by_key[3]) == [5.0, 6.0, 7.0]
    assert sorted(by_key[None]) == [1.0, 2.0, 3.0]
    assert [f.name for f in quality.repair(spark.createDataFrame(rows, POWER)).schema] == [
        "turbine_id",
        "power_output",
    ]


def test_repair_leaves_a_users_mean_column_alone(spark):
    df = spark.createDataFrame([(1, 1.0, 7.0), (1, None, 8.0)], POWER + ", power_output_mean double")
    assert sorted((r[1], r[2]) for r in quality.repair(df).collect()) == [(1.0, 7.0), (1.0, 8.0)]


def test_clean_dedups_before_it_measures(spark):
    df = spark.createDataFrame(
        [(1, at(7, 1), 100.0, at(8)), (1, at(7, 1), 2.0, at(9)), (1, at(7, 2), None, at(9))],
        READINGS,
    )
    assert [r.power_output for r in quality.clean(df).collect()] == [2.0, 2.0]


def test_more_hot_keys_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(grouping, "HOT_KEYS", 4)
    df = skewed(spark)
    plain = quality.dedup_latest(df, keys=["k"], arrival="arrived")
    split = quality.dedup_latest(df, keys=["k"], arrival="arrived", hot_rows=10)
    assertDataFrameEqual(split, plain)
    stats = quality.with_group_stats(df, ["x"], ["k"])
    split = quality.with_group_stats(df, ["x"], ["k"], broadcast_bytes=0, hot_rows=10)
    assertDataFrameEqual(split, stats)
