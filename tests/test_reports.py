from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from sensorlake.operators import incremental, ingest, metrics, quality

SCHEMA = (
    "timestamp timestamp, turbine_id int, wind_speed double, wind_direction int,"
    " power_output double, date_created timestamp"
)


def reading(hour, turbine, speed, direction, power, day=1):
    return (datetime(2022, 3, day, hour), turbine, speed, direction, power, datetime(2022, 3, 5))


@pytest.fixture(scope="module")
def readings(spark):
    rows = [reading(h, t, float(h), h * 10, float(h * t)) for h in range(24) for t in (1, 2)]
    rows += [reading(3, 1, 3.0, 30, None), reading(4, 1, 4.0, None, None), reading(4, 2, 4.0, 1, 9.0)]
    rows += [reading(5, 3, 5.0, 50, 5.0, day=2)]
    return spark.createDataFrame(rows, SCHEMA)


def test_daily_metrics_values(spark):
    rows = [(date(2024, 1, 1), 1, v) for v in (1.0, 2.5, 0.5)]
    rows += [(date(2024, 1, 1), 2, v) for v in (6.0, 7.0, 8.0)]
    rows += [(date(2024, 1, 2), 1, v) for v in (0.0, 0.25, 0.25)]
    rows += [(date(2024, 1, 2), 2, v) for v in (9.5, 9.0, 9.25)]
    rows += [(date(2024, 1, 3), 3, None)]
    df = spark.createDataFrame(rows, "date date, turbine_id int, power_output double")
    expected = [
        (1, date(2024, 1, 1), 0.5, 2.5, 1.33),
        (2, date(2024, 1, 1), 6.0, 8.0, 7.0),
        (1, date(2024, 1, 2), 0.0, 0.25, 0.17),
        (2, date(2024, 1, 2), 9.0, 9.5, 9.25),
        (3, date(2024, 1, 3), None, None, None),
    ]
    got = {tuple(r) for r in metrics.daily_metrics(df).collect()}
    assert got == set(expected)


def test_mean_is_rounded_half_up(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.01)], "turbine_id int, power_output double")
    df = df.withColumn("date", F.lit("2024-01-01").cast("date"))
    assert metrics.daily_metrics(df).first().power_output_daily_mean == 1.01


def test_with_date(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, h), 2.3) for h in (0, 1, 23)],
                               "timestamp timestamp, power_output double")
    assert {r.date for r in metrics.with_date(df).collect()} == {date(2024, 1, 1)}


def test_stamp_arrival(spark):
    df = spark.range(3)
    stamp = datetime(2024, 12, 5, 1, 30)
    assert {r.date_created for r in ingest.stamp_arrival(df, arrival=stamp).collect()} == {stamp}
    now = ingest.stamp_arrival(df.repartition(3))
    assert now.select("date_created").distinct().count() == 1
    assert now.schema["date_created"].dataType.typeName() == "timestamp"


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_newer_than_target(spark, kind):
    stamps = ["2024-03-01 01:00:00", "2024-03-01 02:00:00", None]
    df = spark.createDataFrame([(s,) for s in stamps], "date_created string")
    df = df.select(F.col("date_created").cast(kind))

    def held(stamp):
        return df.sparkSession.createDataFrame([(stamp,)], "s string").select(
            F.col("s").cast(kind).alias("date_created")
        )

    def number(target):
        return incremental.newer_than_target(df, target).count()

    assert number(df.where("false")) == 2
    assert number(held(None)) == 2
    assert number(held("1970-01-01 02:00:00")) == 2
    assert number(held("2024-03-01 01:00:00")) == 1  # strictly later only
    assert number(held("2024-03-01 02:00:00")) == 0
    empty = incremental.high_watermark(df.where("false")).first()[0]
    assert empty == datetime(1970, 1, 1)


def test_z_scores(spark, readings):
    columns = ["wind_speed", "power_output"]
    got = quality.with_z_score(quality.with_group_stats(readings, columns), columns).toPandas()
    for column in columns:
        group = got.groupby("turbine_id")[column]
        expected = ((got[column] - group.transform("mean")) / group.transform("std")).abs()
        np.testing.assert_allclose(got[f"{column}_z_score"], expected, rtol=1e-9)


def test_z_score_of_a_constant_group_is_null(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0)], "turbine_id int, x double")
    scored = quality.with_z_score(quality.with_group_stats(df, ["x"]), ["x"])
    assert [r.x_z_score for r in scored.collect()] == [None, None]
    assert quality.z_outliers(df, ["x"]).count() == 0


def test_z_and_sigma_outliers(spark):
    values = [10.0] * 20 + [11.0] * 20 + [90.0]
    df = spark.createDataFrame([(1, v, None) for v in values], "turbine_id int, x double, y double")
    assert [r.x for r in quality.z_outliers(df, ["x", "y"]).collect()] == [90.0]
    outside = quality.sigma_outliers(df, "x")
    assert [r.x for r in outside.collect()] == [90.0]
    assert outside.columns == df.columns


def test_day_statistics(spark, readings):
    dated = metrics.with_date(readings, name="day")
    got = quality.with_group_stats(dated, ["wind_speed"], ["day"]).toPandas()
    expected = got.groupby("day")["wind_speed"].transform("mean")
    np.testing.assert_allclose(got["wind_speed_mean"], expected)


def test_counts_and_completeness(spark, readings):
    counts = {(r.day, r.turbine_id): r for r in quality.daily_counts(readings).collect()}
    first = counts[(date(2022, 3, 1), 1)]
    assert (first.timestamp_count, first.power_output_count, first.wind_direction_count) == (26, 24, 25)
    over = quality.completeness(readings, over=24).collect()
    assert [(r.turbine_id, r.power_output_count) for r in over] == [(2, 25)]
    under = quality.completeness(readings, under=24).collect()
    assert [(r.turbine_id, r.power_output_count) for r in under] == [(3, 1)]
    both = quality.completeness(readings, over=24, under=24)
    assert both.count() == 2
    ordered = [(r.day, r.turbine_id) for r in quality.daily_counts(readings, sort=True).collect()]
    assert ordered == sorted(ordered)


def test_last_seen_null_counts_and_series(spark, readings):
    seen = {r.turbine_id: r.last_seen for r in quality.last_seen(readings).collect()}
    assert seen[3] == datetime(2022, 3, 2, 5)
    nulls = quality.null_counts(readings, ["wind_direction", "power_output"]).first()
    assert tuple(nulls) == (1, 2)
    buckets = {r.timestamp: r for r in quality.series(readings, "power_output", unit="day").collect()}
    day = buckets[datetime(2022, 3, 1)]
    assert (day["count"], day["min"], day["max"]) == (49, 0.0, 46.0)
    assert quality.series(readings, "wind_speed").count() == 25


def test_profile_matches_pandas(spark, readings):
    frame = readings.toPandas()
    got = {r["column"]: r for r in quality.profile(readings).collect()}
    assert set(got) == {"turbine_id", "wind_speed", "wind_direction", "power_output"}
    for column, row in got.items():
        known = frame[column].dropna().astype(float)
        assert row["count"] == len(known)
        expected = [known.mean(), known.std(), known.min(), *known.quantile([0.25, 0.5, 0.75]), known.max()]
        shown = [row[n] for n in ("mean", "stddev", "min", "q1", "median", "q3", "max")]
        np.testing.assert_allclose(shown, expected, rtol=1e-12)
    mean = quality.overall_mean(readings, "wind_speed").first()[0]
    assert mean == pytest.approx(frame["wind_speed"].mean())


NAN = float("nan")


def test_nan_is_a_missing_reading_everywhere(spark):
    df = spark.createDataFrame(
        [(1, 4.0, datetime(2024, 1, 1, 1)), (1, NAN, datetime(2024, 1, 1, 2)), (1, None, datetime(2024, 1, 1, 3))],
        "turbine_id int, power_output double, timestamp timestamp",
    )
    daily = metrics.daily_metrics(metrics.with_date(df)).first()
    assert tuple(daily)[2:] == (4.0, 4.0, 4.0)
    assert quality.daily_counts(df, ["power_output"]).first()["power_output_count"] == 1
    assert tuple(quality.null_counts(df, ["power_output"], nans=True).first()) == (1, 1)
    filled = quality.impute_mean(quality.with_group_stats(df, ["power_output"]), "power_output")
    assert [r.power_output for r in filled.collect()] == [4.0] * 3


@pytest.mark.parametrize("values", [(5.0, NAN), (NAN, 5.0), (None, 5.0), (NAN, None, 5.0)])
def test_a_real_reading_wins_a_tie(spark, values):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, at, v, at) for v in values], "turbine_id int, timestamp timestamp, power_output double, date_created timestamp")
    assert [r.power_output for r in quality.dedup_latest(df, keep_ties=False).collect()] == [5.0]


def test_whiskers_end_at_the_quartiles(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.0, 0.0, 100.0)], "x double")
    box = quality.box_stats(df, "x").first()
    assert (box.q1, box.q3, box.whisker_low, box.whisker_high, box.fliers) == (0.0, 25.0, 0.0, 25.0, 1)
    low = quality.box_stats(df.selectExpr("-x AS x"), "x").first()
    assert (low.q1, low.whisker_low, low.whisker_high) == (-25.0, -25.0, 0.0)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_infinite_quartiles_flag_nothing(spark, keys):
    df = spark.createDataFrame([(1, float("-inf"))] * 5 + [(1, 1.0)], "k int, x double")
    assert quality.iqr_outliers(df, "x", keys).count() == 0
    assert quality.box_stats(df, "x", keys).first()["fliers"] == 0


def test_profile_of_texts(spark):
    df = spark.createDataFrame([("b", 1), ("a", 3), (None, None)], "s string, n int")
    rows = {r["column"]: r for r in quality.profile(df).collect()}
    assert (rows["s"]["count"], rows["s"].min_text, rows["s"].max_text, rows["s"].mean) == (2, "a", "b", None)
    assert (rows["n"]["count"], rows["n"].mean, rows["n"].median, rows["n"].min_text) == (2, 2.0, 2.0, None)
    large = {r["column"]: r for r in quality.profile(df, exact_rows=0).collect()}
    assert large == rows
