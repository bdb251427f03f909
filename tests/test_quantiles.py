import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.operators import quality

RNG = np.random.default_rng(7)

SHAPES = {
    "uniform": RNG.uniform(-5, 5, 3000),
    "normal": RNG.normal(1e6, 1e-3, 3000),
    "heavy_tail": np.exp(RNG.normal(0, 30, 3000)),
    "one_hot_value": np.where(RNG.random(3000) < 0.4, 2.0, RNG.normal(2, 1, 3000)),
    "two_values": np.array([1.0] * 1500 + [2.0] * 1500),
    "two_values_straddling": np.array([1.0] * 1499 + [2.0] * 1502),
    "constant": np.full(2000, 3.25),
    "neighbouring_doubles": np.array([1.0, np.nextafter(1.0, 2.0)] * 1000),
    "huge_range": np.concatenate([RNG.normal(0, 1, 2000), [-1.7e308, 1.7e308]]),
    "signed_zero": np.array([0.0, -0.0] * 700 + [-1.0] * 600),
}
WANTED = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "high": 1.0}


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


@pytest.mark.parametrize("shape", SHAPES)
def test_narrowing_matches_numpy(spark, shape):
    values = SHAPES[shape]
    got = quality.quantiles(frame(spark, values), "x", WANTED, exact_rows=5, buckets=64).first()
    expected = np.quantile(values, list(WANTED.values()))
    np.testing.assert_allclose([got[n] for n in WANTED], expected, rtol=1e-12)


def test_percentile_and_narrowing_agree_per_group(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 41 == 1, None)
        .otherwise((F.col("id") % 13).cast("string"))
        .alias("k"),
        F.when(F.col("id") % 9 != 0, F.sin("id") * 100).alias("x"),
    )
    plain = quality.quartiles(df, "x", ["k"])
    narrowed = quality.quartiles(df, "x", ["k"], exact_rows=30, buckets=8)

    def rows(result):
        return {r.k: [round(r[c], 9) for c in ("q1", "median", "q3")] for r in result.collect()}

    assert len(rows(plain)) == 15
    assert rows(plain) == rows(narrowed)


def test_infinities_and_missing_readings(spark):
    values = [float("-inf")] * 30 + [float("inf")] * 60 + [float("nan")] * 500 + [1.0] * 31
    df = frame(spark, values).unionByName(spark.range(70).select(F.lit(None).cast("double").alias("x")))
    got = quality.quartiles(df, "x", exact_rows=5, buckets=4).first()
    assert (got.q1, got.median, got.q3) == (1.0, 1.0, float("inf"))


def test_a_group_without_readings_has_a_row(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0)], "k int, x double")
    got = {r.k: r.median for r in quality.quartiles(df, "x", ["k"]).collect()}
    assert got == {1: None, 2: 4.0}
    mixed = df.unionByName(spark.range(100).select(F.lit(3).alias("k"), F.col("id").cast("double").alias("x")))
    got = {r.k: r.median for r in quality.quartiles(mixed, "x", ["k"], exact_rows=5).collect()}
    assert got == {1: None, 2: 4.0, 3: 49.5}


def test_empty_table(spark):
    got = quality.quartiles(spark.createDataFrame([], "x double"), "x").first()
    assert got.median is None


@pytest.mark.parametrize("exact_rows", [1_000_000, 5])
def test_iqr_outliers_and_summary(spark, exact_rows):
    values = list(range(100)) + [500, -400, 300]
    df = frame(spark, values)
    q1, q3 = np.quantile(values, [0.25, 0.75])
    spread = 1.5 * (q3 - q1)
    outside = [v for v in values if v < q1 - spread or v > q3 + spread]
    got = quality.iqr_outliers(df, "x", exact_rows=exact_rows)
    assert sorted(r.x for r in got.collect()) == sorted(outside)
    summary = quality.iqr_summary(df, "x", exact_rows=exact_rows).first()
    assert tuple(summary) == (3, 500.0, -400.0)


def test_iqr_ignores_nan(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, 100.0, float("nan")])
    assert [r.x for r in quality.iqr_outliers(df, "x").collect()] == [100.0]
    box = quality.box_stats(df, "x").first()
    assert (box.median, box.whisker_low, box.whisker_high, box.fliers) == (3.0, 1.0, 4.0, 1)


def test_box_stats_with_test_points(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0])
    box = quality.box_stats(quality.with_test_points(df, "x", [-6, 8]), "x").first()
    q1, median, q3 = np.quantile([1, 2, 3, 4, -6, 8], [0.25, 0.5, 0.75])
    assert (box.q1, box.median, box.q3) == (q1, median, q3)
    assert (box.whisker_low, box.whisker_high, box.fliers) == (1.0, 4.0, 2)


def test_approximate_quartiles_are_near_the_wanted_ranks(spark):
    values = np.sort(SHAPES["normal"])
    got = quality.quartiles(frame(spark, values), "x", approx=True).first()
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        assert abs(np.searchsorted(values, got[name]) - p * len(values)) <= 2
