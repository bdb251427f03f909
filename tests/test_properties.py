"""Operators against plain Python models on random small tables."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorlake import tables
from sensorlake.operators import quality

SCHEMA = "timestamp timestamp, turbine_id int, power_output double, date_created timestamp"
START = datetime(2024, 3, 1)

times = st.integers(0, 5).map(lambda n: START + timedelta(hours=n * 8))
sensors = st.one_of(st.none(), st.integers(1, 2))
powers = st.one_of(st.none(), st.integers(-3, 9).map(float))
arrivals = st.one_of(st.none(), st.integers(1, 3).map(lambda n: START + timedelta(days=n)))
readings = st.lists(st.tuples(times, sensors, powers, arrivals), min_size=1, max_size=25)
few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def rank(arrival):
    return (arrival is not None, arrival or START)


@few
@given(rows=readings, hot_rows=st.sampled_from([2, 5_000_000]))
def test_dedup_latest(spark, rows, hot_rows):
    latest = {}
    for row in rows:
        key = row[:2]
        latest[key] = max(latest.get(key, (False, START)), rank(row[3]))
    expected = [row for row in rows if rank(row[3]) == latest[row[:2]]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert ordered(quality.dedup_latest(df, hot_rows=hot_rows).collect()) == ordered(expected)
    one = quality.dedup_latest(df, keep_ties=False).collect()
    assert len(one) == len(latest)
    assert set(map(tuple, one)) <= set(expected)


@few
@given(old=readings, new=readings)
def test_upsert_frame(spark, old, new):
    def unique(rows):
        return [r for r in {row[:2]: row for row in rows}.values()]

    old, new = unique(old), unique(new)
    keys = {row[:2] for row in new if row[1] is not None}
    expected = [row for row in old if row[:2] not in keys] + new
    merged = tables.upsert_frame(
        spark.createDataFrame(old, SCHEMA),
        spark.createDataFrame(new, SCHEMA),
        ["timestamp", "turbine_id"],
    )
    assert ordered(merged.collect()) == ordered(expected)


@few
@given(values=st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=2, max_size=60))
def test_narrowed_extremes_and_neighbours(spark, values):
    """Without interpolation the result is a value of the table, bit for bit."""
    n = len(values)
    wanted = {f"p{i}": i / (n - 1) for i in (0, n // 2, n - 1)}
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quality.quantiles(df, "x", wanted, exact_rows=0, buckets=16).first()
    known = sorted(values)
    for i in (0, n - 1):
        assert got[f"p{i}"] == known[i]
    low, high = known[max(n // 2 - 1, 0)], known[min(n // 2 + 1, n - 1)]
    assert low <= got[f"p{n // 2}"] <= high
