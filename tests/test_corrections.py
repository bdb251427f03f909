"""Rows taken out of tables, corrected readings and their metrics, compaction."""

import os
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from sensorlake import schema, sources, staging, tables
from sensorlake.operators import metrics, summaries
from sensorlake.plans import jobs

COLUMNS = "timestamp timestamp, turbine_id int, power_output double"
KEYS = ["timestamp", "turbine_id"]


def at(day, hour=0):
    return datetime(2022, 3, day, hour)


def frame(spark, *rows):
    return staging.stage(spark.createDataFrame(rows, COLUMNS))


def keys_of(spark, *rows):
    return staging.stage(spark.createDataFrame(rows, "timestamp timestamp, turbine_id int"))


def stored(spark, name):
    return sorted((tuple(r) for r in sources.read_table(spark, name).collect()), key=str)


@pytest.mark.parametrize("layout", [{}, {"day_of": "timestamp"}, {"bucket_of": ["turbine_id"], "buckets": 3}])
def test_deletes_beside_an_upsert(spark, name, layout, tmp_path):
    location = str(tmp_path / "outside")
    tables.ensure(spark, name, COLUMNS, location=location, **layout)
    rows = [(at(d, h), t, float(d)) for d in (1, 2, 3) for h in (0, 1) for t in (1, 2)]
    tables.upsert(spark, frame(spark, *rows, (None, 1, 9.0)), name, KEYS)
    gone = [(at(2, h), t) for h in (0, 1) for t in (1, 2)] + [(at(1), 1), (at(9), 9), (None, 1)]
    source = frame(spark, (at(1), 1, 50.0), (at(4), 1, 4.0))
    for _ in range(2):  # again: nothing changes
        tables.upsert(spark, source, name, KEYS, deletes=keys_of(spark, *gone))
        expected = [r for r in rows if r[0].day != 2 and r[:2] != (at(1), 1)]
        expected += [(at(1), 1, 50.0), (at(4), 1, 4.0), (None, 1, 9.0)]
        assert stored(spark, name) == sorted(expected, key=str)
    # Everything: also partitions that nothing is written to.
    every = sources.read_table(spark, name).select(*KEYS)
    tables.upsert(spark, source.limit(0), name, KEYS, deletes=staging.stage(every), null_safe=True)
    assert stored(spark, name) == []
    if layout:
        place = tables._detail(spark, name, "Location").removeprefix("file:")
        assert not [f for _, _, files in os.walk(place) for f in files if f.endswith(".parquet") and spark.read.parquet(f"{place}").count()]


def test_deletes_of_random_rounds_equal_a_dictionary(spark, name):
    rng = random.Random(5)
    tables.ensure(spark, name, COLUMNS, day_of="timestamp")
    held = {}
    for _ in range(4):
        new = {(at(rng.randint(1, 5)), rng.randint(1, 4)): rng.random() for _ in range(8)}
        gone = [k for k in held if rng.random() < 0.6] + [(at(6), 1)]
        tables.upsert(spark, frame(spark, *[(*k, v) for k, v in new.items()]), name, KEYS, deletes=keys_of(spark, *gone))
        held = {**{k: v for k, v in held.items() if k not in gone}, **new}
        assert {r[:2]: r[2] for r in stored(spark, name)} == held


def daily(spark, name):
    return {(r.turbine_id, r.date): r.power_output_daily_mean for r in spark.table(name).collect()}


def filled(spark, name):
    names = {"source": f"{name}_c", "target": f"{name}_d"}
    tables.ensure(spark, names["source"], COLUMNS, day_of="timestamp")
    rows = [(at(d, h), t, float(10 * t + d + h)) for d in (1, 2, 3) for h in (0, 2) for t in (1, 2)]
    tables.upsert(spark, frame(spark, *rows), names["source"], KEYS)
    jobs.daily_metrics(spark, **names)
    return names


def recomputed(spark, source):
    made = metrics.daily_metrics(metrics.with_date(spark.table(source)))
    return {(r.turbine_id, r.date): r.power_output_daily_mean for r in made.collect()}


def test_a_correction_moves_readings_and_their_metrics(spark, name):
    names = filled(spark, name)
    moved = [(at(2, 0), 1), (at(2, 2), 1)]
    jobs.correct(spark, deletes=keys_of(spark, *moved), upserts=frame(spark, (at(2, 0), 5, 1.0), (at(3, 0), 2, 99.0)), **names)
    got = daily(spark, names["target"])
    assert got == recomputed(spark, names["source"])
    assert (1, date(2022, 3, 2)) not in got and got[5, date(2022, 3, 2)] == 1.0
    jobs.correct(spark, deletes=staging.stage(spark.table(names["source"]).select(*KEYS)), **names)
    assert daily(spark, names["target"]) == {}


@pytest.mark.parametrize("step", ["upsert", "daily_metrics", "done"])
def test_a_correction_that_was_cut_off_is_made_up(spark, name, monkeypatch, step):
    names = filled(spark, name)
    change = {"deletes": keys_of(spark, (at(1, 0), 1), (at(1, 2), 1)), "upserts": frame(spark, (at(1, 0), 6, 2.0))}
    note, notes = jobs._note_correction, []

    def cut(*_, **__):
        raise InterruptedError

    def second_note_fails(*given):
        notes.append(1)
        note(*given) if len(notes) == 1 else cut()

    with monkeypatch.context() as patched:
        patched.setattr(*{
            "upsert": (tables, "upsert", cut), "daily_metrics": (jobs, "daily_metrics", cut),
            "done": (jobs, "_note_correction", second_note_fails),
        }[step])
        with pytest.raises(InterruptedError):
            jobs.correct(spark, **change, **names)
    jobs.correct(spark, **(change if step == "upsert" else {}), **names)
    got = daily(spark, names["target"])
    assert got == recomputed(spark, names["source"]) and (1, date(2022, 3, 1)) not in got


def test_metrics_stay_unless_they_are_retracted(spark, name):
    names = filled(spark, name)
    tables.upsert(spark, frame(spark).limit(0), names["source"], KEYS, deletes=keys_of(spark, (at(1, 0), 1), (at(1, 2), 1)))
    jobs.daily_metrics(spark, **names)
    assert (1, date(2022, 3, 1)) in daily(spark, names["target"])
    jobs.daily_metrics(spark, retract=True, **names)
    assert daily(spark, names["target"]) == recomputed(spark, names["source"])


def test_summaries_follow_corrections(spark, name):
    names = filled(spark, name)
    target = f"{name}_s"
    jobs.summarise(spark, source=names["source"], target=target, columns=["power_output"])
    jobs.correct(spark, deletes=keys_of(spark, (at(2, 0), 1), (at(2, 2), 1), (at(3, 2), 2)), **names)
    jobs.summarise(spark, source=names["source"], target=target, columns=["power_output"], dates=[date(2022, 3, d) for d in (2, 3)])
    days = sources.read_table(spark, target)
    assert days.count() == 5
    got = summaries.profile_of(days).first()
    row = spark.table(names["source"]).agg(F.count("power_output"), F.avg("power_output"), F.stddev("power_output")).first()
    assert (got["count"], round(got["mean"], 9), round(got["stddev"], 9)) == (row[0], round(row[1], 9), round(row[2], 9))


def test_the_clean_job_with_a_history(spark, name):
    raw = "timestamp timestamp, turbine_id int, wind_speed double, wind_direction int, power_output double, date_created timestamp"
    old = [(at(d, h), 1, 1.0, 1, 10.0 + h, at(20)) for d in (1, 2) for h in range(6)]
    names = {"source": f"{name}_r", "target": f"{name}_c"}
    tables.append(spark.createDataFrame(old, raw), names["source"], day_of="date_created")
    jobs.clean(spark, **names)
    jobs.summarise(spark, source=names["target"], target=f"{name}_s")
    # One new reading is missing, one is far off: alone, they have no statistics at all.
    new = [(at(5, 0), 1, 1.0, 1, None, at(21)), (at(5, 1), 1, 1.0, 1, 500.0, at(21))]
    tables.append(spark.createDataFrame(new, raw), names["source"])
    jobs.clean(spark, history=f"{name}_s", **names)
    got = {r.timestamp: r.power_output for r in spark.table(names["target"]).collect()}
    values = [r[4] for r in old] + [500.0]
    mean = sum(values) / len(values)
    assert abs(got[at(5, 0)] - mean) < 1e-9 and abs(got[at(5, 1)] - mean) < 1e-9 and got[at(1, 3)] == 13.0


# -- small files ------------------------------------------------------------------------------


def data_files(spark, name):
    place = tables._detail(spark, name, "Location").removeprefix("file:")
    return [os.path.join(d, f) for d, _, files in os.walk(place) for f in files if f.endswith(".parquet")]


def test_200_small_files_become_one(spark, name):
    rows = spark.range(5000).select(F.col("id").cast("int").alias("id"), F.sha1(F.col("id").cast("string")).alias("text"))
    tables.ensure(spark, name, "id int, text string")
    tables.append(rows.repartition(200), name)
    assert len(data_files(spark, name)) == 200
    reader = spark.table(name)  # planned before, read between the steps
    seen = []
    real = tables.staging.drop
    tables.staging.drop = lambda *given: (seen.append(reader.count()), real(*given))
    try:
        assert tables.compact(spark, name) == 1
    finally:
        tables.staging.drop = real
    assert seen == [5000] and len(data_files(spark, name)) == 1
    assertDataFrameEqual(spark.table(name), rows)
    assert tables.compact(spark, name) == 0


@pytest.mark.parametrize("layout", [{"day_of": "timestamp"}, {"bucket_of": ["turbine_id"], "buckets": 2}, {"day_of": "timestamp", "batches": True}])
def test_partitions_with_many_small_files_are_put_together(spark, name, layout):
    tables.ensure(spark, name, COLUMNS, **layout)
    many = frame(spark, *[(at(1), i % 7, float(i)) for i in range(60)], (None, None, 1.0), (None, None, 2.0))
    for part in range(10):
        tables.append(many.where(F.pmod(F.hash("power_output"), F.lit(10)) == part).coalesce(1), name)
    tables.append(frame(spark, (at(2), 1, 1.0)), name)
    before = {os.path.dirname(f) for f in data_files(spark, name)}
    kept = [f for f in data_files(spark, name) if "2022-03-02" in f]
    assert tables.compact(spark, name) >= 1
    assert all(f in data_files(spark, name) for f in kept)
    assert {os.path.dirname(f) for f in data_files(spark, name)} == before and len(data_files(spark, name)) <= 6
    assertDataFrameEqual(sources.read_table(spark, name), many.unionByName(frame(spark, (at(2), 1, 1.0))))


def test_notes_of_jobs_are_compacted(spark, name):
    tables.ensure(spark, jobs.progress_table(name), jobs._PROGRESS)
    for hour in range(12):
        row = spark.sql(f"SELECT TIMESTAMP '2022-03-01 {hour:02d}:00:00' AS high, DATE '2022-03-01' AS date")
        jobs._note(spark, name, row)
    assert tables.compact(spark, jobs.progress_table(name)) == 1
    assert len(data_files(spark, jobs.progress_table(name))) == 1
    assert spark.table(jobs.progress_table(name)).count() == 12
    assert schema.ARRIVAL not in spark.table(jobs.progress_table(name)).columns


def test_views_are_not_compacted(spark, name):
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT 1 AS id")
    try:
        with pytest.raises(ValueError, match="not ours"):
            tables.compact(spark, name)
    finally:
        spark.sql(f"DROP VIEW {name}")
