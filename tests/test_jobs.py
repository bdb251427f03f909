import os
from datetime import date, datetime

import pytest

import run_jobs
from sensorlake import sources, staging, tables
from sensorlake.plans import jobs

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"
DAY1, DAY2 = datetime(2024, 12, 5, 1, 30), datetime(2024, 12, 6, 1, 30)


@pytest.fixture
def names(name):
    return {"raw": f"{name}_r", "cleaned": f"{name}_c", "daily": f"{name}_d"}


def write(folder, file, *lines):
    (folder / file).write_text(HEADER + "".join(line + "\n" for line in lines))


def cleaned_rows(spark, names):
    rows = sources.read_table(spark, names["cleaned"]).collect()
    return {(r.timestamp, r.turbine_id): (r.power_output, r.date_created) for r in rows}


def test_ingest_stamps_and_appends(spark, names, tmp_path):
    write(tmp_path, "a.csv", "2022-03-01 00:00:00,1,7.25,88,1.4", "2022-03-01 00:00:00,2,3.75,301,")
    for stamp in (DAY1, DAY2):
        jobs.ingest(spark, f"{tmp_path}/*.csv", table=names["raw"], arrival=stamp)
    raw = sources.read_table(spark, names["raw"])
    assert raw.columns == [
        "timestamp", "turbine_id", "wind_speed", "wind_direction", "power_output", "date_created",
        sources.CORRUPT,
    ]
    assert sorted({r.date_created for r in raw.collect()}) == [DAY1, DAY2]
    assert raw.count() == 4  # every run reads the whole glob again


def test_ingest_with_inferred_types_and_location(spark, names, tmp_path):
    write(tmp_path, "a.csv", "2022-03-01 00:00:00,1,7.25,88,1.4")
    outside = str(tmp_path / "outside")
    jobs.ingest(spark, f"{tmp_path}/*.csv", table=names["raw"], location=outside, infer=True)
    assert sources.read_path(spark, outside).count() == 1


def test_one_reading_per_turbine_passes_through(spark, names, tmp_path):
    lines = [f"2022-03-01 01:00:00,{t},6.5,75,{p}" for t, p in ((1, 1.25), (2, 0.5), (3, 4.75))]
    write(tmp_path, "a.csv", *lines)
    jobs.run_all(spark, f"{tmp_path}/*.csv", arrival=DAY1, **names)
    hour = datetime(2022, 3, 1, 1)
    assert cleaned_rows(spark, names) == {
        (hour, 1): (1.25, DAY1), (hour, 2): (0.5, DAY1), (hour, 3): (4.75, DAY1),
    }
    daily = sources.read_table(spark, names["daily"])
    assert daily.columns == [
        "turbine_id", "date", "power_output_daily_min", "power_output_daily_max",
        "power_output_daily_mean",
    ]
    assert {tuple(r) for r in daily.collect()} == {
        (t, date(2022, 3, 1), p, p, p) for t, p in ((1, 1.25), (2, 0.5), (3, 4.75))
    }


def test_late_correction_and_duplicate_input(spark, names, tmp_path):
    first, second = tmp_path / "one", tmp_path / "two"
    first.mkdir(), second.mkdir()
    write(first, "a.csv", "2022-03-01 01:00:00,1,1.0,1,2.0", "2022-03-02 01:00:00,1,1.0,1,4.0")
    write(first, "copy.csv", "2022-03-01 01:00:00,1,1.0,1,2.0")  # ties with a.csv
    jobs.run_all(spark, f"{first}/*.csv", arrival=DAY1, **names)
    hour1, hour2 = datetime(2022, 3, 1, 1), datetime(2022, 3, 2, 1)
    assert cleaned_rows(spark, names) == {(hour1, 1): (2.0, DAY1), (hour2, 1): (4.0, DAY1)}

    write(second, "a.csv", "2022-03-01 01:00:00,1,1.0,1,3.0", "2022-03-01 02:00:00,1,1.0,1,3.0")
    jobs.run_all(spark, f"{second}/*.csv", arrival=DAY2, **names)
    assert cleaned_rows(spark, names) == {
        (hour1, 1): (3.0, DAY2),
        (datetime(2022, 3, 1, 2), 1): (3.0, DAY2),
        (hour2, 1): (4.0, DAY1),
    }
    daily = {r.date: r.power_output_daily_mean for r in sources.read_table(spark, names["daily"]).collect()}
    assert daily == {date(2022, 3, 1): 3.0, date(2022, 3, 2): 4.0}


def test_ingesting_the_same_files_again_changes_stamps_only(spark, names, tmp_path):
    write(tmp_path, "a.csv", *[f"2022-03-01 {h:02}:00:00,1,1.0,1,{h + 1}.0" for h in range(24)])
    values = []
    for stamp in (DAY1, DAY2):
        jobs.run_all(spark, f"{tmp_path}/*.csv", arrival=stamp, **names)
        values.append({key: power for key, (power, _) in cleaned_rows(spark, names).items()})
    assert values[0] == values[1] and len(values[0]) == 24


def test_nothing_new_and_rows_stamped_too_early(spark, names, tmp_path):
    write(tmp_path, "a.csv", "2022-03-01 01:00:00,1,1.0,1,2.0")
    jobs.run_all(spark, f"{tmp_path}/*.csv", arrival=DAY2, **names)
    before = cleaned_rows(spark, names)
    jobs.clean(spark, source=names["raw"], target=names["cleaned"])
    assert cleaned_rows(spark, names) == before
    write(tmp_path, "a.csv", "2022-03-01 02:00:00,1,1.0,1,9.0")
    jobs.run_all(spark, f"{tmp_path}/*.csv", arrival=DAY1, **names)  # not after the watermark
    assert cleaned_rows(spark, names) == before


def test_daily_metrics_of_some_dates(spark, names, tmp_path):
    write(tmp_path, "a.csv", *[f"2022-03-0{d} 01:00:00,1,1.0,1,{d}.0" for d in (1, 2, 3)])
    jobs.ingest(spark, f"{tmp_path}/*.csv", table=names["raw"], arrival=DAY1)
    jobs.clean(spark, source=names["raw"], target=names["cleaned"])
    jobs.daily_metrics(
        spark, source=names["cleaned"], target=names["daily"], dates=[date(2022, 3, 2)]
    )
    assert [r.date for r in sources.read_table(spark, names["daily"]).collect()] == [date(2022, 3, 2)]
    jobs.daily_metrics(spark, source=names["cleaned"], target=names["daily"])
    assert sources.read_table(spark, names["daily"]).count() == 3


def test_roll_up_of_new_dates_only(spark, names, tmp_path):
    first, second = tmp_path / "one", tmp_path / "two"
    first.mkdir(), second.mkdir()
    write(first, "a.csv", "2022-03-01 23:00:00,1,1.0,1,2.0", "2022-03-02 01:00:00,1,1.0,1,4.0")
    write(second, "a.csv", "2022-03-02 02:00:00,1,1.0,1,8.0", ",1,1.0,1,8.0")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for folder, stamp in ((first, DAY1), (second, DAY2)):
            jobs.run_all(spark, f"{folder}/*.csv", arrival=stamp, new_dates_only=True, **names)
        daily = sources.read_table(spark, names["daily"]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {(r.date, r.power_output_daily_max) for r in daily} == {
        (date(2022, 3, 1), 2.0), (date(2022, 3, 2), 8.0), (None, 8.0),
    }


def test_raw_table_without_day_partitions(spark, names):
    rows = [(datetime(2022, 3, 1, 1), 1, 1.0, 1, 2.0, DAY1)]
    spark.createDataFrame(
        rows,
        "timestamp timestamp, turbine_id int, wind_speed double, wind_direction int,"
        " power_output double, date_created timestamp",
    ).write.saveAsTable(names["raw"])
    assert tables.day_column(spark, names["raw"]) is None
    jobs.clean(spark, source=names["raw"], target=names["cleaned"])
    assert len(cleaned_rows(spark, names)) == 1


def test_command_line(spark, names, tmp_path):
    write(tmp_path, "a.csv", "2022-03-01 01:00:00,1,1.0,1,2.0")
    tables_of = [f"--{layer}={table}" for layer, table in names.items()]
    run_jobs.main([f"{tmp_path}/*.csv", *tables_of, "--new-dates-only"])
    assert [r.power_output_daily_mean for r in sources.read_table(spark, names["daily"]).collect()] == [2.0]


def stop(*_, **__):
    raise InterruptedError


def left_behind(spark):
    """Folders that this application has staged and not deleted."""
    root = staging._own_folder(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_a_run_stopped_halfway_is_repeated_in_full(spark, names, tmp_path, monkeypatch):
    first, second = tmp_path / "one", tmp_path / "two"
    first.mkdir(), second.mkdir()
    write(first, "a.csv", "2022-03-01 01:00:00,1,1.0,1,1.0")
    jobs.run_all(spark, f"{first}/*.csv", arrival=DAY1, new_dates_only=True, **names)
    write(second, "a.csv", *[f"2022-03-0{d} 02:00:00,1,1.0,1,{d}.0" for d in (2, 3, 4)], ",1,1.0,1,9.0")
    jobs.ingest(spark, f"{second}/*.csv", table=names["raw"], arrival=DAY2)
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "_note", stop)
        with pytest.raises(InterruptedError):
            jobs.clean(spark, source=names["raw"], target=names["cleaned"])
    spark.sql(f"ALTER TABLE {names['cleaned']} DROP PARTITION (_day = DATE '2022-03-03')")
    jobs.clean(spark, source=names["raw"], target=names["cleaned"])
    found = cleaned_rows(spark, names)
    assert sorted(k[0].day for k in found if k[0]) == [1, 2, 3, 4]
    # The row without a time, which no key can match, is there once.
    assert sources.read_table(spark, names["cleaned"]).where("timestamp IS NULL").count() == 1
    jobs.clean(spark, source=names["raw"], target=names["cleaned"])
    assert cleaned_rows(spark, names) == found


def test_a_roll_up_that_never_ran_is_made_up_for(spark, names, tmp_path):
    folders = [tmp_path / f"f{i}" for i in range(3)]
    for i, (folder, stamp) in enumerate(zip(folders, (DAY1, DAY2, datetime(2024, 12, 7)))):
        folder.mkdir()
        write(folder, "a.csv", f"2022-03-0{i + 1} 01:00:00,1,1.0,1,{i + 1}.0")
        jobs.ingest(spark, f"{folder}/*.csv", table=names["raw"], arrival=stamp)
        jobs.clean(spark, source=names["raw"], target=names["cleaned"])
        if i != 1:  # the second chain stops after its clean job
            jobs.roll_up(spark, source=names["cleaned"], target=names["daily"], new_dates_only=True)
    daily = sources.read_table(spark, names["daily"]).collect()
    assert sorted((r.date.day, r.power_output_daily_max) for r in daily) == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_malformed_cells_are_kept_and_not_imputed(spark, names, tmp_path):
    write(tmp_path, "a.csv", "2022-03-01 01:00:00,1,1.0,1,2.0", "2022-03-01 02:00:00,1,1.0,1,bad", "2022-03-01 03:00:00,1,1.0,1,")
    jobs.ingest(spark, f"{tmp_path}/*.csv", table=names["raw"], arrival=DAY1)
    assert [r[sources.CORRUPT] for r in jobs.malformed(spark, source=names["raw"]).collect()] == ["2022-03-01 02:00:00,1,1.0,1,bad"]
    jobs.clean(spark, source=names["raw"], target=names["cleaned"])
    assert sorted(k[0].hour for k in cleaned_rows(spark, names)) == [1, 3]
    jobs.clean(spark, source=names["raw"], target=f"{names['cleaned']}_all", use_malformed=True)
    assert spark.table(f"{names['cleaned']}_all").count() == 3


def test_integer_readings_are_rounded_not_cut(spark, names, tmp_path):
    lines = [f"2022-03-01 0{h}:00:00,1,1.0,{d},1.0" for h, d in enumerate((11, 12, ""))]
    write(tmp_path, "a.csv", *lines)
    jobs.ingest(spark, f"{tmp_path}/*.csv", table=names["raw"], arrival=DAY1)
    jobs.clean(spark, source=names["raw"], target=names["cleaned"], columns=["wind_direction"])
    rows = sources.read_table(spark, names["cleaned"]).orderBy("timestamp").collect()
    assert [r.wind_direction for r in rows] == [11, 12, 12]


def test_jobs_leave_nothing_staged(spark, names, tmp_path, monkeypatch):
    write(tmp_path, "a.csv", "2022-03-01 01:00:00,1,1.0,1,2.0")
    before = left_behind(spark)
    jobs.run_all(spark, f"{tmp_path}/*.csv", arrival=DAY1, **names)
    assert left_behind(spark) == before
    write(tmp_path, "a.csv", "2022-03-01 02:00:00,1,1.0,1,2.0")
    monkeypatch.setattr(tables, "upsert", stop)
    jobs.ingest(spark, f"{tmp_path}/*.csv", table=names["raw"], arrival=DAY2)
    for job in (jobs.clean, jobs.daily_metrics):
        with pytest.raises(InterruptedError):
            job(spark, source=names["raw" if job is jobs.clean else "cleaned"], target=names["cleaned" if job is jobs.clean else "daily"])
        assert left_behind(spark) == before


def test_format_goes_through_the_jobs(spark, names, tmp_path):
    write(tmp_path, "a.csv", "2022-03-01 01:00:00,1,1.0,1,2.0")
    jobs.run_all(spark, f"{tmp_path}/*.csv", arrival=DAY1, fmt="orc", **names)
    assert {tables._detail(spark, table, "Provider") for table in names.values()} == {"orc"}
