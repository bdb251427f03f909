"""Files taken once, batches that are cut off and made up, and the stream's batches."""

import os
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorlake import ledger, sources, tables
from sensorlake.plans import jobs
from sensorlake.streaming import ingest_new_files, run_new_files

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"
DAY1, DAY2, DAY3 = (datetime(2024, 12, d) for d in (5, 6, 7))


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "in new"
    folder.mkdir()

    def put(file, *rows, header=HEADER):
        (folder / file).write_text(header + "".join(f"2022-03-01 0{h}:00:00,{t},1.0,1,{p}\n" for h, t, p in rows))

    put.glob = str(tmp_path) + r"/in*new*/*.csv"
    put.folder = folder
    return put


def powers(spark, table):
    return sorted(r.power_output for r in sources.read_table(spark, table).collect())


def cut(*_):
    raise InterruptedError


def test_a_second_run_adds_nothing_and_a_changed_file_is_taken_again(spark, name, landing):
    landing("a [b]{1}+%20.csv", (0, 1, 1.0), (1, 1, 2.0))
    for _ in range(2):
        jobs.ingest(spark, landing.glob, table=name, arrival=DAY1, once=True)
    assert powers(spark, name) == [1.0, 2.0]
    landing("b.csv", (2, 1, 3.0))
    jobs.ingest(spark, landing.glob, table=name, arrival=DAY2, once=True)
    assert powers(spark, name) == [1.0, 2.0, 3.0]
    landing("b.csv", (2, 1, 3.5), (3, 1, 4.0))
    jobs.ingest(spark, landing.glob, table=name, arrival=DAY3, once=True)
    assert powers(spark, name) == [1.0, 2.0, 3.0, 3.5, 4.0]
    stamps = {r.power_output: r.date_created for r in sources.read_table(spark, name).collect()}
    assert (stamps[1.0], stamps[3.0], stamps[4.0]) == (DAY1, DAY2, DAY3)


def test_batches_of_a_few_files_oldest_first(spark, name, landing):
    for i in range(5):
        landing(f"{i}.csv", (i, 1, float(i)))
        os.utime(landing.folder / f"{i}.csv", (2000 - i, 2000 - i))
    jobs.ingest(spark, landing.glob, table=name, once=True, most_files=2)
    noted = spark.table(ledger.ledger_table(name))
    sizes = {r.batch: r.n for r in noted.where("path IS NOT NULL").groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 2, 1: 2, 2: 1} and powers(spark, name) == [0.0, 1.0, 2.0, 3.0, 4.0]
    rows = sources.read_table(spark, name).orderBy("date_created", "power_output").collect()
    assert [r.power_output for r in rows] == [3.0, 4.0, 1.0, 2.0, 0.0]
    assert len({r.date_created for r in rows}) == 3  # stamps rise from batch to batch


@pytest.mark.parametrize("step", ["rows", "note"])
def test_a_run_that_was_cut_off_is_made_up(spark, name, landing, monkeypatch, step):
    landing("a.csv", (0, 1, 1.0))
    jobs.ingest(spark, landing.glob, table=name, arrival=DAY1, once=True)
    landing("b.csv", (1, 1, 2.0))
    with monkeypatch.context() as patched:
        patched.setattr(*((tables, "replace_batch") if step == "rows" else (ledger, "finish")), cut)
        with pytest.raises(InterruptedError):
            jobs.ingest(spark, landing.glob, table=name, arrival=DAY2, once=True)
    assert powers(spark, name) == ([1.0] if step == "rows" else [1.0, 2.0])
    # What is not known to be complete is not cleaned, nor is anything after it.
    jobs.clean(spark, source=name, target=f"{name}_c")
    assert powers(spark, f"{name}_c") == [1.0]
    landing("c.csv", (2, 1, 3.0))
    jobs.ingest(spark, landing.glob, table=name, arrival=DAY3, once=True)
    stamps = {r.power_output: r.date_created for r in sources.read_table(spark, name).collect()}
    assert stamps == {1.0: DAY1, 2.0: DAY2, 3.0: DAY3} and sources.read_table(spark, name).count() == 3
    jobs.clean(spark, source=name, target=f"{name}_c")
    assert len(powers(spark, f"{name}_c")) == 3


def test_a_file_that_is_gone_before_it_is_made_up_fails_the_run(spark, name, landing, monkeypatch):
    landing("a.csv", (0, 1, 1.0))
    landing("b.csv", (1, 1, 1.0))
    with monkeypatch.context() as patched:
        patched.setattr(tables, "replace_batch", cut)
        with pytest.raises(InterruptedError):
            jobs.ingest(spark, landing.glob, table=name, once=True)
    (landing.folder / "a.csv").unlink()
    with pytest.raises(Exception, match="a.csv"):
        jobs.ingest(spark, landing.glob, table=name, once=True)


def test_tables_without_batches_are_refused(spark, name, landing):
    landing("a.csv", (0, 1, 1.0))
    jobs.ingest(spark, landing.glob, table=name)
    with pytest.raises(ValueError, match="without batches"):
        jobs.ingest(spark, landing.glob, table=name, once=True)


def test_the_chain_over_new_files_of_different_headers(spark, name, landing):
    names = {layer: f"{name}_{layer}" for layer in ("raw", "cleaned", "daily")}
    given = {"new_files_only": True, "new_dates_only": True, "by_name": True, **names}
    landing("a.csv", (0, 1, 1.0), (1, 1, 3.0))
    (landing.folder / "b.csv").write_text("power_output,turbine_id,timestamp\n5.0,2,2022-03-01 00:00:00\nwindy,2,2022-03-01 01:00:00\n")
    for _ in range(2):
        jobs.run_all(spark, landing.glob, **given)
    rows = {r.turbine_id: r.power_output_daily_mean for r in sources.read_table(spark, names["daily"]).collect()}
    assert rows == {1: 2.0, 2: 5.0}
    assert [r._corrupt_record for r in jobs.malformed(spark, source=names["raw"]).collect()] == ["windy,2,2022-03-01 01:00:00"]
    assert jobs.malformed(spark, source=names["raw"]).columns[-1] == "_corrupt_record"


def lost_commit(checkpoint, number):
    for file in (f"{number}", f".{number}.crc"):
        os.remove(f"{checkpoint}/commits/{file}")


def test_a_repeated_stream_batch_is_in_the_table_once(spark, name, landing, tmp_path, monkeypatch):
    checkpoint = str(tmp_path / "progress")
    landing("a.csv", (0, 1, 1.0))
    landing("b.csv", (1, 1, 2.0))
    ingest_new_files(spark, landing.glob, checkpoint, table=name)
    first = {r.power_output: r.date_created for r in sources.read_table(spark, name).collect()}
    lost_commit(checkpoint, 0)
    ingest_new_files(spark, landing.glob, checkpoint, table=name)
    again = {r.power_output: r.date_created for r in sources.read_table(spark, name).collect()}
    assert again == first and spark.table(name).count() == 2
    # Cut between the rows and their note.
    landing("c.csv", (2, 1, 3.0))
    with monkeypatch.context() as patched:
        patched.setattr(ledger, "finish", cut)
        with pytest.raises(Exception):
            ingest_new_files(spark, landing.glob, checkpoint, table=name)
    ingest_new_files(spark, landing.glob, checkpoint, table=name)
    assert powers(spark, name) == [1.0, 2.0, 3.0]


def test_streams_of_other_checkpoints_do_not_replace_each_other(spark, name, landing, tmp_path):
    landing("a.csv", (0, 1, 1.0))
    for number in range(2):
        ingest_new_files(spark, landing.glob, str(tmp_path / f"progress{number}"), table=name)
    shutil.rmtree(tmp_path / "progress0")  # a new stream in the old place is another one
    ingest_new_files(spark, landing.glob, str(tmp_path / "progress0"), table=name)
    assert powers(spark, name) == [1.0, 1.0, 1.0]


def test_a_stream_into_a_table_without_batches_appends(spark, name, landing, tmp_path):
    landing("a.csv", (0, 1, 1.0))
    jobs.ingest(spark, landing.glob, table=name)
    ingest_new_files(spark, landing.glob, str(tmp_path / "progress"), table=name)
    assert powers(spark, name) == [1.0, 1.0]


def test_the_chain_behind_a_stream(spark, name, landing, tmp_path, monkeypatch):
    names = {layer: f"{name}_{layer}" for layer in ("raw", "cleaned", "daily")}
    checkpoint = str(tmp_path / "progress")
    landing("a.csv", (0, 1, 1.0), (1, 1, 2.0))
    landing("b.csv", (0, 2, 5.0))
    # One file a batch: the second batch of a run is not taken for one that was cleaned.
    run_new_files(spark, landing.glob, checkpoint, arrival=DAY1, max_files=1, **names)
    assert powers(spark, names["cleaned"]) == [1.0, 2.0, 5.0]
    landing("c.csv", (0, 1, 3.0))
    with monkeypatch.context() as patched:  # lost between the rows and the clean job
        patched.setattr(jobs, "clean", cut)
        with pytest.raises(Exception):
            run_new_files(spark, landing.glob, checkpoint, **names)
    run_new_files(spark, landing.glob, checkpoint, **names)
    assert powers(spark, names["cleaned"]) == [2.0, 3.0, 5.0]
    means = {r.turbine_id: r.power_output_daily_mean for r in sources.read_table(spark, names["daily"]).collect()}
    assert means == {1: 2.5, 2: 5.0}
    assert sources.read_table(spark, names["raw"]).count() == 4


def test_stamps_rise_also_when_the_clock_goes_back(spark, name):
    late = datetime(2100, 1, 1)
    first = ledger.begin_numbered(spark, name, "s", 0, ledger.stamp(spark, name, late))
    assert ledger.stamp(spark, name, None) == first.arrival + 1
    assert ledger.stamp(spark, name, DAY1) < first.arrival
    assert ledger.stamp(spark, name, late - timedelta(days=1), rising=True) == first.arrival + 1
    assert ledger.begin_numbered(spark, name, "s", 0, 5) == first
    assert ledger.open_since(spark, name) == first.arrival
    ledger.finish(spark, name, first)
    assert ledger.open_since(spark, name) is None and ledger.unfinished(spark, name, "s") == []


def test_a_roll_up_of_a_table_that_no_clean_job_has_filled(spark, name):
    rows = spark.sql("SELECT TIMESTAMP '2022-03-01 05:00:00' AS timestamp, 1 AS turbine_id, 2.0D AS power_output")
    tables.append(rows, f"{name}_c", day_of="timestamp")
    jobs.roll_up(spark, source=f"{name}_c", target=f"{name}_d", new_dates_only=True)
    assert [r.power_output_daily_mean for r in spark.table(f"{name}_d").collect()] == [2.0]


def test_tidying_after_many_runs(spark, name, landing):
    names = {layer: f"{name}_{layer}" for layer in ("raw", "cleaned", "daily")}
    for hour in range(4):
        landing(f"{hour}.csv", (hour, 1, 2.0 + hour))
        jobs.run_all(spark, landing.glob, new_files_only=True, new_dates_only=True, **names)
    jobs.run_all(spark, landing.glob, new_files_only=True, new_dates_only=True, **names)  # nothing new: no further notes
    assert spark.table(jobs.progress_table(names["daily"])).count() == 4
    before = {layer: sorted(map(str, sources.read_table(spark, n).collect())) for layer, n in names.items()}
    done = jobs.tidy(spark, least=3, **names)
    assert done[jobs.progress_table(names["cleaned"])] == 1 and done[ledger.ledger_table(names["raw"])] == 1
    assert {layer: sorted(map(str, sources.read_table(spark, n).collect())) for layer, n in names.items()} == before
    landing("9.csv", (0, 2, 7.0))
    jobs.run_all(spark, landing.glob, new_files_only=True, new_dates_only=True, **names)
    assert {r.turbine_id: r.power_output_daily_mean for r in spark.table(names["daily"]).collect()} == {1: 3.5, 2: 7.0}
