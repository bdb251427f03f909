from datetime import datetime

from pyspark.sql import functions as F

from sensorlake import sources
from sensorlake.plans import jobs
from sensorlake.streaming import ingest_new_files

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"
DAY1, DAY2 = datetime(2024, 12, 5), datetime(2024, 12, 6)


def test_each_file_is_read_once(spark, name, tmp_path):
    raw, cleaned = f"{name}_r", f"{name}_c"
    files = tmp_path / "in"
    files.mkdir()
    checkpoint = str(tmp_path / "progress")
    (files / "a.csv").write_text(HEADER + "2022-03-01 00:00:00,1,1.0,1,2.0\n")
    (files / "b.csv").write_text(HEADER + "2022-03-01 01:00:00,1,1.0,1,3.0\n")
    ingest_new_files(spark, f"{files}/*.csv", checkpoint, table=raw, arrival=DAY1, max_files=1)
    jobs.clean(spark, source=raw, target=cleaned)
    (files / "c.csv").write_text(HEADER + "2022-03-01 00:00:00,1,1.0,1,4.0\n")
    ingest_new_files(spark, f"{files}/*.csv", checkpoint, table=raw, arrival=DAY2)
    ingest_new_files(spark, f"{files}/*.csv", checkpoint, table=raw, arrival=DAY2)
    counts = sources.read_table(spark, raw).groupBy("date_created").count().collect()
    assert {r.date_created: r["count"] for r in counts} == {DAY1: 2, DAY2: 1}
    jobs.clean(spark, source=raw, target=cleaned)
    rows = sources.read_table(spark, cleaned).orderBy("timestamp").collect()
    assert [r.power_output for r in rows] == [4.0, 3.0]
