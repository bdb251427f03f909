from datetime import datetime

import pytest
from pyspark.testing import assertDataFrameEqual

from sensorlake import schema, sources

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"
ROWS = [
    (datetime(2022, 3, 1), 7, 6.25, 81, 0.75),
    (datetime(2022, 3, 1), 8, 4.5, 302, None),
    (datetime(2022, 3, 1, 1), 9, 9.75, 12, 3.25),
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text(
        HEADER + "2022-03-01 00:00:00,7,6.25,81,0.75\n2022-03-01 00:00:00,8,4.5,302,\n"
    )
    (tmp_path / "b.csv").write_text(HEADER + "2022-03-01 01:00:00,9,9.75,12,3.25\n")
    return tmp_path


def test_csv_glob(spark, folder):
    expected = spark.createDataFrame(ROWS, schema.MEASUREMENT)
    got = sources.read_measurements_csv(spark, f"{folder}/*.csv")
    assert got.schema == schema.MEASUREMENT
    assertDataFrameEqual(got, expected)


def test_csv_with_inferred_types(spark, folder):
    got = sources.read_measurements_csv(spark, f"{folder}/*.csv", schema=None)
    assert got.schema == schema.MEASUREMENT
    assertDataFrameEqual(got, spark.createDataFrame(ROWS, schema.MEASUREMENT))


def test_csv_with_another_header_order_fails(spark, folder):
    (folder / "c.csv").write_text(
        "turbine_id,timestamp,wind_speed,wind_direction,power_output\n"
        "7,2022-03-01 00:00:00,6.25,81,0.75\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_measurements_csv(spark, f"{folder}/*.csv").collect()


def test_csv_keeps_malformed_lines(spark, folder):
    line = "2022-03-01 02:00:00,4,windy,10,1.5"
    (folder / "c.csv").write_text(HEADER + line + "\n")
    got = sources.read_measurements_csv(spark, f"{folder}/*.csv", corrupt="raw_line")
    rows = {r.turbine_id: r for r in got.collect()}
    assert rows[4].raw_line == line
    assert (rows[4].wind_speed, rows[4].power_output) == (None, 1.5)
    assert rows[7].raw_line is None


def test_path_table_and_preview(spark, folder, tmp_path, name):
    df = spark.createDataFrame(ROWS, schema.MEASUREMENT)
    df.write.parquet(str(tmp_path / "stored"))
    assertDataFrameEqual(sources.read_path(spark, str(tmp_path / "stored")), df)
    df.write.saveAsTable(name)
    assertDataFrameEqual(sources.read_table(spark, name), df)
    assert sources.preview(df, 2).count() == 2
    assert sources.preview(df).count() == 3
