"""CSV files of different headers."""

from datetime import datetime

import pytest
from pyspark.sql import types as T

from sensorlake import schema, sources
from sensorlake.sources import headers

FULL = "timestamp,turbine_id,wind_speed,wind_direction,power_output"


@pytest.fixture
def put(tmp_path):
    def write(file, text):
        (tmp_path / file).write_text(text)
        return str(tmp_path / "*.csv")

    return write


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_reordered_missing_and_added_columns(spark, put):
    put("a.csv", FULL + "\n2022-03-01 00:00:00,7,6.25,81,0.75\n")
    put("b b%20[1].csv", "﻿Power_Output , turbine_id,timestamp,site\n1.5,8,2022-03-01 01:00:00,\"north, \"\"A\"\"\"\n")
    put("c.csv", "turbine_id,wind_direction\n9,5\n")
    put("empty.csv", "")
    glob = put("only_header.csv", "turbine_id,timestamp,wind_speed\n")
    got = sources.read_csv_by_name(spark, glob)
    assert got.schema == schema.MEASUREMENT
    assert rows(got) == sorted([
        (datetime(2022, 3, 1), 7, 6.25, 81, 0.75),
        (datetime(2022, 3, 1, 1), 8, None, None, 1.5),
        (None, 9, None, 5, None),
    ], key=str)


def test_malformed_lines_of_every_group_are_kept(spark, put):
    put("a.csv", FULL + "\n2022-03-01 00:00:00,7,windy,81,0.75\n")
    glob = put("b.csv", "turbine_id,timestamp\nx,2022-03-01 00:00:00\n8,2022-03-01 00:00:00\n")
    got = sources.read_csv_by_name(spark, glob, corrupt="line")
    assert got.columns == [*schema.MEASUREMENT.names, "line"]
    assert sorted(r.line for r in got.collect() if r.line) == ["2022-03-01 00:00:00,7,windy,81,0.75", "x,2022-03-01 00:00:00"]


def test_types_that_hold_the_values_of_all_files(spark, put):
    put("a.csv", "id,n,big,text,gap,at\n1,2,3,4,,2022-03-01\n")
    put("b.csv", "n,id,big,text,gap,at,new\n2.5,2,5000000000,word,7,2022-03-01 05:00:00,x\n")
    glob = put("c.csv", "id\n3\n")
    got = sources.read_csv_by_name(spark, glob, schema=None)
    kinds = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert kinds == {"id": "int", "n": "double", "big": "bigint", "text": "string", "gap": "int", "at": "timestamp", "new": "string"}
    found = {r.id: r for r in got.collect()}
    assert (found[1].n, found[1].text, found[1].gap, found[1]["at"]) == (2.0, "4", None, datetime(2022, 3, 1))
    assert (found[2].big, found[2].gap, found[2]["at"], found[2].new) == (5000000000, 7, datetime(2022, 3, 1, 5), "x")
    assert found[3].n is None


@pytest.mark.parametrize("a, b, expected", [
    (T.IntegerType(), T.LongType(), T.LongType()),
    (T.LongType(), T.DoubleType(), T.DoubleType()),
    (T.DecimalType(20, 0), T.IntegerType(), T.DecimalType(20, 0)),
    (T.DecimalType(22, 4), T.DecimalType(20, 0), T.DecimalType(24, 4)),
    (T.DecimalType(20, 0), T.DoubleType(), T.DoubleType()),
    (T.DateType(), T.TimestampType(), T.TimestampType()),
    (T.BooleanType(), T.IntegerType(), T.StringType()),
    (T.DateType(), T.DoubleType(), T.StringType()),
])
def test_wider_types(a, b, expected):
    assert headers.wider(a, b) == expected and headers.wider(b, a) == expected


def test_files_of_one_header_are_one_scan(spark, put):
    for i in range(4):
        glob = put(f"{i}.csv", FULL + f"\n2022-03-01 00:00:00,{i},6.25,81,0.75\n")
    groups = headers.headers(spark, glob)
    assert [len(paths) for _, paths in groups] == [4]
    plan = sources.read_csv_by_name(spark, glob)._jdf.queryExecution().toString()
    assert plan.count("FileScan csv") == 1 and sources.read_csv_by_name(spark, glob).count() == 4


def test_a_repeated_name_and_too_many_headers_are_refused(spark, put, monkeypatch):
    glob = put("a.csv", "id,Id\n1,2\n")
    with pytest.raises(ValueError, match="repeats.*a.csv"):
        sources.read_csv_by_name(spark, glob)
    put("a.csv", "id\n1\n")
    glob = put("b.csv", "x\n1\n")
    monkeypatch.setattr(headers, "MOST_HEADERS", 1)
    with pytest.raises(ValueError, match="more than 1"):
        sources.read_csv_by_name(spark, glob)


def test_nothing_but_empty_files(spark, put):
    glob = put("a.csv", "")
    assert sources.read_csv_by_name(spark, glob, corrupt="line").columns == [*schema.MEASUREMENT.names, "line"]
    assert sources.read_csv_by_name(spark, glob).count() == 0
