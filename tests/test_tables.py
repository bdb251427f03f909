import os
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from sensorlake import sources, staging, tables

COLUMNS = "timestamp timestamp, turbine_id int, power_output double"
KEYS = ["timestamp", "turbine_id"]


def at(day, hour=0):
    return datetime(2022, 3, day, hour)


def frame(spark, *rows):
    return spark.createDataFrame(rows, COLUMNS)


def day_files(spark, name):
    location = tables._detail(spark, name, "Location").removeprefix("file:")
    return {
        day: sorted(f for f in os.listdir(f"{location}/{day}") if f.endswith(".parquet"))
        for day in os.listdir(location)
        if day.startswith("_day=")
    }


def test_upsert_frame(spark):
    target = frame(spark, (at(1), 1, 1.0), (at(1), 2, 2.0), (at(1), None, 3.0))
    source = frame(spark, (at(1), 2, 20.0), (at(2), 1, 30.0), (at(1), None, 40.0))
    expected = frame(
        spark,
        (at(1), 1, 1.0),
        (at(1), 2, 20.0),
        (at(2), 1, 30.0),
        (at(1), None, 3.0),  # NULL keys never match: kept, and inserted again
        (at(1), None, 40.0),
    )
    assertDataFrameEqual(tables.upsert_frame(target, source, KEYS), expected)


@pytest.mark.parametrize("day_of", [None, "timestamp"])
def test_append(spark, name, day_of):
    first, second = frame(spark, (at(1), 1, 1.0)), frame(spark, (at(1), 2, 2.0), (at(2), 1, None))
    tables.append(first, name, day_of=day_of)
    tables.append(second.select("power_output", "timestamp", "turbine_id"), name)  # by name
    assertDataFrameEqual(
        sources.read_table(spark, name).select(*first.columns), first.unionByName(second)
    )
    assert tables.day_column(spark, name) == day_of
    with pytest.raises(Exception):
        tables.append(second.withColumn("extra", F.lit(1)), name)


@pytest.mark.parametrize("day_of", [None, "timestamp"])
def test_append_to_an_external_location(spark, name, tmp_path, day_of):
    df = frame(spark, (at(1), 1, 1.0))
    location = str(tmp_path / "it's outside")
    tables.append(df, name, location=location, day_of=day_of)
    tables.append(df, name, location=location)
    spark.sql(f"DROP TABLE {name}")
    assertDataFrameEqual(sources.read_path(spark, location), df.unionByName(df))


def test_ensure_and_recreate(spark, name):
    tables.ensure(spark, name, COLUMNS)
    assert spark.table(name).columns == ["timestamp", "turbine_id", "power_output"]
    tables.append(frame(spark, (at(1), 1, 1.0)), name)
    tables.ensure(spark, name, COLUMNS)
    assert spark.table(name).count() == 1
    tables.ensure(spark, name, frame(spark, (at(1), 1, 1.0)).schema, recreate=True)
    assert spark.table(name).count() == 0


def test_upsert_argument_errors(spark, name):
    df = frame(spark, (at(1), 1, 1.0))
    with pytest.raises(ValueError, match="key columns"):
        tables.upsert(spark, df, name, [])
    with pytest.raises(ValueError, match="no table"):
        tables.upsert(spark, df, name, KEYS)
    with pytest.raises(ValueError, match="no table"):
        tables.upsert(spark, df, "", KEYS)
    tables.ensure(spark, name, COLUMNS, day_of="timestamp")
    with pytest.raises(ValueError, match="not a key"):
        tables.upsert(spark, df, name, ["turbine_id"])
    with pytest.raises(ValueError, match="several rows"):
        tables.upsert(spark, df.unionByName(df), name, KEYS)
    assert spark.table(name).count() == 0


@pytest.mark.parametrize("day_of", [None, "timestamp"])
def test_upsert_updates_inserts_and_keeps(spark, name, day_of):
    tables.ensure(spark, name, COLUMNS, day_of=day_of)
    first = frame(spark, (at(1), 1, 1.0), (at(1, 5), 1, 2.0), (at(2), 1, 3.0), (None, 1, 4.0))
    tables.upsert(spark, first, name, KEYS)
    assertDataFrameEqual(sources.read_table(spark, name), first)
    second = frame(spark, (at(1, 5), 1, 20.0), (at(3), 1, 5.0), (None, 1, 6.0))
    tables.upsert(spark, second, name, KEYS)
    expected = frame(
        spark,
        (at(1), 1, 1.0), (at(1, 5), 1, 20.0), (at(2), 1, 3.0), (at(3), 1, 5.0),
        (None, 1, 4.0), (None, 1, 6.0),
    )
    assertDataFrameEqual(sources.read_table(spark, name), expected)
    tables.upsert(spark, second.where("false"), name, KEYS)
    assertDataFrameEqual(sources.read_table(spark, name), expected)


def test_upsert_rewrites_touched_days_only(spark, name):
    tables.ensure(spark, name, COLUMNS, day_of="timestamp")
    tables.upsert(spark, frame(spark, *[(at(d), 1, float(d)) for d in range(1, 6)]), name, KEYS)
    before = day_files(spark, name)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    tables.upsert(spark, frame(spark, (at(2), 1, 0.0), (at(9), 1, 9.0)), name, KEYS)
    after = day_files(spark, name)
    changed = {day for day in after if after[day] != before.get(day)}
    assert changed == {"_day=2022-03-02", "_day=2022-03-09"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    assert spark.table(name).count() == 6


def test_partition_day_does_not_follow_the_session_zone(spark, name):
    tables.ensure(spark, name, COLUMNS, day_of="timestamp")
    tables.upsert(spark, frame(spark, (at(1, 2), 1, 1.0)), name, KEYS)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        same = sources.read_table(spark, name).withColumn("power_output", F.lit(2.0))
        tables.upsert(spark, staging.stage(same), name, KEYS)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in sources.read_table(spark, name).collect()] == [(at(1, 2), 1, 2.0)]
    assert list(day_files(spark, name)) == ["_day=2022-03-01"]


def test_upsert_frame_with_null_safe_keys(spark):
    target = frame(spark, (at(1), None, 3.0), (None, 1, 1.0))
    source = frame(spark, (at(1), None, 40.0))
    merged = tables.upsert_frame(target, source, KEYS, null_safe=True)
    assertDataFrameEqual(merged, frame(spark, (at(1), None, 40.0), (None, 1, 1.0)))


def test_a_failing_rewrite_leaves_the_old_rows(spark, name):
    tables.ensure(spark, name, COLUMNS)
    tables.upsert(spark, frame(spark, (at(1), 1, 1.0), (at(2), 1, 2.0)), name, KEYS)
    place = tables._detail(spark, name, "Location")
    bad = frame(spark, (at(3), 1, 3.0)).withColumn(
        "power_output", F.raise_error(F.lit("stop")).cast("double")
    )
    with pytest.raises(Exception, match="stop"):
        tables.upsert(spark, bad, name, KEYS, check_unique=False)
    spark.catalog.refreshTable(name)
    assert sorted(r.power_output for r in spark.table(name).collect()) == [1.0, 2.0]
    assert tables._detail(spark, name, "Location") == place
    beside = os.listdir(os.path.dirname(place.removeprefix("file:")))
    assert [f for f in beside if f.startswith(os.path.basename(place).split("--")[0])] == [os.path.basename(place)]


def test_a_column_may_be_called_provider(spark, name):
    df = spark.createDataFrame([(1, "delta")], "id int, Provider string")
    tables.ensure(spark, name, df.schema)
    tables.upsert(spark, df, name, ["id"])
    assert spark.table(name).count() == 1 and tables._detail(spark, name, "Provider") == "parquet"


def test_views_and_unknown_formats_are_refused(spark, name):
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT 1 AS id")
    try:
        with pytest.raises(ValueError, match="cannot be upserted"):
            tables.upsert(spark, spark.table(name), name, ["id"])
    finally:
        spark.sql(f"DROP VIEW {name}")


def test_lossy_casts_are_refused(spark, name):
    tables.ensure(spark, name, "id int, n int")
    for kind in ("double", "bigint"):
        with pytest.raises(ValueError, match="the table holds int"):
            tables.upsert(spark, spark.createDataFrame([(1, 2)], f"id int, n {'int' if kind == 'double' else kind}").withColumn("n", F.col("n").cast(kind)), name, ["id"])


def test_formats_with_merge_are_sent_a_merge_with_the_day(spark, name, monkeypatch):
    tables.ensure(spark, name, COLUMNS, day_of="timestamp")
    sent = []
    monkeypatch.setattr(tables, "_merge", lambda df, *rest: sent.append((df.columns, *rest)))
    monkeypatch.setattr(tables, "_FILE_FORMATS", ())
    monkeypatch.setattr(tables, "_MERGE_FORMATS", ("parquet",))
    tables.upsert(spark, frame(spark, (at(1), 1, 1.0)), name, KEYS)
    assert sent == [(["timestamp", "turbine_id", "power_output", tables.DAY], name, KEYS, False)]


def test_merge_is_understood(spark, name):
    tables.ensure(spark, name, COLUMNS)
    with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION|does not support|not supported"):
        tables._merge(frame(spark, (at(1), 1, 1.0)), name, KEYS)


def test_months_as_partitions(spark, name):
    tables.ensure(spark, name, COLUMNS, day_of="timestamp", by="month")
    tables.upsert(spark, frame(spark, (at(1), 1, 1.0), (at(20), 1, 2.0)), name, KEYS)
    tables.upsert(spark, frame(spark, (at(20), 1, 3.0)), name, KEYS)
    assert sorted(r.power_output for r in spark.table(name).collect()) == [1.0, 3.0]
    assert list(day_files(spark, name)) == ["_day=2022-03-01"]


def test_staged_frames(spark):
    path = staging.new_path(spark)
    assert path.startswith(staging.folder(spark))
    staged = staging.stage(spark.range(5).toDF("n"), path)
    assert staged.count() == 5
    staging.drop(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    kept = staging.new_path(spark)
    staging.stage(spark.range(5).toDF("n"), kept)
    staging.sweep(spark)
    assert not os.path.exists(kept.removeprefix("file:"))


def test_a_scope_deletes_what_is_staged_in_it(spark):
    with pytest.raises(InterruptedError), staging.scope(spark):
        path = staging.new_path(spark)
        staging.stage(spark.range(5).toDF("n"), path)
        raise InterruptedError
    assert not os.path.exists(path.removeprefix("file:"))


def test_a_scope_deletes_what_is_written_to_its_new_paths(spark):
    outside = staging.new_path(spark)
    with staging.scope(spark):
        inside = staging.new_path(spark)
        for path in (inside, outside):
            spark.range(5).write.parquet(path)
    assert not os.path.exists(inside.removeprefix("file:")) and spark.read.parquet(outside).count() == 5
    staging.drop(spark, outside)


def test_staging_frees_its_shuffle_files(spark):
    def shuffled():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}

    counts = spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffled()
    stored = staging.stage(counts)
    assert shuffled() <= before and stored.count() == 7
    assert spark.conf.get(staging._FREEING, None) is None
    assert sorted(r["count"] for r in counts.collect()) == [1428] * 3 + [1429] * 4


def test_staging_folder_is_the_one_the_cluster_names():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    named = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs:///shared"}, sparkContext=context)
    assert staging.folder(named) == "hdfs:///shared"
    conf = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": "hdfs:///tables/"}
    assert staging.folder(SimpleNamespace(conf=conf, sparkContext=context)) == "hdfs:///tables/_staged"
