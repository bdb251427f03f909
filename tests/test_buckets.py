"""Tables partitioned by a hash of the key, and tables kept by batches."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from sensorlake import sources, staging, tables

COLUMNS = "id int, site string, value double"


def files(spark, name):
    location = tables._detail(spark, name, "Location").removeprefix("file:")
    found = {}
    for folder, _, names in os.walk(location):
        found[os.path.relpath(folder, location)] = sorted(n for n in names if n.endswith(".parquet"))
    return {folder: held for folder, held in found.items() if held}


def frame(spark, *rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_untouched_buckets_keep_their_files(spark, name):
    tables.ensure(spark, name, COLUMNS, bucket_of=["id"], buckets=16)
    assert tables.bucket_columns(spark, name) == ["id"]
    first = staging.stage(frame(spark, *[(i, "a", float(i)) for i in range(200)]))
    tables.upsert(spark, first, name, ["id"])
    before = files(spark, name)
    assert len(before) == 16
    second = staging.stage(frame(spark, (3, "b", 30.0), (1000, "c", 1.0)))
    tables.upsert(spark, second, name, ["id"])
    after = files(spark, name)
    touched = {f"_bucket={r[0]}" for r in tables._with_bucket(second, ["id"], 16).select("_bucket").collect()}
    assert {b for b in after if after[b] != before.get(b)} == touched and 1 <= len(touched) <= 2
    expected = first.where("id <> 3").unionByName(second)
    assertDataFrameEqual(sources.read_table(spark, name), expected)


def test_random_upserts_equal_a_dictionary(spark, name):
    rng = random.Random(11)
    tables.ensure(spark, name, COLUMNS, bucket_of=["site", "id"], buckets=5)
    held = {}
    for _ in range(4):
        rows = {(rng.randint(0, 30), rng.choice("ab")): rng.random() for _ in range(15)}
        tables.upsert(spark, staging.stage(frame(spark, *[(*k, v) for k, v in rows.items()])), name, ["id", "site"])
        held.update(rows)
    assert {(r.id, r.site): r.value for r in sources.read_table(spark, name).collect()} == held


def test_null_keys_in_buckets(spark, name):
    tables.ensure(spark, name, COLUMNS, bucket_of=["id"], buckets=4)
    rows = staging.stage(frame(spark, (None, "a", 1.0), (1, None, 2.0)))
    for _ in range(2):
        tables.upsert(spark, rows, name, ["id"])
    assert sorted((r.id or 0, r.value) for r in spark.table(name).collect()) == [(0, 1.0), (0, 1.0), (1, 2.0)]
    tables.upsert(spark, rows, name, ["id"], null_safe=True)
    assert sorted((r.id or 0, r.value) for r in spark.table(name).collect()) == [(0, 1.0), (1, 2.0)]


def test_a_hot_bucket_is_split_over_files(spark, name):
    tables.ensure(spark, name, "id int, n int, text string", bucket_of=["id"], buckets=2)
    rows = spark.range(40000).select(
        F.when(F.col("id") < 36000, 7).otherwise(F.col("id")).cast("int").alias("id"),
        F.col("id").cast("int").alias("n"), F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        tables.upsert(spark, staging.stage(rows.repartition(8)), name, ["id", "n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    held = files(spark, name)
    assert max(len(f) for f in held.values()) >= 3 and spark.table(name).count() == 40000


def test_appended_rows_go_to_the_buckets_of_the_stored_types(spark, name):
    tables.ensure(spark, name, COLUMNS, bucket_of=["id"], buckets=8)
    given = spark.createDataFrame([(1.0, 5, "a"), (2.0, 6, "b")], "value double, id short, site string")
    tables.append(given, name)
    tables.upsert(spark, staging.stage(frame(spark, (5, "z", 9.0))), name, ["id"])
    assert {(r.id, r.site, r.value) for r in spark.table(name).collect()} == {(5, "z", 9.0), (6, "b", 2.0)}
    with pytest.raises(Exception):
        tables.append(given.withColumn("extra", F.lit(1)), name)


def test_layouts_that_are_refused(spark, name):
    with pytest.raises(ValueError, match="not by both"):
        tables.ensure(spark, name, "t timestamp, id int", day_of="t", bucket_of=["id"])
    with pytest.raises(ValueError, match="buckets"):
        tables.ensure(spark, name, "id int", bucket_of=["id"], buckets=0)
    with pytest.raises(ValueError, match="day_of"):
        tables.ensure(spark, name, "id int", batches=True)
    tables.ensure(spark, name, COLUMNS, bucket_of=["id"])
    with pytest.raises(ValueError, match="not a key"):
        tables.upsert(spark, frame(spark, (1, "a", 1.0)), name, ["site"])
    with pytest.raises(ValueError, match="without batches"):
        tables.replace_batch(frame(spark, (1, "a", 1.0)), name, "b", 0)


def test_a_column_name_with_quotes_may_be_hashed(spark, name):
    odd = "it's, \"id\""
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], f"`{odd}` int, v double")
    tables.ensure(spark, name, df.schema, bucket_of=[odd], buckets=3)
    for _ in range(2):
        tables.upsert(spark, df, name, [odd])
    assert tables.bucket_columns(spark, name) == [odd] and spark.table(name).count() == 2


def test_only_touched_buckets_are_scanned(spark, name):
    tables.ensure(spark, name, COLUMNS, bucket_of=["id"], buckets=16)
    tables.upsert(spark, staging.stage(frame(spark, *[(i, "a", 1.0) for i in range(100)])), name, ["id"])
    source = tables._with_bucket(frame(spark, (3, "b", 2.0)), ["id"], 16)
    plan = tables.touched_buckets(spark.table(name), source)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan


def test_a_batch_is_replaced_as_a_whole(spark, name):
    tables.ensure(spark, name, "id int, at timestamp", day_of="at", batches=True)
    second = 1_709_251_200_000_000  # 2024-03-01
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int").withColumn("at", F.timestamp_micros(F.lit(second)))
    tables.replace_batch(rows(1, 2), name, "it's-0", second)
    tables.replace_batch(rows(3), name, "it's-1", second)
    tables.replace_batch(rows(1, 5), name, "it's-0", second)
    assert sorted(r.id for r in sources.read_table(spark, name).collect()) == [1, 3, 5]
    tables.replace_batch(rows(1).limit(0), name, "it's-0", second)
    assert [r.id for r in sources.read_table(spark, name).collect()] == [3]
    tables.append(rows(8), name)
    assert sorted(r.id for r in sources.read_table(spark, name).collect()) == [3, 8]
    with pytest.raises(ValueError, match="as a whole"):
        tables.upsert(spark, rows(8), name, ["id", "at"])
