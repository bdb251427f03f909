"""Registered queries, each with the SQL that gives the same rows (where SQL can)."""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import ledger, schema, staging, streaming, tables
from sensorlake.demo import measurements, table
from sensorlake.functions import stable_round
from sensorlake.operators import incremental, ingest, metrics, quality, summaries
from sensorlake.plans import jobs
from sensorlake.sources import preview, read_csv_by_name, read_measurements_csv, read_path, read_table

# Only an absent subpackage is left out; an error within it is not hidden.
llm = None
_parts = [importlib.util.find_spec(name) for name in ("sensorlake.llm", "corpus_pipeline")]
if all(part is not None and part.origin for part in _parts):
    import corpus_pipeline
    from sensorlake.llm import queries as llm

READINGS = list(schema.READINGS)
KEYS = ["timestamp", "turbine_id"]

# Two overlapping deliveries: the second one re-delivers ten days of the first.
FIRST_UNTIL = "2024-01-20 12:30:00"
SECOND_FROM = "2024-01-10 06:30:00"
FIRST_STAMP = "2024-02-01 06:00:00"
SECOND_STAMP = "2024-02-02 06:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    return _daily_metrics(spark, "/root/testdata/sf0.001")


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: stable_round(F.col(c), digits) for c in columns})


def _local(df: DataFrame) -> DataFrame:
    """Zoned timestamps as the wall-clock time of the session."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = measurements(spark, sf_dir)
    first = m.where(F.col("date_created") < F.lit(FIRST_UNTIL).cast("timestamp_ntz"))
    second = m.where(F.col("date_created") >= F.lit(SECOND_FROM).cast("timestamp_ntz"))
    return first, second


# -- loading and cleaning ---------------------------------------------------------------------


def _newly_arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = measurements(spark, sf_dir)
    held = m.where(F.col("date_created") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return incremental.newer_than_target(m, held)


def _newly_arrived_empty_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = measurements(spark, sf_dir)
    return incremental.newer_than_target(m, m.where(F.lit(False)))


def _high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.high_watermark(measurements(spark, sf_dir))


def _stamp_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = measurements(spark, sf_dir).drop("date_created")
    return _local(ingest.stamp_arrival(raw, arrival=FIRST_STAMP))


def _dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedup_latest(measurements(spark, sf_dir))


def _dedup_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedup_latest(
        measurements(spark, sf_dir), keys=["turbine_id", "wind_direction"], hot_rows=10
    )


def _dedup_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedup_latest(
        table(spark, sf_dir, "lineitem"),
        keys=["l_partkey", "l_linenumber"],
        arrival="l_shipdate",
        keep_ties=False,
    )


def _group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.with_group_stats(measurements(spark, sf_dir), ["power_output"])
    return _rounded(stats, "power_output_mean", "power_output_std_dev")


def _group_stats_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.with_group_stats(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity"),
        ["l_quantity"],
        ["l_suppkey"],
        hot_rows=600,
        broadcast_bytes=0,
    )
    return _rounded(stats, "l_quantity_mean", "l_quantity_std_dev")


def _impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.with_group_stats(measurements(spark, sf_dir), ["power_output"])
    filled = quality.impute_mean(stats, "power_output")
    return _rounded(quality.drop_helpers(filled, ["power_output"]), "power_output")


def _replace_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.with_group_stats(measurements(spark, sf_dir), ["power_output"])
    banded = quality.with_sigma_band(stats, ["power_output"])
    fixed = quality.replace_outliers(banded, "power_output")
    return _rounded(quality.drop_helpers(fixed, ["power_output"]), "power_output")


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.clean(measurements(spark, sf_dir)), "power_output")


def _clean_all_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["wind_speed", "power_output"]
    return _rounded(quality.clean(measurements(spark, sf_dir), columns, k=1.5), *columns)


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _deliveries(spark, sf_dir)
    merged = tables.upsert_frame(quality.clean(first), quality.clean(second), KEYS)
    return _rounded(merged, "power_output")


def _daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = quality.clean(measurements(spark, sf_dir))
    daily = metrics.daily_metrics(metrics.with_date(cleaned))
    return _rounded(daily, "power_output_daily_min", "power_output_daily_max")


# -- stored tables and jobs -------------------------------------------------------------------


def _table_name() -> str:
    return f"sensorlake_{uuid.uuid4().hex}"


def _csv_folder(df: DataFrame) -> str:
    path = staging.new_path(df.sparkSession)
    df.write.option("header", True).csv(path)
    return path


def _csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = measurements(spark, sf_dir).drop("date_created")
    return _local(read_measurements_csv(spark, f"{_csv_folder(raw)}/*.csv"))


def _append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _table_name(), staging.new_path(spark)
    try:
        for part in _deliveries(spark, sf_dir):
            tables.append(part, name, location=path, day_of="date_created")
        kept = read_table(spark, name).count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return read_path(spark, path).withColumn("table_rows", F.lit(kept))


def _upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _table_name(), staging.new_path(spark)
    first, second = _deliveries(spark, sf_dir)
    try:
        tables.ensure(spark, name, first.schema, day_of="timestamp", location=path)
        for part in (first, second):
            tables.upsert(spark, staging.stage(quality.clean(part)), name, KEYS)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _rounded(read_path(spark, path), "power_output")


def _upsert_table_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name()
    first, second = _deliveries(spark, sf_dir)
    try:
        tables.ensure(spark, name, first.schema, location=staging.new_path(spark))
        for part in (first, second):
            tables.upsert(spark, staging.stage(quality.clean(part)), name, KEYS)
        stored = staging.stage(read_table(spark, name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _rounded(stored, "power_output")


def _upsert_table_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _table_name(), staging.new_path(spark)
    first, second = _deliveries(spark, sf_dir)
    try:
        tables.ensure(spark, name, first.schema, bucket_of=["turbine_id"], buckets=8, location=path)
        for part in (first, second):
            tables.upsert(spark, staging.stage(quality.clean(part)), name, KEYS)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _rounded(read_path(spark, path), "power_output")


def _csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: in order, in another order with a further column, and without the direction."""
    m = measurements(spark, sf_dir).drop("date_created")
    part = F.pmod(F.hour("timestamp") + F.col("turbine_id"), F.lit(3))
    folder = staging.new_path(spark)
    shapes = [
        m.columns,
        ["power_output", "site", "wind_direction", "turbine_id", "timestamp", "wind_speed"],
        ["turbine_id", "wind_speed", "timestamp", "power_output"],
    ]
    for number, columns in enumerate(shapes):
        rows = m.where(part == number).withColumn("site", F.lit("north, 'A'"))
        rows.select(*columns).write.option("header", True).csv(f"{folder}/{number}")
    return _local(read_csv_by_name(spark, f"{folder}/*/*.csv"))


def _csv_inferred_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types of all files: whole prices beside fractions, and a column that only one file has."""
    orders = table(spark, sf_dir, "orders")
    odd = F.pmod("o_orderkey", F.lit(2)) == 1
    folder = staging.new_path(spark)
    whole = orders.where(odd).select(F.floor("o_totalprice").alias("price"), "o_orderkey")
    rest = orders.where(~odd).select("o_orderkey", F.col("o_totalprice").alias("Price"), "o_orderpriority")
    for number, rows in enumerate((whole, rest)):
        rows.write.option("header", True).csv(f"{folder}/{number}")
    read = read_csv_by_name(spark, f"{folder}/*/*.csv", schema=None)
    return read.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("price").alias("price"), "o_orderpriority"
    )


def _drop_raw(spark: SparkSession, raw: str) -> None:
    for name in (raw, ledger.ledger_table(raw)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _stop_before_note(*_) -> None:
    raise InterruptedError("stopped between the rows and their note")


def _ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, the second of which is cut off once its rows are in; then a run without new files."""
    raw, landing = _table_name(), staging.new_path(spark)
    finish = ledger.finish
    try:
        for number, part in enumerate(_deliveries(spark, sf_dir)):
            part.drop("date_created").write.option("header", True).csv(f"{landing}/{number}")
            given = {"table": raw, "arrival": (FIRST_STAMP, SECOND_STAMP)[number], "once": True}
            if number:
                ledger.finish = _stop_before_note
                try:
                    jobs.ingest(spark, f"{landing}/*/*.csv", **given)
                except InterruptedError:
                    ledger.finish = finish
                jobs.ingest(spark, f"{landing}/*/*.csv", **given)
            jobs.ingest(spark, f"{landing}/*/*.csv", **given)
        stored = staging.stage(read_table(spark, raw).drop("_corrupt_record"))
    finally:
        ledger.finish = finish
        _drop_raw(spark, raw)
    return _local(stored)


def _stream_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both deliveries through the chain as a stream, which runs the batch of each of them twice."""
    landing, checkpoint = staging.new_path(spark), staging.new_path(spark)
    names = {layer: _table_name() for layer in ("raw", "cleaned", "daily")}
    try:
        for number, part in enumerate(_deliveries(spark, sf_dir)):
            part.drop("date_created").write.option("header", True).csv(f"{landing}/{number}")
            for _ in range(2):
                stamp = (FIRST_STAMP, SECOND_STAMP)[number]
                streaming.run_new_files(spark, f"{landing}/*/*.csv", checkpoint, arrival=stamp, **names)
                staging.drop(spark, f"{checkpoint}/commits/{number}")  # as if lost before its commit
        cleaned, daily = (staging.stage(read_table(spark, names[layer])) for layer in ("cleaned", "daily"))
    finally:
        _drop_raw(spark, names["raw"])
        for layer in ("cleaned", "daily"):
            spark.sql(f"DROP TABLE IF EXISTS {jobs.progress_table(names[layer])}")
            spark.sql(f"DROP TABLE IF EXISTS {names[layer]}")
    return _local(cleaned), daily


def _stream_cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_stream_tables(spark, sf_dir)[0], "power_output")


def _stream_daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_stream_tables(spark, sf_dir)[1], "power_output_daily_min", "power_output_daily_max")


def _run_jobs(
    spark: SparkSession, sf_dir: str, *, stopped: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Both deliveries as CSV files through the whole chain; the cleaned and the daily table.

    With `stopped`, the clean job of each delivery ends after its upsert, before it has noted how far
    it came, and loses the last of the days that it wrote; the chain then runs on from there.
    """
    layout = {"cleaned": (schema.CLEAN, "timestamp"), "daily": (schema.DAILY, "date")}
    names = {layer: _table_name() for layer in ("raw", *layout)}
    paths = {layer: staging.new_path(spark) for layer in names}
    layers = {"raw": (schema.CLEAN, "date_created"), **layout}
    try:
        for layer, (columns, day_of) in layers.items():
            tables.ensure(spark, names[layer], columns, day_of=day_of, location=paths[layer])
        for part, stamp in zip(_deliveries(spark, sf_dir), (FIRST_STAMP, SECOND_STAMP)):
            files = f"{_csv_folder(part.drop('date_created'))}/*.csv"
            if not stopped:
                jobs.run_all(spark, files, arrival=stamp, **names)
                continue
            jobs.ingest(spark, files, table=names["raw"], arrival=stamp)
            _clean_and_stop(spark, names["raw"], names["cleaned"])
            jobs.clean(spark, source=names["raw"], target=names["cleaned"])
            jobs.roll_up(spark, source=names["cleaned"], target=names["daily"], new_dates_only=True)
    finally:
        for layer in ("cleaned", "daily"):
            spark.sql(f"DROP TABLE IF EXISTS {jobs.progress_table(names[layer])}")
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _local(read_path(spark, paths["cleaned"])), read_path(spark, paths["daily"])


def _clean_and_stop(spark: SparkSession, raw: str, cleaned: str) -> None:
    """A clean run that is lost after some days are in place: its note and its last day are missing."""
    note, jobs._note = jobs._note, lambda *given: (
        _stop_before_note() if spark.table(jobs.progress_table(cleaned)).count() else note(*given)
    )
    try:
        jobs.clean(spark, source=raw, target=cleaned)
    except InterruptedError:
        last = spark.table(cleaned).agg(F.max(tables.DAY)).first()[0]
        spark.sql(f"ALTER TABLE {cleaned} DROP PARTITION ({tables.DAY} = DATE '{last}')")
    finally:
        jobs._note = note


def _job_resumed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_run_jobs(spark, sf_dir, stopped=True)[0], "power_output")


def _job_resumed_daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        _run_jobs(spark, sf_dir, stopped=True)[1], "power_output_daily_min", "power_output_daily_max"
    )


def _job_cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_run_jobs(spark, sf_dir)[0], "power_output")


def _job_daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        _run_jobs(spark, sf_dir)[1], "power_output_daily_min", "power_output_daily_max"
    )


def _daily_metrics_after_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a sensor that were another one's for six days, and a day of a third that is taken out."""
    names = {layer: _table_name() for layer in ("source", "target")}
    readings = staging.stage(quality.dedup_latest(measurements(spark, sf_dir), keep_ties=False))
    day = F.to_date("timestamp")
    moved = readings.where((F.col("turbine_id") == 3) & day.between("2024-01-05", "2024-01-10"))
    gone = readings.where((F.col("turbine_id") == 7) & (day == "2024-01-12"))
    try:
        tables.ensure(spark, names["source"], readings.schema, day_of="timestamp")
        tables.upsert(spark, readings, names["source"], KEYS)
        jobs.daily_metrics(spark, **names)
        jobs.correct(
            spark,
            upserts=moved.withColumn("turbine_id", F.lit(103)),
            deletes=moved.select(*KEYS).unionByName(gone.select(*KEYS)),
            **names,
        )
        daily = staging.stage(read_table(spark, names["target"]))
    finally:
        for name in (*names.values(), jobs.corrections_table(names["target"])):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _rounded(daily, "power_output_daily_min", "power_output_daily_max")


def _compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _table_name(), staging.new_path(spark)
    try:
        for part in _deliveries(spark, sf_dir):
            tables.append(part.repartition(12), name, location=path, day_of="date_created")
        tables.compact(spark, name)
        stored = staging.stage(read_table(spark, name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return stored


# -- exploration ------------------------------------------------------------------------------


def _daily_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(summaries.summarise(metrics.with_date(measurements(spark, sf_dir))))


def _group_stats_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _daily_summaries(spark, sf_dir)
    stats = summaries.with_group_stats(measurements(spark, sf_dir), ["power_output"], days=days)
    return _rounded(stats, "power_output_mean", "power_output_std_dev")


def _profile_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged from the days; of what is approximate, whether it is as near as stated."""
    found = staging.stage(summaries.profile_of(_daily_summaries(spark, sf_dir)))
    m = measurements(spark, sf_dir)
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in READINGS]
    long = m.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("v IS NOT NULL")
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    beside = long.join(F.broadcast(found), "column")  # one row per column
    shares = [
        ((F.avg((F.col("v") < F.col(q)).cast("int")) <= p + summaries.RANK_ERROR)
         & (F.avg((F.col("v") <= F.col(q)).cast("int")) >= p - summaries.RANK_ERROR)).alias(f"{q}_near")
        for q, p in points.items()
    ]
    apart = F.abs(F.max("approx_distinct") - F.count_distinct("v")) <= 0.05 * F.count_distinct("v") + 1
    exact = ("count", "mean", "stddev", "min", "max")
    near = beside.groupBy("column").agg(*[F.max(c).alias(c) for c in exact], *shares, apart.alias("distinct_near"))
    return _rounded(near, "mean", "stddev")


def _circular_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.circular_stats(measurements(spark, sf_dir)), "direction", "strength", "deviation")


def _direction_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.direction_outliers(measurements(spark, sf_dir), k=1.1)


def _repair_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = measurements(spark, sf_dir)
    gaps = F.when(F.pmod(F.col("wind_direction"), F.lit(7)) != 0, F.col("wind_direction"))
    return quality.repair_direction(m.withColumn("wind_direction", gaps), k=1.1)


def _clean_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery, repaired by the statistics of all days, those of the first one included."""
    batch = staging.stage(quality.dedup_latest(_deliveries(spark, sf_dir)[1], keep_ties=False))
    with_stats = partial(summaries.with_group_stats, days=_daily_summaries(spark, sf_dir))
    return _rounded(quality.repair(batch, with_stats=with_stats), "power_output")


def _series_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = measurements(spark, sf_dir)
    return quality.series_extremes(m, "wind_speed", time="date_created", unit="day", keys=["turbine_id"])


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.with_group_stats(measurements(spark, sf_dir), READINGS)
    return quality.with_z_score(stats, READINGS)


def _z_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = [f"{c}_z_score" for c in READINGS]
    scored = _scored(spark, sf_dir).select("timestamp", "turbine_id", "date_created", *scores)
    return _rounded(scored, *scores)


def _z_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    outliers = quality.z_outliers(measurements(spark, sf_dir))
    return _rounded(outliers, *[f"{c}_z_score" for c in READINGS])


def _sigma_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.with_group_stats(measurements(spark, sf_dir), READINGS)
    banded = quality.with_sigma_band(stats, READINGS)
    bounds = [f"{c}_2_stddev_{side}" for c in READINGS for side in ("lower", "upper")]
    return _rounded(banded.select("timestamp", "turbine_id", "date_created", *bounds), *bounds)


def _sigma_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sigma_outliers(measurements(spark, sf_dir))


def _day_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = metrics.with_date(measurements(spark, sf_dir), name="day")
    stats = quality.with_group_stats(dated, READINGS, ["day"])
    wanted = [f"{c}_mean" for c in READINGS] + ["power_output_std_dev"]
    return _rounded(stats.select("timestamp", "turbine_id", "date_created", *wanted), *wanted)


def _daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.daily_counts(measurements(spark, sf_dir))


def _preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(quality.daily_counts(measurements(spark, sf_dir), sort=True), 20)


def _with_nans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of which one power reading in 13 is NaN, and is delivered beside a real one."""
    m = measurements(spark, sf_dir)
    odd = (F.pmod(F.hour("date_created") * 60 + F.minute("date_created"), F.lit(13)) == 0)
    nan = m.where(odd).withColumn("power_output", F.lit(float("nan")))
    twin = m.where(odd & (F.pmod(F.minute("date_created"), F.lit(2)) == 0))
    return m.where(~odd).unionByName(nan).unionByName(twin)


def _nan_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = quality.dedup_latest(_with_nans(spark, sf_dir), keep_ties=False)
    return latest.select(*KEYS, "date_created", F.nanvl("power_output", F.lit(None)).alias("power_output"))


def _nan_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.clean(_with_nans(spark, sf_dir), keep_ties=False), "power_output")


def _nan_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.daily_metrics(metrics.with_date(_with_nans(spark, sf_dir)))


def _nan_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_with_nans(spark, sf_dir), ["power_output", "wind_speed"], nans=True)


def _clean_wind_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = measurements(spark, sf_dir)
    gaps = F.when(F.pmod(F.col("wind_direction"), F.lit(7)) != 0, F.col("wind_direction"))
    return quality.clean(m.withColumn("wind_direction", gaps), ["wind_direction"], keep_ties=False).select(
        *KEYS, "wind_direction"
    )


def _box_stats_whiskers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of four readings 0, 0, 0 and a large one: the reading within the fences is in the box."""
    m = measurements(spark, sf_dir).select("turbine_id", F.ceil(F.abs("wind_speed") + 1).cast("double").alias("w"))
    top = m.groupBy("turbine_id").agg(F.max("w").alias("w"))
    zeros = top.select("turbine_id", F.explode(F.array(*[F.lit(0.0)] * 3)).alias("w"))
    return quality.box_stats(top.unionByName(zeros), "w", ["turbine_id"])


def _order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    columns = ["o_totalprice", "o_orderstatus", "o_orderpriority"]
    return _rounded(quality.profile(orders, columns), "mean", "stddev", "q1", "median", "q3")


def _over_reporting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.completeness(measurements(spark, sf_dir), over=24)


def _under_reporting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.completeness(measurements(spark, sf_dir), under=24)


def _silent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewer than three events of a user in a day, also none at all."""
    events = table(spark, sf_dir, "events")
    return quality.completeness(events, "value", ["user_id"], time="ts", under=3, empty_days=True)


def _missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_days(table(spark, sf_dir, "events"), ["user_id"], time="ts")


def _outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours without a power reading, on a calendar that is the same for all turbines."""
    m = measurements(spark, sf_dir)
    span = {"since": "2024-01-01 00:00:00", "until": "2024-01-31 23:00:00"}
    return quality.outages(m, unit="hour", column="power_output", **span)


def _last_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.last_seen(measurements(spark, sf_dir))


def _null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(measurements(spark, sf_dir))


def _iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.iqr_outliers(measurements(spark, sf_dir), "wind_speed")


def _iqr_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.iqr_summary(measurements(spark, sf_dir), "wind_speed")


def _iqr_summary_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.iqr_summary(measurements(spark, sf_dir), "wind_direction")


def _box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = quality.box_stats(measurements(spark, sf_dir), "power_output", ["turbine_id"])
    return _rounded(box, "q1", "median", "q3")


def _box_stats_wind_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        quality.box_stats(measurements(spark, sf_dir), "wind_speed"), "q1", "median", "q3"
    )


def _box_stats_with_test_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    tried = quality.with_test_points(measurements(spark, sf_dir), "power_output", [-6, 8])
    return _rounded(quality.box_stats(tried, "power_output"), "q1", "median", "q3")


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = quality.profile(measurements(spark, sf_dir))
    return _rounded(summary, "mean", "stddev", "q1", "median", "q3")


def _wind_speed_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        quality.overall_mean(measurements(spark, sf_dir), "wind_speed"), "wind_speed_mean"
    )


def _series_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.series(measurements(spark, sf_dir), "wind_speed"), "mean")


def _series_direction_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.series(measurements(spark, sf_dir), "wind_direction"), "mean")


# -- the same operators on other tables -------------------------------------------------------


def _order_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = metrics.with_date(table(spark, sf_dir, "orders"), time="o_orderdate")
    return metrics.daily_metrics(dated, column="o_totalprice", keys=["o_orderpriority"])


def _order_z_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    late = quality.z_outliers(orders, ["o_totalprice"], ["o_orderpriority"], threshold=1.5)
    return _rounded(late, "o_totalprice_z_score")


def _latest_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedup_latest(
        table(spark, sf_dir, "lineitem"), keys=["l_orderkey"], arrival="l_shipdate"
    )


def _price_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    summary = quality.profile(table(spark, sf_dir, "lineitem").select(*columns))
    return _rounded(summary, "mean", "stddev", "q1", "median", "q3")


def _price_box_stats_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles by narrowing brackets, the way that groups too large for one task take."""
    box = quality.box_stats(
        table(spark, sf_dir, "lineitem"),
        "l_extendedprice",
        ["l_returnflag", "l_linestatus"],
        exact_rows=50,
    )
    return _rounded(box, "q1", "median", "q3")


def _price_iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return quality.iqr_outliers(lines, "l_extendedprice", reach=0.4, exact_rows=50)


def queries() -> dict[str, Query]:
    if llm is None:
        return own_queries()
    return {**own_queries(), **llm.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return own_sql()
    return {**own_sql(), **llm.SQL}


def own_queries() -> dict[str, Query]:
    """All but those of the subpackage `llm`."""
    return {
        "measurements": measurements,
        "newly_arrived": _newly_arrived,
        "newly_arrived_empty_target": _newly_arrived_empty_target,
        "high_watermark": _high_watermark,
        "stamp_arrival": _stamp_arrival,
        "dedup_latest": _dedup_latest,
        "dedup_hot_keys": _dedup_hot_keys,
        "dedup_one_per_key": _dedup_one_per_key,
        "group_stats": _group_stats,
        "group_stats_hot_keys": _group_stats_hot_keys,
        "impute_mean": _impute_mean,
        "replace_outliers": _replace_outliers,
        "clean": _clean,
        "clean_all_readings": _clean_all_readings,
        "upsert": _upsert,
        "daily_metrics": _daily_metrics,
        "csv_scan": _csv_scan,
        "append_table": _append_table,
        "upsert_table": _upsert_table,
        "upsert_table_unpartitioned": _upsert_table_unpartitioned,
        "upsert_table_by_bucket": _upsert_table_by_bucket,
        "csv_mixed_headers": _csv_mixed_headers,
        "csv_inferred_by_name": _csv_inferred_by_name,
        "ingest_once": _ingest_once,
        "stream_cleaned_table": _stream_cleaned_table,
        "stream_daily_table": _stream_daily_table,
        "daily_metrics_after_correction": _daily_metrics_after_correction,
        "compacted_table": _compacted_table,
        "group_stats_from_state": _group_stats_from_state,
        "profile_from_sketches": _profile_from_sketches,
        "circular_stats": _circular_stats,
        "direction_outliers": _direction_outliers,
        "repair_direction": _repair_direction,
        "clean_with_history": _clean_with_history,
        "series_extremes": _series_extremes,
        "silent_days": _silent_days,
        "missing_days": _missing_days,
        "outages": _outages,
        "job_resumed_table": _job_resumed_table,
        "job_resumed_daily_table": _job_resumed_daily_table,
        "nan_dedup": _nan_dedup,
        "nan_clean": _nan_clean,
        "nan_daily_metrics": _nan_daily_metrics,
        "nan_null_counts": _nan_null_counts,
        "clean_wind_direction": _clean_wind_direction,
        "box_stats_whiskers": _box_stats_whiskers,
        "order_profile": _order_profile,
        "job_cleaned_table": _job_cleaned_table,
        "job_daily_table": _job_daily_table,
        "z_scores": _z_scores,
        "z_outliers": _z_outliers,
        "sigma_bands": _sigma_bands,
        "sigma_outliers": _sigma_outliers,
        "day_stats": _day_stats,
        "daily_counts": _daily_counts,
        "preview": _preview,
        "over_reporting": _over_reporting,
        "under_reporting": _under_reporting,
        "last_seen": _last_seen,
        "null_counts": _null_counts,
        "iqr_outliers": _iqr_outliers,
        "iqr_summary": _iqr_summary,
        "iqr_summary_direction": _iqr_summary_direction,
        "box_stats": _box_stats,
        "box_stats_wind_speed": _box_stats_wind_speed,
        "box_stats_with_test_points": _box_stats_with_test_points,
        "profile": _profile,
        "wind_speed_mean": _wind_speed_mean,
        "series_hourly": _series_hourly,
        "series_direction_hourly": _series_direction_hourly,
        "order_daily_metrics": _order_daily_metrics,
        "order_z_outliers": _order_z_outliers,
        "latest_shipment": _latest_shipment,
        "price_profile": _price_profile,
        "price_box_stats_narrowed": _price_box_stats_narrowed,
        "price_iqr_outliers": _price_iqr_outliers,
    }


# -- SQL --------------------------------------------------------------------------------------

_M = """m AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp",
         CAST(user_id % 15 AS INT) AS turbine_id,
         value / 10 AS wind_speed,
         CAST(CAST(json_extract(props, '$.k') AS INT) * 360 // 100 AS INT) AS wind_direction,
         CASE WHEN event_id % 17 <> 0 THEN value END AS power_output,
         ts AS date_created
  FROM events)"""


def _fixed(expression: str, digits: int = 6) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def _sql_dedup(source: str, keys: str = 'turbine_id, "timestamp"') -> str:
    return f"""SELECT * EXCLUDE (place) FROM (
      SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY date_created DESC NULLS LAST) AS place
      FROM {source}) WHERE place = 1"""


def _sql_one(source: str) -> str:
    return f"""SELECT * EXCLUDE (place) FROM (
      SELECT *, row_number() OVER (PARTITION BY turbine_id, "timestamp"
        ORDER BY wind_speed DESC NULLS LAST, wind_direction DESC NULLS LAST,
                 power_output DESC NULLS LAST) AS place
      FROM {source}) WHERE place = 1"""


def _sql_repair(name: str, source: str) -> str:
    """A CTE with the repaired rows of the relation `source`."""
    return f"""{name} AS (
      SELECT "timestamp", turbine_id, wind_speed, wind_direction,
             CASE WHEN filled > mu + 2 * sd OR filled < mu - 2 * sd THEN mu ELSE filled END
               AS power_output, date_created
      FROM (SELECT *, coalesce(power_output, mu) AS filled FROM (
        SELECT *, avg(power_output) OVER (PARTITION BY turbine_id) AS mu,
               stddev_samp(power_output) OVER (PARTITION BY turbine_id) AS sd FROM ({source}))))"""


def _sql_merge(first: str, second: str) -> str:
    return f"""merged AS (
      SELECT * FROM {first} a WHERE NOT EXISTS (
        SELECT 1 FROM {second} b
        WHERE b."timestamp" = a."timestamp" AND b.turbine_id = a.turbine_id)
      UNION ALL SELECT * FROM {second})"""


def _sql_daily(source: str) -> str:
    return f"""SELECT turbine_id, CAST("timestamp" AS DATE) AS "date",
             {_fixed("min(power_output)")} AS power_output_daily_min,
             {_fixed("max(power_output)")} AS power_output_daily_max,
             {_fixed("avg(power_output)", 2)} AS power_output_daily_mean
      FROM {source} GROUP BY 1, 2"""


def _sql_box(source: str, column: str, keys: str = "", extra: str = "") -> str:
    group = f"GROUP BY {keys}" if keys else ""
    named = f"{keys}, " if keys else ""
    joined = f"{source} JOIN q USING ({keys})" if keys else f"{source}, q"
    low, high = "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"
    return f"""WITH {extra} q AS (
      SELECT {named}quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS md,
             quantile_cont({column}, 0.75) AS q3 FROM {source} {group})
      SELECT {named}{_fixed("q1")} AS q1, {_fixed("md")} AS median, {_fixed("q3")} AS q3,
             least(min({column}) FILTER (WHERE {column} >= {low}), q1) AS whisker_low,
             greatest(max({column}) FILTER (WHERE {column} <= {high}), q3) AS whisker_high,
             count(*) FILTER (WHERE {column} < {low} OR {column} > {high}) AS fliers
      FROM {joined} GROUP BY {named}q1, md, q3"""


def _sql_profile(source: str, columns: list[str], extra: str = "") -> str:
    rows = [
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {_fixed(f"avg({c})")} AS mean,
            {_fixed(f"stddev_samp({c})")} AS stddev, CAST(min({c}) AS DOUBLE) AS "min",
            {_fixed(f"quantile_cont({c}, 0.25)")} AS q1,
            {_fixed(f"quantile_cont({c}, 0.5)")} AS median,
            {_fixed(f"quantile_cont({c}, 0.75)")} AS q3,
            CAST(max({c}) AS DOUBLE) AS "max" FROM {source}"""
        for c in columns
    ]
    return extra + " UNION ALL ".join(rows)


def _sql_near_profile() -> str:
    rows = [
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {_fixed(f"avg({c})")} AS mean,
            {_fixed(f"stddev_samp({c})")} AS stddev, CAST(min({c}) AS DOUBLE) AS "min",
            CAST(max({c}) AS DOUBLE) AS "max", true AS q1_near, true AS median_near, true AS q3_near,
            true AS distinct_near FROM m"""
        for c in READINGS
    ]
    return f"WITH {_M} " + " UNION ALL ".join(rows)


def _sql_series(column: str) -> str:
    return f"""WITH {_M} SELECT "timestamp", count({column}) AS "count", min({column}) AS "min",
               {_fixed(f"avg({column})")} AS mean, max({column}) AS "max" FROM m GROUP BY 1"""


def _sql_iqr_summary(column: str) -> str:
    return f"""WITH {_M}, q AS (SELECT quantile_cont({column}, 0.25) AS q1,
                                      quantile_cont({column}, 0.75) AS q3 FROM m)
      SELECT count({column}) AS outliers, max({column}) AS max_outlier,
             min({column}) AS min_outlier
      FROM m, q WHERE {column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1)"""


def own_sql() -> dict[str, str]:
    w = "OVER (PARTITION BY turbine_id)"
    day = 'OVER (PARTITION BY CAST("timestamp" AS DATE))'
    keys = '"timestamp", turbine_id, date_created'

    def z(column: str) -> str:
        return f"abs(({column} - avg({column}) {w}) / nullif(stddev_samp({column}) {w}, 0))"

    z_columns = ", ".join(f"{_fixed(z(c))} AS {c}_z_score" for c in READINGS)
    bands = ", ".join(
        f"{_fixed(f'avg({c}) {w} {sign} 2 * stddev_samp({c}) {w}')} AS {c}_2_stddev_{side}"
        for c in READINGS
        for side, sign in (("lower", "-"), ("upper", "+"))
    )
    day_means = ", ".join(f"{_fixed(f'avg({c}) {day}')} AS {c}_mean" for c in READINGS)
    stats = f"""s AS (SELECT *, avg(power_output) {w} AS mu, stddev_samp(power_output) {w} AS sd
                      FROM m)"""
    counts = """SELECT CAST("timestamp" AS DATE) AS day, turbine_id,
                count("timestamp") AS timestamp_count, count(wind_speed) AS wind_speed_count,
                count(wind_direction) AS wind_direction_count,
                count(power_output) AS power_output_count FROM m GROUP BY 1, 2"""
    power_counts = """SELECT CAST("timestamp" AS DATE) AS day, turbine_id,
                      count(power_output) AS power_output_count FROM m GROUP BY 1, 2"""
    nulls = ", ".join(
        f'count(*) FILTER (WHERE "{c}" IS NULL) AS {c}_nulls'
        for c in ["timestamp", "turbine_id", *READINGS, "date_created"]
    )
    first = f"(SELECT * FROM m WHERE date_created < TIMESTAMP '{FIRST_UNTIL}')"
    second = f"(SELECT * FROM m WHERE date_created >= TIMESTAMP '{SECOND_FROM}')"
    clean_parts = f"""{_M}, {_sql_repair("a", _sql_dedup(first))},
                      {_sql_repair("b", _sql_dedup(second))}, {_sql_merge("a", "b")}"""
    job_parts = f"""{_M}, {_sql_repair("a0", _sql_one(first))},
        {_sql_repair("b0", _sql_one(second))},
        a AS (SELECT * REPLACE (TIMESTAMP '{FIRST_STAMP}' AS date_created) FROM a0),
        b AS (SELECT * REPLACE (TIMESTAMP '{SECOND_STAMP}' AS date_created) FROM b0),
        {_sql_merge("a", "b")}"""
    rounded_power = f"SELECT * REPLACE ({_fixed('power_output')} AS power_output)"
    raw = '"timestamp", turbine_id, wind_speed, wind_direction, power_output'

    vectors = """v AS (SELECT *, sqrt(s * s + c * c) AS strength FROM (
        SELECT turbine_id, count(wind_direction) AS n, avg(sin(radians(wind_direction))) AS s,
               avg(cos(radians(wind_direction))) AS c FROM m GROUP BY 1))"""
    user_days = """seen AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
        spine AS (SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
          FROM seen GROUP BY user_id),
        gone AS (SELECT * FROM spine ANTI JOIN seen USING (user_id, day))"""

    # One power reading in 13 is NaN, which counts as missing; some come beside a real one.
    odd = "(hour(date_created) * 60 + minute(date_created)) % 13 = 0"
    nan_parts = f"""{_M}, v AS (
        SELECT *, false AS was_nan FROM m WHERE NOT ({odd})
        UNION ALL SELECT * REPLACE (NULL AS power_output), true FROM m WHERE {odd}
        UNION ALL SELECT *, false FROM m WHERE {odd} AND minute(date_created) % 2 = 0),
        d AS (SELECT * EXCLUDE (was_nan) FROM v QUALIFY row_number() OVER (
          PARTITION BY turbine_id, "timestamp" ORDER BY date_created DESC, wind_speed DESC NULLS LAST,
          wind_direction DESC NULLS LAST, power_output DESC NULLS LAST) = 1)"""

    return {
        "measurements": f"WITH {_M} SELECT * FROM m",
        "newly_arrived": f"""WITH {_M} SELECT * FROM m WHERE date_created > (
            SELECT coalesce(max(date_created), TIMESTAMP '1970-01-01') FROM m
            WHERE date_created < TIMESTAMP '2024-01-16')""",
        "newly_arrived_empty_target": f"""WITH {_M}
            SELECT * FROM m WHERE date_created > TIMESTAMP '1970-01-01'""",
        "high_watermark": "SELECT max(ts) AS date_created FROM events",
        "stamp_arrival": f"""WITH {_M}
            SELECT {raw}, TIMESTAMP '{FIRST_STAMP}' AS date_created FROM m""",
        "dedup_latest": f"WITH {_M} {_sql_dedup('m')}",
        "dedup_hot_keys": f"WITH {_M} {_sql_dedup('m', 'turbine_id, wind_direction')}",
        "dedup_one_per_key": """SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_partkey, l_linenumber
              ORDER BY l_shipdate DESC, l_orderkey DESC, l_suppkey DESC, l_quantity DESC,
                       l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                       l_linestatus DESC) AS place
            FROM lineitem) WHERE place = 1""",
        "group_stats": f"""WITH {_M}, {stats} SELECT * EXCLUDE (mu, sd),
            {_fixed("mu")} AS power_output_mean, {_fixed("sd")} AS power_output_std_dev FROM s""",
        "group_stats_hot_keys": f"""SELECT l_orderkey, l_suppkey, l_quantity,
            {_fixed("avg(l_quantity) OVER (PARTITION BY l_suppkey)")} AS l_quantity_mean,
            {_fixed("stddev_samp(l_quantity) OVER (PARTITION BY l_suppkey)")}
              AS l_quantity_std_dev FROM lineitem""",
        "impute_mean": f"""WITH {_M}, {stats} SELECT * EXCLUDE (mu, sd)
            REPLACE ({_fixed("coalesce(power_output, mu)")} AS power_output) FROM s""",
        "replace_outliers": f"""WITH {_M}, {stats} SELECT * EXCLUDE (mu, sd) REPLACE (
            {_fixed('''CASE WHEN power_output > mu + 2 * sd OR power_output < mu - 2 * sd
                       THEN mu ELSE power_output END''')} AS power_output) FROM s""",
        "clean": f"WITH {_M}, {_sql_repair('c', _sql_dedup('m'))} {rounded_power} FROM c",
        "clean_all_readings": f"""WITH {_M}, d AS ({_sql_dedup('m')}), s AS (
            SELECT *, avg(power_output) {w} AS mu, stddev_samp(power_output) {w} AS sd,
                   avg(wind_speed) {w} AS wmu, stddev_samp(wind_speed) {w} AS wsd FROM d),
            f AS (SELECT * REPLACE (coalesce(power_output, mu) AS power_output) FROM s)
            SELECT * EXCLUDE (mu, sd, wmu, wsd) REPLACE (
              {_fixed('''CASE WHEN power_output > mu + 1.5 * sd OR power_output < mu - 1.5 * sd
                         THEN mu ELSE power_output END''')} AS power_output,
              {_fixed('''CASE WHEN wind_speed > wmu + 1.5 * wsd OR wind_speed < wmu - 1.5 * wsd
                         THEN wmu ELSE wind_speed END''')} AS wind_speed) FROM f""",
        "upsert": f"WITH {clean_parts} {rounded_power} FROM merged",
        "daily_metrics": f"WITH {_M}, {_sql_repair('c', _sql_dedup('m'))} {_sql_daily('c')}",
        "csv_scan": f"WITH {_M} SELECT {raw} FROM m",
        "append_table": f"""WITH {_M}, both_parts AS (
            SELECT * FROM {first} UNION ALL SELECT * FROM {second})
            SELECT *, (SELECT CAST(count(*) AS INT) FROM both_parts) AS table_rows
            FROM both_parts""",
        "upsert_table": f"WITH {clean_parts} {rounded_power} FROM merged",
        "upsert_table_unpartitioned": f"WITH {clean_parts} {rounded_power} FROM merged",
        "upsert_table_by_bucket": f"WITH {clean_parts} {rounded_power} FROM merged",
        "csv_mixed_headers": f"""WITH {_M}, p AS (
            SELECT {raw}, (hour("timestamp") + turbine_id) % 3 AS part FROM m)
            SELECT {raw} FROM p WHERE part = 0
            UNION ALL BY NAME SELECT power_output, wind_direction, turbine_id, "timestamp", wind_speed FROM p WHERE part = 1
            UNION ALL BY NAME SELECT turbine_id, wind_speed, "timestamp", power_output FROM p WHERE part = 2""",
        "csv_inferred_by_name": """SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price
            FROM orders WHERE o_orderkey % 2 = 1 UNION ALL BY NAME
            SELECT o_orderkey, o_totalprice AS price, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0""",
        "ingest_once": f"""WITH {_M} SELECT {raw}, TIMESTAMP '{FIRST_STAMP}' AS date_created FROM {first}
            UNION ALL SELECT {raw}, TIMESTAMP '{SECOND_STAMP}' AS date_created FROM {second}""",
        "stream_cleaned_table": f"WITH {job_parts} {rounded_power} FROM merged",
        "stream_daily_table": f"WITH {job_parts} {_sql_daily('merged')}",
        "daily_metrics_after_correction": f"""WITH {_M}, d AS (SELECT * FROM m QUALIFY row_number() OVER (
              PARTITION BY turbine_id, "timestamp" ORDER BY date_created DESC, wind_speed DESC NULLS LAST,
              wind_direction DESC NULLS LAST, power_output DESC NULLS LAST) = 1),
            c AS (SELECT * REPLACE (CASE WHEN turbine_id = 3 AND CAST("timestamp" AS DATE)
                BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' THEN 103 ELSE turbine_id END AS turbine_id)
              FROM d WHERE NOT (turbine_id = 7 AND CAST("timestamp" AS DATE) = DATE '2024-01-12'))
            {_sql_daily('c')}""",
        "compacted_table": f"""WITH {_M} SELECT * FROM {first} UNION ALL SELECT * FROM {second}""",
        "group_stats_from_state": f"""WITH {_M}, {stats} SELECT * EXCLUDE (mu, sd),
            {_fixed('mu')} AS power_output_mean, {_fixed('sd')} AS power_output_std_dev FROM s""",
        "profile_from_sketches": _sql_near_profile(),
        "circular_stats": f"""WITH {_M}, {vectors} SELECT turbine_id, n,
            {_fixed("((round(degrees(atan2(s, c)), 9) % 360) + 360) % 360")} AS direction,
            {_fixed("strength")} AS strength, {_fixed("degrees(sqrt(-2 * ln(strength)))")} AS deviation FROM v""",
        "direction_outliers": f"""WITH {_M}, {vectors} SELECT m.* FROM m JOIN v USING (turbine_id)
            WHERE abs((((wind_direction - degrees(atan2(s, c)) + 180) % 360) + 360) % 360 - 180)
              > 1.1 * degrees(sqrt(-2 * ln(strength)))""",
        "repair_direction": f"""WITH m0 AS (WITH {_M} SELECT * FROM m), m AS (SELECT * REPLACE (CASE WHEN
              wind_direction % 7 <> 0 THEN wind_direction END AS wind_direction) FROM m0), {vectors},
            j AS (SELECT m.*, ((round(degrees(atan2(s, c)), 9) % 360) + 360) % 360 AS mu,
              1.1 * degrees(sqrt(-2 * ln(strength))) AS reach FROM m JOIN v USING (turbine_id))
            SELECT * EXCLUDE (mu, reach) REPLACE (CASE WHEN wind_direction IS NULL
                OR abs((((wind_direction - mu + 180) % 360) + 360) % 360 - 180) > reach
              THEN CAST(round(mu) % 360 AS INT) ELSE wind_direction END AS wind_direction) FROM j""",
        "clean_with_history": f"""WITH {_M}, t AS (SELECT turbine_id, avg(power_output) AS mu,
              stddev_samp(power_output) AS sd FROM m GROUP BY 1),
            d AS (SELECT * FROM {second} QUALIFY row_number() OVER (PARTITION BY turbine_id, "timestamp"
              ORDER BY date_created DESC, wind_speed DESC NULLS LAST, wind_direction DESC NULLS LAST,
              power_output DESC NULLS LAST) = 1),
            f AS (SELECT d.* REPLACE (coalesce(power_output, mu) AS power_output), mu, sd FROM d JOIN t USING (turbine_id))
            SELECT * EXCLUDE (mu, sd) REPLACE ({_fixed("CASE WHEN power_output > mu + 2 * sd OR power_output < mu - 2 * sd THEN mu ELSE power_output END")}
              AS power_output) FROM f""",
        "series_extremes": f"""WITH {_M}, r AS (SELECT turbine_id,
              CAST(date_trunc('day', date_created) AS TIMESTAMP) AS bucket, date_created AS "time", wind_speed AS "value"
            FROM m WHERE wind_speed IS NOT NULL),
            p AS (SELECT *, row_number() OVER (PARTITION BY turbine_id, bucket ORDER BY "time", "value") AS a,
              row_number() OVER (PARTITION BY turbine_id, bucket ORDER BY "time" DESC, "value" DESC) AS b,
              row_number() OVER (PARTITION BY turbine_id, bucket ORDER BY "value", "time") AS c,
              row_number() OVER (PARTITION BY turbine_id, bucket ORDER BY "value" DESC, "time") AS d FROM r)
            SELECT DISTINCT turbine_id, bucket, "time", "value" FROM p WHERE 1 IN (a, b, c, d)""",
        "silent_days": f"""WITH {user_days} SELECT day, user_id, count(value) AS value_count
            FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) GROUP BY 1, 2 HAVING count(value) < 3
            UNION ALL BY NAME SELECT *, CAST(0 AS BIGINT) AS value_count FROM gone""",
        "missing_days": f"WITH {user_days} SELECT * FROM gone",
        "outages": f"""WITH {_M}, seen AS (
            SELECT DISTINCT turbine_id, "timestamp" AS h FROM m WHERE power_output IS NOT NULL),
            spine AS (SELECT turbine_id, unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00',
              TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS h FROM (SELECT DISTINCT turbine_id FROM seen)),
            runs AS (SELECT *, h - row_number() OVER (PARTITION BY turbine_id ORDER BY h) * INTERVAL 1 HOUR AS run
              FROM spine ANTI JOIN seen USING (turbine_id, h))
            SELECT turbine_id, min(h) AS "first", max(h) AS "last", count(*) AS missing
            FROM runs GROUP BY turbine_id, run""",
        "job_resumed_table": f"WITH {job_parts} {rounded_power} FROM merged",
        "job_resumed_daily_table": f"WITH {job_parts} {_sql_daily('merged')}",
        "nan_dedup": f"""WITH {nan_parts} SELECT "timestamp", turbine_id, date_created, power_output FROM d""",
        "nan_clean": f"WITH {nan_parts}, {_sql_repair('c', 'SELECT * FROM d')} {rounded_power} FROM c",
        "nan_daily_metrics": f"WITH {nan_parts} {_sql_daily('v')}",
        "nan_null_counts": f"""WITH {nan_parts} SELECT
            count(*) FILTER (WHERE power_output IS NULL AND NOT was_nan) AS power_output_nulls,
            count(*) FILTER (WHERE wind_speed IS NULL) AS wind_speed_nulls,
            count(*) FILTER (WHERE was_nan) AS power_output_nans,
            count(*) FILTER (WHERE isnan(wind_speed)) AS wind_speed_nans FROM v""",
        "clean_wind_direction": f"""WITH {_M}, g AS (SELECT * REPLACE (CASE WHEN
            ((wind_direction % 7) + 7) % 7 <> 0 THEN wind_direction END AS wind_direction) FROM m),
            d AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY turbine_id, "timestamp"
              ORDER BY date_created DESC, wind_speed DESC NULLS LAST, wind_direction DESC NULLS LAST,
              power_output DESC NULLS LAST) = 1),
            s AS (SELECT *, avg(wind_direction) {w} AS mu, stddev_samp(wind_direction) {w} AS sd FROM d),
            f AS (SELECT *, coalesce(wind_direction, mu) AS filled FROM s)
            SELECT "timestamp", turbine_id, CAST(round(round(
              CASE WHEN filled > mu + 2 * sd OR filled < mu - 2 * sd THEN mu ELSE filled END, 9))
              AS INTEGER) AS wind_direction FROM f""",
        "box_stats_whiskers": _sql_box("p", "w", "turbine_id", f"""{_M}, t AS (SELECT turbine_id,
            max(ceil(abs(wind_speed) + 1)) AS w FROM m GROUP BY 1),
            p AS (SELECT turbine_id, w FROM t UNION ALL
                  SELECT turbine_id, unnest([0.0::DOUBLE, 0.0, 0.0]) FROM t),"""),
        "order_profile": """SELECT 'o_totalprice' AS "column", count(o_totalprice) AS "count",
            """ + f"""{_fixed("avg(o_totalprice)")} AS mean, {_fixed("stddev_samp(o_totalprice)")} AS stddev,
            CAST(min(o_totalprice) AS DOUBLE) AS "min", {_fixed("quantile_cont(o_totalprice, 0.25)")} AS q1,
            {_fixed("quantile_cont(o_totalprice, 0.5)")} AS median,
            {_fixed("quantile_cont(o_totalprice, 0.75)")} AS q3, CAST(max(o_totalprice) AS DOUBLE) AS "max",
            CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM orders""" + "".join(
            f""" UNION ALL SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
                min({c}), max({c}) FROM orders""" for c in ("o_orderstatus", "o_orderpriority")),
        "job_cleaned_table": f"WITH {job_parts} {rounded_power} FROM merged",
        "job_daily_table": f"WITH {job_parts} {_sql_daily('merged')}",
        "z_scores": f"WITH {_M} SELECT {keys}, {z_columns} FROM m",
        "z_outliers": f"""WITH {_M} SELECT *, {z_columns} FROM m QUALIFY
            {" OR ".join(f"{z(c)} > 3" for c in READINGS)}""",
        "sigma_bands": f"WITH {_M} SELECT {keys}, {bands} FROM m",
        "sigma_outliers": f"""WITH {_M}, {stats} SELECT * EXCLUDE (mu, sd) FROM s
            WHERE power_output > mu + 2 * sd OR power_output < mu - 2 * sd""",
        "day_stats": f"""WITH {_M} SELECT {keys}, {day_means},
            {_fixed(f"stddev_samp(power_output) {day}")} AS power_output_std_dev FROM m""",
        "daily_counts": f"WITH {_M} {counts}",
        "preview": f"WITH {_M} {counts} ORDER BY day, turbine_id LIMIT 20",
        "over_reporting": f"WITH {_M}, c AS ({power_counts}) SELECT * FROM c WHERE power_output_count > 24",
        "under_reporting": f"WITH {_M}, c AS ({power_counts}) SELECT * FROM c WHERE power_output_count < 24",
        "last_seen": f"""WITH {_M}
            SELECT turbine_id, max("timestamp") AS last_seen FROM m GROUP BY 1""",
        "null_counts": f"WITH {_M} SELECT {nulls} FROM m",
        "iqr_outliers": f"""WITH {_M}, q AS (SELECT quantile_cont(wind_speed, 0.25) AS q1,
            quantile_cont(wind_speed, 0.75) AS q3 FROM m)
            SELECT * EXCLUDE (q1, q3) FROM m, q WHERE wind_speed < q1 - 1.5 * (q3 - q1)
              OR wind_speed > q3 + 1.5 * (q3 - q1)""",
        "iqr_summary": _sql_iqr_summary("wind_speed"),
        "iqr_summary_direction": _sql_iqr_summary("wind_direction"),
        "box_stats": _sql_box("m", "power_output", "turbine_id", f"{_M},"),
        "box_stats_wind_speed": _sql_box("m", "wind_speed", extra=f"{_M},"),
        "box_stats_with_test_points": _sql_box(
            "p",
            "power_output",
            extra=f"""{_M}, p AS (SELECT power_output FROM m
                      UNION ALL SELECT unnest([-6.0::DOUBLE, 8.0])),""",
        ),
        "profile": _sql_profile("m", ["turbine_id", *READINGS], f"WITH {_M} "),
        "wind_speed_mean": f"""WITH {_M}
            SELECT {_fixed("avg(wind_speed)")} AS wind_speed_mean FROM m""",
        "series_hourly": _sql_series("wind_speed"),
        "series_direction_hourly": _sql_series("wind_direction"),
        "order_daily_metrics": f"""SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS "date",
            min(o_totalprice) AS o_totalprice_daily_min,
            max(o_totalprice) AS o_totalprice_daily_max,
            {_fixed("avg(o_totalprice)", 2)} AS o_totalprice_daily_mean
            FROM orders GROUP BY 1, 2""",
        "order_z_outliers": f"""WITH s AS (SELECT o_orderkey, o_orderpriority, o_totalprice,
            abs((o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderpriority))
                / nullif(stddev_samp(o_totalprice) OVER (PARTITION BY o_orderpriority), 0)) AS z
            FROM orders)
            SELECT * EXCLUDE (z), {_fixed("z")} AS o_totalprice_z_score FROM s WHERE z > 1.5""",
        "latest_shipment": """SELECT * EXCLUDE (place) FROM (SELECT *, rank() OVER (
            PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST) AS place FROM lineitem)
            WHERE place = 1""",
        "price_profile": _sql_profile(
            "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        ),
        "price_box_stats_narrowed": _sql_box(
            "lineitem", "l_extendedprice", "l_returnflag, l_linestatus"
        ),
        "price_iqr_outliers": """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1,
            quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
            SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q
            WHERE l_extendedprice < q1 - 0.4 * (q3 - q1)
               OR l_extendedprice > q3 + 0.4 * (q3 - q1)""",
    }
