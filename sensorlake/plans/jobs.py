"""The three jobs over named tables, and their chain. The caller supplies the session.

How far a job has come is kept apart from its data, in a small table beside its target, and is written
when the upsert has returned. A run that stops in between is therefore repeated in full by the next
one, and an upsert of the same rows changes nothing more.
"""

from collections.abc import Sequence
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from sensorlake import ledger, schema, staging, tables
from sensorlake.operators import incremental, metrics, quality, summaries
from sensorlake.operators.ingest import stamp_arrival
from sensorlake.sources import CORRUPT, escaped, read_csv_by_name, read_measurements_csv

RAW = "raw_measurements"
CLEANED = "clean_measurements"
DAILY = "daily_power_output"
SUMMARIES = "daily_summaries"

_PROGRESS = "high timestamp, date date"
MOST_FILES = 10_000  # of one batch: their paths go through the driver


def progress_table(target: str) -> str:
    """Batches that have reached `target`: the latest arrival, and one row per date of the batch."""
    return f"{target}_progress"


def _progress(spark: SparkSession, target: str, held: DataFrame) -> int:
    """How far `target` has come, in microseconds. At the first run it begins with what `held` has already."""
    name = progress_table(target)
    since = _micros(spark.table(name), "high") if spark.catalog.tableExists(name) else None
    if since is None:
        tables.ensure(spark, name, _PROGRESS)
        begin = incremental.high_watermark(held).select(F.col(schema.ARRIVAL).cast("timestamp").alias("high"))
        _note(spark, target, begin.withColumn("date", F.lit(None).cast("date")))
        since = _micros(spark.table(name), "high")
    return since


def _note(spark: SparkSession, target: str, rows: DataFrame) -> None:
    # One file: the note of a batch is there as a whole or not at all.
    rows.select("high", "date").coalesce(1).write.insertInto(progress_table(target))


def _micros(df: DataFrame, column: str) -> int | None:
    """The latest time of a column; as a number, no time zone can shift it on its way."""
    return df.agg(F.unix_micros(F.max(column).cast("timestamp"))).first()[0]


def ingest(
    spark: SparkSession,
    path: str | list[str],
    *,
    table: str = RAW,
    arrival: datetime | str | None = None,
    location: str | None = None,
    infer: bool = False,
    fmt: str = "parquet",
    by_name: bool = False,
    once: bool = False,
    most_files: int = MOST_FILES,
) -> None:
    """Read all files of the glob, stamp them, append them.

    The table is partitioned by day of arrival, so a later run skips what it has seen. A line with a
    cell that does not fit its type is kept as it is in the column CORRUPT, unless the types are
    inferred or the table was made without that column. `by_name` reads files whose headers differ.

    With `once`, only files that no earlier run took as they are now (see `ledger`) are read, in batches
    of up to `most_files`, oldest first, each in a partition of its own. A run that was cut off is made up
    by the next one, which writes the batch in question anew. A file of it that is gone by then fails
    the run; one that changed is taken again as a further file.
    """
    keep = not infer
    if keep and spark.catalog.tableExists(table):
        keep = CORRUPT in spark.table(table).columns
    columns = None if infer else schema.MEASUREMENT
    read = read_csv_by_name if by_name else read_measurements_csv

    def rows(files: str | list[str], stamp: datetime | str | int | None) -> DataFrame:
        raw = read(spark, files, schema=columns, corrupt=CORRUPT if keep else None)
        return raw_columns(stamp_arrival(raw, arrival=stamp), keep)

    if not once:
        tables.append(rows(path, arrival), table, location=location, day_of=schema.ARRIVAL, fmt=fmt)
        return

    def take(batch: ledger.Batch) -> None:
        files = [escaped(file) for file in ledger.files_of(spark, table, batch)]
        stamped = rows(files, batch.arrival)
        tables.ensure(spark, table, stamped.schema, day_of=schema.ARRIVAL, batches=True, fmt=fmt, location=location)
        tables.replace_batch(stamped, table, batch.name, batch.arrival)
        ledger.finish(spark, table, batch)

    if spark.catalog.tableExists(table) and not tables.has_batches(spark, table):
        raise ValueError(f"{table} was made without batches; files are taken once into a table that this makes")
    for batch in ledger.unfinished(spark, table):
        take(batch)
    while batch := ledger.begin(
        spark, table, ledger.fresh(spark, table, path), ledger.stamp(spark, table, arrival), most=most_files
    ):
        take(batch)


def raw_columns(stamped: DataFrame, keep: bool) -> DataFrame:
    """The raw line, where it is kept, goes last."""
    return stamped.select(*[c for c in stamped.columns if c != CORRUPT], CORRUPT) if keep else stamped


def malformed(spark: SparkSession, *, source: str = RAW) -> DataFrame:
    """Raw rows with a cell that did not fit its type; the line as it came is in CORRUPT."""
    raw = spark.table(source).drop(*tables.INTERNAL)
    return raw.where(F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False))


def clean(
    spark: SparkSession,
    *,
    source: str = RAW,
    target: str = CLEANED,
    columns: Sequence[str] = ("power_output",),
    k: float = 2,
    use_malformed: bool = False,
    history: str | None = None,
    fmt: str = "parquet",
) -> None:
    """New arrivals → latest per key → impute → replace outliers → upsert.

    Statistics cover the newly arrived rows only, unless `history` names a table of daily summaries (see
    `summarise`): then those of its days and of the new rows together, so that a sensor of few new
    readings has them too. A reading delivered twice in one run ties with
    itself; one of the tied rows is taken, as an upsert needs one row per key. Malformed rows are
    left out, so that no mean stands in for a cell that could not be read; `use_malformed` takes
    them in with that cell missing.
    """
    tables.ensure(spark, target, schema.CLEAN, day_of=schema.EVENT_TIME, fmt=fmt)
    raw = spark.table(source)
    day = tables.DAY if tables.day_column(spark, source) == schema.ARRIVAL else None
    since = _progress(spark, target, spark.table(target))
    with staging.scope(spark):
        watermark = F.timestamp_micros(F.lit(since)).cast(raw.schema[schema.ARRIVAL].dataType)
        fresh = incremental.newer_than(raw, watermark, day=day).drop(*tables.INTERNAL)
        open_since = ledger.open_since(spark, source)
        if open_since is not None:  # the rest of that batch will have the same stamp
            fresh = fresh.where(F.col(schema.ARRIVAL) < F.timestamp_micros(F.lit(open_since)))
        # The latest arrival among the rows that this batch has read; what arrives from now on is the next
        # run's. A maximum is the same when a lost task counts its rows twice.
        read = Observation()
        fresh = fresh.observe(read, F.unix_micros(F.max(F.col(schema.ARRIVAL).cast("timestamp"))).alias("high"))
        if CORRUPT in fresh.columns:
            fresh = (fresh if use_malformed else fresh.where(F.col(CORRUPT).isNull())).drop(CORRUPT)
        batch = staging.stage(quality.dedup_latest(fresh, keep_ties=False))
        high = read.get["high"]
        if high is None:
            return
        with_stats = quality.with_group_stats
        if history is not None:
            new = summaries.summarise(metrics.with_date(batch), columns)
            known = spark.table(history).select(*new.columns)
            with_stats = partial(summaries.with_group_stats, days=staging.stage(known.unionByName(new)))
        repaired = staging.stage(quality.repair(batch, columns, k=k, with_stats=with_stats))
        keys = [schema.EVENT_TIME, schema.SENSOR]
        # Rows with a NULL key match nothing: those of a run that did not end are taken out.
        stale = F.col(schema.ARRIVAL) > F.timestamp_micros(F.lit(since))
        tables.upsert(spark, repaired, target, keys, check_unique=False, stale=stale)
        dates = metrics.with_date(batch).select("date").distinct()
        _note(spark, target, dates.withColumn("high", F.timestamp_micros(F.lit(high))))


def _utc_days(dates: DataFrame) -> DataFrame:
    """Partitions hold UTC days; a date of the session time zone lies in its neighbours."""
    shifts = F.explode(F.array(*[F.date_add("date", n) for n in (-1, 0, 1)]))
    near = dates.where("date IS NOT NULL").select(shifts.alias(tables.DAY))
    return near.unionByName(dates.where("date IS NULL").select(F.col("date").alias(tables.DAY))).distinct()


def daily_metrics(
    spark: SparkSession,
    *,
    source: str = CLEANED,
    target: str = DAILY,
    dates: Sequence[date | None] | DataFrame | None = None,
    retract: bool = False,
    fmt: str = "parquet",
) -> None:
    """Roll the cleaned readings up per day and upsert them.

    `dates` (a list, or a frame with the column date) limits the work to those. The table is
    partitioned by month: a day of a roll-up is small. `retract` takes out the metrics of a sensor's day
    that has no readings any more; otherwise they stay.
    """
    readings = spark.table(source)
    with staging.scope(spark):
        if dates is not None:
            if not isinstance(dates, DataFrame):
                dates = spark.createDataFrame([Row(date=d) for d in dates], "date date")
            dates = staging.stage(dates.select("date").distinct())
            if tables.day_column(spark, source) is not None:
                readings = tables.on_days_of(readings, _utc_days(dates))
        dated = metrics.with_date(readings)
        if dates is not None:
            wanted = dates.withColumnRenamed("date", "_date")
            dated = dated.join(wanted, F.col("date").eqNullSafe(F.col("_date")), "left_semi")
        daily = staging.stage(metrics.daily_metrics(dated))
        tables.ensure(spark, target, schema.DAILY, day_of="date", fmt=fmt, by="month")
        keys = [schema.SENSOR, "date"]
        gone = None
        if retract:
            held = spark.table(target).select(*keys)
            if dates is not None:
                held = held.join(wanted, F.col("date").eqNullSafe(F.col("_date")), "left_semi")
            same = tables.key_match("held", "daily", keys, null_safe=True)
            gone = staging.stage(held.alias("held").join(daily.alias("daily"), same, "left_anti"))
        tables.upsert(spark, daily, target, keys, check_unique=False, null_safe=True, deletes=gone)


def corrections_table(target: str) -> str:
    """Dates whose metrics in `target` a correction changes, and which corrections are done."""
    return f"{target}_corrections"


def correct(
    spark: SparkSession,
    *,
    upserts: DataFrame | None = None,
    deletes: DataFrame | None = None,
    source: str = CLEANED,
    target: str = DAILY,
    fmt: str = "parquet",
) -> None:
    """Correct cleaned readings, and the metrics of the dates that this changes.

    `upserts` has rows of the cleaned table, `deletes` the time and sensor of rows to take out. A reading
    that belongs to another sensor or time is a delete and an upsert. The dates are noted before anything
    is changed: a correction that was cut off is made up by calling it again, and its dates are rolled up
    again by the next call of any.
    """
    keys = [schema.EVENT_TIME, schema.SENSOR]
    name = corrections_table(target)
    tables.ensure(spark, name, "number long, date date, done boolean")
    with staging.scope(spark):
        empty = spark.table(source).drop(*tables.INTERNAL).where(F.lit(False))
        upserts = staging.stage(empty if upserts is None else upserts)
        deletes = staging.stage(empty.select(*keys) if deletes is None else deletes.select(*keys))
        times = upserts.select(schema.EVENT_TIME).unionByName(deletes.select(schema.EVENT_TIME))
        last = spark.table(name).agg(F.max("number")).first()[0]
        number = F.lit(0 if last is None else last + 1).cast("long")
        dates = metrics.with_date(times).select("date").distinct()
        _note_correction(spark, target, dates.select(number.alias("number"), "date", F.lit(False).alias("done")))
        tables.upsert(spark, upserts, source, keys, deletes=deletes)
        noted = spark.table(name)
        done = noted.where("done").select("number")
        open_ = staging.stage(noted.where("NOT done").join(done, "number", "left_anti").select("number", "date"))
        if not open_.isEmpty():
            daily_metrics(spark, source=source, target=target, dates=open_.select("date"), retract=True, fmt=fmt)
        finished = open_.select("number").distinct()
        _note_correction(spark, target, finished.select("number", F.lit(None).cast("date").alias("date"), F.lit(True).alias("done")))


def _note_correction(spark: SparkSession, target: str, rows: DataFrame) -> None:
    rows.coalesce(1).write.insertInto(corrections_table(target))


def summarise(
    spark: SparkSession,
    *,
    source: str = CLEANED,
    target: str = SUMMARIES,
    columns: Sequence[str] = schema.READINGS,
    dates: Sequence[date | None] | DataFrame | None = None,
    fmt: str = "parquet",
) -> None:
    """Summarise the cleaned readings per sensor, day and column (see `operators.summaries`), and take out
    the summaries of days that have no readings any more. `dates` limits the work to those."""
    readings = spark.table(source)
    with staging.scope(spark):
        if dates is not None:
            if not isinstance(dates, DataFrame):
                dates = spark.createDataFrame([Row(date=d) for d in dates], "date date")
            dates = staging.stage(dates.select("date").distinct())
            if tables.day_column(spark, source) is not None:
                readings = tables.on_days_of(readings, _utc_days(dates))
        dated, wanted = metrics.with_date(readings), None
        if dates is not None:
            wanted = dates.withColumnRenamed("date", "_date")
            dated = dated.join(wanted, F.col("date").eqNullSafe(F.col("_date")), "left_semi")
        days = staging.stage(summaries.summarise(dated, columns))
        tables.ensure(spark, target, days.schema, day_of="date", by="month", fmt=fmt)
        keys = [schema.SENSOR, "date", "column"]
        held = spark.table(target).select(*keys)
        if wanted is not None:
            held = held.join(wanted, F.col("date").eqNullSafe(F.col("_date")), "left_semi")
        same = tables.key_match("held", "days", keys, null_safe=True)
        gone = staging.stage(held.alias("held").join(days.alias("days"), same, "left_anti"))
        tables.upsert(spark, days, target, keys, check_unique=False, null_safe=True, deletes=gone)


def run_all(
    spark: SparkSession,
    path: str | list[str],
    *,
    raw: str = RAW,
    cleaned: str = CLEANED,
    daily: str = DAILY,
    arrival: datetime | str | None = None,
    new_dates_only: bool = False,
    new_files_only: bool = False,
    by_name: bool = False,
    fmt: str = "parquet",
) -> None:
    """The three jobs in order.

    The roll-up covers the whole cleaned table, unless it is limited to the dates of the batches
    that it has not covered yet, also those of earlier runs that stopped before it. `new_files_only`
    leaves out files that an earlier run took.
    """
    ingest(spark, path, table=raw, arrival=arrival, fmt=fmt, once=new_files_only, by_name=by_name)
    clean(spark, source=raw, target=cleaned, fmt=fmt)
    roll_up(spark, source=cleaned, target=daily, new_dates_only=new_dates_only, fmt=fmt)


def tidy(
    spark: SparkSession,
    *,
    raw: str = RAW,
    cleaned: str = CLEANED,
    daily: str = DAILY,
    least: int = 8,
) -> dict[str, int]:
    """Put the small files of the tables and of their notes together, where a partition has `least` of them.

    Every run adds files: one to each note, some to the day of arrival. Returns how many partitions of
    which tables were written anew. No job may run at the same time.
    """
    notes = [ledger.ledger_table(raw), progress_table(cleaned), progress_table(daily), corrections_table(daily)]
    names = [name for name in (raw, cleaned, daily, *notes) if spark.catalog.tableExists(name)]
    return {name: tables.compact(spark, name, least=least) for name in names}


def roll_up(
    spark: SparkSession,
    *,
    source: str = CLEANED,
    target: str = DAILY,
    new_dates_only: bool = False,
    fmt: str = "parquet",
) -> None:
    """The daily metrics of all cleaned readings, or of the dates that no earlier roll-up covers.

    A source that no clean job has filled has no notes of its batches: all its dates are rolled up.
    """
    if not spark.catalog.tableExists(progress_table(source)):
        daily_metrics(spark, source=source, target=target, fmt=fmt)
        return
    noted = spark.table(progress_table(source))
    name = progress_table(target)
    tables.ensure(spark, name, _PROGRESS)
    both = noted.select("high", F.lit(True).alias("own")).unionByName(spark.table(name).select("high", F.lit(False).alias("own")))
    reached, since = both.agg(*[F.unix_micros(F.max(F.when(F.col("own") == own, F.col("high")))) for own in (True, False)]).first()
    if not new_dates_only or since is None:  # without an earlier roll-up all dates are new
        daily_metrics(spark, source=source, target=target, fmt=fmt)
    elif reached == since:
        return
    else:
        new = noted.where(F.col("high") > F.timestamp_micros(F.lit(since)))
        new = new.where(F.col("high") <= F.timestamp_micros(F.lit(reached)))
        daily_metrics(spark, source=source, target=target, dates=new.select("date"), fmt=fmt)
    done = spark.range(1).select(F.timestamp_micros(F.lit(reached)).alias("high"))
    _note(spark, target, done.withColumn("date", F.lit(None).cast("date")))
