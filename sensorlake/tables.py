"""Named tables: create, append, keyed upsert.

Tables made with `day_of` are partitioned by the UTC day of that column, kept in the internal
column DAY that readers drop. Appends then land in few directories, incremental reads skip old
ones, and an upsert reads and rewrites only the days that its source touches.

Tables made with `bucket_of`, for keys without a time, are partitioned by a hash of these columns (the
internal column BUCKET): an upsert reads and rewrites only the buckets that its source touches.

Tables made with `batches` have a partition of its own for each batch of a day (the internal column
BATCH), so that a batch can be written again in place of itself.
"""

import json
import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import staging
from sensorlake.functions import utc_day

DAY = "_day"
BUCKET = "_bucket"
BATCH = "_batch"
INTERNAL = (DAY, BUCKET, BATCH)
MOST_BUCKETS = 10_000  # numbers of touched buckets go through the driver
MOST_DAYS = 1_000  # of an upsert, as literals
_DAY_OF = "sensorlake.day_of"
_BY = "sensorlake.by"
_BUCKET_OF = "sensorlake.bucket_of"
_BUCKETS = "sensorlake.buckets"
_BATCHES = "sensorlake.batches"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_FILE_FORMATS = ("parquet", "orc", "csv", "json", "avro")  # rewritten by files
_MERGE_FORMATS = ("delta", "iceberg", "hudi", "paimon")  # sent a MERGE


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ensure(
    spark: SparkSession,
    name: str,
    schema: str | T.StructType,
    *,
    recreate: bool = False,
    day_of: str | None = None,
    by: str = "day",
    bucket_of: Sequence[str] | None = None,
    buckets: int = 64,
    batches: bool = False,
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Create the table unless it is there; `recreate` drops it first.

    With `by="month"` the partitions hold whole months of `day_of` (DAY is then the first of each).
    `bucket_of` names columns that are part of every upsert's keys. The number of buckets stays as it is:
    choose it for the size that the table will reach, some files' worth of rows to a bucket.
    """
    if day_of is not None and bucket_of is not None:
        raise ValueError("a table is partitioned by day_of or by bucket_of, not by both")
    if batches and day_of is None:
        raise ValueError("batches are kept by day: name day_of")
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"a table has 1 to {MOST_BUCKETS} buckets")
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = schema if isinstance(schema, str) else schema.toDDL()
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}"
    properties, internal = {}, {}
    if day_of is not None:
        properties, internal = {_DAY_OF: day_of, _BY: by}, {DAY: "DATE"}
    if batches:
        properties, internal = {**properties, _BATCHES: "true"}, {**internal, BATCH: "STRING"}
    if bucket_of is not None:
        properties, internal = {_BUCKET_OF: json.dumps(list(bucket_of)), _BUCKETS: str(buckets)}, {BUCKET: "INT"}
    statement += "".join(f", {column} {kind}" for column, kind in internal.items()) + f") USING {fmt}"
    if internal:
        listed = ", ".join(f"'{key}' = '{_escaped(value)}'" for key, value in properties.items())
        statement += f" PARTITIONED BY ({', '.join(internal)}) TBLPROPERTIES ({listed})"
    if location:
        statement += f" LOCATION '{_escaped(location)}'"
    spark.sql(statement)


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _detail(spark: SparkSession, name: str, field: str) -> str:
    """A field of the table's details, which follow its columns (one may have the field's name)."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    header = max(
        (i for i, row in enumerate(described) if row["col_name"].startswith("# Detailed")), default=-1
    )
    details = described[header + 1 :]
    return next((row["data_type"] for row in details if row["col_name"] == field), "")


def day_column(spark: SparkSession, name: str) -> str | None:
    """The column whose day partitions the table, or None."""
    return _properties(spark, name).get(_DAY_OF)


def bucket_columns(spark: SparkSession, name: str) -> list[str] | None:
    """The columns whose hash partitions the table, or None."""
    named = _properties(spark, name).get(_BUCKET_OF)
    return None if named is None else json.loads(named)


def has_batches(spark: SparkSession, name: str) -> bool:
    return _BATCHES in _properties(spark, name)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _with_day(df: DataFrame, day_of: str, by: str | None = None) -> DataFrame:
    day = utc_day(F.col(day_of), df.schema[day_of].dataType.simpleString())
    return df.withColumn(DAY, F.trunc(day, "month") if by == "month" else day)


def _with_bucket(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """Rows whose key has the same values, of the same types, have the same bucket."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in columns]), F.lit(buckets)).cast("int"))


def _placed(df: DataFrame, properties: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """`df` with the internal columns that partition a table of these properties, and their names."""
    if _DAY_OF in properties:
        dated = _with_day(df, properties[_DAY_OF], properties.get(_BY))
        if _BATCHES in properties:
            return dated.withColumn(BATCH, F.lit(None).cast("string")), [DAY, BATCH]
        return dated, [DAY]
    if _BUCKET_OF in properties:
        return _with_bucket(df, json.loads(properties[_BUCKET_OF]), int(properties[_BUCKETS])), [BUCKET]
    return df, []


def _as_stored(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    _refuse_lossy(df, fields)
    return df.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in fields])


def _own_fields(target: DataFrame) -> list[T.StructField]:
    return [f for f in target.schema.fields if f.name not in INTERNAL]


def append(
    df: DataFrame,
    name: str,
    *,
    location: str | None = None,
    day_of: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Append rows, columns matched by name; the table is created when absent."""
    spark = df.sparkSession
    properties: dict[str, str] = {}
    if spark.catalog.tableExists(name):
        properties = _properties(spark, name)
        if _BUCKET_OF in properties and set(df.columns) == {f.name for f in _own_fields(spark.table(name))}:
            df = _as_stored(df, _own_fields(spark.table(name)))  # a hash depends on the type
    elif day_of is not None:
        ensure(spark, name, df.schema, day_of=day_of, fmt=fmt, location=location)
        properties = {_DAY_OF: day_of}
    placed, columns = _placed(df, properties)
    writer = placed.write.partitionBy(*columns) if columns else placed.write
    if location:
        writer = writer.option("path", location)
    writer.format(fmt).mode("append").saveAsTable(name)


def replace_batch(df: DataFrame, name: str, batch: str, arrival: int) -> None:
    """Write the rows of one batch into its own partition, in place of what an earlier attempt left there.

    All rows of a batch have the same stamp, `arrival` (microseconds), so one day holds them; an attempt
    that repeats the stamp finds the same partition. The table was made with `batches`.
    """
    spark = df.sparkSession
    if not has_batches(spark, name):
        raise ValueError(f"{name} was made without batches, so that none of them can be replaced")
    rows = _as_stored(df, _own_fields(spark.table(name)))
    day = (datetime(1970, 1, 1) + timedelta(microseconds=arrival)).date()
    where = f"{DAY} = DATE '{day}', {BATCH} = '{_escaped(batch)}'"
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({where}) SELECT * FROM {{rows}}", rows=rows)


def key_match(source: str, target: str, keys: Sequence[str], *, null_safe: bool = False) -> Column:
    """Equality of all keys between two aliases; NULL keys match nothing, or each other."""
    pairs = [(F.col(f"{source}.{quoted(key)}"), F.col(f"{target}.{quoted(key)}")) for key in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def upsert_frame(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    stale: Column | None = None,
    null_safe: bool = False,
    deletes: DataFrame | None = None,
) -> DataFrame:
    """`target` with the rows of `source` put in place of those with equal keys, or added.

    Target rows with a NULL key match nothing. They bypass the join, which would send all of
    them to one task. `stale` tells which of them to leave out: what an earlier attempt to upsert
    the same rows left behind. With `null_safe`, NULL keys match each other instead. Rows whose keys
    are among `deletes` are left out, unless `source` has the key as well.
    """
    replaced = source.select(*keys)
    if deletes is not None:
        replaced = replaced.unionByName(deletes.select(*keys))
    if null_safe:
        match = key_match("source", "target", keys, null_safe=True)
        rest = target.alias("target").join(replaced.alias("source"), match, "left_anti")
        return rest.unionByName(source.select(*target.columns))
    unmatchable = reduce(or_, [F.col(quoted(key)).isNull() for key in keys])
    kept = (
        target.where(~unmatchable)
        .alias("target")
        .join(replaced.alias("source"), key_match("source", "target", keys), "left_anti")
    )
    passed = target.where(unmatchable if stale is None else unmatchable & ~F.coalesce(stale, F.lit(False)))
    return kept.unionByName(passed).unionByName(source.select(*target.columns))


def _check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    known = source.dropna(subset=list(keys))
    twice = known.groupBy(*keys).count().where(F.col("count") > 1)
    if not twice.isEmpty():
        raise ValueError(f"the source has several rows for one key {list(keys)}")


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    # insertInto follows the session setting only, not a write option.
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def _refuse_lossy(source: DataFrame, fields: Sequence[T.StructField]) -> None:
    """A cast that would cut values off is the caller's to make."""
    whole = ("tinyint", "smallint", "int", "bigint")
    for field in fields:
        given, kept = source.schema[field.name].dataType, field.dataType
        fractional = isinstance(given, T.FractionalType) and isinstance(kept, T.IntegralType)
        names = given.simpleString(), kept.simpleString()
        narrower = names[0] in whole and names[1] in whole and whole.index(names[0]) > whole.index(names[1])
        if fractional or narrower or names == ("double", "float"):
            raise ValueError(f"column {field.name!r} is {names[0]}, and the table holds {names[1]}")


def on_days_of(target: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of a table whose DAY is among `days` (one column DAY, distinct).

    The days go into the plan as literals, so that only their partitions are listed. Beyond MOST_DAYS
    of them only their range does, and the days themselves are joined.
    """
    held = [row[DAY] for row in days.limit(MOST_DAYS + 1).collect()]
    if len(held) <= MOST_DAYS:
        among = F.col(DAY).isin([day for day in held if day is not None])
        return target.where(among | F.col(DAY).isNull() if None in held else among)
    low, high, missing = days.agg(F.min(DAY), F.max(DAY), F.count_if(F.col(DAY).isNull())).first()
    in_range = F.col(DAY).between(F.lit(low), F.lit(high))
    found = target.where(in_range).join(days.where(in_range), DAY, "left_semi").select(*target.columns)
    return found.unionByName(target.where(F.col(DAY).isNull())) if missing else found


def upsert(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    *,
    check_unique: bool = True,
    stale: Column | None = None,
    null_safe: bool = False,
    deletes: DataFrame | None = None,
) -> None:
    """Update the rows with equal keys, insert the others, keep the rest of the table.

    `deletes` has the key columns of rows to take out of the table, unless `df` has the key as well.

    `df` is read several times; hand in a stored or staged frame. A table whose format has MERGE
    gets a MERGE. Otherwise, a table made with `day_of` or `bucket_of` (which must be among the keys, so
    that a key never changes partition) has only the touched days or buckets rewritten, and any other
    table is written anew beside its files and then pointed there. A rewrite of partitions replaces each
    after all data is written, but not all of them at one instant. `stale` tells rows with a NULL
    key that the upsert replaces: those that an attempt which did not end may have added. With
    `null_safe`, NULL keys match each other (for tables where they are few).
    """
    if not keys:
        raise ValueError("an upsert needs key columns")
    if not name or not spark.catalog.tableExists(name):
        raise ValueError(f"there is no table {name!r} to upsert into")
    provider = _detail(spark, name, "Provider").lower()
    if provider not in _FILE_FORMATS + _MERGE_FORMATS:
        raise ValueError(f"{name} has the format {provider or 'of a view'!r}, which cannot be upserted into")
    target = spark.table(name)
    source = _as_stored(df, _own_fields(target))
    if check_unique:
        _check_unique(source, keys)

    properties = _properties(spark, name)
    if _BATCHES in properties:
        raise ValueError(f"{name} is kept by batches, which are replaced as a whole")
    if _DAY_OF in properties and properties[_DAY_OF] not in keys:
        raise ValueError(f"{name} is partitioned by the day of {properties[_DAY_OF]!r}, which is not a key")
    unkeyed = [c for c in json.loads(properties.get(_BUCKET_OF, "[]")) if c not in keys]
    if unkeyed:
        raise ValueError(f"{name} is partitioned by a hash of {unkeyed[0]!r}, which is not a key")
    source, columns = _placed(source, properties)
    if deletes is not None:
        named = [f for f in _own_fields(target) if f.name in keys]
        deletes, _ = _placed(_as_stored(deletes, named), properties)
    if provider in _MERGE_FORMATS:
        _merge(source, name, keys, null_safe, *([] if deletes is None else [deletes]))
        return
    if not columns:
        rows = upsert_frame(target, source, keys, stale=stale, null_safe=null_safe, deletes=deletes)
        _rewrite_table(spark, rows, name, provider)
        return
    (column,) = columns
    places = source.select(column)
    if deletes is not None:
        places = places.unionByName(deletes.select(column))
    touched = touched_days(target, places) if column == DAY else touched_buckets(target, places)
    merged = upsert_frame(touched, source, keys, stale=stale, null_safe=null_safe, deletes=deletes)
    emptied = [] if deletes is None else _emptied(merged, deletes, column)
    with _dynamic_overwrite(spark):
        dealt = evenly_by_day(merged) if column == DAY else evenly(merged, column)
        dealt.write.insertInto(name, overwrite=True)
    for place in emptied:  # an overwrite leaves alone what it writes no row to
        none = spark.createDataFrame([], T.StructType(_own_fields(target)))
        shown = "NULL" if place is None else f"DATE '{place}'" if column == DAY else place
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({column} = {shown}) SELECT * FROM {{none}}", none=none)


def _emptied(merged: DataFrame, deletes: DataFrame, column: str) -> list:
    """The partitions of `deletes` in which no row is left; at most as many as it touches."""
    left = merged.select(F.col(column).alias("_left")).distinct()
    touched = deletes.select(column).distinct()
    gone = touched.join(left, F.col(column).eqNullSafe(F.col("_left")), "left_anti")
    return [row[column] for row in gone.collect()]


def touched_days(target: DataFrame, source: DataFrame) -> DataFrame:
    """The rows of `target` on the days that `source` touches; both have DAY."""
    return on_days_of(target, source.select(DAY).distinct())


def touched_buckets(target: DataFrame, source: DataFrame) -> DataFrame:
    """The rows of `target` in the buckets that `source` touches; both have BUCKET.

    Their numbers, no more than the table has buckets, go into the plan, so that the others are not listed.
    """
    numbers = [row[BUCKET] for row in source.select(BUCKET).distinct().collect()]
    return target.where(F.col(BUCKET).isin(numbers))


def evenly(df: DataFrame, column: str) -> DataFrame:
    """Dealt out so that files come in an even size: small partitions are put together in one task, a hot
    one is split over several. Without adaptive execution, a partition is one task's."""
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", F.col(column))
    return df.repartition(F.col(column))


def evenly_by_day(df: DataFrame) -> DataFrame:
    return evenly(df, DAY)


def _merge(
    source: DataFrame, name: str, keys: Sequence[str], null_safe: bool = False, deletes: DataFrame | None = None
) -> None:
    values = {column: F.col(f"source.{quoted(column)}") for column in source.columns}
    match = key_match("source", name, keys, null_safe=null_safe)
    if deletes is None:
        merge = source.alias("source").mergeInto(name, match)
        merge.whenMatched().update(values).whenNotMatched().insert(values).merge()
        return
    only = key_match("gone", "kept", keys, null_safe=null_safe)
    gone = deletes.distinct().alias("gone").join(source.select(*keys).alias("kept"), only, "left_anti")
    both = source.withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
    merge = both.alias("source").mergeInto(name, match)
    merge = merge.whenMatched(F.col("source._gone")).delete().whenMatched().update(values)
    merge.whenNotMatched(~F.col("source._gone")).insert(values).merge()


def _rewrite_table(spark: SparkSession, merged: DataFrame, name: str, provider: str) -> None:
    """Write a new folder beside the old one, point the table there, delete the old one last."""
    old = _detail(spark, name, "Location").rstrip("/")
    new = f"{re.sub('--[0-9a-f]{32}$', '', old)}--{uuid.uuid4().hex}"
    try:
        merged.write.format(provider).save(new)
    except Exception:
        staging.drop(spark, new)
        raise
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{_escaped(new)}'")
    spark.catalog.refreshTable(name)
    staging.drop(spark, old)


def compact(spark: SparkSession, name: str, *, least: int = 8, size: int | None = None) -> int:
    """Put small files together, where a table or one of its partitions has `least` or more of them.

    Small is below half of `size` (by default the advised size of a partition). Returns the number of
    partitions written anew (1 for a table without partitions). Rows stay as they are. A table without
    partitions is written beside its files and then pointed there, so readers see the old files or the
    new ones; partitions are replaced one after the other, as by an upsert. No writer at the same time.
    """
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    provider = _detail(spark, name, "Provider").lower()
    if provider not in _FILE_FORMATS:
        raise ValueError(f"{name} has the format {provider or 'of a view'!r}, whose files are not ours")
    size = size or _bytes(spark, spark.conf.get(setting))
    columns = [c for c in INTERNAL if c in spark.table(name).columns]
    files = _files(spark, name).where(F.col("length") < size // 2)
    folders = files.groupBy("folder").agg(F.count(F.lit(1)).alias("small")).where(F.col("small") >= least)
    crowded = [row["folder"] for row in folders.select("folder").collect()]  # no more than partitions
    if not crowded:
        return 0
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(size))
    try:
        if not columns:
            _rewrite_table(spark, spark.table(name).hint("rebalance"), name, provider)
            return 1
        values = [tuple(_partition_value(folder, c) for c in columns) for folder in crowded]
        chosen = [reduce(and_, [F.col(c).cast("string").eqNullSafe(F.lit(v)) for c, v in zip(columns, row)]) for row in values]
        with _dynamic_overwrite(spark):
            rows = spark.table(name).where(reduce(or_, chosen)).hint("rebalance", *[F.col(c) for c in columns])
            rows.write.insertInto(name, overwrite=True)
        return len(crowded)
    finally:
        spark.conf.set(setting, before)


def _files(spark: SparkSession, name: str) -> DataFrame:
    """folder (below the table's), length of its data files; none is opened."""
    location = _detail(spark, name, "Location").rstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
    below = F.regexp_extract("path", "((?:/[^/=]+=[^/]*)*)/[^/]+$", 1)
    return listed.select(below.alias("folder"), "length")


def _partition_value(folder: str, column: str) -> str | None:
    text = unquote(next(part for part in folder.split("/") if part.startswith(f"{column}=")).split("=", 1)[1])
    return None if text == "__HIVE_DEFAULT_PARTITION__" else text


def _bytes(spark: SparkSession, text: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)
