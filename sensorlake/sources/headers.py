"""CSV files whose headers differ: columns in another order, left out, or added."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.schema import MEASUREMENT

MOST_HEADERS = 1000  # different headers of one read
_WHOLE = (T.IntegerType, T.LongType)


def escaped(path: str) -> str:
    """A path as a glob that fits this path only."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def headers(spark: SparkSession, path: str | list[str]) -> list[tuple[tuple[str, ...], list[str]]]:
    """The different headers of some files, and the files of each.

    One pass over the lines, as the inference of types makes one; a line per file is shuffled. An empty
    file has no header and no rows.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        # Lines of one part of a file are read in order by one task.
        F.monotonically_increasing_id().alias("place"),
    )
    lines = lines.where("block = 0 AND trim(value) <> ''")
    first = lines.groupBy("path").agg(F.min_by("value", "place").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    held = groups.limit(MOST_HEADERS + 1).collect()
    if len(held) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    found: dict[tuple[str, ...], list[str]] = {}
    for row in held:
        names = tuple(name.strip() for name in next(csv.reader([row["header"].lstrip("﻿")])))
        known = [name.lower() for name in names if name]
        if len(set(known)) < len(known):
            raise ValueError(f"a column name repeats in the header of {row['paths'][0]}: {', '.join(names)}")
        found.setdefault(names, []).extend(unquote(p) for p in row["paths"])
    return sorted(found.items())


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both; text, where no number or time does."""
    if a == b:
        return a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        decimals = [t for t in (a, b) if isinstance(t, T.DecimalType)]
        if decimals and not any(isinstance(t, T.FractionalType) and t not in decimals for t in (a, b)):
            whole = max([t.precision - t.scale for t in decimals] + [19])
            scale = max(t.scale for t in decimals)
            return T.DecimalType(min(38, whole + scale), scale)
        return T.DoubleType()
    if isinstance(a, (T.DateType, T.TimestampType)) and isinstance(b, (T.DateType, T.TimestampType)):
        return T.TimestampType()
    return T.StringType()


def _placed(names: Sequence[str], kinds: dict[str, T.DataType], corrupt: str | None) -> T.StructType:
    """The columns of a file in its own order; those that nobody asked for under names of no use."""
    fields = [
        T.StructField(f"_{i}_" if name.lower() not in kinds else f"_{i}_{name.lower()}", kinds.get(name.lower(), T.StringType()))
        for i, name in enumerate(names)
    ]
    if corrupt is not None:
        fields.append(T.StructField(corrupt, T.StringType()))
    return T.StructType(fields)


def _scan(spark, names, paths, kinds, columns, corrupt) -> DataFrame:
    placed = _placed(names, kinds, corrupt)
    reader = spark.read.option("header", True).schema(placed)
    if corrupt is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    rows = reader.csv([escaped(p) for p in paths])
    at = {name.lower(): field.name for name, field in zip(names, placed.fields)}
    chosen = [
        (F.col(at[name.lower()]) if name.lower() in at else F.lit(None).cast(kinds[name.lower()])).alias(name)
        for name in columns
    ]
    return rows.select(*chosen, *([corrupt] if corrupt is not None else []))


def _inferred(spark: SparkSession, groups) -> tuple[dict[str, T.DataType], list[str]]:
    """The type of every column over all groups, and the names as first written.

    A column without any value in a group says nothing about its type.
    """
    kinds: dict[str, list[tuple[T.DataType, DataFrame, str]]] = {}
    written: dict[str, str] = {}
    for names, paths in groups:
        rows = spark.read.option("header", True).option("inferSchema", True).csv([escaped(p) for p in paths])
        rows = rows.toDF(*[f"_{i}" for i in range(len(rows.columns))])
        for i, name in enumerate(names):
            if name:
                written.setdefault(name.lower(), name)
                kinds.setdefault(name.lower(), []).append((rows.schema[i].dataType, rows, f"_{i}"))
    out = {}
    for name, found in kinds.items():
        if len({kind.simpleString() for kind, _, _ in found}) > 1:
            texts = [f for f in found if isinstance(f[0], T.StringType)]
            empty = [f for f in texts if f[1].where(F.col(f[2]).isNotNull()).isEmpty()]
            found = [f for f in found if f not in empty] or found
        out[name] = reduce(wider, [kind for kind, _, _ in found])
    return out, list(written.values())


def read_csv_by_name(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: T.StructType | None = MEASUREMENT,
    corrupt: str | None = None,
) -> DataFrame:
    """All CSV files of a glob, each with a header of its own, put together by column name.

    Files are grouped by header, and each group is one scan in its own order. Names are compared without
    regard to case and outer spaces. With a schema, the result has its columns: one that a file lacks is
    NULL, one that only a file has is left out, and `corrupt` names a column for lines with a cell that
    does not fit. `schema=None` takes all columns of all files, with the type that holds the values of
    every file (whole numbers become fractions, dates become times, else text).
    """
    groups = headers(spark, path)
    if schema is None:
        kinds, columns = _inferred(spark, groups)
    else:
        kinds = {field.name.lower(): field.dataType for field in schema.fields}
        columns = schema.names
    if not groups:
        kept = schema or T.StructType([])
        kept = kept if corrupt is None else T.StructType([*kept.fields, T.StructField(corrupt, T.StringType())])
        return spark.createDataFrame([], kept)
    scans = [_scan(spark, names, paths, kinds, columns, corrupt) for names, paths in groups]
    return reduce(DataFrame.unionByName, scans)
