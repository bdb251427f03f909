"""Frames stored in buckets, for joins by the same keys that move nothing of them; rows as structs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import staging


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct: joined as such, their names meet no others."""
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in df.columns])


def bucketed(df: DataFrame, *keys: str, dealt: bool = False) -> DataFrame:
    """`df` written once to the shared folder, bucketed by `keys` into as many parts as a shuffle has.

    `dealt` says that an aggregate has just dealt `df` out by the same keys: its parts are the buckets.

    The frame goes through a table, which leaves the catalog at once; its files stay with the other
    staged ones.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = df if dealt else df.repartition(parts, *keys)
    writer = df.write.bucketBy(parts, *keys).option("compression", "zstd")
    with staging.freeing(spark):
        writer.option("path", staging.new_path(spark)).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored
