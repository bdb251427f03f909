"""Raw CSV files, named tables and tables addressed by directory."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sensorlake.schema import MEASUREMENT
from sensorlake.tables import INTERNAL

CORRUPT = "_corrupt_record"


def read_measurements_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: T.StructType | None = MEASUREMENT,
    corrupt: str | None = None,
) -> DataFrame:
    """All CSV files of a glob, with a header row, in one scan.

    With a schema the files are read once, and a file whose header differs from it fails the
    read instead of shifting columns. `corrupt` names a column that keeps the raw line when a
    cell does not fit its type (the cell itself becomes NULL). `schema=None` infers the types,
    which reads the files one more time.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A named table without its internal partition columns."""
    return spark.table(name).drop(*INTERNAL)


def read_path(spark: SparkSession, path: str, *, fmt: str = "parquet") -> DataFrame:
    """A stored table by directory, without its internal partition columns."""
    return spark.read.format(fmt).load(path).drop(*INTERNAL)


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows of a table; nothing more of it is read."""
    return df.limit(rows)
