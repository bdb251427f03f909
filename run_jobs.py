"""Ingest, clean and roll up, for spark-submit."""

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from sensorlake import staging
from sensorlake.plans import jobs


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("path", help="glob of CSV files")
    parser.add_argument("--raw", default=jobs.RAW, help="table of raw readings")
    parser.add_argument("--cleaned", default=jobs.CLEANED, help="table of cleaned readings")
    parser.add_argument("--daily", default=jobs.DAILY, help="table of daily metrics")
    parser.add_argument("--new-dates-only", action="store_true", help="limit the roll-up")
    parser.add_argument("--new-files-only", action="store_true", help="leave out files taken before")
    parser.add_argument("--by-name", action="store_true", help="read files whose headers differ")
    parser.add_argument("--tidy", action="store_true", help="put small files together afterwards")
    parser.add_argument("--fmt", default="parquet", help="format of tables that are made")
    options = vars(parser.parse_args(arguments))
    tidy = options.pop("tidy")
    spark = SparkSession.builder.getOrCreate()
    try:
        jobs.run_all(spark, **options)
        if tidy:
            jobs.tidy(spark, **{layer: options[layer] for layer in ("raw", "cleaned", "daily")})
    finally:
        staging.sweep(spark)


if __name__ == "__main__":
    main()
