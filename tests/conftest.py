import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorlake import staging  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sensorlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    staging.sweep(session)
    session.stop()


@pytest.fixture
def name(spark, request):
    """A table name of the test's own; the table is dropped afterwards."""
    table = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name)[:60]
    yield table
    for left in spark.catalog.listTables():
        if left.name.startswith(table.lower()):
            spark.sql(f"DROP TABLE IF EXISTS {left.name}")
