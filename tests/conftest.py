import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tablecheck-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def text(spark):
    """text(("a", "b"), [(1, 2), ...]) -> a frame of text columns."""
    from pyspark.sql.types import StringType, StructField, StructType

    from tablecheck.local import local_frame

    def build(names, rows):
        names = (names,) if isinstance(names, str) else names
        schema = StructType([StructField(n, StringType()) for n in names])
        rows = [row if isinstance(row, tuple) else (row,) for row in rows]
        return local_frame(spark, rows, schema)

    return build


@pytest.fixture(scope="session")
def counts():
    """counts(report) -> {(check name, column): violations}."""

    def read(report):
        return {(r.check_name, r.column_name): r.n_violations for r in report.collect()}

    return read
