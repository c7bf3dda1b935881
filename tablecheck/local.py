"""Small frames from driver-side rows: reports, log and status rows, fixtures."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: Iterable[Sequence], schema: StructType) -> DataFrame:
    """``rows`` as a local relation, which Spark reads without any Python worker."""
    names = schema.fieldNames()
    table = pa.Table.from_pylist(
        [dict(zip(names, row, strict=True)) for row in rows], schema=to_arrow_schema(schema)
    )
    return spark.createDataFrame(table, schema)
