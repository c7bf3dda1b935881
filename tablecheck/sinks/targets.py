"""Where log and status rows go. A target is anything that takes a DataFrame and appends it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

Sink = Callable[[DataFrame], None]


def file_sink(path: str, fmt: str = "parquet", **options) -> Sink:
    """Append to a folder; each batch is a few rows, hence one file."""
    return lambda df: df.coalesce(1).write.mode("append").format(fmt).options(**options).save(path)


def table_sink(name: str) -> Sink:
    return lambda df: df.coalesce(1).write.mode("append").saveAsTable(name)


def jdbc_sink(url: str, table: str, properties: Mapping[str, str]) -> Sink:
    return lambda df: df.coalesce(1).write.jdbc(
        url, table, mode="append", properties=dict(properties)
    )


def overwrite_jdbc_table(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], column_types: str | None = None
) -> None:
    """Replace a database table; ``column_types`` such as ``"code VARCHAR(50)"`` override its DDL."""
    writer = df.write.mode("overwrite")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, table, properties=dict(properties))
