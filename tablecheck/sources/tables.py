"""Tables and references by name, from files, the catalog or a database."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablecheck.fixed_values import FETCH_SIZE
from tablecheck.functions import quoted
from tablecheck.operators.referential import LoadReference

LoadTable = Callable[[str], DataFrame]

# Rows that one task reads from a database.
ROWS_PER_RANGE = 1_000_000

_SQL_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*)*")


def file_tables(
    spark: SparkSession, root: str, fmt: str = "parquet", schema: StructType | None = None, **options
) -> LoadTable:
    """Tables as files ``root/<name>.<fmt>``, read with the options and the schema, if given."""

    def load(name: str) -> DataFrame:
        reader = spark.read.format(fmt).options(**options)
        return (reader if schema is None else reader.schema(schema)).load(f"{root}/{name}.{fmt}")

    return load


def catalog_tables(spark: SparkSession) -> LoadTable:
    """Tables and views of the session catalog."""
    return spark.table


def file_references(spark: SparkSession, root: str, fmt: str = "parquet", **options) -> LoadReference:
    """References as files ``root/<database>/<table>.<fmt>``."""
    load = file_tables(spark, root, fmt, **options)
    return lambda database, table, column: load(f"{database}/{table}").select(quoted(column))


def catalog_references(spark: SparkSession) -> LoadReference:
    return lambda database, table, column: spark.table(f"{database}.{table}").select(quoted(column))


def range_predicates(
    column: str, lower: int | date, upper: int | date, partitions: int
) -> list[str]:
    """SQL conditions that put every row into exactly one of ``partitions`` key ranges.

    The ranges from ``lower`` to ``upper`` are half-open, of one size rounded up, at least 1; high
    ones may stay empty. The outer ranges are open, so bounds that have become stale lose no row;
    NULL keys go with the first. Times are cut between days.
    """
    _require_name(column)
    if isinstance(lower, datetime):
        lower, upper = lower.date(), upper.date()
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    span = _distance(lower, upper) + 1
    step = max(1, -(-span // partitions))
    cuts = [_literal(_plus(lower, i * step)) for i in range(1, partitions)]
    if not cuts:
        return ["1 = 1"]
    return [
        f"{column} < {cuts[0]} OR {column} IS NULL",
        *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])],
        f"{column} >= {cuts[-1]}",
    ]


def _distance(lower, upper) -> int:
    return (upper - lower).days if isinstance(lower, date) else upper - lower


def _plus(lower, steps: int):
    return lower + timedelta(days=steps) if isinstance(lower, date) else lower + steps


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def cut_query(table: str, column: str, partitions: int) -> str:
    """SQL for the lowest key of each of ``partitions`` parts with equally many rows."""
    _require_name(column)
    return (
        f"SELECT MIN({column}) AS cut FROM (SELECT {column}, NTILE({partitions}) OVER"
        f" (ORDER BY {column}) AS part FROM {_require_name(table)} WHERE {column} IS NOT NULL) parts"
        " GROUP BY part"
    )


def cut_predicates(column: str, cuts: Sequence) -> list[str]:
    """SQL conditions that put every row into exactly one of the ranges between the cuts.

    ``cuts`` are the lowest keys of the ranges, of any type that has an order. The first range is open
    below and the last above, so keys that came later are not lost; NULL keys have a range of their
    own. A key that is the lowest of several parts makes one range.
    """
    _require_name(column)
    edges = [_literal(cut) for cut in sorted(set(cuts))[1:]]
    missing = f"{column} IS NULL"
    if not edges:
        return [f"{column} IS NOT NULL", missing]
    return [
        f"{column} < {edges[0]}",
        *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])],
        f"{column} >= {edges[-1]}",
        missing,
    ]


def _require_name(name: str) -> str:
    if not _SQL_NAME.fullmatch(name):
        raise ValueError(f"{name!r} is not a plain SQL name")
    return name


def jdbc_properties(properties: Mapping[str, str]) -> dict[str, str]:
    """Connection properties with the fetch size set, unless the caller chose one."""
    return {"fetchsize": str(FETCH_SIZE), **properties}


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    key_column: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table; with a key of any ordered type, read in parallel ranges of that key.

    The database cuts the ranges so that each has as many rows; there are as many as the table's rows
    need (``ROWS_PER_RANGE``), unless ``partitions`` says how many.
    """
    _require_name(table)
    options = jdbc_properties(properties)
    if key_column is None:
        warnings.warn(f"{table} is read in one task: no key column was given", stacklevel=2)
        return spark.read.jdbc(url, table, properties=options)

    def ask(query: str) -> list:
        return [row[0] for row in spark.read.jdbc(url, f"({query}) q", properties=options).collect()]

    if partitions is None:
        (n_rows,) = ask(f"SELECT COUNT(*) AS n FROM {table}")
        partitions = max(1, -(-n_rows // ROWS_PER_RANGE))
    cuts = ask(cut_query(table, key_column, partitions))
    predicates = cut_predicates(key_column, cuts)
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def jdbc_tables(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    key_columns: Mapping[str, str] | None = None,
    partitions: int | None = None,
) -> LoadTable:
    """Database tables; ``key_columns`` names the key to split a table on."""
    keys = key_columns or {}
    return lambda name: read_jdbc_table(spark, url, name, properties, keys.get(name), partitions)


def jdbc_references(
    spark: SparkSession, url: str, properties: Mapping[str, str], partitions: int = 1
) -> LoadReference:
    """References from a database, which removes repeated values itself.

    With several ``partitions``, each reads its own range of values; the database cuts them by
    counting. NULL is no value and is not read then.
    """
    options = jdbc_properties(properties)

    def load(database: str, table: str, column: str) -> DataFrame:
        source = _require_name(f"{database}.{table}")
        query = f"(SELECT DISTINCT {_require_name(column)} FROM {source}) ref"
        if partitions == 1:
            return spark.read.jdbc(url, query, properties=options)
        asked = spark.read.jdbc(url, f"({cut_query(source, column, partitions)}) q", properties=options)
        *ranges, _ = cut_predicates(column, [row[0] for row in asked.collect()])
        return spark.read.jdbc(url, query, predicates=ranges, properties=options)

    return load
