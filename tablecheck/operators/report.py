"""Counts as report rows."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tablecheck.local import local_frame
from tablecheck.schemas import REPORT_SCHEMA

# Order of the checks inside a phase; the others of a phase go by ``seq`` alone.
_STAGES = ("data_type", "not_null", "max_length", "primary_key", "reference_format", "reference")

# A good number of checks per aggregate for columnar files, whose columns are read by one part each.
# Compiled code stays small enough to be fast: of 72 checks over 34 columns, two aggregates took 15%
# less time than one; of 670 over 300, many took half as long as one. Beyond 100 fields
# (spark.sql.codegen.maxFields) Spark neither vectorizes the scan nor compiles the aggregate.
COLUMNAR_CHECKS_PER_SCAN = 40

_LABELS = (
    "struct<phase: int, check_name: string, seq: int, column_name: string, error_type: string,"
    " before: string, after: string>"
)


@dataclass(frozen=True)
class Check:
    """One condition and the aggregate that counts its violations.

    ``count`` is 0 instead of a column where the table's own schema rules violations out.
    The message is ``before``, the count, ``after``.
    """

    phase: int
    check_name: str
    seq: int
    column_name: str
    error_type: str
    count: Column | int
    before: str
    after: str

    def labels(self) -> dict:
        """Everything but the count."""
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "count"}


def count_violations(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def scan_report(
    df: DataFrame,
    checks: Sequence[Check],
    keep_zero: bool = False,
    checks_per_scan: int | None = None,
) -> DataFrame:
    """All counts over the rows of a table in one scan, one report row for each.

    ``checks_per_scan`` cuts them by column into several aggregates. That pays for columnar files, of
    which each part reads its own columns; any other source would be read as a whole by each part.
    """
    parts = [list(checks)] if checks_per_scan is None else _parts(checks, checks_per_scan)
    reports = [count_report(df, part, keep_zero) for part in parts if part]
    return union_reports(df.sparkSession, reports)


def counted_scan(df: DataFrame, checks: Sequence[Check]) -> tuple[int, list[Row]]:
    """The number of rows and the violations of all checks, from one scan of the table."""
    if not any(isinstance(check.count, Column) for check in checks):
        return df.count(), []
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("n_rows"))
    rows = collect_report(scan_report(observed, checks))
    return counted.get["n_rows"], rows


def _parts(checks: Sequence[Check], checks_per_scan: int) -> list[list[Check]]:
    """The checks in order of their columns, cut between columns."""
    by_column: dict[str, list[Check]] = {}
    for check in checks:
        by_column.setdefault(check.column_name, []).append(check)
    parts: list[list[Check]] = []
    for of_column in by_column.values():
        if not parts or len(parts[-1]) + len(of_column) > checks_per_scan:
            parts.append([])
        parts[-1] += of_column
    return parts


def count_report(df: DataFrame, checks: Sequence[Check], keep_zero: bool = False) -> DataFrame:
    """All counts in one aggregate over ``df``, one report row for each."""
    zero = F.lit(0).cast("bigint")
    counted = {i: c.count for i, c in enumerate(checks) if isinstance(c.count, Column)}
    totals = df.agg(zero.alias("none"), *[n.alias(f"n{i}") for i, n in counted.items()])
    counts = F.array(*[f"n{i}" if i in counted else "none" for i in range(len(checks))])
    # Everything but the counts is known here and travels as one literal.
    known = F.from_json(F.lit(json.dumps([c.labels() for c in checks])), f"array<{_LABELS}>")
    rows = totals.select(F.posexplode(counts).alias("place", "n_violations")).select(
        F.element_at(known, F.col("place") + 1).alias("of"), "n_violations"
    )
    report = rows.select(
        "of.phase",
        "of.check_name",
        "of.seq",
        "of.column_name",
        "of.error_type",
        "n_violations",
        F.concat("of.before", "n_violations", "of.after").alias("error_message"),
    )
    return report if keep_zero else report.filter("n_violations > 0")


def empty_report(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [], REPORT_SCHEMA)


def report_of_rows(spark: SparkSession, rows: Sequence[Row]) -> DataFrame:
    return local_frame(spark, rows, REPORT_SCHEMA)


def violation(phase, check_name, seq, column_name, error_type, n_violations, message) -> Row:
    """A report row that needed no counting."""
    return Row(*REPORT_SCHEMA.fieldNames())(
        phase, check_name, seq, column_name, error_type, n_violations, message
    )


def union_reports(spark: SparkSession, reports: Sequence[DataFrame]) -> DataFrame:
    """One plan for several reports, so that one action runs their stages side by side."""
    return reduce(DataFrame.unionByName, reports) if reports else empty_report(spark)


def collect_report(report: DataFrame) -> list[Row]:
    """Report rows in order. Their number is that of the rules, never that of the data."""
    return in_order(report.select(*REPORT_SCHEMA.fieldNames()).collect())


def in_order(rows: Iterable[Row]) -> list[Row]:
    """By phase, then kind of check, then place in the rules."""

    def place(row: Row) -> tuple:
        stage = _STAGES.index(row.check_name) if row.check_name in _STAGES else 0
        return row.phase, stage, row.seq

    return sorted(rows, key=place)
