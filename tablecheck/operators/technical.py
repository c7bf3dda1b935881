"""Phase 2: data types, mandatory values, lengths and the primary key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.fixed_values import DATA_TYPE_ERROR, LENGTH_ERROR, NOT_NULL_ERROR, PK_ERROR
from tablecheck.functions import (
    blank_column,
    is_date,
    is_whole_number,
    not_a_date,
    not_a_decimal,
    not_an_int,
    quoted,
    text_column,
    too_long,
)
from tablecheck.functions.columns import field_of
from tablecheck.operators.report import (
    Check,
    count_report,
    count_violations,
    empty_report,
    scan_report,
)
from tablecheck.rules import ColumnRule, LogicalType, RuleError, primary_key

PHASE = 2
# Suspected fingerprints that are broadcast to confirm a key: 12 bytes each, so at most 12 MB.
CONFIRM_ROWS = 1_000_000
_HASHED_ALIKE = (
    T.IntegralType,
    T.DecimalType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def type_checks(schema: T.StructType, rules: Iterable[ColumnRule]) -> list[Check]:
    """One check per column with a testable type."""
    checks = []
    for seq, rule in enumerate(rules):
        kind = rule.logical_type
        if kind is None:
            continue
        checks.append(
            Check(
                PHASE, "data_type", seq, rule.field_name, DATA_TYPE_ERROR,
                _type_violations(schema, rule.field_name, kind),
                f"{rule.field_name}: ", f" values are not a valid {kind.name}",
            )
        )
    return checks


def _type_violations(schema: T.StructType, name: str, kind: LogicalType) -> Column | int:
    value = text_column(schema, name)
    if kind.name == "DATE":
        if is_date(schema, name):
            return 0
        return count_violations(not_a_date(value, kind.date_format))
    if is_whole_number(schema, name):
        return 0
    broken = not_an_int(value) if kind.name == "INT" else not_a_decimal(value)
    return count_violations(broken)


def null_checks(schema: T.StructType, rules: Iterable[ColumnRule]) -> list[Check]:
    """One check per mandatory column."""
    return [
        Check(
            PHASE, "not_null", seq, rule.field_name, NOT_NULL_ERROR,
            count_violations(blank_column(schema, rule.field_name)),
            f"{rule.field_name}: ", " values are null or blank",
        )
        for seq, rule in enumerate(rules)
        if not rule.nullable
    ]


def length_checks(schema: T.StructType, rules: Iterable[ColumnRule]) -> list[Check]:
    """One check per column with a maximum length."""
    return [
        Check(
            PHASE, "max_length", seq, rule.field_name, LENGTH_ERROR,
            count_violations(too_long(text_column(schema, rule.field_name), limit)),
            f"{rule.field_name}: ", f" values are longer than {limit}",
        )
        for seq, rule in enumerate(rules)
        if (limit := rule.max_length) is not None
    ]


def check_date_formats(
    spark: SparkSession, schema: T.StructType, rules: Iterable[ColumnRule]
) -> None:
    """Raise :class:`RuleError` for a date format Spark cannot parse, before any data is read.

    Columns that are stored as dates or times are not parsed; their format does not matter.
    """
    formats = {
        kind.date_format: rule.field_name
        for rule in rules
        if (kind := rule.logical_type)
        and kind.date_format is not None
        and not is_date(schema, rule.field_name)
    }
    for date_format, name in formats.items():
        probe = spark.sql("SELECT try_to_date('2000-01-01', :f) AS d", args={"f": date_format})
        try:
            probe.collect()
        except Exception as error:
            raise RuleError(f"{name}: {date_format!r} is not a date format") from error


def data_types_report(df: DataFrame, rules: Sequence[ColumnRule], keep_zero: bool = False) -> DataFrame:
    check_date_formats(df.sparkSession, df.schema, rules)
    return scan_report(df, type_checks(df.schema, rules), keep_zero)


def not_null_report(df: DataFrame, rules: Sequence[ColumnRule], keep_zero: bool = False) -> DataFrame:
    return scan_report(df, null_checks(df.schema, rules), keep_zero)


def max_length_report(df: DataFrame, rules: Sequence[ColumnRule], keep_zero: bool = False) -> DataFrame:
    return scan_report(df, length_checks(df.schema, rules), keep_zero)


def primary_key_report(df: DataFrame, columns: Sequence[str], keep_zero: bool = False) -> DataFrame:
    """Rows beyond the first of each key; NULL is a key value like any other.

    The key is grouped in its stored type, and copies of a key collapse before the shuffle, so a key
    that holds a large share of the rows costs each reducer one row per map task.
    """
    return _surplus_report(df, columns, [quoted(name) for name in columns], keep_zero)


def suspected_key_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Like :func:`primary_key_report`, over fingerprints of 96 bits instead of the keys.

    Equal keys have equal fingerprints: an empty report proves the key unique, with about half the
    shuffle that wide keys need. Anything else has to be counted on the keys.
    """
    key = [quoted(name) for name in columns]
    return _surplus_report(df, columns, [F.xxhash64(*key), F.hash(*key)], keep_zero=False)


def confirmed_key_report(df: DataFrame, columns: Sequence[str], suspected: int) -> DataFrame:
    """:func:`primary_key_report` after ``suspected`` surplus rows by fingerprint.

    Only rows whose fingerprint occurs more than once can repeat a key. As long as there are few such
    fingerprints (at most ``suspected``), they are broadcast, and the keys of all other rows stay where
    they are; beyond, all keys are grouped.
    """
    if suspected > CONFIRM_ROWS:
        return primary_key_report(df, columns)
    key = [quoted(name) for name in columns]
    prints = df.select(
        *[k.alias(f"k{i}") for i, k in enumerate(key)],
        F.xxhash64(*key).alias("print_a"),
        F.hash(*key).alias("print_b"),
    )
    repeated = prints.groupBy("print_a", "print_b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = prints.join(F.broadcast(repeated.drop("n")), ["print_a", "print_b"], "left_semi")
    return _surplus_report(rows, columns, [F.col(f"k{i}") for i in range(len(key))], keep_zero=False)


def fingerprints_pay(schema: T.StructType, columns: Sequence[str]) -> bool:
    """Wide keys, of types whose equal values are sure to hash alike."""
    kinds = [field_of(schema, name).dataType for name in columns]
    text = [kind for kind in kinds if kind == T.StringType()]
    return (bool(text) or len(kinds) > 2) and all(
        kind in text or isinstance(kind, _HASHED_ALIKE) for kind in kinds
    )


def _surplus_report(df, columns, key: list[Column], keep_zero: bool) -> DataFrame:
    if not columns:
        return empty_report(df.sparkSession)
    # Grouping columns get names by place: a table may call its columns anything.
    placed = [part.alias(f"k{i}") for i, part in enumerate(key)]
    copies = df.groupBy(*placed).agg((F.count(F.lit(1)) - 1).alias("surplus"))
    check = Check(
        PHASE, "primary_key", 0, ",".join(columns), PK_ERROR,
        F.coalesce(F.sum("surplus"), F.lit(0).cast("bigint")),
        f"key ({', '.join(columns)}): ", " surplus rows",
    )
    return count_report(copies, [check], keep_zero)


def row_level_checks(schema: T.StructType, rules: Sequence[ColumnRule]) -> list[Check]:
    """Everything of this phase that one scan can count."""
    return [
        *type_checks(schema, rules),
        *null_checks(schema, rules),
        *length_checks(schema, rules),
    ]


def technical_report(df: DataFrame, rules: Sequence[ColumnRule], keep_zero: bool = False) -> DataFrame:
    """All technical checks, ungated: one scan for the rows, one shuffle for the key."""
    check_date_formats(df.sparkSession, df.schema, rules)
    rows = scan_report(df, row_level_checks(df.schema, rules), keep_zero)
    key = primary_key(rules)
    return rows.unionByName(primary_key_report(df, key, keep_zero)) if key else rows
