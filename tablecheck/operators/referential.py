"""Phase 3: values that must exist in a reference table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablecheck.fixed_values import REF_INTEGRITY_ERROR
from tablecheck.functions import is_whole_number, quoted, text_column
from tablecheck.operators.report import (
    Check,
    collect_report,
    count_report,
    count_violations,
    in_order,
    report_of_rows,
    union_reports,
    violation,
)
from tablecheck.rules import ColumnRule, Reference

PHASE = 3

# (database, table, column) -> a DataFrame that has the column.
LoadReference = Callable[[str, str, str], DataFrame]


@dataclass(frozen=True)
class ReferenceGroup:
    """The checked columns that share one reference column, with their places in the rules."""

    reference: Reference
    columns: dict[int, str] = field(default_factory=dict)


def format_violations(rules: Sequence[ColumnRule]) -> list[Row]:
    """One row per reference text that is not ``table.column``."""
    return [
        violation(
            PHASE, "reference_format", seq, rule.field_name, REF_INTEGRITY_ERROR, 1,
            f"{rule.field_name}: reference {rule.referential_table_field_name!r}"
            " is not of the form table.column",
        )
        for seq, rule in enumerate(rules)
        if rule.has_reference and rule.reference is None
    ]


def reference_groups(rules: Sequence[ColumnRule]) -> list[ReferenceGroup]:
    """The rules by reference column, so that each one is read once."""
    groups: dict[Reference, ReferenceGroup] = {}
    for seq, rule in enumerate(rules):
        if rule.reference is not None:
            group = groups.setdefault(rule.reference, ReferenceGroup(rule.reference))
            group.columns[seq] = rule.field_name
    return list(groups.values())


def reference_values(reference: DataFrame, column: str) -> DataFrame:
    """The distinct values of a reference column as text, in a column ``value``."""
    return _known_values(reference, column, text_column).distinct()


# (schema, column name) -> the column in the form in which values are compared.
_Form = Callable[[StructType, str], Column]


def _whole_number(schema: StructType, name: str) -> Column:
    return quoted(name).cast("bigint")


def _form(df: DataFrame, columns: Iterable[str], reference: DataFrame, column: str) -> _Form:
    """Values are compared as text; whole numbers on both sides give the same result unconverted."""
    numbers = all(is_whole_number(df.schema, name) for name in columns)
    return _whole_number if numbers and is_whole_number(reference.schema, column) else text_column


def _known_values(reference: DataFrame, column: str, form: _Form) -> DataFrame:
    value = form(reference.schema, column).alias("value")
    return reference.select(value).filter(F.col("value").isNotNull())


@dataclass(frozen=True)
class BroadcastBounds:
    """A reference is broadcast only after its values were counted and measured against both."""

    rows: int = 1_000_000
    size: int = 32 * 1024 * 1024


def is_broadcastable(values: DataFrame, bounds: BroadcastBounds) -> bool:
    """One aggregate counts and measures the values of a reference."""
    text = not is_whole_number(values.schema, "value")
    width = F.octet_length("value") if text else F.lit(8)
    found = values.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("size")).first()
    return found["rows"] <= bounds.rows and (found["size"] or 0) <= bounds.size


def missing_values_report(
    df: DataFrame,
    group: ReferenceGroup,
    reference: DataFrame,
    keep_zero: bool = False,
    bounds: BroadcastBounds = BroadcastBounds(),
) -> DataFrame:
    """For each column of the group, how many of its distinct values the reference lacks.

    A small reference is broadcast and meets the rows themselves, so that only missing values are
    shuffled. A large one meets the distinct values, collapsed before their shuffle; that shuffle is
    on the join key, so the join needs no other, and a value held by many rows weighs no more than
    any other.
    """
    form = _form(df, group.columns.values(), reference, group.reference.column)
    values = _column_values(df, group, form)
    known = _known_values(reference, group.reference.column, form)
    if is_broadcastable(known, bounds):
        missing = _by_value(values.join(F.broadcast(known), "value", "left_anti"), group)
    else:
        missing = _by_value(values, group).join(known.distinct(), "value", "left_anti")
    return count_report(missing, _reference_checks(group), keep_zero)


def _reference_checks(group: ReferenceGroup) -> list[Check]:
    place = f"{group.reference.full_table}.{group.reference.column}"
    return [
        Check(
            PHASE, "reference", seq, name, REF_INTEGRITY_ERROR,
            count_violations(F.col(f"in_{seq}")),
            f"{name}: ", f" values do not exist in {place}",
        )
        for seq, name in group.columns.items()
    ]


def _column_values(df: DataFrame, group: ReferenceGroup, form: _Form) -> DataFrame:
    """(seq, value) for every checked column, without NULLs."""
    values = df.select(
        *[form(df.schema, name).alias(str(seq)) for seq, name in group.columns.items()]
    )
    if len(group.columns) == 1:
        (seq,) = group.columns
        rows = values.toDF("value").withColumn("seq", F.lit(str(seq)))
    else:
        rows = values.unpivot([], list(values.columns), "seq", "value")
    return rows.filter(F.col("value").isNotNull())


def _by_value(rows: DataFrame, group: ReferenceGroup) -> DataFrame:
    """One row per distinct value, telling which columns hold it."""
    return rows.groupBy("value").agg(
        *[F.bool_or(F.col("seq") == str(seq)).alias(f"in_{seq}") for seq in group.columns]
    )


def failed_group(group: ReferenceGroup, error: Exception) -> list[Row]:
    """What a reference that cannot be read leaves: one violation per column that needs it."""
    reason = str(error) or type(error).__name__
    return [
        violation(
            PHASE, "reference", seq, name, REF_INTEGRITY_ERROR, 1,
            f"{name}: could not be checked against {group.reference.full_table} - {reason}",
        )
        for seq, name in group.columns.items()
    ]


@dataclass(frozen=True)
class OpenReference:
    """A reference that could be opened: its values and those of the table, as entries to compare.

    An entry is (reference, number, text): whole numbers on both sides stay numbers, all else is text.
    """

    group: ReferenceGroup
    reference: DataFrame
    of_table: list[Column]
    known: DataFrame


def open_reference(
    df: DataFrame, group: ReferenceGroup, reference: DataFrame, place: int
) -> OpenReference:
    form = _form(df, group.columns.values(), reference, group.reference.column)
    no_number, no_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")

    def entry(schema: StructType, name: str) -> list[Column]:
        value = form(schema, name)
        pair = (value, no_text) if form is _whole_number else (no_number, value)
        return [F.lit(place).alias("reference"), pair[0].alias("number"), pair[1].alias("text")]

    of_table = [
        F.struct(F.lit(seq).alias("seq"), *entry(df.schema, name)) for seq, name in group.columns.items()
    ]
    known = reference.select(
        F.lit(None).cast("int").alias("seq"), *entry(reference.schema, group.reference.column)
    )
    return OpenReference(group, reference, of_table, known.where(_HAS_VALUE))


_HAS_VALUE = "number IS NOT NULL OR text IS NOT NULL"


def missing_in_one_pass(
    df: DataFrame, opened: Sequence[OpenReference], keep_zero: bool = False
) -> DataFrame:
    """All references from one scan of the table, one read of each reference and one shuffle.

    The table's columns and the references' values become entries, which collapse to distinct ones
    before the shuffle and meet in one grouping: an entry that no reference row brought is missing. No
    value is heavier than another, and nothing has to be measured first.
    """
    entries = df.select(F.inline(F.array(*[e for o in opened for e in o.of_table]))).where(_HAS_VALUE)
    both = entries.withColumn("is_known", F.lit(False))
    for o in opened:
        both = both.unionByName(o.known.withColumn("is_known", F.lit(True)))
    seqs = [seq for o in opened for seq in o.group.columns]
    held = [F.bool_or(F.col("seq") == seq).alias(f"in_{seq}") for seq in seqs]
    values = both.groupBy("reference", "number", "text").agg(F.bool_or("is_known").alias("is_known"), *held)
    checks = [check for o in opened for check in _reference_checks(o.group)]
    return count_report(values.where("NOT is_known"), checks, keep_zero)


@dataclass(frozen=True)
class ReferencePlan:
    """Referential checks ready to run: the references that could be opened, rows for the others."""

    df: DataFrame
    opened: list[OpenReference]
    rows: list[Row]
    keep_zero: bool = False
    bounds: BroadcastBounds = BroadcastBounds()

    @property
    def plans(self) -> list[tuple[ReferenceGroup, DataFrame]]:
        """A plan per reference."""
        return [(o.group, self._plan(o)) for o in self.opened]

    def _plan(self, o: OpenReference) -> DataFrame:
        return missing_values_report(self.df, o.group, o.reference, self.keep_zero, self.bounds)

    def together(self) -> list[DataFrame]:
        """One plan for all references, if there are any."""
        return [missing_in_one_pass(self.df, self.opened, self.keep_zero)] if self.opened else []

    def readable(self) -> ReferencePlan:
        """The same without references that break while they are read; those become rows.

        Each reference is read once by itself; the table is not touched.
        """
        opened, rows = [], list(self.rows)
        for o in self.opened:
            try:
                o.known.write.format("noop").mode("overwrite").save()
                opened.append(o)
            except Exception as error:
                rows += failed_group(o.group, error)
        return replace(self, opened=opened, rows=rows)

    def run_each(self) -> list[Row]:
        """Run the plans one by one; a failing reference does not touch the others."""
        rows = list(self.rows)
        for o in self.opened:
            try:
                rows += collect_report(self._plan(o))
            except Exception as error:
                rows += failed_group(o.group, error)
        return in_order(rows)


def plan_references(
    df: DataFrame,
    rules: Sequence[ColumnRule],
    load_reference: LoadReference,
    keep_zero: bool = False,
    bounds: BroadcastBounds = BroadcastBounds(),
) -> ReferencePlan:
    opened, rows = [], format_violations(rules)
    for place, group in enumerate(reference_groups(rules)):
        at = group.reference
        try:
            reference = load_reference(at.database, at.table, at.column)
            opened.append(open_reference(df, group, reference, place))
        except Exception as error:
            rows += failed_group(group, error)
    return ReferencePlan(df, opened, rows, keep_zero, bounds)


def references_report(
    df: DataFrame,
    rules: Sequence[ColumnRule],
    load_reference: LoadReference,
    keep_zero: bool = False,
    bounds: BroadcastBounds = BroadcastBounds(),
) -> DataFrame:
    """All referential checks as one plan: several references in one pass, a single one by its size.

    References that cannot be opened become rows; for one that breaks while it is read, use
    :meth:`ReferencePlan.run_each`.
    """
    spark = df.sparkSession
    plan = plan_references(df, rules, load_reference, keep_zero, bounds)
    reports = plan.together() if len(plan.opened) > 1 else [report for _, report in plan.plans]
    if plan.rows:
        reports.append(report_of_rows(spark, plan.rows))
    return union_reports(spark, reports)
