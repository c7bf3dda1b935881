"""Phase 4: business rules over rows and over groups of rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.fixed_values import (
    CELL_COLUMN,
    COLUMN_PREFIX,
    CURRENCY_PREFIX,
    FUNCTIONAL_ERROR,
    GROUP_COLUMNS,
    NAME_COLUMN,
    PREFIXED_COLUMN,
    REQUIRED_NAMES,
)
from tablecheck.functions import lacks_prefix, outside_cell_range, quoted, text_column
from tablecheck.functions.columns import field_of
from tablecheck.operators.report import (
    Check,
    count_report,
    count_violations,
    scan_report,
    union_reports,
)

PHASE = 4


@dataclass(frozen=True)
class ExactlyOne:
    """In each group every required name occurs exactly once.

    Groups without any of the names do not count, unless ``include_empty_groups``.
    """

    group_cols: tuple[str, ...]
    name_col: str
    required: tuple[str, ...]
    include_empty_groups: bool = False


@dataclass(frozen=True)
class AtLeastOne:
    """In each group at least one name starts with the prefix, ignoring case."""

    group_cols: tuple[str, ...]
    name_col: str
    prefix: str


@dataclass(frozen=True)
class StartsWith:
    """Values that are not blank start with the prefix, which minds case."""

    column: str
    prefix: str


@dataclass(frozen=True)
class CellInRange:
    """Cell names that are not blank lie inside the table; its own size unless given."""

    column: str
    n_cols: int | None = None
    n_rows: int | None = None


BusinessRule = ExactlyOne | AtLeastOne | StartsWith | CellInRange

DEFAULT_RULES: tuple[BusinessRule, ...] = (
    ExactlyOne(GROUP_COLUMNS, NAME_COLUMN, REQUIRED_NAMES),
    AtLeastOne(GROUP_COLUMNS, NAME_COLUMN, CURRENCY_PREFIX),
    StartsWith(PREFIXED_COLUMN, COLUMN_PREFIX),
    CellInRange(CELL_COLUMN),
)


def row_checks(
    schema: T.StructType, rules: Sequence[BusinessRule], n_cols: int, n_rows: int
) -> list[Check]:
    """The rules that look at one row at a time."""
    checks = []
    for place, rule in zip(_places(rules), rules):
        if isinstance(rule, StartsWith):
            broken = lacks_prefix(text_column(schema, rule.column), rule.prefix)
            name, after = "starts_with", f" values do not start with {rule.prefix!r}"
        elif isinstance(rule, CellInRange):
            cols = n_cols if rule.n_cols is None else rule.n_cols
            rows = n_rows if rule.n_rows is None else rule.n_rows
            broken = outside_cell_range(text_column(schema, rule.column), cols, rows)
            name, after = "cell_range", f" cells are outside {cols} columns x {rows} rows"
        else:
            continue
        checks.append(
            Check(
                PHASE, name, place, rule.column, FUNCTIONAL_ERROR,
                count_violations(broken), f"{rule.column}: ", after,
            )
        )
    return checks


def group_reports(
    df: DataFrame, rules: Sequence[BusinessRule], keep_zero: bool = False
) -> list[DataFrame]:
    """The rules that look at groups, all of them from one scan and one shuffle."""
    by_columns: dict[tuple[str, ...], list[tuple[int, ExactlyOne | AtLeastOne]]] = {}
    for place, rule in zip(_places(rules), rules):
        if isinstance(rule, (ExactlyOne, AtLeastOne)):
            columns = tuple(field_of(df.schema, name).name for name in rule.group_cols)
            by_columns.setdefault(columns, []).append((place, rule))
    if not by_columns:
        return []
    if len(by_columns) == 1:
        ((group_cols, placed),) = by_columns.items()
        return [_grouped_report(df, group_cols, placed, keep_zero)]
    return [_grouping_sets_report(df, by_columns, keep_zero)]


def _grouped_report(df, group_cols, placed, keep_zero) -> DataFrame:
    """Per-group counts are combined before the shuffle, so large groups are no heavier than small."""
    per_group, checks = [], []
    for place, rule in placed:
        counters, rule_checks = _counters(df.schema, place, rule, "rule")
        per_group += counters
        checks += rule_checks
    # Grouping columns get names by place: a table may call its columns anything.
    keys = [quoted(name).alias(f"k{i}") for i, name in enumerate(group_cols)]
    return count_report(_taking_part(df, placed).groupBy(*keys).agg(*per_group), checks, keep_zero)


def _grouping_sets_report(df, by_columns, keep_zero) -> DataFrame:
    """Rules over different group columns: each row counts once for every set of them, partial counts
    are combined before one shuffle, and a rule looks at the groups of its own set only."""
    names = list(dict.fromkeys(name for columns in by_columns for name in columns))
    # Columns keep their names here: the counters get some that the table has not.
    prefix = "rule"
    while any(name.lower().startswith(prefix) for name in df.columns):
        prefix += "_"
    set_no = F.col(f"{prefix}set")
    per_group, checks = [], []
    for columns, placed in by_columns.items():
        left_out = sum(1 << i for i, name in enumerate(reversed(names)) if name not in columns)
        for place, rule in placed:
            counters, rule_checks = _counters(df.schema, place, rule, prefix, set_no == left_out)
            per_group += counters
            checks += rule_checks
    rows = _taking_part(df, [placed for of_set in by_columns.values() for placed in of_set])
    sets = [[quoted(name) for name in columns] for columns in by_columns]
    groups = rows.groupingSets(sets, *[quoted(name) for name in names])
    counted = groups.agg(F.grouping_id().alias(f"{prefix}set"), *per_group)
    return count_report(counted, checks, keep_zero)


def _taking_part(df, placed) -> DataFrame:
    """Rows with names that no rule looks for are left at the scan, if no rule counts their groups."""
    if not all(isinstance(rule, ExactlyOne) and not rule.include_empty_groups for _, rule in placed):
        return df
    return df.filter(
        reduce(or_, [text_column(df.schema, r.name_col).isin(*r.required) for _, r in placed])
    )


def _counters(
    schema, place: int, rule: ExactlyOne | AtLeastOne, prefix: str, of_set: Column | None = None
) -> tuple[list[Column], list[Check]]:
    """Counts per group, and the checks on them; ``of_set`` tells the groups of the rule."""
    plan = _exactly_one if isinstance(rule, ExactlyOne) else _at_least_one
    return plan(schema, place, rule, prefix, F.lit(True) if of_set is None else of_set)


def _exactly_one(
    schema, place: int, rule: ExactlyOne, prefix: str, of_set: Column
) -> tuple[list[Column], list[Check]]:
    name = text_column(schema, rule.name_col)
    counters = {value: f"{prefix}{place}_{i}" for i, value in enumerate(rule.required)}
    per_group = [
        F.count(F.when(name == value, True)).alias(alias) for value, alias in counters.items()
    ]
    taken = F.lit(True)
    if not rule.include_empty_groups:
        taken = reduce(or_, [F.col(alias) > 0 for alias in counters.values()])
    checks = [
        Check(
            PHASE, "exactly_one", place + i, rule.name_col, FUNCTIONAL_ERROR,
            count_violations(of_set & taken & (F.col(alias) != 1)),
            f"{rule.name_col}={value!r}: ",
            f" groups ({', '.join(rule.group_cols)}) do not have exactly one row",
        )
        for i, (value, alias) in enumerate(counters.items())
    ]
    return per_group, checks


def _at_least_one(
    schema, place: int, rule: AtLeastOne, prefix: str, of_set: Column
) -> tuple[list[Column], list[Check]]:
    name, alias = F.lower(text_column(schema, rule.name_col)), f"{prefix}{place}"
    found = F.bool_or(name.startswith(rule.prefix.lower())).alias(alias)
    check = Check(
        PHASE, "at_least_one", place, rule.name_col, FUNCTIONAL_ERROR,
        count_violations(of_set & ~F.coalesce(F.col(alias), F.lit(False))),
        f"{rule.name_col} starting with {rule.prefix!r}: ",
        f" groups ({', '.join(rule.group_cols)}) have no row",
    )
    return [found], [check]


def _places(rules: Sequence[BusinessRule]) -> list[int]:
    """The first place of each rule among all checks of a rule list; a rule has one per name."""
    sizes = [len(r.required) if isinstance(r, ExactlyOne) else 1 for r in rules]
    return list(accumulate(sizes, initial=0))[:-1]


def business_report(
    df: DataFrame,
    rules: Sequence[BusinessRule] = DEFAULT_RULES,
    n_rows: int | None = None,
    keep_zero: bool = False,
) -> DataFrame:
    """All business rules, none stopping another: one scan for the rows, one shuffle per grouping."""
    spark = df.sparkSession
    needs_size = any(isinstance(rule, CellInRange) and rule.n_rows is None for rule in rules)
    if n_rows is None:
        n_rows = df.count() if needs_size else 0
    by_row = row_checks(df.schema, rules, len(df.columns), n_rows)
    reports = [scan_report(df, by_row, keep_zero)] if by_row else []
    return union_reports(spark, reports + group_reports(df, rules, keep_zero))
