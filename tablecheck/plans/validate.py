"""All phases over one table, each phase only where the one before found nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Literal

from pyspark.sql import DataFrame, Row, SparkSession

from tablecheck.fixed_values import (
    ALL_COLUMNS,
    COMPLETED,
    FUNCTIONAL_FAILED,
    PROCESSING,
    REFERENCES_FAILED,
    REFERENCES_OK,
    STRUCTURE_FAILED,
    STRUCTURE_MISMATCH,
    STRUCTURE_OK,
    TECHNICAL_FAILED,
    TECHNICAL_OK,
)
from tablecheck.operators import functional, referential, technical
from tablecheck.operators.functional import DEFAULT_RULES, BusinessRule
from tablecheck.operators.referential import LoadReference, ReferencePlan
from tablecheck.operators.report import (
    Check,
    collect_report,
    counted_scan,
    in_order,
    report_of_rows,
    scan_report,
    union_reports,
    violation,
)
from tablecheck.operators.structure import check_structure
from tablecheck.rules import ColumnRule, primary_key

Mode = Literal["fused", "gated"]
_FAILED = {2: TECHNICAL_FAILED, 3: REFERENCES_FAILED, 4: FUNCTIONAL_FAILED}
_PASSED = {2: TECHNICAL_OK, 3: REFERENCES_OK}


@dataclass(frozen=True)
class ValidationOutcome:
    """Final state, row count and the violations of the phase that failed, one row per check."""

    flag: int
    row_count: int
    violations: list[Row] = field(default_factory=list)

    def report_df(self, spark: SparkSession) -> DataFrame:
        return report_of_rows(spark, self.violations)


def count_and_check(
    df: DataFrame, rules: Sequence[ColumnRule], has_header: bool
) -> tuple[int, list[Row] | None]:
    """The number of rows, and the violations of types, nulls and lengths found by the same scan.

    For tables whose every scan is dear, as of text files: give both to :func:`validate_table`. The
    violations are None where a plain count is all that can be done: with wrong columns, or a rule that
    cannot be applied, which is reported in its place.
    """
    # Whether there are rows is not known yet: the check of names does without.
    structure = check_structure(df, [r.field_name for r in rules], has_header, row_count=1)
    if not structure.ok:
        return df.count(), None
    job = _Job(structure.df, rules, _no_references, (), 0, None)
    try:
        checks = [*job.type_checks(), *job.null_checks(), *job.length_checks()]
    except Exception:
        return df.count(), None
    return counted_scan(structure.df, checks)


@dataclass(frozen=True)
class _Job:
    """What the checks of one table need."""

    df: DataFrame
    rules: Sequence[ColumnRule]
    load_reference: LoadReference
    business: Sequence[BusinessRule]
    n_rows: int
    checks_per_scan: int | None
    # Violations of types, nulls and lengths, if they are known already.
    counted: list[Row] | None = None

    def type_checks(self) -> list[Check]:
        technical.check_date_formats(self.df.sparkSession, self.df.schema, self.rules)
        return technical.type_checks(self.df.schema, self.rules)

    def null_checks(self) -> list[Check]:
        return technical.null_checks(self.df.schema, self.rules)

    def length_checks(self) -> list[Check]:
        return technical.length_checks(self.df.schema, self.rules)

    def business_row_checks(self) -> list[Check]:
        return functional.row_checks(
            self.df.schema, self.business, len(self.df.columns), self.n_rows
        )

    def key_reports(self) -> list[DataFrame]:
        """The key check in its cheapest form, if there is a key."""
        key = primary_key(self.rules)
        if not key:
            return []
        quick = technical.fingerprints_pay(self.df.schema, key)
        report = technical.suspected_key_report if quick else technical.primary_key_report
        return [report(self.df, key)]

    def confirmed_key(self, found: list[Row]) -> list[Row]:
        """What is left of a suspicion once the keys themselves are counted."""
        key = primary_key(self.rules)
        if found and technical.fingerprints_pay(self.df.schema, key):
            suspected = sum(row.n_violations for row in found)
            return collect_report(technical.confirmed_key_report(self.df, key, suspected))
        return found

    def references(self) -> ReferencePlan:
        return referential.plan_references(self.df, self.rules, self.load_reference)

    def group_reports(self) -> list[DataFrame]:
        return functional.group_reports(self.df, self.business)


def validate_table(
    df: DataFrame,
    rules: Sequence[ColumnRule],
    *,
    has_header: bool = True,
    load_reference: LoadReference | None = None,
    business: Sequence[BusinessRule] = DEFAULT_RULES,
    mode: Mode = "fused",
    row_count: int | None = None,
    counted: list[Row] | None = None,
    checks_per_scan: int | None = None,
    on_flag: Callable[[int], None] = lambda flag: None,
) -> ValidationOutcome:
    """Structure, technical checks, references, business rules.

    ``gated`` counts types, nulls and lengths in one scan, reports the first kind that finds
    something, and then runs one kind of check after the other. ``fused`` reports the same from fewer
    passes: one scan counts everything that looks at single rows, whatever its phase; if the table is
    still clean then, one action runs the key, the references and the groups side by side.
    ``checks_per_scan`` is for tables of columnar files, see :func:`scan_report`; ``row_count`` and
    ``counted`` for others, see :func:`count_and_check`.

    A rule that cannot be applied raises when its check is reached, in both modes. ``on_flag`` is
    told each state on the way; the final one is in the outcome.
    """
    if row_count is None:
        row_count = df.count()
    on_flag(PROCESSING)
    structure = check_structure(df, [r.field_name for r in rules], has_header, row_count)
    if not structure.ok:
        row = violation(1, "structure", 0, ALL_COLUMNS, STRUCTURE_MISMATCH, 1, structure.message)
        return ValidationOutcome(STRUCTURE_FAILED, row_count, [row])
    on_flag(STRUCTURE_OK)

    load_reference = load_reference or _no_references
    job = _Job(structure.df, rules, load_reference, business, row_count, checks_per_scan, counted)
    steps = {"fused": _fused, "gated": _gated}[mode](job)
    for phase, last_of_phase, violations in steps:
        if violations:
            return ValidationOutcome(_FAILED[phase], row_count, violations)
        if last_of_phase and phase in _PASSED:
            on_flag(_PASSED[phase])
    return ValidationOutcome(COMPLETED, row_count)


def _no_references(database: str, table: str, column: str) -> DataFrame:
    raise LookupError("no way to load references was given")


# A step is (phase, whether the phase ends with it, violations).
_Steps = Iterator[tuple[int, bool, list[Row]]]


def _gated(job: _Job) -> _Steps:
    stages = _row_stages(job)
    counted = _count_stages(job, stages)
    yield from _technical_rows(stages, counted)
    yield from _after_rows(job)


def _row_stages(job: _Job) -> dict[str, _Attempt]:
    """The kinds of phase 2 that look at single rows, in their order."""
    return {
        "data_type": _Attempt(job.type_checks),
        "not_null": _Attempt(job.null_checks),
        "max_length": _Attempt(job.length_checks),
    }


def _count_stages(job: _Job, stages: dict[str, _Attempt]) -> list[Row]:
    """One scan for all of them; a kind that could not be prepared is left out."""
    if job.counted is None:
        return _count(job, [check for stage in stages.values() for check in stage.result or []])
    if job.counted or "business" not in stages:
        return job.counted
    return _count(job, stages["business"].result or [])


def _technical_rows(stages: dict[str, _Attempt], counted: list[Row]) -> _Steps:
    for name in ("data_type", "not_null", "max_length"):
        stages[name].raise_if_failed()
        yield 2, False, [row for row in counted if row.check_name == name]


def _after_rows(job: _Job) -> _Steps:
    """From the key on, one action per kind of check."""
    suspected = [row for report in job.key_reports() for row in collect_report(report)]
    yield 2, True, job.confirmed_key(suspected)
    yield 3, True, job.references().run_each()
    by_row = _count(job, job.business_row_checks())
    by_group = [row for report in job.group_reports() for row in collect_report(report)]
    yield 4, True, in_order(by_row + by_group)


def _fused(job: _Job) -> _Steps:
    stages = _row_stages(job) | {"business": _Attempt(job.business_row_checks)}
    counted = _count_stages(job, stages)
    yield from _technical_rows(stages, counted)

    references, groups = _Attempt(job.references), _Attempt(job.group_reports)

    def run(plan: ReferencePlan | None) -> list[Row]:
        plans = job.key_reports() + (plan.together() if plan else []) + (groups.result or [])
        return collect_report(union_reports(job.df.sparkSession, plans)) if plans else []

    plan = references.result
    try:
        try:
            found = run(plan)
        except Exception:
            # Something broke while it was read. If references did, all else runs together again.
            readable = plan.readable() if plan else None
            if readable is None or len(readable.opened) == len(plan.opened):
                raise
            plan = readable
            found = run(plan)
    except Exception:
        # Find out what it is, with the others unharmed.
        yield from _after_rows(job)
        return
    yield 2, True, job.confirmed_key([row for row in found if row.phase == 2])
    references.raise_if_failed()
    yield 3, True, in_order(plan.rows + [row for row in found if row.phase == 3])
    for stage in (stages["business"], groups):
        stage.raise_if_failed()
    in_rows = [row for row in counted if row.phase == 4]
    yield 4, True, in_order(in_rows + [row for row in found if row.phase == 4])


class _Attempt:
    """The result of preparing a stage, or the error to raise once the stage is reached."""

    def __init__(self, build: Callable) -> None:
        self.result, self._error = None, None
        try:
            self.result = build()
        except Exception as error:
            self._error = error

    def raise_if_failed(self) -> None:
        if self._error is not None:
            raise self._error


def _count(job: _Job, checks: Sequence[Check]) -> list[Row]:
    if not checks:
        return []
    return collect_report(scan_report(job.df, checks, checks_per_scan=job.checks_per_scan))
