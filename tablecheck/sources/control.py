"""The control tables: requests, table types and column rules. All are small by nature."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tablecheck.fixed_values import PENDING
from tablecheck.operators.functional import (
    AtLeastOne,
    BusinessRule,
    CellInRange,
    ExactlyOne,
    StartsWith,
)
from tablecheck.rules import ColumnRule, RuleError
from tablecheck.sinks.status import current_status


def pending_requests(triggers: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """The requests still to do.

    ``triggers`` is never updated in place; with the ``status`` table given, the latest state there
    goes before the one a request was created with.
    """
    if status is None:
        return triggers.filter(F.col("flag") == PENDING)
    latest = current_status(status).select("id_trigger", F.col("flag").alias("latest_flag"))
    return (
        triggers.join(latest, "id_trigger", "left")
        .filter(F.coalesce("latest_flag", "flag") == PENDING)
        .select(*triggers.columns)
    )


def config_for(config: DataFrame, id_type_table: str) -> Row:
    """The configuration of a table type."""
    row = config.filter(F.col("id_type_table") == id_type_table).first()
    if row is None:
        raise LookupError(f"no configuration for table type {id_type_table!r}")
    return row


def rule_rows(rules: DataFrame, id_type_table: str) -> DataFrame:
    """The rules of a table type in column order, those without a position last."""
    return rules.filter(F.col("id_type_table") == id_type_table).orderBy(
        F.asc_nulls_last("field_position"), "field_name"
    )


def rules_for(rules: DataFrame, id_type_table: str) -> list[ColumnRule]:
    return [ColumnRule.from_row(row) for row in rule_rows(rules, id_type_table).collect()]


def business_rules_for(business: DataFrame, id_type_table: str) -> list[BusinessRule]:
    """The business rules of a table type in order; none if the table holds none."""
    rows = business.filter(F.col("id_type_table") == id_type_table)
    return [_business_rule(row) for row in rows.orderBy(F.asc_nulls_last("position")).collect()]


def _business_rule(row: Row) -> BusinessRule:
    groups, names = _listed(row.group_columns), _listed(row.names)
    if row.kind in ("exactly_one", "exactly_one_all_groups"):
        return ExactlyOne(groups, row.column_name, names, row.kind == "exactly_one_all_groups")
    if row.kind == "at_least_one":
        return AtLeastOne(groups, row.column_name, row.prefix)
    if row.kind == "starts_with":
        return StartsWith(row.column_name, row.prefix)
    if row.kind == "cell_range":
        return CellInRange(row.column_name, row.n_cols, row.n_rows)
    raise RuleError(f"{row.kind!r} is not a kind of business rule")


def _listed(text: str | None) -> tuple[str, ...]:
    return tuple(part.strip() for part in (text or "").split(",") if part.strip())
