"""Rule-driven validation of tables with Spark."""

from tablecheck.operators import (
    DEFAULT_RULES,
    AtLeastOne,
    CellInRange,
    ExactlyOne,
    StartsWith,
    business_report,
    check_structure,
    data_types_report,
    max_length_report,
    not_null_report,
    primary_key_report,
    references_report,
    technical_report,
)
from tablecheck.plans import RequestRunner, ValidationOutcome, validate_table
from tablecheck.rules import ColumnRule, RuleError

__all__ = [
    "DEFAULT_RULES",
    "AtLeastOne",
    "CellInRange",
    "ColumnRule",
    "ExactlyOne",
    "RequestRunner",
    "RuleError",
    "StartsWith",
    "ValidationOutcome",
    "business_report",
    "check_structure",
    "data_types_report",
    "max_length_report",
    "not_null_report",
    "primary_key_report",
    "references_report",
    "technical_report",
    "validate_table",
]
