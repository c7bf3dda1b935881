from tablecheck.operators.functional import (
    DEFAULT_RULES,
    AtLeastOne,
    CellInRange,
    ExactlyOne,
    StartsWith,
    business_report,
)
from tablecheck.operators.referential import (
    BroadcastBounds,
    plan_references,
    reference_values,
    references_report,
)
from tablecheck.operators.structure import StructureResult, check_structure
from tablecheck.operators.technical import (
    data_types_report,
    max_length_report,
    not_null_report,
    primary_key_report,
    technical_report,
)

__all__ = [
    "DEFAULT_RULES",
    "AtLeastOne",
    "BroadcastBounds",
    "CellInRange",
    "ExactlyOne",
    "StartsWith",
    "StructureResult",
    "business_report",
    "check_structure",
    "data_types_report",
    "max_length_report",
    "not_null_report",
    "plan_references",
    "primary_key_report",
    "reference_values",
    "references_report",
    "technical_report",
]
