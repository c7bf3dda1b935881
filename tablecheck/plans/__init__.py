from tablecheck.plans.requests import RequestRunner
from tablecheck.plans.validate import ValidationOutcome, validate_table

__all__ = ["RequestRunner", "ValidationOutcome", "validate_table"]
