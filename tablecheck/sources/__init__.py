from tablecheck.sources.control import (
    business_rules_for,
    config_for,
    pending_requests,
    rule_rows,
    rules_for,
)
from tablecheck.sources.cuts import Cuts, counted_cuts, cut_conditions
from tablecheck.sources.tables import (
    catalog_references,
    catalog_tables,
    cut_predicates,
    cut_query,
    file_references,
    file_tables,
    jdbc_references,
    jdbc_tables,
    range_predicates,
    read_jdbc_table,
)

__all__ = [
    "Cuts",
    "business_rules_for",
    "catalog_references",
    "catalog_tables",
    "config_for",
    "counted_cuts",
    "cut_conditions",
    "cut_predicates",
    "cut_query",
    "file_references",
    "file_tables",
    "jdbc_references",
    "jdbc_tables",
    "pending_requests",
    "range_predicates",
    "read_jdbc_table",
    "rule_rows",
    "rules_for",
]
