"""Column rules: one row of the rule table becomes one :class:`ColumnRule`."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Row

# Blank and control characters, stripped from both ends of a stored type name.
_EDGES = "".join(map(chr, range(33)))
_DATE_WITH_FORMAT = re.compile(r"DATE\s*\((.+)\)", re.IGNORECASE | re.ASCII)
_WHOLE_NUMBER = re.compile(r"[+-]?[0-9]+")
_INT_MAX = 2**31 - 1


class RuleError(ValueError):
    """A stored rule that cannot be applied."""


@dataclass(frozen=True)
class LogicalType:
    """``INT``, ``DECIMAL`` or ``DATE``; only dates carry a format."""

    name: str
    date_format: str | None = None


@dataclass(frozen=True)
class Reference:
    """The column a value must exist in."""

    database: str
    table: str
    column: str

    @property
    def full_table(self) -> str:
        return f"{self.database}.{self.table}"


@dataclass(frozen=True)
class ColumnRule:
    """What one expected column must fulfil. ``length`` stays text until a length check needs it."""

    field_name: str
    data_type: str | None = None
    length: str | None = None
    nullable: bool = True
    pk: bool = False
    referential_bbdd: str | None = None
    referential_table_field_name: str | None = None

    @classmethod
    def from_row(cls, row: Row | Mapping[str, Any]) -> ColumnRule:
        value = row.asDict() if isinstance(row, Row) else dict(row)
        nullable = value.get("nullable")
        return cls(
            field_name=value["field_name"],
            data_type=value.get("data_type"),
            length=value.get("length"),
            nullable=True if nullable is None else bool(nullable),
            pk=bool(value.get("pk")),
            referential_bbdd=value.get("referential_bbdd"),
            referential_table_field_name=value.get("referential_table_field_name"),
        )

    @property
    def logical_type(self) -> LogicalType | None:
        """The type to test, or None where every value is accepted."""
        if self.data_type is None:
            return None
        declared = self.data_type.strip(_EDGES)
        kind = declared.upper()
        if kind == "INT":
            return LogicalType("INT")
        if kind.startswith("DECIMAL"):
            return LogicalType("DECIMAL")
        if kind.startswith("DATE"):
            return LogicalType("DATE", _DATE_WITH_FORMAT.sub(r"\1", declared).strip(_EDGES))
        return None

    @property
    def max_length(self) -> int | None:
        """The longest value allowed, or None without a limit."""
        if not self.length:
            return None
        if not _WHOLE_NUMBER.fullmatch(self.length):
            raise RuleError(f"{self.field_name}: length {self.length!r} is not a whole number")
        limit = int(self.length)
        if not -_INT_MAX - 1 <= limit <= _INT_MAX:
            raise RuleError(f"{self.field_name}: length {self.length!r} is out of range")
        return limit

    @property
    def has_reference(self) -> bool:
        return bool(self.referential_bbdd) and bool(self.referential_table_field_name)

    @property
    def reference(self) -> Reference | None:
        """The reference, or None where there is none or its text is not ``table.column``."""
        if not self.has_reference:
            return None
        parts = self.referential_table_field_name.rstrip(".").split(".")
        if len(parts) != 2:
            return None
        return Reference(self.referential_bbdd, *parts)


def primary_key(rules: Iterable[ColumnRule]) -> list[str]:
    """The key columns, in rule order."""
    return [rule.field_name for rule in rules if rule.pk]
