"""Columns by name, safe for any name, read as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.predicates import blank
from tablecheck.rules import RuleError

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
_CAN_BE_BLANK = (T.StringType, T.BinaryType)


def quoted(name: str) -> Column:
    """The column called exactly ``name``, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def field_of(schema: T.StructType, name: str) -> T.StructField:
    """The field ``name``, found like Spark does: ignoring case."""
    for field in schema.fields:
        if field.name.lower() == name.lower():
            return field
    raise RuleError(f"column {name!r} is not in the table")


def text_column(schema: T.StructType, name: str) -> Column:
    """The column as text; nested columns have no text to check."""
    kind = field_of(schema, name).dataType
    if isinstance(kind, _NESTED):
        raise RuleError(f"column {name!r} is a {kind.simpleString()}, not a plain value")
    column = quoted(name)
    return column if isinstance(kind, T.StringType) else column.cast("string")


def is_whole_number(schema: T.StructType, name: str) -> bool:
    """Whether the column is stored as a whole number; its text is then one, too."""
    return isinstance(field_of(schema, name).dataType, T.IntegralType)


def is_date(schema: T.StructType, name: str) -> bool:
    """Whether the column is stored as a date or time; it then is one, whatever its format."""
    kind = field_of(schema, name).dataType
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def blank_column(schema: T.StructType, name: str) -> Column:
    """True where the column has no value: NULL or, if its type has such values, blank."""
    value = text_column(schema, name)
    can_be_blank = isinstance(field_of(schema, name).dataType, _CAN_BE_BLANK)
    return blank(value) if can_be_blank else quoted(name).isNull()
