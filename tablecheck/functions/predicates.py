"""Row predicates: true where a text value breaks a rule. None of them can raise on data."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablecheck.fixed_values import DECIMAL_PATTERN, INT_PATTERN


def blank(value: Column) -> Column:
    """NULL, empty or spaces only (a tab is not blank)."""
    return value.isNull() | (F.trim(value) == "")


def not_blank(value: Column) -> Column:
    return value.isNotNull() & (F.trim(value) != "")


def not_an_int(value: Column) -> Column:
    """What fits a bigint first: it is told without a pattern, and most values do. Then the pattern,
    and only then a look for blanks."""
    return ~_surely_int(value) & ~value.rlike(INT_PATTERN) & not_blank(value)


def _surely_int(value: Column) -> Column:
    """Converts to a bigint, and without the white space, control characters and plus signs that a
    conversion would pass over."""
    first, last = F.substring(value, 1, 1), F.substring(value, -1, 1)
    edges = (first.between("0", "9") | (first == "-")) & last.between("0", "9")
    return edges & value.try_cast("bigint").isNotNull()


def not_a_decimal(value: Column) -> Column:
    return ~value.rlike(DECIMAL_PATTERN) & not_blank(value)


def not_a_date(value: Column, date_format: str) -> Column:
    """Parsing is dear, most of all for texts that are no date: what surely is one is told by a
    pattern, where the format has one, and blanks are told before parsing."""
    parsed = not_blank(value) & F.try_to_date(value, date_format).isNull()
    pattern = sure_date_pattern(date_format)
    return parsed if pattern is None else ~value.rlike(pattern) & parsed


_DIGITS = {
    "yyyy": "(?:[1-9][0-9]{3}|0[1-9][0-9]{2})",
    "MM": "(?:0[1-9]|1[0-2])",
    "dd": "(?:0[1-9]|1[0-9]|2[0-8])",
    "HH": "(?:[01][0-9]|2[0-3])",
    "mm": "[0-5][0-9]",
    "ss": "[0-5][0-9]",
}
_FORMAT_PARTS = re.compile("([A-Za-z]+)|([^A-Za-z]+)")


def sure_date_pattern(date_format: str) -> str | None:
    """A pattern for texts that are dates in any case, of formats that are digits of fixed width.

    Days after the 28th and early years are left to the parser; so are all other formats.
    """
    parts, used = [], []
    for letters, between in _FORMAT_PARTS.findall(date_format):
        if letters:
            used.append(letters)
            parts.append(_DIGITS.get(letters, ""))
        elif re.fullmatch("[-/. :_,]+", between):
            parts.append(re.escape(between))
        else:
            return None
    known = all(letters in _DIGITS for letters in used) and len(set(used)) == len(used)
    if not known or not {"yyyy", "MM", "dd"} <= set(used):
        return None
    return rf"\A{''.join(parts)}\z"


def too_long(value: Column, limit: int) -> Column:
    """More characters than ``limit``, trailing spaces included.

    A text has no more characters than bytes, and its bytes need no counting.
    """
    return (F.octet_length(value) > limit) & (F.length(value) > limit)


def lacks_prefix(value: Column, prefix: str) -> Column:
    return not_blank(value) & ~value.startswith(prefix)
