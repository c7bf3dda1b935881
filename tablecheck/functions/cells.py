"""Spreadsheet cell names such as ``B3``: column number, row number, range test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablecheck.functions.predicates import not_blank

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# One or two leading letters that no third letter follows.
_LETTERS = "^([A-Za-z]{1,2})(?:[^A-Za-z]|$)"
_DIGITS_AT_END = "([0-9]+)$"
_BEYOND_ANY_SIZE = 2**63 - 1


def cell_column(cell: Column) -> Column:
    """A=1 … Z=26, AA=27 … ZZ=702; 0 without letters or with more than two."""
    letters = F.lpad(F.upper(F.regexp_extract(cell, _LETTERS, 1)), 2, " ")
    high, low = (F.position(F.substring(letters, i, 1), F.lit(_ALPHABET)) for i in (1, 2))
    return high * len(_ALPHABET) + low


def cell_row(cell: Column) -> Column:
    """The trailing digits as a number; NULL without digits or beyond a bigint."""
    return F.regexp_extract(cell, _DIGITS_AT_END, 1).try_cast("bigint")


def outside_cell_range(cell: Column, n_cols: int, n_rows: int) -> Column:
    """Not blank and outside; a row number that cannot be read counts as inside."""
    row_inside = F.coalesce(_from_one_to(cell_row(cell), n_rows), F.lit(True))
    return not_blank(cell) & ~(_from_one_to(cell_column(cell), n_cols) & row_inside)


def _from_one_to(number: Column, limit: int) -> Column:
    """1 <= number <= limit for numbers from 0, computing ``number`` once: 0 wraps around."""
    return F.pmod(number - 1, F.lit(_BEYOND_ANY_SIZE)) < limit
