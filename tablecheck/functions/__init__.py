from tablecheck.functions.cells import cell_column, cell_row, outside_cell_range
from tablecheck.functions.columns import (
    blank_column,
    is_date,
    is_whole_number,
    quoted,
    text_column,
)
from tablecheck.functions.predicates import (
    blank,
    lacks_prefix,
    not_a_date,
    not_a_decimal,
    not_an_int,
    not_blank,
    too_long,
)

__all__ = [
    "blank",
    "blank_column",
    "cell_column",
    "cell_row",
    "is_date",
    "is_whole_number",
    "lacks_prefix",
    "not_a_date",
    "not_a_decimal",
    "not_an_int",
    "not_blank",
    "outside_cell_range",
    "quoted",
    "text_column",
    "too_long",
]
