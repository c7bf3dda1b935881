import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablecheck.fixed_values import REQUIRED_NAMES
from tablecheck import (
    DEFAULT_RULES,
    AtLeastOne,
    CellInRange,
    ExactlyOne,
    RuleError,
    StartsWith,
    business_report,
)

# The default rules name five of these columns; the other two only make the table wider.
NAMES = ("template_code", "sheet", "pad_a", "excel_cell", "column_x", "pad_b", "data_name")


@pytest.fixture
def table(text):
    """Rows given by data_name, and optionally cell, column and group."""

    def build(*rows):
        full = []
        for i, row in enumerate(rows):
            name, cell, column, sheet = (*row, *("A1", "_c1", "Cover")[len(row) - 1:])
            full.append(("tpl", sheet, "-", cell, column, str(i), name))
        return text(NAMES, full)

    return build


def violations(df, rules=DEFAULT_RULES):
    return {
        (r.check_name, r.error_message.split(":")[0]): r.n_violations
        for r in business_report(df, rules).collect()
    }


def full_group(sheet="Cover"):
    return [(n, "A1", "_c1", sheet) for n in (*REQUIRED_NAMES, "ccy1", "metric")]


def test_valid_group(table):
    assert violations(table(*full_group())) == {}


def test_valid_groups(table):
    assert violations(table(*full_group(), *full_group("CCY"))) == {}


def test_required_name_missing(table):
    df = table(("cristine_unit",), ("excel_title",), ("ccy1",))
    assert violations(df) == {("exactly_one", "data_name='data_as_of'"): 1}


def test_required_name_twice(table):
    df = table(("data_as_of",), *full_group())
    assert violations(df) == {("exactly_one", "data_name='data_as_of'"): 1}


def test_groups_without_any_required_name(table):
    df = table(("ccy1",))
    assert violations(df) == {}
    strict = ExactlyOne(("template_code", "sheet"), "data_name", REQUIRED_NAMES, include_empty_groups=True)
    assert sum(violations(df, [strict]).values()) == 3


def test_no_currency(table):
    df = table(*[(n,) for n in (*REQUIRED_NAMES, "metric")])
    assert violations(df) == {("at_least_one", "data_name starting with 'ccy'"): 1}


def test_currency_in_any_case_and_null_names(table):
    assert violations(table(("CcY_x",), (None,))) == {}
    assert violations(table((None,))) == {("at_least_one", "data_name starting with 'ccy'"): 1}


def test_null_group_keys_form_a_group(text):
    df = text(("g", "n"), [(None, "x"), (None, "x"), ("1", "ccy")])
    rules = [AtLeastOne(("g",), "n", "ccy"), ExactlyOne(("g",), "n", ("x",))]
    assert sorted(violations(df, rules).values()) == [1, 1]


def test_column_prefix(table):
    rows = [(n, "A1", c) for n, c in zip((*REQUIRED_NAMES, "ccy1"), ("_c1", "_c2", "_c10", "_c1"))]
    assert violations(table(*rows)) == {}


def test_wrong_column_prefix(table):
    rows = [("ccy1", "A1", c) for c in ("_c1", "c1_", "_C1", " _c1", "  ", "", None)]
    report = business_report(table(*rows), [StartsWith("column_x", "_c")]).collect()
    assert [(r.column_name, r.n_violations) for r in report] == [("column_x", 3)]


def cells(text, values, n_cols=5, n_rows=9):
    report = business_report(text("excel_cell", values), [CellInRange("excel_cell", n_cols, n_rows)])
    return sum(r.n_violations for r in report.collect())


def test_cells_inside(text):
    assert cells(text, ["E9", "c7", "D1", "b2", "", None, "    "]) == 0


@pytest.mark.parametrize("cell", ["F2", "e10", "C0", "BC4", "ABC1", "#D4", "\tD4", "Ö2", "44", "?"])
def test_cell_outside(text, cell):
    assert cells(text, [cell, "A1"]) == 1


@pytest.mark.parametrize("cell", ["D", "C5C", "E_2", "B" + "8" * 25, "A6\n"])
def test_cell_row_that_cannot_be_read_is_accepted(text, cell):
    assert cells(text, [cell]) == 0


@pytest.mark.parametrize(("cell", "columns"), [("Z1", 26), ("AA1", 27), ("az1", 52), ("ZZ1", 702)])
def test_cell_column_numbers(text, cell, columns):
    assert cells(text, [cell], n_cols=columns) == 0
    assert cells(text, [cell], n_cols=columns - 1) == 1


def test_range_is_the_size_of_the_table(table):
    rows = [(n, c) for n, c in zip((*REQUIRED_NAMES, "ccy1"), ("C2", "E4", "G1", "A3"))]
    assert violations(table(*rows)) == {}
    assert violations(table(*rows[:3])) == {
        ("at_least_one", "data_name starting with 'ccy'"): 1,
        ("cell_range", "excel_cell"): 1,
    }


def test_all_rules_report_together(table):
    df = table(("data_as_of", "K30", "c1_"), ("data_as_of", "B2", "_c1"))
    assert [r.error_type for r in business_report(df).collect()] == ["FUNCTIONAL_ERROR"] * 6


def test_unknown_column(table):
    with pytest.raises(RuleError):
        business_report(table(("x",)), [StartsWith("absent", "_c")])


def test_one_grouping_serves_all_rules_with_its_columns(table):
    plan = business_report(table(("x",)), DEFAULT_RULES[:2])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_other_names_stay_at_the_scan(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = business_report(conversations, [ExactlyOne(("conv_id",), "role", ("system", "user"))])
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(role, [system,user])]" in scan
    assert "text:string" not in scan


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["g", "h", None]), st.sampled_from(["a", "b", "CCy", "ccyX", None]))
    )
)
def test_groups_against_plain_python(text, rows):
    groups = defaultdict(Counter)
    for group, name in rows:
        groups[group][name] += 1
    taken = [g for g in groups.values() if g["a"] + g["b"]]
    expected = [
        sum(g["a"] != 1 for g in taken),
        sum(g["b"] != 1 for g in taken),
        sum(not g["CCy"] + g["ccyX"] for g in groups.values()),
    ]
    rules = [ExactlyOne(("k",), "n", ("a", "b")), AtLeastOne(("k",), "n", "CCY")]
    found = business_report(text(("k", "n"), rows), rules, keep_zero=True).orderBy("seq").collect()
    assert [r.n_violations for r in found] == expected


def outside(cell, n_cols, n_rows):
    """The rule for one cell, in plain Python."""
    if cell is None or not cell.strip(" "):
        return False
    letters = re.match("[A-Za-z]*", cell)[0].upper()
    column = 0
    if len(letters) in (1, 2):
        for letter in letters:
            column = 26 * column + ord(letter) - 64
    digits = re.search("[0-9]+$", cell)
    row = int(digits[0]) if digits and int(digits[0]) < 2**63 else None
    return not 1 <= column <= n_cols or (row is not None and not 1 <= row <= n_rows)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.text("aBzÑı103 $-\n", max_size=6),
                       st.from_regex(r"\A[A-Ca-c]{1,2}[0-9]{1,21}\Z")), max_size=30),
    st.integers(1, 60),
    st.integers(1, 40),
)
def test_cells_against_plain_python(text, values, n_cols, n_rows):
    assert cells(text, values, n_cols, n_rows) == sum(outside(v, n_cols, n_rows) for v in values)
