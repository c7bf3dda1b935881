import pytest

from tablecheck.rules import ColumnRule, LogicalType, Reference, RuleError, primary_key


@pytest.mark.parametrize(
    ("declared", "expected"),
    [
        (None, None),
        ("STRING", None),
        ("INT", LogicalType("INT")),
        (" int ", LogicalType("INT")),
        ("INTEGER", None),
        ("BIGINT", None),
        ("decimal", LogicalType("DECIMAL")),
        ("DECIMAL(10,2)", LogicalType("DECIMAL")),
        ("DATE(yyyy/MM/dd)", LogicalType("DATE", "yyyy/MM/dd")),
        ("date ( dd-MM-yyyy )", LogicalType("DATE", "dd-MM-yyyy")),
        ("DATE", LogicalType("DATE", "DATE")),
        ("DATETIME", LogicalType("DATE", "DATETIME")),
        ("VARCHAR", None),
    ],
)
def test_logical_type(declared, expected):
    assert ColumnRule("c", declared).logical_type == expected


@pytest.mark.parametrize(
    ("length", "expected"), [(None, None), ("", None), ("4", 4), ("+4", 4), ("-1", -1)]
)
def test_max_length(length, expected):
    assert ColumnRule("c", length=length).max_length == expected


@pytest.mark.parametrize("length", ["10,2", " ", " 5 ", "5.0", "٤", "99999999999"])
def test_max_length_must_be_a_whole_number(length):
    with pytest.raises(RuleError):
        ColumnRule("c", length=length).max_length


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("t.c", Reference("db", "t", "c")),
        ("t.c.", Reference("db", "t", "c")),
        (".c", Reference("db", "", "c")),
        ("t.", None),
        ("t", None),
        ("a.b.c", None),
        (".", None),
    ],
)
def test_reference_text(text, expected):
    rule = ColumnRule("c", referential_bbdd="db", referential_table_field_name=text)
    assert rule.has_reference
    assert rule.reference == expected


@pytest.mark.parametrize(("database", "text"), [(None, None), ("", ""), ("db", None), ("", "t.c")])
def test_half_a_reference_is_none(database, text):
    rule = ColumnRule("c", referential_bbdd=database, referential_table_field_name=text)
    assert not rule.has_reference
    assert rule.reference is None


def test_missing_flags():
    rule = ColumnRule.from_row({"field_name": "c", "nullable": None, "pk": None})
    assert rule.nullable
    assert not rule.pk
    assert primary_key([rule, ColumnRule("k", pk=True)]) == ["k"]
