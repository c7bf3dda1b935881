import pytest
from pyspark.sql import functions as F

from tablecheck import ColumnRule, RuleError, StartsWith, validate_table
from tablecheck.operators import referential, technical
from tablecheck.plans import validate

RULES = [
    ColumnRule("k", "STRING", "5", nullable=False, pk=True,
               referential_bbdd="db", referential_table_field_name="ref.code"),
    ColumnRule("n", "INT", "3", nullable=False),
    ColumnRule("d", "DATE(yyyy/MM/dd)", "10"),
    ColumnRule("x", "STRING", "8"),
]
BUSINESS = [StartsWith("x", "_c")]
GOOD = ("a", "1", "2024/01/01", "_c1")


@pytest.fixture(params=["fused", "gated"])
def check(request, text):
    def run(rows, rules=RULES, business=BUSINESS, load=None, names="kndx"):
        flags = []
        outcome = validate_table(
            text(tuple(names), rows),
            rules,
            load_reference=load or (lambda *_: text("code", ["a", "b", "c"])),
            business=business,
            mode=request.param,
            on_flag=flags.append,
        )
        seen = [(r.check_name, r.column_name, r.n_violations) for r in outcome.violations]
        return outcome.flag, seen, flags

    return run


def test_all_phases_pass(check):
    assert check([GOOD]) == (2, [], [11, 12, 13, 14])


def test_structure_fails(check):
    flag, seen, flags = check([GOOD[:3]], names="knd")
    assert (flag, seen, flags) == (31, [("structure", "ALL_COLUMNS", 1)], [11])


def test_empty_table(check):
    assert check([])[0] == 31


def test_types_go_before_all_other_checks(check):
    rows = [("abcdefgh", "x", "2024-01-01", "y"), ("abcdefgh", None, "1", "z" * 9)]
    assert check(rows) == (32, [("data_type", "n", 1), ("data_type", "d", 2)], [11, 12])


def test_nulls_go_before_lengths(check):
    assert check([("abcdefgh", " ", None, "z" * 9)])[:2] == (32, [("not_null", "n", 1)])


def test_lengths_go_before_the_key(check):
    rows = [("abcdefgh", "1", None, "z" * 9)] * 2
    assert check(rows)[:2] == (32, [("max_length", "k", 2), ("max_length", "x", 2)])


def test_the_key_goes_before_references(check):
    assert check([("zz", "1", None, "y")] * 2) == (32, [("primary_key", "k", 1)], [11, 12])


def test_references_go_before_business_rules(check):
    assert check([("zz", "1", None, "y")]) == (33, [("reference", "k", 1)], [11, 12, 13])


def test_business_rules_come_last(check):
    assert check([("a", "1", None, "y")]) == (34, [("starts_with", "x", 1)], [11, 12, 13, 14])


def test_default_business_rules_need_their_columns(check):
    with pytest.raises(RuleError):
        check([GOOD], business=validate.DEFAULT_RULES)


def changed(name, **values):
    return [ColumnRule(**{**vars(r), **values}) if r.field_name == name else r for r in RULES]


def test_bad_date_format_raises_once_structure_is_right(check):
    rules = changed("d", data_type="DATE")
    with pytest.raises(RuleError, match="date format"):
        check([GOOD], rules)
    assert check([], rules)[0] == 31


def test_bad_length_raises_only_when_reached(check):
    rules = changed("x", length="10,2")
    assert check([("a", "x", None, "")], rules)[:2] == (32, [("data_type", "n", 1)])
    assert check([("a", None, None, "")], rules)[:2] == (32, [("not_null", "n", 1)])
    with pytest.raises(RuleError, match="whole number"):
        check([GOOD], rules)


def test_bad_business_rule_raises_only_when_reached(check):
    business = [StartsWith("absent", "_c")]
    assert check([("zz", "1", None, "")], business=business)[0] == 33
    with pytest.raises(RuleError):
        check([GOOD], business=business)


def test_reference_that_cannot_be_opened(check):
    def load(*_):
        raise LookupError("gone")

    assert check([GOOD], load=load) == (33, [("reference", "k", 1)], [11, 12, 13])
    assert check([GOOD, GOOD], load=load)[:2] == (32, [("primary_key", "k", 1)])


def test_reference_that_breaks_while_read(check, spark, monkeypatch):
    monkeypatch.setattr(referential, "is_broadcastable", lambda *_: False)
    broken = spark.range(3).select(F.raise_error(F.lit("disk gone")).cast("string").alias("code"))
    assert check([GOOD], load=lambda *_: broken) == (33, [("reference", "k", 1)], [11, 12, 13])
    assert check([GOOD, GOOD], load=lambda *_: broken)[:2] == (32, [("primary_key", "k", 1)])


def test_breaking_references_cost_one_more_action(spark, text, monkeypatch):
    """However many references there are, the table is read three times: rows, all that failed, the rest."""
    reads = []
    monkeypatch.setattr(
        validate, "collect_report", lambda report: reads.append(1) or report.collect()
    )
    broken = spark.range(3).select(F.raise_error(F.lit("disk gone")).cast("string").alias("v"))
    rules = [
        ColumnRule(c, nullable=False, referential_bbdd="db", referential_table_field_name=f"{c}.v")
        for c in "kndx"
    ]
    outcome = validate_table(
        text(tuple("kndx"), [GOOD]), rules, business=[],
        load_reference=lambda _, name, __: broken if name in "nd" else text("v", ["a", "zz"]),
    )
    assert len(reads) == 3 and outcome.flag == 33
    found = {r.column_name: r.error_message for r in outcome.violations}
    assert "disk gone" in found["n"] and "disk gone" in found["d"]
    assert "do not exist" in found["x"] and "k" not in found


def test_no_key_no_reference_no_business_rule(check):
    rules = [ColumnRule(c) for c in "kndx"]
    assert check([GOOD, GOOD], rules, business=[])[0] == 2


def test_without_header(text):
    outcome = validate_table(
        text(("c0", "c1", "c2", "c3"), [GOOD]), RULES, has_header=False, business=BUSINESS,
        load_reference=lambda *_: text("code", ["a"]),
    )
    assert (outcome.flag, outcome.row_count) == (2, 1)


def test_report_frame(spark, text):
    outcome = validate_table(text("a", ["x"]), [ColumnRule("a", "INT")], business=[])
    row = outcome.report_df(spark).first()
    assert (row.phase, row.check_name, row.n_violations) == (2, "data_type", 1)


def test_references_without_a_loader(text):
    outcome = validate_table(text("k", ["a"]), RULES[:1], business=[])
    assert outcome.flag == 33


def test_fused_and_gated_agree_over_whole_tables(spark):
    from tablecheck.registry.fixtures import RULES as rules
    from tablecheck.registry.fixtures import clean, mixed, template_references
    from tablecheck.registry.scenarios import REQUESTS, scenario_tables

    sf_dir = "/root/testdata/sf0.001"
    load = scenario_tables(clean(spark, sf_dir), mixed(spark, sf_dir))
    for name in {name for name, _ in REQUESTS} - {"nowhere"}:
        outcomes = [
            validate_table(
                load(name), rules, has_header=name != "unnamed",
                load_reference=template_references(spark), mode=mode,
            )
            for mode in ("fused", "gated")
        ]
        assert outcomes[0] == outcomes[1], name


def test_fused_run_reads_a_clean_table_twice(spark, text, monkeypatch):
    """One action for the rows, one for key, references and groups."""
    reads = []
    monkeypatch.setattr(
        validate, "collect_report", lambda report: reads.append(1) or report.collect()
    )
    validate_table(
        text(tuple("kndx"), [GOOD]), RULES, business=BUSINESS, row_count=1,
        load_reference=lambda *_: text("code", ["a"]),
    )
    assert len(reads) == 2


def test_a_suspected_key_is_counted_before_it_fails(check, spark, monkeypatch):
    """Different keys with one fingerprint are no violation."""
    alike = lambda df, columns: technical.primary_key_report(
        df.withColumn("k", F.lit("same")), ["k"]
    )
    monkeypatch.setattr(technical, "suspected_key_report", alike)
    assert check([GOOD, ("b", "2", None, "_c2")])[0] == 2
    assert check([GOOD, GOOD, ("b", "2", None, "_c2")])[:2] == (32, [("primary_key", "k", 1)])
