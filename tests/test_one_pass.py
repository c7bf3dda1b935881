"""Several references, and several groupings, from one scan and one shuffle."""

import pytest
from pyspark.sql import functions as F

from tablecheck import AtLeastOne, ColumnRule, ExactlyOne
from tablecheck.operators import business_report, references_report
from tablecheck.operators.functional import group_reports
from tablecheck.operators.referential import plan_references


def rule(name, place):
    return ColumnRule(name, referential_bbdd="ref", referential_table_field_name=place)


@pytest.fixture
def stored(spark, tmp_path):
    """stored(name, df) -> the frame read from files."""

    def keep(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return keep


@pytest.fixture
def case(spark, stored):
    rows = spark.sql(
        "SELECT * FROM VALUES (1, 7L, 'x', '1'), (2, 8L, NULL, ' 1'), (2, NULL, 'y', '2'),"
        " (300, 9L, 'x', '02'), (NULL, 7L, '', '2') AS t(a, b, c, d)"
    )
    references = {
        "numbers": spark.sql("SELECT CAST(v AS SMALLINT) AS v FROM VALUES (2), (7), (7), (NULL) AS t(v)"),
        "texts": spark.sql("SELECT * FROM VALUES ('x'), ('1'), (NULL) AS t(v)"),
        "dates": spark.sql("SELECT DATE'2024-01-01' AS v"),
    }
    rules = [rule("a", "numbers.v"), rule("b", "numbers.v"), rule("c", "texts.v"), rule("d", "numbers.v"),
             rule("d", "dates.v")]
    load = {name: stored(name, df) for name, df in references.items()}
    return stored("rows", rows), rules, lambda database, table, column: load[table]


def test_one_pass_equals_one_by_one(case):
    df, rules, load = case
    plan = plan_references(df, rules, load, keep_zero=True)
    (report,) = plan.together()
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, plan.run_each()))
    counted = {(r.seq, r.column_name): r.n_violations for r in report.collect()}
    assert counted == {(0, "a"): 2, (1, "b"): 2, (2, "c"): 2, (3, "d"): 3, (4, "d"): 4}


def test_one_scan_and_one_shuffle(case):
    df, rules, load = case
    plan = references_report(df, rules, load)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 + 3
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_frequent_value_collapses_before_the_shuffle(spark, case):
    _, rules, load = case
    df = spark.range(20_000).select(
        F.lit(5).alias("a"), F.lit(7).alias("b"), F.lit("z").alias("c"), F.lit("2").alias("d")
    )
    plan = references_report(df, rules, load, keep_zero=True)
    counted = {r.seq: r.n_violations for r in plan.collect()}
    assert counted == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_bool_or" if "partial_bool_or" in text else "partial_max") > 0


def test_a_reference_that_cannot_be_opened_is_a_row(case):
    df, rules, load = case

    def some(database, table, column):
        if table == "texts":
            raise LookupError("it is gone")
        return load(database, table, column)

    rows = {r.seq: r for r in references_report(df, rules, some).collect()}
    assert "it is gone" in rows[2].error_message and rows[0].n_violations == 2


RULES = [
    ExactlyOne(("g",), "n", ("u", "v")),
    AtLeastOne(("h", "g"), "n", "U"),
    ExactlyOne(("h",), "n", ("w",), include_empty_groups=True),
    AtLeastOne(("g",), "n", "w"),
]


def grouped(spark):
    return spark.sql(
        "SELECT * FROM VALUES (1, 'p', 'u'), (1, 'p', 'v'), (1, 'q', 'w'), (2, 'p', 'u'), (2, 'p', 'u'),"
        " (NULL, 'q', 'v'), (NULL, NULL, 'w'), (3, NULL, NULL), (4, 'p', 'x') AS t(g, h, n)"
    )


def one_by_one(df, rules):
    """Each rule by itself, as it is where all rules share their columns."""
    out = []
    for r in rules:
        out += [tuple(row)[1:2] + tuple(row)[3:] for row in business_report(df, [r], 0, True).collect()]
    return sorted(out)


def test_grouping_sets_equal_rules_one_by_one(spark):
    df = grouped(spark)
    (report,) = group_reports(df, RULES, keep_zero=True)
    assert sorted(tuple(r)[1:2] + tuple(r)[3:] for r in report.collect()) == one_by_one(df, RULES)


def test_grouping_sets_without_empty_groups(spark):
    df, rules = grouped(spark), [RULES[0], ExactlyOne(("h",), "n", ("w", "x"))]
    (report,) = group_reports(df, rules, keep_zero=True)
    assert sorted(tuple(r)[1:2] + tuple(r)[3:] for r in report.collect()) == one_by_one(df, rules)


def test_three_groupings_need_one_shuffle(spark):
    (report,) = group_reports(grouped(spark), RULES)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_grouping_sets_over_columns_with_odd_names(spark):
    df = grouped(spark).toDF("rule_set", "Rule0", "k.0 `x`")
    rules = [ExactlyOne(("RULE_SET",), "k.0 `x`", ("u",)), AtLeastOne(("rule0",), "k.0 `x`", "w")]
    (report,) = group_reports(df, rules, keep_zero=True)
    assert {r.seq: r.n_violations for r in report.collect()} == {0: 1, 1: 1}
