import pytest
from pyspark.sql import functions as F

from tablecheck import ColumnRule, references_report
from tablecheck.operators import plan_references, reference_values, referential


def rule(name, database="db", place="td_templates.template_code"):
    return ColumnRule(name, referential_bbdd=database, referential_table_field_name=place)


@pytest.fixture
def load(text):
    calls = []

    def loader(database, table, column):
        calls.append((database, table, column))
        if table == "absent":
            raise LookupError("it is not there")
        return text(column, ["T1", "T2", "T2", None])

    loader.calls = calls
    return loader


def found(report):
    return [(r.column_name, r.n_violations, r.error_type) for r in report.collect()]


@pytest.fixture(params=["broadcast", "shuffled"])
def either_join(request, monkeypatch):
    """Both ways to join, whatever the size of the reference."""
    if request.param == "shuffled":
        monkeypatch.setattr(referential, "is_broadcastable", lambda *_: False)
    return request.param


@pytest.mark.parametrize(("database", "place"), [(None, None), ("", ""), ("db", None), (None, "t.c")])
def test_no_reference(text, load, database, place):
    df = text(("a", "b"), [("T1", "Cover")])
    rules = [rule("a", database, place), ColumnRule("b")]
    assert references_report(df, rules, load).isEmpty()
    assert load.calls == []


def test_bad_format_does_not_stop_the_others(text, load):
    df = text(("a", "b"), [("T1", "T9")])
    report = references_report(df, [rule("a", place="no_dot"), rule("b")], load)
    rows = {r.column_name: r for r in report.collect()}
    assert rows["a"].check_name == "reference_format"
    assert "no_dot" in rows["a"].error_message
    assert rows["b"].n_violations == 1
    assert {r.error_type for r in rows.values()} == {"REF_INTEGRITY_ERROR"}


def test_all_present(text, load, either_join):
    df = text(("a", "b"), [("T1", "Cover"), ("T2", "CCY"), (None, "CCY")])
    assert references_report(df, [rule("a")], load).isEmpty()


def test_distinct_missing_values_count_once(text, load, either_join):
    df = text("a", ["T1", "T99", "T99", "T98", "", " T1", None])
    assert found(references_report(df, [rule("a")], load)) == [("a", 4, "REF_INTEGRITY_ERROR")]


def test_columns_sharing_a_reference_read_it_once(text, load, either_join):
    df = text(("a", "b", "c"), [("T1", "T9", "T9"), ("T2", "T8", "T1"), ("T9", "T9", None)])
    report = references_report(df, [rule("a"), rule("b"), rule("c")], load, keep_zero=True)
    assert sorted(found(report)) == [
        ("a", 1, "REF_INTEGRITY_ERROR"),
        ("b", 2, "REF_INTEGRITY_ERROR"),
        ("c", 1, "REF_INTEGRITY_ERROR"),
    ]
    assert len(load.calls) == 1


def test_values_are_compared_as_text(spark, either_join):
    df = spark.range(5).select(F.col("id").alias("a"))
    known = spark.sql("SELECT * FROM VALUES ('0'), ('1'), ('02') AS t(template_code)")
    assert found(references_report(df, [rule("a")], lambda *_: known)) == [
        ("a", 3, "REF_INTEGRITY_ERROR")
    ]


def test_an_empty_reference_lacks_everything(text, spark, either_join):
    df = text("a", ["x", "y", "y"])
    empty = text("template_code", [])
    assert found(references_report(df, [rule("a")], lambda *_: empty))[0][1] == 2


def test_reference_that_cannot_be_opened(text, load):
    df = text(("a", "b", "c"), [("T1", "T9", "x")])
    rules = [rule("a", place="absent.x"), rule("b"), rule("c", place="absent.x")]
    rows = {r.column_name: r for r in references_report(df, rules, load).collect()}
    assert rows["a"].error_message == "a: could not be checked against db.absent - it is not there"
    assert rows["c"].n_violations == 1
    assert "do not exist" in rows["b"].error_message


def test_reference_that_breaks_while_read(text, spark, load, monkeypatch):
    df = text(("a", "b"), [("T1", "T9")])
    broken = spark.range(3).select(F.raise_error(F.lit("disk gone")).cast("string").alias("x"))
    monkeypatch.setattr(referential, "is_broadcastable", lambda *_: False)

    def loader(database, table, column):
        return broken if table == "broken" else load(database, table, column)

    plan = plan_references(df, [rule("a", place="broken.x"), rule("b")], loader)
    assert len(plan.plans) == 2
    rows = {r.column_name: r for r in plan.run_each()}
    assert "disk gone" in rows["a"].error_message
    assert rows["b"].n_violations == 1


def test_missing_reference_column(text, load):
    df = text("a", ["T1"])
    report = references_report(df, [rule("a")], lambda *_: text("other", ["T1"]))
    assert "could not be checked" in report.first().error_message


def test_reference_values(spark):
    df = spark.sql("SELECT * FROM VALUES (1), (1), (NULL), (2) AS t(k)")
    assert sorted(r.value for r in reference_values(df, "k").collect()) == ["1", "2"]


def test_size_bounds(text):
    frame, bounds = text("value", ["abc", "de"]), referential.BroadcastBounds
    assert referential.is_broadcastable(frame, bounds())
    assert not referential.is_broadcastable(frame, bounds(size=4))
    assert not referential.is_broadcastable(frame, bounds(rows=1))


def test_large_reference_needs_one_shuffle_per_side(text, monkeypatch, spark):
    monkeypatch.setattr(referential, "is_broadcastable", lambda *_: False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = text(("a", "b"), [("T1", "T2")])
        known = text("template_code", ["T1"])
        report = references_report(df, [rule("a"), rule("b")], lambda *_: known)
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2


def test_small_reference_shuffles_missing_values_only(text, load):
    df = text("a", ["T1", "T2"])
    plan = references_report(df, [rule("a")], load)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")


def test_whole_numbers_are_compared_unconverted(spark, either_join):
    df = spark.sql("SELECT * FROM VALUES (1, 7L), (2, 8L), (2, NULL), (300, 9L) AS t(a, b)")
    known = spark.sql("SELECT CAST(c AS SMALLINT) AS c FROM VALUES (2), (7), (NULL) AS t(c)")
    rules = [rule("a", place="t.c"), rule("b", place="t.c")]
    report = references_report(df, rules, lambda *_: known)
    assert sorted(r.n_violations for r in report.collect()) == [2, 2]
    assert "as string" not in report._jdf.queryExecution().sparkPlan().toString().split("Generate")[1]


def test_mixed_types_are_compared_as_text(spark, either_join):
    df = spark.sql("SELECT * FROM VALUES (1, '1'), (2, '02') AS t(a, b)")
    known = spark.sql("SELECT * FROM VALUES (1), (2) AS t(c)")
    rules = [rule("a", place="t.c"), rule("b", place="t.c")]
    report = references_report(df, rules, lambda *_: known, keep_zero=True)
    assert {r.column_name: r.n_violations for r in report.collect()} == {"a": 0, "b": 1}


def test_many_columns_share_one_join(text, load):
    names = [f"c{i}" for i in range(60)]
    df = text(names, [("T1",) * 30 + ("T9",) * 30])
    report = references_report(df, [rule(n) for n in names], load, keep_zero=True)
    assert report._jdf.queryExecution().sparkPlan().toString().count("Join") == 1
    assert [r.n_violations for r in report.orderBy("seq").collect()] == [0] * 30 + [1] * 30
