"""Results and plans where one value holds a third of all rows, and where results are kept."""

import pytest
from pyspark.sql import functions as F

from tablecheck import AtLeastOne, ColumnRule, ExactlyOne, business_report, primary_key_report
from tablecheck import references_report
from tablecheck.operators import referential

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key, group and missing reference value."""
    hot = F.col("id") % 3 == 0
    return spark.range(ROWS, numPartitions=6).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"),
        F.when(hot, "missing").otherwise((F.col("id") % 100).cast("string")).alias("fk"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("name"),
    )


def test_key(skewed):
    report = primary_key_report(skewed, ["k"])
    assert report.first().n_violations == ROWS // 3 - 1
    assert counted_before_shuffle(report)


def test_groups(skewed):
    rules = [ExactlyOne(("k",), "name", ("a",)), AtLeastOne(("k",), "name", "b")]
    report = business_report(skewed, rules)
    # Of the groups with an "a" only the hot one has several; the others with a single row lack a "b".
    assert [r.n_violations for r in report.orderBy("seq").collect()] == [1, ROWS // 3]
    assert counted_before_shuffle(report)


@pytest.mark.parametrize("bound", [0, 1000])
def test_references(skewed, spark, bound):
    known = spark.range(60).select(F.col("id").cast("string").alias("c"))
    rule = ColumnRule("fk", referential_bbdd="d", referential_table_field_name="t.c")
    bounds = referential.BroadcastBounds(rows=bound)
    report = references_report(skewed, [rule], lambda *_: known, bounds=bounds)
    assert report.first().n_violations == 41
    assert counted_before_shuffle(report)


def counted_before_shuffle(report) -> bool:
    """Below every hash shuffle stands an aggregate that has already merged equal keys."""
    plan = report._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lines = [line.lstrip(" :+-") for line in plan.splitlines()]
    below = [b for a, b in zip(lines, lines[1:]) if a.startswith("Exchange hashpartitioning")]
    return bool(below) and all(line.startswith("HashAggregate") for line in below)
