"""Rows counted by the scan that checks them."""

import pytest
from pyspark.sql import functions as F

from tablecheck import ColumnRule, RequestRunner
from tablecheck.operators.report import counted_scan
from tablecheck.plans import validate
from tablecheck.plans.validate import count_and_check, validate_table
from tablecheck.registry.fixtures import RULES, clean, mixed, template_references
from tablecheck.registry.scenarios import KeptRows, control_tables, scenario_tables
from tablecheck.schemas import LOG_SCHEMA, STATUS_SCHEMA

SMALL = "/root/testdata/sf0.001"


def states(spark, **changes):
    triggers, config, rules = control_tables(spark)
    log, status = KeptRows(spark, LOG_SCHEMA), KeptRows(spark, STATUS_SCHEMA)
    RequestRunner(
        spark, config, rules,
        load_table=scenario_tables(clean(spark, SMALL), mixed(spark, SMALL)),
        load_reference=template_references(spark), log_sink=log, status_sink=status, **changes,
    ).run_pending(triggers)
    return (
        sorted((r.id_trigger, r.flag, str(r.row_count)) for r in status.rows),
        sorted((r.id_trigger, r.validation_id, r.validation_msg) for r in log.rows),
    )


def test_states_and_log_are_those_of_a_count_of_its_own(spark):
    assert states(spark, count_with_checks=True) == states(spark)


@pytest.mark.parametrize("mode", ["fused", "gated"])
def test_outcomes_agree(spark, text, mode):
    rules = [ColumnRule("a", "INT", nullable=False), ColumnRule("b", length="3")]
    for rows in ([], [("1", "x")], [("x", "y"), (None, "long text")], [(None, "x")], [("1", "longer")]):
        df = text(("a", "b"), rows)
        n, counted = count_and_check(df, rules, True)
        found = validate_table(df, rules, business=[], mode=mode, row_count=n, counted=counted)
        assert found == validate_table(df, rules, business=[], mode=mode)


def scans(spark, run):
    """How many rows of a text file ``run`` reads, by an accumulator-free count of jobs' input."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("scans", "scans")
    run()
    jobs = tracker.getJobIdsForGroup("scans")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(jobs)


def test_a_text_file_that_fails_in_phase_2_is_scanned_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(100).select(F.col("id").alias("a"), F.lit("x").alias("b")).write.csv(path, header=True)
    df = spark.read.csv(path, header=True, schema="a string, b string")
    rules = [ColumnRule("a", "INT"), ColumnRule("b", "INT")]
    actions = []
    original = validate.counted_scan
    monkeypatch.setattr(validate, "counted_scan", lambda *a: actions.append("scan") or original(*a))
    monkeypatch.setattr(validate, "collect_report", lambda report: actions.append("more") or report.collect())

    def run():
        n, counted = count_and_check(df, rules, True)
        outcome = validate_table(df, rules, business=[], row_count=n, counted=counted)
        assert (outcome.flag, outcome.row_count) == (32, 100)
        assert [r.n_violations for r in outcome.violations] == [100]

    # One job for the scan, one that ends its aggregate: as many as for a count.
    assert scans(spark, run) <= 2 and actions == ["scan"]


def test_wrong_columns_are_only_counted(text):
    df = text(("a", "z"), [("1", "x")])
    assert count_and_check(df, [ColumnRule("a"), ColumnRule("b")], True) == (1, None)


def test_a_rule_that_cannot_be_applied_is_only_counted(text):
    df = text("a", ["2024"])
    assert count_and_check(df, [ColumnRule("a", "DATE")], True) == (1, None)


def test_nothing_to_check_is_a_count(spark):
    assert counted_scan(spark.range(7), []) == (7, [])
