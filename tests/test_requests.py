from datetime import datetime

import pytest
from pyspark import StorageLevel

from tablecheck import ColumnRule, RequestRunner
from tablecheck.local import local_frame
from tablecheck.schemas import CONFIG_SCHEMA, LOG_SCHEMA, RULE_SCHEMA, STATUS_SCHEMA, TRIGGER_SCHEMA
from tablecheck.registry.scenarios import KeptRows
from tablecheck.sinks import current_log, current_status

AT = datetime(2024, 1, 1)


def rule_row(kind, position, rule):
    return (kind, position, rule.field_name, None, rule.pk, rule.data_type, rule.length,
            rule.nullable, None, rule.referential_bbdd, rule.referential_table_field_name, None)


@pytest.fixture
def job(spark, text):
    """Builds a runner with two columns, and keeps what it writes."""
    tables = {
        "good": text(("a", "b"), [("1", "x"), ("2", "y")]),
        "swapped": text(("b", "a"), [("x", "1")]),
        "bad": text(("a", "b"), [("one", "x"), ("two", None)]),
        "narrow": text("a", ["1"]),
        "unknown": text(("a", "b"), [("3", "zz")]),
    }

    class Job:
        log, status = KeptRows(spark, LOG_SCHEMA), KeptRows(spark, STATUS_SCHEMA)
        loaded = []

        def load(self, name):
            self.loaded.append(name)
            return tables[name]

        def runner(self, **changes):
            rules = [
                ColumnRule("a", "INT", pk=True),
                ColumnRule("b", referential_bbdd="db", referential_table_field_name="r.v"),
            ]
            return RequestRunner(**{
                "spark": spark,
                "config": local_frame(spark, [("T", "t", True, "me", 2), ("P", "p", None, "me", 2)],
                                      CONFIG_SCHEMA),
                "rules": local_frame(
                    spark, [rule_row(k, i, r) for k in "TP" for i, r in enumerate(rules)],
                    RULE_SCHEMA),
                "load_table": self.load,
                "load_reference": lambda *_: text("v", ["x", "y"]),
                "log_sink": self.log,
                "status_sink": self.status,
                "business": [],
                **changes,
            })

        def run(self, *requests, **changes):
            rows = [(i, kind, name, AT, flag, None)
                    for i, (name, kind, flag) in enumerate(requests, 1)]
            return self.runner(**changes).run_pending(local_frame(spark, rows, TRIGGER_SCHEMA))

        def states(self, request):
            return [r.flag for r in sorted(self.status.rows, key=lambda r: r.seq)
                    if r.id_trigger == request]

    instance = Job()
    instance.log.rows, instance.status.rows, instance.loaded = [], [], []
    return instance


def test_nothing_pending(job):
    assert job.run(("good", "T", 2), ("good", "T", None)) == 0
    assert job.status.rows == job.log.rows == []


@pytest.mark.parametrize("mode", ["fused", "gated"])
def test_states_and_logs(job, mode):
    done = job.run(("good", "T", 0), ("bad", "T", 0), ("narrow", "T", 0), ("unknown", "T", 0),
                   mode=mode)
    assert done == 4
    assert [job.states(i) for i in (1, 2, 3, 4)] == [
        [1, 11, 12, 13, 14, 2],
        [1, 11, 12, 32],
        [1, 11, 31],
        [1, 11, 12, 13, 33],
    ]
    assert [(r.id_trigger, r.validation_id, r.type_validation, r.field_name, r.incidences, r.flag)
            for r in job.log.rows] == [
        (2, "DATA_TYPE_ERROR", "functional_validation", "a", "1", 1),
        (3, "STRUCTURE_MISMATCH", "table_validation", "ALL_COLUMNS", "1", 1),
        (4, "REF_INTEGRITY_ERROR", "functional_validation", "b", "1", 1),
    ]
    assert job.log.rows[0].table_name == "bad"
    assert job.log.rows[0].execution_timestamp is not None


def test_row_count_and_duration(job, spark):
    job.run(("good", "T", 0))
    assert [r.row_count for r in job.status.rows] == [2, None, None, None, None, None]
    assert job.status.rows[-1].duration_s > 0
    assert current_status(job.status.frame()).collect() == [(1, 2, 2)]


def test_a_failing_request_does_not_stop_the_next(job):
    job.run(("absent", "T", 0), ("good", "unconfigured", 0), ("good", "T", 0))
    assert [job.states(i) for i in (1, 2, 3)] == [[3], [3], [1, 11, 12, 13, 14, 2]]
    assert [(r.validation_id, r.type_validation, r.field_name) for r in job.log.rows] == [
        ("EXECUTION_ERROR", "system_error", "SYSTEM")] * 2
    assert "unconfigured" in job.log.rows[1].validation_msg


def test_an_error_without_message_is_logged_by_name(job):
    def load(name):
        raise RuntimeError

    job.run(("good", "T", 0), load_table=load)
    assert job.log.rows[0].validation_msg == "RuntimeError"


def test_header_in_any_order(job):
    job.run(("swapped", "T", 0))
    assert job.states(1)[-1] == 2


def test_no_header_value_means_by_position(job):
    job.run(("swapped", "P", 0))
    assert job.states(1)[-1] == 32


def test_log_that_cannot_be_written(job):
    def broken(df):
        raise OSError("log is full")

    with pytest.warns(UserWarning, match="log is full"):
        job.run(("bad", "T", 0), ("good", "T", 0), log_sink=broken)
    assert job.states(1)[-1] == 32
    assert job.states(2)[-1] == 2


def test_status_that_cannot_be_written(job):
    failing = {1}

    def sink(df):
        row = df.first()
        if row.id_trigger in failing:
            raise OSError("no status")
        job.status(df)

    with pytest.warns(UserWarning, match="no status"):
        job.run(("good", "T", 0), ("good", "T", 0), status_sink=sink)
    assert job.states(1) == []
    assert job.states(2)[-1] == 2
    assert job.log.rows[0].validation_id == "EXECUTION_ERROR"


def test_done_requests_are_not_repeated(job, spark):
    triggers = local_frame(spark, [(1, "T", "good", AT, 0, None)], TRIGGER_SCHEMA)
    assert job.runner().run_pending(triggers, job.status.frame()) == 1
    assert job.runner().run_pending(triggers, job.status.frame()) == 0


def test_persist_is_released(job, spark):
    frame = job.load("good")
    kept = []

    def load(name):
        kept.append(frame)
        return frame

    job.run(("good", "T", 0), load_table=load, persist=StorageLevel.MEMORY_AND_DISK)
    assert job.states(1)[-1] == 2
    assert kept[0].storageLevel == StorageLevel.NONE


def test_all_states_and_codes(spark):
    """The registered requests reach every final state and every error code."""
    from tablecheck.registry.scenarios import run_requests

    log, status = run_requests(spark, "/root/testdata/sf0.001")
    flags = [r.flag for r in current_status(status).orderBy("id_trigger").collect()]
    assert flags == [2, 2, 31, 31, 32, 32, 32, 32, 33, 34, 34, 3, 3, 3]
    assert {r.validation_id for r in log.collect()} == {
        "STRUCTURE_MISMATCH", "DATA_TYPE_ERROR", "NOT_NULL_ERROR", "LENGTH_ERROR", "PK_ERROR",
        "REF_INTEGRITY_ERROR", "FUNCTIONAL_ERROR", "EXECUTION_ERROR",
    }


REQUESTS = [("good", "T", 0), ("bad", "T", 0), ("absent", "T", 0), ("narrow", "T", 0), ("unknown", "T", 0)] * 3


def test_requests_side_by_side(job):
    """The same states in the same order for each request, and the same log."""

    def results():
        log = sorted((r.id_trigger, r.validation_id, r.field_name) for r in job.log.rows)
        return [job.states(i + 1) for i in range(len(REQUESTS))], log

    job.run(*REQUESTS)
    one_by_one = results()
    job.log.rows, job.status.rows = [], []
    assert job.run(*REQUESTS, workers=4) == len(REQUESTS)
    assert results() == one_by_one
    assert len({r.seq for r in job.status.rows}) == len(job.status.rows)


def test_side_by_side_requests_have_pools_of_their_own(job, spark):
    pools, load = set(), job.load

    def loading(name):
        pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return load(name)

    job.run(*REQUESTS, workers=3, load_table=loading)
    assert pools == {"requests-0", "requests-1", "requests-2"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_one_commit_per_request(job):
    batches, keep = [], job.status

    def sink(df):
        batches.append(df.count())
        keep(df)

    job.run(("good", "T", 0), ("bad", "T", 0), ("absent", "T", 0), status_sink=sink, one_commit=True)
    assert batches == [6, 4, 1]
    assert [job.states(i) for i in (1, 2, 3)] == [[1, 11, 12, 13, 14, 2], [1, 11, 12, 32], [3]]


class Killed(BaseException):
    """Ends a run as a lost driver would: nothing handles it."""


def test_a_killed_run_repeats_without_duplicates(job, spark):
    """Killed between log and states: the request is still pending, and its log counts once."""
    requests = local_frame(spark, [(i, "T", name, AT, 0, None) for i, name in ((1, "unknown"), (2, "bad"))],
                           TRIGGER_SCHEMA)

    def killed(df):
        raise Killed

    with pytest.raises(Killed):
        job.runner(one_commit=True, status_sink=killed).run_pending(requests)
    assert len(job.log.rows) == 1 and job.status.rows == []
    assert job.runner(one_commit=True).run_pending(requests, job.status.frame()) == 2
    assert len(job.log.rows) == 3
    kept = current_log(job.log.frame(), job.status.frame())
    assert kept.columns == LOG_SCHEMA.fieldNames()
    assert sorted((r.id_trigger, r.validation_id) for r in kept.collect()) == [
        (1, "REF_INTEGRITY_ERROR"), (2, "DATA_TYPE_ERROR")]
    assert job.runner().run_pending(requests, job.status.frame()) == 0


def test_log_of_a_reopened_request(job, spark):
    """Also of attempts that ended before anything was counted."""
    triggers = local_frame(spark, [(1, "T", "bad", AT, 0, None)], TRIGGER_SCHEMA)
    for load in (job.load, lambda name: 1 / 0):
        runner = job.runner(load_table=load)
        if job.status.rows:
            runner.reopen([1])
        assert runner.run_pending(triggers, job.status.frame()) == 1
    assert len(job.log.rows) == 2
    kept = current_log(job.log.frame(), job.status.frame())
    assert [r.validation_id for r in kept.collect()] == ["EXECUTION_ERROR"]
    # Without any state, and with an empty one, every row is kept.
    assert current_log(job.log.frame(), job.status.frame().limit(0)).count() == 2


def test_first_rows_are_found_once(spark):
    """Tables that requests derive from events join a few known rows, and rank none again."""
    from tablecheck.registry.fixtures import clean, mixed

    for build in (clean, mixed):
        plan = build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "LocalRelation" in plan
