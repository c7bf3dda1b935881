from datetime import datetime

import pytest

from tablecheck import job
from tablecheck.local import local_frame
from tablecheck.registry.fixtures import RULES, clean, mixed, templates
from tablecheck.schemas import (
    BUSINESS_SCHEMA,
    CONFIG_SCHEMA,
    RULE_SCHEMA,
    STATUS_SCHEMA,
    TRIGGER_SCHEMA,
)
from tablecheck.sinks import current_status


@pytest.fixture
def root(spark, tmp_path):
    """Control tables, two tables under validation and their reference, as files."""
    at, sf_dir = datetime(2024, 1, 1), "/root/testdata/sf0.001"
    frames = {
        "triggers": local_frame(
            spark,
            [(1, "T", "good", at, 0, None), (2, "T", "bad", at, 0, None), (3, "T", "x", at, 2, None)],
            TRIGGER_SCHEMA,
        ),
        "config": local_frame(spark, [("T", "t", True, "me", 8)], CONFIG_SCHEMA),
        "rules": local_frame(
            spark,
            [
                ("T", i, r.field_name, None, r.pk, r.data_type, r.length, r.nullable, None,
                 r.referential_bbdd, r.referential_table_field_name, None)
                for i, r in enumerate(RULES)
            ],
            RULE_SCHEMA,
        ),
        "good": clean(spark, sf_dir),
        "bad": mixed(spark, sf_dir),
        "ref/td_templates": templates(spark),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_job_over_files(spark, root):
    names = [f"--{n}={n}" for n in ("triggers", "config", "rules", "log", "status")]
    given = job.arguments(["--source", "files", "--root", root, *names])
    assert job.run(spark, given) == 2
    status = current_status(spark.read.parquet(f"{root}/status.parquet"))
    assert sorted(map(tuple, status.collect())) == [(1, 2, 1000), (2, 32, 1000)]
    log = spark.read.parquet(f"{root}/log.parquet").collect()
    assert {(r.id_trigger, r.validation_id) for r in log} == {(2, "DATA_TYPE_ERROR")}
    assert job.run(spark, given) == 0


def test_arguments():
    given = job.arguments(
        ["--source", "jdbc", "--url", "jdbc:x", "--property", "user=a=b", "--key", "s.t=id"]
    )
    assert job._pairs(given.property) == {"user": "a=b"}
    assert job._pairs(given.key) == {"s.t": "id"}
    assert given.triggers == "public.trigger_control"
    for incomplete in (["--source", "files"], ["--source", "jdbc"], []):
        with pytest.raises(SystemExit):
            job.arguments(incomplete)


NAMES = [f"--{n}={n}" for n in ("triggers", "config", "rules", "log", "status")]


def people(spark, columns=("who", "born", "team")):
    rows = [("ann", "2001-02-03", "red"), ("bo", "1999-12-31", "blue")]
    return spark.createDataFrame(rows, list(columns))


def control(spark, has_header=True, names=("people",)):
    at = datetime(2024, 1, 1)
    rules = [
        ("P", i, name, None, i == 1, kind, "12", False, None, None, None, None)
        for i, (name, kind) in enumerate(
            [("who", "STRING"), ("born", "DATE(yyyy-MM-dd)"), ("team", "STRING")], 1
        )
    ]
    triggers = [(i, "P", name, at, 0, None) for i, name in enumerate(names, 1)]
    return {
        "triggers": local_frame(spark, triggers, TRIGGER_SCHEMA),
        "config": local_frame(spark, [("P", "p", has_header, "me", 3)], CONFIG_SCHEMA),
        "rules": local_frame(spark, rules, RULE_SCHEMA),
    }


def business(spark, team):
    rows = [("P", 1, "exactly_one", "team", "team", team, None, None, None)]
    return local_frame(spark, rows, BUSINESS_SCHEMA)


@pytest.mark.parametrize("header", [True, False])
def test_text_files_with_and_without_header(spark, tmp_path, header):
    for name, frame in (control(spark, header) | {"business": business(spark, "red")}).items():
        frame.write.option("header", True).csv(f"{tmp_path}/{name}.csv")
    people(spark).write.option("header", header).csv(f"{tmp_path}/people.csv")
    options = ["--format=csv", f"--option=header={header}", "--business=business"]
    given = job.arguments(["--source=files", f"--root={tmp_path}", *options, *NAMES])
    assert job.run(spark, given) == 1
    status = spark.read.schema(STATUS_SCHEMA).csv(f"{tmp_path}/status.csv", header=True)
    assert [(r.id_trigger, r.flag) for r in current_status(status).collect()] == [(1, 2)]
    assert job.run(spark, given) == 0


def test_business_rules_of_the_job_and_reopening(spark, tmp_path):
    for name, frame in (control(spark) | {"people": people(spark)}).items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    business(spark, "green").write.parquet(f"{tmp_path}/strict.parquet")
    business(spark, "x").limit(0).write.parquet(f"{tmp_path}/none.parquet")
    files = ["--source=files", f"--root={tmp_path}", *NAMES]

    def state():
        return current_status(spark.read.parquet(f"{tmp_path}/status.parquet")).collect()[0].flag

    # The built-in rules name columns that this table does not have.
    assert (job.run(spark, job.arguments(files)), state()) == (1, 3)
    again = [*files, "--reopen=1", "--persist"]
    assert (job.run(spark, job.arguments([*again, "--business=none"])), state()) == (1, 2)
    assert (job.run(spark, job.arguments([*files, "--business=none"])), state()) == (0, 2)
    # No team is green: groups without any of the names do not count.
    assert (job.run(spark, job.arguments([*again, "--business=strict"])), state()) == (1, 2)


def test_job_over_the_catalog(spark):
    spark.sql("DROP TABLE IF EXISTS job_status")
    spark.sql("DROP TABLE IF EXISTS job_log")
    for name, frame in (control(spark, names=("people", "nobody")) | {"people": people(spark)}).items():
        frame.createOrReplaceTempView(name)
    business(spark, "red").createOrReplaceTempView("strict")
    given = job.arguments(
        ["--source=catalog", *NAMES[:3], "--log=job_log", "--status=job_status", "--business=strict"]
    )
    try:
        assert job.run(spark, given) == 2
        states = {(r.id_trigger, r.flag) for r in current_status(spark.table("job_status")).collect()}
        assert states == {(1, 2), (2, 3)}
        assert {r.id_trigger for r in spark.table("job_log").collect()} == {2}
        assert job.run(spark, given) == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS job_status")
        spark.sql("DROP TABLE IF EXISTS job_log")
