from datetime import datetime

from tablecheck.local import local_frame
from tablecheck.operators.report import report_of_rows, violation
from tablecheck.schemas import LOG_SCHEMA, STATUS_SCHEMA
from tablecheck.sinks import (
    StatusWriter,
    capped_message,
    current_status,
    file_sink,
    jdbc_sink,
    log_rows,
    overwrite_jdbc_table,
)

AT = datetime(2024, 1, 1)


def test_messages_are_capped(text):
    df = text("m", ["a" * 255, "b" * 256, "ñ" * 300, "", None])
    found = [r[0] for r in df.select(capped_message(df.m)).collect()]
    assert found == ["a" * 255, "b" * 250 + "...", "ñ" * 250 + "...", "", None]


def test_log_rows(spark):
    report = report_of_rows(spark, [violation(2, "not_null", 0, "c", "NOT_NULL_ERROR", 7, "m")])
    rows = log_rows(report, 3, "s.t", "functional_validation")
    assert rows.schema.fieldNames() == LOG_SCHEMA.fieldNames()
    assert [f.dataType for f in rows.schema] == [f.dataType for f in LOG_SCHEMA]
    assert tuple(rows.first())[:-1] == (
        3, "NOT_NULL_ERROR", "functional_validation", "s.t", "m", "c", "1", 1
    )


def test_latest_state_wins_and_the_count_stays(spark):
    status = local_frame(
        spark,
        [
            (1, 12, None, 30, AT, None),
            (1, 1, 100, 10, AT, None),
            (1, 11, None, 20, AT, None),
            (2, 3, None, 40, AT, 1.5),
            (1, 1, 90, 5, AT, None),
        ],
        STATUS_SCHEMA,
    )
    assert sorted(map(tuple, current_status(status).collect())) == [(1, 12, 100), (2, 3, None)]


def test_status_file_is_appended_in_order(spark, tmp_path):
    path = f"{tmp_path}/status"
    for _ in range(2):
        writer = StatusWriter(spark, file_sink(path))
        for flag in (1, 11, 12):
            writer.append(5, flag, 10 if flag == 1 else None)
    rows = spark.read.parquet(path).orderBy("seq").collect()
    assert [r.flag for r in rows] == [1, 11, 12] * 2
    assert len({r.seq for r in rows}) == 6


class Writer:
    """Stands in for a frame; keeps what its writer was told."""

    def __init__(self):
        self.told, self.write = {}, self

    def coalesce(self, n):
        self.told["files"] = n
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def jdbc(self, url, table, mode=None, properties=None):
        self.told |= {"table": table, "mode": mode or self.told.get("mode"), "properties": properties}


def test_jdbc_append():
    df = Writer()
    jdbc_sink("jdbc:x", "log", {"user": "u"})(df)
    assert df.told == {"files": 1, "table": "log", "mode": "append", "properties": {"user": "u"}}


def test_jdbc_overwrite():
    df = Writer()
    overwrite_jdbc_table(df, "jdbc:x", "ref", {}, "code VARCHAR(50)")
    assert df.told["mode"] == "overwrite"
    assert df.told["createTableColumnTypes"] == "code VARCHAR(50)"
