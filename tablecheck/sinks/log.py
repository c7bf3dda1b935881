"""The error log: report rows in the form they are kept."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.fixed_values import (
    INGESTED,
    LOG_FLAG,
    LOG_INCIDENCES,
    MESSAGE_KEPT,
    MESSAGE_LIMIT,
    MESSAGE_TAIL,
)
from tablecheck.schemas import LOG_SCHEMA
from tablecheck.sinks.targets import Sink


def capped_message(message: Column) -> Column:
    """The message, or its beginning and a tail where the log column is too narrow for it."""
    cut = F.concat(F.substring(message, 1, MESSAGE_KEPT), F.lit(MESSAGE_TAIL))
    return F.when(F.length(message) > MESSAGE_LIMIT, cut).otherwise(message)


def log_rows(report: DataFrame, id_trigger: int, table_name: str, type_validation: str) -> DataFrame:
    """One log row per report row."""
    values = {
        "id_trigger": F.lit(id_trigger),
        "validation_id": F.col("error_type"),
        "type_validation": F.lit(type_validation),
        "table_name": F.lit(table_name),
        "validation_msg": capped_message(F.col("error_message")),
        "field_name": F.col("column_name"),
        "incidences": F.lit(LOG_INCIDENCES),
        "flag": F.lit(LOG_FLAG),
        "execution_timestamp": F.current_timestamp(),
    }
    return report.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields]
    )


def current_log(log: DataFrame, status: DataFrame) -> DataFrame:
    """The log rows of each request's latest attempt.

    Rows are only ever appended: a request that was killed behind its log rows, or was reopened, leaves
    those of every attempt. An attempt began when its rows were counted, or, where it ended without, its
    duration before its last state. Rows of requests without any such state are kept. Log and states are
    told apart by clock time, so the machines that wrote them need clocks that agree.
    """
    ended_after = F.expr("event_time - make_dt_interval(0, 0, 0, CAST(duration_s AS DECIMAL(18, 6)))")
    counted_at = F.when(F.col("flag") == INGESTED, F.col("event_time"))
    begun = status.groupBy("id_trigger").agg(
        F.max(F.greatest(counted_at, ended_after)).alias("attempt_begun")
    )
    rows = log.join(begun, "id_trigger", "left")
    latest = F.col("attempt_begun").isNull() | (F.col("execution_timestamp") >= F.col("attempt_begun"))
    return rows.where(latest).select(*log.columns)


def append_log(sink: Sink, rows: DataFrame) -> None:
    """Write log rows; a log that cannot be written does not stop a validation."""
    try:
        sink(rows)
    except Exception as error:
        warnings.warn(f"error log not written: {error}", stacklevel=2)
