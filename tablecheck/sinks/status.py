"""The state of requests, as an append-only table: the latest row of a request is its state."""

from __future__ import annotations

import threading
import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.local import local_frame
from tablecheck.schemas import STATUS_SCHEMA
from tablecheck.sinks.targets import Sink


def current_status(status: DataFrame) -> DataFrame:
    """The latest state per request, and the row count last recorded for it."""
    counted_at = F.when(F.col("row_count").isNotNull(), F.col("seq"))
    return status.groupBy("id_trigger").agg(
        F.max_by("flag", "seq").alias("flag"),
        F.max_by("row_count", counted_at).alias("row_count"),
    )


def compacted_status(status: DataFrame) -> DataFrame:
    """At most two rows per request with the same latest state and row count as all of ``status``.

    Every state is one small row of its own when it is appended. To compact a status table, write this
    to a new one and go on with that.
    """
    counted = F.col("row_count").isNotNull()
    whole = F.struct(*status.columns)
    kept = status.groupBy("id_trigger").agg(
        F.max_by(whole, "seq").alias("latest"),
        F.max_by(whole, F.when(counted, F.col("seq"))).alias("counted"),
    )
    rows = kept.select(F.explode(F.array_distinct(F.array("latest", "counted"))).alias("row"))
    return rows.where("row is not null").select("row.*")


class StatusWriter:
    """Appends states, numbered so that later ones sort behind earlier ones; threads may share it.

    Each state is written at once, so that others can follow a request. With ``one_commit``, the states of
    a request are written together by :meth:`commit`: a request that was killed has left none.
    """

    def __init__(self, spark: SparkSession, sink: Sink, one_commit: bool = False) -> None:
        self._spark, self._sink, self._seq = spark, sink, 0
        self._one_commit, self._held = one_commit, {}
        self._lock = threading.Lock()

    def append(
        self,
        id_trigger: int,
        flag: int,
        row_count: int | None = None,
        duration_s: float | None = None,
    ) -> None:
        with self._lock:
            # Clock time also orders the rows of different runs.
            self._seq = max(self._seq + 1, time.time_ns())
            row = (id_trigger, flag, row_count, self._seq, datetime.now(UTC), duration_s)
            if self._one_commit:
                self._held.setdefault(id_trigger, []).append(row)
            else:
                self._sink(local_frame(self._spark, [row], STATUS_SCHEMA))

    def commit(self, id_trigger: int) -> None:
        """Write what is held back of a request."""
        with self._lock:
            rows = self._held.pop(id_trigger, None)
            if rows:
                self._sink(local_frame(self._spark, rows, STATUS_SCHEMA))
