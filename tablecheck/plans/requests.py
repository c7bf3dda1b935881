"""The batch job: every pending request, one after the other or side by side, none harming another."""

from __future__ import annotations

import threading
import time
import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession

from tablecheck.fixed_values import (
    EXECUTION_ERROR,
    FUNCTIONAL_VALIDATION,
    INGESTED,
    PENDING,
    STRUCTURE_FAILED,
    SYSTEM_ERROR,
    SYSTEM_FIELD,
    SYSTEM_VALIDATION,
    TABLE_VALIDATION,
)
from tablecheck.operators.functional import DEFAULT_RULES, BusinessRule
from tablecheck.operators.referential import LoadReference
from tablecheck.operators.report import report_of_rows, violation
from tablecheck.plans.validate import Mode, ValidationOutcome, count_and_check, validate_table
from tablecheck.sinks.log import append_log, log_rows
from tablecheck.sinks.status import StatusWriter
from tablecheck.sinks.targets import Sink
from tablecheck.sources.control import config_for, pending_requests, rules_for
from tablecheck.sources.tables import LoadTable


@dataclass(frozen=True)
class RequestRunner:
    """Control tables, ways to load data, and where results go.

    ``business`` are the business rules of every table, or a function from table type to rules.

    ``persist`` keeps a table between its passes. Leave it out for columnar files, which are cheaper
    to read again by column; set it (``StorageLevel.MEMORY_AND_DISK``) where reading is dear, as from
    a database. ``checks_per_scan`` is the other way round: for tables of columnar files only.
    ``count_with_checks`` is for tables of text files that are not kept: the scan that counts rows also
    checks types, nulls and lengths.

    ``workers`` is how many requests run side by side, each in a scheduler pool of its own: small tables
    then fill the gaps that large ones leave (set ``spark.scheduler.mode`` to FAIR). States of a request
    stay in order, and sinks get one batch at a time. With ``one_commit`` the states of a request are
    written once, behind its log rows: a run that was killed leaves its request pending, and
    :func:`tablecheck.sinks.current_log` leaves out the log rows of attempts that were repeated.
    """

    spark: SparkSession
    config: DataFrame
    rules: DataFrame
    load_table: LoadTable
    load_reference: LoadReference
    log_sink: Sink
    status_sink: Sink
    business: Sequence[BusinessRule] | Callable[[str], Sequence[BusinessRule]] = DEFAULT_RULES
    mode: Mode = "fused"
    persist: StorageLevel | None = None
    checks_per_scan: int | None = None
    count_with_checks: bool = False
    workers: int = 1
    one_commit: bool = False
    _logging: threading.Lock = field(default_factory=threading.Lock, init=False, repr=False, compare=False)

    def reopen(self, ids: Sequence[int]) -> None:
        """Requests with these ids are pending again."""
        writer = StatusWriter(self.spark, self.status_sink)
        for id_trigger in ids:
            writer.append(id_trigger, PENDING)

    def run_pending(self, triggers: DataFrame, status: DataFrame | None = None) -> int:
        """Validate every pending request and return their number. Requests are few."""
        requests = pending_requests(triggers, status).orderBy("id_trigger").collect()
        writer = StatusWriter(self.spark, self.status_sink, self.one_commit)
        if self.workers <= 1:
            for request in requests:
                self._run(request, writer)
            return len(requests)

        def run_in_pool(place: int, request: Row) -> None:
            pool = f"requests-{place % self.workers}"
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
            self._run(request, writer)

        with ThreadPoolExecutor(self.workers) as threads:
            # Wrapped one by one: each takes local properties of its own along.
            running = [
                threads.submit(inheritable_thread_target(self.spark)(run_in_pool), place, request)
                for place, request in enumerate(requests)
            ]
        for done in running:
            done.result()
        return len(requests)

    def _run(self, request: Row, writer: StatusWriter) -> None:
        started = time.monotonic()
        # The final state is written last, behind its log rows and with the time taken.
        try:
            outcome = self._validate(request, writer)
            at_structure = outcome.flag == STRUCTURE_FAILED
            kind = TABLE_VALIDATION if at_structure else FUNCTIONAL_VALIDATION
            self._log(request, outcome.violations, kind)
            writer.append(request.id_trigger, outcome.flag, duration_s=time.monotonic() - started)
            writer.commit(request.id_trigger)
        except Exception as error:
            self._fail(request, writer, error, time.monotonic() - started)

    def _validate(self, request: Row, writer: StatusWriter) -> ValidationOutcome:
        has_header = bool(config_for(self.config, request.id_type_table).header)
        df = self.load_table(request.table_name)
        if self.persist is not None:
            df = df.persist(self.persist)
        try:
            counted = None
            if self.count_with_checks:
                rules = rules_for(self.rules, request.id_type_table)
                row_count, counted = count_and_check(df, rules, has_header)
                writer.append(request.id_trigger, INGESTED, row_count)
            else:
                row_count = df.count()
                writer.append(request.id_trigger, INGESTED, row_count)
                rules = rules_for(self.rules, request.id_type_table)
            return validate_table(
                df,
                rules,
                has_header=has_header,
                load_reference=self.load_reference,
                business=self._business_of(request.id_type_table),
                mode=self.mode,
                row_count=row_count,
                counted=counted,
                checks_per_scan=self.checks_per_scan,
                on_flag=partial(writer.append, request.id_trigger),
            )
        finally:
            if self.persist is not None:
                df.unpersist()

    def _business_of(self, id_type_table: str) -> Sequence[BusinessRule]:
        return self.business(id_type_table) if callable(self.business) else self.business

    def _log(self, request: Row, violations: Sequence[Row], kind: str) -> None:
        if violations:
            report = report_of_rows(self.spark, violations)
            rows = log_rows(report, request.id_trigger, request.table_name, kind)
            with self._logging:
                append_log(self.log_sink, rows)

    def _fail(self, request: Row, writer: StatusWriter, error: Exception, duration_s: float) -> None:
        try:
            writer.append(request.id_trigger, SYSTEM_ERROR, duration_s=duration_s)
            writer.commit(request.id_trigger)
        except Exception as status_error:
            warnings.warn(f"request {request.id_trigger}: state not written: {status_error}",
                          stacklevel=2)
        message = str(error) or type(error).__name__
        row = violation(0, "execution", 0, SYSTEM_FIELD, EXECUTION_ERROR, 1, message)
        self._log(request, [row], SYSTEM_VALIDATION)
