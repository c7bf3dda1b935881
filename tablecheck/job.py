"""The batch job: ``spark-submit tablecheck/job.py --source ... `` validates all pending requests."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tablecheck.operators.report import COLUMNAR_CHECKS_PER_SCAN
from tablecheck.plans import RequestRunner
from tablecheck.schemas import (
    BUSINESS_SCHEMA,
    CONFIG_SCHEMA,
    RULE_SCHEMA,
    STATUS_SCHEMA,
    TRIGGER_SCHEMA,
)
from tablecheck.sinks import file_sink, jdbc_sink, table_sink
from tablecheck.sources import (
    business_rules_for,
    catalog_references,
    catalog_tables,
    file_references,
    file_tables,
    jdbc_references,
    jdbc_tables,
)

# Names of the control tables, unless arguments say otherwise.
TRIGGERS = "public.trigger_control"
CONFIG = "public.table_configuration"
RULES = "public.semantic_layer"
LOG = "public.process_validation_logs"
STATUS = "public.trigger_status"


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", choices=("files", "catalog", "jdbc"), required=True)
    parser.add_argument("--root", help="files: folder of the tables, <root>/<table name>.<format>")
    parser.add_argument("--format", default="parquet", help="files: their format")
    parser.add_argument("--url", help="jdbc: where to connect")
    parser.add_argument(
        "--property", action="append", default=[], metavar="NAME=VALUE",
        help="jdbc: connection properties such as user, password, driver",
    )
    parser.add_argument(
        "--key", action="append", default=[], metavar="TABLE=COLUMN",
        help="jdbc: column of any ordered type to read a table in parallel by",
    )
    parser.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE",
        help="files: options for reading tables and references, such as header=true",
    )
    parser.add_argument("--partitions", type=int, help="jdbc: ranges per table; by its rows if not given")
    parser.add_argument(
        "--persist", action="store_true", help="keep each table between passes; jdbc always does"
    )
    parser.add_argument(
        "--reopen", action="append", default=[], type=int, metavar="ID",
        help="validate this request again, whatever its state",
    )
    parser.add_argument(
        "--business", help="table of business rules by table type; the built-in ones if not given"
    )
    parser.add_argument("--triggers", default=TRIGGERS)
    parser.add_argument("--config", default=CONFIG)
    parser.add_argument("--rules", default=RULES)
    parser.add_argument("--log", default=LOG)
    parser.add_argument("--status", default=STATUS)
    parser.add_argument("--workers", type=int, default=1, help="requests validated side by side")
    parser.add_argument(
        "--one-commit", action="store_true", help="write the states of a request once, behind its log rows"
    )
    parser.add_argument("--mode", choices=("fused", "gated"), default="fused")
    given = parser.parse_args(argv)
    for option in {"files": ["root"], "jdbc": ["url"]}.get(given.source, []):
        if not getattr(given, option):
            parser.error(f"--source {given.source} needs --{option}")
    return given


def run(spark: SparkSession, given: argparse.Namespace) -> int:
    """Validate all pending requests; returns how many there were."""
    persist = StorageLevel.MEMORY_AND_DISK if given.persist else None
    checks_per_scan, count_with_checks = None, False
    if given.source == "files":
        options = _pairs(given.option)
        load = file_tables(spark, given.root, given.format, **options)
        references = file_references(spark, given.root, given.format, **options)
        sink, control = _file_sinks(given), _file_control(spark, given)
        if given.format in ("parquet", "orc") and persist is None:
            checks_per_scan = COLUMNAR_CHECKS_PER_SCAN
        # Text files have no count of their own: one scan counts and checks.
        count_with_checks = given.format not in ("parquet", "orc") and persist is None
    elif given.source == "catalog":
        load, references, sink = catalog_tables(spark), catalog_references(spark), table_sink
        control = _any_control(load)
    else:
        properties, keys = _pairs(given.property), _pairs(given.key)
        load = jdbc_tables(spark, given.url, properties, keys, given.partitions)
        references = jdbc_references(spark, given.url, properties)
        sink = _jdbc_sinks(given, properties)
        # Control tables are small: one task reads them.
        control = _any_control(lambda name: spark.read.jdbc(given.url, name, properties=properties))
        # One read of the database serves all passes.
        persist = StorageLevel.MEMORY_AND_DISK
    business = {}
    if given.business:
        rules = control(given.business, BUSINESS_SCHEMA)
        business = {"business": lambda id_type_table: business_rules_for(rules, id_type_table)}
    runner = RequestRunner(
        spark,
        config=control(given.config, CONFIG_SCHEMA),
        rules=control(given.rules, RULE_SCHEMA),
        load_table=load,
        load_reference=references,
        log_sink=sink(given.log),
        status_sink=sink(given.status),
        mode=given.mode,
        persist=persist,
        checks_per_scan=checks_per_scan,
        count_with_checks=count_with_checks,
        workers=given.workers,
        one_commit=given.one_commit,
        **business,
    )
    runner.reopen(given.reopen)
    triggers = control(given.triggers, TRIGGER_SCHEMA)
    return runner.run_pending(triggers, _status_so_far(control, given.status))


def _any_control(load):
    """Control tables that bring their own schema."""
    return lambda name, schema: load(name)


def _file_control(spark, given):
    """Control tables as files have the schemas of this package, and text files of them a header."""
    return lambda name, schema: file_tables(
        spark, given.root, given.format, schema, **_control_options(given)
    )(name)


def _control_options(given) -> dict[str, str]:
    return {"header": "true"} if given.format == "csv" else {}


def _file_sinks(given):
    return lambda name: file_sink(
        f"{given.root}/{name}.{given.format}", given.format, **_control_options(given)
    )


def _jdbc_sinks(given, properties):
    return lambda name: jdbc_sink(given.url, name, properties)


def _status_so_far(control, name: str) -> DataFrame | None:
    """The status table, which the first run has yet to write."""
    try:
        return control(name, STATUS_SCHEMA)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise


def _pairs(texts: Sequence[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


if __name__ == "__main__":
    options = arguments()
    builder = SparkSession.builder.appName("tablecheck")
    if options.workers > 1:
        builder = builder.config("spark.scheduler.mode", "FAIR")
    session = builder.getOrCreate()
    print(f"{run(session, options)} requests validated")
    session.stop()
