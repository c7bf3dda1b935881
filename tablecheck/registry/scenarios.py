"""Validation requests that reach every final state and every error code, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablecheck.local import local_frame
from tablecheck.plans import RequestRunner
from tablecheck.registry.fixtures import RULES, clean, mixed, template_references
from tablecheck.schemas import CONFIG_SCHEMA, LOG_SCHEMA, RULE_SCHEMA, STATUS_SCHEMA, TRIGGER_SCHEMA

# Table types: with header, without, with a date rule that has no format, and one without any
# configuration.
NAMED, POSITIONAL, BAD_RULE, UNKNOWN = "00001", "00002", "00003", "00009"

# Requests as (table, table type); the request id is the place in the list, from 1.
REQUESTS = (
    ("clean", NAMED),
    ("unnamed", POSITIONAL),
    ("no_as_of", NAMED),
    ("empty", NAMED),
    ("mixed", NAMED),
    ("blank_sheet", NAMED),
    ("long_type", NAMED),
    ("same_row", NAMED),
    ("unknown_code", NAMED),
    ("wrong_column", NAMED),
    ("missing_names", NAMED),
    ("nowhere", NAMED),
    ("clean", UNKNOWN),
    ("clean", BAD_RULE),
)


def _replace(column: str, condition: str, value: str) -> Callable[[DataFrame], DataFrame]:
    changed = F.when(F.expr(condition), F.lit(value)).otherwise(F.col(column))
    return lambda df: df.withColumn(column, changed)


def scenario_tables(
    clean_table: DataFrame, mixed_table: DataFrame
) -> Callable[[str], DataFrame]:
    """Loader of the tables named in ``REQUESTS``."""
    variants = {
        "clean": lambda df: df,
        "unnamed": lambda df: df.toDF(*[f"c{i}" for i in range(len(df.columns))]),
        "no_as_of": lambda df: df.drop("as_of"),
        "empty": lambda df: df.filter(F.lit(False)),
        "blank_sheet": _replace("sheet", "sheet = 'click'", "  "),
        "long_type": _replace("data_type", "template_code = '4'", "metric " * 3),
        "same_row": _replace("row_y", "true", "1"),
        "unknown_code": _replace("template_code", "template_code = '8'", "99"),
        "wrong_column": _replace("column_x", "true", "XX"),
        "missing_names": _replace(
            "data_name",
            "(template_code = '2' AND data_name = 'excel_title')"
            " OR (template_code = '3' AND data_name = 'CCY_main')",
            "metric",
        ),
    }

    def load(name: str) -> DataFrame:
        if name == "mixed":
            return mixed_table
        if name not in variants:
            raise LookupError(f"no table {name}")
        return variants[name](clean_table)

    return load


def control_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Triggers, configuration and rules."""
    at = datetime(2024, 1, 1, tzinfo=UTC)
    triggers = local_frame(
        spark,
        [(i, kind, name, at, 0, None) for i, (name, kind) in enumerate(REQUESTS, 1)],
        TRIGGER_SCHEMA,
    )
    config = local_frame(
        spark,
        [
            (NAMED, "named", True, "owner", len(RULES)),
            (POSITIONAL, "positional", False, "owner", len(RULES)),
            (BAD_RULE, "bad rule", True, "owner", len(RULES)),
        ],
        CONFIG_SCHEMA,
    )
    rules = local_frame(
        spark,
        [
            (
                kind, position, r.field_name, None, r.pk,
                "DATE" if kind == BAD_RULE and r.field_name == "as_of" else r.data_type,
                r.length, r.nullable, None,
                r.referential_bbdd, r.referential_table_field_name, None,
            )
            for kind in (NAMED, POSITIONAL, BAD_RULE)
            for position, r in enumerate(RULES, 1)
        ],
        RULE_SCHEMA,
    )
    return triggers, config, rules


class KeptRows:
    """A sink that keeps what it is given: the few rows of a log or a status table."""

    def __init__(self, spark: SparkSession, schema: StructType) -> None:
        self._spark, self._schema = spark, schema
        self.rows: list[Row] = []

    def __call__(self, df: DataFrame) -> None:
        self.rows += df.select(*self._schema.fieldNames()).collect()

    def frame(self) -> DataFrame:
        return local_frame(self._spark, self.rows, self._schema)


def run_requests(
    spark: SparkSession, sf_dir: str, mode: str = "fused", **options
) -> tuple[DataFrame, DataFrame]:
    """Run all requests; returns their log and their states. Nothing is written."""
    triggers, config, rules = control_tables(spark)
    log, status = KeptRows(spark, LOG_SCHEMA), KeptRows(spark, STATUS_SCHEMA)
    RequestRunner(
        spark,
        config,
        rules,
        load_table=scenario_tables(clean(spark, sf_dir), mixed(spark, sf_dir)),
        load_reference=template_references(spark),
        log_sink=log,
        status_sink=status,
        mode=mode,
        # The tables are derived from events: each is worked out once for all passes of its request.
        persist=StorageLevel.MEMORY_AND_DISK,
        **options,
    ).run_pending(triggers)
    return log.frame(), status.frame()
