"""Tables for the registered queries, derived by Spark from the given ones.

``mixed`` turns every event into a row of a template table with faults of every kind spread over it;
``clean`` turns every event into a row that passes all checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.local import local_frame
from tablecheck.rules import ColumnRule

# Keys of the template reference table.
TEMPLATE_CODES = tuple(str(n) for n in range(1, 15))

# Row expressions, in SQL that Spark and the checking engine read alike. ``rn`` is the place of a row
# in its group, known for the first five rows only.
SHEET = """
  CASE WHEN event_type IN ('signup', 'view', 'purchase', 'click', 'error') THEN event_type
       ELSE 'other' END"""

MIXED_TEMPLATE = "CAST(user_id % 20 AS STRING)"
MIXED_COLUMNS = {
    "template_code": "template_code",
    "sheet": "sheet",
    "data_type": "'metric'",
    "excel_cell": """
  CASE WHEN event_id % 997 = 0 THEN 'ABC1' WHEN event_id % 499 = 0 THEN '$B$3'
       WHEN event_id % 491 = 0 THEN 'B0'   WHEN event_id % 487 = 0 THEN 'B'
       WHEN event_id % 479 = 0 THEN '  '   WHEN event_id % 467 = 0 THEN NULL
       ELSE chr(CAST(65 + event_id % 8 AS INT)) || CAST(1 + event_id % 10050 AS STRING) END""",
    "column_x": """
  CASE WHEN event_id % 101 = 0 THEN 'XX' WHEN event_id % 103 = 0 THEN '  '
       WHEN event_id % 107 = 0 THEN NULL
       ELSE '_c' || CAST(event_id % 34 AS STRING) END""",
    "row_y": """
  CASE WHEN event_id % 211 = 0 THEN '1.5' WHEN event_id % 223 = 0 THEN ''
       WHEN event_id % 227 = 0 THEN 'abc'
       ELSE CAST(event_id AS STRING) END""",
    "data_name": """
  CASE WHEN template_code = '19' THEN 'metric'
       WHEN rn = 1 THEN 'data_as_of'
       WHEN rn = 2 AND template_code <> '11' THEN 'cristine_unit'
       WHEN rn = 3 THEN 'excel_title'
       WHEN rn = 4 AND template_code <> '13' THEN 'CCY_main'
       WHEN rn = 5 AND template_code = '7' THEN 'data_as_of'
       ELSE 'metric' END""",
    "as_of": """
  CASE WHEN event_id % 307 = 0 THEN '2024-01-05' WHEN event_id % 311 = 0 THEN '2024/02/30'
       WHEN event_id % 313 = 0 THEN ''
       ELSE '2024/01/' || CASE WHEN event_id % 28 < 9 THEN '0' ELSE '' END
            || CAST(1 + event_id % 28 AS STRING) END""",
}

CLEAN_TEMPLATE = (
    "CASE user_id % 14 "
    + " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(TEMPLATE_CODES))
    + " END"
)
CLEAN_COLUMNS = {
    "template_code": "template_code",
    "sheet": "sheet",
    "data_type": "'metric'",
    "excel_cell": "chr(CAST(65 + event_id % 8 AS INT)) || CAST(1 + event_id % 100 AS STRING)",
    "column_x": "'_c' || CAST(event_id % 34 AS STRING)",
    "row_y": "CAST(event_id AS STRING)",
    "data_name": """
  CASE rn WHEN 1 THEN 'data_as_of' WHEN 2 THEN 'cristine_unit' WHEN 3 THEN 'excel_title'
          WHEN 4 THEN 'CCY_main' ELSE 'metric' END""",
    "as_of": """
  '2024/01/' || CASE WHEN event_id % 28 < 9 THEN '0' ELSE '' END
       || CAST(1 + event_id % 28 AS STRING)""",
}

# One rule per column of both tables.
RULES = (
    ColumnRule("template_code", "STRING", "10", nullable=False, pk=True,
               referential_bbdd="ref", referential_table_field_name="td_templates.template_code"),
    ColumnRule("sheet", "STRING", "20", nullable=False, pk=True),
    ColumnRule("data_type", "STRING", "20"),
    ColumnRule("excel_cell", "STRING", "10"),
    ColumnRule("column_x", "STRING", "10"),
    ColumnRule("row_y", "INT", "18", nullable=False, pk=True),
    ColumnRule("data_name", "STRING", "20"),
    ColumnRule("as_of", "DATE(yyyy/MM/dd)", "10"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, MIXED_TEMPLATE, MIXED_COLUMNS)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, CLEAN_TEMPLATE, CLEAN_COLUMNS)


def _from_events(spark, sf_dir, template: str, columns: dict[str, str]) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.expr(SHEET).alias("sheet"), F.expr(template).alias("template_code")
    )
    # Ranks up to a small limit are cut per input partition before the shuffle. What is left holds
    # 5 rows for each of at most 20 codes x 6 sheets, however large the table: safe to broadcast. They
    # are found once, not again for every table that is derived from these rows.
    by_age = Window.partitionBy("template_code", "sheet").orderBy("event_id")
    first_rows = (
        events.withColumn("rn", F.row_number().over(by_age))
        .filter("rn <= 5")
        .select("event_id", "rn")
    )
    found = local_frame(spark, first_rows.collect(), first_rows.schema)
    rows = events.join(F.broadcast(found), "event_id", "left")
    return rows.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])


def templates(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("template_code", T.StringType())])
    return local_frame(spark, [(code,) for code in TEMPLATE_CODES], schema)


def template_references(spark: SparkSession):
    """A loader that knows the template table only."""

    def load(database: str, table: str, column: str) -> DataFrame:
        if (database, table) != ("ref", "td_templates"):
            raise LookupError(f"no reference table {database}.{table}")
        return templates(spark).select(column)

    return load


def given_references(spark: SparkSession, sf_dir: str):
    """A loader for the given tables, whatever the database is called."""
    return lambda database, name, column: table(spark, sf_dir, name).select(column)
