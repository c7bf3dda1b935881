"""Schemas of the control tables and of the results."""

from pyspark.sql import types as T


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_text, _int, _long = T.StringType(), T.IntegerType(), T.LongType()
_bool, _time, _double = T.BooleanType(), T.TimestampType(), T.DoubleType()

# Column names of the control and log tables.
TRIGGER_SCHEMA = _schema(
    ("id_trigger", _int),
    ("id_type_table", _text),
    ("table_name", _text),
    ("tst_trigger_control", _time),
    ("flag", _int),
    ("row_count", _long),
)
CONFIG_SCHEMA = _schema(
    ("id_type_table", _text),
    ("type_table_name", _text),
    ("header", _bool),
    ("user_id", _text),
    ("nCols", _int),
)
RULE_SCHEMA = _schema(
    ("id_type_table", _text),
    ("field_position", _int),
    ("field_name", _text),
    ("field_description", _text),
    ("pk", _bool),
    ("data_type", _text),
    ("length", _text),
    ("nullable", _bool),
    ("decimal_symbol", _text),
    ("referential_bbdd", _text),
    ("referential_table_field_name", _text),
    ("init_date", _time),
)
LOG_SCHEMA = _schema(
    ("id_trigger", _int),
    ("validation_id", _text),
    ("type_validation", _text),
    ("table_name", _text),
    ("validation_msg", _text),
    ("field_name", _text),
    ("incidences", _text),
    ("flag", _int),
    ("execution_timestamp", _time),
)

# One business rule per row; ``names`` are separated by commas, what a kind does not use stays null.
BUSINESS_SCHEMA = _schema(
    ("id_type_table", _text),
    ("position", _int),
    ("kind", _text),
    ("column_name", _text),
    ("group_columns", _text),
    ("names", _text),
    ("prefix", _text),
    ("n_cols", _int),
    ("n_rows", _int),
)

# One row per state a request went through; ``seq`` orders them.
STATUS_SCHEMA = _schema(
    ("id_trigger", _int),
    ("flag", _int),
    ("row_count", _long),
    ("seq", _long),
    ("event_time", _time),
    ("duration_s", _double),
)

# One row per check that was counted; ``seq`` is its place among its kind.
REPORT_SCHEMA = _schema(
    ("phase", _int),
    ("check_name", _text),
    ("seq", _int),
    ("column_name", _text),
    ("error_type", _text),
    ("n_violations", _long),
    ("error_message", _text),
)
