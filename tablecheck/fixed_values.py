"""Values that callers, stored rules and stored results rely on."""

# --- Fixed values: interface constants, stated as they must be ---------------

# Logical types: whole-value patterns (JVM regex).
INT_PATTERN = "^-?[0-9]+$"
DECIMAL_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"

# Error codes.
STRUCTURE_MISMATCH = "STRUCTURE_MISMATCH"
DATA_TYPE_ERROR = "DATA_TYPE_ERROR"
NOT_NULL_ERROR = "NOT_NULL_ERROR"
LENGTH_ERROR = "LENGTH_ERROR"
PK_ERROR = "PK_ERROR"
REF_INTEGRITY_ERROR = "REF_INTEGRITY_ERROR"
FUNCTIONAL_ERROR = "FUNCTIONAL_ERROR"
EXECUTION_ERROR = "EXECUTION_ERROR"

# Request states.
PENDING = 0
INGESTED = 1
PROCESSING = 11
STRUCTURE_OK = 12
TECHNICAL_OK = 13
REFERENCES_OK = 14
COMPLETED = 2
SYSTEM_ERROR = 3
STRUCTURE_FAILED = 31
TECHNICAL_FAILED = 32
REFERENCES_FAILED = 33
FUNCTIONAL_FAILED = 34

# Error-log rows.
TABLE_VALIDATION = "table_validation"
FUNCTIONAL_VALIDATION = "functional_validation"
SYSTEM_VALIDATION = "system_error"
ALL_COLUMNS = "ALL_COLUMNS"
SYSTEM_FIELD = "SYSTEM"
LOG_INCIDENCES = "1"
LOG_FLAG = 1
MESSAGE_LIMIT = 255
MESSAGE_KEPT = 250
MESSAGE_TAIL = "..."

# Default business rules.
GROUP_COLUMNS = ("template_code", "sheet")
NAME_COLUMN = "data_name"
REQUIRED_NAMES = ("data_as_of", "cristine_unit", "excel_title")
CURRENCY_PREFIX = "ccy"
PREFIXED_COLUMN = "column_x"
COLUMN_PREFIX = "_c"
CELL_COLUMN = "excel_cell"

# JDBC reads.
FETCH_SIZE = 10_000

# --- end of fixed values ------------------------------------------------------
