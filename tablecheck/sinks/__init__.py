from tablecheck.sinks.log import append_log, capped_message, current_log, log_rows
from tablecheck.sinks.status import StatusWriter, compacted_status, current_status
from tablecheck.sinks.targets import (
    file_sink,
    jdbc_sink,
    overwrite_jdbc_table,
    table_sink,
)

__all__ = [
    "StatusWriter",
    "append_log",
    "capped_message",
    "compacted_status",
    "current_log",
    "current_status",
    "file_sink",
    "jdbc_sink",
    "log_rows",
    "overwrite_jdbc_table",
    "table_sink",
]
