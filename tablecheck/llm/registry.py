"""What ``__spark_entry__`` registers of this subpackage."""

import corpus_pipeline
from tablecheck.llm.oracle import ORACLE_SQL as _ORACLE_SQL
from tablecheck.llm.queries import QUERIES as _QUERIES

QUERIES = {**_QUERIES, "pipeline": corpus_pipeline.run}
ORACLE_SQL = _ORACLE_SQL
