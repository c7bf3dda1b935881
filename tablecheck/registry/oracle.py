"""SQL for DuckDB that gives the result of each registered query from the given tables."""

from __future__ import annotations

from tablecheck.fixed_values import REQUIRED_NAMES
from tablecheck.registry.fixtures import (
    CLEAN_COLUMNS,
    CLEAN_TEMPLATE,
    MIXED_COLUMNS,
    MIXED_TEMPLATE,
    SHEET,
    TEMPLATE_CODES,
)
from tablecheck.registry.scenarios import REQUESTS


def _events_cte(name: str, template: str, columns: dict[str, str]) -> str:
    selected = ", ".join(f"{sql} AS {column}" for column, sql in columns.items())
    return f"""{name} AS (
  SELECT {selected} FROM (
    SELECT event_id, sheet, template_code,
      row_number() OVER (PARTITION BY template_code, sheet ORDER BY event_id) AS rn
    FROM (SELECT event_id, {SHEET} AS sheet, {template} AS template_code FROM events) e) r)"""


_MIXED = _events_cte("mixed", MIXED_TEMPLATE, MIXED_COLUMNS)
_CLEAN = _events_cte("clean", CLEAN_TEMPLATE, CLEAN_COLUMNS)
_CODES = ", ".join(f"('{code}')" for code in TEMPLATE_CODES)
_TEMPLATES = f"td_templates AS (SELECT * FROM (VALUES {_CODES}) v(template_code))"


# --- conditions and counts ---


def _filled(c: str) -> str:
    return f"({c} IS NOT NULL AND trim({c}, ' ') <> '')"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}, ' ') = '')"


def _not_int(c: str) -> str:
    return f"({_filled(c)} AND NOT regexp_full_match({c}, '-?[0-9]+'))"


def _not_decimal(c: str) -> str:
    return f"({_filled(c)} AND NOT regexp_full_match({c}, '-?[0-9]+(\\.[0-9]+)?'))"


def _not_date(c: str) -> str:
    shape = f"regexp_full_match({c}, '[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}')"
    return f"({_filled(c)} AND NOT ({shape} AND try_strptime({c}, '%Y/%m/%d') IS NOT NULL))"


def _column_names(n_cols: int) -> str:
    """The names of a sheet's first columns: A to Z, then AA, AB and so on."""
    single = [chr(65 + i) for i in range(26)]
    names = single + [a + b for a in single for b in single]
    return ", ".join(f"'{name}'" for name in names[:n_cols])


def _outside(c: str, n_cols: int, n_rows: str) -> str:
    """A column that is none of the sheet's, or a readable row that is none of its rows."""
    in_columns = f"upper(regexp_extract({c}, '^[A-Za-z]*')) IN ({_column_names(n_cols)})"
    row = f"TRY_CAST(regexp_extract({c}, '[0-9]+$') AS BIGINT)"
    return f"({_filled(c)} AND NOT ({in_columns} AND coalesce({row} BETWEEN 1 AND {n_rows}, true)))"


def _rows_where(condition: str, source: str) -> str:
    return f"SELECT count(*) FILTER (WHERE {condition}) AS n FROM {source}"


def _surplus(keys: str, source: str) -> str:
    return f"SELECT coalesce(sum(k - 1), 0) AS n FROM (SELECT count(*) AS k FROM {source} GROUP BY {keys}) g"


def _lacking(column: str, source: str, known: str, reference: str) -> str:
    return (
        f"SELECT count(DISTINCT {column}) AS n FROM {source} t WHERE NOT EXISTS"
        f" (SELECT 1 FROM {reference} r WHERE CAST(r.{known} AS VARCHAR) = CAST(t.{column} AS VARCHAR))"
    )


def _not_once(keys: str, name: str, value: str, required: list[str], source: str, every=False) -> str:
    names = ", ".join(f"'{v}'" for v in required)
    having = "" if every else f"HAVING count(*) FILTER (WHERE {name} IN ({names})) > 0"
    return (
        f"SELECT count(*) FILTER (WHERE k <> 1) AS n FROM (SELECT count(*) FILTER"
        f" (WHERE {name} = '{value}') AS k FROM {source} GROUP BY {keys} {having}) g"
    )


def _none_with(keys: str, name: str, prefix: str, source: str) -> str:
    return (
        f"SELECT count(*) FILTER (WHERE NOT found) AS n FROM (SELECT coalesce(bool_or("
        f"starts_with(lower({name}), '{prefix.lower()}')), false) AS found FROM {source} GROUP BY {keys}) g"
    )


# --- report rows ---


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _row(phase, check, column, error, count_sql, before, after) -> str:
    return (
        f"SELECT CAST({phase} AS INTEGER) AS phase, {_quote(check)} AS check_name,"
        f" {_quote(column)} AS column_name, {_quote(error)} AS error_type,"
        f" CAST(n AS BIGINT) AS n_violations,"
        f" {_quote(before)} || CAST(n AS BIGINT) || {_quote(after)} AS error_message"
        f" FROM ({count_sql}) c"
    )


def _type_row(column, kind, condition, source):
    return _row(2, "data_type", column, "DATA_TYPE_ERROR", _rows_where(condition, source),
                f"{column}: ", f" values are not a valid {kind}")


def _null_row(column, source, text=None):
    return _row(2, "not_null", column, "NOT_NULL_ERROR",
                _rows_where(_blank(text or column), source), f"{column}: ", " values are null or blank")


def _length_row(column, limit, source, text=None):
    return _row(2, "max_length", column, "LENGTH_ERROR",
                _rows_where(f"length({text or column}) > {limit}", source),
                f"{column}: ", f" values are longer than {limit}")


def _key_row(columns, source):
    return _row(2, "primary_key", ",".join(columns), "PK_ERROR", _surplus(", ".join(columns), source),
                f"key ({', '.join(columns)}): ", " surplus rows")


def _reference_row(column, source, known, reference, shown=None):
    return _row(3, "reference", column, "REF_INTEGRITY_ERROR",
                _lacking(column, source, known, reference),
                f"{column}: ", f" values do not exist in {shown or 'given.' + reference}.{known}")


def _once_row(keys, name, value, required, source, every=False):
    return _row(4, "exactly_one", name, "FUNCTIONAL_ERROR",
                _not_once(", ".join(keys), name, value, required, source, every),
                f"{name}='{value}': ", f" groups ({', '.join(keys)}) do not have exactly one row")


def _some_row(keys, name, prefix, source):
    return _row(4, "at_least_one", name, "FUNCTIONAL_ERROR",
                _none_with(", ".join(keys), name, prefix, source),
                f"{name} starting with '{prefix}': ", f" groups ({', '.join(keys)}) have no row")


def _prefix_row(column, prefix, source):
    condition = f"({_filled(column)} AND NOT starts_with({column}, '{prefix}'))"
    return _row(4, "starts_with", column, "FUNCTIONAL_ERROR", _rows_where(condition, source),
                f"{column}: ", f" values do not start with '{prefix}'")


def _cell_row(column, n_cols, source):
    """The row limit is the number of rows, which the message names too."""
    size = f"(SELECT count(*) FROM {source})"
    return (
        "SELECT CAST(4 AS INTEGER) AS phase, 'cell_range' AS check_name,"
        f" '{column}' AS column_name, 'FUNCTIONAL_ERROR' AS error_type,"
        " CAST(n AS BIGINT) AS n_violations,"
        f" '{column}: ' || CAST(n AS BIGINT) || ' cells are outside {n_cols} columns x '"
        f" || {size} || ' rows' AS error_message"
        f" FROM ({_rows_where(_outside(column, n_cols, size), source)}) c"
    )


def _report(rows: list[str], *ctes: str) -> str:
    head = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
    return head + "\nUNION ALL\n".join(rows)


_GROUP = ["template_code", "sheet"]
_NAMES = list(REQUIRED_NAMES)


def _type_rows(source):
    return [
        _type_row("row_y", "INT", _not_int("row_y"), source),
        _type_row("as_of", "DATE", _not_date("as_of"), source),
    ]


def _technical_rows(source):
    lengths = {
        "template_code": 10, "sheet": 20, "data_type": 20, "excel_cell": 10, "column_x": 10,
        "row_y": 18, "data_name": 20, "as_of": 10,
    }
    return [
        *_type_rows(source),
        *[_null_row(c, source) for c in ("template_code", "sheet", "row_y")],
        *[_length_row(c, limit, source) for c, limit in lengths.items()],
        _key_row(["template_code", "sheet", "row_y"], source),
    ]


def _template_row(source):
    return _reference_row("template_code", source, "template_code", "td_templates", "ref.td_templates")


def _once_rows(source, every=False):
    return [_once_row(_GROUP, "data_name", name, _NAMES, source, every) for name in _NAMES]


def _business_rows(source):
    return [
        *_once_rows(source),
        _some_row(_GROUP, "data_name", "ccy", source),
        _prefix_row("column_x", "_c", source),
        _cell_row("excel_cell", 8, source),
    ]


# --- structure ---

_ORDER_NAMES = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority"


def _structure_row(case: str, ok: bool, message: str | None, names: str, rows: str = "orders") -> str:
    shown = "CAST(NULL AS VARCHAR)" if message is None else _quote(message)
    return (
        f"SELECT '{case}' AS case_name, {str(ok).lower()} AS ok, {shown} AS message,"
        f" '{names}' AS names, count(*) AS n_rows, CAST(sum(o_custkey) AS BIGINT) AS customer_sum"
        f" FROM {rows}"
    )


_STRUCTURE = "\nUNION ALL\n".join(
    [
        _structure_row("same", True, None, _ORDER_NAMES),
        _structure_row("permuted", True, None, ",".join(reversed(_ORDER_NAMES.upper().split(",")))),
        _structure_row("by_position", True, None, "c0,c1,c2,c3,c4,c5"),
        _structure_row(
            "by_wrong_name", False, "missing: priority. extra: o_orderpriority", _ORDER_NAMES
        ),
        _structure_row(
            "too_few", False, "wrong number of columns: expected 5, found 6", _ORDER_NAMES
        ),
        _structure_row(
            "repeated", False, "expected names occur more than once: o_custkey", _ORDER_NAMES
        ),
        _structure_row(
            "no_rows", False, "the table is empty (0 rows)", _ORDER_NAMES,
            "(SELECT * FROM orders WHERE false) o",
        ),
    ]
)


# --- requests: every check of every requested table is counted, then the gate is applied ---

_VARIANTS = {
    "clean": "SELECT * FROM clean",
    "unnamed": "SELECT * FROM clean",
    "mixed": "SELECT * FROM mixed",
    "blank_sheet": "SELECT * REPLACE (CASE WHEN sheet = 'click' THEN '  ' ELSE sheet END AS sheet) FROM clean",
    "long_type": "SELECT * REPLACE (CASE WHEN template_code = '4' THEN 'metric metric metric '"
    " ELSE data_type END AS data_type) FROM clean",
    "same_row": "SELECT * REPLACE ('1' AS row_y) FROM clean",
    "unknown_code": "SELECT * REPLACE (CASE WHEN template_code = '8' THEN '99'"
    " ELSE template_code END AS template_code) FROM clean",
    "wrong_column": "SELECT * REPLACE ('XX' AS column_x) FROM clean",
    "missing_names": "SELECT * REPLACE (CASE WHEN template_code = '2' AND data_name = 'excel_title'"
    " OR template_code = '3' AND data_name = 'CCY_main' THEN 'metric' ELSE data_name END AS data_name)"
    " FROM clean",
}
_STAGES = ("data_type", "not_null", "max_length", "primary_key", "reference")


def _requests() -> list[str]:
    """CTEs: the tables, all counts per request, the first stage with a violation, the failures."""
    ctes = [_MIXED, _CLEAN, _TEMPLATES]
    ctes += [f"t_{name} AS ({sql})" for name, sql in _VARIANTS.items()]
    counted, sizes = [], []
    for request, (name, kind) in enumerate(REQUESTS, 1):
        if name in _VARIANTS and kind in ("00001", "00002"):
            source = f"t_{name}"
            rows = _technical_rows(source) + [_template_row(source)] + _business_rows(source)
            counted += [f"SELECT {request} AS id, * FROM ({row}) q" for row in rows]
            sizes.append(f"SELECT {request} AS id, count(*) AS n_rows FROM {source}")
    stage = " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(_STAGES))
    ctes.append("counted AS (" + "\nUNION ALL\n".join(counted) + ")")
    ctes.append("sizes AS (" + " UNION ALL ".join(sizes) + ")")
    ctes.append(
        f"staged AS (SELECT *, CASE check_name {stage} ELSE {len(_STAGES)} END AS stage"
        " FROM counted WHERE n_violations > 0)"
    )
    ctes.append("first_stage AS (SELECT id, min(stage) AS stage FROM staged GROUP BY id)")
    fixed = []
    for request, (name, kind) in enumerate(REQUESTS, 1):
        if kind == "00009":
            fixed.append((request, 3, None, "EXECUTION_ERROR", "system_error", "SYSTEM",
                          f"no configuration for table type '{kind}'"))
        elif name == "nowhere":
            fixed.append((request, 3, None, "EXECUTION_ERROR", "system_error", "SYSTEM",
                          "no table nowhere"))
        elif kind == "00003":
            fixed.append((request, 3, "(SELECT count(*) FROM clean)", "EXECUTION_ERROR",
                          "system_error", "SYSTEM", "as_of: 'DATE' is not a date format"))
        elif name == "empty":
            fixed.append((request, 31, "0", "STRUCTURE_MISMATCH", "table_validation", "ALL_COLUMNS",
                          "the table is empty (0 rows)"))
        elif name == "no_as_of":
            fixed.append((request, 31, "(SELECT count(*) FROM clean)", "STRUCTURE_MISMATCH",
                          "table_validation", "ALL_COLUMNS",
                          "wrong number of columns: expected 8, found 7"))
    ctes.append(
        "fixed AS ("
        + " UNION ALL ".join(
            f"SELECT {request} AS id, {flag} AS flag, {rows or 'NULL'} AS n_rows, '{code}' AS code,"
            f" '{kind}' AS kind, '{field}' AS field, {_quote(message)} AS message"
            for request, flag, rows, code, kind, field, message in fixed
        )
        + ")"
    )
    return ctes


_REQUESTS = "WITH " + ",\n".join(_requests())
_FLAGS = f"""{_REQUESTS},
flags AS (
  SELECT s.id, CASE WHEN f.stage IS NULL THEN 2 WHEN f.stage < 4 THEN 32
                    WHEN f.stage = 4 THEN 33 ELSE 34 END AS flag, s.n_rows
  FROM sizes s LEFT JOIN first_stage f ON s.id = f.id
  UNION ALL SELECT id, flag, n_rows FROM fixed)"""
_REQUEST_FLAGS = f"""{_FLAGS}
SELECT CAST(id AS INTEGER) AS id_trigger, CAST(flag AS INTEGER) AS flag,
  CAST(n_rows AS BIGINT) AS row_count FROM flags"""
# The states before the final one: ingested if counted, then as far as the phases passed.
_REQUEST_HISTORY = f"""{_FLAGS},
steps AS (
  SELECT id, 1 AS step, 1 AS flag, n_rows FROM flags WHERE n_rows IS NOT NULL
  UNION ALL SELECT id, 2, 11, NULL FROM flags WHERE n_rows IS NOT NULL
  UNION ALL SELECT id, 3, 12, NULL FROM flags WHERE n_rows IS NOT NULL AND flag <> 31
  UNION ALL SELECT id, 4, 13, NULL FROM flags WHERE flag IN (33, 34, 2)
  UNION ALL SELECT id, 5, 14, NULL FROM flags WHERE flag IN (34, 2)
  UNION ALL SELECT id, 6, flag, NULL FROM flags)
SELECT CAST(id AS INTEGER) AS id_trigger,
  CAST(row_number() OVER (PARTITION BY id ORDER BY step) - 1 AS INTEGER) AS place,
  CAST(flag AS INTEGER) AS flag, CAST(n_rows AS BIGINT) AS row_count
FROM steps"""
_TABLE_NAMES = " ".join(f"WHEN {i} THEN '{name}'" for i, (name, _) in enumerate(REQUESTS, 1))
_ERROR_LOG = f"""{_REQUESTS},
logged AS (
  SELECT s.id, s.error_type AS code, 'functional_validation' AS kind, s.column_name AS field,
    s.error_message AS message
  FROM staged s JOIN first_stage f ON s.id = f.id AND s.stage = f.stage
  UNION ALL SELECT id, code, kind, field, message FROM fixed)
SELECT CAST(id AS INTEGER) AS id_trigger, code AS validation_id, kind AS type_validation,
  CASE id {_TABLE_NAMES} END AS table_name, message AS validation_msg, field AS field_name,
  '1' AS incidences, CAST(1 AS INTEGER) AS flag
FROM logged"""

_EVENT_STATUS = """status AS (
  SELECT CAST(user_id AS INTEGER) AS id_trigger,
    CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 11
      WHEN 'purchase' THEN 2 ELSE 3 END AS flag,
    CASE WHEN event_type = 'view' THEN event_id END AS row_count, event_id AS seq
  FROM events),
latest AS (
  SELECT id_trigger, CAST(arg_max(flag, seq) AS INTEGER) AS flag,
    arg_max(row_count, seq) FILTER (WHERE row_count IS NOT NULL) AS row_count
  FROM status GROUP BY id_trigger)"""


def _counted_ranges(name: str, source: str) -> str:
    """Ranges start at the distinct lowest keys of eight equal parts; NULL keys come last."""
    return f"""
WITH t AS ({source}),
parts AS (SELECT k, ntile(8) OVER (ORDER BY k) AS part FROM t WHERE k IS NOT NULL),
cuts AS (SELECT DISTINCT cut FROM (SELECT min(k) AS cut FROM parts GROUP BY part) m),
placed AS (SELECT cut AS low, lead(cut) OVER (ORDER BY cut) AS high,
             row_number() OVER (ORDER BY cut) - 1 AS range_no FROM cuts)
SELECT '{name}' AS keys, CAST(range_no AS INTEGER) AS range_no,
  (SELECT count(*) FROM t WHERE k >= low AND (high IS NULL OR k < high)) AS n_rows FROM placed
UNION ALL
SELECT '{name}', CAST((SELECT count(*) FROM cuts) AS INTEGER), (SELECT count(*) FROM t WHERE k IS NULL)"""


def _cut_edges(name: str, source: str) -> str:
    """Distinct lowest keys of a hundred equal parts but the lowest of all, with the rows below."""
    return f"""
SELECT '{name}' AS keys, CAST(row_number() OVER (ORDER BY cut) AS INTEGER) AS edge_no,
  CAST(cut AS VARCHAR) AS edge, n_below
FROM (
  SELECT cut, (SELECT count(*) FROM ({source}) u WHERE u.k < cut) AS n_below
  FROM (SELECT DISTINCT min(k) AS cut FROM (
          SELECT k, ntile(100) OVER (ORDER BY k) AS part FROM ({source}) t WHERE k IS NOT NULL) p
        GROUP BY part) m) c
WHERE n_below > 0"""


# All checks of the rule set in the order of a report; none of them depends on the data.
_PLACED_CHECKS = "SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({i} AS INTEGER), '{check}', '{column}')"
    for i, (check, column) in enumerate(
        [
            ("data_type", "row_y"),
            ("data_type", "as_of"),
            *[("not_null", c) for c in ("template_code", "sheet", "row_y")],
            *[
                ("max_length", c)
                for c in (
                    "template_code", "sheet", "data_type", "excel_cell", "column_x", "row_y",
                    "data_name", "as_of",
                )
            ],
            ("primary_key", "template_code,sheet,row_y"),
            ("reference", "template_code"),
            *[("exactly_one", "data_name")] * len(REQUIRED_NAMES),
            ("at_least_one", "data_name"),
            ("starts_with", "column_x"),
            ("cell_range", "excel_cell"),
        ]
    )
) + ") v(place, check_name, column_name)"

ORACLE_SQL: dict[str, str] = {
    "type_int": _report(
        [
            _type_row("row_y", "INT", _not_int("row_y"), "mixed"),
            _type_row("template_code", "INT", _not_int("template_code"), "mixed"),
        ],
        _MIXED,
    ),
    "type_decimal": _report([_type_row("row_y", "DECIMAL", _not_decimal("row_y"), "mixed")], _MIXED),
    "type_date": _report([_type_row("as_of", "DATE", _not_date("as_of"), "mixed")], _MIXED),
    "type_stored": _report(
        [
            _type_row("o_orderkey", "INT", _not_int("CAST(o_orderkey AS VARCHAR)"), "orders"),
            _type_row("o_custkey", "DECIMAL", _not_decimal("CAST(o_custkey AS VARCHAR)"), "orders"),
            _type_row("o_orderdate", "DATE", "false", "orders"),
            _type_row("o_orderpriority", "INT", _not_int("o_orderpriority"), "orders"),
        ]
    ),
    "type_stored_dates": _report(
        [
            _type_row("o_orderdate", "DATE", "false", "orders"),
            _type_row("o_day", "DATE", "false", "orders"),
            _type_row("o_custkey", "DATE", "o_custkey IS NOT NULL", "orders"),
            _type_row("o_orderdate", "DATE", "false", "orders"),
            _type_row("o_orderpriority", "DATE", _not_date("o_orderpriority"), "orders"),
        ]
    ),
    "not_null": _report(
        [_null_row(c, "mixed") for c in ("column_x", "excel_cell", "row_y", "as_of")], _MIXED
    ),
    "max_length": _report(
        [
            _length_row("data_name", 10, "mixed"),
            _length_row("excel_cell", 4, "mixed"),
            _length_row("as_of", 10, "mixed"),
        ],
        _MIXED,
    ),
    "primary_key": _report(
        [
            _key_row(["template_code", "sheet"], "mixed"),
            _key_row(["template_code", "sheet", "data_name"], "mixed"),
            _key_row(["template_code", "sheet", "row_y"], "mixed"),
        ],
        _MIXED,
    ),
    "primary_key_lineitem": _report([_key_row(["l_orderkey", "l_linenumber"], "lineitem")]),
    "primary_key_odd_names": _report(
        [_key_row(["surplus", "none"], "odd"), _key_row(["k0", "none"], "odd")],
        'odd AS (SELECT l_orderkey AS surplus, l_linenumber AS "none", l_suppkey AS k0 FROM lineitem)',
    ),
    "primary_key_conversations": _report([_key_row(["conv_id", "turn"], "conversations")]),
    "technical_rules": _report(_technical_rows("mixed"), _MIXED),
    "technical_documents": _report(
        [
            _type_row("doc_id", "INT", _not_int("CAST(doc_id AS VARCHAR)"), "documents"),
            _type_row("source", "DECIMAL", _not_decimal("source"), "documents"),
            _type_row("n_chars", "INT", _not_int("CAST(n_chars AS VARCHAR)"), "documents"),
            _null_row("doc_id", "documents", "CAST(doc_id AS VARCHAR)"),
            _null_row("text", "documents"),
            _null_row("lang", "documents"),
            _length_row("text", 5000, "documents"),
            _length_row("lang", 2, "documents"),
            _length_row("source", 4, "documents"),
            _length_row("n_chars", 3, "documents", "CAST(n_chars AS VARCHAR)"),
            _key_row(["doc_id"], "documents"),
        ]
    ),
    "referential": _report([_template_row("mixed")], _MIXED, _TEMPLATES),
    "referential_formats": _report(
        [
            _row(3, "reference_format", "l_orderkey", "REF_INTEGRITY_ERROR", "SELECT 1 AS n",
                 "l_orderkey: reference 'orders' is not of the form table.column", "").replace(
                     "|| CAST(n AS BIGINT) ", ""),
            _row(3, "reference_format", "l_partkey", "REF_INTEGRITY_ERROR", "SELECT 1 AS n",
                 "l_partkey: reference 'part.p_partkey.x' is not of the form table.column",
                 "").replace("|| CAST(n AS BIGINT) ", ""),
            _row(3, "reference", "l_linenumber", "REF_INTEGRITY_ERROR", "SELECT 1 AS n",
                 "l_linenumber: could not be checked against given.absent - it is not there",
                 "").replace("|| CAST(n AS BIGINT) ", ""),
            _reference_row("l_suppkey", "lineitem", "s_suppkey", "supplier"),
        ]
    ),
    "referential_documents": _report([_reference_row("doc_id", "documents", "doc_id", "labels")]),
    "referential_clean": _report(
        [
            _reference_row("o_custkey", "orders", "c_custkey", "customer"),
            _reference_row("l_orderkey", "lineitem", "o_orderkey", "orders"),
            _reference_row("l_partkey", "lineitem", "p_partkey", "part"),
            _reference_row("l_suppkey", "lineitem", "s_suppkey", "supplier"),
        ]
    ),
    "referential_shared": _report(
        [
            _reference_row("l_suppkey", "lineitem", "s_suppkey", "supplier"),
            _reference_row("l_partkey", "lineitem", "s_suppkey", "supplier"),
        ]
    ),
    "reference_orders_customers": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS value FROM orders"
    " WHERE o_custkey IS NOT NULL",
    "exactly_one": _report(_once_rows("mixed"), _MIXED),
    "exactly_one_all_groups": _report(_once_rows("mixed", every=True), _MIXED),
    "at_least_one": _report([_some_row(_GROUP, "data_name", "ccy", "mixed")], _MIXED),
    "prefix": _report([_prefix_row("column_x", "_c", "mixed")], _MIXED),
    "cell_range": _report([_cell_row("excel_cell", 8, "mixed")], _MIXED),
    "business_rules": _report(_business_rows("mixed"), _MIXED),
    "business_conversations": _report(
        [
            _once_row(["conv_id"], "role", "system", ["system"], "conversations"),
            _once_row(["conv_id"], "role", "system", ["system"], "conversations", every=True),
            _some_row(["conv_id"], "role", "ASSIST", "conversations"),
            _prefix_row("role", "a", "conversations"),
        ]
    ),
    "business_order_lines": _report(
        [
            _once_row(["l_orderkey"], "l_linenumber", "1", ["1", "2"], "lines"),
            _once_row(["l_orderkey"], "l_linenumber", "2", ["1", "2"], "lines"),
            _some_row(["l_orderkey"], "l_returnflag", "R", "lines"),
            _some_row(["l_partkey", "l_suppkey"], "l_linestatus", "o", "lines"),
        ],
        "lines AS (SELECT * REPLACE (CAST(l_linenumber AS VARCHAR) AS l_linenumber) FROM lineitem)",
    ),
    "prefix_pages": _report([_prefix_row("url", "https://", "pages")]),
    "structure": _STRUCTURE,
    "request_flags": _REQUEST_FLAGS,
    "request_flags_gated": _REQUEST_FLAGS,
    "request_flags_side_by_side": _REQUEST_FLAGS,
    "log_of_attempts": """
WITH begun AS (
  SELECT conv_id, max(CASE WHEN turn % 3 = 0 THEN turn - turn % 5 * 0.5 ELSE turn END) AS attempt_begun
  FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT c.conv_id AS id_trigger, role AS validation_id, text AS validation_msg
FROM conversations c LEFT JOIN begun b ON c.conv_id = b.conv_id
WHERE role <> 'user' AND (attempt_begun IS NULL OR turn >= attempt_begun)""",
    "referential_breaking": """
SELECT CAST(3 AS INTEGER) AS phase, 'reference' AS check_name, column_name,
  'REF_INTEGRITY_ERROR' AS error_type, n_violations
FROM (
  SELECT 'doc_id' AS column_name, count(DISTINCT doc_id) AS n_violations FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)
  UNION ALL SELECT 'lang', 1
  UNION ALL SELECT 'n_chars', count(DISTINCT n_chars) FROM documents
  WHERE n_chars NOT IN (SELECT vec_id FROM embeddings WHERE vec_id IS NOT NULL)) found
WHERE n_violations > 0""",
    "request_history": _REQUEST_HISTORY,
    "error_log": _ERROR_LOG,
    "log_messages": """
SELECT CAST(7 AS INTEGER) AS id_trigger, source AS validation_id,
  'functional_validation' AS type_validation, 'documents' AS table_name,
  CASE WHEN length(text) > 255 THEN substr(text, 1, 250) || '...' ELSE text END AS validation_msg,
  lang AS field_name, '1' AS incidences, CAST(1 AS INTEGER) AS flag
FROM documents""",
    "compacted_states": f"WITH {_EVENT_STATUS} SELECT id_trigger, flag, row_count FROM latest",
    "latest_states": f"WITH {_EVENT_STATUS} SELECT id_trigger, flag, row_count FROM latest",
    "open_requests": f"""WITH {_EVENT_STATUS},
queue AS (
  SELECT CAST(o_orderkey AS INTEGER) AS id_trigger, o_orderpriority AS id_type_table,
    CAST(CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 11 ELSE 2 END AS INTEGER) AS flag
  FROM orders)
SELECT q.* FROM queue q LEFT JOIN latest l ON q.id_trigger = l.id_trigger
WHERE coalesce(l.flag, q.flag) = 0""",
    "rules_of_type": """
SELECT CAST(row_number() OVER (ORDER BY CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END
  ASC NULLS LAST, p_name || '_' || p_partkey) - 1 AS INTEGER) AS place, p_brand AS id_type_table,
  CAST(CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS INTEGER) AS field_position,
  p_name || '_' || p_partkey AS field_name
FROM part WHERE p_brand = 'Brand#2'""",
    "config_of_type": """
SELECT c_name AS id_type_table, c_mktsegment AS type_table_name, c_acctbal > 0 AS header,
  'owner' AS user_id, c_nationkey AS "nCols"
FROM customer WHERE c_name = 'Customer#000000001'""",
    "key_ranges": """
WITH b AS (SELECT min(l_orderkey) AS lo, (max(l_orderkey) - min(l_orderkey) + 1 + 11) // 12 AS step
           FROM lineitem),
r AS (SELECT least((l_orderkey - lo) // step, 11) AS range_no FROM lineitem, b)
SELECT CAST(i AS INTEGER) AS range_no, count(range_no) AS n_rows
FROM generate_series(0, 11) s(i) LEFT JOIN r ON r.range_no = i GROUP BY i""",
    "groups_odd_names": _report(
        [
            _once_row(["rule0"], "k0", "1", ["1", "2"], "odd"),
            _once_row(["rule0"], "k0", "2", ["1", "2"], "odd"),
            _some_row(["rule2", "rule0"], '"none"', "r", "odd").replace('"none" starting', "none starting")
            .replace("'\"none\"'", "'none'"),
        ],
        'odd AS (SELECT l_orderkey AS rule0, l_suppkey AS rule2, CAST(l_linenumber AS VARCHAR) AS k0,'
        ' l_returnflag AS "none" FROM lineitem)',
    ),
    "referential_large": _report(
        [
            _reference_row("l_orderkey", "lineitem", "o_orderkey", "thinned", "given.orders"),
            _reference_row("supplier_text", "texts", "p_partkey", "part"),
            _reference_row("l_returnflag", "lineitem", "o_orderkey", "thinned", "given.orders"),
        ],
        "thinned AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)",
        "texts AS (SELECT CAST(l_suppkey AS VARCHAR) AS supplier_text FROM lineitem)",
    ),
    "referential_one_pass": _report(
        [
            _reference_row("doc_id", "documents", "doc_id", "thin_labels", "given.labels"),
            _reference_row("n_chars", "documents", "vec_id", "thin_embeddings", "given.embeddings"),
            _reference_row("id_text", "texts", "page_id", "pages"),
            _reference_row("lang", "documents", "role", "conversations"),
            _reference_row("source", "documents", "o_orderkey", "thin_orders", "given.orders"),
            _reference_row("doc_id", "documents", "vec_id", "thin_embeddings", "given.embeddings"),
        ],
        "thin_labels AS (SELECT * FROM labels WHERE doc_id % 7 <> 0)",
        "thin_embeddings AS (SELECT * FROM embeddings WHERE vec_id % 5 <> 0)",
        "thin_orders AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0)",
        "texts AS (SELECT CAST(doc_id AS VARCHAR) AS id_text FROM documents)",
    ),
    "grouping_sets": _report(
        [
            _once_row(["source"], "lang", "en", ["en", "de"], "documents"),
            _once_row(["source"], "lang", "de", ["en", "de"], "documents"),
            _some_row(["n_chars"], "lang", "E", "documents"),
            _once_row(["doc_id", "source"], "lang", "fr", ["fr"], "documents", every=True),
            _some_row(["source"], "text", "the", "documents"),
            _some_row(["lang", "n_chars"], "source", "SRC1", "documents"),
        ]
    ),
    "report_order": _PLACED_CHECKS,
    "key_ranges_skewed": "\nUNION ALL\n".join(
        f"SELECT * FROM ({_counted_ranges(name, source)}) q{i}"
        for i, (name, source) in enumerate(
            {
                "numbers": "SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_orderkey = 1"
                " THEN 999999999999 ELSE l_orderkey END AS k FROM lineitem",
                "texts": "SELECT text AS k FROM documents",
                "times": "SELECT o_orderdate AS k FROM orders",
            }.items()
        )
    ),
    "key_cuts": "\nUNION ALL\n".join(
        f"SELECT * FROM ({_cut_edges(name, source)}) q{i}"
        for i, (name, source) in enumerate(
            {
                "parts": "SELECT l_partkey AS k FROM lineitem",
                "quantities": "SELECT CAST(round(100 * l_quantity) AS BIGINT) AS k FROM lineitem",
                "prices": "SELECT CAST(100 * CAST(l_extendedprice AS DECIMAL(18,2)) AS BIGINT) AS k"
                " FROM lineitem",
                "days": "SELECT CAST(l_shipdate AS DATE) AS k FROM lineitem",
                "chars": "SELECT n_chars AS k FROM documents",
            }.items()
        )
    ),
}
