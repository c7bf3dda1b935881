"""Registered queries: each takes (session, folder of the given tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tablecheck.local import local_frame
from tablecheck.operators import (
    AtLeastOne,
    BroadcastBounds,
    CellInRange,
    ExactlyOne,
    StartsWith,
    business_report,
    check_structure,
    data_types_report,
    max_length_report,
    not_null_report,
    primary_key_report,
    reference_values,
    references_report,
    technical_report,
)
from tablecheck.plans.validate import validate_table
from tablecheck.registry.fixtures import (
    RULES,
    given_references,
    mixed,
    table,
    template_references,
)
from tablecheck.registry.scenarios import run_requests
from tablecheck.rules import ColumnRule
from tablecheck.schemas import CONFIG_SCHEMA
from tablecheck.fixed_values import REQUIRED_NAMES
from tablecheck.operators.report import collect_report
from tablecheck.sinks import compacted_status, current_log, current_status, log_rows
from tablecheck.sources import (
    config_for,
    counted_cuts,
    cut_conditions,
    pending_requests,
    range_predicates,
    rule_rows,
)

_PLACES = StructType(
    [
        StructField("place", IntegerType()),
        StructField("check_name", StringType()),
        StructField("column_name", StringType()),
    ]
)
_PLACED_RULES = StructType(
    [
        StructField("place", IntegerType()),
        StructField("id_type_table", StringType()),
        StructField("field_position", IntegerType()),
        StructField("field_name", StringType()),
    ]
)

_EDGES = StructType(
    [
        StructField("keys", StringType()),
        StructField("edge_no", IntegerType()),
        StructField("edge", StringType()),
        StructField("n_below", LongType()),
    ]
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _shown(report: DataFrame) -> DataFrame:
    return report.select(
        "phase", "check_name", "column_name", "error_type", "n_violations", "error_message"
    )


# --- technical checks ---


@query
def type_int(spark, sf_dir):
    rules = [ColumnRule("row_y", "INT"), ColumnRule("template_code", " int ")]
    return _shown(data_types_report(mixed(spark, sf_dir), rules, keep_zero=True))


@query
def type_decimal(spark, sf_dir):
    return _shown(
        data_types_report(mixed(spark, sf_dir), [ColumnRule("row_y", "DECIMAL(10,2)")], keep_zero=True)
    )


@query
def type_date(spark, sf_dir):
    rules = [ColumnRule("as_of", "DATE(yyyy/MM/dd)")]
    return _shown(data_types_report(mixed(spark, sf_dir), rules, keep_zero=True))


@query
def type_stored(spark, sf_dir):
    """Columns that are not text: whole numbers, timestamps."""
    rules = [
        ColumnRule("o_orderkey", "INT"),
        ColumnRule("o_custkey", "DECIMAL(12,0)"),
        ColumnRule("o_orderdate", "DATE (yyyy-MM-dd HH:mm:ss)"),
        ColumnRule("o_orderpriority", "INT"),
        ColumnRule("o_orderstatus", "VARCHAR"),
    ]
    return _shown(data_types_report(table(spark, sf_dir, "orders"), rules, keep_zero=True))


@query
def type_stored_dates(spark, sf_dir):
    """Stored times and dates are dates, whatever format the rule has; a text beside them is not."""
    orders = table(spark, sf_dir, "orders").withColumn("o_day", F.to_date("o_orderdate"))
    rules = [
        ColumnRule("o_orderdate", "DATE(yyyy/MM/dd)"),
        ColumnRule("o_day", "DATE"),
        ColumnRule("o_custkey", "DATE(yyyy-MM-dd)"),
        ColumnRule("o_orderdate", "DATETIME"),
        ColumnRule("o_orderpriority", "DATE(yyyy/MM/dd)"),
    ]
    return _shown(data_types_report(orders, rules, keep_zero=True))


@query
def not_null(spark, sf_dir):
    names = ("column_x", "excel_cell", "row_y", "as_of")
    rules = [ColumnRule(name, nullable=False) for name in names]
    return _shown(not_null_report(mixed(spark, sf_dir), rules, keep_zero=True))


@query
def max_length(spark, sf_dir):
    limits = {"data_name": "10", "excel_cell": "4", "as_of": "10"}
    rules = [ColumnRule(name, length=limit) for name, limit in limits.items()]
    return _shown(max_length_report(mixed(spark, sf_dir), rules, keep_zero=True))


@query
def primary_key(spark, sf_dir):
    rows = mixed(spark, sf_dir)
    keys = (
        ["template_code", "sheet"],
        ["template_code", "sheet", "data_name"],
        ["template_code", "sheet", "row_y"],
    )
    first, *others = [primary_key_report(rows, key, keep_zero=True) for key in keys]
    for other in others:
        first = first.unionByName(other)
    return _shown(first)


@query
def primary_key_lineitem(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _shown(primary_key_report(lines, ["l_orderkey", "l_linenumber"], keep_zero=True))


@query
def primary_key_odd_names(spark, sf_dir):
    """Key columns called like the counters inside the check."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("surplus"), F.col("l_linenumber").alias("none"), F.col("l_suppkey").alias("k0")
    )
    first = primary_key_report(lines, ["surplus", "none"], keep_zero=True)
    return _shown(first.unionByName(primary_key_report(lines, ["k0", "none"], keep_zero=True)))


@query
def primary_key_conversations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return _shown(primary_key_report(turns, ["conv_id", "turn"], keep_zero=True))


@query
def technical_rules(spark, sf_dir):
    """All technical checks of a rule set at once."""
    return _shown(technical_report(mixed(spark, sf_dir), RULES, keep_zero=True))


@query
def technical_documents(spark, sf_dir):
    rules = [
        ColumnRule("doc_id", "INT", nullable=False, pk=True),
        ColumnRule("text", "STRING", "5000", nullable=False),
        ColumnRule("lang", "STRING", "2", nullable=False),
        ColumnRule("source", "DECIMAL", "4"),
        ColumnRule("n_chars", "INT", "3"),
    ]
    return _shown(technical_report(table(spark, sf_dir, "documents"), rules, keep_zero=True))


# --- references ---


@query
def referential(spark, sf_dir):
    return _shown(
        references_report(mixed(spark, sf_dir), RULES, template_references(spark), keep_zero=True)
    )


@query
def referential_formats(spark, sf_dir):
    """Texts that are no reference, a reference that cannot be opened, and sound ones beside them."""
    references = {
        "l_orderkey": "orders",
        "l_partkey": "part.p_partkey.x",
        "l_suppkey": "supplier.s_suppkey.",
        "l_linenumber": "absent.column",
        "l_returnflag": None,
    }
    rules = [
        ColumnRule(name, referential_bbdd="given", referential_table_field_name=text)
        for name, text in references.items()
    ]
    load_given = given_references(spark, sf_dir)

    def load(database, name, column):
        if name == "absent":
            raise LookupError("it is not there")
        return load_given(database, name, column)

    report = references_report(table(spark, sf_dir, "lineitem"), rules, load, keep_zero=True)
    return _shown(report)


@query
def referential_documents(spark, sf_dir):
    rule = ColumnRule(
        "doc_id", referential_bbdd="given", referential_table_field_name="labels.doc_id"
    )
    report = references_report(
        table(spark, sf_dir, "documents"), [rule], given_references(spark, sf_dir), keep_zero=True
    )
    return _shown(report)


@query
def referential_clean(spark, sf_dir):
    load = given_references(spark, sf_dir)

    def report(name: str, references: dict[str, str]) -> DataFrame:
        rules = [
            ColumnRule(column, referential_bbdd="given", referential_table_field_name=text)
            for column, text in references.items()
        ]
        return references_report(table(spark, sf_dir, name), rules, load, keep_zero=True)

    orders = report("orders", {"o_custkey": "customer.c_custkey"})
    lines = report(
        "lineitem",
        {
            "l_orderkey": "orders.o_orderkey",
            "l_partkey": "part.p_partkey",
            "l_suppkey": "supplier.s_suppkey",
        },
    )
    return _shown(orders.unionByName(lines))


@query
def referential_shared(spark, sf_dir):
    """Two columns against one reference column, which is read once."""
    rules = [
        ColumnRule(name, referential_bbdd="given", referential_table_field_name="supplier.s_suppkey")
        for name in ("l_suppkey", "l_partkey")
    ]
    report = references_report(
        table(spark, sf_dir, "lineitem"), rules, given_references(spark, sf_dir), keep_zero=True
    )
    return _shown(report)


@query
def referential_large(spark, sf_dir):
    """References that may not be broadcast: whole numbers and texts."""
    given = given_references(spark, sf_dir)

    def load(database, name, column):
        reference = given(database, name, column)
        return reference.where(f"{column} % 3 <> 0") if name == "orders" else reference

    lines = table(spark, sf_dir, "lineitem").withColumn(
        "supplier_text", F.col("l_suppkey").cast("string")
    )
    rules = [
        ColumnRule(name, referential_bbdd="given", referential_table_field_name=text)
        for name, text in {
            "l_orderkey": "orders.o_orderkey",
            "supplier_text": "part.p_partkey",
            "l_returnflag": "orders.o_orderkey",
        }.items()
    ]
    return _shown(references_report(lines, rules, load, True, BroadcastBounds(0, 0)))


@query
def referential_one_pass(spark, sf_dir):
    """Five references at once, whole numbers and texts, with values that each of them lacks."""
    given = given_references(spark, sf_dir)
    kept = {"orders": "o_orderkey % 3 <> 0", "labels": "doc_id % 7 <> 0", "embeddings": "vec_id % 5 <> 0"}

    def load(database, name, column):
        return given(database, name, column).where(kept.get(name, "true"))

    docs = table(spark, sf_dir, "documents").withColumn("id_text", F.col("doc_id").cast("string"))
    rules = [
        ColumnRule(name, referential_bbdd="given", referential_table_field_name=text)
        for name, text in {
            "doc_id": "labels.doc_id",
            "n_chars": "embeddings.vec_id",
            "id_text": "pages.page_id",
            "lang": "conversations.role",
            "source": "orders.o_orderkey",
        }.items()
    ] + [ColumnRule("doc_id", referential_bbdd="given", referential_table_field_name="embeddings.vec_id")]
    return _shown(references_report(docs, rules, load, keep_zero=True))


@query
def referential_breaking(spark, sf_dir):
    """A whole validation with one reference that breaks while it is read, and two that don't."""
    given = given_references(spark, sf_dir)

    def load(database, name, column):
        reference = given(database, name, column)
        if name == "conversations":
            broken = F.raise_error(F.lit("the reference broke"))
            return reference.select(F.when(F.col(column).isNotNull(), broken).alias(column))
        return reference

    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    places = ("labels.doc_id", "conversations.role", "embeddings.vec_id")
    rules = [
        ColumnRule(name, referential_bbdd="given", referential_table_field_name=place)
        for name, place in zip(docs.columns, places, strict=True)
    ]
    found = validate_table(docs, rules, load_reference=load, business=[]).report_df(spark)
    return found.select("phase", "check_name", "column_name", "error_type", "n_violations")


@query
def reference_orders_customers(spark, sf_dir):
    """The distinct values of a reference column, as text."""
    return reference_values(table(spark, sf_dir, "orders"), "o_custkey")


# --- business rules ---


@query
def exactly_one(spark, sf_dir):
    rule = ExactlyOne(("template_code", "sheet"), "data_name", REQUIRED_NAMES)
    return _shown(business_report(mixed(spark, sf_dir), [rule], keep_zero=True))


@query
def exactly_one_all_groups(spark, sf_dir):
    rule = ExactlyOne(("template_code", "sheet"), "data_name", REQUIRED_NAMES, include_empty_groups=True)
    return _shown(business_report(mixed(spark, sf_dir), [rule], keep_zero=True))


@query
def at_least_one(spark, sf_dir):
    rule = AtLeastOne(("template_code", "sheet"), "data_name", "ccy")
    return _shown(business_report(mixed(spark, sf_dir), [rule], keep_zero=True))


@query
def prefix(spark, sf_dir):
    rule = StartsWith("column_x", "_c")
    return _shown(business_report(mixed(spark, sf_dir), [rule], keep_zero=True))


@query
def cell_range(spark, sf_dir):
    rule = CellInRange("excel_cell")
    return _shown(business_report(mixed(spark, sf_dir), [rule], keep_zero=True))


@query
def business_rules(spark, sf_dir):
    """The four default rules together."""
    return _shown(business_report(mixed(spark, sf_dir), keep_zero=True))


@query
def business_conversations(spark, sf_dir):
    rules = [
        ExactlyOne(("conv_id",), "role", ("system",)),
        ExactlyOne(("conv_id",), "role", ("system",), include_empty_groups=True),
        AtLeastOne(("conv_id",), "role", "ASSIST"),
        StartsWith("role", "a"),
    ]
    return _shown(business_report(table(spark, sf_dir, "conversations"), rules, keep_zero=True))


@query
def business_order_lines(spark, sf_dir):
    """Groups whose number grows with the data."""
    rules = [
        ExactlyOne(("l_orderkey",), "l_linenumber", ("1", "2")),
        AtLeastOne(("l_orderkey",), "l_returnflag", "R"),
        AtLeastOne(("l_partkey", "l_suppkey"), "l_linestatus", "o"),
    ]
    return _shown(business_report(table(spark, sf_dir, "lineitem"), rules, keep_zero=True))


@query
def grouping_sets(spark, sf_dir):
    """Rules over four different groupings, of which some share columns."""
    rules = [
        ExactlyOne(("source",), "lang", ("en", "de")),
        AtLeastOne(("n_chars",), "lang", "E"),
        ExactlyOne(("doc_id", "source"), "lang", ("fr",), include_empty_groups=True),
        AtLeastOne(("source",), "text", "the"),
        AtLeastOne(("lang", "n_chars"), "source", "SRC1"),
    ]
    return _shown(business_report(table(spark, sf_dir, "documents"), rules, keep_zero=True))


@query
def groups_odd_names(spark, sf_dir):
    """Group and name columns called like the counters inside the rules."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("rule0"),
        F.col("l_suppkey").alias("rule2"),
        F.col("l_linenumber").alias("k0"),
        F.col("l_returnflag").alias("none"),
    )
    rules = [
        ExactlyOne(("rule0",), "k0", ("1", "2")),
        AtLeastOne(("rule2", "rule0"), "none", "r"),
    ]
    return _shown(business_report(lines, rules, keep_zero=True))


@query
def report_order(spark, sf_dir):
    """Places of report rows: by phase, kind of check and place in the rules."""
    rows = mixed(spark, sf_dir)
    reports = [
        business_report(rows, keep_zero=True),
        references_report(rows, RULES, template_references(spark), keep_zero=True),
        technical_report(rows, RULES, keep_zero=True),
    ]
    first, *others = reports
    for other in others:
        first = first.unionByName(other)
    ordered = [(i, r.check_name, r.column_name) for i, r in enumerate(collect_report(first))]
    return local_frame(spark, ordered, _PLACES)


@query
def prefix_pages(spark, sf_dir):
    rule = StartsWith("url", "https://")
    return _shown(business_report(table(spark, sf_dir, "pages"), [rule], keep_zero=True))


# --- structure ---


@query
def structure(spark, sf_dir):
    """Right, permuted, positional and wrong headers; sums show which column went where."""
    orders = table(spark, sf_dir, "orders")
    names = orders.columns
    cases = {
        "same": (orders, names, True),
        "permuted": (orders, [n.upper() for n in reversed(names)], True),
        "by_position": (orders, [f"c{i}" for i in range(len(names))], False),
        "by_wrong_name": (orders, names[:-1] + ["priority"], True),
        "too_few": (orders, names[:-1], True),
        "repeated": (orders, names[:-1] + ["O_CUSTKEY"], False),
        "no_rows": (orders.filter(F.lit(False)), names, True),
    }
    results = [
        _structure_case(case, df, check_structure(df, expected, has_header))
        for case, (df, expected, has_header) in cases.items()
    ]
    first, *others = results
    for other in others:
        first = first.unionByName(other)
    return first


def _structure_case(case: str, df: DataFrame, result) -> DataFrame:
    rows = result.df if result.ok else df
    customer = next((n for n in rows.columns if n.lower() in ("o_custkey", "c1")), None)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(customer).alias("customer_sum")).select(
        F.lit(case).alias("case_name"),
        F.lit(result.ok).alias("ok"),
        F.lit(result.message).cast("string").alias("message"),
        F.lit(",".join(rows.columns)).alias("names"),
        "n_rows",
        "customer_sum",
    )


# --- requests, states, logs ---


@query
def request_flags(spark, sf_dir):
    """Final state and row count of every request."""
    return current_status(run_requests(spark, sf_dir)[1])


@query
def request_flags_gated(spark, sf_dir):
    return current_status(run_requests(spark, sf_dir, mode="gated")[1])


@query
def request_flags_side_by_side(spark, sf_dir):
    """The same from four requests at a time, with one commit each."""
    return current_status(run_requests(spark, sf_dir, workers=4, one_commit=True)[1])


@query
def request_history(spark, sf_dir):
    """Every state each request went through, numbered."""
    status = run_requests(spark, sf_dir)[1]
    states = F.array_sort(F.collect_list(F.struct("seq", "flag", "row_count")))
    return (
        status.groupBy("id_trigger")
        .agg(states.alias("states"))
        .select("id_trigger", F.posexplode("states").alias("place", "state"))
        .select("id_trigger", "place", "state.flag", "state.row_count")
    )


@query
def error_log(spark, sf_dir):
    return run_requests(spark, sf_dir)[0].drop("execution_timestamp")


@query
def log_messages(spark, sf_dir):
    """Log rows from long messages: every document text is one."""
    report = table(spark, sf_dir, "documents").select(
        F.col("source").alias("error_type"),
        F.col("lang").alias("column_name"),
        F.col("text").alias("error_message"),
    )
    rows = log_rows(report, 7, "documents", "functional_validation")
    return rows.drop("execution_timestamp")


def _status_of_events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("id_trigger"),
        F.expr(
            "CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 11"
            " WHEN 'purchase' THEN 2 ELSE 3 END"
        ).alias("flag"),
        F.expr("CASE WHEN event_type = 'view' THEN event_id END").alias("row_count"),
        F.col("event_id").alias("seq"),
    )


@query
def latest_states(spark, sf_dir):
    """Latest state per request out of a long status table."""
    return current_status(_status_of_events(spark, sf_dir))


@query
def compacted_states(spark, sf_dir):
    """Latest states out of the compacted status table."""
    return current_status(compacted_status(_status_of_events(spark, sf_dir)))


@query
def log_of_attempts(spark, sf_dir):
    """Log rows of the latest attempts, out of a long log and a long status table."""
    turns = table(spark, sf_dir, "conversations").withColumn("at", F.timestamp_seconds("turn"))
    status = turns.where("role = 'user'").select(
        F.col("conv_id").alias("id_trigger"),
        F.expr("if(turn % 3 = 0, 2, 1)").alias("flag"),
        F.col("at").alias("event_time"),
        F.expr("if(turn % 3 = 0, turn % 5 * 0.5D, null)").alias("duration_s"),
    )
    log = turns.where("role <> 'user'").select(
        F.col("conv_id").alias("id_trigger"),
        F.col("role").alias("validation_id"),
        F.col("text").alias("validation_msg"),
        F.col("at").alias("execution_timestamp"),
    )
    return current_log(log, status).drop("execution_timestamp")


@query
def open_requests(spark, sf_dir):
    """Requests still to do, from a long queue and a long status table."""
    queue = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("id_trigger"),
        F.col("o_orderpriority").alias("id_type_table"),
        F.expr("CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 11 ELSE 2 END").alias("flag"),
    )
    return pending_requests(queue, _status_of_events(spark, sf_dir))


# --- control tables and partitioned reads ---


@query
def rules_of_type(spark, sf_dir):
    """Rules of one table type in order, from a long rule table."""
    rules = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("id_type_table"),
        F.expr("CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END").alias("field_position"),
        F.concat_ws("_", "p_name", "p_partkey").alias("field_name"),
    )
    rows = rule_rows(rules, "Brand#2").collect()
    ordered = [(i, r.id_type_table, r.field_position, r.field_name) for i, r in enumerate(rows)]
    return local_frame(spark, ordered, _PLACED_RULES)


@query
def config_of_type(spark, sf_dir):
    config = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("id_type_table"),
        F.col("c_mktsegment").alias("type_table_name"),
        (F.col("c_acctbal") > 0).alias("header"),
        F.lit("owner").alias("user_id"),
        F.col("c_nationkey").alias("nCols"),
    )
    row = config_for(config, "Customer#000000001")
    return local_frame(spark, [row], CONFIG_SCHEMA)


@query
def key_ranges(spark, sf_dir):
    """Rows per range of a partitioned read: each row falls into exactly one."""
    lines = table(spark, sf_dir, "lineitem")
    low, high = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    counts = {
        str(i): F.count(F.when(F.expr(condition), True)).alias(str(i))
        for i, condition in enumerate(range_predicates("l_orderkey", low, high, 12))
    }
    return (
        lines.agg(*counts.values())
        .unpivot([], list(counts), "range_no", "n_rows")
        .withColumn("range_no", F.col("range_no").cast("int"))
    )


def _keys_to_cut(spark, sf_dir) -> dict[str, DataFrame]:
    """Keys with a far outlier and NULLs, texts, and times, in a column ``k``."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr(
            "CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_orderkey = 1 THEN 999999999999"
            " ELSE l_orderkey END"
        ).alias("k")
    )
    texts = table(spark, sf_dir, "documents").select(F.col("text").alias("k"))
    times = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("k"))
    return {"numbers": lines, "texts": texts, "times": times}


@query
def key_ranges_skewed(spark, sf_dir):
    """Rows per range cut by counting: each row falls into exactly one."""
    results = []
    for name, rows in _keys_to_cut(spark, sf_dir).items():
        cuts = counted_cuts(rows, "k", 8)
        counts = {
            str(i): F.count(F.when(condition, True)).alias(str(i))
            for i, condition in enumerate(cut_conditions(F.col("k"), cuts.edges))
        }
        results.append(
            rows.agg(*counts.values())
            .unpivot([], list(counts), "range_no", "n_rows")
            .select(F.lit(name).alias("keys"), F.col("range_no").cast("int"), "n_rows")
        )
    first, *others = results
    for other in others:
        first = first.unionByName(other)
    return first


@query
def key_cuts(spark, sf_dir):
    """Edges of a hundred ranges with the rows below each: few keys that many rows share, prices, times."""
    lines = table(spark, sf_dir, "lineitem")
    keys = {
        "parts": lines.select(F.col("l_partkey").alias("k")),
        "quantities": lines.select(F.col("l_quantity").alias("k")),
        "prices": lines.select(F.col("l_extendedprice").cast("decimal(18,2)").alias("k")),
        "days": lines.select(F.to_date("l_shipdate").alias("k")),
        "chars": table(spark, sf_dir, "documents").select(F.col("n_chars").alias("k")),
    }
    edges = []
    for name, rows in keys.items():
        cuts = counted_cuts(rows, "k", 100)
        edges += [
            (name, i, str(int(100 * e) if name in ("prices", "quantities") else e), n)
            for i, (e, n) in enumerate(zip(cuts.edges, cuts.before, strict=True), 1)
        ]
    return local_frame(spark, edges, _EDGES)
