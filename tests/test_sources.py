from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablecheck.local import local_frame
from tablecheck.operators import AtLeastOne, CellInRange, ExactlyOne, StartsWith
from tablecheck.rules import RuleError
from tablecheck.schemas import (
    BUSINESS_SCHEMA,
    CONFIG_SCHEMA,
    RULE_SCHEMA,
    STATUS_SCHEMA,
    TRIGGER_SCHEMA,
)
from tablecheck.sources import (
    business_rules_for,
    catalog_references,
    catalog_tables,
    config_for,
    cut_predicates,
    cut_query,
    file_references,
    file_tables,
    jdbc_references,
    jdbc_tables,
    pending_requests,
    range_predicates,
    read_jdbc_table,
    rules_for,
)

AT = datetime(2024, 1, 1)


def test_pending(spark):
    triggers = local_frame(
        spark, [(i, "T", "t", AT, flag, None) for i, flag in enumerate([0, 1, 0, None, 2])],
        TRIGGER_SCHEMA,
    )
    assert sorted(r.id_trigger for r in pending_requests(triggers).collect()) == [0, 2]
    status = local_frame(
        spark, [(0, 1, 5, 10, AT, None), (0, 2, None, 20, AT, None), (1, 0, None, 5, AT, None)],
        STATUS_SCHEMA,
    )
    pending = pending_requests(triggers, status)
    assert sorted(r.id_trigger for r in pending.collect()) == [1, 2]
    assert pending.columns == triggers.columns


def test_config(spark):
    config = local_frame(spark, [("1", "a", True, "u", 3), ("2", "b", False, "u", 3)], CONFIG_SCHEMA)
    assert config_for(config, "2").header is False
    with pytest.raises(LookupError, match="'3'"):
        config_for(config, "3")


def test_rules_in_order_with_unplaced_ones_last(spark):
    def row(kind, position, name):
        return (kind, position, name, None, None, None, None, None, None, None, None, None)

    rules = local_frame(
        spark,
        [row("T", None, "z"), row("T", 2, "b"), row("U", 0, "x"), row("T", 1, "c"), row("T", None, "y")],
        RULE_SCHEMA,
    )
    assert [r.field_name for r in rules_for(rules, "T")] == ["c", "b", "y", "z"]
    assert rules_for(rules, "V") == []


@pytest.mark.parametrize("partitions", [1, 2, 5, 12])
@pytest.mark.parametrize(("low", "high"), [(0, 99), (7, 9), (5, 5), (-20, 20), (30, 60)])
def test_ranges_hold_every_row_once(spark, low, high, partitions):
    """Also for keys outside the bounds and without a key."""
    conditions = range_predicates("k", low, high, partitions)
    assert len(conditions) == partitions
    rows = spark.range(-30, 130).select(F.when(F.col("id") % 17 != 0, F.col("id")).alias("k"))
    hits = sum((F.when(F.expr(c), 1).otherwise(0) for c in conditions), F.lit(0))
    assert rows.select(hits.alias("n")).distinct().collect() == [(1,)]


def test_ranges_are_of_one_size():
    assert range_predicates("k", 0, 9, 4) == [
        "k < 3 OR k IS NULL", "k >= 3 AND k < 6", "k >= 6 AND k < 9", "k >= 9",
    ]


def test_date_ranges():
    assert range_predicates("d", date(2024, 1, 1), date(2024, 1, 31), 2) == [
        "d < DATE '2024-01-17' OR d IS NULL", "d >= DATE '2024-01-17'",
    ]


def test_time_ranges_are_cut_between_days(spark):
    conditions = range_predicates("t", datetime(2024, 1, 1, 5, 30), datetime(2024, 1, 4, 23), 2)
    assert conditions == ["t < DATE '2024-01-03' OR t IS NULL", "t >= DATE '2024-01-03'"]
    rows = spark.sql("SELECT TIMESTAMP'2024-01-02 23:59:59' AS t UNION ALL SELECT NULL")
    assert [rows.filter(c).count() for c in conditions] == [2, 0]


@pytest.mark.parametrize("name", ["k; DROP TABLE t", "a b", "", "1k", 'k"'])
def test_names_must_be_plain(name):
    with pytest.raises(ValueError, match="plain SQL name"):
        range_predicates(name, 0, 1, 2)


def test_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/db/t.parquet")
    spark.range(2).write.option("header", True).csv(f"{tmp_path}/u.csv")
    assert file_tables(spark, str(tmp_path))("db/t").count() == 3
    assert file_tables(spark, str(tmp_path), "csv", header=True)("u").columns == ["id"]
    assert file_references(spark, str(tmp_path))("db", "t", "id").count() == 3


def test_catalog(spark):
    spark.range(4).createOrReplaceTempView("four_rows")
    assert catalog_tables(spark)("four_rows").count() == 4
    with pytest.raises(Exception, match="no_such"):
        catalog_references(spark)("no_such", "t", "c").count()


class Reader:
    """Stands in for a session; keeps the arguments of its JDBC reads and answers what they ask."""

    def __init__(self, n_rows=0, cuts=()):
        self.calls, self.read = [], self
        self.answers = {"COUNT": [(n_rows,)], "MIN": [(cut,) for cut in cuts]}

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append((table, predicates, properties))
        return self

    def collect(self):
        asked = self.calls[-1][0]
        return next(rows for word, rows in self.answers.items() if f"SELECT {word}(" in asked)


def test_jdbc_reference_in_ranges_of_values():
    session = Reader(cuts=["m", "a", "t"])
    jdbc_references(session, "jdbc:x", {"user": "u"}, partitions=3)("s", "t", "c")
    cuts, data = session.calls
    assert "NTILE(3)" in cuts[0] and "FROM s.t" in cuts[0]
    assert data[0] == "(SELECT DISTINCT c FROM s.t) ref"
    # Every value is in one range; NULL is none and not read.
    assert data[1] == ["c < 'm'", "c >= 'm' AND c < 't'", "c >= 't'"]


def test_jdbc_read_in_counted_ranges():
    session = Reader(n_rows=2_400_000, cuts=[80, 0, 40])
    read_jdbc_table(session, "jdbc:x", "s.t", {"user": "u"}, "k")
    count, cuts, data = session.calls
    assert count[0] == "(SELECT COUNT(*) AS n FROM s.t) q"
    assert "NTILE(3)" in cuts[0]
    assert data == (
        "s.t", ["k < 40", "k >= 40 AND k < 80", "k >= 80", "k IS NULL"],
        {"user": "u", "fetchsize": "10000"},
    )


def test_jdbc_read_without_key_or_rows():
    session = Reader()
    with pytest.warns(UserWarning, match="one task"):
        read_jdbc_table(session, "jdbc:x", "t", {"fetchsize": "5"})
    read_jdbc_table(session, "jdbc:x", "t", {}, "k")
    assert [call[1] for call in session.calls if call[0] == "t"] == [
        None, ["k IS NOT NULL", "k IS NULL"],
    ]
    assert session.calls[0][2] == {"fetchsize": "5"}


def test_jdbc_tables_split_those_with_a_key():
    session = Reader(cuts=[date(2024, 1, 1), date(2024, 2, 1)])
    load = jdbc_tables(session, "jdbc:x", {}, {"t": "day"}, partitions=2)
    load("t")
    with pytest.warns(UserWarning):
        load("u")
    assert session.calls[1][1] == [
        "day < DATE '2024-02-01'", "day >= DATE '2024-02-01'", "day IS NULL",
    ]
    assert session.calls[2][1] is None


@pytest.mark.parametrize(
    "values",
    [
        list(range(200)),
        [7] * 150 + list(range(40)) + [10**15],
        ["it's", "", "a", "b", "\u00e9", "zz"] * 9,
        [datetime(2024, 1, 1, 0, 0, s % 60, s) for s in range(90)],
        [None, None],
        [],
    ],
)
def test_cuts_hold_every_row_once(spark, values):
    kind = next((type(v) for v in values if v is not None), int)
    ddl = {int: "long", str: "string", datetime: "timestamp_ntz"}[kind]
    spark.createDataFrame([(v,) for v in [*values, None]], f"k {ddl}").createOrReplaceTempView("cut_me")
    cuts = [r.cut for r in spark.sql(cut_query("cut_me", "k", 7)).collect()]
    conditions = cut_predicates("k", cuts)
    rows = spark.table("cut_me")
    hits = sum((F.when(F.expr(c), 1).otherwise(0) for c in conditions), F.lit(0))
    assert rows.select(hits.alias("n")).distinct().collect() == [(1,)]
    sizes = [rows.filter(c).count() for c in conditions[:-1]]
    hottest = max((values.count(v) for v in values if v is not None), default=0)
    assert max(sizes) <= 2 * max(hottest, len(values) / 7 + 1)


def test_schema_and_options_of_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1;x\n2;y\n")
    load = file_tables(spark, str(tmp_path), "csv", sep=";")
    assert load("t").columns == ["_c0", "_c1"]
    schema = spark.range(0).schema
    assert file_tables(spark, str(tmp_path), "csv", schema, sep=";")("t").dtypes == [("id", "bigint")]


def test_business_rules_as_rows(spark):
    rows = [
        ("T", 2, "starts_with", "a", None, None, "_c", None, None),
        ("T", 1, "exactly_one", "n", "g, h", "x,y", None, None, None),
        ("T", 3, "at_least_one", "n", "g", None, "z", None, None),
        ("T", 4, "cell_range", "c", None, None, None, 5, None),
        ("U", 1, "unheard_of", "c", None, None, None, None, None),
    ]
    table = local_frame(spark, rows, BUSINESS_SCHEMA)
    assert business_rules_for(table, "T") == [
        ExactlyOne(("g", "h"), "n", ("x", "y")),
        StartsWith("a", "_c"),
        AtLeastOne(("g",), "n", "z"),
        CellInRange("c", 5, None),
    ]
    assert business_rules_for(table, "nothing") == []
    with pytest.raises(RuleError, match="unheard_of"):
        business_rules_for(table, "U")


def test_jdbc_references_are_distinct_at_the_source():
    session = Reader()
    jdbc_references(session, "jdbc:x", {})("db", "t", "c")
    assert session.calls[0][0] == "(SELECT DISTINCT c FROM db.t) ref"
    with pytest.raises(ValueError, match="plain SQL name"):
        jdbc_references(session, "jdbc:x", {})("db", "", "c")
