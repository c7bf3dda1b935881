"""Registered queries against their SQL, and the counts known for one size of the given tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tablecheck.registry.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() <= queries().keys()
    assert QUERIES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    result = queries()[name](spark, SMALL)
    expected = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    found = [tuple(row) for row in result.select(*columns).collect()]
    assert sorted(found, key=repr) == sorted(expected.fetchall(), key=repr)


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("type_int", {"row_y": 92, "template_code": 0}),
        ("type_decimal", {"row_y": 44}),
        ("type_date", {"as_of": 65}),
        ("not_null", {"column_x": 190, "excel_cell": 41, "row_y": 44, "as_of": 31}),
        ("max_length", {"data_name": 185, "excel_cell": 8901, "as_of": 0}),
        (
            "primary_key",
            {
                "template_code,sheet": 9900,
                "template_code,sheet,data_name": 9530,
                "template_code,sheet,row_y": 25,
            },
        ),
        ("primary_key_lineitem", {"l_orderkey,l_linenumber": 14168}),
        ("referential", {"template_code": 6}),
        ("referential_documents", {"doc_id": 601}),
        ("at_least_one", {"data_name": 10}),
        ("prefix", {"column_x": 100}),
        ("cell_range", {"excel_cell": 51}),
    ],
)
def test_known_counts(spark, name, expected):
    rows = queries()[name](spark, MIDDLE).collect()
    assert {r.column_name: r.n_violations for r in rows} == expected


def test_known_counts_of_required_names(spark):
    rows = queries()["exactly_one"](spark, MIDDLE).collect()
    assert sorted(r.n_violations for r in rows) == [0, 5, 5]


def test_entry(spark):
    assert entry(spark).count() == 14
