"""Cuts by counting against sorting in plain Python."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablecheck.sources import counted_cuts, cut_conditions, cuts
from tablecheck.sources.cuts import part_starts


def brute(keys, partitions):
    """(edges, rows below each, rows with a key, rows without)."""
    known = sorted(k for k in keys if k is not None)
    size, larger = divmod(len(known), partitions)
    lowest, at = set(), 0
    for part in range(partitions):
        step = size + (part < larger)
        if step:
            lowest.add(known[at])
        at += step
    edges = sorted(lowest)[1:]
    return edges, [sum(k < e for k in known) for e in edges], len(known), len(keys) - len(known)


def check(spark, keys, schema, partitions=8):
    df = spark.createDataFrame([(k,) for k in keys], f"k {schema}").repartition(3)
    found = counted_cuts(df, "k", partitions)
    edges, before, n_rows, n_missing = brute(keys, partitions)
    assert (found.before, found.n_rows, found.n_missing) == (before, n_rows, n_missing)
    conditions = cut_conditions(F.col("k"), found.edges)
    counted = df.agg(*[F.count(F.when(c, 1)).alias(str(i)) for i, c in enumerate(conditions)]).first()
    assert list(counted) == found.sizes()
    return found, edges


@pytest.fixture
def small_samples(monkeypatch):
    monkeypatch.setattr(cuts, "SAMPLE_ROWS", 16)
    monkeypatch.setattr(cuts, "SAMPLE_PER_CUT", 2)
    monkeypatch.setattr(cuts, "_NEAR", [0, 1, -1, 4, -4])


RNG = random.Random(9)
HOT = [7] * 900 + [RNG.randrange(-(10**18), 10**18) for _ in range(500)] + [2**63 - 1] * 300 + [None] * 50


@pytest.mark.parametrize("partitions", [1, 2, 8, 37])
def test_whole_numbers_with_hot_ones_and_outliers(spark, small_samples, partitions):
    found, edges = check(spark, HOT, "bigint", partitions)
    assert found.edges == edges


def test_other_types(spark, small_samples):
    days = [date(2024, 1, 1) + timedelta(days=int(RNG.paretovariate(0.5)) % 4000) for _ in range(400)]
    found, edges = check(spark, days + [date(9999, 12, 31)] * 200, "date")
    assert found.edges == edges
    times = [datetime(2024, 1, 1) + timedelta(microseconds=RNG.randrange(10**9)) for _ in range(500)]
    found, edges = check(spark, times, "timestamp_ntz")
    assert found.edges == edges
    found, edges = check(spark, [Decimal(RNG.randrange(10**6)) / 100 for _ in range(500)], "decimal(38,2)")
    assert found.edges == edges
    found, edges = check(spark, [RNG.gauss(0, 1) for _ in range(500)] + [float("inf")] * 100, "double")
    assert found.edges == edges
    check(spark, [RNG.randrange(100) for _ in range(300)], "smallint")


def test_times_with_a_zone(spark, small_samples):
    df = spark.range(1000).select(F.timestamp_micros(F.col("id") * F.col("id") * 10**9).alias("k"))
    found = counted_cuts(df, "k", 4)
    assert found.before == [250, 500, 750]
    counted = [df.where(c).count() for c in cut_conditions(F.col("k"), found.edges)]
    assert counted == found.sizes() == [250, 250, 250, 250, 0]


def test_not_a_number_is_in_the_last_range(spark):
    df = spark.createDataFrame([(float(i),) for i in range(8)] + [(float("nan"),)] * 8, "k double")
    found = counted_cuts(df, "k", 4)
    counted = [df.where(c).count() for c in cut_conditions(F.col("k"), found.edges)]
    assert counted == found.sizes() and sum(counted) == 16


def test_texts_that_share_long_beginnings(spark, small_samples):
    long = "é" * 5000
    texts = [long + str(RNG.random()) for _ in range(200)] + [long] * 100 + ["", "a\\n'b", "\U0001f600"]
    texts += [None] * 10 + [str(RNG.random()) for _ in range(300)]
    found, edges = check(spark, texts, "string")
    assert all(prefix <= edge for edge, prefix in zip(edges, found.edges, strict=True))


def test_text_keys_come_as_short_prefixes(spark):
    texts = [f"{i:05d}" + "x" * 10_000 for i in range(500)]
    found, _ = check(spark, texts, "string")
    assert max(map(len, found.edges)) <= cuts.FIRST_CHARS + 1


def test_no_rows_no_keys_few_keys(spark):
    assert counted_cuts(spark.createDataFrame([], "k bigint"), "k", 8) == cuts.Cuts([], [], 0, 0)
    assert counted_cuts(spark.createDataFrame([(None,)] * 3, "k string"), "k", 8) == cuts.Cuts([], [], 0, 3)
    assert check(spark, [1, 2, 3], "int")[0].edges == [2, 3]
    assert check(spark, [5] * 20, "int")[0].edges == []
    with pytest.raises(ValueError):
        counted_cuts(spark.range(3), "id", 0)
    with pytest.raises(TypeError):
        counted_cuts(spark.range(3).select(F.array("id").alias("k")), "k", 2)


def test_part_starts():
    assert part_starts(10, 4) == [0, 3, 6, 8]
    assert part_starts(2, 4) == [0, 1]
    assert part_starts(0, 4) == []


def test_odd_column_names(spark):
    df = spark.range(100).select(F.col("id").alias("k.b `x`"))
    assert counted_cuts(df, "k.b `x`", 2).edges == [50]


def test_no_row_leaves_its_task(spark):
    """Counting buckets neither sorts nor moves rows: partial counts are all that is shuffled."""
    kind = cuts._kind(spark.range(1).schema["id"].dataType)
    keys = spark.range(1000).select(F.col("id").alias("k"))
    counted = keys.select(cuts._bucket(kind, [10, 20, 30]).alias("b")).groupBy("b").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and plan.count("Exchange") == 1
    assert {r.b: r["count"] for r in counted.collect()} == {0: 10, 1: 10, 2: 10, 3: 970}


def test_short_decimals_days_and_times_are_looked_up_as_arrays(spark, small_samples):
    prices = [Decimal(RNG.randrange(-(10**6), 10**6)) / 100 for _ in range(500)] + [Decimal("7.00")] * 200
    found, edges = check(spark, prices + [None] * 5, "decimal(12,2)")
    assert found.edges == edges
    found, edges = check(spark, [Decimal(10**18 - 1), Decimal(1 - 10**18), Decimal(0)] * 40, "decimal(18,0)")
    assert found.edges == edges
    for of in ("decimal(12,2)", "date", "timestamp", "double", "int"):
        kind = cuts._kind(spark.createDataFrame([], f"k {of}").schema["k"].dataType)
        assert kind.is_number, of
        plan = spark.range(9).select(F.col("id").alias("k")).select(cuts._bucket(kind, [1, 2]))
        plan = plan._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and "filter(" not in plan


def test_few_rounds_for_many_cuts(spark, monkeypatch):
    rounds, counted = [], cuts._counted
    monkeypatch.setattr(cuts, "_counted", lambda *args: rounds.append(1) or counted(*args))
    df = spark.range(300_000).select((F.col("id") * 7919 % 300_007).alias("k"))
    assert len(counted_cuts(df, "k", 100).edges) == 99
    assert len(rounds) <= 3
