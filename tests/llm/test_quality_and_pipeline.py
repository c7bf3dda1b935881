import glob
import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tablecheck.llm import mixing, quality
from tablecheck.llm.common import stored, table
from tablecheck.llm.registry import ORACLE_SQL, QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    model = quality.learn(docs, labels)
    assert 1 <= len(model.rules) < 80
    scored = quality.with_score(docs.select("doc_id", "text"), model).where(quality.held_out())
    rows = scored.join(labels, "doc_id").select("predicted", "quality", "score").collect()
    assert len(rows) > 80
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == bool(r.predicted) for r in rows)


def test_no_held_out_label_is_learned(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    wrong = labels.withColumn(
        "quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert quality.learn(docs, labels) == quality.learn(docs, wrong)
    held = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", quality.held_out())
    assert all(r[1] == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in held.collect())


def test_lasso_is_sparse_and_right():
    rng = np.random.default_rng(1)
    a = (rng.random((2000, 30)) < 0.5).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(3 * a[:, 3] - 2 * a[:, 7])))).astype(float)
    _, w = quality.lasso_logistic(a, y, 0.02)
    assert w[3] > 1 and w[7] < -0.5 and np.count_nonzero(abs(w) > 1e-6) < 12


def test_a_filter_on_the_score_does_not_repeat_statistics(spark, edge):
    rule = quality.Rule((("s_distinct_words", True, 0.5), ("s_symbols", False, 0.1)), 1.0)
    model = quality.RuleModel(0.0, (rule, rule, rule))
    plan = quality.with_score(edge.drop("score"), model).where("predicted = 1")
    optimized = plan._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("array_distinct(") == 2


def test_columns_called_like_the_result(spark, edge):
    assert {"score"} <= set(edge.columns)
    rows = quality.with_score(edge.withColumn("Predicted", F.lit(9)), quality.RuleModel(0.0, ())).collect()
    assert len(rows) == edge.count() and all((r.score, r.predicted) == (0.5, 1) for r in rows)


def test_rows_that_share_a_labelled_id_come_once(spark):
    docs = spark.range(3000).select(
        F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text")
    )
    docs = docs.unionByName(spark.createDataFrame([(1, "other words"), (2, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 7, 7)], "doc_id long, quality int")
    seen = []
    original = quality.fit
    quality.fit = lambda rows, names: seen.append(len(rows)) or original(rows, names)
    try:
        quality.learn(docs, labels)
    finally:
        quality.fit = original
    assert seen and seen[0] <= 4


def test_quality_of_odd_documents(spark, edge, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (2, None), (None, 1), (4, 0), (4, 0)], "doc_id long, quality int"
    )
    docs = edge.drop("score")
    rows = quality.with_score(docs, quality.learn(docs, labels)).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    one_kind = quality.learn(docs, labels.where("quality = 1"))
    assert not one_kind.rules
    assert quality.with_score(nothing, quality.learn(nothing, labels)).collect() == []


def test_stages_against_what_they_promise(spark):
    docs = stored(spark, table(spark, MIDDLE, "documents"), "t")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "suffix_dedup", "mixing", "packing"]
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(spark, stage(spark, frames[-1], MIDDLE), name))
    start, good, single, cut, mixed, packed = frames
    for frame in (good, single, cut, mixed):
        assert frame.dtypes == start.dtypes
    labels = table(spark, MIDDLE, "labels")
    lost = start.join(good, "doc_id", "left_anti").join(labels, "doc_id")
    assert lost.where("quality = 1").count() <= 2
    ids = {r.doc_id for r in single.collect()}
    assert len(ids) == single.count() < good.count()
    kept = {r.doc_id: r.text for r in cut.collect()}
    before = {r.doc_id: r.text for r in single.collect()}
    assert all(len(text) <= len(before[i]) for i, text in kept.items())
    assert sum(map(len, kept.values())) < sum(map(len, before.values()))
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(copies) <= set(kept) and max(copies.values()) <= 3
    expected = mixing.mix(cut).agg(F.sum("copies")).collect()[0][0]
    assert sum(copies.values()) == expected
    pieces = packed.agg(F.sum(F.octet_length("ids") / 4)).collect()[0][0]
    tokens = packed.where("start = 0").agg(F.sum("doc_tokens")).collect()[0][0]
    assert pieces == tokens


def test_pipeline_of_odd_documents(spark, edge, nothing, tmp_path):
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    for name, docs in (("edge", edge), ("nothing", nothing)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        assert bool(rows) == (name == "edge")


def test_near_dedup_of_shared_and_missing_ids(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[(i * (j + 7) + j) % 400] for i in range(150)) for j in range(4)]
    rows = [
        (5, texts[0]), (5, texts[1]), (5, texts[0]),  # one id, two documents, one of them twice
        (None, texts[2]), (None, texts[2]), (None, texts[2] + " end"),  # copies without ids
        (3, texts[3]), (None, texts[3]), (9, texts[3] + " end"),
        (6, ""), (6, ""), (7, ""), (None, None), (None, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], schema).repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    found = sorted(((r.doc_id, r.text) for r in kept if r.text), key=repr)
    without = [t for i, t in found if i is None]
    assert len(without) == 1 and without[0].startswith(texts[2])
    assert [f for f in found if f[0] is not None] == sorted(
        [(5, texts[0]), (5, texts[1]), (3, texts[3])], key=repr
    )
    wordless = sorted(((r.doc_id, r.text) for r in kept if not r.text), key=repr)
    assert wordless == [(6, ""), (7, ""), (None, None), (None, None)]
    empty = spark.createDataFrame([], schema)
    assert corpus_pipeline.near_dedup(spark, empty, "").collect() == []


def test_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())
    assert [n for n in QUERIES if n.startswith("op")] == sorted(
        (n for n in QUERIES if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0])
    )
    assert len(QUERIES) == 14


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        duck.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}')")
    result = QUERIES[name](spark, SMALL)
    expected = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in expected.description]
    found = [tuple(row) for row in result.select(*columns).collect()]
    assert sorted(found, key=repr) == sorted(expected.fetchall(), key=repr)
