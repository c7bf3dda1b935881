"""Mixing, sharding and fingerprints."""

import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tablecheck.llm import fingerprints, mixing, sharding
from tablecheck.llm.common import table

SMALL = "/root/testdata/sf0.001"


def python_plan(df):
    return re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def test_mix_meets_its_targets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix(docs).collect()
    largest = max(r["size"] for r in rows)
    taken, target = {}, {}
    for r in rows:
        key = (r.target, r.source_size)
        taken[key] = taken.get(key, 0) + r.copies * r["size"]
        target[key] = r.target
        assert 0 <= r.copies <= math.ceil(r.target / r.source_size) <= 3
    assert all(abs(taken[k] - target[k]) <= largest for k in taken)
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
    assert not python_plan(mixing.mix(docs))


def test_targets_are_capped_and_shared_again(spark):
    sizes = spark.createDataFrame(
        [("0a", 1, 10), ("0b", 1, 1000), ("0c", 1, 1000), ("0d", 1, 0)],
        "source_key string, n_docs long, source_size long",
    )
    found = {r.source_key: r.target for r in mixing.source_targets(sizes).collect()}
    assert found["0a"] == 30 and found["0d"] == 0
    assert found["0b"] == pytest.approx(1980 * 2 / 3) and found["0c"] == pytest.approx(1980 / 3)
    whole = spark.createDataFrame([("0a", 1, 10)], sizes.schema)
    assert mixing.source_targets(whole, share=9.0).collect()[0].target == 30


def test_mix_of_odd_documents(spark, edge, nothing):
    rows = mixing.mix(edge, keep=("text", "n")).collect()
    assert len(rows) == edge.count()
    assert {r["size"] for r in rows if not (r.text or "").strip()} == {0}
    copies = sum(r.copies for r in rows)
    assert mixing.expand(mixing.mix(edge)).count() == copies
    assert mixing.mix(nothing).collect() == []


def test_shards_have_equal_bytes(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    placed, slot_map = sharding.shard_documents(docs, 24)
    assert not python_plan(placed)
    rows, texts = placed.collect(), {r.doc_id: r.text for r in docs.collect()}
    loads, places = [0] * 24, [[] for _ in range(24)]
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        loads[r.shard] += r["size"]
        places[r.shard].append(r.slot)
        assert slot_map.shards[r.virtual_slot] == r.shard
    assert max(loads) - min(loads) < 0.02 * max(loads)
    assert all(sorted(p) == list(range(len(p))) for p in places)


def test_rebalancing_moves_little(spark, tmp_path):
    size = [100 + s % 7 for s in range(512)]
    old = sharding.first_map(size, 8)
    new = sharding.rebalanced(old, size, 9)
    moved = [s for s in range(512) if old.shards[s] != new.shards[s]]
    assert new.version == 2 and len(moved) < 512 / 9 * 1.3
    loads = [sum(size[s] for s in range(512) if new.shards[s] == k) for k in range(9)]
    assert max(loads) < 1.03 * min(loads)
    fewer = sharding.rebalanced(new, size, 7)
    assert set(fewer.shards) == set(range(7))
    path = str(tmp_path / "map")
    for m in (old, new):
        sharding.write_map(spark, m, path)
    assert sharding.read_map(spark, path) == new
    assert sharding.read_map(spark, path, 1) == old


def test_shards_by_a_stored_map(spark, edge, nothing, tmp_path):
    docs, path = table(spark, "/root/testdata/sf0.01", "documents"), str(tmp_path / "map")
    placed, slot_map = sharding.shard_by_stored_map(spark, docs, path, (23, 24))
    assert not python_plan(placed)
    rows, before = placed.collect(), sharding.read_map(spark, path, 1)
    assert slot_map == sharding.read_map(spark, path) and (before.n_shards, slot_map.n_shards) == (23, 24)
    moved = [a != b for a, b in zip(before.shards, slot_map.shards)]
    assert 0 < sum(moved) < 0.15 * len(moved)
    loads, places = [0] * 24, [[] for _ in range(24)]
    for r in rows:
        assert slot_map.shards[r.virtual_slot] == r.shard
        loads[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    assert max(loads) - min(loads) < 0.02 * max(loads)
    assert all(sorted(p) == list(range(len(p))) for p in places)
    # A third version, for fewer shards, goes on from the stored one.
    assert sharding.shard_by_stored_map(spark, docs, path, (20,))[1].version == 3
    odd = sharding.shard_by_stored_map(spark, edge, str(tmp_path / "odd"), (2, 3))[0]
    assert odd.count() == edge.count()
    assert sharding.shard_by_stored_map(spark, nothing, str(tmp_path / "no"), (2, 3))[0].collect() == []


def test_mix_blocks_spread_ids_of_any_pattern(spark):
    ids = spark.range(20_000).select((F.col("id") * 256).alias("doc_id"), F.lit("a b").alias("text"))
    nulls = spark.range(20_000).select(
        F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("a "), F.col("id")).alias("text")
    )
    for docs in (ids, nulls):
        classes = docs.groupBy(mixing.id_class(F.col("doc_id"), F.col("text")).alias("c")).count().collect()
        assert len(classes) == 256 and max(r["count"] for r in classes) < 200
    both = ids.unionByName(nulls).withColumn("source", F.lit("s"))
    assert mixing.mix(both).agg(F.sum("copies")).collect()[0][0] == 40_000


def test_words_are_counted_once(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    plan = mixing.mix(docs, keep=("text",))._jdf.queryExecution().toString()
    assert "regexp_count" not in plan and "Window" in plan


def test_shards_of_odd_documents(spark, edge, nothing):
    rows = sharding.shard_documents(edge, 3)[0].collect()
    assert len(rows) == edge.count()
    for shard in range(3):
        places = sorted(r.slot for r in rows if r.shard == shard)
        assert places == list(range(len(places)))
    assert sharding.shard_documents(nothing, 3)[0].collect() == []


def test_fingerprints_of_edited_and_next_texts(spark):
    docs = table(spark, SMALL, "documents")
    result = fingerprints.against_edited_and_next(spark, docs)
    assert not python_plan(result)
    rows = sorted(result.collect())
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    by_text = {}
    for i, r in enumerate(rows):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if len(text) > 2000:
            assert r.near_edited > 0.02
        if text == following:
            assert r.near_next == 1
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)


def test_fingerprints_depend_on_order(spark):
    words = [f"word{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[200:] + words[:200]), " ".join(words[:390] + ["x"] * 10)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = [r.fingerprint for r in fingerprints.fingerprints(docs).orderBy("doc_id").collect()]

    def agree(a, b):
        return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / (len(a) // 4)

    # A moved half keeps nearly all k-mers but not their order.
    assert agree(found[0], found[2]) > 0.8 > agree(found[0], found[1])


def test_repeated_kmers_count(spark):
    docs = spark.createDataFrame([(1, "a b c " * 10), (2, "a b c " * 60)], "doc_id long, text string")
    found = {r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert len(found) == 2


def test_fingerprints_of_odd_documents(spark, edge, nothing):
    rows = fingerprints.against_edited_and_next(spark, edge).collect()
    assert len(rows) == edge.count()
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {"0" * 4 * fingerprints.BINS}
    assert fingerprints.against_edited_and_next(spark, nothing).collect() == []
    assert fingerprints.fingerprints(nothing).collect() == []
