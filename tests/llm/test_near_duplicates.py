"""Cover tree, MinHash and connected components against brute force."""

import random
import re

import numpy as np
import pytest

from tablecheck.llm import cover_tree, minhash
from tablecheck.llm import shingles as shingle_module
from tablecheck.llm.common import components


def classes(nodes, links):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 8), (8, 8), (8, 7)]
    links += [(1000, 1000 + i) for i in range(200)] + [
        (rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(60)
    ]
    nodes = {n for pair in links for n in pair}
    rows = components(spark, spark.createDataFrame(links, "a long, b long")).collect()
    expected = {n: c for n, c in classes(nodes, links).items()}
    alone = {n for n in nodes if all(n not in p or p[0] == p[1] for p in links)}
    assert {r.node: r.component for r in rows} == {n: c for n, c in expected.items() if n not in alone}
    assert components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_ids_near_the_bounds(spark):
    high, low = 2**63 - 1, -(2**63)
    links = [(high - i, high - i - 1) for i in range(40)] + [(low, low + 1), (low + 1, low + 2), (0, -5)]
    rows = components(spark, spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == classes({n for pair in links for n in pair}, links)


def test_near_duplicates_with_large_ids(spark):
    text = "the same words again and again in every one of these texts " * 3
    ids = [2**63 - 1, 2**62, 2**62 + 5, -(2**63)]
    docs = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, docs, 3, 85).collect()}
    assert found == dict.fromkeys(ids, -(2**63))
    close = [(i, [1.0, 2.0, 0.01 * n]) for n, i in enumerate(ids)]
    frame = spark.createDataFrame(close, "vec_id long, embedding array<double>")
    rows = cover_tree.near_duplicates(spark, frame, 0.9).collect()
    assert all((r.n_links, r.component_id) == (3, -(2**63)) for r in rows)


def test_vectors_of_several_lengths(spark):
    rows = [(i, [1.0, 0.01 * i]) for i in range(5)] + [(10 + i, [1.0, 2.0, 0.01 * i]) for i in range(7)]
    rows += [(30, [1.0, 1.0, 1.0, 1.0]), (31, [1.0]), (32, [2.0]), (33, [-1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.near_duplicates(spark, frame, 0.9).collect()}
    expected = {i: (4, 0) for i in range(5)} | {10 + i: (6, 10) for i in range(7)}
    assert found == expected | {30: (0, 30), 31: (1, 31), 32: (1, 31), 33: (0, 33)}


def vectors():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 8))
    near = base[rng.integers(0, 6, 200)] + rng.normal(size=(200, 8)) * 0.15
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(np.concatenate([base, near, base[:3]]))]
    rows += [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (904, [])]
    rows += [(905, [1.0, 2.0]), (None, rows[0][1]), (0, rows[0][1])]
    return rows


@pytest.mark.parametrize("chunk", [17, 4096])
def test_cover_tree(spark, monkeypatch, chunk):
    monkeypatch.setattr(cover_tree.near_pairs, "__defaults__", (chunk,))
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "0 AS cell", "1 AS n", "2 AS vector"
    )
    good = [
        (i, np.array(v))
        for i, v in rows
        if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)
    ]
    links = [
        (i, j)
        for i, v in good
        for j, w in good
        if i != j and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9
    ]
    tops = classes({i for i, _ in rows if i is not None}, links)
    found = cover_tree.near_duplicates(spark, frame, 0.9).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert r.n_links == sum(a == r.vec_id for a, _ in links)
            assert r.component_id == tops[r.vec_id]
            assert r.kept == (r.vec_id == r.component_id)


def test_equal_vectors_are_one_entry(spark):
    many = [(i, [0.0, 1.0, 2.0]) for i in range(20000)]
    rows = many + [(30000, [-0.0, 2.0, 4.0]), (30001, [5.0, 0.0, 0.0]), (30002, [0.0, 3.0, -1.0])]
    # An id of several rows, equal and unequal; squares that neither overflow nor vanish.
    rows += [(40000, [0.0, 1.0, 2.0]), (40000, [0.0, 1.0, 2.0]), (40000, [0.0, 1.0, 2.1])]
    rows += [(50000, [1e200, -1e200, 0.0]), (50001, [1e-200, -1e-200, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    merged = cover_tree.entries(cover_tree.rows_to_compare(frame))
    assert merged.count() == 8
    found = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.near_duplicates(spark, frame, 0.9).collect()}
    # 20,001 others of one row and three rows of 40000; that id counts the others once per row.
    expected = {i: (20000 + 3, 0) for i in [*range(20000), 30000]} | {40000: (3 * 20001, 0)}
    expected |= {30001: (0, 30001), 30002: (0, 30002), 50000: (1, 50000), 50001: (1, 50000)}
    assert found == expected


def test_single_precision_and_doubles_agree(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8))
    rows = [(i, [float(x) for x in base[i % 12] + rng.normal(size=8) * 0.2]) for i in range(150)]
    single = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    double = single.selectExpr("vec_id", "cast(embedding AS array<double>) AS embedding")
    results = [
        {tuple(r) for r in cover_tree.near_duplicates(spark, f, 0.9).collect()} for f in (single, double)
    ]
    assert results[0] == results[1]
    assert len({component for _, _, component, _ in results[0]}) < 150


def test_cover_tree_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.near_duplicates(spark, empty, 0.9).collect() == []


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def expected_classes(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    links = [
        (i, j)
        for x, (i, s) in enumerate(sets)
        for j, t in sets[:x]
        if s and t and 100 * len(s & t) >= percent * len(s | t)
    ]
    return classes({i for i, _ in sets}, links)


@pytest.mark.parametrize(("k", "percent", "chunk"), [(3, 85, 512), (3, 85, 5), (5, 80, 16)])
def test_minhash(spark, monkeypatch, k, percent, chunk):
    monkeypatch.setattr(minhash.links_of, "__defaults__", (chunk,))
    rng = random.Random(k)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(4):
        base = rng.choices(words, k=80)
        for _ in range(25):
            text = list(base)
            for _ in range(rng.randrange(6)):
                text[rng.randrange(80)] = rng.choice(words)
            rows.append((len(rows) * 3 + family, " ".join(text)))
    rows += [(5000 + i, rows[0][1].upper()) for i in range(3)]
    found = minhash.near_duplicates(
        spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), k, percent
    ).collect()
    expected = expected_classes(rows, k, percent)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t, k)) for i, t in rows}


@pytest.mark.parametrize(("small", "most"), [(32, 16), (4, 3), (1, 16)])
def test_every_pair_of_chunks_meets_in_one_tile(spark, small, most):
    families = {5: 2, -7: 11, 8: 17}
    rows = [(family, p, parts, b"x") for family, parts in families.items() for p in range(parts)]
    chunks = spark.createDataFrame(rows, "family long, part int, parts int, chunk binary")
    tiles = {}
    for r in minhash.in_tiles(chunks, small, most).collect():
        tiles.setdefault((r.family, r.i, r.j), []).append((r.own, r.part))
    met = []
    for (family, i, j), members in tiles.items():
        members.sort()
        for n, (own, part) in enumerate(members):
            earlier = [p for o, p in members[:n] if o == i] if own == j else []
            met += [(family, p, part) for p in earlier]
    wanted = [(f, p, q) for f, parts in families.items() for q in range(parts) for p in range(q)]
    assert sorted(met) == sorted(wanted)


def test_minhash_with_tiles_of_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(minhash.links_of, "__defaults__", (4,))
    monkeypatch.setattr(minhash.in_tiles, "__defaults__", (2, 3))
    rng = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    base = rng.choices(words, k=120)
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.randrange(14)):
            text[rng.randrange(120)] = rng.choice(words)
        rows.append((i * 7 - 200, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, docs, 5, 80).collect()}
    assert found == expected_classes(rows, 5, 80)


def test_minhash_odd_documents(spark, edge, nothing):
    found = minhash.near_duplicates(spark, edge, 3, 85).collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    expected = expected_classes(rows, 3, 85)
    assert len(found) == len(rows)
    for r in found:
        assert r.component_id == (None if r.doc_id is None else expected[r.doc_id])
        assert r.kept == (r.doc_id is not None and r.doc_id == r.component_id)
    assert minhash.near_duplicates(spark, nothing, 3, 85).collect() == []


@pytest.mark.parametrize("text", ["Ab cd  e\tF " * 40, "x" * 300, " " * 90, "a " + "b" * 200 + " c" * 70])
def test_long_texts_in_pieces(monkeypatch, text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    offsets = np.array([0, len(data)])
    words, of = shingle_module.word_hashes(data, offsets)
    monkeypatch.setattr(shingle_module, "GROUP_BYTES", 16)
    pieces, piece_of = shingle_module.word_hashes(data, offsets)
    assert pieces.tolist() == words.tolist() and piece_of.tolist() == of.tolist() == [0] * len(text.split())


def test_estimates_are_close():
    rng = np.random.default_rng(8)
    multipliers = minhash._multipliers()
    for share in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(40):
            a = minhash.mix(rng.integers(0, 1 << 62, 400, dtype=np.uint64))
            shared = int(800 * share / (1 + share))
            b = np.concatenate([a[:shared], minhash.mix(rng.integers(0, 1 << 62, 400 - shared, dtype=np.uint64))])
            bits = [
                np.frombuffer(minhash.packed(minhash.minima(x, multipliers)), np.uint64)[None, :]
                for x in (a, b)
            ]
            errors.append(minhash.estimates(*bits)[0, 0] - shared / (800 - shared))
        assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < share - minhash.least_estimate(share) + 0.05
