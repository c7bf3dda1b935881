import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from tablecheck.llm import spelling
from tablecheck.llm.queries import op11_spelling

SMALL = "/root/testdata/sf0.001"
RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_words(rows, min_length=6, min_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = defaultdict(set)
    deletions = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            deletions[w[:i] + w[i + 1 :]].add(w)
        deletions[w].add(w)
    for group in deletions.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def as_tuples(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 400)
    monkeypatch.setattr(spelling, "LEAF", 4)
    monkeypatch.setattr(spelling, "_QUERIES_AT_ONCE", 8)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = brute(brute_words([(r[0], r[1]) for r in rows]))
    assert any(e[1] for e in expected)
    assert as_tuples(op11_spelling(spark, SMALL)) == expected


def test_many_cells_and_parts(spark, small_cells):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    found = spelling.words(rows)
    assert len(spelling.upper_trees(found)) > 2
    expected = brute(brute_words([(r[0], r[1]) for r in rows.collect()]))
    assert as_tuples(spelling.variants(spark, rows)) == expected


def test_chains_ties_and_letters(spark, small_cells):
    counts = {
        "kitten": 1000, "kittens": 200, "kittenz": 30, "kittenzz": 5, "sitten": 1000, "mitten": 1000,
        "kitte": 9999, "Ünîcode": 50, "ünîcode": 7, "Ûnîcode": 5, "aaaaaa": 25, "aaaaaaa": 5, "×÷×÷×÷": 5,
    }
    rows = [(None, " ".join([w] * n)) for w, n in counts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = as_tuples(spelling.variants(spark, docs))
    assert found == brute(brute_words(rows))
    roots = {f[0]: f[2] for f in found}
    assert roots["kittenzz"] == "kitten"


def test_anagrams_fill_a_cell(spark, small_cells):
    """Words that no letter count tells apart, and a few that are near some of them."""
    words = ["".join(p) for p in permutations("abcdefg")][:1500]
    words += [w[:3] + "h" + w[4:] for w in words[:700]] + [w + "g" for w in words[:300]]
    rows = [(i, " ".join(words)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = spelling.variants(spark, docs)
    assert as_tuples(found) == brute(brute_words(rows))


def test_odd_documents(spark, edge, nothing):
    rows = [(r[0], r[1]) for r in edge.select("doc_id", "text").collect()]
    assert as_tuples(spelling.variants(spark, edge)) == brute(brute_words(rows))
    assert spelling.variants(spark, nothing).collect() == []


def test_very_long_words(spark):
    long = ["x" * 5000 + "y" * 5000, "x" * 5000 + "z" + "y" * 4999, "x" * 5001 + "y" * 5000]
    rows = [(i, " ".join(long)) for i in range(7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = as_tuples(spelling.variants(spark, docs))
    assert found == brute(brute_words(rows)) and len(found) == 3


def test_half_alike_gives_each_pair_once():
    rng = random.Random(1)
    a = np.array([[rng.randint(0, 1) for _ in range(6)] for _ in range(60)], dtype=np.uint8)
    for extra in (0, 1):
        b = np.array([[rng.randint(0, 1) for _ in range(6 + extra)] for _ in range(60)], dtype=np.uint8)
        pairs = Counter()
        for i, j in spelling._half_alike(a, b):
            pairs.update(zip(i.tolist(), j.tolist(), strict=True))
        wanted = {
            (i, j)
            for i in range(60)
            for j in range(60)
            if (a[i, :3] == b[j, :3]).all() or (a[i, 3:] == b[j, 3 + extra :]).all()
        }
        assert set(pairs) == wanted and set(pairs.values()) == {1}
