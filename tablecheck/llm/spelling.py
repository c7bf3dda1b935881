"""Spelling variants: k-d trees over letter-count vectors, searched per pair of lengths.

A word is a vector of counts, one per letter. One replaced letter moves one count up and one down, one
inserted or deleted letter moves a single count: one edit gives an L1 distance of at most two. So the
words near a word of length n lie, among those of length n, in a box of one up and one down around its
vector, and among those of length n + 1 in a box of one up. Trees over the vectors of one length split
at a count of one letter; a search leaves out every branch whose box is further off. What is found is
verified by the order of the letters.

On Spark the upper part of each length's tree deals the words to cells: it is fitted on a bounded sample
(``SAMPLE`` words) and is the same for every word, so it shapes the work and never the result. Each
word goes to its own cell, and as a query to all cells that its box reaches. A task builds the lower part
of the tree over a cell's words and streams the queries through it. A cell that holds more than its
share, as by anagrams, which no count can tell apart, is dealt into parts, each of which sees all its
queries. Words that share one vector are anagrams and never near each other; where two such groups
face each other, only words that share their first or last half are compared, as one edit leaves one
half as it is.

Words are runs of ASCII letters and of U+00C0 to U+00FF: one byte of Latin-1 per letter.

Cases: null and empty texts have no words; words may be of any length; equal rows, equal and null ids
each count (a null id is the empty string in the digest that decides on misspellings); ties of forms go
to the smallest word in code-point order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm.common import shuffle_partitions, stored

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: One in so many runs of a document loses a letter before it is counted.
MISSPELLED = 199

#: Words that the upper trees are fitted on, over all lengths.
SAMPLE = 1 << 16
#: Letters of the words that one cell should hold; a cell of more than twice as many is dealt into parts.
CELL = 1 << 18
#: Words below which a branch is compared as a whole.
LEAF = 48
#: Words that a task counts before it hands them on.
COUNTED = 1 << 19
#: Pairs of words that are compared at once.
PAIRS = 1 << 18

#: Latin-1 bytes: letters stay, A-Z become a-z, all else becomes a space.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


# --- words ---


def _count_partition(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                _count(counts, doc_id.as_py(), text.as_py(), min_length)
                if len(counts) >= COUNTED:
                    yield from _counted(counts)
                    counts = Counter()
        yield from _counted(counts)

    return run


def _count(counts: Counter, doc_id: int | None, text: str | None, min_length: int) -> None:
    """Adds the words of a document, some of them with a letter less."""
    runs = Counter((text or "").encode("latin-1", "replace").translate(_LETTERS).split())
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        if len(run) < min_length:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
        if h % MISSPELLED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < min_length:
                continue
        counts[run] += n


def _counted(counts: Counter) -> Iterator[pa.RecordBatch]:
    words = list(counts)
    for at in range(0, len(words), 10_000):
        part = words[at : at + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.binary()), pa.array([counts[w] for w in part], pa.int64())],
            names=["word", "n"],
        )


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words as Latin-1 bytes with their number over all documents. Counted in tasks first."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    partial = rows.mapInArrow(_count_partition(min_length), "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- the upper trees ---


@dataclass(frozen=True)
class Cells:
    """The upper tree of one length: every branch is (letter, count, branch up to the count, branch
    above it), every cell a negative number; cells are numbered from 0 as -1 - number."""

    branches: tuple[tuple[int, int, int, int], ...]
    root: int

    def reached(self, vectors: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, places of vectors) for the cells that hold points within ``up`` and ``down`` of them."""
        places = np.arange(len(vectors))
        stack = [(self.root, places, np.full(len(vectors), up), np.full(len(vectors), down))]
        while stack:
            at, places, ups, downs = stack.pop()
            if not len(places):
                continue
            if at < 0:
                yield -1 - at, places
                continue
            letter, count, below, above = self.branches[at]
            own = vectors[places, letter]
            # What it takes to get into a branch is taken from what is left: letters differ on the way.
            for branch, left_up, left_down in (
                (below, ups, downs - np.maximum(own - count, 0)),
                (above, ups - np.maximum(count + 1 - own, 0), downs),
            ):
                can = (left_up >= 0) & (left_down >= 0)
                stack.append((branch, places[can], left_up[can], left_down[can]))


def _best_split(vectors: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that halve the vectors best; None if all are equal."""
    best, found = len(vectors) + 1, None
    for letter in np.flatnonzero(vectors.min(axis=0) < vectors.max(axis=0)):
        upto = np.cumsum(np.bincount(vectors[:, letter]))[:-1]
        off = np.abs(2 * upto - len(vectors))
        count = int(np.argmin(off))
        if 0 < upto[count] < len(vectors) and off[count] < best:
            best, found = off[count], (int(letter), count)
    return found


def _fit(vectors: np.ndarray, cells: int) -> Cells:
    """A tree of about ``cells`` cells, halving the sample letter by letter.

    A letter is split once on every way down, so that the distances of its branches add up.
    """
    branches: list = []
    n_cells = 0

    def grow(rows: np.ndarray, wanted: int, free: np.ndarray) -> int:
        nonlocal n_cells
        split = _best_split(rows * free) if wanted > 1 and len(rows) > 1 else None
        if split is None:
            n_cells += 1
            return -n_cells
        at = len(branches)
        branches.append(None)
        letter, count = split
        below = rows[:, letter] <= count
        left = free.copy()
        left[letter] = 0
        part = max(1, round(wanted * below.mean()))
        branches[at] = (
            letter,
            count,
            grow(rows[below], part, left),
            grow(rows[~below], max(1, wanted - part), left),
        )
        return at

    root = grow(vectors, cells, np.ones(vectors.shape[1], dtype=vectors.dtype))
    return Cells(tuple(branches), root)


def _codes(of: list[bytes], length: int) -> np.ndarray:
    """Words of one length as a matrix of letters."""
    return np.frombuffer(b"".join(of), dtype=np.uint8).reshape(len(of), length)


def _vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts, one column per Latin-1 byte from U+0061 on."""
    n, length = codes.shape
    flat = np.arange(n)[:, None] * 160 + (codes.astype(np.int64) - 96)
    return np.bincount(flat.ravel(), minlength=n * 160).reshape(n, 160).astype(np.int32)


def upper_trees(found: DataFrame) -> dict[int, Cells]:
    """The trees of all lengths whose words do not fit one cell.

    The driver sees one row per such length and a sample of at most about ``SAMPLE`` words; there are
    about as many branches as cells.
    """
    length = F.octet_length("word")
    sizes = (
        found.groupBy(length.alias("length"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") * F.col("length") > CELL)
        .collect()
    )
    wanted = {r.length: -(-r.n * r.length // CELL) for r in sizes}
    if not wanted:
        return {}
    one_in = max(1, -(-sum(r.n for r in sizes) // SAMPLE))
    sample = found.where(
        length.isin(list(wanted)) & (F.pmod(F.xxhash64("word"), F.lit(one_in)) == 0)
    ).select("word")
    by_length: dict[int, list[bytes]] = {n: [] for n in wanted}
    for row in sample.limit(2 * SAMPLE).collect():
        by_length[len(row.word)].append(bytes(row.word))
    return {
        n: _fit(_vectors(_codes(sorted(own), n)), wanted[n]) for n, own in by_length.items() if own
    }


_ROUTED = "length int, cell int, is_query boolean, word binary, n long"
_ONE_CELL = Cells((), -1)


def _route_partition(trees):
    """Every word to its own cell, and as a query to the cells within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([w.as_py() for w in batch.column(0)], dtype=object)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            lengths = np.array([len(w) for w in own])
            for length in np.unique(lengths):
                places = np.flatnonzero(lengths == length)
                step = max(1, min(1 << 14, (1 << 24) // int(length)))
                for at in range(0, len(places), step):
                    part = places[at : at + step]
                    yield from _routed(trees.value, own[part], n[part], int(length))

    return run


def _routed(trees: dict, own: np.ndarray, n: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    vectors = _vectors(_codes(list(own), length))
    for of, is_query, up, down in ((length, False, 0, 0), (length, True, 1, 1), (length + 1, True, 1, 0)):
        for cell, places in trees.get(of, _ONE_CELL).reached(vectors, up, down):
            size = len(places)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, of, dtype=np.int32)),
                    pa.array(np.full(size, cell, dtype=np.int32)),
                    pa.array(np.full(size, is_query)),
                    pa.array(own[places].tolist(), pa.binary()),
                    pa.array(n[places]),
                ],
                names=["length", "cell", "is_query", "word", "n"],
            )


# --- the lower trees ---


class Tree:
    """A k-d tree over the words of one cell, all of one length."""

    def __init__(self, own: list[bytes], n: np.ndarray, length: int):
        self.words, self.n, self.length = own, n, length
        self.codes = _codes(own, length)
        vectors = _vectors(self.codes)
        self.letters = np.flatnonzero(vectors.any(axis=0))
        vectors, group = np.unique(vectors[:, self.letters], axis=0, return_inverse=True)
        self.group = group.ravel()
        self.by_group = np.argsort(self.group, kind="stable")
        self.starts = np.searchsorted(self.group[self.by_group], np.arange(len(vectors) + 1))
        # Products of counts stay whole numbers below 2**24 unless words are very long.
        self.points = vectors.astype(np.float32 if length < 2000 else np.float64)
        self.squares = (self.points**2).sum(axis=1)
        self.nodes: list[tuple] = []
        self._grow(vectors, np.arange(len(vectors)))

    def _grow(self, vectors: np.ndarray, places: np.ndarray) -> int:
        own = vectors[places]
        at = len(self.nodes)
        box = (own.min(axis=0), own.max(axis=0))
        self.nodes.append(None)
        split = _best_split(own) if len(places) > LEAF else None
        if split is None:
            self.nodes[at] = (box, places, None)
        else:
            below = own[:, split[0]] <= split[1]
            self.nodes[at] = (
                box, None, (self._grow(vectors, places[below]), self._grow(vectors, places[~below]))
            )
        return at

    def near(self, own: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (places of queries, places of words) that one edit separates; queries are of the tree's
        length or one less."""
        codes = _codes(own, length)
        counts = _vectors(codes)
        # Letters that the cell has not: one at most, which the edit replaces.
        strange = length - counts[:, self.letters].sum(axis=1)
        down = 1 if length == self.length else 0
        counts = counts[:, self.letters]
        queries, group = np.unique(
            np.column_stack([counts, strange])[strange <= down], axis=0, return_inverse=True
        )
        if not len(queries):
            return
        places = np.flatnonzero(strange <= down)[np.argsort(group.ravel(), kind="stable")]
        starts = np.searchsorted(np.sort(group.ravel()), np.arange(len(queries) + 1))
        vectors, strange = queries[:, :-1], queries[:, -1]
        points = vectors.astype(self.points.dtype)
        squares = (points**2).sum(axis=1)
        stack = [(0, np.arange(len(queries)))]
        while stack:
            at, reach = stack.pop()
            (low, high), leaf, branches = self.nodes[at]
            own_vectors = vectors[reach]
            above = np.maximum(own_vectors - high, 0).sum(axis=1) + strange[reach]
            below = np.maximum(low - own_vectors, 0).sum(axis=1)
            reach = reach[(below <= 1) & (above <= down)]
            if not len(reach):
                continue
            if branches is not None:
                stack += [(branch, reach) for branch in branches]
                continue
            # One up (and one down): the squared distance is the number of moved counts.
            distance = (
                squares[reach][:, None]
                + strange[reach][:, None]
                + self.squares[leaf][None, :]
                - 2 * (points[reach] @ self.points[leaf].T)
            )
            q, p = np.nonzero(distance == 1 + down)
            q, p = reach[q], leaf[p]
            yield from self._verified(
                codes, places, starts[q], starts[q + 1], self.starts[p], self.starts[p + 1]
            )

    def _verified(self, codes, places, q_from, q_to, p_from, p_to):
        """Of groups of anagrams that face each other, the words that one edit separates."""
        n_q, n_p = q_to - q_from, p_to - p_from
        small = n_q * n_p <= 4096
        for i in np.flatnonzero(~small):
            q, p = places[q_from[i] : q_to[i]], self.by_group[p_from[i] : p_to[i]]
            for a, b in _half_alike(codes[q], self.codes[p]):
                yield from self._one_edit(codes, q[a], p[b])
        q_from, p_from, n_q, n_p = q_from[small], p_from[small], n_q[small], n_p[small]
        sizes = n_q * n_p
        upto = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS)))
            pair = np.repeat(np.arange(at, to), sizes[at:to])
            inside = np.arange(len(pair)) - np.repeat(upto[at:to] - sizes[at:to], sizes[at:to])
            inside += upto[at - 1] if at else 0
            q = places[q_from[pair] + inside // n_p[pair]]
            p = self.by_group[p_from[pair] + inside % n_p[pair]]
            yield from self._one_edit(codes, q, p)
            at = to

    def _one_edit(self, codes, q, p):
        step = max(1, (1 << 24) // self.length)
        for at in range(0, len(q), step):
            i, j = q[at : at + step], p[at : at + step]
            right = _differ_by_one(codes[i], self.codes[j])
            if right.any():
                yield i[right], j[right]


def _differ_by_one(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether one replaced letter, or one letter inserted into ``a``, makes ``b``; row by row."""
    length = a.shape[1]
    if length == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.minimum.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    tail = np.minimum.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= length


def _half_alike(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that share the first half, then pairs that share the last half and not the first."""
    half = a.shape[1] // 2
    rest = a.shape[1] - half
    ids = []
    for x, y in ((a[:, :half], b[:, :half]), (a[:, half:], b[:, b.shape[1] - rest :])):
        _, inverse = np.unique(np.concatenate([x, y]), axis=0, return_inverse=True)
        ids.append((inverse.ravel()[: len(a)], inverse.ravel()[len(a) :]))
    for side, (x, y) in enumerate(ids):
        order = np.argsort(y, kind="stable")
        start = np.searchsorted(y[order], x)
        n = np.searchsorted(y[order], x, side="right") - start
        for at in range(0, len(x), 1024):
            own = np.arange(at, min(at + 1024, len(x)))
            i = np.repeat(own, n[own])
            offset = np.arange(len(i)) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
            j = order[start[i] + offset]
            if side:
                new = ids[0][0][i] != ids[0][1][j]
                i, j = i[new], j[new]
            yield i, j


_FOUND = "word binary, n_near long, form_n long, form binary"
_QUERIES_AT_ONCE = 1 << 14


class _Near:
    """Near words of some words: their number and the form among them so far."""

    def __init__(self):
        self.number: Counter = Counter()
        self.form: dict[bytes, tuple[int, bytes]] = {}

    def add(self, word: bytes, n: int, near: bytes, near_n: int) -> None:
        self.number[word] += 1
        if near_n >= RATIO * n:
            # The largest count first, then the smallest word.
            own = self.form.get(word)
            if own is None or (-near_n, near) < (-own[0], own[1]):
                self.form[word] = (near_n, near)

    def batches(self) -> Iterator[pa.RecordBatch]:
        found = list(self.number)
        for at in range(0, len(found), 10_000):
            part = found[at : at + 10_000]
            forms = [self.form.get(w, (None, None)) for w in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.binary()),
                    pa.array([self.number[w] for w in part], pa.int64()),
                    pa.array([f[0] for f in forms], pa.int64()),
                    pa.array([f[1] for f in forms], pa.binary()),
                ],
                names=["word", "n_near", "form_n", "form"],
            )
        self.__init__()


def _search_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell and part, words before queries; queries by length."""
    key, tree, own, queries = None, None, [], []
    near = _Near()

    def searched() -> None:
        nonlocal tree, queries
        if own and tree is None:
            tree = Tree([w for w, _ in own], np.array([n for _, n in own]), len(own[0][0]))
        if tree is not None:
            for length in sorted({len(w) for w, _ in queries}):
                asked = [(w, n) for w, n in queries if len(w) == length]
                for i, j in tree.near([w for w, _ in asked], length):
                    for a, b in zip(i.tolist(), j.tolist(), strict=True):
                        (word, n), other, other_n = asked[a], tree.words[b], int(tree.n[b])
                        near.add(word, n, other, other_n)
                        if length < tree.length:
                            near.add(other, other_n, word, n)
        queries = []

    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for length, cell, part, is_query, word, n in zip(*(c.to_pylist() for c in columns), strict=True):
            if (length, cell, part) != key:
                searched()
                key, tree, own = (length, cell, part), None, []
            if not is_query:
                own.append((word, n))
            else:
                queries.append((word, n))
                if len(queries) * length >= _QUERIES_AT_ONCE * 16:
                    searched()
        if len(near.number) >= COUNTED:
            searched()
            yield from near.batches()
    searched()
    yield from near.batches()


def near_words(spark: SparkSession, found: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of all words of (word, n) that have a near word."""
    trees = spark.sparkContext.broadcast(upper_trees(found))
    rows = stored(spark, found.mapInArrow(_route_partition(trees), _ROUTED), "cells")
    # Cells and their sizes: about one row per CELL letters of words.
    parts = (
        rows.where("NOT is_query")
        .groupBy("length", "cell")
        .agg(F.ceil(F.count(F.lit(1)) * F.first("length") / (2 * CELL)).cast("int").alias("parts"))
    )
    dealt = (
        rows.join(F.broadcast(parts), ["length", "cell"])
        .withColumn(
            "part",
            F.explode(
                F.when(F.col("is_query"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
                    F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
                )
            ),
        )
        .select("length", "cell", "part", "is_query", "word", "n")
    )
    cells = ["length", "cell", "part"]
    found_near = (
        dealt.repartition(shuffle_partitions(spark), *cells)
        .sortWithinPartitions(*cells, "is_query")
        .mapInArrow(_search_partition, _FOUND)
    )
    rank = F.struct((-F.col("form_n")).alias("less"), "form")
    best = F.min(F.when(F.col("form").isNotNull(), rank))
    return (
        found_near.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    )


def variants(
    spark: SparkSession, docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word, the near word that it is a variant of, and the
    last word that forms lead to.

    A form has at least ``RATIO`` times the occurrences, so a chain of forms is short, and is followed by
    doubling steps: the root of every word's form's root and so on, until none moves.
    """
    counted = stored(spark, words(docs, min_length, min_count), "words")
    near = near_words(spark, counted)
    known = stored(spark, counted.join(near, "word", "left"), "near-words")
    jumps = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = jumps.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = stored(spark, moved, "roots")
        jumps = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break

    def text(column: str) -> Column:
        return F.decode(F.col(column), "ISO-8859-1").alias(column)

    return known.join(jumps, "word", "left").select(
        text("word"),
        text("form"),
        F.decode(F.coalesce("root", "word"), "ISO-8859-1").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form_n",
    )

