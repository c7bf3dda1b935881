"""Near-duplicate embeddings by dual traversal of cover trees: exact pairs above a cosine.

On unit vectors a cosine is a distance, d^2 = 2 - 2 cos. The top of the tree are cells: every vector
belongs to the nearest of at most ``MAX_CELLS`` pivots. Cells with more than ``CHUNK`` vectors are dealt
into chunks, and each chunk gets a cover tree: nested levels with halving radii, the children of a node
being a net of its vectors. Pairs of cells, and below them pairs of nodes, are dropped when their
centres are farther apart than both covering radii and the threshold together; a pair of nodes that lies
within the threshold as a whole is counted without looking at its vectors. The remaining leaves are
compared vector by vector, in double precision. A traversal gives each vector's number of links and its
smallest connected vector in that pair of chunks, so a dense group costs rows in proportion to its
members, not to its pairs. Components come from those rows.

Equal vectors are one entry with a weight before any of this, so that copies cost one row. Pairs of
chunks are done in tiles of ``SIDE`` by ``SIDE`` chunks, and a chunk's tree is sent once per tile that asks
for it.

How much is dropped depends on the data: clustered vectors leave few pairs of cells; vectors spread
evenly in many dimensions leave all of them, and the work grows with the square of the table, in blocks
of matrix products.

Vectors of different lengths never link; each length has cells and trees of its own.

Cases: vectors that are null, zero or hold null or non-finite components link with nothing; equal
vectors link; rows that repeat an id are one vector with the links
of all of them, each row is returned; a null id links with nothing and has no component; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StructField, StructType

from tablecheck.llm.common import components, shuffle_partitions, stored
from tablecheck.local import local_frame

CHUNK, MAX_CELLS, SIDE = 4096, 1024, 2
LEAST_RADIUS = 0.05
SLACK = 1e-9


def usable(vector: str = "embedding"):
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


class Tree:
    """Entries in tree order; nodes as (first, end, radius, children); a node's centre is its first.

    An entry has an id, a vector, the number of rows it stands for (``weights``) and how many of them are
    rows of its own id (``times``).
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray, times: np.ndarray):
        unit = unit_vectors(vectors)
        gram = unit @ unit.T
        self.order: list[int] = []
        self.nodes: list[tuple[int, int, float, list[int]]] = []
        self.root = self._build(np.arange(len(ids)), 2.0, gram)
        self.ids, self.vectors = ids[self.order], vectors[self.order]
        self.weights, self.times = weights[self.order], times[self.order]
        self.unit = unit[self.order]

    def packed(self) -> bytes:
        """Vectors as they came: unit vectors in double precision are made again from them."""
        return pickle.dumps((self.ids, self.vectors, self.weights, self.times, self.nodes), protocol=5)

    @classmethod
    def unpacked(cls, blob: bytes) -> Tree:
        tree = cls.__new__(cls)
        tree.ids, tree.vectors, tree.weights, tree.times, tree.nodes = pickle.loads(blob)
        tree.unit, tree.root = unit_vectors(tree.vectors), 0
        return tree

    def _build(self, members: np.ndarray, radius: float, gram: np.ndarray) -> int:
        """A node for the members, whose first is the centre; returns its number."""
        todo = [(members, radius, None)]
        made: list[list] = []
        while todo:  # depth first, so that a node's vectors lie together
            rows, r, parent = todo.pop()
            number = len(made)
            far = float(np.sqrt(max(0.0, 2 - 2 * gram[rows[0], rows].min())))
            made.append([rows, far, []])
            if parent is not None:
                made[parent][2].append(number)
            if len(rows) == 1 or far < LEAST_RADIUS:
                continue
            r = min(r, 2.0 ** math.floor(math.log2(far))) / 2
            close, rest, nets = 1 - r * r / 2, rows, []
            while len(rest):
                near = gram[rest[0], rest] >= close
                near[0] = True
                nets.append(rest[near])
                rest = rest[~near]
            todo.extend((net, r, number) for net in reversed(nets))
        # The centre of a node is the centre of its first child, so one order serves all levels.
        for rows, far, children in made:
            first = len(self.order)
            if not children:
                self.order.extend(rows.tolist())
            self.nodes.append([first, first + len(rows), far, children])
        return 0


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """In double precision; scaled by a power of two first, so that no square overflows or vanishes."""
    vectors = np.asarray(vectors, dtype=float)
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    vectors = np.ldexp(vectors, -exponent)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class Traversal:
    """Links of the vectors of tree ``a`` in tree ``b``, which may be the same tree."""

    def __init__(self, a: Tree, b: Tree, cosine: float):
        self.a, self.b, self.cosine = a, b, cosine
        self.eps = math.sqrt(2 - 2 * cosine)
        self.links = np.zeros(len(a.ids), dtype=np.int64)
        self.back = np.zeros(len(b.ids), dtype=np.int64)
        self.parent = np.arange(len(a.ids) + len(b.ids))

    def run(self) -> None:
        pairs = [(self.a.root, self.b.root)]
        while pairs:
            i, j = pairs.pop()
            left, right = self._children(self.a, i), self._children(self.b, j)
            if len(left) == 1 and len(right) == 1 and left[0] == i and right[0] == j:
                self._leaves(self.a.nodes[i], self.b.nodes[j])
            else:
                pairs.extend(self._survivors(left, right))

    @staticmethod
    def _children(tree: Tree, i: int) -> list[int]:
        return tree.nodes[i][3] or [i]

    def _survivors(self, left: list[int], right: list[int]) -> list[tuple[int, int]]:
        """Pairs of nodes that may hold links; pairs of single vectors and whole pairs are settled."""
        a, b = [self.a.nodes[i] for i in left], [self.b.nodes[j] for j in right]
        first_a, first_b = np.array([n[0] for n in a]), np.array([n[0] for n in b])
        cos = self.a.unit[first_a] @ self.b.unit[first_b].T
        far_a, far_b = np.array([n[2] for n in a]), np.array([n[2] for n in b])
        one_a = np.array([n[1] - n[0] == 1 for n in a])
        one_b = np.array([n[1] - n[0] == 1 for n in b])
        singles = np.nonzero((cos >= self.cosine) & one_a[:, None] & one_b)
        self._link(first_a[singles[0]], first_b[singles[1]])
        if one_a.all() and one_b.all():
            return []
        apart = np.sqrt(np.maximum(0, 2 - 2 * cos))
        reach = far_a[:, None] + far_b
        open_ = (apart <= reach + self.eps + SLACK) & ~(one_a[:, None] & one_b)
        whole = open_ & (apart + reach <= self.eps - SLACK)
        for i, j in zip(*np.nonzero(whole), strict=True):
            self._whole(a[i], b[j])
        return [(left[i], right[j]) for i, j in zip(*np.nonzero(open_ & ~whole), strict=True)]

    def _link(self, i: np.ndarray, j: np.ndarray) -> None:
        other = self.a.ids[i] != self.b.ids[j]
        i, j = i[other], j[other]
        np.add.at(self.links, i, self.b.weights[j])
        np.add.at(self.back, j, self.a.weights[i])
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            self._union(x, len(self.a.ids) + y)

    def _whole(self, a, b) -> None:
        rows_a, rows_b = slice(a[0], a[1]), slice(b[0], b[1])
        ids_a, ids_b = self.a.ids[rows_a], self.b.ids[rows_b]
        weights_a, weights_b = self.a.weights[rows_a], self.b.weights[rows_b]
        self.links[rows_a] += weights_b.sum() - _weight_in(ids_a, ids_b, weights_b)
        self.back[rows_b] += weights_a.sum() - _weight_in(ids_b, ids_a, weights_a)
        for x in range(a[0], a[1]):
            self._union(x, len(self.a.ids) + b[0])
        for y in range(b[0], b[1]):
            self._union(a[0], len(self.a.ids) + y)

    def _leaves(self, a, b) -> None:
        near = self.a.unit[a[0] : a[1]] @ self.b.unit[b[0] : b[1]].T >= self.cosine
        near &= self.a.ids[a[0] : a[1], None] != self.b.ids[b[0] : b[1]]
        self.links[a[0] : a[1]] += near @ self.b.weights[b[0] : b[1]]
        self.back[b[0] : b[1]] += self.a.weights[a[0] : a[1]] @ near
        # Each row's links are joined through its first column and, column by column, that is enough:
        # all columns of a row join the row.
        for x, row in enumerate(near):
            for y in np.flatnonzero(row).tolist():
                self._union(a[0] + x, len(self.a.ids) + b[0] + y)

    def _find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def _union(self, x: int, y: int) -> None:
        x, y = self._find(x), self._find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def result(self, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, links, smallest connected id) of entries with links."""
        ids = np.concatenate([self.a.ids, self.b.ids])
        links = np.concatenate([self.links, 0 * self.back if same else self.back])
        links = links * np.concatenate([self.a.times, self.b.times])
        used = np.concatenate([self.links, self.back]) > 0
        tops = np.array([self._find(x) for x in np.flatnonzero(used)], dtype=np.int64)
        low = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(low, tops, ids[used])
        out = ids[used], links[used], low[tops]
        if same:  # the second half repeats the first
            keep = np.flatnonzero(used) < len(self.a.ids)
            out = tuple(x[keep] for x in out)
        return out


def _weight_in(these: np.ndarray, those: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weight that each of these ids has among those."""
    order = np.argsort(those, kind="stable")
    below = np.concatenate([[0], np.cumsum(weights[order])])
    ordered = those[order]
    return below[np.searchsorted(ordered, these, "right")] - below[np.searchsorted(ordered, these, "left")]


def _cells(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = unit_vectors(pivots)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.array(batch.column(1).flatten(), dtype=float).reshape(batch.num_rows, -1)
            cos = unit_vectors(vectors) @ unit.T
            cell = cos.argmax(axis=1)
            apart = np.sqrt(np.maximum(0, 2 - 2 * cos[np.arange(len(cell)), cell]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(apart)],
                names=["vec_id", "vector", "weight", "times", "cell", "apart"],
            )

    return run


def _plant(pdf: pd.DataFrame) -> pd.DataFrame:
    columns = [pdf[c].to_numpy(np.int64) for c in ("vec_id", "weight", "times")]
    tree = Tree(columns[0], np.stack(pdf["vector"].to_numpy()), *columns[1:])
    return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "part": [pdf["part"].iloc[0]], "tree": [tree.packed()]})


def _traverse(cosine: float):
    """Sorted rows (i, j, number, partners, tree): the trees of a tile, each with the numbers of those that
    it is to be compared with. At most ``2 * SIDE`` trees are held."""

    def finish(trees: dict[int, Tree], asked: list[tuple[int, int]]):
        for x, y in asked:
            traversal = Traversal(trees[x], trees[y], cosine)
            traversal.run()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in traversal.result(x == y)], names=["vec_id", "n", "low"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, trees, asked = None, {}, []
        for batch in batches:
            for row in range(batch.num_rows):
                i, j, number, partners, blob = (column[row].as_py() for column in batch.columns)
                if current != (i, j):
                    yield from finish(trees, asked)
                    current, trees, asked = (i, j), {}, []
                trees[number] = Tree.unpacked(blob)
                asked += [(number, other) for other in partners]
        yield from finish(trees, asked)

    return run


_PAIRS = StructType([StructField("cell_a", IntegerType()), StructField("cell_b", IntegerType())])


def rows_to_compare(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, own): the usable rows; ``own`` is the id where several of them have it."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    good = vectors.where(usable()).where("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast(f"array<{'float' if single else 'double'}>").alias("vector"),
    )
    # The join's key is computed, so that a very frequent id can be split.
    several = good.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = several.select(F.bitwise_not("vec_id").alias("key"), F.lit(True).alias("several"))
    return good.withColumn("key", F.bitwise_not("vec_id")).join(several, "key", "left").select(
        "vec_id", "vector", F.when(F.col("several"), F.col("vec_id")).alias("own")
    )


def entries(rows: DataFrame) -> DataFrame:
    """(vec_id, vector, weight, times, print): equal vectors as one, with their smallest id. An id of
    several rows keeps entries of its own, because rows of one id do not link with each other."""
    merged = rows.groupBy("own", "vector").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight")
    )
    times = F.when(F.col("own").isNull(), F.lit(1).cast("long")).otherwise(F.col("weight"))
    return merged.select("vec_id", "vector", "weight", times.alias("times"), _print().alias("print"))


def _print():
    """128 bits that tell vectors apart."""
    return F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b"))


def near_pairs(spark: SparkSession, merged: DataFrame, cosine: float, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n, low) per entry with links and pair of chunks: its links there, and the smallest id
    that it is connected with there. ``merged`` has ``entries``."""
    good = merged.drop("print")
    lengths = good.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    found = spark.createDataFrame([], "vec_id long, n long, low long")
    for row in sorted(lengths):
        own = good.where(F.size("vector") == row.length)
        if row.n > 1:
            # What a length leaves is written before the next one starts, unless it is the only one.
            pairs = _near_pairs_of_length(spark, own, row.n, cosine, chunk)
            found = found.unionByName(pairs if len(lengths) == 1 else stored(spark, pairs, "near"))
    return found


def _near_pairs_of_length(
    spark: SparkSession, good: DataFrame, n: int, cosine: float, chunk: int
) -> DataFrame:
    k = max(1, min(MAX_CELLS, n // chunk))
    pivots = good.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(k).collect()
    pivots = np.array([p.vector for p in pivots])
    vector_type = good.schema["vector"].dataType.simpleString()
    celled = good.mapInArrow(
        _cells(pivots), f"vec_id long, vector {vector_type}, weight long, times long, cell int, apart double"
    )
    celled = stored(spark, celled, "cells")
    stats = {
        r.cell: (r.n, r.radius)
        for r in celled.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"), F.max("apart").alias("radius"))
        .collect()
    }
    parts = [-(-stats[c][0] // chunk) if c in stats else 0 for c in range(len(pivots))]
    before = [0, *np.cumsum(parts).tolist()]
    # No two entries agree in id and vector, so the hash deals them evenly.
    parts_of = F.element_at(F.lit([max(1, p) for p in parts]), F.col("cell") + 1)
    part = F.pmod(F.xxhash64("vec_id", "vector"), parts_of).cast("int")
    trees = (
        celled.withColumn("part", part)
        .groupBy("cell", "part")
        .applyInPandas(_plant, "cell int, part int, tree binary")
    )
    number = F.element_at(F.lit(before), F.col("cell") + 1) + F.col("part")
    trees = stored(spark, trees.select("cell", number.cast("int").alias("number"), "tree"), "trees")
    known = trees.select("cell", "number")
    pairs = (
        local_frame(spark, _cell_pairs(pivots, stats, cosine), _PAIRS)
        .join(known.toDF("cell_a", "x"), "cell_a")
        .join(known.toDF("cell_b", "y"), "cell_b")
        .where("x <= y")
        .selectExpr(f"int(x div {SIDE}) AS i", f"int(y div {SIDE}) AS j", "x", "y")
    )
    asked = (
        pairs.select("i", "j", F.col("x").alias("number"), F.col("y").alias("partner"))
        .unionAll(pairs.select("i", "j", "y", F.lit(None).cast("int")))
        .groupBy("i", "j", "number")
        .agg(F.collect_set("partner").alias("partners"))  # at most SIDE of them
    )
    tiles = (
        asked.join(trees.select("number", "tree"), "number")
        .repartition(2 * shuffle_partitions(spark), "i", "j")
        .sortWithinPartitions("i", "j", "number")
    )
    return tiles.select("i", "j", "number", "partners", "tree").mapInArrow(
        _traverse(cosine), "vec_id long, n long, low long"
    )


def _cell_pairs(pivots: np.ndarray, stats: dict, cosine: float) -> list[tuple[int, int]]:
    """Pairs of cells, a <= b, that the covering radii leave; at most MAX_CELLS^2 / 2."""
    cells = sorted(stats)
    unit = unit_vectors(pivots)
    apart = np.sqrt(np.maximum(0, 2 - 2 * unit @ unit.T))
    eps = math.sqrt(2 - 2 * cosine)
    return [
        (a, b)
        for i, a in enumerate(cells)
        for b in cells[i:]
        if apart[a, b] <= stats[a][1] + stats[b][1] + eps + SLACK
    ]


def near_duplicates(spark: SparkSession, vectors: DataFrame, cosine: float) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    rows = stored(spark, rows_to_compare(vectors), "rows")
    merged = stored(spark, entries(rows), "entries")
    found = stored(spark, near_pairs(spark, merged, cosine), "near")
    links = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    classes = components(spark, found.select(F.col("vec_id").alias("a"), F.col("low").alias("b")))
    linked = links.join(classes.toDF("vec_id", "component"), "vec_id", "left")
    # What an entry of several ids found holds for each of them, beside the links among themselves.
    shared = merged.where("weight > times").select("vec_id", "print", "weight").join(linked, "vec_id", "left")
    shared = shared.select(
        "print",
        (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component"),
    )
    members = rows.where("own is null").select("vec_id", _print().alias("print"))
    members = members.join(shared, "print").select("vec_id", "n_links", "component")
    alone = linked.join(merged.where("weight > times").select("vec_id"), "vec_id", "left_anti")
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
        .join(alone.unionByName(members), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
