"""Near-duplicate documents by b-bit MinHash: bands for candidates, bits for estimates, sets for links.

1. Each text becomes the set of its distinct word shingles. ``HASHES`` minima are taken over it; the
   first of them are hashed band by band, of all only ``BITS`` low bits are kept, packed. Texts with the
   same set collapse into the one with the smallest id.
2. Texts that share a band are candidates. A bucket links its members to its smallest, and families are
   the connected components of these links: texts in different families share no band at all. No pairs
   are made.
3. Families are dealt into chunks bounded in texts and in shingles. The packed signatures of two chunks
   (or one) are compared by bit counts, corrected for chance collisions, and the pairs at or above the
   threshold less a margin of ``MARGIN`` standard errors which are not connected yet are confirmed on the
   full sets, highest estimates first. Links that connect nothing new need no confirmation and are not
   written. The chunks of a large family meet in tiles, blocks of chunks against blocks of chunks, each
   tile with a key of its own: no key brings a family together, and a chunk is sent once per block of its
   family, not once per chunk.
4. Components come from the confirmed links and the collapsed copies.

A pair at the threshold is missed only if it shares no band (below 1 in 100,000) or its estimate is off
by the margin, and then only if nothing else connects it.

Cases: null and empty texts and texts without words have an empty set and link with nothing; texts with
fewer words than a shingle have their whole sequence; repeated rows are copies; rows that repeat an id
are one node, each is returned; a null id links with nothing and is its own null component; very long
texts are read as a whole; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm.common import components, shuffle_partitions, stored
from tablecheck.llm.shingles import mix, shingle_sets, text_groups

HASHES, BITS, BANDS, ROWS = 256, 2, 32, 5
MARGIN = 4.5
CHUNK, CHUNK_SHINGLES = 512, 1 << 20
#: A family of up to so many chunks has tiles of one chunk by one, larger ones up to MAX_SIDE by MAX_SIDE.
SMALL_FAMILY, MAX_SIDE = 32, 16

SIGNED = "doc_id long, n_shingles long, set_key binary, bits binary, bands array<long>"


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def minima(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The least value of each of HASHES hash functions over the set."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        block = np.multiply.outer(shingles[at : at + 512], multipliers)
        np.minimum(low, block.min(axis=0), out=low)
    return mix(low)


def packed(low: np.ndarray) -> bytes:
    """The low BITS bits of the minima, one plane of HASHES bits after the other."""
    planes = [np.packbits(((low >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(BITS)]
    return np.concatenate(planes).tobytes()


def band_hashes(low: np.ndarray) -> np.ndarray:
    rows = low[: BANDS * ROWS].reshape(BANDS, ROWS)
    out = mix(np.arange(BANDS, dtype=np.uint64))
    for r in range(ROWS):
        out = mix(out * np.uint64(5) + rows[:, r])
    return out.view(np.int64)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarities of all pairs of two blocks of packed signatures (rows of 64-bit words)."""
    words = HASHES // 64
    differ = np.zeros((len(a), len(b), words), dtype=np.uint64)
    for plane in range(BITS):
        part = slice(plane * words, (plane + 1) * words)
        differ |= a[:, None, part] ^ b[None, :, part]
    agree = 1.0 - np.bitwise_count(differ).sum(axis=2) / HASHES
    chance = 0.5**BITS
    return (agree - chance) / (1 - chance)


def least_estimate(threshold: float) -> float:
    """The threshold less MARGIN standard errors of the corrected estimate."""
    chance = 0.5**BITS
    agree = threshold * (1 - chance) + chance
    return threshold - MARGIN * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - chance)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers()
        for batch in batches:
            for first, data, offsets in text_groups(batch.column(1)):
                sets = shingle_sets(data, offsets, k)
                keys, bits, bands = [], [], []
                for s in sets:
                    low = minima(s, multipliers) if len(s) else None
                    keys.append(set_key(s) if len(s) else None)
                    bits.append(None if low is None else packed(low))
                    bands.append(None if low is None else band_hashes(low))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bits, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bits", "bands"],
                )

    return run


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bits, bands); null but for the first two if the set is empty."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sign(k), SIGNED
    )


class Chunk:
    """Some texts of a family: ids, sets and packed signatures."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray], bits: np.ndarray):
        self.ids, self.sets, self.bits = ids, sets, bits
        self.sizes = np.array([len(s) for s in sets])


def confirm(a: Chunk, b: Chunk | None, label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Confirmed links that connect ``label``, which has the class of each text of ``a``, then ``b``.

    A link is 100 * intersection >= percent * union. Without ``b``, pairs within ``a``.
    """
    least = least_estimate(percent / 100)
    other = b or a
    shift = len(a.ids) if b else 0
    links = []
    estimated = estimates(a.bits, other.bits)
    for i in range(len(a.ids)):
        close = np.flatnonzero(estimated[i] >= least)
        if b is None:
            close = close[close < i]
        sizes = other.sizes[close]
        close = close[
            100 * np.minimum(a.sizes[i], sizes) >= percent * np.maximum(a.sizes[i], sizes)
        ]
        close = close[np.argsort(-estimated[i, close], kind="stable")]
        step = 4
        while len(close := close[label[close + shift] != label[i]]):
            tried, close = close[:step], close[step:]
            step *= 2
            shared = _shared(a.sets[i], [other.sets[j] for j in tried])
            union = a.sizes[i] + other.sizes[tried] - shared
            for j in tried[100 * shared >= percent * union]:
                if label[j + shift] != label[i]:
                    label[label == label[j + shift]] = label[i]
                    links.append((int(a.ids[i]), int(other.ids[j])))
    return links


def _shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others."""
    together = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, together), len(one) - 1)
    same = np.concatenate([[0], np.cumsum(one[at] == together)])
    ends = np.cumsum([len(o) for o in others])
    return same[ends] - same[ends - [len(o) for o in others]]


LINKED = "family long, part int, parts int, a long, b long, chunk binary"
_LINKED = pa.schema(
    [
        ("family", pa.int64()),
        ("part", pa.int32()),
        ("parts", pa.int32()),
        ("a", pa.int64()),
        ("b", pa.int64()),
        ("chunk", pa.binary()),
    ]
)


def _within(k: int, percent: int):
    """Sorted rows (family, part, parts, doc_id, set_key, bits, text) -> links inside each chunk, and
    the chunk itself where its family has more than one."""

    def finish(family, part, parts, rows):
        chunk = Chunk(
            np.array([r[0] for r in rows], dtype=np.int64),
            [r[1] for r in rows],
            np.frombuffer(b"".join(r[2] for r in rows), dtype=np.uint64).reshape(len(rows), -1),
        )
        label = np.arange(len(rows))
        out = [(family, part, parts, a, b, None) for a, b in confirm(chunk, None, label, percent)]
        if parts > 1:
            blob = pickle.dumps((chunk.ids, chunk.sets, chunk.bits, label), protocol=5)
            out.append((family, part, parts, None, None, blob))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, seen, out = None, [], set(), []
        for batch in batches:
            for first, data, offsets in text_groups(batch.column(6)):
                sets = shingle_sets(data, offsets, k)
                rest = zip(
                    *[batch.column(c).slice(first, len(sets)).to_pylist() for c in range(6)],
                    sets,
                    strict=True,
                )
                for family, part, parts, doc_id, key, bits, shingles in rest:
                    if current != (family, part, parts):
                        if rows:
                            out += finish(*current, rows)
                        current, rows, seen = (family, part, parts), [], set()
                        if len(out) >= 1000 or any(o[5] for o in out):
                            yield pa.RecordBatch.from_pylist(_dicts(out), schema=_LINKED)
                            out = []
                    # Rows that repeat an id may have other texts; the key tells which is meant.
                    if key not in seen and set_key(shingles) == key:
                        seen.add(key)
                        rows.append((doc_id, shingles, bits))
        if rows:
            out += finish(*current, rows)
        if out:
            yield pa.RecordBatch.from_pylist(_dicts(out), schema=_LINKED)

    return run


def _dicts(rows: list[tuple]) -> list[dict]:
    return [dict(zip(_LINKED.names, r, strict=True)) for r in rows]


def _across(percent: int):
    """Sorted rows (family, i, j, own, chunk), the chunks of blocks i and j of a family, block i first ->
    links between different chunks that connect what is not connected inside."""

    def load(blob):
        ids, sets, bits, label = pickle.loads(blob)
        return Chunk(ids, sets, bits), label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                family, i, j, own = (batch.column(c)[row].as_py() for c in range(4))
                if current != (family, i, j):
                    current, held = (family, i, j), []
                b, label_b = load(batch.column(4)[row].as_py())
                links = []
                if own == j:
                    for a, label_a in held:
                        label = np.concatenate([label_a, label_b + len(a.ids)])
                        links += confirm(a, b, label, percent)
                if own == i:
                    held.append((b, label_b))
                if links:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ends, pa.int64()) for ends in zip(*links, strict=True)], names=["a", "b"]
                    )

    return run


def in_tiles(chunks: DataFrame, small: int = SMALL_FAMILY, most: int = MAX_SIDE) -> DataFrame:
    """(family, i, j, own, part, chunk): every chunk (family, part, parts, chunk) in each tile of its family
    that it belongs to, a tile being the blocks i <= j; two chunks of a family meet in exactly one tile."""
    side = F.least(F.lit(most), F.ceil(F.col("parts") / small)).cast("int")
    sided = chunks.select("family", "part", "parts", "chunk", side.alias("side"))
    own = F.floor(F.col("part") / F.col("side")).cast("int")
    blocks = F.ceil(F.col("parts") / F.col("side")).cast("int")
    return (
        sided.select(
            "family", "part", "side", "chunk", own.alias("own"), F.sequence(F.lit(0), blocks - 1).alias("all")
        )
        .select("family", "part", "side", "chunk", "own", F.explode("all").alias("other"))
        .where("side > 1 or own <> other")
        .select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "part", "chunk")
    )


def links_of(
    spark: SparkSession, docs: DataFrame, signed: DataFrame, k: int, percent: int, chunk: int = CHUNK
) -> DataFrame:
    """(a, b): confirmed links that connect all near-duplicates with different sets."""
    ones = signed.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min_by(F.struct("bits", "bands"), "doc_id").alias("sketch"),
        F.min("doc_id").alias("doc_id"),
        F.max("n_shingles").alias("n_shingles"),
    )
    banded = ones.select("doc_id", F.explode("sketch.bands").alias("band"))
    lowest = banded.groupBy("band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    # The join's keys are computed, so that both sides get an exchange which can be split.
    shared = banded.select("doc_id", F.bitwise_not("band").alias("key")).join(
        lowest.where("low < high").select("low", F.bitwise_not("band").alias("key")), "key"
    )
    members = components(spark, shared.select(F.col("doc_id").alias("a"), F.col("low").alias("b")))
    lengths = ones.select(F.col("doc_id").alias("node"), "n_shingles")
    families = stored(spark, members.join(lengths, "node"), "families")
    sizes = families.groupBy("component").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles")
    )
    by_size = F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.col("shingles") / CHUNK_SHINGLES))
    parts = F.least("n", by_size).cast("int")
    placed = (
        families.select("node", F.bitwise_not("component").alias("key"))
        .join(sizes.select(F.bitwise_not("component").alias("key"), parts.alias("parts")), "key")
        .select(
            F.col("node").alias("doc_id"),
            F.bitwise_not("key").alias("family"),
            "parts",
            F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"),
        )
    )
    keyed = ones.select("doc_id", "set_key", F.col("sketch.bits").alias("bits")).join(placed, "doc_id")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = (
        keyed.join(texts, "doc_id")
        .select("family", "part", "parts", "doc_id", "set_key", "bits", "text")
        .repartition(2 * shuffle_partitions(spark), "family", "part")
        .sortWithinPartitions("family", "part", "doc_id")
    )
    inside = stored(spark, rows.mapInArrow(_within(k, percent), LINKED), "links")
    chunks = inside.where("chunk is not null").select("family", "part", "parts", "chunk")
    tiles = (
        in_tiles(chunks)
        .repartition(2 * shuffle_partitions(spark), "family", "i", "j")
        .sortWithinPartitions("family", "i", "j", "part")
        .select("family", "i", "j", "own", "chunk")
    )
    across = tiles.mapInArrow(_across(percent), "a long, b long")
    return inside.where("a is not null").select("a", "b").unionAll(across)


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; links are texts whose sets of ``k``-word
    shingles have 100 * intersection >= percent * union."""
    signed = stored(spark, signatures(docs, k), "signed")
    links = links_of(spark, docs, signed, k, percent)
    copies = signed.where("set_key is not null and doc_id is not null").select("doc_id", "set_key")
    first = copies.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    same = (
        copies.select("doc_id", F.base64("set_key").alias("key"))
        .join(first.where("first < last").select("first", F.base64("set_key").alias("key")), "key")
        .select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    )
    classes = components(spark, links.unionAll(same))
    return (
        signed.select("doc_id", "n_shingles")
        .join(classes.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )
