"""Sharding over fixed virtual slots, with a versioned map from slots to shards.

Records are hashed into a fixed number of virtual slots that never changes. Bytes are summed per slot
(a few thousand rows, whatever the input), and a slot-to-shard map is made from the sums: slots by
falling size, each to the least loaded shard. The map is a small versioned table; rebalancing edits it
(``rebalanced``) and moves only as many slots as it needs. Records are never moved between slots.

Cases: a null text has no bytes; a null id is hashed by text and size; rows that agree in all of them
share a slot, rows with the same id but other texts do not; an empty table gives an empty result and a
map of empty slots. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tablecheck.local import local_frame

N_SLOTS = 4096
RECORD_BYTES = 8
MAP_SCHEMA = StructType(
    [
        StructField("version", LongType(), False),
        StructField("virtual_slot", IntegerType(), False),
        StructField("shard", IntegerType(), False),
    ]
)


@dataclass(frozen=True)
class SlotMap:
    """``shards[slot]`` is the shard of a virtual slot."""

    version: int
    n_shards: int
    shards: tuple[int, ...]


def records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    light = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + RECORD_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    slot = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(n_slots)).cast("int")
    return light.withColumn("virtual_slot", slot)


def slot_sums(rows: DataFrame, n_slots: int = N_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows per slot; what comes to the driver is bounded by ``n_slots``."""
    size, count = [0] * n_slots, [0] * n_slots
    for r in (
        rows.groupBy("virtual_slot")
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        .collect()
    ):
        size[r.virtual_slot], count[r.virtual_slot] = r["size"], r["n"]
    return size, count


def first_map(size: list[int], n_shards: int, version: int = 1) -> SlotMap:
    """Largest slots first, each to the shard with the fewest bytes so far."""
    shards = [0] * len(size)
    loads = [(0, shard) for shard in range(n_shards)]
    for slot in sorted(range(len(size)), key=lambda s: (-size[s], s)):
        load, shard = heapq.heappop(loads)
        shards[slot] = shard
        heapq.heappush(loads, (load + size[slot], shard))
    return SlotMap(version, n_shards, tuple(shards))


def rebalanced(old: SlotMap, size: list[int], n_shards: int) -> SlotMap:
    """The map edited for ``n_shards``: shards that vanish give up all slots, shards above the mean
    those that do not fit below it; all else stays where it is."""
    loads = [0] * n_shards
    mean = sum(size) / n_shards
    shards, loose = list(old.shards), []
    for slot in sorted(range(len(size)), key=lambda s: (-size[s], s)):
        shard = shards[slot]
        if shard < n_shards and loads[shard] + size[slot] <= mean:
            loads[shard] += size[slot]
        else:
            loose.append(slot)
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    for slot in loose:
        load, shard = heapq.heappop(heap)
        shards[slot] = shard
        heapq.heappush(heap, (load + size[slot], shard))
    return SlotMap(old.version + 1, n_shards, tuple(shards))


def write_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Appends a version to the map table."""
    rows = [(slot_map.version, slot, shard) for slot, shard in enumerate(slot_map.shards)]
    local_frame(spark, rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A version of the map, the latest by default."""
    df = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = df.agg(F.max("version")).collect()[0][0]
    rows = df.where(F.col("version") == version).orderBy("virtual_slot").collect()
    shards = tuple(r.shard for r in rows)
    return SlotMap(version, max(shards) + 1, shards)


def place(rows: DataFrame, slot_map: SlotMap, count: list[int]) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the place in the shard, gapless from 0.

    A place is the number of rows in earlier virtual slots of the shard, which the slot counts give,
    plus the rank in the own slot: windows are as small as virtual slots, not as shards.
    """
    before, seen = [0] * len(count), [0] * slot_map.n_shards
    for virtual, shard in enumerate(slot_map.shards):
        before[virtual] = seen[shard]
        seen[shard] += count[virtual]
    in_slot = Window.partitionBy("virtual_slot").orderBy(
        F.asc_nulls_first("doc_id"), "text_crc32", "size"
    )
    at = F.col("virtual_slot") + 1
    return (
        rows.withColumn("rank", F.row_number().over(in_slot) - 1)
        .withColumn("shard", F.element_at(F.lit(list(slot_map.shards)), at).cast("int"))
        .withColumn("slot", F.element_at(F.lit(before), at).cast("long") + F.col("rank"))
        .drop("rank")
    )


def edited_map(spark: SparkSession, path: str, size: list[int], n_shards: int) -> SlotMap:
    """The map stored at ``path``, edited for these sizes and shards and stored as its next version; the
    first version where there is none. What is returned is read back from there."""
    try:
        old = read_map(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        old = None
    new = rebalanced(old, size, n_shards) if old else first_map(size, n_shards)
    write_map(spark, new, path)
    return read_map(spark, path, new.version)


def shard_by_stored_map(
    spark: SparkSession, docs: DataFrame, path: str, steps: Sequence[int], n_slots: int = N_SLOTS
) -> tuple[DataFrame, SlotMap]:
    """Records placed by the last of the versions that ``steps``, numbers of shards, add to a stored map."""
    rows = records(docs, n_slots)
    size, count = slot_sums(rows, n_slots)
    for n_shards in steps:
        slot_map = edited_map(spark, path, size, n_shards)
    return place(rows, slot_map, count), slot_map


def shard_documents(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS) -> tuple[DataFrame, SlotMap]:
    """Placed records and the map that placed them."""
    rows = records(docs, n_slots)
    size, count = slot_sums(rows, n_slots)
    slot_map = first_map(size, n_shards)
    return place(rows, slot_map, count), slot_map
