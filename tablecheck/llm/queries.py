"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import (
    alignment,
    chat,
    cover_tree,
    fingerprints,
    html_extract,
    minhash,
    mixing,
    packing,
    quality,
    secret_scan,
    sharding,
    spelling,
    suffix_dedup,
)
from tablecheck.llm.common import shared_dir, table

N_SHARDS = 24


#: Control strings in the texts themselves, in a conversation of its own.
PROBE = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    events = chat.as_streamed_log(turns.unionByName(probe))
    return chat.read_back(chat.format_conversations(events))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_dedup.digests(suffix_dedup.deduplicate(spark, docs))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents")))


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(spark, table(spark, sf_dir, "embeddings"), 0.9)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"), k=3, percent=85)


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edited_and_next(spark, table(spark, sf_dir, "documents"))


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    # The map is made for one shard less, stored, and edited for one more.
    steps = (N_SHARDS - 1, N_SHARDS)
    placed, _ = sharding.shard_by_stored_map(spark, table(spark, sf_dir, "documents"), path, steps)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", "predicted"
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(spark, table(spark, sf_dir, "documents")))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_digests(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_main_text": op2_main_text,
    "op3_suffix_array": op3_suffix_array,
    "op4_pack": op4_pack,
    "op5_cover_tree": op5_cover_tree,
    "op6_mix_sources": op6_mix_sources,
    "op7_minhash": op7_minhash,
    "op8_order_minhash": op8_order_minhash,
    "op9_virtual_slots": op9_virtual_slots,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling": op11_spelling,
    "op12_secrets": op12_secrets,
    "op13_align": op13_align,
}
