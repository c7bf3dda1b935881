"""A corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last
return the columns of ``documents``. Stages are written as Parquet and read again in between.

- quality: documents that the rule ensemble scores below 0.5 go. It learns from the labels of this
  input, none of them held out.
- near_dedup: of each group linked by 5-word shingles at a similarity of 0.8, the row with the smallest id
  stays, one without an id last. Rows are compared by their texts, whatever their ids; texts without words
  are in no group, but rows that repeat an id and its text are one document.
- suffix_dedup: bytes covered by 100-byte strings that start earlier are cut out, by whole characters;
  ``n_chars`` follows. A document of which nothing is left goes.
- mixing: sources are mixed to their target weights; a document that is taken several times has as many
  rows.
- packing: the mix as token sequences, one row per piece.

An empty ``documents`` table gives an empty result; further columns are not carried on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import minhash, mixing, packing, quality
from tablecheck.llm import suffix_dedup as suffixes
from tablecheck.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).where("predicted = 1").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Ids may be null or shared: each row gets a number of its own, written so that it holds.
    docs = docs.select(*COLUMNS).withColumns(
        {"row": F.monotonically_increasing_id(), "text_hash": F.xxhash64("text")}
    )
    docs = stored(spark, docs, "numbered")
    found = minhash.near_duplicates(
        spark, docs.select(F.col("row").alias("doc_id"), "text"), k=5, percent=80
    )
    wordless = F.col("n_shingles") == 0
    repeated = F.when(wordless & F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "lang", "source", "n_chars", "row")
    stay = (
        found.withColumnRenamed("doc_id", "row")
        .join(docs.drop("text"), "row")
        .withColumns({"repeated": repeated, "first": first})
        .groupBy(F.when(F.col("repeated").isNull(), F.col("component_id")), "repeated")
        .agg(F.min("first")["row"].alias("row"))
        .select("row")
    )
    return docs.join(stay, "row").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffixes.deduplicate(spark, docs, characters=True, keep=("lang", "source"))
    text = F.decode("kept", "utf-8")
    return (
        cut.where("n_bytes = 0 or octet_length(kept) > 0")
        .select("doc_id", text.alias("text"), "lang", "source")
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, keep=("text", "lang", "source", "n_chars"))
    return mixing.expand(mixed).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The stages hash and fit models; tests compare them with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
