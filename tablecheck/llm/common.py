"""Helpers of several operators: the shared folder, written tables, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where a session on one machine has none, as in tests, a temporary folder is set; on a cluster
    that is an error, because executors would write to disks of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop shuffle files that nothing refers to any more.

    It goes by the driver's garbage collection, which a driver with little to do may never start.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(spark: SparkSession, links: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b), for all linked nodes.

    Alternates two steps on distributed edges until nothing changes: every node hangs its larger
    neighbours below the smallest one it sees (large star), then its smaller neighbours likewise
    (small star). The number of rounds grows with the logarithm of the longest chain. A neighbourhood
    is only ever aggregated to its minimum, never gathered, so a node with very many links is no
    heavier than its share of rows. Each round is a written table.
    """
    edges = stored(spark, _oriented(links.select("a", "b")), "links")
    before = None
    for _ in range(rounds):
        edges = stored(spark, _small_star(_large_star(edges)), "links")
        state = edges.agg(
            F.count(F.lit(1)),
            F.sum(F.hash("a", "b").cast("long")),
            # Ids may be any bigint: their sum need not fit one.
            F.sum(F.col("b").cast("decimal(38,0)")),
        ).collect()[0]
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components: no end after {rounds} rounds")
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops)


def _oriented(links: DataFrame) -> DataFrame:
    """(a, b) with a > b, once each."""
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    # The join's key is computed: both sides get an exchange of their own, and adaptive execution can
    # split a node with very many links. A key taken over from the grouping would rule that out.
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return (
        both.where("b > a")
        .select("b", F.bitwise_not("a").alias("key"))
        .join(low.select("low", F.bitwise_not("a").alias("key")), "key")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.select("b", F.bitwise_not("a").alias("key")).join(
        low.select("low", F.bitwise_not("a").alias("key")), "key"
    )
    moved = moved.where("b <> low")
    return (
        moved.select(F.col("b").alias("a"), F.col("low").alias("b"))
        .unionAll(low.select("a", F.col("low").alias("b")))
        .where("a <> b")
        .distinct()
    )
