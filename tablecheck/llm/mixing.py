"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's share of all words, at most ``cap`` times its own words; what is
above is shared again by weight until no source is above its cap. That fixed point has a closed form:
with sources by rising cap / weight, the first k are capped and the rest share what is left. Each
document of a source has target / size expected copies. Documents stand in a line (by rising size, so
that the words taken follow the copies taken); the sum of expected copies before a document, plus one
random offset per source, is its start on a ruler, and it is emitted once per integer boundary in its
interval. No document is taken more than ceil(target / size) times.

The line is never one task's work: it is cut into blocks of (source, size class, hash of the id, or of the
text where there is none); block counts are summed first, and only ranks inside a block need the rows
themselves. Sizes are counted once and written to the shared folder, with the columns to keep.

Cases: null or blank texts have size 0 and are placed first; a null source is a source of its own, last;
a source without words has target 0 and nothing is taken from it; rows with equal ids are separate
documents (ordered by size, the same for equal rows: either may be taken); an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, share: float = 1.0
) -> DataFrame:
    """(source_key, n_docs, source_size) -> the same with ``target``; one row per source.

    Weights repeat over sources in code point order, null last. Windows here run over one row per
    source.
    """
    place = F.row_number().over(Window.orderBy("source_key")) - 1
    weight = F.element_at(F.lit([float(w) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * F.lit(float(cap))
    )
    ratio = F.col("cap") / F.col("weight")
    rising = Window.orderBy(ratio, "source_key")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onwards = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(onwards))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight"))
    )
    first_fit = F.when(F.col("level") <= ratio, F.struct(ratio, "source_key", "level"))
    level = F.min(first_fit).over(everything)["level"]
    # No level fits only if the caps together are below the total: every source is at its cap.
    target = F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))
    return rows.select("source_key", "n_docs", "source_size", target.alias("target"))


def size_class() -> Column:
    """Eight classes per doubling of ``size``, from bits alone; 0 for size 0."""
    bits = "length(bin(size))"
    return F.expr(f"if(size > 0, {bits} * 8 + shiftright(size * 8, {bits} - 1) - 8, 0)").cast("int")


def source_key(source: Column) -> Column:
    """A key that is never null and sorts as sources do: by code point, null last."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def offset(key: Column, seed: str) -> Column:
    """In [0, 1), from the seed and the source's key."""
    digest = F.md5(F.concat(F.lit(f"{seed}/"), key))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def id_class(doc_id: Column, text: Column) -> Column:
    """Ids in any pattern, and rows without one, spread over all classes."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), text, F.lit("")))
    return F.conv(F.substring(digest, 1, 2), 16, 10).cast("int")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    cap: float = CAP,
    seed: str = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, *keep, source, size, source_size, target, copies) for every document.

    ``copies`` is how often the mix takes it; ``expand`` repeats the rows.
    """
    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    rows = docs.select(
        "doc_id",
        source_key(F.col("source")).alias("source_key"),
        word_count(F.col("text")).alias("size"),
        id_class(F.col("doc_id"), F.col("text")).alias("id_class"),
        *kept,
    )
    rows = stored(docs.sparkSession, rows.withColumn("size_class", size_class()), "sizes")
    block = ["source_key", "size_class", "id_class"]
    blocks = rows.groupBy(*block).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")
    )
    in_source = (
        Window.partitionBy("source_key")
        .orderBy("size_class", "id_class")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = blocks.withColumn("start", F.coalesce(F.sum("n").over(in_source), F.lit(0)))
    sizes = blocks.groupBy("source_key").agg(
        F.sum("n").alias("n_docs"), F.sum("words").alias("source_size")
    )
    starts = starts.join(source_targets(sizes, weights, cap), "source_key").select(
        *block, "start", "source_size", "target"
    )
    in_block = Window.partitionBy(*block).orderBy("size", F.asc_nulls_first("doc_id"))
    joined = rows.withColumn("rank", F.row_number().over(in_block) - 1).join(starts, block)
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank, shift = F.col("start") + F.col("rank"), offset(F.col("source_key"), seed)
    copies = F.floor(shift + each * (rank + 1)) - F.floor(shift + each * rank)
    return joined.select(
        "doc_id",
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)],
        "size",
        "source_size",
        "target",
        copies.cast("long").alias("copies"),
    )


def expand(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes."""
    return mixed.where("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
