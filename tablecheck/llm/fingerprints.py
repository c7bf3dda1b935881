"""Order MinHash fingerprints of texts: sketches that agree more the smaller the edit distance.

A text is cut into units (a word or up to 16 characters of one, with the space after it) and its k-mers
are runs of ``K`` units. A k-mer carries its occurrence number, so repeats count. Items are hashed once
and dealt into ``BINS`` bins of two halves; the minimal item of each half is kept, a bin's two items are
put into text order, and their hash is the bin's part of the signature: two texts agree in a bin only if
they share both minima and have them in the same order. An item belongs to one bin only, so a text costs
one hash per item and not one per item and bin; bins that are empty in both texts say nothing.

Everything is DataFrame functions. Texts are brought together once, by ranges of ids; all sorting and
grouping of k-mers happens inside those ranges without another exchange.

Cases: null is the empty text; a text without units, such as blanks only, is one unit as a whole; one
with fewer units than ``K`` is one k-mer; empty texts have an empty signature (all zeros), which agrees
fully with another empty one and not at all with others; rows with equal or null ids are separate rows,
ordered by text, null ids first. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BINS = 128
K = 3
UNIT = r"\S{1,16}\s*"
#: Ids are cut at quantiles (at most so many values reach the driver) and evenly between them.
QUANTILES, DOCS_PER_RANGE, MAX_RANGES = 256, 256, 1 << 17
POSITION_BITS = 24


def with_kmers(texts: DataFrame, column: str) -> DataFrame:
    """``texts`` with ``column`` replaced by ``runs``, an array of runs of K units as structs; one
    shorter run if there are fewer units. Each step is a projection of its own, so that the text is
    searched once."""
    rest = [c for c in texts.columns if c != column]
    text = F.col(column)
    found = texts.select(
        *rest,
        F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)).alias("found"),
        F.when(text.rlike(r"\S"), None).otherwise(text).alias("blank"),
    )
    no_units = F.when(F.col("blank") == "", F.array().cast("array<string>")).otherwise(F.array("blank"))
    units = found.select(
        *rest, F.when(F.col("blank").isNull(), F.col("found")).otherwise(no_units).alias("units")
    )
    counted = units.select(*rest, "units", F.size("units").alias("n_units"))
    last = F.greatest("n_units", F.lit(1))
    shifted = [F.col("units")] + [F.slice("units", i + 1, last) for i in range(1, K)]
    zipped = counted.select(
        *rest, "n_units", F.arrays_zip(*[u.alias(f"u{i}") for i, u in enumerate(shifted)]).alias("zipped")
    )
    n = F.when(F.col("n_units") == 0, 0).otherwise(F.greatest(F.col("n_units") - (K - 1), F.lit(1)))
    return zipped.select(*rest, F.slice("zipped", F.lit(1), n).alias("runs"))


def sketch(texts: DataFrame, keys: list[str], column: str, names: list[str]) -> DataFrame:
    """``texts`` has ``keys`` and an array of texts in ``column``; one row per key with a signature per
    text (arrays of ``BINS`` numbers, 0 for an empty bin) under ``names``.

    The keys must already bring rows together (``texts`` is partitioned by some of them); sorting and
    grouping by more keys then moves nothing.
    """
    per_text = texts.select(*keys, F.posexplode(column).alias("which", "one"))
    # Outer: a text without k-mers keeps a row of nulls.
    items = with_kmers(per_text, "one").select(
        *keys, "which", F.posexplode_outer("runs").alias("pos", "run")
    )
    items = items.select(
        *keys,
        "which",
        F.least("pos", F.lit((1 << POSITION_BITS) - 1)).cast("long").alias("pos"),
        F.when(F.col("run").isNotNull(), F.xxhash64("run")).alias("kmer"),
    )
    occurrence = F.row_number().over(Window.partitionBy(*keys, "which", "kmer").orderBy("pos"))
    items = items.select(
        *keys,
        "which",
        "pos",
        F.when(F.col("kmer").isNotNull(), F.xxhash64("kmer", occurrence)).alias("item"),
    )
    # The low 8 bits choose the bin and its half; the next 39 and the position make up one number, so
    # that a minimum keeps its place in the text.
    low = (1 << 39) - 1
    packed = F.shiftleft(F.shiftright("item", 8).bitwiseAND(F.lit(low)), POSITION_BITS) + F.col("pos")
    bin_of, half = F.pmod("item", F.lit(BINS)).cast("int"), F.shiftright("item", 7).bitwiseAND(F.lit(1))
    minima = items.groupBy(*keys, bin_of.alias("bin")).agg(
        *[
            F.min(F.when((F.col("which") == i) & (half == h), packed)).alias(f"m{i}{h}")
            for i in range(len(names))
            for h in (0, 1)
        ]
    )
    signed = minima.select(
        *keys, "bin", *[_tuple_hash(f"m{i}0", f"m{i}1").alias(f"v{i}") for i in range(len(names))]
    )
    gathered = signed.groupBy(*keys).agg(
        F.map_from_entries(
            F.collect_list(
                F.when(
                    F.col("bin").isNotNull(),
                    F.struct("bin", F.struct(*[f"v{i}" for i in range(len(names))])),
                )
            )
        ).alias("bins")
    )
    full = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.col("bins")[b])
    return gathered.select(*keys, full.alias("full")).select(
        *keys,
        *[
            F.transform("full", _value(f"v{i}")).alias(name)
            for i, name in enumerate(names)
        ],
    )


def _value(field: str):
    return lambda bins: F.coalesce(bins[field], F.lit(0))


def _tuple_hash(a: str, b: str) -> Column:
    """16 bits, never 0, of a bin's minima in text order; null for an empty bin."""
    x, y = F.shiftright(a, POSITION_BITS), F.shiftright(b, POSITION_BITS)
    place = (1 << POSITION_BITS) - 1
    first = F.col(a).bitwiseAND(F.lit(place)) <= F.col(b).bitwiseAND(F.lit(place))
    # xxhash64 skips nulls; which half a lone minimum is from is in its hash already.
    hashed = F.when(F.coalesce(first, F.lit(True)), F.xxhash64(x, y)).otherwise(F.xxhash64(y, x))
    return F.when(
        F.col(a).isNotNull() | F.col(b).isNotNull(), (F.pmod(hashed, F.lit(65535)) + 1).cast("int")
    )


def likeness(a: str, b: str) -> Column:
    """Share of the bins with an item in either text that agree; 1 for two empty texts."""
    pairs = F.arrays_zip(F.col(a).alias("x"), F.col(b).alias("y"))
    used = F.size(F.filter(pairs, lambda p: (p["x"] > 0) | (p["y"] > 0)))
    same = F.size(F.filter(pairs, lambda p: (p["x"] > 0) & (p["x"] == p["y"])))
    return F.when(used == 0, 1.0).otherwise(same / used)


def as_text(signature: str) -> Column:
    """Four hexadecimal digits per bin."""
    return F.lower(
        F.array_join(F.transform(signature, lambda v: F.lpad(F.hex(v), 4, "0")), "")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every text."""
    key = F.struct(F.col("doc_id"), F.monotonically_increasing_id().alias("row"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(key.alias("key"), F.array(text).alias("texts")).repartition("key")
    signed = sketch(rows.select("key", "texts"), ["key"], "texts", ["signature"])
    return signed.select(F.col("key.doc_id").alias("doc_id"), as_text("signature").alias("fingerprint"))


def in_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, text, bucket): consecutive ids share a bucket, and buckets rise with ids."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    steps = [i / QUANTILES for i in range(QUANTILES + 1)]
    n, cuts = ids.agg(
        F.count(F.lit(1)), F.percentile_approx("doc_id", steps, 20 * QUANTILES)
    ).collect()[0]
    cuts = sorted(set(cuts or [0]))
    per_range = max(DOCS_PER_RANGE, n // MAX_RANGES)
    parts = max(1, n // (per_range * len(cuts)))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    at = F.size(F.filter(F.lit(cuts), lambda c: c <= F.col("doc_id")))
    low = F.get(F.lit(cuts), at - 1)
    high = F.get(F.lit([*cuts[1:], cuts[-1] + 1]), at - 1)
    share = (F.col("doc_id") - low).cast("double") / (high - low).cast("double")
    inner = F.least(F.floor(share * parts), F.lit(parts - 1))
    bucket = F.when(F.col("doc_id").isNull(), -1).when(at == 0, 0).otherwise(at * parts + inner)
    return rows.withColumn("bucket", bucket.cast("long"))


def with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, place, text, next_text, ghost), partitioned by bucket.

    The next text by ascending id comes from the same bucket; a bucket's last row finds it in a ghost, a
    copy of the first row of the next bucket, marked as such.
    """
    rows = in_ranges(docs)
    firsts = rows.groupBy("bucket").agg(F.min("doc_id").alias("first_id"))
    # One row per bucket, at most MAX_RANGES and a few: small enough for one window and a broadcast.
    order = Window.orderBy("bucket")
    lowest = F.first("bucket").over(Window.orderBy("bucket"))
    homes = firsts.select(
        F.col("bucket").alias("of"),
        "first_id",
        F.lag("bucket").over(order).alias("home"),
        F.max("bucket").over(Window.partitionBy()).alias("last"),
        lowest.alias("lowest"),
    ).select("of", "first_id", F.coalesce("home", "last").alias("home"))
    ghosts = (
        rows.join(
            F.broadcast(homes),
            (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
        )
        .groupBy("home", "doc_id")
        .agg(F.min("text").alias("text"))
        .select(F.col("home").alias("bucket"), "doc_id", "text", F.lit(True).alias("ghost"))
    )
    every = rows.select("bucket", "doc_id", "text", F.lit(False).alias("ghost")).unionAll(
        ghosts.select("bucket", "doc_id", "text", "ghost")
    )
    every = every.repartition(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket")
    line = Window.partitionBy("bucket").orderBy("ghost", F.asc_nulls_first("doc_id"), "text")
    return every.select(
        "*", F.row_number().over(line).alias("place"), F.lead("text").over(line).alias("next_text")
    )


def against_edited_and_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every text's fingerprint beside those of its edited text and of the next document.

    The edited text has its last half replaced by as much of the start of the next text.
    """
    rows = with_next(spark, docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.coalesce(F.col("next_text"), F.lit("")), F.lit(1), half),
    )
    rows = rows.select("bucket", "place", "ghost", "doc_id", n.alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.select(
        "bucket",
        F.struct("place", "ghost", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")).alias("row"),
        F.array("text", "edited").alias("texts"),
    )
    signed = sketch(rows, ["bucket", "row"], "texts", ["own", "changed"])
    line = Window.partitionBy("bucket").orderBy("row")
    signed = signed.withColumn("following", F.lead("own").over(line)).where("not row.ghost")
    return signed.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.n_chars").cast("long").alias("n_chars"),
        F.col("row.edited_sha256").alias("edited_sha256"),
        as_text("own").alias("fingerprint"),
        as_text("changed").alias("edited_fingerprint"),
        likeness("own", "changed").cast("double").alias("near_edited"),
        likeness("own", "following").cast("double").alias("near_next"),
    )
