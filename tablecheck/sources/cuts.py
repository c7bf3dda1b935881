"""Key ranges of equally many rows, cut on Spark by counting, without sorting the table."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from decimal import Context, Decimal
from itertools import count
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions import quoted

# Keys that the driver sees of a table per round, or this many per cut, and characters of text keys.
SAMPLE_ROWS, SAMPLE_PER_CUT, SAMPLE_CHARS = 1 << 16, 32, 1 << 22
# Characters of a text key that are looked at first; four times as many where they tell too little.
FIRST_CHARS = 64

# Sampled keys around the expected place of a cut that are counted, in quarters of the place's
# standard error: nearly always the cut is between two that are one quarter apart.
_NEAR = [0] + [sign * i for i in (1, 2, 3, 4, 5, 6, 8, 10, 12, 16) for sign in (1, -1)]
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
# Digits of decimals that are whole numbers of 64 bits once the point is left out.
_SHORT_DIGITS = 18


@dataclass(frozen=True)
class Cuts:
    """Edges between ranges, ascending: a row is in the range of the last edge that its key reaches.

    An edge has the number of rows below it. Rows below the first edge are the first range; NULL keys
    are in none. ``n_rows`` counts rows with a key, ``n_missing`` those without.
    """

    edges: list[Any]
    before: list[int]
    n_rows: int
    n_missing: int

    def sizes(self) -> list[int]:
        """Rows per range, then rows without a key."""
        ends = [*self.before, self.n_rows]
        return [b - a for a, b in zip([0, *ends], ends)] + [self.n_missing]


@dataclass(frozen=True)
class _Kind:
    """How keys of a type are compared: as ``key(column)``, of the SQL type ``of``."""

    key: Callable[[Column], Column]
    of: str
    # The least value above another; OverflowError if there is none.
    after: Callable[[Any], Any]
    # A value as text that can be cast to the type.
    text: Callable[[Any], str] = str
    # What a found value is to the caller.
    shown: Callable[[Any], Any] = lambda value: value

    @property
    def is_text(self) -> bool:
        return self.of == "string"

    @property
    def is_number(self) -> bool:
        """Keys that tasks look up as arrays."""
        return self.of in ("bigint", "double")


def _kind(of: T.DataType) -> _Kind:
    def same(column):
        return column

    if isinstance(of, T.IntegralType):
        return _Kind(lambda c: c.cast("bigint"), "bigint", _next_whole)
    if isinstance(of, T.DecimalType) and of.precision <= _SHORT_DIGITS:
        whole = F.lit(Decimal(10**of.scale))
        return _Kind(
            lambda c: (c * whole).cast("bigint"), "bigint", _next_whole,
            shown=lambda v: Decimal(v).scaleb(-of.scale),
        )
    if isinstance(of, T.DecimalType):
        step, wide = Decimal(1).scaleb(-of.scale), Context(prec=60)
        return _Kind(same, f"decimal(38,{of.scale})", lambda v: wide.add(v, step), "{:f}".format)
    if isinstance(of, T.FractionalType):
        # Every NaN is above infinity; it is not told from it here.
        return _Kind(lambda c: c.cast("double"), "double", lambda v: math.nextafter(v, math.inf), repr)
    if isinstance(of, T.StringType):
        return _Kind(same, "string", lambda v: v + "\0")
    if isinstance(of, T.DateType):
        return _Kind(
            lambda c: F.unix_date(c).cast("bigint"), "bigint", _next_whole,
            shown=lambda v: _EPOCH.date() + timedelta(days=v),
        )
    if isinstance(of, T.TimestampNTZType):
        return _Kind(same, "timestamp_ntz", lambda v: v + timedelta(microseconds=1))
    if isinstance(of, T.TimestampType):
        return _Kind(
            F.unix_micros, "bigint", _next_whole, shown=lambda v: _EPOCH + timedelta(microseconds=v)
        )
    raise TypeError(f"keys of type {of.simpleString()} cannot be cut")


def _next_whole(value: int) -> int:
    if value == 2**63 - 1:
        raise OverflowError
    return value + 1


@dataclass(frozen=True)
class _Range:
    """Keys from ``low`` to below ``high`` (None: open), the rows below them and in them."""

    low: Any
    high: Any
    before: int
    n: int


def part_starts(n_rows: int, partitions: int) -> list[int]:
    """Places of the first rows of equal parts, the larger parts first."""
    size, larger = divmod(n_rows, partitions)
    starts = [i * size + min(i, larger) for i in range(partitions)]
    return sorted({s for s in starts if s < n_rows})


def counted_cuts(df: DataFrame, column: str, partitions: int) -> Cuts:
    """The lowest keys of ``partitions`` parts with equally many rows, for keys of any ordered type.

    Order statistics without an order: in each round a bounded sample tells keys around the places of
    the cuts, all rows are counted between these keys, and each cut is looked for again between the
    two keys around it, until only one key is left there. A round is two scans of the key column;
    nothing but counts is shuffled, so no key, however frequent, makes a task larger. The number of
    rounds grows with the logarithm of the table, and a row takes steps as the logarithm of the number
    of keys counted between: whole numbers, short decimals, dates, times and floats are looked up as
    arrays. Of text keys the driver sees a prefix, as long as it
    takes to tell them apart; an edge of a text column is made of such a prefix, and has the same rows
    on either side as the key itself.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    kind = _kind(df.schema[column].dataType)
    rows = df.select(kind.key(quoted(column)).alias("k"))
    total = rows.agg(F.count("k").alias("keys"), F.count(F.lit(1)).alias("rows")).first()
    n_rows, n_missing = total["keys"], total["rows"] - total["keys"]
    keys = rows.where(F.col("k").isNotNull())
    chars = FIRST_CHARS
    found: dict[int, Any] = {}
    ranges = {p: _Range(None, None, 0, n_rows) for p in part_starts(n_rows, partitions)[1:]}
    for turn in count():
        if not ranges:
            break
        sampled = _sampled(rows, kind, ranges, chars, turn)
        splitters = _splitters(kind, ranges, sampled)
        buckets = list(_counted(keys, kind, splitters))
        narrower: dict[int, _Range] = {}
        for place, bucket, only_key in _holding(sorted(ranges), buckets):
            if only_key is None:
                narrower[place] = bucket
            else:
                found[bucket.before] = bucket.low if kind.is_text else only_key
        if any(2 * r.n > ranges[p].n for p, r in narrower.items()):
            chars *= 4
        ranges = narrower
    # The lowest key of all starts the first range, which is open below.
    edges = sorted((before, edge) for before, edge in found.items() if before > 0)
    return Cuts([kind.shown(e) for _, e in edges], [b for b, _ in edges], n_rows, n_missing)


def _holding(places: Sequence[int], buckets: Sequence[tuple]) -> Iterator[tuple]:
    """(place, range, its only key or None) for ascending places of rows."""
    at = 0
    for place in places:
        while buckets[at][0].before + buckets[at][0].n <= place:
            at += 1
        yield place, *buckets[at]


def _sampled(rows: DataFrame, kind: _Kind, ranges: dict[int, _Range], chars: int, seed: int) -> dict:
    """Sorted sampled keys per range that holds a cut."""
    open_ranges = sorted(set(ranges.values()), key=lambda r: r.before)
    bounds = sorted({v for r in open_ranges for v in (r.low, r.high) if v is not None})
    wanted = max(SAMPLE_ROWS, SAMPLE_PER_CUT * len(ranges))
    if kind.is_text:
        wanted = min(wanted, max(64, SAMPLE_CHARS // chars))
    share = wanted / max(1, sum(r.n for r in open_ranges))
    value = F.substring("k", 1, chars) if kind.is_text else F.col("k")
    by_bucket = {0 if r.low is None else bounds.index(r.low) + 1: r for r in open_ranges}
    # Only rows that were drawn are looked up, or even have their key worked out.
    drawn = rows.where(F.rand(seed) < share) if share < 1 else rows
    some = (
        drawn.where(F.col("k").isNotNull())
        .select("k", _bucket(kind, bounds).alias("bucket"))
        .where(F.col("bucket").isin(list(by_bucket)))
    )
    out: dict[_Range, list] = {r: [] for r in open_ranges}
    for row in some.select("bucket", value.alias("value")).collect():
        if row["value"] == row["value"]:  # but for NaN
            out[by_bucket[row["bucket"]]].append(row["value"])
    return {r: sorted(values) for r, values in out.items()}


def _splitters(kind: _Kind, ranges: dict[int, _Range], sampled: dict) -> list:
    """Keys to count between: bounds of the ranges, and sampled keys where the cuts should be."""
    out = {v for r in ranges.values() for v in (r.low, r.high) if v is not None}
    for place, within in ranges.items():
        values = sampled[within]
        share = (place - within.before) / max(1, within.n)
        middle = (place - within.before) * len(values) // max(1, within.n)
        quarter = max(1, int(math.sqrt(len(values) * share * (1 - share)) / 4))
        for step in _NEAR:
            at = middle + step * quarter
            if 0 <= at < len(values):
                out.update(v for v in _around(kind, values[at]) if _inside(within, v))
    return sorted(out)


def _around(kind: _Kind, value: Any) -> list:
    """A key and the least one above it: between them is that key alone."""
    try:
        return [value, kind.after(value)]
    except OverflowError:
        return [value]


def _inside(within: _Range, value: Any) -> bool:
    return (within.low is None or value > within.low) and (within.high is None or value < within.high)


def _counted(keys: DataFrame, kind: _Kind, splitters: list) -> Iterator[tuple[_Range, Any]]:
    """Every range between splitters that holds rows, with its only key, if it is only one.

    Of text keys, that is the one fingerprint.
    """
    mark = F.xxhash64("k") if kind.is_text else F.col("k")
    counts = (
        keys.select(_bucket(kind, splitters).alias("bucket"), mark.alias("mark"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("mark").alias("low"), F.max("mark").alias("high"))
        .collect()
    )
    before = 0
    for row in sorted(counts, key=lambda r: r["bucket"]):
        at = row["bucket"]
        low = splitters[at - 1] if at else None
        high = splitters[at] if at < len(splitters) else None
        only = row["low"] == row["high"] or row["low"] == math.inf or row["low"] != row["low"]
        yield _Range(low, high, before, row["n"]), row["low"] if only else None
        before += row["n"]


def _bucket(kind: _Kind, splitters: Sequence) -> Column:
    """How many of the ascending splitters a key reaches."""
    if not splitters:
        return F.lit(0)
    return _looked_up(kind, splitters) if kind.is_number else _filtered(kind, splitters)


def _looked_up(kind: _Kind, splitters: Sequence) -> Column:
    """By bisection, an array of keys at a time; NaN reaches all."""
    edges = np.array(splitters, dtype=np.int64 if kind.of == "bigint" else np.float64)

    def reached(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, keys.to_numpy(zero_copy_only=False), side="right"), pa.int32())

    return F.arrow_udf(reached, T.IntegerType())(F.col("k"))


def _filtered(kind: _Kind, splitters: Sequence) -> Column:
    """First among blocks of splitters, then in its block."""
    size = math.isqrt(len(splitters) - 1) + 1
    texts = [kind.text(v) for v in splitters]
    blocks = [texts[at : at + size] for at in range(0, len(texts), size)]
    # One literal, however many there are.
    blocks = F.from_json(F.lit(json.dumps(blocks)), "array<array<string>>").cast(f"array<array<{kind.of}>>")

    def reached(values: Column) -> Column:
        return F.size(F.filter(values, lambda v: v <= F.col("k")))

    block = reached(F.transform(blocks, lambda b: F.element_at(b, 1)))
    inside = F.element_at(blocks, block)
    return F.when(block == 0, 0).otherwise((block - 1) * size + reached(inside))


def cut_conditions(column: Column, edges: Sequence) -> list[Column]:
    """Conditions that put every row into exactly one of the ranges between the edges, NULL keys into
    one of their own."""
    missing = column.isNull()
    if not edges:
        return [~missing, missing]
    return [
        column < F.lit(edges[0]),
        *[(column >= F.lit(a)) & (column < F.lit(b)) for a, b in zip(edges, edges[1:])],
        column >= F.lit(edges[-1]),
        missing,
    ]
