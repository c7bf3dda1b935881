"""Removal of repeated passages with suffix arrays: every byte that is covered by a ``window``-byte
string which also starts earlier, in a smaller document or earlier in the same one.

Suffixes are dealt into shards so that equal windows always meet, without moving the corpus:

1. Each window of a text has an anchor, the place in it with the least hash of ``SEED`` bytes; equal
   windows have equal anchors at equal places. Windows that follow each other mostly share their anchor;
   such a run and its bytes are a segment (about 140 bytes). Tasks send only numbers per segment: hashes
   of anchor and bytes, place and length.
2. Anchors that occur once hold no repeats. Of equal segments the first stays and the others are spans
   to remove (this happens in the sending tasks first, so a segment copied very often is sent by each
   only once). Anchors with two or more different segments remain.
3. The bytes of those segments are cut from the texts, written, and dealt by anchor. Each task builds the
   suffix array of its segments by induced sorting and the permuted common prefixes; neighbours that share
   ``window`` bytes are one class of equal windows, of which all but the earliest are removed. Windows
   whose hash occurs once in the task equal no other and are left out of the array.
   An anchor whose different segments have more than ``HOT_BYTES`` (the edge of a passage that very many
   documents share) is dealt further, by its single windows, so that no suffix array grows beyond
   ``ARRAY_BYTES`` and ``HOT_BYTES``: first their hashes meet, as numbers; of those that occur more than
   once, which are few, tasks send each different window once, with its earliest place.
4. Spans are gathered by document, merged and cut out.

Cases: null is the empty text; texts shorter than ``window`` keep everything; repeated rows (same id and
text) are one document and have the same result; rows with the same id, or none, and other texts are told
apart by a 64-bit hash of the text, in whose order they count; a null id comes first; an empty table gives
an empty result. Texts of more than 2 GB are not possible in Spark. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm.common import release, shuffle_partitions, stored
from tablecheck.llm.shingles import mix, text_groups
from tablecheck.llm.suffix_array import permuted_common_prefixes, suffix_array

WINDOW, SEED = 100, 20
#: Texts are hashed together up to so many bytes, so that the work stays in the processor's cache; a
#: longer one alone. Bytes of segments are sent up to so many at a time.
BLOCK_BYTES, CUT_BYTES = 1 << 15, 1 << 22
#: Sender's packets: so many segments are sorted and sent at a time.
PACKET_SEGMENTS = 1 << 18
#: Suffix arrays are built over about so many bytes; all segments of an anchor stay together, unless they
#: have more than HOT_BYTES. Tasks hold at most HOT_WINDOWS different windows of such anchors.
ARRAY_BYTES, HOT_BYTES, HOT_WINDOWS = 1 << 20, 1 << 21, 1 << 16
NULL_ID = -(1 << 63)

_BASE = int(mix(np.array([11], dtype=np.uint64))[0]) | 1
#: A segment on its way: order matters, the first five are its identity and place.
SEGMENT = np.dtype(
    [
        ("anchor", "<u8"),
        ("content", "<u8"),
        ("id", "<i8"),
        ("start", "<u4"),
        ("variant", "<i8"),
        ("windows", "u1"),
    ]
)


def keyed(docs: DataFrame, *others: Column) -> DataFrame:
    """(id, variant, text, *others): the first three are never null."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(text).alias("variant"),
        text.alias("text"),
        *others,
    )


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


class Hasher:
    """Hashes of any part of a run of bytes, from prefix sums of a polynomial."""

    def __init__(self, base: int = _BASE):
        self.base, self.forth, self.back = base, _powers(base, 0), _powers(1, 0)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.forth) <= len(data):
            self.forth = _powers(self.base, len(data))
            self.back = _powers(pow(self.base, -1, 1 << 64), len(data))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.add(data, 1, out=out[1:], dtype=np.uint64)
        out[1:] *= self.forth[: len(data)]
        np.cumsum(out, out=out)
        return out

    def part(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.back[start]

    def sliding(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Of each ``width`` neighbours."""
        out = sums[width:] - sums[:-width]
        out *= self.back[: len(out)]
        return out


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def segments(data: np.ndarray, offsets: np.ndarray, hasher: Hasher, window: int) -> tuple[np.ndarray, ...]:
    """(text number, start in the text, windows, anchor, content) of all segments of a group of texts."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < window:
        return none
    sums = hasher.sums(data)
    # Hash of SEED bytes at each place, its upper bits spread. The low 31 bits give way to the place, so
    # that of equal hashes the last one is the least: the choice depends on the window's bytes alone.
    hashed = hasher.sliding(sums, SEED)
    hashed ^= hashed >> np.uint64(32)
    hashed *= np.uint64(0x94D049BB133111EB)
    place_bits = np.uint64((1 << 31) - 1)
    least = hashed & ~place_bits
    least |= place_bits - np.arange(len(hashed), dtype=np.uint64)
    least = sliding_least(least, window - SEED + 1)
    # Whole windows are the first ones of each text.
    last_whole = np.maximum(offsets[1:] - window + 1, offsets[:-1])
    fresh = np.empty(len(least), dtype=bool)
    fresh[0] = True
    np.not_equal(least[1:], least[:-1], out=fresh[1:])
    fresh[offsets[:-1][offsets[:-1] < len(least)]] = True
    begin = np.flatnonzero(fresh)
    text = np.searchsorted(offsets, begin, side="right") - 1
    whole = begin < last_whole[text]
    begin, text = begin[whole], text[whole]
    if not len(begin):
        return none
    # A segment ends before the next one, or where its text has no more whole windows.
    end = np.minimum(np.append(begin[1:], len(least)), last_whole[text])
    content = mix(hasher.part(sums, begin, end + window - 1) ^ mix((end - begin).astype(np.uint64)))
    at = (place_bits - (least[begin] & place_bits)).astype(np.int64)
    return text, begin - offsets[text], end - begin, mix(hashed[at]), content


def repeated(values: np.ndarray) -> np.ndarray:
    """True for values that occur more than once."""
    order = np.argsort(values)
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(values), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def first_of_equal(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments sorted, equal rows once: (those that are the first with their bytes, the others)."""
    order = np.lexsort(
        (found["start"], found["variant"], found["id"], found["content"], found["anchor"])
    )
    found = found[order]
    same_bytes = (found["anchor"][1:] == found["anchor"][:-1]) & (
        found["content"][1:] == found["content"][:-1]
    )
    same_place = (
        (found["id"][1:] == found["id"][:-1])
        & (found["variant"][1:] == found["variant"][:-1])
        & (found["start"][1:] == found["start"][:-1])
    )
    is_first = np.concatenate([[True], ~same_bytes])
    is_row = np.concatenate([[True], ~(same_bytes & same_place)])
    return found[is_first], found[is_row & ~is_first]


PACKETS = "bucket int, spans boolean, packet binary"
_PACKETS = pa.schema([("bucket", pa.int32()), ("spans", pa.bool_()), ("packet", pa.binary())])


def _packets(found: np.ndarray, others: np.ndarray, buckets: int) -> pa.RecordBatch:
    """``found`` dealt into buckets, and ``others``, which ride along with any."""
    # The high bits of an anchor choose the bucket, which is the number of a task.
    bucket = ((found["anchor"] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    columns, bucket = _columns(found[order]), bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rows = [
        (b, False, _pack(columns, low, high))
        for b, low, high in zip(
            bucket[first].tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True
        )
    ]
    if len(others):
        rows.append((int(others["start"][0]) % buckets, True, _pack(_columns(others), 0, len(others))))
    return _rows(rows, _PACKETS)


def _send(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, waiting, count = Hasher(), [], 0

        def packets():
            found = np.concatenate(waiting)
            # Most anchors occur once; only the others are sorted.
            again = repeated(found["anchor"])
            if not again.any():
                return _packets(found, found[:0], buckets)
            firsts, others = first_of_equal(found[again])
            return _packets(np.concatenate([found[~again], firsts]), others, buckets)

        for batch in batches:
            ids = batch.column(0).to_numpy()
            variants = batch.column(1).to_numpy()
            for row, data, offsets in text_groups(batch.column(2), BLOCK_BYTES):
                text, start, windows, anchor, content = segments(data, offsets, hasher, window)
                if not len(text):
                    continue
                part = np.empty(len(text), dtype=SEGMENT)
                part["anchor"], part["content"] = anchor, content
                part["id"], part["variant"] = ids[row + text], variants[row + text]
                part["start"], part["windows"] = start, windows
                waiting.append(part)
                count += len(part)
                if count >= PACKET_SEGMENTS:
                    yield packets()
                    waiting, count = [], 0
        if waiting:
            yield packets()

    return run


def _columns(found: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(found[name]) for name in SEGMENT.names]


def _pack(columns: list[np.ndarray], low: int, high: int) -> bytes:
    """Column by column, which compresses better than row by row."""
    return b"".join([c[low:high].tobytes() for c in columns])


def _unpack(packets: list[bytes]) -> np.ndarray:
    sizes = [len(p) // SEGMENT.itemsize for p in packets]
    out, at = np.empty(sum(sizes), dtype=SEGMENT), 0
    for name in SEGMENT.names:
        kind = SEGMENT[name]
        column = [np.frombuffer(p, kind, n, n * at) for p, n in zip(packets, sizes, strict=True)]
        out[name] = np.concatenate(column)
        at += kind.itemsize
    return out


SPANS = "id long, variant long, start long, end long, anchor long, hot boolean"
_SPANS = pa.schema(
    [
        ("id", pa.int64()),
        ("variant", pa.int64()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("anchor", pa.int64()),
        ("hot", pa.bool_()),
    ]
)
_PIECES = pa.schema([*list(_SPANS)[:5], ("bytes", pa.binary())])


def _span_batches(rows: np.ndarray, window: int, hot: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Segments as spans; with ``hot``, as those to compare."""
    anchored = hot is not None
    for at in range(0, len(rows), 50_000):
        r = rows[at : at + 50_000]
        start = r["start"].astype(np.int64)
        anchor = r["anchor"].view(np.int64) if anchored else np.zeros(len(r), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(r["id"]),
                pa.array(np.ascontiguousarray(r["variant"])),
                pa.array(start),
                pa.array(start + r["windows"] + (window - 1)),
                pa.array(np.ascontiguousarray(anchor), mask=None if anchored else np.ones(len(r), bool)),
                pa.array(hot[at : at + 50_000]) if anchored else pa.nulls(len(r), pa.bool_()),
            ],
            schema=_SPANS,
        )


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, np.ndarray]]:
    """(True, spans) of each packet of spans, then (False, those of repeated anchors) of all others."""
    waiting = []
    for batch in batches:
        for spans, packet in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if spans:
                yield True, _unpack([packet])
            else:
                waiting.append(packet)
    if waiting:
        rows = _unpack(waiting)
        waiting.clear()
        rows = rows[repeated(rows["anchor"])]
        if len(rows):
            yield False, rows


def _meet(window: int, hot_bytes: int):
    """Packets -> spans to remove (anchor null) and segments to compare (anchor set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for spans, rows in _received(batches):
            if spans:
                yield from _span_batches(rows, window)
                continue
            firsts, others = first_of_equal(rows)
            yield from _span_batches(others, window)
            anchor = firsts["anchor"]
            next_same = anchor[1:] == anchor[:-1]
            several = np.concatenate([[False], next_same]) | np.concatenate([next_same, [False]])
            compared = firsts[several]
            if len(compared):
                _, number = np.unique(compared["anchor"], return_inverse=True)
                size = np.bincount(number, compared["windows"] + np.float64(window - 1))
                yield from _span_batches(compared, window, size[number] > hot_bytes)

    return run


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of strings or binaries without nulls."""
    text = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    column = column.cast(pa.large_string() if text else pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    return np.frombuffer(data if data is not None else b"", dtype=np.uint8), offsets


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def _send_windows(window: int, buckets: int):
    """Segments of hot anchors -> packets of hashes of their single windows; what is repeated within
    one packet already rides along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            data, offsets = _bytes(batch.column(4))
            low = offsets[0]
            data, offsets = data[low : offsets[-1]], offsets - low
            count = np.diff(offsets) - (window - 1)
            piece = np.repeat(np.arange(len(count)), count)
            place = _ranges(offsets[:-1], count)
            sums = hasher.sums(data)
            found = np.zeros(len(place), dtype=SEGMENT)
            found["content"] = hasher.part(sums, place, place + window)
            anchor = batch.column(3).to_numpy().view(np.uint64)
            found["anchor"] = mix(found["content"] ^ mix(anchor)[piece])
            found["id"] = batch.column(0).to_numpy()[piece]
            found["variant"] = batch.column(1).to_numpy()[piece]
            found["start"] = batch.column(2).to_numpy()[piece]
            found["windows"] = place - offsets[piece]
            again = repeated(found["anchor"])
            if again.any():
                firsts, _ = first_of_equal(found[again])
                yield _packets(np.concatenate([found[~again], firsts]), found[again], buckets)
            elif len(found):
                yield _packets(found, found[:0], buckets)

    return run


WINDOWS = "id long, variant long, start long, inside int"
_WINDOWS = pa.schema(
    [("id", pa.int64()), ("variant", pa.int64()), ("start", pa.int64()), ("inside", pa.int32())]
)


def _meet_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packets -> windows whose hash occurs more than once: start of the segment, place in it."""
    for _, rows in _received(batches):
        for at in range(0, len(rows), 50_000):
            r = rows[at : at + 50_000]
            columns = (r["id"], r["variant"], r["start"].astype(np.int64), r["windows"].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in columns], schema=_WINDOWS
            )


class HotWindows:
    """Different windows with their earliest places; the places of the others are spans to remove."""

    def __init__(self, window: int):
        self.window = window
        self.first: dict[bytes, tuple[int, int, int]] = {}

    def add(self, i: int, variant: int, start: int, data: bytes) -> Iterator[tuple]:
        """Takes all windows of a segment; yields what is no longer first, runs as one span."""
        run = None
        for at in range(len(data) - self.window + 1):
            key, place = data[at : at + self.window], (i, variant, start + at)
            known = self.first.setdefault(key, place)
            if place < known:
                self.first[key] = place
                yield self._span(*known, known[2])
            elif place > known:
                if run and run[1] == start + at - 1:
                    run[1] += 1
                else:
                    if run:
                        yield self._span(i, variant, *run)
                    run = [start + at, start + at]
        if run:
            yield self._span(i, variant, *run)

    def _span(self, i: int, variant: int, start: int, last: int) -> tuple:
        # Dealt by the place, in want of an anchor.
        return (i, variant, start, last + self.window, i ^ start, None)

    def pieces(self) -> list[tuple]:
        """The windows held, each dealt by its bytes; none are held afterwards."""
        held, self.first = self.first, {}
        return [(*place, place[2] + self.window, _deal(key), key) for key, place in held.items()]


def _deal(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


CUT = "id long, variant long, start long, end long, anchor long, bytes binary, hot boolean"
_CUT = pa.schema([*list(_PIECES), ("hot", pa.bool_())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, variant, text, segments) -> the segments' bytes."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, variants = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        # Repeated rows are one text, and stand together: its segments are cut once.
        fresh = np.empty(len(ids), dtype=bool)
        fresh[0] = (ids[0], variants[0]) != before
        fresh[1:] = (ids[1:] != ids[:-1]) | (variants[1:] != variants[:-1])
        before = ids[-1], variants[-1]
        data, offsets = _bytes(batch.column(2))
        found = batch.column(3)
        row = np.repeat(np.arange(len(ids)), pa.compute.list_value_length(found).to_numpy())
        start, end, anchor, hot = (c.to_numpy(zero_copy_only=False) for c in found.flatten().flatten())
        kept = fresh[row]
        row, start, end, anchor, hot = (c[kept] for c in (row, start, end, anchor, hot))
        size = np.cumsum(end - start)
        low = 0
        while low < len(row):
            most = (size[low - 1] if low else 0) + CUT_BYTES
            high = max(low + 1, int(np.searchsorted(size, most, side="right")))
            r, a, b = row[low:high], start[low:high], end[low:high]
            length = b - a
            pieces = pa.BinaryArray.from_buffers(
                pa.binary(),
                len(r),
                [
                    None,
                    pa.py_buffer(np.append(0, np.cumsum(length)).astype(np.int32)),
                    pa.py_buffer(data[_ranges(offsets[r] + a, length)]),
                ],
            )
            columns = (ids[r], variants[r], a, b, anchor[low:high])
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c) for c in columns], pieces, pa.array(hot[low:high])], schema=_CUT
            )
            low = high


def _hot(window: int):
    """(id, variant, start, bytes, windows that may be repeated) -> spans to remove (without bytes) and
    the bytes of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = HotWindows(window)
        for batch in batches:
            rows = []
            for i, variant, start, data, inside in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for a, b in merged([(at, at + 1) for at in set(inside)]):
                    rows += hot.add(i, variant, start + a, data[a : b + window - 1])
                if len(hot.first) >= HOT_WINDOWS:
                    rows += hot.pieces()
                if len(rows) >= HOT_WINDOWS:
                    yield _rows(rows, _PIECES)
                    rows = []
            if rows:
                yield _rows(rows, _PIECES)
        if hot.first:
            yield _rows(hot.pieces(), _PIECES)

    return run


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
        schema=schema,
    )


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of the runs of neighbours in sorted places."""
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1] + 1]))
    return places[first], np.diff(np.append(first, len(places)))


def may_repeat(data: np.ndarray, offsets: np.ndarray, hasher: Hasher, window: int) -> np.ndarray:
    """Places of whole windows whose hash occurs more than once, sorted."""
    place = _ranges(offsets[:-1], np.maximum(np.diff(offsets) - (window - 1), 0))
    sums = hasher.sums(data)
    return place[repeated(hasher.part(sums, place, place + window))]


def repeated_windows(
    ids: np.ndarray,
    variants: np.ndarray,
    starts: np.ndarray,
    data: np.ndarray,
    offsets: np.ndarray,
    hasher: Hasher,
    window: int,
) -> tuple[np.ndarray, ...]:
    """(piece, first window, windows) of the runs of windows that also start earlier among the pieces,
    by a suffix array over all of them but what no other window can equal."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    places = may_repeat(data, offsets, hasher, window)
    if not len(places):
        return none
    # A run of windows of one piece is a part of the joined text, ended by a separator.
    first, lengths = _runs(places)
    lengths = lengths + (window - 1)
    of = np.searchsorted(offsets, first, side="right") - 1
    total = int(lengths.sum()) + len(lengths)
    goes = np.cumsum(np.append(0, lengths[:-1] + 1))
    joined = np.zeros(total, dtype=np.uint8)
    text = np.ones(total + 1, dtype=np.uint16)
    into = _ranges(goes, lengths)
    joined[into] = data[_ranges(first, lengths)]
    text[into] = joined[into].astype(np.uint16) + np.uint16(2)
    text[total] = 0
    part = np.repeat(np.arange(len(lengths)), lengths + 1)
    inside = np.arange(total) - goes[part]
    whole = inside + window <= lengths[part]
    order = suffix_array(text, 258, window)[1:]
    shared = permuted_common_prefixes(joined, order, window, whole)
    # Neighbours that share a window are one class. A place without a whole window shares none with
    # one that has: its next separator comes first.
    new_class = np.concatenate([[True], (shared[order] < window)[1:] | ~whole[order][:-1]])
    number = np.cumsum(new_class)
    sizes = np.bincount(number)
    many = (sizes[number] > 1) & whole[order]
    place, group = order[many], number[many]
    if not len(place):
        return none
    there = first[part[place]] + inside[place]
    piece = of[part[place]]
    i, variant, absolute = ids[piece], variants[piece], starts[piece] + there - offsets[piece]
    by = np.lexsort((absolute, variant, i, group))
    i, variant, absolute, group, there = (c[by] for c in (i, variant, absolute, group, there))
    # The first of each class stays, and so does a copy of its place.
    earliest = np.arange(len(group))
    earliest[1:][group[1:] == group[:-1]] = 0
    earliest = np.maximum.accumulate(earliest)
    later = (
        (i != i[earliest]) | (variant != variant[earliest]) | (absolute != absolute[earliest])
    )
    gone = np.sort(there[later])
    if not len(gone):
        return none
    gone, count = _runs(gone)
    piece = np.searchsorted(offsets, gone, side="right") - 1
    return piece, gone - offsets[piece], count


def _compare(window: int):
    """Segments sorted by anchor -> spans to remove, a suffix array at a time; spans pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, waiting, size, last = Hasher(), [], 0, None
        places = pa.schema(list(_SPANS)[:4])

        def spans():
            ids, variants, starts, data = (np.concatenate(c) for c in zip(*[w[:4] for w in waiting]))
            offsets = np.append(0, np.cumsum(np.concatenate([w[4] for w in waiting])))
            p, first, count = repeated_windows(ids, variants, starts, data, offsets, hasher, window)
            start = starts[p] + first
            columns = (ids[p], variants[p], start, start + count + (window - 1))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=places)

        for batch in batches:
            settled = batch.filter(pa.compute.is_null(batch.column(5)))
            if settled.num_rows:
                yield pa.RecordBatch.from_arrays(settled.columns[:4], schema=places)
                batch = batch.filter(pa.compute.is_valid(batch.column(5)))
            if not batch.num_rows:
                continue
            ids, variants, starts, _, anchors = (c.to_numpy() for c in batch.columns[:5])
            data, offsets = _bytes(batch.column(5))
            changes = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
            if anchors[0] != last:
                changes = np.append(0, changes)
            last, low = anchors[-1], 0
            # Cuts are made where an anchor ends, as soon as enough bytes are waiting.
            while low < len(ids):
                enough = np.searchsorted(offsets[changes], offsets[low] + max(0, ARRAY_BYTES - size))
                high = int(changes[enough]) if enough < len(changes) else len(ids)
                if high > low:
                    waiting.append(
                        (
                            ids[low:high],
                            variants[low:high],
                            starts[low:high],
                            data[offsets[low] : offsets[high]],
                            np.diff(offsets[low : high + 1]),
                        )
                    )
                    size += int(offsets[high] - offsets[low])
                if enough < len(changes):
                    yield spans()
                    waiting, size = [], 0
                low = high
        if waiting:
            yield spans()

    return run


def removed_spans(
    spark: SparkSession,
    docs: DataFrame,
    window: int = WINDOW,
    parts: int | None = None,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """(id, variant, start, end): spans of bytes to remove; they may overlap."""
    parts = parts or 2 * shuffle_partitions(spark)
    met = stored(spark, _met(docs, window, parts, hot_bytes), "segments")
    release(spark)
    pieces = stored(spark, _pieces(docs, met), "pieces")
    release(spark)
    several = met.where("hot").limit(1).count() > 0
    compared = stored(spark, _compared(pieces, window, parts, several), "repeats")
    release(spark)
    return met.where("anchor is null").select("id", "variant", "start", "end").unionAll(compared)


def _met(docs: DataFrame, window: int, parts: int, hot_bytes: int) -> DataFrame:
    """Spans to remove and segments to compare, from numbers alone."""
    packets = keyed(docs).mapInArrow(_send(window, parts), PACKETS)
    return packets.repartitionById(parts, F.col("bucket")).mapInArrow(_meet(window, hot_bytes), SPANS)


def _pieces(docs: DataFrame, met: DataFrame) -> DataFrame:
    """The bytes of the segments to compare."""
    wanted = (
        met.where("anchor is not null")
        .groupBy("id", "variant")
        .agg(F.collect_list(F.struct("start", "end", "anchor", "hot")).alias("segments"))
    )
    texts = keyed(docs).join(wanted, ["id", "variant"])
    return texts.select("id", "variant", "text", "segments").mapInArrow(_cut, CUT)


def _compared(pieces: DataFrame, window: int, parts: int, any_hot: bool) -> DataFrame:
    """Spans to remove, by suffix arrays of segments and of those windows of hot anchors that may repeat."""
    columns = [f.name for f in _PIECES]
    compared = pieces.where("not hot").select(*columns)
    if any_hot:
        hot = pieces.where("hot").select("id", "variant", "start", "anchor", "bytes")
        packets = hot.mapInArrow(_send_windows(window, parts), PACKETS)
        found = packets.repartitionById(parts, F.col("bucket")).mapInArrow(_meet_windows, WINDOWS)
        found = found.groupBy("id", "variant", "start").agg(F.collect_list("inside").alias("inside"))
        windows = hot.join(found, ["id", "variant", "start"])
        windows = windows.select("id", "variant", "start", "bytes", "inside").mapInArrow(
            _hot(window), "id long, variant long, start long, end long, anchor long, bytes binary"
        )
        compared = compared.unionAll(windows)
    return (
        compared.repartition(parts, "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_compare(window), "id long, variant long, start long, end long")
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _whole_characters(
    data: np.ndarray, ends_of_text: np.ndarray, start: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The spans without bytes of characters that they only partly cover."""
    inside = np.append(data & 0xC0 == 0x80, False)
    start, end = start.copy(), end.copy()
    while (move := (start < end) & inside[start]).any():
        start += move
    while (move := (start < end) & (end < ends_of_text) & inside[end]).any():
        end -= move
    return start, end


_SPAN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _remove(characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            sizes = np.cumsum(np.diff(_bytes(batch.column(1))[1])) if batch.num_rows else []
            while low < batch.num_rows:
                most = (sizes[low - 1] if low else 0) + CUT_BYTES
                high = max(low + 1, int(np.searchsorted(sizes, most, side="right")))
                yield _without_spans(batch.slice(low, high - low), characters)
                low = high

    return run


def _without_spans(batch: pa.RecordBatch, characters: bool) -> pa.RecordBatch:
    n = batch.num_rows
    data, offsets = _bytes(batch.column(1))
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    found = batch.column(2)
    row = np.repeat(np.arange(n), pa.compute.list_value_length(found).fill_null(0).to_numpy())
    start, end = (offsets[row] + c.to_numpy() for c in found.flatten().flatten())
    # Overlapping and touching spans of a text are one.
    by = np.lexsort((start, row))
    row, start, end = row[by], start[by], end[by]
    if len(row):
        furthest = np.maximum.accumulate(end)
        fresh = np.concatenate([[True], (start[1:] > furthest[:-1]) | (row[1:] != row[:-1])])
        begin = np.flatnonzero(fresh)
        row, start, end = row[begin], start[begin], furthest[np.append(begin[1:], len(fresh)) - 1]
    if characters:
        start, end = _whole_characters(data, offsets[row + 1], start, end)
        left = start < end
        row, start, end = row[left], start[left], end[left]
    keeps = np.ones(len(data), dtype=bool)
    keeps[_ranges(start, end - start)] = False
    removed = np.bincount(row, end - start, minlength=n).astype(np.int64)
    kept = np.append(0, np.cumsum(np.diff(offsets) - removed))
    count = np.append(0, np.cumsum(np.bincount(row, minlength=n)))
    places = [pa.array(start - offsets[row]), pa.array(end - offsets[row])]
    spans = pa.StructArray.from_arrays(places, fields=list(_SPAN_LIST.value_type))
    columns = [
        pa.array(ids := batch.column(0).to_numpy(), mask=ids == NULL_ID),
        pa.array(np.diff(offsets)),
        pa.ListArray.from_arrays(pa.array(count.astype(np.int32)), spans),
        pa.BinaryArray.from_buffers(
            pa.binary(), n, [None, pa.py_buffer(kept.astype(np.int32)), pa.py_buffer(data[keeps])]
        ),
    ]
    names = ["doc_id", "n_bytes", "spans", "kept", *batch.schema.names[3:]]
    return pa.RecordBatch.from_arrays([*columns, *batch.columns[3:]], names=names)


DEDUPLICATED = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def deduplicate(
    spark: SparkSession,
    docs: DataFrame,
    window: int = WINDOW,
    characters: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept, *keep): maximal removed spans and the remaining bytes of every row.

    With ``characters``, a character stays if only some of its bytes are repeated, so that what is left
    is valid text.
    """
    spans = removed_spans(spark, docs, window)
    by_text = spans.groupBy("id", "variant").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    others = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    joined = keyed(docs, *others).join(by_text, ["id", "variant"], "left")
    rows = joined.select("id", "text", "spans", *[f"keep_{i}" for i in range(len(keep))])
    kinds = [f", keep_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    out = rows.mapInArrow(_remove(characters), DEDUPLICATED + "".join(kinds))
    return out.toDF(*[n for n in out.columns if not n.startswith("keep_")], *keep)


def digests(deduplicated: DataFrame) -> DataFrame:
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]
    )
    return deduplicated.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
