"""Word shingles of many texts at once, as sets of 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
#: Texts are taken together up to so many bytes; a longer one is taken alone, as a whole.
GROUP_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_groups(column: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; null is empty. The bytes are those of Arrow."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        low, high = int(offsets[first]), int(offsets[end])
        yield first, data[low:high], offsets[first : end + 1] - low
        first = end


def between_words(data: np.ndarray, step: int) -> list[int]:
    """Cuts of a text into pieces of about ``step`` bytes, each but the last at a space."""
    cuts, at = [0], step
    while at < len(data):
        space = np.flatnonzero(_SPACE[data[at : at + step]])
        if len(space):
            cuts.append(at + int(space[0]))
            at = cuts[-1]
        at += step
    return [*cuts, len(data)]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word, A-Z lower-cased, in order.

    A very long text is read piece by piece: the work needs some 60 bytes per byte of a piece.
    """
    if len(offsets) != 2 or len(data) <= 2 * GROUP_BYTES:
        return _word_hashes(data, offsets)
    cuts = between_words(data, GROUP_BYTES)
    found = [_word_hashes(data[a:b], np.array([0, b - a])) for a, b in zip(cuts, cuts[1:])]
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = _LOWER[data]
    solid = ~_SPACE[data]
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, solid[:-1]
    starts_of_text = offsets[:-1][offsets[:-1] < n]
    before[starts_of_text] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = solid[1:]
    after[starts_of_text[starts_of_text > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    powers = np.empty(n + 1, dtype=np.uint64)
    powers[0] = 1
    powers[1:] = _BASE
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    # A word's sum is moved to the place 0: times the inverse of the power at its start.
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    back = np.full(n + 1, inverse, dtype=np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    found = (sums[ends] - sums[starts]) * back[starts]
    found = mix(found ^ mix((ends - starts).astype(np.uint64)))
    return found, np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingles of k words per text; the whole sequence if there are fewer words."""
    words, of = word_hashes(data, offsets)
    n_texts = len(offsets) - 1
    first = np.searchsorted(of, np.arange(n_texts + 1))
    runs = np.zeros(max(0, len(words) - k + 1), dtype=np.uint64)
    for i in range(k):
        runs = mix(runs + words[i : i + len(runs)] * np.uint64(2 * i + 3))
    out = []
    for t in range(n_texts):
        a, b = first[t], first[t + 1]
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            whole = np.uint64(int(b - a))
            for w in words[a:b]:
                whole = mix(np.array([whole]) * np.uint64(7) + w)[0]
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
