"""Suffix arrays by induced sorting, and permuted common prefixes (numpy, inside tasks).

A suffix is smaller (S) or larger (L) than the one after it. Leftmost-S suffixes are sorted first: their
substrings by one round of inducing, then, where substrings repeat, the string of their names by the same
method (or, for the large alphabets that numpy can't walk bucket by bucket, by doubling). A second round
induces all suffixes from them in linear time. Inducing goes bucket by bucket, but within a bucket all
suffixes that are known move their predecessors at once.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are walked bucket by bucket.
WALKED = 1024


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes. The last symbol must be the unique smallest."""
    n = len(text)
    rises = np.empty(n, dtype=np.int8)
    rises[:-1] = np.sign(np.diff(text.astype(np.int64)))
    rises[-1] = 1
    # A run of equal symbols has the type of its last one.
    decided = np.where(rises != 0, np.arange(n), n)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    return rises[decided] > 0


def induce(text: np.ndarray, small: np.ndarray, k: int, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes sorted, given the leftmost-S ones in their order (or in any order, which then sorts
    the substrings up to the next leftmost-S place)."""
    n = len(text)
    counts = np.bincount(text, minlength=k)
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.zeros(n, dtype=np.int32)
    symbols = text[leftmost]
    order = np.argsort(symbols, kind="stable")
    leftmost, symbols = leftmost[order], symbols[order]
    seeds = np.bincount(symbols, minlength=k)
    seeded = ends - seeds
    out[seeded[symbols] + np.arange(len(symbols)) - (np.cumsum(seeds) - seeds)[symbols]] = leftmost

    def grouped(before):
        """Stable groups by symbol: (suffixes, symbols of groups, sizes, place in the group)."""
        symbols = text[before]
        order = np.argsort(symbols, kind="stable")
        symbols = symbols[order]
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        sizes = np.diff(np.append(first, len(symbols)))
        return before[order], symbols[first], sizes, np.arange(len(symbols)) - np.repeat(first, sizes)

    heads = starts.copy()

    def push_large(suffixes):
        before = suffixes[suffixes > 0] - 1
        before = before[~small[before]]
        if len(before):
            moved, groups, sizes, place = grouped(before)
            out[np.repeat(heads[groups], sizes) + place] = moved
            heads[groups] += sizes

    for c in np.flatnonzero(counts).tolist():
        at = starts[c]
        while at < heads[c]:
            end = heads[c]
            push_large(out[at:end])
            at = end
        if seeds[c]:
            push_large(out[seeded[c] : ends[c]])

    tails = ends.copy()
    last = text[n - 1]
    out[tails[last] - 1] = n - 1
    tails[last] -= 1

    def push_small(suffixes):
        before = suffixes[suffixes > 0] - 1
        before = before[small[before]]
        if len(before):
            moved, groups, sizes, place = grouped(before)
            out[np.repeat(tails[groups] - 1, sizes) - place] = moved
            tails[groups] -= sizes

    for c in np.flatnonzero(counts)[::-1].tolist():
        at = ends[c]
        while at > tails[c]:
            end = tails[c]
            push_small(out[end:at][::-1])
            at = end
        if heads[c] > starts[c]:
            push_small(out[starts[c] : heads[c]][::-1])
    return out


def suffix_array(text: np.ndarray, k: int, depth: int | None = None) -> np.ndarray:
    """Suffixes of ``text`` (symbols below ``k``, the last one 0 and nowhere else) in order.

    With ``depth``, suffixes that agree in their first ``depth`` symbols may stand in any order.
    """
    n = len(text)
    small = suffix_types(text)
    is_leftmost = np.zeros(n, dtype=bool)
    is_leftmost[1:] = small[1:] & ~small[:-1]
    leftmost = np.flatnonzero(is_leftmost).astype(np.int32)
    if len(leftmost) > 1:
        found = induce(text, small, k, leftmost)
        ordered = found[is_leftmost[found]]
        names, distinct = _names(text, leftmost, ordered)
        if distinct < len(leftmost):
            if distinct <= WALKED:
                rank = suffix_array(names, distinct, depth and depth // 2 + 1)
            else:
                rank = _by_doubling(names, depth)
            ordered = leftmost[rank]
        leftmost = ordered
    return induce(text, small, k, leftmost)


def _names(text: np.ndarray, leftmost: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """The string of names of the leftmost-S substrings in text order, and how many names there are."""
    n = len(text)
    following = np.full(n, n - 1, dtype=np.int64)
    following[leftmost[:-1]] = leftmost[1:]
    a, b = ordered[:-1].astype(np.int64), ordered[1:].astype(np.int64)
    length_a, length_b = following[a] - a, following[b] - b
    same = length_a == length_b
    active = np.flatnonzero(same)
    step = 0
    while len(active):  # compare symbol by symbol, as far as both go
        differ = text[a[active] + step] != text[b[active] + step]
        same[active[differ]] = False
        active = active[~differ & (length_a[active] > step)]
        step += 1
    name = np.concatenate([[0], np.cumsum(~same)])
    by_place = np.empty(n, dtype=np.int32)
    by_place[ordered] = name
    return by_place[leftmost], int(name[-1]) + 1


def _by_doubling(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Suffixes of the reduced string in order. Names stand for at least two symbols each."""
    rank, n, width = names.astype(np.int64), len(names), 1
    while True:
        following = np.zeros(n, dtype=np.int64)
        following[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        width *= 2
        if fresh[-1] == n - 1 or width >= n or depth is not None and 2 * width >= depth + 2:
            return order


def permuted_common_prefixes(
    data: np.ndarray, order: np.ndarray, most: int, asked: np.ndarray | None = None
) -> np.ndarray:
    """For each place of ``data`` (bytes), how many bytes it shares with the suffix before it in
    ``order``, counted up to ``most``; 0 where a place or the one before it is not ``asked`` for."""
    n = len(data)
    words = np.zeros(n + most + 16, dtype=np.uint64)
    padded = np.concatenate([data, np.zeros(most + 24, dtype=np.uint8)])
    for i in range(8):
        words |= padded[i : i + len(words)].astype(np.uint64) << np.uint64(8 * i)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, dtype=np.int32)
    active = np.flatnonzero(before >= 0)
    if asked is not None:
        active = active[asked[active] & asked[before[active]]]
    step = 0
    while len(active) and step < most:
        x = words[active + step] ^ words[before[active] + step]
        low = x & (~x + np.uint64(1))  # the lowest bit that differs tells the byte
        equal = np.where(x == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3)
        shared[active] += equal.astype(np.int32)
        active = active[x == 0]
        step += 8
    return np.minimum(shared, most)
