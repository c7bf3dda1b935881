"""Packing tokenized documents into windows: non-negative least squares over length combinations.

Each task packs blocks of its own documents (about ``BLOCK_TOKENS`` tokens, so memory is bounded and
nothing is shuffled). Whole windows are cut off the front of long documents. What remains of each has
a length below the window; lengths are counted in classes of ``window / UNITS`` tokens, rounded up. All
combinations of at most ``DEPTH`` classes that fill a window are enumerated, and the repeat counts that
explain the histogram best are found by non-negative least squares. Counts are rounded down to what the
histogram holds, and sequences are built accordingly. The residual documents, which no rounded count
uses, are packed greedily: they are cut to fill the slack of the sequences built so far, then whole
windows; where the residual is too small, the last built sequences are taken apart again. What is left
at a block's end, less than a window, is cut into powers of two, lengths that need no padding.

Cases: null is the empty text, which has the end id alone; any length is possible, a long document is
cut; equal rows and equal or null ids are packed as separate documents; an empty table gives no pieces.
Other columns are not read. Sequence ids are unique, not gapless: the task's number and a running one,
the same again if a task is run again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, UNITS, DEPTH = 2048, 32, 3
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
BLOCK_TOKENS = 1 << 21

PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids of whole texts as numpy arrays.

    The tokenizer file is read by ``tokenizers`` for its vocabulary, its merges' ranks and its added
    tokens; texts are encoded by ``tiktoken`` from these, which gives the same ids (tests compare them)
    in about a fifth of the time: corpora of this kind have very many rare words, and nothing is gained
    by remembering words.
    """

    def __init__(self, path: str, pattern: str):
        self.ranks, self.added = _vocabulary(path)
        self.encoding = tiktoken.Encoding(
            path, pat_str=pattern, mergeable_ranks=self.ranks, special_tokens=self.added
        )

    def encode(self, text: str) -> np.ndarray:
        """Added tokens in the text become their ids, as the file says; the rest is encoded in between."""
        return self.encoding.encode_to_numpy(text, allowed_special="all")

    def encode_plain(self, text: str) -> np.ndarray:
        """Strings of added tokens are ordinary text."""
        return self.encoding.encode_to_numpy(text, disallowed_special=())

    def token_bytes(self) -> list[bytes]:
        """What every id spells."""
        spelled = {i: token for token, i in self.ranks.items()}
        spelled |= {i: token.encode() for token, i in self.added.items()}
        return [spelled.get(i, b"") for i in range(max(spelled) + 1)]


def _vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Bytes of every token of a byte-level vocabulary with its id, which is its rank; added tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = tokenizer.get_added_tokens_decoder()
    for token in added.values():
        if token.lstrip or token.rstrip or token.single_word:
            raise ValueError(f"{path}: added token {token.content!r} takes more than its own string")
    # The printable stand-ins of bytes, in the order in which byte-level vocabularies give them out.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in set(printable)]
    stand_in |= {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ranks = {
        bytes(map(stand_in.__getitem__, token)): i for token, i in vocabulary.items() if i not in added
    }
    return ranks, {token.content: i for i, token in added.items()}


def combinations() -> np.ndarray:
    """Combinations of at most DEPTH length classes (1..UNITS) that fill a window exactly, as counts."""
    rows = []
    for depth in range(1, DEPTH + 1):
        for c in combinations_with_replacement(range(1, UNITS + 1), depth):
            if sum(c) == UNITS:
                rows.append(np.bincount(c, minlength=UNITS + 1)[1:])
    return np.array(rows, dtype=float)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Least squares of ``a @ x = b`` with x >= 0: active sets, in the manner of Lawson and Hanson."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, dtype=bool)
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        if (best := int(np.argmax(gradient))) < 0 or gradient[best] <= 1e-9 * max(1.0, b.sum()):
            break
        active[best] = True
        while True:
            s = np.zeros(n)
            s[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (s <= 1e-12)
            if not low.any():
                x = s
                break
            gap = x[low] - s[low]
            step = np.min(np.where(gap > 0, x[low] / np.where(gap > 0, gap, 1), 0))
            x = x + step * (s - x)
            active &= x > 1e-12
            x[~active] = 0
    return x


def repeat_counts(histogram: np.ndarray, filling: np.ndarray) -> np.ndarray:
    """Whole repeat counts per combination that use no more of a class than there is."""
    counts = np.floor(nnls(filling.T, histogram.astype(float)) + 1e-6).astype(np.int64)
    left = histogram - counts @ filling.astype(np.int64)
    for i in np.argsort(-counts):  # a sum of whole parts may still exceed a class
        used = filling[i].astype(np.int64)
        while counts[i] and (left[used > 0] < 0).any():
            counts[i] -= 1
            left = left + used
    return counts


def pack_block(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) for documents of these lengths, ids counted once."""
    sequences = []
    by_class: list[deque] = [deque() for _ in range(UNITS + 1)]
    for doc, n in enumerate(lengths):
        whole = n // window * window
        sequences.extend([(doc, start, window)] for start in range(0, whole, window))
        if n > whole:
            by_class[-(-(n - whole) * UNITS // window)].append((doc, whole, n - whole))
    histogram = np.array([len(c) for c in by_class[1:]], dtype=np.int64)
    built = []
    if histogram.any():
        filling = combinations()
        counts = repeat_counts(histogram, filling)
        for count, used in zip(counts, filling.astype(int), strict=True):
            classes = [c + 1 for c in np.flatnonzero(used) for _ in range(used[c])]
            built.extend([by_class[c].popleft() for c in classes] for _ in range(count))
    residual = deque(piece for c in by_class for piece in c)
    available = sum(p[2] for p in residual)
    slack = [window - sum(p[2] for p in s) for s in built]
    missing = sum(slack)
    while built and missing > available:  # the residual can't fill it: take a sequence apart
        pieces = built.pop()
        missing -= slack.pop()
        available += sum(p[2] for p in pieces)
        residual.extend(pieces)
    for s, room in zip(built, slack, strict=True):
        s.extend(_cut(residual, room))
        sequences.append(s)
        available -= room
    while available >= window:
        sequences.append(_cut(residual, window))
        available -= window
    while available:
        part = 1 << (available.bit_length() - 1)
        sequences.append(_cut(residual, part))
        available -= part
    return sequences


def _cut(line: deque, n: int) -> list[tuple[int, int, int]]:
    """The first n ids of the line, as pieces."""
    out = []
    while n:
        doc, start, length = line.popleft()
        if length > n:
            line.appendleft((doc, start + n, length - n))
            length = n
        out.append((doc, start, length))
        n -= length
    return out


def _pack_partition(path: str, pattern: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        base, number = TaskContext.get().partitionId() << 40, 0
        end = np.array([END_ID], dtype="<u4")
        ids, texts, tokens = [], [], 0

        def flush():
            nonlocal number
            sequences = pack_block([len(t) for t in texts], window)
            rows = []
            for sequence in sequences:
                offset = 0
                for doc, start, length in sequence:
                    whole = texts[doc]
                    part = whole[start : start + length].tobytes()
                    rows.append((ids[doc], start, part, len(whole), base + number, offset))
                    offset += length
                number += 1
            for at in range(0, len(rows), 10_000):
                columns = list(zip(*rows[at : at + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
                )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(doc_id.as_py())
                texts.append(np.concatenate([encoder.encode(text.as_py() or ""), end], dtype="<u4"))
                tokens += len(texts[-1])
                if tokens >= BLOCK_TOKENS:
                    yield from flush()
                    ids, texts, tokens = [], [], 0
        if texts:
            yield from flush()

    return run


_NAMES = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    pattern: str | None = None,
    window: int = WINDOW,
) -> DataFrame:
    """One row per piece: doc_id, start, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset. ``tokenizer`` is the path of a byte-level tokenizer file that every executor has,
    ``pattern`` how it splits texts before merging."""
    if tokenizer is None or pattern is None:
        import public_tokenizers

        tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
        pattern = pattern or public_tokenizers.PATTERN
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pack_partition(tokenizer, pattern, window), PIECES
    )


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with length and check sum instead of the ids themselves."""
    return pieces.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
