"""Cross-tokenizer alignment: divide and conquer at shared cuts.

A text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B). Both token sequences
spell the same bytes, so an alignment is given by the byte offsets where tokens of both end. They are
found by divide and conquer: near the middle of an interval of A tokens, the first common end is located
by going from A's end to B's next and from there to A's next in turn, both looked up for all ends
beforehand; both halves are searched likewise, and an interval without a common end is left as one group.
All intervals of one depth, over a block of documents, are searched together as arrays.

An A and a B token whose byte ranges end together are linked. The bytes of one are then a suffix of the
other's, so the pairs of ids that can ever be linked are a fixed set given by the two vocabularies
(``Pairs``), whatever the corpus: counts over the corpus are one array of that size, which is what is
collected and broadcast.

Cases: a text that is null, empty or that B does not spell byte for byte (it has U+2581, say) has no
tokens: zeros and an empty string. Strings of special tokens are ordinary text. Very long texts are
encoded in stretches, cut at single spaces between words, where neither vocabulary has a token that
reaches across. B's ids of words, of which few are rare, are remembered up to a bound. Equal rows and equal or null ids are documents of their own; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm.common import stored
from tablecheck.llm.packing import TOKENIZER, Encoder

PIECES = "piece_bpe_32k.model"

#: Characters of a document that are encoded at once, and of a block that is aligned at once.
STRETCH, BLOCK = 1 << 16, 1 << 20
#: What is remembered of B's words: characters, and as many more for every word as it costs besides.
WORDS, WORD_COST = 1 << 23, 16

_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"

ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_last array<int>, b_last array<int>"
_LINKED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
)


@dataclass(frozen=True)
class Files:
    """Paths, on every executor, of the two tokenizers, and how A splits texts before merging."""

    a: str
    b: str
    pattern: str

    @classmethod
    def public(cls) -> Files:
        import public_tokenizers

        return cls(
            public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES), public_tokenizers.PATTERN
        )


class Tokenizers:
    """Ids of a text by both, and the bytes of every id."""

    def __init__(self, files: Files):
        import sentencepiece

        self.a = Encoder(files.a, files.pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a = self.a.token_bytes()
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(t) for t in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(t) for t in self.bytes_b], dtype=np.int64)
        # No piece goes on after a space inside: then stretches may be encoded one by one.
        self.cuttable = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self._words: dict[str, bytes] = {}
        self._words_size = 0

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by A of space and text and by B of the text, or None unless both spell the same bytes."""
        stretches = self._stretches(text)
        ids_a = np.concatenate([self.a.encode_plain(" " + s) for s in stretches]).astype(np.int64)
        whole = (" " + text).encode()
        # A's tokens are cut out of the text one after the other: they spell it if none is missing.
        if self.sizes_a[ids_a].sum() != len(whole):
            return None
        ids_b = self._by_words(text)
        if ids_b is not None:
            return ids_a, ids_b
        by_stretch = self.b.encode(stretches, num_threads=1)
        if b"".join(self._spelled_by_b(ids) for ids in by_stretch) != whole:
            return None
        return ids_a, np.concatenate([np.array(ids, dtype=np.int64) for ids in by_stretch])

    def learn(self, texts: Iterable[str]) -> None:
        """Encode by B, all at once, the words of these texts that are not remembered yet.

        Words that are not spelled byte for byte are not kept.
        """
        words = set()
        for text in texts:
            if self._has_words(text):
                words.update(text.split(" "))
        if self._words_size > WORDS:
            self._words.clear()
            self._words_size = 0
        new = list(words.difference(self._words))
        by_word = self.b.encode(new, num_threads=1)
        if self._spelled_by_b(chain.from_iterable(by_word)) != " ".join(["", *new]).encode():
            spelled = [self._spelled_by_b(ids) == (" " + word).encode() for word, ids in zip(new, by_word)]
            new, by_word = list(compress(new, spelled)), list(compress(by_word, spelled))
        flat = array("i", chain.from_iterable(by_word)).tobytes()
        at = 0
        for word, ids in zip(new, by_word, strict=True):
            to = at + 4 * len(ids)
            self._words[word] = flat[at:to]
            at = to
        self._words_size += sum(map(len, new)) + WORD_COST * len(new)

    def _has_words(self, text: str) -> bool:
        """Spaces neither meet, which B joins, nor stand at an end: no piece reaches from before a space
        to behind it."""
        return self.cuttable and "  " not in text and text[0] != " " and text[-1] != " "

    def _by_words(self, text: str) -> np.ndarray | None:
        """Ids by B, if it can be put together from words that are remembered."""
        if not self._has_words(text):
            return None
        try:
            ids = b"".join(map(self._words.__getitem__, text.split(" ")))
        except KeyError:
            return None
        return np.frombuffer(ids, np.int32).astype(np.int64)

    def _spelled_by_b(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_b.__getitem__, ids))

    def _stretches(self, text: str) -> list[str]:
        out, at = [], 0
        while self.cuttable and len(text) - at > STRETCH:
            space = _BETWEEN_WORDS.search(text, at + STRETCH)
            if space is None:
                break
            out.append(text[at : space.start()])
            at = space.end()  # each stretch gets a space in front from the tokenizer
        out.append(text[at:])
        return out


class Pairs:
    """All pairs of ids of which one's bytes are a suffix of the other's, numbered from 0."""

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]):
        by_bytes_a, by_bytes_b = _places(bytes_a), _places(bytes_b)
        codes = set()
        for a, token in enumerate(bytes_a):
            for at in range(len(token)):
                codes.update((a, b) for b in by_bytes_b.get(token[at:], ()))
        for b, token in enumerate(bytes_b):
            for at in range(1, len(token)):
                codes.update((a, b) for a in by_bytes_a.get(token[at:], ()))
        self.width = len(bytes_b)
        self.codes = np.sort(np.array([a * self.width + b for a, b in codes], dtype=np.int64))
        self.b = self.codes % self.width

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.codes, a * self.width + b).astype("<u4")

    def __len__(self) -> int:
        return len(self.codes)


def _places(tokens: list[bytes]) -> dict[bytes, list[int]]:
    places = defaultdict(list)
    for i, token in enumerate(tokens):
        places[token].append(i)
    return places


@lru_cache(maxsize=2)
def _loaded(files: Files) -> tuple[Tokenizers, Pairs]:
    """Once per Python worker."""
    tokenizers = Tokenizers(files)
    return tokenizers, Pairs(tokenizers.bytes_a, tokenizers.bytes_b)


def shared_cuts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in ``a`` of all ends that ``b`` has too; both ascend strictly and end alike."""
    found = [np.array([len(a) - 1], dtype=np.int64)]
    low, high = np.array([0], dtype=np.int64), np.array([len(a) - 1], dtype=np.int64)
    # B's next end from each of A's, whether it is the same, and A's next end from there.
    next_b = np.searchsorted(b, a)
    same = b[next_b] == a
    onward = np.searchsorted(a, b)[next_b]
    while True:
        open_ = low < high
        low, high = low[open_], high[open_]
        if not len(low):
            return np.sort(np.concatenate(found))
        middle = (low + high) // 2
        cut = middle.copy()
        searching = np.arange(len(cut))
        while len(searching):
            # Equal, or further to the right.
            ends = cut[searching]
            cut[searching] = onward[ends]
            searching = searching[~same[ends] & (cut[searching] < high[searching])]
        hit = cut < high
        found.append(cut[hit])
        low, high = (
            np.concatenate([low, cut[hit] + 1]),
            np.concatenate([middle, high[hit]]),
        )


@dataclass
class _Block:
    """Documents aligned together; ends count on over all of them."""

    doc_ids: list
    has_tokens: np.ndarray  # per document
    a: np.ndarray
    b: np.ndarray
    a_last: np.ndarray  # place of the last A token of each group
    b_last: np.ndarray
    a_to: np.ndarray  # per document with tokens: places where its tokens and groups end
    b_to: np.ndarray
    groups_to: np.ndarray


def _blocks(files: Files, batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    tokenizers, _ = _loaded(files)
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            doc_ids.append(doc_id.as_py())
            texts.append(text)
            size += len(text or "")
            if size >= BLOCK:
                yield _aligned(tokenizers, doc_ids, texts)
                doc_ids, texts, size = [], [], 0
    if doc_ids:
        yield _aligned(tokenizers, doc_ids, texts)


def _aligned(tokenizers: Tokenizers, doc_ids: list, texts: list[str | None]) -> _Block:
    tokenizers.learn(text for text in texts if text)
    encoded = [tokenizers.encode(text) if text else None for text in texts]
    has_tokens = np.array([e is not None for e in encoded])
    none = np.empty(0, dtype=np.int64)
    some = [e for e in encoded if e is not None]
    if not some:
        return _Block(doc_ids, has_tokens, none, none, none, none, none, none, none)
    a, b = (np.concatenate([e[side] for e in some]) for side in (0, 1))
    ends_a, ends_b = np.cumsum(tokenizers.sizes_a[a]), np.cumsum(tokenizers.sizes_b[b])
    a_last = shared_cuts(ends_a, ends_b)
    b_last = np.searchsorted(ends_b, ends_a[a_last])
    a_to, b_to = (np.cumsum([len(e[side]) for e in some]) for side in (0, 1))
    groups_to = np.searchsorted(a_last, a_to - 1) + 1
    return _Block(doc_ids, has_tokens, a, b, a_last, b_last, a_to, b_to, groups_to)


def _from(to: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], to[:-1]])


def _align_partition(files: Files):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(files, batches):
            rows, doc = [], 0
            a_from, b_from, g_from = _from(block.a_to), _from(block.b_to), _from(block.groups_to)
            for doc_id, has_tokens in zip(block.doc_ids, block.has_tokens, strict=True):
                if not has_tokens:
                    rows.append((doc_id, [], [], [], []))
                    continue
                groups = slice(g_from[doc], block.groups_to[doc])
                rows.append(
                    (
                        doc_id,
                        block.a[a_from[doc] : block.a_to[doc]],
                        block.b[b_from[doc] : block.b_to[doc]],
                        block.a_last[groups] - a_from[doc],
                        block.b_last[groups] - b_from[doc],
                    )
                )
                doc += 1
            yield _batch(rows, ["doc_id", "a_ids", "b_ids", "a_last", "b_last"],
                         [pa.int64()] + [pa.list_(pa.int32())] * 4)

    return run


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def align(docs: DataFrame, files: Files | None = None) -> DataFrame:
    """doc_id, ids by both tokenizers, and the places (from 0) of the last A and B token of each group.

    No shuffle: every task aligns its own documents.
    """
    return _rows(docs).mapInArrow(_align_partition(files or Files.public()), ALIGNED)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


# --- links and their counts over the corpus ---


@lru_cache(maxsize=2)
def _spelled(n_a: int, n_b: int) -> list[bytes]:
    """Decimal ids with what follows them: A then ``,`` or ``|``, B then ``,`` or ``;``."""
    spelled = [b"%d%c" % (i, mark) for i in range(n_a) for mark in b",|"]
    return spelled + [b"%d%c" % (i, mark) for i in range(n_b) for mark in b",;"]


def _groups_text(block: _Block, tokenizers: Tokenizers) -> list[bytes]:
    """The groups of all documents in order as text, token by token."""
    n_a, n_b = len(block.a), len(block.b)
    groups = np.arange(len(block.a_last))
    group_a = np.repeat(groups, np.diff(block.a_last, prepend=-1))
    group_b = np.repeat(groups, np.diff(block.b_last, prepend=-1))
    last_a, last_b = np.zeros(n_a, dtype=np.int64), np.zeros(n_b, dtype=np.int64)
    last_a[block.a_last], last_b[block.b_last] = 1, 1
    codes = np.empty(n_a + n_b, dtype=np.int64)
    before = np.concatenate([[0], block.b_last + 1])  # B tokens of the groups before
    codes[np.arange(n_a) + before[group_a]] = 2 * block.a + last_a
    codes[np.arange(n_b) + block.a_last[group_b] + 1] = 2 * (len(tokenizers.bytes_a) + block.b) + last_b
    spelled = _spelled(len(tokenizers.bytes_a), len(tokenizers.bytes_b))
    return [spelled[c] for c in codes.tolist()]


def _link_partition(files: Files):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
    types = [pa.int64()] * 5 + [pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, pairs = _loaded(files)
        for block in _blocks(files, batches):
            rows, doc = [], 0
            links = pairs.numbers(block.a[block.a_last], block.b[block.b_last])
            text = _groups_text(block, tokenizers)
            a_from, b_from, g_from = _from(block.a_to), _from(block.b_to), _from(block.groups_to)
            for doc_id, has_tokens in zip(block.doc_ids, block.has_tokens, strict=True):
                if not has_tokens:
                    rows.append((doc_id, 0, 0, 0, 0, "", b""))
                    continue
                tokens = slice(a_from[doc] + b_from[doc], block.a_to[doc] + block.b_to[doc])
                digest = hashlib.sha256(b"".join(text[tokens])[:-1]).hexdigest()
                own = links[g_from[doc] : block.groups_to[doc]]
                rows.append(
                    (
                        doc_id,
                        int(block.a_to[doc] - a_from[doc]),
                        int(block.b_to[doc] - b_from[doc]),
                        len(own),
                        len(own),
                        digest,
                        own.tobytes(),
                    )
                )
                doc += 1
            yield _batch(rows, names, types)

    return run


def _count_partition(n_pairs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_pairs, dtype=np.int64)
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), dtype="<u4") for x in batch.column(0)]
            if own:
                counts += np.bincount(np.concatenate(own), minlength=n_pairs)
        some = np.flatnonzero(counts)
        for at in range(0, len(some), 10_000):
            part = some[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(counts[part])], names=["pair", "n"]
            )

    return run


def _weigh_partition(counts, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = counts.value
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), dtype="<u4") for x in batch.column("links")]
            columns = [batch.column(name) for name in names]
            columns.append(pa.array([int(best[x].sum()) for x in own], pa.int64()))
            columns.append(pa.array([int(n[x].sum()) for x in own], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_best", "count_sum"])

    return run


def link_counts(spark: SparkSession, linked: DataFrame, files: Files) -> tuple[np.ndarray, np.ndarray]:
    """For every possible pair of ids: its links in the corpus, and whether no other A id is linked
    more often to its B id. Two arrays of a length that the vocabularies give, not the corpus."""
    _, pairs = _loaded(files)
    partial = linked.select("links").mapInArrow(_count_partition(len(pairs)), "pair int, n long")
    total = partial.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(len(pairs), dtype=np.int64)
    n[total["pair"].to_numpy()] = total["n"].to_numpy()
    highest = np.zeros(pairs.width, dtype=np.int64)
    np.maximum.at(highest, pairs.b, n)
    return n, (n == highest[pairs.b]) & (n > 0)


def link_digests(spark: SparkSession, docs: DataFrame, files: Files | None = None) -> DataFrame:
    """Per document: numbers of tokens, groups and links, a digest of its groups, and its links weighed
    by the counts of their pairs over the whole corpus.

    Texts are encoded once; the links, numbered pairs, are written to the shared folder and read twice.
    """
    files = files or Files.public()
    linked = stored(spark, _rows(docs).mapInArrow(_link_partition(files), _LINKED), "links")
    counts = spark.sparkContext.broadcast(link_counts(spark, linked, files))
    names = [name for name in linked.columns if name != "links"]
    schema = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in linked.schema if f.name != "links"
    )
    return linked.mapInArrow(_weigh_partition(counts, names), f"{schema}, n_best long, count_sum long")
