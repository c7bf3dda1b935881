import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablecheck.llm import alignment
from tablecheck.llm.queries import op13_align

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def stand_ins():
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


STAND_INS = stand_ins()


def tokens_of(libraries, text):
    """(A, B) as lists of (id, bytes), by the libraries themselves; empty if they spell other bytes."""
    a, b = libraries
    if not text:
        return [], []
    ours = a.encode(" " + text, add_special_tokens=False)
    tokens_a = [
        (i, bytes(STAND_INS[c] for c in t)) for i, t in zip(ours.ids, ours.tokens, strict=True)
    ]
    tokens_b = [
        (i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
        for i in b.encode(text)
        for p in [b.id_to_piece(i)]
    ]
    whole = (" " + text).encode()
    if any(b"".join(t for _, t in side) != whole for side in (tokens_a, tokens_b)):
        return [], []
    return tokens_a, tokens_b


def ends(tokens):
    at, out = 0, []
    for _, spelled in tokens:
        at += len(spelled)
        out.append(at)
    return out


def groups_of(tokens_a, tokens_b):
    """Groups as (A ids, B ids), cut at every offset that is in both sets of ends."""
    ends_a, ends_b = ends(tokens_a), ends(tokens_b)
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        p, q = bisect_left(ends_a, cut) + 1, bisect_left(ends_b, cut) + 1
        groups.append(([t for t, _ in tokens_a[i:p]], [t for t, _ in tokens_b[j:q]]))
        i, j = p, q
    return groups


def expected(libraries, rows):
    tokens = [tokens_of(libraries, text) for _, text in rows]
    groups = [groups_of(*t) for t in tokens]
    counts = Counter((a[-1], b[-1]) for of in groups for a, b in of)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (doc_id, _), (a, b), of in zip(rows, tokens, groups, strict=True):
        links = [(x[-1], y[-1]) for x, y in of]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in of)
        out.append(
            (
                doc_id, len(a), len(b), len(of), len(links),
                sum(counts[link] == highest[link[1]] for link in links),
                sum(counts[link] for link in links),
                hashlib.sha256(text.encode()).hexdigest() if of else "",
            )
        )
    return out


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def as_tuples(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = op13_align(spark, SMALL)
    assert as_tuples(found) == sorted(expected(libraries, [(r[0], r[1]) for r in docs]), key=repr)


def test_odd_documents(spark, edge, nothing, libraries):
    odd = ["a▁b", " two  spaces ", "<s> x </s> <0x41>", "tab\tand\nline", "　wide", "\x1c", "中文😀" * 20]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    docs = edge.select("doc_id", "text").unionByName(more)
    rows = [(r[0], r[1]) for r in docs.collect()]
    found = alignment.link_digests(spark, edge.unionByName(more, allowMissingColumns=True))
    assert as_tuples(found) == sorted(expected(libraries, rows), key=repr)
    assert alignment.link_digests(spark, nothing).collect() == []
    assert alignment.align(nothing).collect() == []


def test_groups_are_whole(edge, libraries):
    for row in alignment.align(edge).collect():
        assert len(row.a_last) == len(row.b_last)
        if row.a_ids:
            assert row.a_last[-1] == len(row.a_ids) - 1 and row.b_last[-1] == len(row.b_ids) - 1


def test_cuts_are_all_common_ends():
    rng = random.Random(3)
    for _ in range(300):
        size = rng.randint(1, 60)
        share = rng.random()
        a = [i for i in range(1, size) if rng.random() < share] + [size]
        b = [i for i in range(1, size) if rng.random() < rng.random()] + [size]
        found = alignment.shared_cuts(np.array(a), np.array(b))
        assert [a[i] for i in found] == sorted(set(a) & set(b))


def test_stretches_change_no_id(monkeypatch, libraries):
    tokenizers, _ = alignment._loaded(alignment.Files.public())
    rng = random.Random(4)
    text = "".join(rng.choices("ab  cé\n\t.,1'中😀", k=5000)) + " word" * 500 + "x" * 300
    whole = tokenizers.encode(text)
    monkeypatch.setattr(alignment, "STRETCH", 7)
    cut = tokenizers.encode(text)
    assert len(tokenizers._stretches(text)) > 100
    assert all((x == y).all() for x, y in zip(whole, cut, strict=True))


def test_pairs_hold_all_suffixes():
    a, b = [b"a", b"ba", b"cba", b"x"], [b"a", b"cba", b"dcba", b"y"]
    pairs = alignment.Pairs(a, b)
    wanted = {
        (i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x.endswith(y) or y.endswith(x)
    }
    assert {divmod(int(c), len(b)) for c in pairs.codes} == wanted


def test_no_link_outside_the_pairs(spark):
    files = alignment.Files.public()
    _, pairs = alignment._loaded(files)
    for row in alignment.align(spark.read.parquet(f"{SMALL}/documents.parquet")).collect():
        a = np.array([row.a_ids[i] for i in row.a_last], dtype=np.int64)
        b = np.array([row.b_ids[i] for i in row.b_last], dtype=np.int64)
        assert (pairs.codes[pairs.numbers(a, b)] == a * pairs.width + b).all()


class Counting:
    """B that counts the characters it is given."""

    def __init__(self, of):
        self.of, self.chars = of, 0

    def encode(self, texts, num_threads):
        self.chars += sum(map(len, texts))
        return self.of.encode(texts, num_threads=num_threads)


def test_words_are_encoded_once(monkeypatch, libraries):
    tokenizers, _ = alignment._loaded(alignment.Files.public())
    b = Counting(tokenizers.b)
    monkeypatch.setattr(tokenizers, "b", b)
    monkeypatch.setattr(tokenizers, "_words", {}, raising=False)
    text = "such words\u3000are repeated\nover and over 中文😀"
    docs = [(i, " ".join([text] * 50)) for i in range(20)]
    batch = alignment.pa.RecordBatch.from_arrays(
        [alignment.pa.array(c) for c in zip(*docs, strict=True)], names=["doc_id", "text"]
    )
    (block,) = alignment._blocks(alignment.Files.public(), iter([batch]))
    assert b.chars <= 2 * len(text)
    assert block.b.tolist() == libraries[1].encode(docs[0][1]) * 20


def test_remembered_words_change_no_id(monkeypatch, libraries):
    tokenizers, _ = alignment._loaded(alignment.Files.public())
    monkeypatch.setattr(alignment, "WORDS", 200)
    rng = random.Random(5)
    parts = ["a", "é", "\n", "\t", "\u3000", "\u00a0", "中", "😀", "▁", "\0", "\u0301", "'s", "<s>", "1", "the", " ", "  "]
    for _ in range(300):
        texts = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(4)]
        texts += [" ".join(rng.choices(parts[:-2], k=20)) for _ in range(4)]
        tokenizers.learn(texts)
        for text in texts:
            wanted = tokens_of(libraries, text)
            found = tokenizers.encode(text)
            if not wanted[0]:
                assert found is None
            else:
                assert [ids.tolist() for ids in found] == [[i for i, _ in side] for side in wanted]
