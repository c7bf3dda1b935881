import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablecheck.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer(tokenizer):
    rng = random.Random(5)
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    alphabets = (" \n\tab'1,é\x1c　s", "中文1½Ⅷ_'ʼ𝔸😀‍́ ", "'sreEvml d", "aeiou bcd.,")
    texts = ["", " ", "<|endoftext|> x", "a  b\n\n c ", "a <|endoftext|> b", "a  <|endoftext|>  ", "<|endoftext"]
    texts += ["<|endoftext|>" * 3, "l'<|endoftext|>'re <|endoftext|>\n\n"]
    texts += ["".join(rng.choices(a, k=rng.randint(1, 20))) for a in alphabets for _ in range(2000)]
    texts += ["".join(chr(rng.randrange(1, 0xD800)) for _ in range(8)) for _ in range(2000)]
    expected = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [encoder.encode(t).tolist() for t in texts] == [e.ids for e in expected]
    assert encoder.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


def test_ids_of_plain_text():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    for text in ("<|endoftext|> x", "a <|endoftext|> b", "plain"):
        assert encoder.encode_plain(text).tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 2, 60, 4000])
def test_no_id_is_lost_and_nothing_is_padded(n):
    rng = random.Random(n)
    lengths = [int(rng.paretovariate(0.9) * 60) % 9000 + 1 for _ in range(n)]
    seen = defaultdict(list)
    for sequence in packing.pack_block(lengths):
        used = sum(p[2] for p in sequence)
        assert used == packing.WINDOW or used & (used - 1) == 0
        for doc, start, length in sequence:
            seen[doc].append((start, length))
    for doc, total in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[doc]):
            assert start == at and length > 0
            at += length
        assert at == total


def test_nnls_meets_its_conditions():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.random(12)
        x = packing.nnls(a, b)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and (gradient <= 1e-6).all() and abs(gradient[x > 0]).max() < 1e-6


def test_counts_use_no_more_than_there_is():
    rng = np.random.default_rng(4)
    filling = packing.combinations()
    for _ in range(20):
        histogram = rng.integers(0, 40, packing.UNITS)
        counts = packing.repeat_counts(histogram, filling)
        assert (counts >= 0).all() and (counts @ filling <= histogram).all()


def test_odd_documents(edge, nothing, tokenizer):
    rows = packing.pack(edge).collect()
    by_row = sum(len(r.ids) // 4 for r in rows)
    texts = [r.text or "" for r in edge.collect()]
    assert by_row == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, len(r.ids) // 4))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    assert packing.digests(packing.pack(nothing)).collect() == []
