import random

import numpy as np
import pyarrow as pa
import pytest

from tablecheck.llm import suffix_array as sa
from tablecheck.llm import suffix_dedup


@pytest.mark.parametrize("walked", [0, 1024])
def test_suffix_array(monkeypatch, walked):
    monkeypatch.setattr(sa, "WALKED", walked)
    rng = random.Random(walked)
    for trial in range(150):
        k = rng.randint(1, 5)
        text = [rng.randint(1, k) for _ in range(rng.randint(0, 90))]
        if trial % 3 == 0:
            text = text[:9] * 8
        text = np.array([*text, 0], dtype=np.uint16)
        expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert sa.suffix_array(text, k + 1).tolist() == expected
        shared = sa.permuted_common_prefixes(text.astype(np.uint8), np.array(expected), 20)
        for a, b in zip(expected, expected[1:]):
            same = 0
            while same < 20 and max(a, b) + same < len(text) and text[a + same] == text[b + same]:
                same += 1
            assert shared[b] == same


def brute_force(rows, window):
    """{(id, text): removed flags per byte} in order of id and text hash (ids are unique here)."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - window + 1):
            piece = data[at : at + window]
            if piece in seen:
                gone[at : at + window] = True
            seen.add(piece)
        out[i] = gone
    return out


def check(spark, rows, window):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_dedup.deduplicate(spark, frame, window).collect()
    expected = brute_force(rows, window)
    assert len(found) == len(rows)
    for r in found:
        gone = np.zeros(r.n_bytes, dtype=bool)
        for s in r.spans:
            assert s.start < s.end
            gone[s.start : s.end] = True
        assert (gone == expected[r.doc_id]).all(), r.doc_id
        data = next(t or "" for i, t in rows if i == r.doc_id).encode()
        assert bytes(r.kept) == bytes(np.frombuffer(data, np.uint8)[~gone])
        assert len(r.spans) == sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(gone)))


def test_shared_passages(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    passage = " ".join(rng.choices(words, k=60))
    rows = [(0, None), (1, ""), (2, "x" * 99)]
    for i in range(3, 60):
        text = " ".join(rng.choices(words, k=rng.randrange(5, 120)))
        if i % 3 == 0:
            cut = rng.randrange(150)
            text = text + passage[cut : cut + rng.randrange(60, 260)] + text[:50]
        rows.append((i, text))
    rows += [(70 + i, rows[10 + i][1]) for i in range(5)]
    check(spark, rows, 100)


def test_runs_nuls_and_overlaps(spark):
    rows = [(1, "a" * 500), (2, "ab" * 300), (3, "\0" * 250), (4, "b" + "a" * 130), (5, "é" * 200)]
    check(spark, rows, 100)


def test_odd_documents(spark, edge, nothing):
    found = suffix_dedup.digests(suffix_dedup.deduplicate(spark, edge)).collect()
    texts = edge.collect()
    assert len(found) == len(texts)
    repeated = {(r.n_removed, r.n_spans) for r in found if r.doc_id == 1 and r.n_bytes == 225}
    assert len(repeated) == 1  # the same row twice is one document
    assert next(r.n_removed for r in found if r.doc_id == 2) == 225
    assert next(r.n_removed for r in found if r.doc_id == 11) == 600
    assert suffix_dedup.deduplicate(spark, nothing).collect() == []


def test_whole_characters(spark):
    rows = [(1, "x" + "é" * 60), (2, "é" * 50 + "y" + "é" * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for r in suffix_dedup.deduplicate(spark, frame, characters=True).collect():
        bytes(r.kept).decode()


def check_rows(spark, rows, window=100):
    """Rows with repeated and null ids against brute force: a text is told by id and text."""
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    keys = suffix_dedup.keyed(frame).distinct().collect()
    assert len({(r.id, r.variant) for r in keys}) == len(set(rows))
    seen, expected = set(), {}
    for r in sorted(keys, key=lambda r: (r.id, r.variant)):
        data = r.text.encode()
        gone = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - window + 1):
            piece = data[at : at + window]
            if piece in seen:
                gone[at : at + window] = True
            seen.add(piece)
        doc_id = None if r.id == suffix_dedup.NULL_ID else r.id
        expected[doc_id, bytes(np.frombuffer(data, np.uint8)[~gone]), len(data)] = True
    found = suffix_dedup.deduplicate(spark, frame, window).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, bytes(r.kept), r.n_bytes) for r in found} == set(expected)


def random_text(rng, n):
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))


def test_repeated_rows_beside_a_shared_passage(spark):
    rng = random.Random(5)
    passage = random_text(rng, 400)
    one = passage + random_text(rng, 300)
    rows = [(1, one)] * 4 + [(2, passage + random_text(rng, 300)), (3, random_text(rng, 50) + passage)]
    rows += [(3, random_text(rng, 300))] * 2
    check_rows(spark, rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = suffix_dedup.deduplicate(spark, frame).where("doc_id = 1").collect()
    assert [bytes(r.kept).decode() for r in found] == [one] * 4


def test_many_texts_without_an_id(spark):
    rng = random.Random(6)
    passage = random_text(rng, 150)
    rows = [(None, random_text(rng, 130) + (passage if i % 10 == 0 else "")) for i in range(1000)]
    rows += rows[:5] + [(7, rows[3][1]), (7, rows[20][1])]
    check_rows(spark, rows)


@pytest.mark.parametrize("hot_bytes", [0, 3000])
def test_edges_of_a_passage_that_many_share(spark, monkeypatch, hot_bytes):
    monkeypatch.setattr(suffix_dedup.removed_spans, "__defaults__", (100, None, hot_bytes))
    rng = random.Random(hot_bytes)
    passage = random_text(rng, 260)
    rows = []
    for i in range(240):
        before, after = random_text(rng, rng.randrange(140)), random_text(rng, rng.randrange(140))
        # Some share a little more than the passage, on either side.
        if i % 5 == 0:
            after = "shared " * rng.randrange(1, 4) + after
        rows.append((i * 11 % 241, before + passage[rng.randrange(40) :] + after))
    rows += [(500, "a" * 400), (501, "ab" * 300), (502, "a" * 130 + "b"), (503, passage * 2)]
    check(spark, rows, 100)
    check_rows(spark, [(None if i % 3 else i, text) for i, text in rows] + rows[:9])


def test_hot_windows_hold_the_earliest_place():
    rng = random.Random(2)
    passage = random_text(rng, 60)
    segments = [(i, 0, 5 * i, random_text(rng, 6) + passage + random_text(rng, 6)) for i in range(40)]
    rng.shuffle(segments)
    hot, gone = suffix_dedup.HotWindows(50), set()
    for i, variant, start, text in segments:
        for span in hot.add(i, variant, start, text.encode()):
            gone |= {(span[0], s) for s in range(span[2], span[3] - 49)}
    first, later = {}, set()
    for i, _, start, text in sorted(segments):
        for at in range(len(text) - 49):
            if first.setdefault(text[at : at + 50], (i, start + at)) != (i, start + at):
                later.add((i, start + at))
    assert gone == later
    held = {piece[5].decode(): (piece[0], piece[2]) for piece in hot.pieces()}
    assert held == first and not hot.first


def cut_pieces(segments):
    """Batches as they come to the tasks that compare: (id, variant, start, end, anchor, bytes)."""
    i, variant, start, anchor, data = zip(*segments, strict=True)
    ends = [s + len(d) for s, d in zip(start, data, strict=True)]
    columns = [
        pa.array(c, t)
        for c, t in zip((i, variant, start, ends, anchor, data), suffix_dedup._PIECES.types, strict=True)
    ]
    return pa.RecordBatch.from_arrays(columns, schema=suffix_dedup._PIECES)


def test_windows_of_hot_anchors_that_occur_once_are_not_sent():
    rng = random.Random(3)
    line = random_text(rng, 76)
    segments = [(i, 0, 7, 1, (random_text(rng, 40) + line + random_text(rng, 40)).encode()) for i in range(300)]
    segments += [(i, 0, 400, 1, segments[i][4][:130]) for i in range(5)]
    rng.shuffle(segments)
    batch = cut_pieces(segments).select(["id", "variant", "start", "anchor", "bytes"])
    packets = suffix_dedup._send_windows(100, 4)([batch.slice(0, 170), batch.slice(170)])
    sent = pa.Table.from_batches(packets).to_batches()
    found = [r for b in suffix_dedup._meet_windows(sent) for r in b.to_pylist()]
    places = {}
    for i, _, start, _, data in segments:
        for at in range(len(data) - 99):
            places.setdefault(data[at : at + 100], []).append((i, start, at))
    expected = {p for same in places.values() if len(same) > 1 for p in same}
    assert expected and {(r["id"], r["start"], r["inside"]) for r in found} == expected
    assert len(found) < len(places) / 10


@pytest.mark.parametrize(("array_bytes", "rows"), [(1, 3), (400, 7), (1 << 20, 1000)])
def test_suffix_arrays_end_where_anchors_do(monkeypatch, array_bytes, rows):
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", array_bytes)
    rng = random.Random(array_bytes)
    segments, expected = [], set()
    for anchor in range(12):
        passage, seen = random_text(rng, 30).encode(), {}
        for _ in range(rng.randint(1, 9)):
            text = random_text(rng, 8).encode() + passage + random_text(rng, 8).encode()
            segments.append((rng.randrange(50), 0, 100 * len(segments), anchor, text))
        # A row that came twice is one place, not a repeat.
        segments.append(segments[-1])
        for i, _, start, _, data in sorted(s for s in segments if s[3] == anchor):
            for at in range(len(data) - 24):
                first = seen.setdefault(data[at : at + 25], (i, start + at))
                if first != (i, start + at):
                    expected.add((i, start + at))
    batch = cut_pieces(segments)
    found = suffix_dedup._compare(25)([batch.slice(a, rows) for a in range(0, len(segments), rows)])
    gone = {(r["id"], s) for b in found for r in b.to_pylist() for s in range(r["start"], r["end"] - 24)}
    assert gone == expected


def test_segments_are_the_same_in_any_company():
    rng = random.Random(8)
    texts = ["a" * 300, "", random_text(rng, 99), "é" * 130, random_text(rng, 100), "\0" * 150]
    texts.append(random_text(rng, 2000))
    hasher = suffix_dedup.Hasher()

    def found(texts):
        data = "".join(texts).encode()
        offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
        columns = suffix_dedup.segments(np.frombuffer(data, np.uint8), offsets, hasher, 100)
        return list(zip(*[c.tolist() for c in columns], strict=True))

    together = found(texts)
    assert together == [(i, *r[1:]) for i, t in enumerate(texts) for r in found([t])]
    for i, text in enumerate(texts):
        runs = [r[1:3] for r in together if r[0] == i]
        assert sum(n for _, n in runs) == max(0, len(text.encode()) - 99)
        assert all(a + n == b for (a, n), (b, _) in zip(runs, runs[1:]))


@pytest.mark.parametrize("characters", [False, True])
def test_spans_are_cut_out_of_many_texts_at_once(monkeypatch, characters):
    monkeypatch.setattr(suffix_dedup, "CUT_BYTES", 500)
    rng = random.Random(4)
    rows = []
    for i in range(80):
        text = "".join(rng.choices("abé😀", k=rng.randrange(90)))
        n, spans = len(text.encode()), None
        if i % 4:
            cuts = [sorted(rng.choices(range(n + 1), k=2)) for _ in range(rng.randrange(6))]
            spans = [{"start": a, "end": b} for a, b in cuts if a < b]
        rows.append((i if i % 9 else suffix_dedup.NULL_ID, text, spans, f"s{i}"))
    names = ["id", "text", "spans", "keep_0"]
    kinds = (pa.int64(), pa.string(), suffix_dedup._SPAN_LIST, pa.string())
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, names=names).slice(7)
    found = [r for b in suffix_dedup._remove(characters)([batch]) for r in b.to_pylist()]
    assert len(found) == len(rows) - 7
    for (i, text, spans, other), r in zip(rows[7:], found, strict=True):
        data = text.encode()
        merged = suffix_dedup.merged([(s["start"], s["end"]) for s in spans or ()])
        if characters:
            heads = [at for at in range(len(data)) if data[at] & 0xC0 != 0x80] + [len(data)]
            merged = [(min(h for h in heads if h >= a), max(h for h in heads if h <= b)) for a, b in merged]
            merged = [(a, b) for a, b in merged if a < b]
        left = np.ones(len(data), dtype=bool)
        for a, b in merged:
            left[a:b] = False
        doc_id = None if i == suffix_dedup.NULL_ID else i
        assert (r["doc_id"], r["n_bytes"], r["keep_0"]) == (doc_id, len(data), other)
        assert [(s["start"], s["end"]) for s in r["spans"]] == merged
        assert r["kept"] == bytes(np.frombuffer(data, np.uint8)[left])
