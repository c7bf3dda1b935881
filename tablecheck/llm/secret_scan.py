"""Secret scans: base rules, and a character convolutional network over every other candidate.

Base rules are three patterns (assignments of a password or token, access keys, hex strings); what they
find stays. A candidate is a maximal run of the characters of keys, without dots at its ends, that is
long enough and holds a letter and a digit (``candidates``). The network, written in numpy, sees a
candidate's characters and those around it: character classes are embedded, a convolution looks at every
stretch of ``WIDTH`` characters, its strongest answers inside the candidate, before and behind it and its
mean answer inside are fed to one hidden layer, and a logistic output is calibrated on findings held out
from training. The threshold is the highest that still recalls ``RECALL`` of the held-out labelled
secrets. A candidate at or above it, unless it touches what a base rule found, is a further span of the
kind ``model``.

Labelled findings come from a bounded sample of the documents (about ``SAMPLE_DOCS``, by hash, with at most
``SAMPLE_FINDINGS`` of either label): what the base rules find is a secret if its value is assigned or is
an access key; other candidates are none. To these, ``MADE_FINDINGS`` are made: values in the shapes of
well-known keys, put into the contexts of sampled documents behind a word that names them or behind
none, and look-alikes that are none (identifiers, versions, paths, dates, camel case), of words of the
corpus and of made words.

Spans are whole matches in code points, ends exclusive. A text is scanned in one go whatever its length.

Cases: null and empty texts have no spans; equal rows, equal and null ids are documents of their own; a
table without any candidates still has the made findings to learn from; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import base64
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Base rules: fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "model")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16

#: A candidate has at least so many characters of keys.
CANDIDATE_LENGTH = 16
_RUN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{CANDIDATE_LENGTH},}}")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
#: The hex rule's matches that are long enough.
_HEX_RUN = re.compile(rf"[0-9a-f]{{{HEX_LENGTH},}}")

#: Characters that the network sees of a candidate (its first and last half of them) and on either side.
INSIDE, AROUND = 48, 24
WIDTH, EMBEDDED, FILTERS, HIDDEN = 5, 8, 24, 16
CLASSES = 72
RECALL = 0.99
#: Documents of the sample, findings of either label among them at most, and made findings.
SAMPLE_DOCS, SAMPLE_FINDINGS, MADE_FINDINGS = 20_000, 2000, 10_000
#: Candidates that are scored at once.
SCORED = 512


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str


def base_spans(text: str) -> list[Span]:
    """What the base rules find, by start, then kind as listed."""
    found = [
        Span(m.start(), m.end(), "assign")
        for m in ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= ASSIGN_LENGTH
    ]
    found += [
        Span(m.start(), m.end(), "access")
        for m in ACCESS.finditer(text)
        if m.end() - m.start() >= ACCESS_LENGTH
    ]
    found += [Span(m.start(), m.end(), "hex") for m in _HEX_RUN.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def candidates(text: str) -> Iterator[tuple[int, int]]:
    for m in _RUN.finditer(text):
        run = m.group()
        end = m.start() + len(run.rstrip("."))
        start = m.end() - len(run.lstrip("."))
        if end - start >= CANDIDATE_LENGTH and _DIGIT.search(run) and _LETTER.search(run):
            yield start, end


def untouched(found: list[tuple[int, int]], spans: list[Span]) -> list[tuple[int, int]]:
    """The candidates that no span touches; both ascend by start."""
    out, at, reach = [], 0, 0
    for start, end in found:
        while at < len(spans) and spans[at].start < end:
            reach = max(reach, spans[at].end)
            at += 1
        if reach <= start:
            out.append((start, end))
    return out


# --- what the network sees ---


def _class_table() -> np.ndarray:
    """ASCII characters to classes: small and capital letters, digits, marks of keys, white space, others.

    0 is beyond the text or the window, 1 any character above ASCII.
    """
    table = np.full(128, 2, dtype=np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 3
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        table[ord(c)] = 4 + i
        table[ord(c.upper())] = 30 + i
    for c in "01234567":
        table[ord(c)] = 56
    for c in "89":
        table[ord(c)] = 57
    for i, c in enumerate("+/_.=-:\"'<>@%#"):
        table[ord(c)] = 58 + i
    return table


_TABLE = _class_table()
#: Places of the three parts of a window: before, inside, behind.
PARTS = ((0, AROUND), (AROUND, AROUND + INSIDE), (AROUND + INSIDE, 2 * AROUND + INSIDE))
WINDOW = 2 * AROUND + INSIDE


def window(text: str, start: int, end: int) -> np.ndarray:
    """Classes of the characters in and around a candidate; of a long one both ends."""
    out = np.zeros(WINDOW, dtype=np.uint8)
    before = text[max(0, start - AROUND) : start]
    inside = text[start:end]
    if len(inside) > INSIDE:
        inside = inside[: INSIDE // 2] + inside[-(INSIDE // 2) :]
    behind = text[end : end + AROUND]
    for part, at in ((before, AROUND - len(before)), (inside, AROUND), (behind, AROUND + INSIDE)):
        codes = np.frombuffer(part.encode("utf-32-le", "replace"), dtype="<u4")
        out[at : at + len(codes)] = np.where(codes < 128, _TABLE[np.minimum(codes, 127)], 1)
    return out


# --- the network ---


class Network:
    """Embedding, one convolution, maxima over three parts and a mean, a hidden layer, calibrated output."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (CLASSES, EMBEDDED)),
            "conv": rng.normal(0, (2 / (WIDTH * EMBEDDED)) ** 0.5, (WIDTH * EMBEDDED, FILTERS)),
            "conv_bias": np.zeros(FILTERS),
            "hidden": rng.normal(0, (1 / (2 * FILTERS)) ** 0.5, (4 * FILTERS, HIDDEN)),
            "hidden_bias": np.zeros(HIDDEN),
            "out": rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN),
            "out_bias": np.zeros(1),
        }
        self.p = {name: value.astype(np.float32) for name, value in self.p.items()}
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, windows: np.ndarray) -> tuple:
        p, n = self.p, len(windows)
        padded = np.pad(windows, ((0, 0), (WIDTH // 2, WIDTH // 2)))
        places = np.arange(WINDOW)[:, None] + np.arange(WIDTH)
        seen = padded[:, places]  # classes under the filter at every place
        stretches = p["embed"][seen].reshape(n, WINDOW, WIDTH * EMBEDDED)
        answers = np.maximum(stretches @ p["conv"] + p["conv_bias"], 0)
        best = [answers[:, a:b].argmax(axis=1) + a for a, b in PARTS]
        strongest = [np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0] for at in best]
        # How much each place counts for the mean inside: none beyond a short candidate's end.
        share = np.zeros(windows.shape, dtype=np.float32)
        share[:, AROUND : AROUND + INSIDE] = windows[:, AROUND : AROUND + INSIDE] != 0
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1)
        pooled = np.concatenate([*strongest, np.einsum("np,npf->nf", share, answers)], axis=1)
        hidden = np.maximum(pooled @ p["hidden"] + p["hidden_bias"], 0)
        return hidden @ p["out"] + p["out_bias"][0], hidden, pooled, answers, best, share, stretches, seen

    def logits(self, windows: np.ndarray) -> np.ndarray:
        if not len(windows):
            return np.zeros(0)
        parts = [self._forward(windows[i : i + SCORED])[0] for i in range(0, len(windows), SCORED)]
        return np.concatenate(parts).astype(np.float64)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return _logistic(self.scale * self.logits(windows) + self.shift)

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(windows)
        logits, hidden, pooled, answers, best, share, stretches, seen = self._forward(windows)
        error = (_logistic(logits) - labels).astype(pooled.dtype) / n
        g = {"out": hidden.T @ error, "out_bias": error.sum(keepdims=True)}
        back = np.outer(error, p["out"]) * (hidden > 0)
        g["hidden"], g["hidden_bias"] = pooled.T @ back, back.sum(axis=0)
        *parts, mean = np.split(back @ p["hidden"].T, len(PARTS) + 1, axis=1)
        # An error reaches the strongest answers, and all inside by their share in the mean.
        to_answers = share[:, :, None] * mean[:, None, :]
        for own, at in zip(parts, best, strict=True):
            now = np.take_along_axis(to_answers, at[:, None, :], axis=1)
            np.put_along_axis(to_answers, at[:, None, :], now + own[:, None, :], axis=1)
        to_answers = (to_answers * (answers > 0)).reshape(n * WINDOW, FILTERS)
        g["conv"] = stretches.reshape(n * WINDOW, -1).T @ to_answers
        g["conv_bias"] = to_answers.sum(axis=0)
        to_embed = (to_answers @ p["conv"].T).reshape(-1, EMBEDDED)
        g["embed"] = np.stack(
            [np.bincount(seen.ravel(), to_embed[:, i], CLASSES) for i in range(EMBEDDED)], axis=1
        )
        return g

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 8, batch: int = 64) -> None:
        """Adam on the logistic loss, in a fixed order of batches."""
        rng = np.random.default_rng(3)
        first = {name: np.zeros_like(v) for name, v in self.p.items()}
        second = {name: np.zeros_like(v) for name, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            rate = 4e-3 * 0.7**epoch
            order = rng.permutation(len(windows))
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                step += 1
                for name, g in self._gradients(windows[part], labels[part]).items():
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.001 * (g * g - second[name])
                    moved = first[name] / (1 - 0.9**step)
                    self.p[name] -= rate * moved / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, windows: np.ndarray, labels: np.ndarray, recall: float = RECALL) -> None:
        """Scale and shift of the output by logistic regression on held-out findings, then the highest
        threshold, at most 0.5, that recalls so many of the secrets among them."""
        x = self.logits(windows)
        a, b = 1.0, 0.0
        target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / (np.sum(labels == 0) + 2))
        for _ in range(50):
            q = _logistic(a * x + b)
            weight = np.maximum(q * (1 - q), 1e-9)
            gradient = np.array([((q - target) * x).sum(), (q - target).sum()])
            curve = np.array([[(weight * x * x).sum(), (weight * x).sum()], [(weight * x).sum(), weight.sum()]])
            a, b = np.array([a, b]) - np.linalg.solve(curve + 1e-6 * np.eye(2), gradient)
        self.scale, self.shift = float(a), float(b)
        found = np.sort(self.probabilities(windows)[labels == 1])
        lost = int(np.floor((1 - recall) * len(found)))
        self.threshold = float(min(0.5, found[lost])) if len(found) else 0.5


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


# --- labelled findings ---

_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey", "auth", "key", "credential", "bearer")
_JOINS = (": ", " = ", "=", ":", ' = "', ": '", " is ", " ", " -> ", '="')
_ONSETS = ("", "b", "c", "d", "f", "g", "h", "l", "m", "n", "p", "r", "s", "t", "v", "pr", "st", "ch", "tr", "sh")
_CODAS = ("", "", "n", "r", "s", "t", "l", "m", "d", "rt", "nd", "st", "ck", "ng", "x")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def made_secret(rng: random.Random) -> str:
    """A value in the shape of a well-known kind of key."""

    def some(alphabet: str, n: int) -> str:
        return "".join(rng.choices(alphabet, k=n))

    raw = base64.b64encode(rng.randbytes(rng.choice((24, 32, 48)))).decode()
    return rng.choice(
        (
            lambda: "AKIA" + some(_BASE62[:36], 16),
            lambda: some("0123456789abcdef", rng.choice((32, 40, 64))),
            lambda: some("0123456789ABCDEF", rng.choice((32, 40, 64))),
            lambda: raw,
            lambda: raw.rstrip("=").replace("+", "-").replace("/", "_"),
            lambda: some(_BASE62, rng.randint(20, 48)),
            lambda: rng.choice(("ghp_", "gho_", "glpat-", "npm_", "hf_")) + some(_BASE62, 36),
            lambda: rng.choice(("sk_live_", "rk_live_", "sk-", "pk_test_")) + some(_BASE62, 32),
            lambda: f"xoxb-{some('0123456789', 12)}-{some('0123456789', 12)}-{some(_BASE62, 24)}",
            lambda: "AIza" + some(_BASE62 + "_-", 35),
            lambda: f"eyJ{some(_BASE62, 17)}.eyJ{some(_BASE62, 40)}.{some(_BASE62 + '_-', 43)}",
        )
    )()


def made_other(rng: random.Random, word) -> str:
    """A value that looks like a key and is none; ``word`` gives words of the corpus."""
    number = rng.randint
    return rng.choice(
        (
            lambda: f"{word()}{number(1, 9999)}.{word()}.{word()}.com",
            lambda: f"{word()}/{word()}/{word()}-{number(1, 99)}.html",
            lambda: f"{word()}_{word()}_{word()}_{number(0, 99)}",
            lambda: f"{word()}-{word()}-v{number(1, 20)}.{number(0, 30)}.{number(0, 30)}",
            lambda: f"{word().title()}{word().title()}{word().title()}{number(1, 99)}",
            lambda: f"20{number(10, 29)}-0{number(1, 9)}-{number(10, 28)}T{number(10, 23)}.{number(10, 59)}.00Z",
            lambda: f"{word()}{word()}{word()}{number(1, 999)}",
            lambda: f"img_{number(10**7, 10**8)}_{number(100, 999)}x{number(100, 999)}.{rng.choice(('png', 'jpg'))}",
            lambda: f"ISBN-978-{number(0, 9)}-{number(100, 999)}-{number(10000, 99999)}-{number(0, 9)}",
            lambda: f"+{number(1, 99)}-{number(100, 999)}-{number(100, 999)}-{number(1000, 9999)}-ext{number(1, 99)}",
            lambda: f"{word()}.{word()}=={number(1, 9)}.{number(0, 99)}.{number(0, 99)}",
            lambda: f"{word()}-{word()}-{word()}-{word()}-{number(1, 999)}",
        )
    )()


def made_findings(
    contexts: list[tuple[str, str]], words: list[str], n: int, seed: int = 12
) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): made values between the given texts before and behind."""
    rng = random.Random(seed)
    contexts = contexts or [("", "")]

    def word() -> str:
        if words and rng.random() < 0.5:
            return rng.choice(words)
        syllables = [rng.choice(_ONSETS) + rng.choice("aeiou") for _ in range(rng.randint(1, 3))]
        return "".join(syllables) + rng.choice(_CODAS)

    out = []
    while len(out) < n:
        before, behind = rng.choice(contexts)
        label = rng.randint(0, 1)
        value = made_secret(rng) if label else made_other(rng, word)
        if list(candidates(value)) != [(0, len(value))]:
            continue
        if rng.random() < (0.5 if label else 0.1):
            name = rng.choice(_NAMES)
            name = rng.choice((name, name.upper(), name.title()))
            before = f"{before} {name}{rng.choice(_JOINS)}"
        else:
            before = f"{before}{rng.choice((' ', ' ', '(', chr(34), '', chr(10)))}"
        if before and re.match("[A-Za-z0-9+/_.=-]", before[-1]) and before[-1] != "=":
            before += " "
        if behind and re.match("[A-Za-z0-9+/_.=-]", behind[0]):
            behind = " " + behind
        out.append((before + value + behind, len(before), len(before) + len(value), label))
    return out


_SAMPLED = "text string, start int, end int, label int"


def _sample_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates with what is around them and a label: whether a base rule sees a secret there."""
    for batch in batches:
        rows = []
        for text in batch.column(0):
            text = text.as_py() or ""
            spans = base_spans(text)
            for start, end in candidates(text):
                by = {s.kind for s in spans if s.start < end and start < s.end}
                label = int(bool(by & {"assign", "access"}))
                if by == {"hex"}:
                    continue  # without a name beside it, hex may be either
                low, high = max(0, start - 2 * AROUND), min(len(text), end + 2 * AROUND)
                rows.append((text[low:high], start - low, end - low, label))
        if rows:
            columns = list(zip(*rows, strict=True))
            types = (pa.string(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["text", "start", "end", "label"],
            )


def labelled_findings(docs: DataFrame) -> tuple[list[tuple], list[tuple[str, str]], list[str]]:
    """Findings from a bounded sample of documents, contexts of them, and words of the corpus.

    Of either label the first ``SAMPLE_FINDINGS`` by hash. Contexts and words come from the first
    characters of sampled documents.
    """
    texts = docs.where(F.length("text") > 0).select("doc_id", "text")
    one_in = max(1, -(-docs.count() // SAMPLE_DOCS))
    # Repeated rows share a hash: they are one document of the sample.
    sample = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0).distinct()
    found = sample.select("text").mapInArrow(_sample_partition, _SAMPLED).distinct()
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("text", "start"), "text", "start")
    found = found.withColumn("place", F.row_number().over(by_hash)).where(f"place <= {SAMPLE_FINDINGS}")
    rows = [(r.text, r.start, r.end, r.label) for r in found.orderBy("label", "place").collect()]
    piece = F.substring("text", 1, 4 * AROUND).alias("piece")
    some = sample.select(piece).distinct().orderBy(F.xxhash64("piece"), "piece").limit(SAMPLE_FINDINGS)
    pieces = [r.piece for r in some.collect()]
    words = sorted({w for p in pieces for w in re.findall("[a-z]{2,9}", p)})
    contexts = [(p[: len(p) // 2].rstrip(), p[len(p) // 2 :].lstrip()) for p in pieces]
    return rows, contexts, words


def learn(docs: DataFrame) -> Network:
    """A network fitted on three quarters of the labelled findings, calibrated on the others."""
    rows, contexts, words = labelled_findings(docs)
    return train(rows + made_findings(contexts, words, MADE_FINDINGS))


def train(findings: list[tuple[str, int, int, int]]) -> Network:
    windows = np.array([window(text, start, end) for text, start, end, _ in findings])
    labels = np.array([label for *_, label in findings])
    held = np.array([zlib.crc32(text[start:end].encode()) % 4 == 0 for text, start, end, _ in findings])
    network = Network()
    network.fit(windows[~held], labels[~held])
    network.calibrate(windows[held], labels[held])
    return network


# --- scans ---

SCANNED = "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>"
_SPAN_TYPE = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
)


def _scan_partition(network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, asked, windows = [], [], []
            extra: list[list[tuple[Span, float]]] = [[] for _ in range(batch.num_rows)]

            def score() -> None:
                if windows:
                    scores = network.value.probabilities(np.array(windows))
                    for (place, start, end), p in zip(asked, scores.tolist(), strict=True):
                        if p >= network.value.threshold:
                            extra[place].append((Span(start, end, "model"), p))
                asked.clear()
                windows.clear()

            for place, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                spans = base_spans(text)
                base.append(spans)
                for start, end in untouched(list(candidates(text)), spans):
                    asked.append((place, start, end))
                    windows.append(window(text, start, end))
                    if len(windows) >= SCORED:
                        score()
            score()
            rows = []
            for spans, more in zip(base, extra, strict=True):
                scores = {s: None for s in spans} | dict(more)
                rows.append(
                    [
                        {"kind": s.kind, "start": s.start, "end": s.end, "score": scores[s]}
                        for s in in_order(list(scores))
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(_SPAN_TYPE))], names=["doc_id", "spans"]
            )

    return run


def scan(spark: SparkSession, docs: DataFrame, network: Network | None = None) -> DataFrame:
    """(doc_id, spans): kind, start, end of every finding in order, with the score of the model's.

    No shuffle; the network, some ten thousand numbers, is broadcast.
    """
    network = spark.sparkContext.broadcast(network or learn(docs))
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_scan_partition(network), SCANNED)


def digests(scanned: DataFrame) -> DataFrame:
    """Numbers of base findings, a digest of them, and all findings as one string."""
    text = "concat(s.kind, ':', s.start, ':', s.end)"
    numbers = [
        F.expr(f"CAST(size(filter(spans, s -> s.kind = '{kind}')) AS LONG)").alias(f"n_{kind}")
        for kind in KINDS
    ]
    base = F.expr(f"array_join(transform(filter(spans, s -> s.kind <> 'model'), s -> {text}), ',')")
    return scanned.select(
        "doc_id",
        *numbers,
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.expr(f"array_join(transform(spans, s -> {text}), ',')").alias("spans"),
    )
