"""Chat formatting from event logs.

A log has one row per event: ``conv_id, seq, kind, message_id, role, text``. Rows are partitioned by
conversation and sorted by sequence, and each conversation's events are folded into its messages:

- ``message`` (or null): a whole message; with the id of a message that exists, it replaces that one.
- ``delta``: text streamed into the message with this id, which it creates if need be.
- ``edit``: the message gets this text, and what followed it is dropped.
- ``regenerate``: the message starts again with this text, and what followed it is dropped.
- ``delete``: the message is dropped.

A null ``message_id`` names no message: ``message``, ``edit``, ``regenerate`` and ``delta`` then make a
new one each, ``delete`` does nothing. An edit or regeneration of an unknown message makes it.

Rendering marks turns with control strings and escapes control strings inside texts and roles, so that
``read_back`` gives the very same turns. The loss mask is a list of spans, in code points of the
formatted text, one per assistant message.

Cases: null texts and roles are empty; null sequence numbers come first, ties are ordered by message id,
role and text; equal rows are events of their own; null conversation ids make up one conversation; an
empty log gives an empty result. A task holds one conversation at a time, which is also one row of the
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Strings with a meaning in this or other templates; none may appear unescaped in a text.
CONTROL = (START, MIDDLE, "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
ESCAPE = "\\"
LEARNED = "assistant"
BATCH_ROWS = 256

FORMATTED = "conv_id long, n_turns long, formatted string, loss_spans array<struct<start:long,end:long>>"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(\\?)")
_TURN = re.compile(
    f"{re.escape(START)}(.*?){re.escape(MIDDLE)}(.*?){re.escape(END)}", re.DOTALL
)


def escape(text: str) -> str:
    """Doubles escape characters, and puts one behind the first character of each control string."""
    doubled = text.replace(ESCAPE, ESCAPE * 2)
    return _CONTROL.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], doubled)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Conversation:
    """The messages of one conversation while its events come in."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.messages: list[tuple[str, list[str]] | None] = []
        self.ids: list[int | None] = []
        self.place: dict[int, int] = {}

    def apply(self, kind: str | None, message_id: int | None, role: str, text: str) -> None:
        at = self.place.get(message_id)
        if kind == "delete":
            if at is not None:
                self.messages[at] = self.ids[at] = None
                del self.place[message_id]
        elif at is None:
            if message_id is not None:
                self.place[message_id] = len(self.messages)
            self.messages.append((role, [text]))
            self.ids.append(message_id)
        elif kind == "delta":
            self.messages[at][1].append(text)
        else:
            self.messages[at] = (role or self.messages[at][0], [text])
            if kind in ("edit", "regenerate"):
                # An id that is dropped here is in no other place: work is for what is dropped only.
                for dropped in self.ids[at + 1 :]:
                    self.place.pop(dropped, None)
                del self.messages[at + 1 :], self.ids[at + 1 :]

    def turns(self) -> list[tuple[str, str]]:
        return [(m[0], "".join(m[1])) for m in self.messages if m is not None]


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + MIDDLE, escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, current = [], None

    def close(conversation):
        turns = conversation.turns()
        formatted, spans = render(turns)
        loss = [{"start": a, "end": b} for a, b in spans]
        rows.append((conversation.conv_id, len(turns), formatted, loss))

    for batch in batches:
        for conv_id, kind, message_id, role, text in zip(
            *[c.to_pylist() for c in batch.columns], strict=True
        ):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    close(current)
                current = Conversation(conv_id)
            current.apply(kind, message_id, role or "", text or "")
            if len(rows) >= BATCH_ROWS:
                yield _batch(rows, _FORMATTED)
                rows.clear()
    if current is not None:
        close(current)
    if rows:
        yield _batch(rows, _FORMATTED)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_spans", _SPANS)]
)
_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans) for every conversation of an event log."""
    log = events.select(
        F.col("conv_id").cast("long"), "seq", "kind", F.col("message_id").cast("long"), "role", "text"
    )
    ordered = log.repartition("conv_id").sortWithinPartitions(
        "conv_id", "seq", "message_id", "role", "text"
    )
    return ordered.select("conv_id", "kind", "message_id", "role", "text").mapInArrow(_fold, FORMATTED)


def turns_as_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as an event log of whole messages."""
    return conversations.select(
        "conv_id",
        F.col("turn").alias("seq"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("long").alias("message_id"),
        "role",
        "text",
    )


#: Events per turn in a streamed log, with room for more.
STEPS = 8


def as_streamed_log(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as a log that their making could have left, in no order.

    Each turn begins as a draft, which a stray answer follows; an edit or a regeneration replaces the
    draft by the first third of the text and drops the answer, and deltas stream the rest. Folding the log
    gives the turns. Turns are numbered by turn, role and text in their conversation.
    """
    line = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "turn", "role", "text").withColumn(
        "number", F.row_number().over(line).cast("long")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    third = F.floor(F.char_length(text) / 3).cast("int")
    after = F.lit(2**31 - 1)
    anew = F.when(F.col("number") % 2 == 0, "edit").otherwise("regenerate")
    stray = -F.col("number")
    steps = [
        ("message", F.col("number"), F.col("role"), F.concat(F.lit("draft "), F.substring(text, F.lit(1), F.lit(9)))),
        ("delta", stray, F.lit(LEARNED), F.lit("a stray ")),
        ("delta", stray, F.lit(LEARNED), F.lit("answer")),
        (anew, F.col("number"), F.col("role"), F.substring(text, F.lit(1), third)),
        ("delta", F.col("number"), F.col("role"), F.substring(text, third + 1, third)),
        ("delta", F.col("number"), F.col("role"), F.substring(text, 2 * third + 1, after)),
    ]
    events = [
        F.struct(
            (F.col("number") * STEPS + step).alias("seq"),
            (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
            message_id.alias("message_id"),
            role.alias("role"),
            part.alias("text"),
        )
        for step, (kind, message_id, role, part) in enumerate(steps)
    ]
    return numbered.select("conv_id", F.inline(F.array(*reversed(events))))


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, formatted, spans in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            turns, all_turns, loss = parse(formatted), hashlib.sha256(), hashlib.sha256()
            for role, text in turns:
                all_turns.update(f"{role}\n{text}\n".encode())
            chars = 0
            for span in spans:
                text = unescape(formatted[span["start"] : span["end"]])
                chars += len(text)
                loss.update(text.encode())
            rows.append(
                (conv_id, len(turns), all_turns.hexdigest(), chars, loss.hexdigest(), len(formatted))
            )
        if rows:
            yield _batch(rows, _DIGESTS)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, read from the formatted texts."""
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(_read_back, DIGESTS)
