from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablecheck.llm import chat

SCHEMA = "conv_id long, seq long, kind string, message_id long, role string, text string"
PIECES = st.sampled_from([*chat.CONTROL, "\\", "<", "|", "[", "\n", "a", "😀", "<|im_end|", ">"])
TEXT = st.lists(PIECES, max_size=8).map("".join)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
@settings(max_examples=300, deadline=None)
def test_round_trip(turns):
    formatted, _ = chat.render(turns)
    assert chat.parse(formatted) == turns


@given(TEXT)
def test_no_control_string_is_left_in_a_text(text):
    assert not any(c in chat.escape(text) for c in chat.CONTROL)


def test_loss_mask_covers_assistant_texts_only():
    turns = [("user", "</s>"), ("assistant", "[INST] yes"), ("assistant", "")]
    formatted, spans = chat.render(turns)
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == ["[INST] yes", ""]


def fold(spark, events):
    rows = chat.format_conversations(spark.createDataFrame(events, SCHEMA)).collect()
    return {r.conv_id: chat.parse(r.formatted) for r in rows}


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 0, "message", 10, "user", "hello"),
        (1, 3, "delta", 11, "assistant", "lo"),
        (1, 2, "delta", 11, "assistant", "hel"),
        (1, 4, "regenerate", 11, "assistant", ""),
        (1, 5, "delta", 11, "assistant", "better"),
        (1, 6, "message", 12, "user", "thanks"),
        (1, 7, "edit", 10, "user", "hi"),
        (1, 8, "delta", 13, "assistant", "last"),
        (2, 0, None, None, "user", "x"),
        (2, 0, None, None, "user", "x"),
        (2, 1, "message", 5, "tool", "gone"),
        (2, 2, "delete", 5, None, None),
        (2, 3, "delete", None, None, None),
    ]
    assert fold(spark, events) == {
        1: [("user", "hi"), ("assistant", "last")],
        2: [("user", "x"), ("user", "x")],
    }


def test_nulls_ties_and_empty_log(spark):
    events = [(None, None, None, None, None, None), (None, 1, "message", None, "assistant", "a")]
    assert fold(spark, events) == {None: [("", ""), ("assistant", "a")]}
    assert fold(spark, []) == {}


def test_read_back_with_clashing_columns(spark):
    turns = spark.createDataFrame(
        [(1, 1, "assistant", "b"), (1, 0, "user", None)], "conv_id long, turn long, role string, text string"
    ).withColumn("formatted", F.lit("x"))
    row = chat.read_back(chat.format_conversations(chat.turns_as_events(turns))).collect()[0]
    assert (row.n_turns, row.loss_chars) == (2, 1)
    # sha256 of "user\n\nassistant\nb\n"
    import hashlib

    assert row.turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\n").hexdigest()


def test_a_streamed_log_folds_to_its_turns(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", "ab\\</s>😀" * t) for c in (1, 2) for t in range(9)]
    rows += [(3, None, None, None), (3, 1, "user", "x"), (3, 1, "user", "x"), (None, 0, "tool", "é")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat.as_streamed_log(turns)
    assert log.count() == 6 * len(rows)
    assert {r.kind for r in log.collect()} == {"message", "delta", "edit", "regenerate"}
    formatted = chat.format_conversations(log.repartition(5)).collect()
    found = {r.conv_id: chat.parse(r.formatted) for r in formatted}
    assert found[1] == found[2] == [(r, t) for _, _, r, t in rows[:9]]
    assert found[3] == [("", ""), ("user", "x"), ("user", "x")] and found[None] == [("tool", "é")]
    plain = chat.read_back(chat.format_conversations(chat.turns_as_events(turns)))
    streamed = chat.read_back(chat.format_conversations(log))
    assert sorted(plain.collect(), key=repr) == sorted(streamed.collect(), key=repr)


def test_many_edits_take_linear_time():
    conversation = chat.Conversation(1)
    for m in range(60_000):
        conversation.apply("message", m, "user", "draft")
        conversation.apply("delta", -m - 1, "assistant", "stray")
        conversation.apply("edit", m, "user", "text")
    assert len(conversation.turns()) == 60_000
