from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textstyle.llm import chat

SCHEMA = "conv_id bigint, seq bigint, kind string, message_id string, role string, text string, position string"


def test_events_fold_to_final_messages(spark):
    log = [
        (1, 1, "message", "a", "user", "Hi"), (1, 2, "message", "b", "assistant", None),
        (1, 3, "delta", "b", None, "Hel"), (1, 4, "delta", "b", None, "lo"),
        (1, 5, "regenerate", "b", None, "dropped"), (1, 7, "delta", "b", None, "ew"), (1, 6, "delta", "b", None, "N"),
        (1, 8, "message", "c", "user", "x"), (1, 9, "edit", "c", None, "y"), (1, 10, "delta", "c", None, "z"),
        (1, 11, "message", "d", "user", "gone"), (1, 12, "delete", "d", None, None), (1, 13, "delta", "d", None, "late"),
        (2, 1, "delta", "only", None, "no start"), (None, 1, "message", None, None, None),
        (2, 2, "message", "two", "user", "same"), (2, 2, "delta", "two", None, " seq"),
    ]
    events = spark.createDataFrame([(*r, "clash") for r in log], SCHEMA)
    folded = chat.fold_events(events.repartition(3)).collect()
    got = sorted(((r["conv_id"] or 0, r["position"], r["role"], r["text"]) for r in folded))
    assert got == [
        (0, 1, "", ""), (1, 1, "user", "Hi"), (1, 2, "assistant", "New"), (1, 8, "user", "yz"),
        (2, 1, "", "no start"), (2, 2, "user", "same seq"),
    ]
    assert chat.fold_events(events.limit(0)).count() == 0


def _read_back(spark, turns):
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    rendered = chat.render(chat.fold_events(chat.turn_events(rows)))
    return rendered.select(
        "conv_id", "formatted", chat.parse("formatted").alias("turns"),
        chat.loss_text("formatted", "loss").alias("learned"), F.size("loss").alias("n"),
    ).collect()


def test_repeats_nulls_and_long_texts(spark):
    long = "é😀</s>[INST]" * 20_000
    turns = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long), (1, None, None, None)]
    (row,) = _read_back(spark, turns)
    assert [(t["role"], t["text"]) for t in row["turns"]] == [("", ""), ("user", long), ("assistant", long), ("assistant", long)]
    assert row["learned"] == long + long and row["n"] == 2
    assert _read_back(spark, [(1, 0, "user", "no answer")])[0]["learned"] == ""


HOSTILE = st.lists(
    st.sampled_from(["</s>", "<s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\n", "\\", "<", "[", "s>", "/", "a", "é", "$1", "\\E"]),
    max_size=12,
).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a</s>b"]), HOSTILE), min_size=1, max_size=25))
@settings(max_examples=15, deadline=None)
def test_any_text_is_read_back(spark, messages):
    (row,) = _read_back(spark, [(1, k, role, text) for k, (role, text) in enumerate(messages)])
    assert [(t["role"], t["text"]) for t in row["turns"]] == messages
    assert row["learned"] == "".join(t for r, t in messages if r == "assistant")
    assert row["formatted"].count("</s>") == len(messages)
