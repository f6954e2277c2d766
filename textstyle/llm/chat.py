"""Event-sourced chat logs: fold events into messages, render, read back.

Everything is a DataFrame expression. A log row is an event of one message:

* ``message`` starts it (role and text),
* ``delta`` appends to it, as streaming does,
* ``edit`` replaces its text,
* ``regenerate`` drops its text, so that later deltas write it anew,
* ``delete`` removes it, until a later event of another kind than ``delta``.

Events are folded message by message, not conversation by conversation, so a
long conversation is spread out until its turns are joined to one text.

The template of a turn is ``<s>[ROLE]role[/ROLE]\\ntext</s>\\n``. A control
string inside a role or text gets a backslash after its first character, and
one that has backslashes there already gets one more; that is undone exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, CLOSE = "<s>[ROLE]", "</s>\n"
BODY = "[/ROLE]\n"
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"]
_HEADS = r"([<\[])"
_TAILS = r"(/?s>|/?INST\]|/?ROLE\])"
ASSISTANT = "assistant"

_KINDS = ["message", "edit", "regenerate", "delete", "delta"]


def escape(text: Column | str) -> Column:
    return F.regexp_replace(text, rf"{_HEADS}(\\*){_TAILS}", r"$1\\$2$3")


def unescape(text: Column | str) -> Column:
    return F.regexp_replace(text, rf"{_HEADS}\\(\\*){_TAILS}", "$1$2$3")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_events(events: DataFrame) -> DataFrame:
    """The messages that stand at the end: ``conv_id, position, role, text``.

    ``events`` has ``conv_id, seq, kind, message_id, role, text``; further
    columns are ignored. Events of one message apply in the order of ``seq``;
    equal ones by kind in the order above, then by text and role, so the
    result does not depend on the order of rows. ``position`` is the message's
    first ``seq``, and messages with equal ones are ordered by id. A null text
    is empty; the role is the last one given, or ''. A delta without a message
    begins one. Null keys are keys of their own; an unknown kind is an error.
    """
    order = F.array_position(F.array(*map(F.lit, _KINDS)), F.col("kind"))
    unknown = F.raise_error(F.concat(F.lit("unknown kind of event: "), F.col("kind")))
    kind = F.when(F.coalesce(order, F.lit(0)) > 0, order.cast("int")).otherwise(
        F.when(F.col("kind").isNull(), F.raise_error("an event has no kind")).otherwise(unknown)
    )
    event = F.struct(
        "seq", kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"), "role"
    )
    log = events.groupBy("conv_id", "message_id").agg(
        F.array_sort(F.collect_list(event)).alias("log")
    )
    delta, delete = (_KINDS.index(k) + 1 for k in ("delta", "delete"))
    # The last event that is not a delta decides from where the text is read.
    start = F.coalesce(
        F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != delta, i + 1))),
        F.lit(0),
    )
    roles = F.filter("log", lambda e: e["role"].isNotNull())
    parts = F.slice("log", F.greatest("start", F.lit(1)), F.size("log"))
    return (
        log.withColumn("start", start)
        .where((F.col("start") == 0) | (F.col("log")[F.col("start") - 1]["kind"] != delete))
        .select(
            "conv_id",
            "message_id",
            F.col("log")[0]["seq"].alias("position"),
            F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
            F.array_join(
                F.transform(
                    parts,
                    lambda e: F.when(
                        e["kind"] == _KINDS.index("regenerate") + 1, ""
                    ).otherwise(e["text"]),
                ),
                "",
            ).alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``: each conversation as one text.

    ``loss`` holds the assistant texts as ``(start, size)`` in UTF-8 bytes of
    ``formatted``, in order: the text alone, without header and end mark.
    """
    turn = messages.select(
        "conv_id",
        "position",
        "message_id",
        F.concat(F.lit(OPEN), escape("role"), F.lit(BODY)).alias("head"),
        escape("text").alias("body"),
        (F.col("role") == ASSISTANT).alias("learned"),
    )
    size = F.octet_length("head") + F.octet_length("body") + len(CLOSE)
    along = Window.partitionBy("conv_id").orderBy("position", "message_id")
    before = F.sum(size.cast("bigint")).over(
        along.rowsBetween(Window.unboundedPreceding, -1)
    )
    span = F.struct(
        (F.coalesce(before, F.lit(0)) + F.octet_length("head")).alias("start"),
        F.octet_length("body").cast("bigint").alias("size"),
    )
    turn = turn.select(
        "conv_id",
        F.struct(
            "position",
            "message_id",
            F.concat("head", "body", F.lit(CLOSE)).alias("turn"),
            F.when(F.col("learned"), span).alias("span"),
        ).alias("t"),
    )
    turns = F.array_sort(F.collect_list("t"))
    joined = turn.groupBy("conv_id").agg(turns.alias("turns"))
    return joined.select(
        "conv_id",
        F.array_join(F.col("turns.turn"), "").alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss"),
    )


def parse(formatted: Column | str) -> Column:
    """The turns of a rendered text: ``array<struct<role, text>>``."""
    parts = F.split(formatted, rf"\Q{CLOSE}\E")
    whole = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        return _let(
            F.split(part, rf"\Q{BODY}\E", 2),
            lambda h: F.struct(
                unescape(F.substring(h[0], F.lit(len(OPEN) + 1), F.length(h[0]))).alias("role"),
                unescape(h[1]).alias("text"),
            ),
        )

    return F.transform(whole, turn)


def loss_text(formatted: Column | str, loss: Column | str) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    parts = _let(
        formatted.cast("binary"),
        lambda raw: F.transform(
            loss,
            lambda s: unescape(
                F.decode(raw.substr(s["start"].cast("int") + 1, s["size"].cast("int")), "utf-8")
            ),
        ),
    )
    return F.array_join(parts, "")


def turn_events(turns: DataFrame) -> DataFrame:
    """A table of finished turns as the log that streaming them would leave.

    Each row becomes a message with its role and no text, then one delta.
    Rows are numbered by turn, role and text; repeated rows stay apart.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).alias("n"))
    n = F.col("n").cast("bigint")
    no_text, no_role = F.lit(None).cast("string"), F.lit(None).cast("string")
    both = F.array(
        F.struct((2 * n).alias("seq"), F.lit("message").alias("kind"),
                 F.col("role"), no_text.alias("text")),
        F.struct((2 * n + 1).alias("seq"), F.lit("delta").alias("kind"),
                 no_role.alias("role"), F.col("text")),
    )
    events = numbered.select("conv_id", n.alias("message_id"), F.explode(both).alias("e"))
    return events.select("conv_id", "message_id", "e.*")
