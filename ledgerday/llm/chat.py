"""Chat formatting by event-sourced reconstruction: a log of streamed deltas, edits and
regenerations is folded into each conversation's final messages, which are then rendered.

Kinds of events; each names a message (an orderable key within its conversation):

* ``open``: the message begins, with a role and perhaps text;
* ``delta``: its text goes on;
* ``edit``: its text is replaced, and what the log had for later messages is void;
* ``regenerate``: its text and what the log had for later messages are void; deltas follow.

So an event's text counts unless a later edit or regeneration names its message
or an earlier one.  That is a running minimum from the end of the log, taken in
two levels (within a range of the sorted log, then over the ranges), so that a
conversation with a third of all events is no one task's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerday.llm.common import shared_table

RESETS = ("edit", "regenerate")
KINDS = ("open", "delta", *RESETS)
#: The role whose texts a model is trained on.
LEARNED = "assistant"
# The template: a turn's marks.  Their first characters stand in texts and roles only behind a backslash.
HEAD, AFTER_ROLE, TAIL = "### ", ": ", " </turn>\n"


def final_messages(events: DataFrame) -> DataFrame:
    """``conv_id, message, role, text`` of the messages that stand when the log is folded.

    ``events``: ``conv_id, seq, kind, message, role, text``; ``seq`` and
    ``message`` of any orderable types.  A message's text are its live texts in
    the order of ``seq``, its role that of its last open event.  It is gone if
    an edit or regeneration of an earlier message came after its last event.

    Null text: empty.  No open event, or a null role there: null.  Null seq:
    first.  Null message: one message, the first, which nothing voids.  Null
    conv_id: a conversation.  Other kinds are left out.  Events of one seq come
    in the order of (kind, message, role, text); one repeated in full counts once, so a log
    may be delivered twice.  Empty table: no rows; other columns are ignored.
    """
    log = events.where(F.col("kind").isin(*KINDS)).select(
        "conv_id", "seq", "kind", "message", "role", F.coalesce("text", F.lit("")).alias("text"),
        F.when(F.col("kind").isin(*RESETS), F.col("message")).alias("reset"),
    )
    # Written with their ranges, which a second run of the sampling might cut elsewhere.
    log = shared_table(log.repartitionByRange("conv_id", "seq").withColumn("range", F.spark_partition_id()), "chat-log")
    earlier = (Window.unboundedPreceding, -1)  # in the log's order from its end: what came later
    ranges = Window.partitionBy("conv_id").orderBy(F.desc("range")).rowsBetween(*earlier)
    behind = log.groupBy("conv_id", "range").agg(F.min("reset").alias("least"))
    behind = behind.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), F.min("least").over(ranges).alias("behind"))
    event = ("seq", "kind", "message", "role", "text")
    within = Window.partitionBy("conv_id", "range").orderBy(*map(F.desc, event))
    log = log.select(
        "*", F.min("reset").over(within.rowsBetween(*earlier)).alias("within"),
        F.struct(*event).eqNullSafe(F.lag(F.struct(*event)).over(within)).alias("again"),
    ).where("not again")
    log = log.join(behind, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")), "left")
    void_from = F.least("within", "behind")
    live = F.when(F.coalesce(void_from > F.col("message"), F.lit(True)), F.struct("seq", "kind", "text"))
    opened = F.when(F.col("kind") == "open", F.struct("seq", "role"))
    folded = log.where(F.coalesce(void_from >= F.col("message"), F.lit(True))).groupBy("conv_id", "message").agg(
        F.max(opened).alias("opened"), F.array_sort(F.collect_list(live)).alias("texts")
    )
    text = F.array_join(F.transform("texts", lambda x: x["text"]), "")
    return folded.select("conv_id", "message", F.col("opened.role").alias("role"), text.alias("text"))


def _escaped(text: Column, characters: str) -> Column:
    return F.regexp_replace(text, f"([\\\\{characters}])", r"\\$1")


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, message, formatted, loss_from, loss_to``: each message as the template has it.

    A conversation's formatted text are its messages' in order.  Backslashes and
    the first characters of the template's marks get a backslash, so the marks
    are only the template's.  ``loss_from`` and ``loss_to`` (code points in
    ``formatted``) bound the text that bears loss; null where none does.  A null role is an empty one.
    """
    role = _escaped(F.coalesce("role", F.lit("")), "#<:")
    text = _escaped(F.coalesce("text", F.lit("")), "#<")
    parts = messages.select("conv_id", "message", (F.col("role") == LEARNED).alias("learned"), role.alias("role"), text.alias("text"))
    start = F.char_length("role") + len(HEAD + AFTER_ROLE)
    return parts.select(
        "conv_id", "message",
        F.concat(F.lit(HEAD), "role", F.lit(AFTER_ROLE), "text", F.lit(TAIL)).alias("formatted"),
        F.when(F.col("learned"), start).cast("long").alias("loss_from"),
        F.when(F.col("learned"), start + F.char_length("text")).cast("long").alias("loss_to"),
    )


def chat_format(events: DataFrame) -> DataFrame:
    """:func:`render` of :func:`final_messages`."""
    return render(final_messages(events))


_TURN = re.compile(
    re.escape(HEAD) + r"([^\\:#<]*(?:\\.[^\\:#<]*)*)" + re.escape(AFTER_ROLE) + r"([^\\#<]*(?:\\.[^\\#<]*)*)" + re.escape(TAIL),
    re.DOTALL,
)
_BACKSLASHED = re.compile(r"\\(.)", re.DOTALL)


def unescape(text: str) -> str:
    return _BACKSLASHED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of each turn of a formatted text; ValueError if it isn't one."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of formatted conversations.

    A conversation's messages stream by in order and only digests are held.  A
    digest is of a sequence, so one task reads a conversation, whatever its length.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [c.split()[0] for c in schema.split(", ")]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, some, out = None, False, []

        def close() -> None:
            if some:
                out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in batches:
            for key, text, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not some or key != conv:
                    close()
                    conv, some, n_turns, loss_chars, chars, turns, loss = key, True, 0, 0, 0, sha256(), sha256()
                for turn in parse(text):
                    n_turns += 1
                    turns.update("{}\n{}\n".format(*turn).encode())
                chars += len(text)
                if lo is not None:
                    learned = unescape(text[lo:hi])
                    loss_chars += len(learned)
                    loss.update(learned.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=names)

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "message")
    return rows.select("conv_id", "formatted", "loss_from", "loss_to").mapInArrow(digest, schema)


def table_events(conversations: DataFrame) -> DataFrame:
    """The event log of a table of turns (``conv_id, turn, role, text``).

    A user's turn is opened with its first line and then edited into the whole
    text.  An assistant's streams line by line, after a first answer that broke
    off behind its first line and was regenerated; any other is opened whole.
    Every row is a message, in the order of (turn, role, text), nulls first;
    rows repeated in full are messages of their own.  Null text: empty.
    """
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("nth", nth).withColumn("lines", F.split("text", "\n"))
    last = F.size("lines") - 1
    lines = F.transform("lines", lambda x, i: F.when(i < last, F.concat(x, F.lit("\n"))).otherwise(x))
    first = F.element_at("lines", 1)
    none = F.lit(None).cast("string")

    def event(step: int | Column, kind: str, text: Column) -> Column:
        return F.struct((F.lit(step) if isinstance(step, int) else step).alias("step"), F.lit(kind).alias("kind"), text.alias("text"))

    streamed = F.concat(
        F.array(event(0, "open", none), event(1, "delta", first), event(2, "regenerate", none)),
        F.transform(lines, lambda x, i: event(i + 3, "delta", x)),
    )
    edited = F.array(event(0, "open", first), event(1, "edit", F.col("text")))
    events = F.when(F.col("role") == LEARNED, streamed).when(F.col("role") == "user", edited).otherwise(F.array(event(0, "open", F.col("text"))))
    return rows.select("conv_id", "turn", "nth", "role", F.explode(events).alias("e")).select(
        "conv_id", F.struct("turn", "nth", "e.step").alias("seq"), "e.kind", F.struct("turn", "nth").alias("message"),
        F.when(F.col("e.kind") == "open", F.col("role")).alias("role"), "e.text",
    )
