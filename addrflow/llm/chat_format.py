"""Chat formatting from event logs.

A conversation is a log of events (conv_id, seq, message, kind, role, text):

* ``message`` opens a message with a role and its first text;
* ``delta`` appends text to a message (a streamed piece);
* ``edit`` replaces what a message says so far;
* ``regenerate`` empties a message and drops all messages opened between it and this event; the
  deltas that follow build the new answer.

``fold`` turns the log into final messages, ``render`` writes each as a turn of the template, and
``digest`` reads the output back. Control strings in roles and texts are escaped reversibly: a
backslash becomes two and ``<|`` becomes ``<\\|``, so a mark of the template never occurs in a text. A
line feed in a role becomes a backslash and n.

Messages stay one row each all along, so a conversation of any length is never gathered. The digest
of a conversation is folded by a stream over its sorted turns that holds one hash state (a SHA-256
over a whole conversation can only be computed in order).

Nulls and odd input: a null text or role is empty; a null conv_id is a conversation of its own; a
null seq comes first. Events of a message with the same seq: ``message`` first, then by text.
Messages opened at the same seq are ordered by their rendered turn. A message without a ``message``
event is opened by its first event. Rows of an unknown kind count as deltas. Repeated rows are
separate events. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
EVENTS = "conv_id long, seq long, message string, kind string, role string, text string"
TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
LEARNED = "assistant"


def fold(events: DataFrame) -> DataFrame:
    """conv_id, opened (seq), message, role, text of the final messages."""
    resets = F.coalesce(F.col("kind").isin("message", "edit", "regenerate"), F.lit(False))
    step = F.struct(
        "seq", (F.coalesce("kind", F.lit("")) != "message").alias("later"),
        F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit(""))).alias("text"), resets.alias("resets"),
    )
    opening = F.struct((F.coalesce("kind", F.lit("")) != "message").alias("a"), "seq", "role")
    per = events.groupBy("conv_id", "message").agg(
        F.min(F.struct("seq")).getField("seq").alias("opened"),
        F.min(opening).getField("role").alias("role"),
        F.max(F.when(resets, step)).alias("last"),
    )
    # Everything before the last event that sets the text is history: of the rest, only what was
    # appended behind it is gathered, once and in order.
    appended = (
        events.filter(~resets)
        .select("conv_id", "message", step.alias("step"))
        .alias("e")
        .join(per.select("conv_id", "message", "last").alias("p"), F.expr("e.conv_id <=> p.conv_id and e.message <=> p.message"))
        .filter("last is null or step > last")
        .groupBy("e.conv_id", "e.message")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("step")), lambda s: s["text"]), "").alias("tail"))
    )
    messages = (
        per.alias("p")
        .join(appended.alias("a"), F.expr("p.conv_id <=> a.conv_id and p.message <=> a.message"), "left")
        .select(
            "p.conv_id", "p.message", "opened", F.coalesce("role", F.lit("")).alias("role"),
            F.concat(F.coalesce("last.text", F.lit("")), F.coalesce("tail", F.lit(""))).alias("text"),
        )
    )
    back = (
        events.filter("kind = 'regenerate'")
        .select("conv_id", "message", F.col("seq").alias("at"))
        .alias("r")
        .join(per.select("conv_id", "message", "opened").alias("p"), F.expr("r.conv_id <=> p.conv_id and r.message <=> p.message"))
        .select("r.conv_id", F.lit(None).cast("string").alias("message"), "r.at", F.col("p.opened").alias("target"))
    )
    # A message goes if a later regeneration belongs to an earlier message: the running minimum of
    # the targets, from the end of the conversation. Only conversations with a regeneration.
    touched = back.select("conv_id").distinct().alias("b")
    points = (
        messages.alias("m")
        .join(touched, F.expr("m.conv_id <=> b.conv_id"), "left_semi")
        .select("conv_id", "message", F.col("opened").alias("at"), F.lit(None).cast("long").alias("target"))
        .unionByName(back)
    )
    later = Window.partitionBy("conv_id").orderBy(F.desc_nulls_last("at"), F.asc_nulls_last("target")).rowsBetween(Window.unboundedPreceding, -1)
    gone = (
        points.withColumn("target_min", F.min("target").over(later))
        .filter("message is not null and target_min < at")
        .select("conv_id", "message")
        .alias("g")
    )
    return messages.alias("m").join(gone, F.expr("m.conv_id <=> g.conv_id and m.message <=> g.message"), "left_anti")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_role(role: Column) -> Column:
    """As ``escape``; a line feed, which would end the role, becomes backslash and n."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def render(messages: DataFrame) -> DataFrame:
    """conv_id, opened, message, formatted, loss_from, loss_to.

    The turns of a conversation, concatenated by (opened, formatted), are its formatted text;
    loss_from and loss_to are places in ``formatted`` (null where nothing is learned).
    """
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(OPEN), escape_role(role), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    learned = role == LEARNED
    return messages.select(
        "conv_id", "opened", "message",
        F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
        F.when(learned, F.length(head)).alias("loss_from"),
        F.when(learned, F.length(head) + F.length(body)).alias("loss_to"),
    )


class _Conversation:
    """What the digest of one conversation needs while its turns stream by."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start, stop) -> None:
        self.chars += len(formatted)
        for turn in TURN.finditer(formatted):
            self.n_turns += 1
            role, text = unescape_role(turn[1]), unescape(turn[2])
            self.turns.update(f"{role}\n{text}\n".encode())
        if start is not None:
            learned = unescape(formatted[start:stop])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
DIGEST_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _digest_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), DIGEST_ARROW, strict=True)], schema=DIGEST_ARROW)

    now: _Conversation | None = None
    for b in batches:
        done = []
        for conv_id, formatted, start, stop in zip(*(b.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_from", "loss_to")), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv_id)
            now.add(formatted, start, stop)
        if done:
            yield out(done)
    if now is not None:
        yield out([now.row()])


def digest(rendered: DataFrame) -> DataFrame:
    """One row per conversation, from the rendered turns alone."""
    turns = rendered.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("opened"), "formatted", "message")
    return turns.select("conv_id", "formatted", "loss_from", "loss_to").mapInArrow(_digest_stream, DIGEST)
