"""Chat formatting from event logs.

A log holds events of messages: ``open`` begins one, ``delta`` adds streamed text, ``edit``
replaces what is there, ``regenerate`` throws it away to be streamed anew. Events are dealt by
conversation and message, so that a conversation of any length is dealt over tasks, sorted by
sequence and folded into the final text. A message is rendered as one segment of the formatted
conversation, and reading parses the segments back.

Template of a segment::

    ### role: text </turn>\\n

In texts and roles a backslash goes before every backslash and every control string (``###``,
``</turn>``), in roles before colons too; taking it away again gives the original.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import arrow_limits

OPEN, CLOSE = "### ", " </turn>\n"
_CONTROL = r"(\\|###|</turn>)"
_ROLE_CONTROL = r"(\\|###|</turn>|:)"
#: The role whose text counts towards the loss.
LEARNED = "assistant"


def as_events(rows: DataFrame) -> DataFrame:
    """Logs of ``rows (conv_id, turn, role, text)`` as a client would have written them.

    conv_id, message (place of the message, also among rows of one turn), seq, kind, role, text.
    The text is streamed in two deltas after a draft that is taken back: learned turns are
    regenerated, others edited. A null text or role is empty. Rows of one turn follow each other
    by role and text; repeated rows are messages of their own.
    """
    said = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    half = F.expr("cast(length(text) div 2 as int)")
    first, rest = F.col("text").substr(F.lit(1), half), F.col("text").substr(half + 1, F.length("text"))
    again = F.col("role") == LEARNED
    # the part of the text that an edit brings along, and the deltas after it
    events = F.array(*[
        F.struct(F.lit(seq).alias("seq"), kind.alias("kind"), text.alias("text"))
        for seq, (kind, text) in enumerate([
            (F.lit("open"), F.lit("")),
            (F.lit("delta"), F.concat(rest, first)),
            (F.when(again, "regenerate").otherwise("edit"), F.when(again, "").otherwise(first)),
            (F.lit("delta"), F.when(again, first).otherwise("")),
            (F.lit("delta"), rest),
        ])
    ])
    message = F.struct("turn", "role", F.sha2("text", 256).alias("text_key"), "copy")
    return (
        said.withColumn("copy", F.explode(F.expr("sequence(1, cast(copies as int))")))
        .select("conv_id", message.alias("message"), "role", F.explode(events).alias("e"))
        .select("conv_id", "message", "e.seq", "e.kind", "role", "e.text")
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, message, role, text)`` of an event log.

    Per message, the events after the last edit or regeneration, with the text that it brings,
    make the text. Events of one sequence number go by kind and text; unknown kinds are taken as
    deltas; null texts are empty. The role is that of the first event that has one.
    """
    log = F.sort_array(F.collect_list(F.struct(
        "seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")))
    folded = events.groupBy("conv_id", "message").agg(log.alias("log"))
    text = F.aggregate(
        "log", F.array().cast("array<string>"),
        lambda parts, e: F.when(e["kind"].isin("edit", "regenerate"), F.array(e["text"]))
        .otherwise(F.concat(parts, F.array(e["text"]))),
        lambda parts: F.array_join(parts, ""),
    )
    role = F.coalesce(F.get(F.filter("log.role", lambda r: r.isNotNull()), F.lit(0)), F.lit(""))
    return folded.select("conv_id", "message", role.alias("role"), text.alias("text"))


def escape(text: Column, pattern: str = _CONTROL) -> Column:
    return F.regexp_replace(text, pattern, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\|###|</turn>|:)", "$1")


def render(messages: DataFrame) -> DataFrame:
    """``(conv_id, message, segment, loss_start, loss_chars)``; code points within the segment.

    The formatted conversation is its segments by message. The loss mask of a segment is the
    text of a learned turn, and empty otherwise.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role"), _ROLE_CONTROL), F.lit(": "))
    body = escape(F.col("text"))
    return messages.select(
        "conv_id", "message", F.concat(head, body, F.lit(CLOSE)).alias("segment"),
        F.length(head).alias("loss_start"),
        F.when(F.col("role") == LEARNED, F.length(body)).otherwise(0).alias("loss_chars"),
    )


def parse(segments: DataFrame) -> DataFrame:
    """``segments`` with role, text, loss (the unescaped text under the mask) and n_chars."""
    head, n = F.col("loss_start"), F.length("segment")
    body = F.col("segment").substr(head + 1, n - head - len(CLOSE))
    return segments.withColumns({
        "role": unescape(F.col("segment").substr(F.lit(len(OPEN) + 1), head - len(OPEN) - 2)),
        "text": unescape(body),
        "loss": unescape(F.col("segment").substr(head + 1, F.col("loss_chars"))),
        "n_chars": n.cast("long"),
    })


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation; its messages come in order, one after the other."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now, state = object(), None

    def close():
        n, turns, chars, loss, formatted = state
        return pa.RecordBatch.from_arrays([
            pa.array([now], pa.int64()), pa.array([n], pa.int64()),
            pa.array([turns.hexdigest()]), pa.array([chars], pa.int64()),
            pa.array([loss.hexdigest()]), pa.array([formatted], pa.int64()),
        ], names=names)

    for batch in batches:
        for conv, role, text, loss, n_chars in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or conv != now:
                if state is not None:
                    yield close()
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            state[2] += len(loss)
            state[3].update(loss.encode())
            state[4] += n_chars
    if state is not None:
        yield close()


def digest(segments: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest runs over the turns in order, so the parsed turns of a conversation stream through
    one task, which holds a batch of them at a time. conv_id must be an integer; the rows
    without one are one conversation.
    """
    arrow_limits(segments.sparkSession)
    parsed = parse(segments)
    return (
        parsed.select(F.col("conv_id").cast("long"), "message", "role", "text", "loss", "n_chars")
        .repartition("conv_id").sortWithinPartitions("conv_id", "message")
        .drop("message").mapInArrow(
            _digests,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
            " loss_sha256 string, formatted_chars long",
        )
    )
