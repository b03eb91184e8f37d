"""Chat formatting by event-sourced reconstruction.

A log of events is folded into final messages: events are dealt by (conversation, message), sorted by sequence, and
streamed deltas, edits and regenerations are applied in order, one message in memory at a time. Messages are then
rendered: turn marks around each, control strings inside texts escaped reversibly, and the span of each assistant
text under the loss mask. A conversation is stored as one segment per message, so none has to fit one cell; reading
it back streams its segments in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

#: The template's control strings.
START, END = "<|im_start|>", "<|im_end|>\n"
EVENTS = "conv_id bigint, seq bigint, message_id string, step int, kind string, role string, text string"


def message_events(turns: DataFrame) -> DataFrame:
    """Log of a table of finished turns (conv_id, turn, role, text): each opens a message and streams its text in two
    deltas. Rows that repeat are messages of their own; null role and text count as empty."""
    same = turns.select("conv_id", F.col("turn").alias("seq"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text")).groupBy("conv_id", "seq", "role", "text").count()
    copies = same.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    ids = F.concat_ws("/", F.coalesce(F.col("seq").cast("string"), F.lit("-")), F.col("role"), F.sha2("text", 256), F.lpad(F.col("copy").cast("string"), 10, "0"))
    half = F.floor(F.length("text") / 2).cast("int")
    event = lambda step, kind, role, text: F.struct(
        F.lit(step).alias("step"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))
    none = F.lit(None).cast("string")
    events = F.array(event(0, "open", F.col("role"), none),
                     event(1, "delta", none, F.substring(F.col("text"), F.lit(1), half)),
                     event(2, "delta", none, F.substring(F.col("text"), half + 1, F.length("text"))))
    return copies.select("conv_id", "seq", ids.alias("message_id"), F.explode(events).alias("e")).select(
        "conv_id", "seq", "message_id", "e.step", "e.kind", "e.role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, position, message_id, role, text) of an event log (columns of ``EVENTS``).

    Events of a message apply in order of (seq, step, kind, text), null seq first: ``open`` names the role, ``delta`` appends,
    ``edit`` replaces the text so far, ``regenerate`` drops it so that later deltas build it anew, ``retract``
    removes the message, ``open`` after that restores it empty. Other kinds change nothing. A message stands where its
    first event stands. Null texts append nothing; a message never opened has an empty role. No events, no messages.
    """
    keys = ["conv_id", "message_id"]
    ship(events.sparkSession)
    dealt = events.select("conv_id", "message_id", "seq", "step", "kind", "role", "text")
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "seq", "step", "kind", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []

        def close():
            if state is not None and state["alive"]:
                done.append((state["conv"], state["seq"], state["id"], state["role"] or "", "".join(state["parts"])))

        for batch in batches:
            for conv, mid, seq, _, kind, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if state is None or (state["conv"], state["id"]) != (conv, mid):
                    close()
                    state = {"conv": conv, "id": mid, "seq": seq, "role": None, "parts": [], "alive": True}
                if kind == "open":
                    state["role"], state["alive"] = role if state["role"] is None else state["role"], True
                elif kind == "delta":
                    state["parts"].append(text or "")
                elif kind == "edit":
                    state["parts"] = [text or ""]
                elif kind == "regenerate":
                    state["parts"] = []
                elif kind == "retract":
                    state["parts"], state["alive"] = [], False
            if done:
                yield _batch(done)
                done.clear()
        close()
        if done:
            yield _batch(done)

    return dealt.mapInArrow(run, "conv_id bigint, position bigint, message_id string, role string, text string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "position", "message_id", "role", "text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def escaped(text: Column) -> Column:
    """One backslash more between ``<`` and ``|``: no control string remains, and one less gives the text again."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", lambda m: f"<{m[1]}|", text)


def escaped_role(role: Column) -> Column:
    """Also keeps a role on its line."""
    one_line = F.regexp_replace(F.regexp_replace(role, r"\\", r"\\\\"), "\n", r"\\n")
    return escaped(one_line)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One segment per message: (conv_id, position, message_id, segment, loss_start, loss_chars).

    ``segment`` is ``<|im_start|>role\\ntext<|im_end|>\\n``; the loss span (code points within the segment) covers the
    escaped text of ``loss_role``'s messages, else it is null. A conversation's formatted text is its segments in
    order of (position, message_id), null position first.
    """
    role, text = escaped_role(F.col("role")), escaped(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    loss = F.col("role") == loss_role
    return messages.select("conv_id", "position", "message_id", F.concat(head, text, F.lit(END)).alias("segment"),
                           F.when(loss, F.length(head)).alias("loss_start"), F.when(loss, F.length(text)).alias("loss_chars"))


def formatted(segments: DataFrame) -> DataFrame:
    """Whole conversations (conv_id, text), for those that fit a cell."""
    parts = F.array_sort(F.collect_list(F.struct("position", "message_id", "segment")))
    return segments.groupBy("conv_id").agg(F.concat_ws("", F.transform(parts, lambda s: s["segment"])).alias("text"))


def read_back(segments: DataFrame) -> DataFrame:
    """Parses segments: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) per conversation.

    Streams each conversation's segments in order; memory holds one segment and two running digests.
    """
    ship(segments.sparkSession)
    dealt = (segments.select("conv_id", "position", "message_id", "segment", "loss_start", "loss_chars").repartition("conv_id")
             .sortWithinPartitions("conv_id", "position", "message_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        state, done = None, []

        def close():
            if state is not None:
                done.append((state["conv"], state["turns"], state["all"].hexdigest(), state["loss"], state["under"].hexdigest(), state["chars"]))

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done.clear()
            return batch

        for batch in batches:
            for conv, _, _, segment, start, size in zip(*[c.to_pylist() for c in batch.columns]):
                if state is None or state["conv"] != conv:
                    close()
                    state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": 0, "under": hashlib.sha256(), "chars": 0}
                role, text = parse(segment)
                state["turns"] += 1
                state["chars"] += len(segment)
                state["all"].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    under = unescaped(segment[start:start + size])
                    state["loss"] += len(under)
                    state["under"].update(under.encode())
            if done:
                yield out()
        close()
        if done:
            yield out()

    return dealt.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                 "loss_sha256 string, formatted_chars bigint")


def parse(segment: str) -> tuple[str, str]:
    """Role and text of one segment."""
    if not segment.startswith(START) or not segment.endswith(END):
        raise ValueError("not a rendered segment")
    role, _, text = segment[len(START):-len(END)].partition("\n")
    return unescaped_role(role), unescaped(text)
