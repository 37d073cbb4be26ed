"""Chat formatting: conversations rebuilt from an event log, then rendered.

Method.  The log has events (conv_id, msg, seq, op, role, text).  Events are
grouped by conversation and message, sorted by sequence and folded: ``open`` and
``regenerate`` start a message's text anew, ``edit`` replaces it, ``delta``
appends to it, ``delete`` removes the message.  Messages then are in order of
their first sequence number, and each is rendered with the marks of a template.

Template.  A conversation starts with ``<s>``; turns are
``[INST] text [/INST]`` (user), ``[ANS] text </s>`` (assistant),
``<<SYS>> text <</SYS>>`` (system) and ``[ROLE] "role" text [/ROLE]`` (any other
role, as JSON).  Control strings inside texts are escaped by a backslash, and
backslashes before them are doubled, so the text comes back exactly.  The loss
mask marks the assistant texts, as code point ranges.

Output.  Rows (conv_id, piece, formatted, loss): a conversation is one string, or
several pieces cut between turns where it is longer than ``PIECE`` code points.
A conversation of any length is rendered as a stream: a task holds one message
and one piece.  Folding is by message, so a long conversation folds in many tasks.

Nulls and the like: a null text is empty, a null role is its own role, a null
conversation id is one conversation.  An event that repeats another in every
column counts once (a log may be delivered twice); events of equal sequence go by
op, then text, then role.  Events of a null sequence come first.  Without events
there are no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import arrow_map

PIECE = 1_000_000

#: The control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ANS]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
_ANY = "|".join(re.escape(c) for c in CONTROLS)
_BARE, _ESCAPED = re.compile(rf"(\\*)({_ANY})"), re.compile(rf"(\\+)({_ANY})")
_MARK = re.compile(rf"(?<!\\)(?:{_ANY})")
_TURN = {"user": ("[INST] ", " [/INST]"), "assistant": ("[ANS] ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
_OPENS = {marks[0].strip(): (role, marks[1].strip()) for role, marks in _TURN.items()}
_PIECES = "conv_id long, piece int, formatted string, loss array<struct<start:long,length:long>>"


def escape(text: str) -> str:
    return _BARE.sub(lambda m: "\\" * (2 * len(m[1]) + 1) + m[2], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" * ((len(m[1]) - 1) // 2) + m[2], text)


def render(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A turn, and where in it the escaped text starts and how long it is."""
    body = escape(text or "")
    if role in _TURN:
        head, tail = _TURN[role]
    else:
        head, tail = f"[ROLE] {escape(json.dumps(role, ensure_ascii=False))} ", " [/ROLE]"
    return head + body + tail, len(head), len(body)


def parse(formatted: str) -> Iterator[tuple[str | None, str]]:
    """The (role, text) turns of a formatted string."""
    at = 0
    while (m := _MARK.search(formatted, at)) is not None:
        at = m.end()
        if m[0] == "<s>":
            continue
        role, close = _OPENS.get(m[0], (None, "[/ROLE]"))
        end = _MARK.search(formatted, at)
        if end is None or end[0] != close or m[0] not in (*_OPENS, "[ROLE]"):
            raise ValueError(f"broken turn at {m.start()}")
        body = formatted[at + 1:end.start() - 1]
        if m[0] == "[ROLE]":
            name, size = _json_head(body)
            role, body = json.loads(unescape(name)), body[size + 1:]
        yield role, unescape(body)
        at = end.end()


def _json_head(body: str) -> tuple[str, int]:
    m = re.match(r'null|"(?:[^"\\]|\\.)*"', body)
    return m[0], m.end()


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, seq, msg, role, text) of the messages left by the log."""
    starts = F.array(F.lit("open"), F.lit("regenerate"), F.lit("edit"))
    log = (events.groupBy("conv_id", "msg")
           .agg(F.sort_array(F.collect_set(F.struct("seq", "op", F.coalesce("text", F.lit("")).alias("text"), "role"))).alias("log")))
    index = F.sequence(F.lit(0), F.size("log") - 1)
    reset = F.array_max(F.transform(index, lambda i: F.when(F.array_contains(starts, F.element_at("log", i + 1)["op"]), i).otherwise(0)))
    live = F.slice("log", F.col("reset") + 1, F.size("log"))
    opened = F.filter("log", lambda e: e["op"] == "open")
    return (log.withColumn("reset", reset).withColumn("live", live)
            .where(~F.exists("live", lambda e: e["op"] == "delete"))
            .select("conv_id", F.element_at("log", 1)["seq"].alias("seq"), "msg", F.try_element_at(opened, F.lit(-1))["role"].alias("role"),
                    F.array_join(F.transform("live", lambda e: e["text"]), "").alias("text")))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, started, piece, parts, loss, size = None, False, 0, [], [], 0

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([piece], pa.int32()), pa.array(["".join(parts)], pa.string()),
             pa.array([loss], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))], ["conv_id", "piece", "formatted", "loss"])

    for batch in batches:
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if not started or key != conv:
                if started:
                    yield out()
                conv, started, piece, parts, loss, size = key, True, 0, ["<s>"], [], 3
            elif size >= PIECE:
                yield out()
                piece, parts, loss, size = piece + 1, [], [], 0
            turn, start, length = render(role, text)
            if role == "assistant":
                loss.append({"start": size + start, "length": length})
            parts.append(turn)
            size += len(turn)
    if started:
        yield out()


def format_conversations(messages: DataFrame) -> DataFrame:
    """Formatted conversations, rows of one conversation together and in order."""
    by = ["conv_id", "seq", "msg"]
    return arrow_map(messages.select(*by, F.col("role"), F.col("text")).repartition("conv_id").sortWithinPartitions(*by), _format, _PIECES)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, names = None, None, [c.split()[0] for c in _DIGEST.split(", ")]

    def out():
        turns, all_turns, chars, lost, total = state
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
            [conv, turns, all_turns.hexdigest(), chars, lost.hexdigest(), total],
            [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])], names)

    for batch in batches:
        for key, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
            if state is None or key != conv:
                if state is not None:
                    yield out()
                conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, body in parse(text):
                state[0] += 1
                state[1].update(f"{role or ''}\n{body}\n".encode("utf-8", "surrogatepass"))
            for span in loss:
                body = unescape(text[span["start"]:span["start"] + span["length"]])
                state[2] += len(body)
                state[3].update(body.encode("utf-8", "surrogatepass"))
            state[4] += len(text)
    if state is not None:
        yield out()


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and hashes read back from ``format_conversations``: turns from the
    marks, loss text from the mask.  Pieces must still be in its order."""
    return arrow_map(formatted, _digest, _DIGEST)
