"""Chat formatting: event-sourced conversations folded into messages and rendered.

A log holds events (conv_id, message, seq, kind, role, text).  Events of one
message are folded in the order of seq: ``message`` and ``edit`` set its text,
``delta`` appends to it, ``regenerate`` starts it anew, ``delete`` removes it.
The messages of a conversation are ordered and rendered into segments, one per
turn, that joined in order are the formatted conversation; the loss mask is a
span of each assistant segment.

Folding is spread by message.  Rendering numbers the code points of a whole
conversation, so its messages pass through one task in order, as a stream: the
task sorts on disk and holds one batch, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>\n"
_ESCAPE = re.compile(r"[\\#<]")
_ROLE_ESCAPE = re.compile(r"[\\#<:\n]")
_UNESCAPE = re.compile(r"\\(.)", re.S)
#: A segment: role and text without bare control characters.
_SEGMENT = re.compile(r"### ((?:[^\\#<:\n]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    """The text without bare control characters, so that no marker of the
    template can stand in it; ``unescape`` undoes it."""
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A turn's segment and the span of its text in it."""
    head = f"{HEAD}{_ROLE_ESCAPE.sub(lambda m: chr(92) + m[0], role)}: "
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _SEGMENT.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, seq, role, text) of the final messages of an event log.

    seq is the message's first; the role is that of its first event that names
    one; null texts are empty, null roles too if no event names one.  Events of
    equal seq are folded in the order of kind, then role, then text; a null seq
    comes first.  Unknown kinds do nothing.  A message of which only
    ``delete`` remains is gone; one with later events stays.
    """
    e = events.select("conv_id", "message", F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    log = e.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list("e")).alias("log"))
    sets = F.array_position(F.reverse(F.transform("log", lambda x: x["kind"].isin("message", "edit", "regenerate", "delete"))), True)
    log = log.withColumn("from", F.when(sets > 0, F.size("log") - sets + 1).otherwise(1).cast("int"))
    live = F.expr("slice(log, from, size(log))")
    text = F.array_join(F.transform(F.filter(live, lambda x: x["kind"].isin("message", "edit", "delta")), lambda x: x["text"]), "")
    gone = (F.size(live) == 1) & (F.element_at(live, 1)["kind"] == "delete")
    role = F.element_at(F.filter("log", lambda x: x["role"].isNotNull()), 1)["role"]
    return (log.where(~gone)
            .select("conv_id", "message", F.element_at("log", 1)["seq"].alias("seq"),
                    F.coalesce(F.when(F.size(F.filter("log", lambda x: x["role"].isNotNull())) > 0, role), F.lit("")).alias("role"),
                    text.alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """Segments (conv_id, turn, role, formatted, start, loss_start, loss_end) of
    folded messages, in partitions that hold whole conversations in order.

    turn counts from 0 in the order of seq, role, text (nulls first); start is
    the segment's first code point in the conversation; loss_start and loss_end
    are the span, in the conversation, of an assistant's text (null for others).
    Messages with a null conv_id form a conversation of their own.
    """
    kind = dict(messages.dtypes)["conv_id"]

    def run(batches):
        now, fresh, turn, at = None, True, 0, 0
        for b in batches:
            conv, role, text = b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist()
            turns, segs, starts, lo, hi = [], [], [], [], []
            for c, r, t in zip(conv.to_pylist(), role, text, strict=True):
                if fresh or c != now:
                    now, fresh, turn, at = c, False, 0, 0
                seg, a, z = segment(r or "", t or "")
                turns.append(turn)
                segs.append(seg)
                starts.append(at)
                mine = r == "assistant"
                lo.append(at + a if mine else None)
                hi.append(at + z if mine else None)
                turn, at = turn + 1, at + len(seg)
            yield pa.record_batch([conv, pa.array(turns, pa.int64()), b.column(1), pa.array(segs, pa.string()),
                                   pa.array(starts, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
                                  names=["conv_id", "turn", "role", "formatted", "start", "loss_start", "loss_end"])

    ordered = (messages.select("conv_id", "role", "text", "seq")
               .repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "seq", "role", "text")
               .select("conv_id", "role", "text"))
    return ordered.mapInArrow(run, f"conv_id {kind}, turn long, role string, formatted string, start long, loss_start long, loss_end long")


def digest(segments: DataFrame) -> DataFrame:
    """Facts of each conversation read back from ``render``'s segments, as a
    stream: conv_id, n_turns, turns_sha256 (role, line feed, text, line feed per
    turn), loss_chars and loss_sha256 (the unescaped text under the loss mask)
    and formatted_chars."""
    kind = dict(segments.dtypes)["conv_id"]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        now, state = None, None

        def done():
            return now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for b in batches:
            out = []
            for c, seg, start, lo, hi in zip(*[b.column(k).to_pylist() for k in range(5)], strict=True):
                if state is None or start == 0:
                    if state is not None:
                        out.append(done())
                    now, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_back(seg):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if lo is not None:
                    loss = unescape(seg[lo - start: hi - start])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(seg)
            if out:
                yield table(out)
        if state is not None:
            yield table([done()])

    def table(rows):
        cols = list(zip(*rows, strict=True))
        return pa.record_batch([pa.array(x) if any(v is not None for v in x) else pa.nulls(len(x), pa.int64()) for x in cols], names=names)

    return (segments.select("conv_id", "formatted", "start", "loss_start", "loss_end")
            .mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def turn_events(turns: DataFrame) -> DataFrame:
    """Events of a table of turns (conv_id, turn, role, text), one per row.
    Rows that repeat another stay messages of their own."""
    rows = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))))
    return rows.select("conv_id", F.struct("turn", F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("of"), "copy").alias("message"),
                       F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text")


def format_conversations(events: DataFrame) -> DataFrame:
    """Segments of all conversations of an event log: ``render`` of ``fold``."""
    return render(fold(events))
