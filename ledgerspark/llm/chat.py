"""Conversations rebuilt from event logs, rendered as training text and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.shared import map_slices

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that some chat template reads as control; inside texts all are escaped.
CONTROL = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: First character, any number of backslashes, and the rest of a control string.
_RESTS = "|".join(re.escape(c[1:]) for c in CONTROL)
MARKED = rf"([<\[])(\\*)({_RESTS})"
SEGMENT = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*){re.escape(END)}\n", re.DOTALL)


def escaped(c: Column) -> Column:
    """Put one more backslash into every control string; ``unescape`` takes it out again.

    No control string is left as such, and since a string that already holds backslashes
    gets one more, two texts never become the same.
    """
    return F.regexp_replace(c, MARKED, r"$1\\$2$3")


def unescape(text: str) -> str:
    return re.sub(MARKED, lambda m: m[1] + m[2][1:] + m[3], text)


def unescape_role(text: str) -> str:
    return unescape(re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", text))


def fold_events(events: DataFrame) -> DataFrame:
    """Messages from a log with columns conv, seq, kind, message, role, text.

    ``kind`` is ``message`` (a whole text), ``delta`` (adds to the text), ``edit`` (replaces it) or
    ``regenerate`` (empties it, deltas follow). Events of one message are folded in the
    order of seq, nulls first; ties by kind, text, role. A message stands where its first event
    stands and has the last role that is not null. Events without a message id are messages
    of their own. Null text is empty; other kinds change nothing. Returns conv, seq, role, text.

    Logs are dealt out by conversation and message, so a long conversation is folded in many
    tasks, and streamed in order. A task holds the deltas of one message, which are
    joined once, when the message ends.
    """
    text = F.coalesce("text", F.lit(""))
    alone = events.where(F.col("message").isNull() & F.col("kind").isin("message", "edit", "delta"))
    alone = alone.select("conv", "seq", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    log = events.where(F.col("message").isNotNull())
    log = log.select("conv", "message", "seq", "kind", text.alias("text"), "role")
    ordered = log.repartition("conv", "message").sortWithinPartitions(*log.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, seq, role, parts, types = None, None, None, [], None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(types, zip(*rows, strict=True), strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for t, c in columns], names=["conv", "seq", "role", "text"]
            )

        for batch in batches:
            field = batch.schema.field
            types = [field("conv").type, field("seq").type, pa.string(), pa.string()]
            out = []
            for e in batch.to_pylist():
                key = (e["conv"], e["message"])
                if key != of:
                    if of is not None:
                        out.append((of[0], seq, role or "", "".join(parts)))
                    of, seq, role, parts = key, e["seq"], None, []
                if e["role"] is not None:
                    role = e["role"]
                if e["kind"] in ("message", "edit", "regenerate"):
                    parts = []
                if e["kind"] in ("message", "edit", "delta"):
                    parts.append(e["text"])
            if out:
                yield batch_of(out)
        if of is not None:
            yield batch_of([(of[0], seq, role or "", "".join(parts))])

    conv, seq = (log.schema[c].dataType.simpleString() for c in ("conv", "seq"))
    return alone.unionByName(map_slices(ordered, run, f"conv {conv}, seq {seq}, role string, text string"))


#: Code points of a delta in a log made from whole turns.
DELTA = 200


def event_log(turns: DataFrame) -> DataFrame:
    """The log of events that writes the turns conv, turn, role, text; see ``fold_events``.

    A hash of conversation and turn decides how a turn comes about: streamed in deltas of DELTA
    code points, as a draft that an edit replaces, or as a draft that is regenerated in
    deltas. Folded, the log gives the turns again. Every row is a message of its own: rows of
    one conversation and turn are numbered by role and text. seq is the turn and
    the step in its log. Null text is empty.
    """
    text = F.coalesce("text", F.lit(""))
    same = Window.partitionBy("conv", "turn").orderBy("role", "text")
    way = F.pmod(F.xxhash64("conv", "turn"), F.lit(3))
    rows = turns.select(
        "conv", "turn", "role", text.alias("text"), way.alias("way"),
        F.concat_ws(".", F.col("turn").cast("string"), F.row_number().over(same)).alias("message"),
    )

    def event(kind: str, text: Column, role: Column | None = None) -> Column:
        role = F.lit(None).cast("string") if role is None else role
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), role.alias("role"))

    def opened(text: Column) -> Column:
        return event("message", text, F.col("role"))

    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))
    deltas = F.transform(pieces, lambda piece: event("delta", piece))
    draft = F.concat(F.lit("draft "), F.col("message"))
    streamed = F.concat(F.array(opened(F.lit(""))), deltas)
    edited = F.array(opened(draft), event("edit", F.col("text")))
    again = F.concat(F.array(opened(draft), event("regenerate", F.lit(""))), deltas)
    steps = F.when(F.col("way") == 0, streamed).when(F.col("way") == 1, edited).otherwise(again)
    log = rows.select("conv", "turn", "message", F.posexplode(steps).alias("step", "event"))
    return log.select("conv", F.struct("turn", "step").alias("seq"), "message", "event.*")


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Segments of the formatted conversations from columns conv, seq, role, text.

    One row per turn: conv, segment, start (code points of the conversation before it), loss_start
    and loss_end (the span of the segment under the loss mask; null for other roles). A
    formatted conversation is its segments in a row. Turns are ordered by seq, nulls first, then
    role and text, so ties and repeated rows have one defined result. Null role is empty.

    Escaping happens before the shuffle. A conversation is then streamed through its task in
    order, so one that holds a third of all rows takes time there but no memory.
    """
    role = F.coalesce("role", F.lit(""))
    name = F.regexp_replace(F.regexp_replace(escaped(role), r"\\", r"\\\\"), "\n", r"\\n")
    body = escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), name, F.lit("\n"))
    spoken = role == F.lit(loss_role)
    rows = messages.select(
        "conv", "seq", role.alias("role"), body.alias("body"),
        F.concat(head, body, F.lit(f"{END}\n")).alias("segment"),
        F.when(spoken, F.length(head)).cast("long").alias("loss_start"),
        F.when(spoken, F.length(head) + F.length(body)).cast("long").alias("loss_end"),
    )
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "seq", "role", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, start = object(), 0
        for batch in batches:
            starts = []
            for conv, segment in zip(*(batch[c].to_pylist() for c in ("conv", "segment")), strict=True):
                if conv != current:
                    current, start = conv, 0
                starts.append(start)
                start += len(segment)
            names = ["conv", "segment", "start", "loss_start", "loss_end"]
            columns = {c: pa.array(starts, pa.int64()) if c == "start" else batch[c] for c in names}
            yield pa.RecordBatch.from_pydict(columns)

    kind = rows.schema["conv"].dataType.simpleString()
    return map_slices(
        ordered, run, f"conv {kind}, segment string, start long, loss_start long, loss_end long"
    )


def read_back(segments: DataFrame, in_order: bool = False) -> DataFrame:
    """Digests of what the rendered segments say, in the order of their starts.

    Returns conv, n_turns, turns_sha256 (role, line feed, text, line feed per turn), loss_chars and loss_sha256
    (unescaped text under the loss mask), formatted_chars. ``segments`` is the result of
    ``render``, from a table too. With ``in_order`` it comes straight from ``render`` and is not
    shuffled again. A segment that does not go on where the last one ended is an error.
    """
    if not in_order:
        segments = segments.repartition("conv").sortWithinPartitions("conv", "start")

    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, kind = None, None

        def finished(x: list) -> tuple:
            return x[0], x[1], x[2].hexdigest(), x[3], x[4].hexdigest(), x[5]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c) for c in zip(*rows, strict=True)]
            return pa.RecordBatch.from_arrays([columns[0].cast(kind), *columns[1:]], names=names)

        for batch in batches:
            kind, out = batch.schema.field("conv").type, []
            for row in batch.to_pylist():
                if row["start"] == 0:
                    if state is not None:
                        out.append(finished(state))
                    state = [row["conv"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                elif state is None or (row["conv"], row["start"]) != (state[0], state[5]):
                    raise ValueError(f"conversation {row['conv']!r}: segments are missing or out of order")
                segment = row["segment"]
                role, text = SEGMENT.fullmatch(segment).groups()
                state[1] += 1
                state[2].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
                if row["loss_start"] is not None:
                    spoken = unescape(segment[row["loss_start"] : row["loss_end"]])
                    state[3] += len(spoken)
                    state[4].update(spoken.encode())
                state[5] += len(segment)
            if out:
                yield batch_of(out)
        if state is not None:
            yield batch_of([finished(state)])

    kind = segments.schema["conv"].dataType.simpleString()
    return map_slices(
        segments, run,
        f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )
