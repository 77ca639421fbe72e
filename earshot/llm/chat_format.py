r"""Conversations as training text, one example per assistant turn.

A turn is written `<|im_start|>role`, a newline, its text, `<|im_end|>` and a newline. Inside texts and roles a backslash
goes between `<` and `|` wherever they meet, and one more where backslashes already stand between them; so no text can
forge a mark, and taking one backslash away gives the text back. A newline in a role is written `<nl>`, and `<nl>` itself likewise escaped.

Every assistant turn becomes an example: all turns before it are its context, and only its own text is trained. Contexts
of one conversation are prefixes of each other, so they travel front-coded: an example's row holds what it adds to
the example before (the turns since, and the reply). `expanded` makes the whole examples of them, whose size grows with the
square of a conversation's turns; the front-coded form grows with the turns alone. `example_digests` reads whole examples,
`conversation_digests` front-coded ones.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import text_batches, trim
from earshot.sources.snapshots import settle

START, END, REPLY = "<|im_start|>", "<|im_end|>\n", "assistant"
PIECE_CHARS = 1 << 20  # a longer context is handed on in rows of about this size
HELD_CHARS = 4 << 20  # of one conversation while it is read back in one place
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.regexp_replace(role, r"<(\\*)(\||nl>)", r"<\\$1$2"), F.lit("\n"), F.lit("<nl>"))


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"<\\(\\*)(\||nl>)", r"<\1\2", role.replace("<nl>", "\n"))


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, piece (the turn as written), head (code points before its text), body (of its text, -1: no reply), in order."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    head, body = F.concat(F.lit(START), escaped_role(of(role)), F.lit("\n")), escaped(of(text))
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(of(role), of(text)).alias("tie"), F.concat(head, body, F.lit(END)).alias("piece"),
        F.char_length(head).alias("head"), F.when(of(role) == REPLY, F.char_length(body)).otherwise(-1).alias("body"),
    )
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "tie")]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "piece", "head", "body")


def prefix_examples(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The examples of every conversation, front-coded: conv_id, example, text, n_turns, loss_start, loss_end.

    `text` is what the row adds, n_turns the turns in it, and loss_start to loss_end (code points in `text`, end exclusive) the
    reply that is trained. `example` ascends in a conversation and has no other meaning. A row without a span is
    context only: the turns after the last reply, or a part of a very long context. So a conversation's rows in order
    hold each of its turns once, and an example is all rows up to its own with the one span of its own.

    Turns are ordered by `turn` (null first), ties by a hash of role and text; null roles and texts count as empty, repeated rows stay, and rows
    without conv_id are one conversation. Only a role that is exactly `assistant` replies; an empty reply has an empty span. Other
    columns are not read. Rows are range-partitioned by conversation and turn, so a conversation that holds most rows is spread over
    tasks; a task holds one row's text. No rows give no rows.
    """
    rows = _turns(conversations, conv_id, turn, role, text)
    names = ["conv_id", "example", "text", "n_turns", "loss_start", "loss_end"]

    def run(batches):
        number, held, size, at, types, done, out = TaskContext.get().partitionId() << 33, [], 0, None, None, [], 0

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

        for batch in chain(text_batches(batches, 1), [None]):
            if batch is not None and types is None:
                types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            for conv, piece, head, body in [(None, None, 0, -1)] if batch is None else zip(*[c.to_pylist() for c in batch.columns]):
                if held and (piece is None or conv != at or size > PIECE_CHARS):
                    done.append([at, number, "".join(held), len(held), None, None])
                    number, held, size, out = number + 1, [], 0, out + size
                if piece is not None:
                    held.append(piece)
                    at, size = conv, size + len(piece)
                    if body >= 0:
                        start = size - len(piece) + head
                        done.append([at, number, "".join(held), len(held), start, start + body])
                        number, held, size, out = number + 1, [], 0, out + size
                if done and (piece is None or out > PIECE_CHARS):
                    yield emit()
                    done, out = [], 0
        trim()

    key = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {key}, example long, text string, n_turns long, loss_start long, loss_end long")


def expanded(examples: DataFrame, *, tails: bool = False) -> DataFrame:
    """Each example whole: conv_id, example, text (context and reply), n_turns, loss_start, loss_end (code points in `text`).

    One row per assistant turn. With `tails`, a conversation that goes on after its last reply, or has none, ends with a row without a span, all of
    it as context. A task holds one example at a time, and as many as fit in a batch of a megabyte; a conversation's rows come
    in order, out of one task.
    """
    names = ["conv_id", "example", "text", "n_turns", "loss_start", "loss_end"]
    rows = examples.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "example")

    def run(batches):
        at, before, turns, last, done, out, types = object(), "", 0, None, [], 0, None
        for batch in chain(text_batches(batches, 2), [None]):
            types = batch.schema.types if batch is not None else types
            for conv, number, text, n, start, end in [(object(), None, "", 0, None, None)] if batch is None else zip(*[c.to_pylist() for c in batch.columns]):
                if conv != at:
                    if tails and last is not None:
                        done.append([at, last, before, turns, None, None])
                        out += len(before)
                    at, before, turns = conv, "", 0
                if start is not None:
                    done.append([conv, number, before + text, turns + n, len(before) + start, len(before) + end])
                    out += len(before) + len(text)
                before, turns, last = before + text, turns + n, number if start is None else None
                if done and (out > PIECE_CHARS or batch is None):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
                    done, out = [], 0
        trim()

    return rows.mapInArrow(run, rows.schema)


class _Reader:
    """What stands in the rows of one conversation, read in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.examples = self.expanded = 0

    def read(self, text: str, n_turns: int, start: int | None, end: int | None) -> None:
        at = 0
        for found in TURN.finditer(text):
            if found.start() != at:
                break
            self.turns.update(f"{unescaped_role(found[1])}\n{unescaped(found[2])}\n".encode())
            self.n_turns, n_turns, at = self.n_turns + 1, n_turns - 1, found.end()
        if at != len(text) or n_turns:
            raise ValueError("a row that does not hold whole turns")
        self.chars += len(text)
        if start is not None:
            reply = unescaped(text[start:end])
            self.loss.update(reply.encode())
            self.loss_chars, self.examples, self.expanded = self.loss_chars + len(reply), self.examples + 1, self.expanded + self.chars

    def row(self) -> list:
        return [self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.examples, self.expanded]


FOUND = {"n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64(), "n_examples": pa.int64(), "expanded_chars": pa.int64()}
FOUND_SCHEMA = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long, expanded_chars long"


def _read_in_place(examples: DataFrame) -> DataFrame:
    """The conversations that lie whole inside a partition, read, and the rows of the others as they are.

    Rows of `prefix_examples` are in order in their partitions. The first and last conversation of a partition may go on in its neighbours; so
    may one that is too long to be held, whose rows are then handed on, too.
    """
    columns = ["conv_id", "example", "text", "n_turns", "loss_start", "loss_end"]
    rows = examples.select(*columns)

    def run(batches):
        types, at, held, size, whole, read, left = None, None, [], 0, False, [], []

        def emit():
            gone, kept = [[r[0]] + r[1:] for r in read], [[r[0]] + [None] * len(FOUND) + list(r[1:]) for r in left]
            full = [r + [None] * 5 for r in gone] + kept
            names = ["conv_id", *FOUND, "example", "text", "part_turns", "loss_start", "loss_end"]
            kinds = [types[0], *FOUND.values(), *types[1:]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*full), kinds)], names=names)

        for batch in chain(text_batches(batches, 2), [None]):
            if types is None and batch is not None:
                types, at = batch.schema.types, batch.column(0)[0].as_py()
            for row in [] if batch is None else zip(*[c.to_pylist() for c in batch.columns]):
                if row[0] != at:
                    if whole:
                        reader = _Reader()
                        for r in held:
                            reader.read(*r[2:])
                        read.append([at, *reader.row()])
                    else:
                        left.extend(held)
                    at, held, size, whole = row[0], [], 0, True
                held.append(row)
                size += len(row[2])
                if size > HELD_CHARS or (not whole and size > PIECE_CHARS):
                    left.extend(held)
                    held, size, whole = [], 0, False
                if len(read) > 5_000 or left:
                    yield emit()
                    read, left = [], []
        left.extend(held)
        if read or left:
            yield emit()
        trim()

    key = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {key}, {FOUND_SCHEMA}, example long, text string, part_turns long, loss_start long, loss_end long")


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, parsed out of its examples (as `prefix_examples` gives them): conv_id, n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars, loss_sha256
    (of all text under the spans, in order), formatted_chars (of the stored rows), n_examples, expanded_chars (of all examples whole).

    Marks are parsed and escapes undone. Only conversations at the edges of partitions, and very long ones, are shuffled again.
    """
    place = settle(_read_in_place(examples), "read")
    read = place.filter("text IS NULL").select("conv_id", *FOUND)
    rest = place.filter("text IS NOT NULL").select("conv_id", "example", "text", "part_turns", "loss_start", "loss_end")
    rest = rest.repartition("conv_id").sortWithinPartitions("conv_id", "example")

    def run(batches):
        at, reader, kind, done = None, None, None, []

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), [kind, *FOUND.values()])], names=["conv_id", *FOUND])

        for batch in text_batches(batches, 2):
            kind = batch.schema.types[0]
            for conv, _, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if reader is None or conv != at:
                    if reader is not None:
                        done.append([at, *reader.row()])
                    at, reader = conv, _Reader()
                reader.read(*row)
            if len(done) > 5_000:
                yield emit()
                done = []
        if reader is not None:
            done.append([at, *reader.row()])
            yield emit()
        trim()

    return read.unionByName(rest.mapInArrow(run, read.schema))


def example_digests(whole: DataFrame) -> DataFrame:
    """The columns of `conversation_digests`, read back from whole examples as `expanded` gives them with `tails`.

    Every example is read: its context must be the conversation as the example before left it, and goes on from there. The rows
    must be those of `expanded` itself, where a conversation's are in order in one task; they are digested as they come, and neither
    shuffled nor written.
    """
    rows = whole.select("conv_id", "example", "text", "n_turns", "loss_start", "loss_end")

    def run(batches):
        at, reader, before, turns, kind, done = None, None, "", 0, None, []

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), [kind, *FOUND.values()])], names=["conv_id", *FOUND])

        for batch in text_batches(batches, 2):
            kind = batch.schema.types[0]
            for conv, _, text, n, start, end in zip(*[c.to_pylist() for c in batch.columns]):
                if reader is None or conv != at:
                    if reader is not None:
                        done.append([at, *reader.row()])
                    at, reader, before, turns = conv, _Reader(), "", 0
                if not text.startswith(before) or (start is not None and start < len(before)):
                    raise ValueError("an example that does not go on from the one before")
                span = (None, None) if start is None else (start - len(before), end - len(before))
                reader.read(text[len(before) :], n - turns, *span)
                before, turns = text, n
            if len(done) > 5_000:
                yield emit()
                done = []
        if reader is not None:
            done.append([at, *reader.row()])
        if done:
            yield emit()
        trim()

    key = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {key}, {FOUND_SCHEMA}")
