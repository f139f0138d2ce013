"""Conversations as training text: one template, one encoding, and a loss mask aligned by offsets.

A turn of a user is `[INST]text[/INST]`, one of the assistant `<s>text</s>`, one of any other role `<s>[INST]role[/INST]text</s>`. These
four strings are control tokens. Where a text or role holds one, a backslash is put behind its bracket, one more if there are some
already, so that unescaping gives back every text, and no text can open or close a turn.

Conversations are rendered whole and encoded once. Tokens tile the bytes of the rendering; the mask is found by intersecting the
sorted spans of the assistant's texts with the tokens' offsets by binary search, and kept as token ranges. A token that reached across
a span's border would have no loss; control tokens at all borders see to it that there is none. Output rows hold token ids and ranges
only, and all that is told about a conversation is read back from them.

Turns are range-sorted by conversation and turn, so a conversation of any length is spread over the ranges it fills, and cut between
turns into output rows of about PART characters; as control tokens part the turns, the pieces' ids are those of the whole. Its output rows
are streamed in order when read back, and never held together.

Defined results: a null text or role is empty. Turns that share a number stand in the order of role, then of a hash of the text; a null
turn is the first; repeated rows are turns of their own. Rows without conv_id form one conversation. A very long text is one
output row, encoded in chunks. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tallyline.llm import tokens
from tallyline.llm.store import written

PART = 1 << 20
USER, ASSISTANT = "user", "assistant"
OPEN, CLOSE, BEGIN, END = CONTROL = ("[INST]", "[/INST]", "<s>", "</s>")
_PLAIN = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns (role, text), and the character spans of the assistant's texts in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        text = escape(text)
        if role == USER:
            before, after = OPEN, CLOSE
        elif role == ASSISTANT:
            before, after = BEGIN, END
            spans.append((at + len(before), at + len(before) + len(text)))
        else:
            before, after = BEGIN + OPEN + escape(role) + CLOSE, END
        out += [before, text, after]
        at += len(before) + len(text) + len(after)
    return "".join(out), spans


def byte_spans(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """Ascending character spans as byte spans."""
    out, chars, size = [], 0, 0
    for edge in (e for span in spans for e in span):
        size += len(text[chars:edge].encode())
        chars = edge
        out.append(size)
    return np.array(out, np.int64).reshape(-1, 2)


def masked(ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Ranges [first, last) of the tokens that lie within each span, by binary search in the tokens' offsets."""
    starts = np.concatenate(([0], ends[:-1]))
    first, last = np.searchsorted(starts, spans[:, 0]), np.searchsorted(ends, spans[:, 1], side="right")
    return np.stack((first, np.maximum(first, last)), axis=1)


def encoded(turns: list[tuple[str, str]], folder: str = tokens.FOLDER) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the rendered turns, and the loss mask as token ranges."""
    words = tokens.byte_level(folder, CONTROL)
    text, spans = rendered(turns)
    ids = words.encode(text)
    return ids, masked(words.ends(ids), byte_spans(text, spans))


def turns_of(ids: np.ndarray, folder: str = tokens.FOLDER) -> Iterator[tuple[str, str]]:
    """Read turns (role, text) back from token ids."""
    words = tokens.byte_level(folder, CONTROL)
    low = min(words.control.values())
    marks = np.flatnonzero(ids >= low)
    kinds = [words.parts[k].decode() for k in ids[marks].tolist()]

    def between(k: int) -> str:
        return unescape(words.joined(ids[marks[k] + 1 : marks[k + 1]]).decode())

    k = 0
    while k < len(marks):
        if kinds[k] == OPEN:
            role, shape = USER, [OPEN, CLOSE]
        elif kinds[k + 1] == OPEN:
            role, shape = between(k + 1), [BEGIN, OPEN, CLOSE, END]
        else:
            role, shape = ASSISTANT, [BEGIN, END]
        if kinds[k : k + len(shape)] != shape:
            raise ValueError(f"turn of {role!r} is not closed")
        yield role, between(k + len(shape) - 2)
        k += len(shape)


def format_conversations(conversations: DataFrame, folder: str = tokens.FOLDER, part: int = PART) -> DataFrame:
    """Write the encoded conversations: conv_id, task and nth (the order of a conversation's parts), whole (no other part), ids and
    loss (first token, end token, first, end, ...)."""
    kind = conversations.schema["conv_id"].dataType
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    order = ["conv_id", "turn", "role", "hash"]
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("hash", F.xxhash64("text"))
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    fields = T.StructType.fromDDL("task int, nth int, whole boolean, ids array<int>, loss array<int>").fields
    schema = T.StructType([T.StructField("conv_id", kind), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, id_type = TaskContext.get().partitionId(), pa.null()
        now, held, size, nth, inner = None, [], 0, 0, False

        def out(whole: bool) -> pa.RecordBatch:
            ids, loss = encoded(held, folder)
            row = [now[0]], [task], [nth], [whole], [ids.astype(np.int32)], [loss.ravel().astype(np.int32)]
            types = id_type, pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types, strict=True)], schema.names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and (key != now[0] or size > part):
                    # the first and the last conversation of a range may go on in others
                    yield out(inner and nth == 0 and key != now[0])
                    inner, nth, held, size = (True, 0, [], 0) if key != now[0] else (inner, nth + 1, [], 0)
                now = (key,)
                held.append((role, text))
                size += len(text)
        if now is not None:
            yield out(False)

    return written(turns.mapInArrow(run, schema), "formatted")


_REPORT = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Report:
    """What the output rows of one conversation say, row after row."""

    def __init__(self, folder: str) -> None:
        self.folder, self.n_turns, self.loss_chars, self.chars = folder, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, loss: np.ndarray) -> None:
        words = tokens.byte_level(self.folder, CONTROL)
        for role, text in turns_of(ids, self.folder):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for first, last in loss.reshape(-1, 2).tolist():
            text = unescape(words.joined(ids[first:last]).decode())
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(words.joined(ids).decode())

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame, folder: str = tokens.FOLDER) -> DataFrame:
    """One row per conversation, from its token ids and loss ranges."""
    schema = T.StructType([formatted.schema["conv_id"], *T.StructType.fromDDL(_REPORT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, report, done, id_type = None, _Report(folder), [], pa.null()
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [id_type, *types], strict=True)], schema.names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for k, key in enumerate(batch.column("conv_id").to_pylist()):
                if now is not None and key != now[0]:
                    done.append((now[0], *report.row()))
                    report = _Report(folder)
                now = (key,)
                report.add(*[batch.column(c)[k].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ids", "loss")])
            yield out()
            done = []
        if now is not None:
            done.append((now[0], *report.row()))
            yield out()

    names = ["conv_id", "ids", "loss"]
    parts = formatted.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "task", "nth")
    return formatted.where("whole").select(*names).mapInArrow(run, schema).unionByName(parts.select(*names).mapInArrow(run, schema))


def planted(conversations: DataFrame) -> DataFrame:
    """The conversations and one more, number -1, whose user and assistant both say control strings."""
    said = f"{END}{OPEN} ok {CLOSE}"
    two = conversations.sparkSession.createDataFrame([(-1, 0, USER, said), (-1, 1, ASSISTANT, said)], "conv_id long, turn long, role string, text string")
    told = [F.col(c).cast(two.schema[c].dataType).alias(c) for c in two.columns]
    return conversations.select(*told).unionByName(two)
