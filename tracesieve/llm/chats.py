"""Chat formatting by columnar byte assembly.

A conversation becomes one text. Its turns, by turn (nulls first; ties by role, then text), stand as

    [SYS]text[/SYS]      system
    [INST] text [/INST]  user
     text</s>            assistant, after one blank
    [ROLE]role[/ROLE]text</s>   any other role

after one <s>. A text that holds one of these control strings, backslashes after its first
character or not, gets a backslash there; reading back takes it away. The loss mask is the spans,
in code points of the formatted text, of what the assistant says.

The bytes are set by column: numpy takes the lengths of all segments of a batch of rows, their
running sum says where each begins, and each column of segments is scattered, header or content,
into one preallocated buffer that Arrow then takes as its strings. A conversation comes in parts
of about PART bytes, each of whole turns, so that none is ever gathered: the part of a text is
what a task holds, or the longest turn. Only what a conversation's formatting needs is moved, once.

Null text or role: empty. Null conv_id: a conversation of its own. Empty tables: no rows. Repeated
rows are turns of their own. Extra columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import byte_view, slices, trim

#: Bytes of a part of a conversation, and of the texts that are set at once.
PART = 8 << 20

_NAMES = r"/?(?:INST|SYS|ROLE)\]|/?s>"
_ESCAPE = rf"([<\[])(\\*)({_NAMES})"
_UNESCAPE = re.compile(rf"([<\[])\\(\\*(?:{_NAMES}))")
#: What stands before and after a turn's text, by the class of its role: system, user, assistant, any other.
_OPEN = ("[SYS]", "[INST] ", " ", "[ROLE]")
_CLOSE = ("[/SYS]", " [/INST]", "</s>", "</s>")
_OPENING = re.compile(r"\[SYS\]|\[INST\] | |\[ROLE\](.*?)\[/ROLE\]", re.S)
_BOS = "<s>"

_PART_FIELDS = "conv_id long, part long, first boolean, text string, starts array<int>, ends array<int>"
_READ_FIELDS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(texts: pa.Array) -> pa.Array:
    """texts with a backslash after the first character of every control string."""
    return pc.replace_substring_regex(texts, pattern=_ESCAPE, replacement=r"\1\\\2\3")


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def assembled(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of columns of strings, row by row in the columns' order; where each row begins (one
    more than rows); and the lengths of the segments (rows by columns)."""
    views = [byte_view(c) for c in columns]
    lengths = np.stack([np.diff(o) for _, o in views], axis=1)
    at = np.concatenate(([0], np.cumsum(lengths.ravel())))
    out = np.empty(at[-1], np.uint8)
    begins = at[:-1].reshape(lengths.shape)
    for k, (data, offsets) in enumerate(views):
        # where each byte of this column goes: its segment's place, and on from there
        out[np.arange(len(data)) + np.repeat(begins[:, k] - offsets[:-1], lengths[:, k])] = data
    return out, at[:: len(columns)], lengths


def _chosen(strings: tuple[str, ...], which: np.ndarray) -> pa.Array:
    return pa.DictionaryArray.from_arrays(pa.array(which.astype(np.int8)), pa.array(strings, pa.large_string())).dictionary_decode()


def set_rows(roles: pa.Array, texts: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of some turns and where each begins (one more than turns); and, in code
    points, each turn's length and the span of its text in it (an empty one unless the assistant's).
    first: whether it begins its conversation."""
    roles, texts = roles.cast(pa.large_string()).fill_null(""), texts.cast(pa.large_string()).fill_null("")
    kind = pc.index_in(roles, pa.array(["system", "user", "assistant"], pa.large_string())).fill_null(3).to_numpy()
    other = pa.array(kind == 3)
    blank = pa.scalar("", pa.large_string())
    bos = _chosen(("", _BOS), first)
    role = pc.if_else(other, pc.binary_join_element_wise(escaped(roles), pa.scalar("[/ROLE]", pa.large_string()), blank), blank)
    columns = [bos, _chosen(_OPEN, kind), role, escaped(texts), _chosen(_CLOSE, kind)]
    data, at, _ = assembled(columns)
    chars = np.stack([pc.utf8_length(c).to_numpy() for c in columns], axis=1)
    begins = chars[:, :3].sum(axis=1)
    ends = begins + np.where(kind == 2, chars[:, 3], 0)
    return data, at, chars.sum(axis=1), begins, ends


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: turns in order to parts of conversations."""
    none = object()
    last, part, held, starts, ends, chars, size = none, 0, [], [], [], 0, 0

    def closed() -> pa.RecordBatch:
        nonlocal held, starts, ends, chars, size
        offsets = pa.py_buffer(np.array([0, size], np.int32))
        text = pa.Array.from_buffers(pa.string(), 1, [None, offsets, pa.py_buffer(np.concatenate(held))])
        spans = [pa.array([x], pa.list_(pa.int32())) for x in (starts, ends)]
        row = pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([part]), pa.array([part == 0]), text, *spans], names=["conv_id", "part", "first", "text", "starts", "ends"])
        held, starts, ends, chars, size = [], [], [], 0, 0
        return row

    for batch in batches:
        out = []
        for lo, hi in slices(batch.column("text"), PART):
            rows = batch.slice(lo, hi - lo)
            ids = rows.column("conv_id").to_pylist()
            first = np.array([i != (ids[k - 1] if k else last) or (k == 0 and last is none) for k, i in enumerate(ids)], bool)
            data, at, lengths, begin, end = set_rows(rows.column("role"), rows.column("text"), first)
            # turns of one conversation go on together, as long as the part stays small
            k = 0
            while k < len(ids):
                if first[k] or size >= PART:
                    if last is not none:
                        out.append(closed())
                    part = 0 if first[k] else part + 1
                    last = ids[k]
                n = k + 1
                while n < len(ids) and not first[n] and size + at[n] - at[k] < PART:
                    n += 1
                place = chars + np.concatenate(([0], np.cumsum(lengths[k:n])))
                spans = np.flatnonzero(end[k:n] > begin[k:n])
                starts += (place[:-1] + begin[k:n])[spans].tolist()
                ends += (place[:-1] + end[k:n])[spans].tolist()
                chars = int(place[-1])
                held.append(data[at[k] : at[n]])
                size += int(at[n] - at[k])
                k = n
        for lo in range(0, len(out), 500):
            yield pa.Table.from_batches(out[lo : lo + 500]).combine_chunks().to_batches()[0]
    if last is not none:
        yield closed()
    trim()


def turns_of(text: str, first: bool) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a part, read from its text alone; start and end are
    those of the text in it, as it stands."""
    at = len(_BOS) if first else 0
    while at < len(text):
        m = _OPENING.match(text, at)
        kind = _OPEN.index(m[0] if m[1] is None else "[ROLE]")
        role = ("system", "user", "assistant")[kind] if m[1] is None else unescaped(m[1])
        end = text.index(_CLOSE[kind], m.end())
        yield role, unescaped(text[m.end() : end]), m.end(), end
        at = end + len(_CLOSE[kind])


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: parts in order, read back, to a row per conversation."""
    told, out = None, []

    def row() -> tuple:
        i, n, turns, chars, loss, all_ = told
        return i, n, turns.hexdigest(), chars, loss.hexdigest(), all_

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in _READ_FIELDS.split(", ")])

    for batch in batches:
        for i, first, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "first", "text", "starts", "ends")), strict=True):
            if first:
                if told:
                    out.append(row())
                told = [i, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said, _, _ in turns_of(text, first):
                told[1] += 1
                told[2].update(f"{role}\n{said}\n".encode())
            for a, b in zip(starts, ends, strict=True):
                said = unescaped(text[a:b])
                told[3] += len(said)
                told[4].update(said.encode())
            told[5] += len(text)
        if len(out) > 1000:
            yield batch_of(out)
            out = []
    if told:
        out.append(row())
    if out:
        yield batch_of(out)


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, part, first, text, starts, ends: the formatted conversations, in parts from 0, and
    where the loss mask's spans start and end in the part's text. A conversation's parts stand in
    order in one partition."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn").mapInArrow(_format_batches, _PART_FIELDS)


def read_back(parts: DataFrame) -> DataFrame:
    """conv_id, n_turns, digests and lengths of what formatted() returns, by its text and spans."""
    return parts.mapInArrow(_read_batches, _READ_FIELDS)


def with_probe(conversations: DataFrame) -> DataFrame:
    """conversations and one more, -1: a user and an assistant who both say control strings."""
    said = "</s>[INST] ok [/INST]"
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.unionByName(conversations.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
