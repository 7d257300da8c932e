"""Repair of conversations' structure by the cheapest edits.

The rows of a conversation, by turn (nulls first; ties by role, then by the digest of the text),
are to have roles whose initials read (s?(ua)+)?. The edits are the ways through a lattice: a node
is a number of rows done and a state of that pattern, an edge keeps (K), re-roles (R) or deletes
(D) the next row or inserts an empty one (I). A search from both ends (Dijkstra's, a heap each)
goes on until no crossing of equal cost can be left, and takes the least audit of all of them: a
prefix and a suffix that meet in one node. Neither of two equally dear ways to a node begins with
the other, so that the least prefix and the least suffix make the least whole.

A conversation is searched in blocks of BLOCK rows: first the costs from the blocks' borders to
the end, last block first, then block by block from the beginning. What a task holds of a
conversation is some 40 bytes a row and the audit, itself one cell of the result; texts stream by
in a second pass and are never gathered. (Its hash is that of one text in order, so one task must
read it.) Conversations that hold many rows are told by blocks, not by other rules.

Nulls: a null role or text is one blank, a null conv_id is a conversation of its own, a null turn
comes first and counts in no gap. Empty tables: no rows. Repeated rows are duplicates. Blank and
duplicate rows must go. Very long texts are hashed as they stream. Extra columns are never read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import trim

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 256

#: States: nothing yet, after the system's row, after the user's, after the assistant's. The last and the first may end it.
ENDS = (0, None, None, 0)
#: A row: the class of its role (0 other, 1 system, 2 user, 3 assistant), and marks.
MUST_GO, CUT_OFF = 4, 8
_ROLES = {2: "user", 3: "assistant"}

_SEEN_FIELDS = "conv_id long, audit string, told array<long>"
_DIGEST_FIELDS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROW_FIELDS = "conv_id long, place long, turn long, role string, text string, edit string"


def _made(state: int) -> int:
    """The state after a row of the one role, user or assistant, that may follow."""
    return 3 if state == 2 else 2


def _kept(state: int, role: int) -> int | None:
    """The state after a row of that class of role, if it may follow."""
    if role == 1:
        return 1 if state == 0 else None
    return role if role and _made(state) == role else None


_BEFORE = {2: (0, 1, 3), 3: (2,)}


def _onward(codes: bytes, node: tuple[int, int], last: bool) -> Iterator[tuple[int, str, tuple[int, int]]]:
    i, s = node
    if i < len(codes):
        code = codes[i]
        yield DELETE, "D", (i + 1, s)
        if not code & MUST_GO:
            extra = TRUNCATED if code & CUT_OFF else 0
            t = _kept(s, code & 3)
            if t is not None:
                yield KEEP + extra, "K", (i + 1, t)
            yield REROLE + extra, "R", (i + 1, _made(s))
    if i < len(codes) or last:
        yield INSERT, "I", (i, _made(s))


def _back(codes: bytes, node: tuple[int, int], last: bool) -> Iterator[tuple[int, str, tuple[int, int]]]:
    j, t = node
    if j:
        code = codes[j - 1]
        yield DELETE, "D", (j - 1, t)
        if not code & MUST_GO:
            extra = TRUNCATED if code & CUT_OFF else 0
            if t == 1 and code & 3 == 1:
                yield KEEP + extra, "K", (j - 1, 0)
            for s in _BEFORE.get(t, ()):
                if code & 3 == t:
                    yield KEEP + extra, "K", (j - 1, s)
                yield REROLE + extra, "R", (j - 1, s)
    if j < len(codes) or last:
        for s in _BEFORE.get(t, ()):
            yield INSERT, "I", (j, s)


def _ends(codes: bytes, exits: tuple[int | None, ...]) -> list[tuple[int, int, str, tuple[int, int]]]:
    heap = [(c, -len(codes), "", (len(codes), s)) for s, c in enumerate(exits) if c is not None]
    heapify(heap)
    return heap


def entries(codes: bytes, exits: tuple[int | None, ...], last: bool) -> tuple[int, ...]:
    """The cost from each state before a block to the end, given those after it."""
    heap, done = _ends(codes, exits), {}
    while heap:
        cost, _, _, node = heappop(heap)
        if node not in done:
            done[node] = cost
            for more, _, before in _back(codes, node, last):
                if before not in done:
                    heappush(heap, (cost + more, -before[0], "", before))
    return tuple(done[(0, s)] for s in range(4))


def cheapest(codes: bytes, state: int, exits: tuple[int | None, ...], last: bool) -> tuple[int, str]:
    """The cost and the least audit of the cheapest ways from a state through a block to the end.
    Among equal costs a node nearer to its own side goes first: edges of no cost then never lead to a node
    that is settled already."""
    sides = (_onward, 1), (_back, -1)
    heaps = [[(0, 0, "", (0, state))], _ends(codes, exits)]
    labels: list[dict] = [{(0, state): (0, "")}, {node: (cost, audit) for cost, _, audit, node in heaps[1]}]
    settled: list[set] = [set(), set()]
    best = None
    while all(heaps) and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        k = int(heaps[1][0][0] < heaps[0][0][0])
        edges, sign = sides[k]
        cost, _, audit, node = heappop(heaps[k])
        if node in settled[k]:
            continue
        settled[k].add(node)
        if node in labels[1 - k]:
            met = cost + labels[1 - k][node][0]
            best = met if best is None else min(best, met)
        for more, letter, other in edges(codes, node, last):
            label = (cost + more, audit + letter if k == 0 else letter + audit)
            if other not in settled[k] and (other not in labels[k] or label < labels[k][other]):
                labels[k][other] = label
                heappush(heaps[k], (label[0], sign * other[0], label[1], other))
                if other in labels[1 - k]:
                    met = label[0] + labels[1 - k][other][0]
                    best = met if best is None else min(best, met)
    return best, min(labels[0][v][1] + labels[1][v][1] for v in labels[0].keys() & labels[1].keys() if labels[0][v][0] + labels[1][v][0] == best)


def applied(codes: bytes, state: int, audit: str) -> int:
    """The state after an audit's edits."""
    i = 0
    for letter in audit:
        if letter in "RI":
            state = _made(state)
        elif letter == "K":
            state = _kept(state, codes[i] & 3)
        i += letter != "I"
    return state


def repair(codes: bytes, size: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of a conversation."""
    if len(codes) <= min(size, 64):
        return _short(codes)
    blocks = [codes[i : i + size] for i in range(0, len(codes), size)]
    exits = [ENDS]
    for k in range(len(blocks) - 1, 0, -1):
        exits.append(entries(blocks[k], exits[-1], k == len(blocks) - 1))
    state, audit, total = 0, [], None
    for block in blocks:
        cost, part = cheapest(block, state, exits.pop(), not exits)
        total = cost if total is None else total
        audit.append(part)
        state = applied(block, state, part)
    return total, "".join(audit)


@functools.lru_cache(maxsize=1 << 16)
def _short(codes: bytes) -> tuple[int, str]:
    return cheapest(codes, 0, ENDS, True)


def seen(turns: np.ndarray, known: np.ndarray, codes: np.ndarray, digests: np.ndarray) -> tuple[str, list[int]]:
    """A conversation's audit, and gaps, blank, duplicate, truncated, illegal, cost. codes: class of
    role, MUST_GO if blank, CUT_OFF if its end is no sentence's."""
    if not len(codes):
        return "", [0] * 6
    t = turns[known]
    gaps = int(t[-1] - t[0]) + 1 - (1 + int((t[1:] != t[:-1]).sum())) if len(t) else 0
    again = np.ones(len(codes), bool)
    again[np.unique(digests, return_index=True)[1]] = False
    blank = codes & MUST_GO > 0
    duplicate = again & ~blank
    truncated = (codes & CUT_OFF > 0) & ~blank & ~duplicate
    role = codes & 3
    a, b = role[:-1], role[1:]
    legal = ((b == 2) & ((a == 1) | (a == 3))) | ((a == 2) & (b == 3))
    cost, audit = repair((role | np.where(blank | duplicate, MUST_GO, 0) | np.where(truncated, CUT_OFF, 0)).astype(np.uint8).tobytes())
    return audit, [gaps, int(blank.sum()), int(duplicate.sum()), int(truncated.sum()), int((~legal).sum()), cost]


def _runs(column: pa.Array) -> list[tuple[int, int]]:
    """Row ranges of equal ids (null: an id too) of sorted rows."""
    ids, null = column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])))
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)], strict=True))


def _seen_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: rows of conversations, in order, to (conv_id, audit, told)."""
    none = object()
    last, parts = none, []

    def closed() -> None:
        audit, told = seen(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        out.append((last, audit, told))

    for batch in batches:
        out: list = []
        if not len(batch):
            continue
        code = batch.column("code").to_numpy()
        there = code >= 0
        turn = batch.column("turn")
        known = turn.is_valid().to_numpy(zero_copy_only=False)
        turns = turn.fill_null(0).to_numpy()
        digest = np.array([x or bytes(16) for x in batch.column("digest").to_pylist()], "V16")
        for lo, hi in _runs(batch.column("conv_id")):
            i = batch.column("conv_id")[lo].as_py()
            if i != last or last is none:
                if last is not none:
                    closed()
                last, parts = i, []
            at = there[lo:hi]
            parts.append((turns[lo:hi][at], known[lo:hi][at], code[lo:hi][at], digest[lo:hi][at]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.list_(pa.int64()))], names=["conv_id", "audit", "told"])
    if last is not none:
        out = []
        closed()
        yield pa.RecordBatch.from_arrays([pa.array([out[0][0]], pa.int64()), pa.array([out[0][1]], pa.string()), pa.array([out[0][2]], pa.list_(pa.int64()))], names=["conv_id", "audit", "told"])


class _Edits:
    """The edits of one conversation, applied to its rows as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[str]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = _made(self.state)
            yield _ROLES[self.state]

    def next(self, role: str) -> tuple[str, str]:
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.state = _made(self.state)
            role = _ROLES[self.state]
        elif letter == "K":
            self.state = _kept(self.state, "?sua".find(role[:1]))
        return letter, role


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, told, audit) of each conversation, then its repaired rows as (turn, role, text, edit),
    then None."""
    edits = None
    for batch in batches:
        for i, told, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "told", "turn", "role", "text")), strict=True):
            if told is not None:  # the conversation begins
                if edits:
                    yield from ((None, r, "", "I") for r in edits.inserted())
                    yield None
                edits = _Edits(text)
                yield i, told, text
            else:
                yield from ((None, r, "", "I") for r in edits.inserted())
                letter, role = edits.next(role)
                if letter != "D":
                    yield turn, role, text, letter
    if edits:
        yield from ((None, r, "", "I") for r in edits.inserted())
        yield None


def _arrow(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    named = [f.split(" ") for f in fields.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), named, strict=True)], names=[n for n, _ in named])


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, head, sha, first = [], None, None, True
    for x in _walk(batches):
        if x is None:
            out.append((head[0], *head[1], head[2], sha.hexdigest()))
            if len(out) == 1000:
                yield _arrow(out, _DIGEST_FIELDS)
                out = []
        elif len(x) == 3:
            head, sha, first = x, hashlib.sha256(), True
        else:
            sha.update(("" if first else "\n").encode() + x[1].encode() + b":" + x[2].encode())
            first = False
    if out:
        yield _arrow(out, _DIGEST_FIELDS)
    trim()


def _row_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, conv, place, size = [], None, 0, 0
    for x in _walk(batches):
        if x is not None and len(x) == 3:
            conv, place = x[0], 0
        elif x is not None:
            out.append((conv, place, *x))
            place, size = place + 1, size + len(x[2])
            if size > 4 << 20 or len(out) == 10_000:
                yield _arrow(out, _ROW_FIELDS)
                out, size = [], 0
    if out:
        yield _arrow(out, _ROW_FIELDS)


def _rows(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def _digest():
    return F.unhex(F.md5(F.concat("role", F.lit("\n"), "text")))


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv_id, audit, told of every conversation of rows, and of ids, if given. Only a class of
    role, marks and a digest of each row are moved."""
    solid = F.right(F.rtrim("text", F.lit(" \t\n\v\f\r")), F.lit(1))  # empty if the row is blank
    role = F.when(F.startswith("role", F.lit("s")), 1).when(F.startswith("role", F.lit("u")), 2).when(F.startswith("role", F.lit("a")), 3).otherwise(0)
    code = role + F.when(solid == "", MUST_GO).when(~solid.isin(".", "!", "?"), CUT_OFF).otherwise(0)
    told = _rows(rows).select("conv_id", "turn", "role", code.cast("int").alias("code"), _digest().alias("digest"))
    if ids is not None:
        ids = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        told = told.unionByName(ids.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(-1).alias("code"), F.lit(None).cast("binary").alias("digest")))
    return told.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest").drop("role").mapInArrow(_seen_batches, _SEEN_FIELDS)


def _with_audits(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Each conversation's audit, then its rows in order."""
    head = audits(rows, ids).select("conv_id", F.lit(0).alias("kind"), "told", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"))
    body = _rows(rows).select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("array<long>").alias("told"), "turn", "role", "text", _digest().alias("digest"))
    return head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").select("conv_id", "told", "turn", "role", "text")


def digests(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row per conversation: its faults, the edits' cost and audit, and the digest of what they
    make of it. ids: further conversations to tell, without rows."""
    return _with_audits(rows, ids).mapInArrow(_digest_batches, _DIGEST_FIELDS)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), turn (null: inserted), role, text, edit."""
    return _with_audits(rows, None).mapInArrow(_row_batches, _ROW_FIELDS)


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations with faults by the crc32 of conv_id:turn: a row is dropped, emptied, loses its
    sentences' ends, is repeated, or becomes the user's."""
    rows = _rows(conversations)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(name.cast("binary")) % 20
    return rows.filter(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
