"""Language-model scoring: causal self-attention on subword ids, in numpy.

A text is its words (runs without ASCII white space, A-Z in lower case) and one end. Words are cut
into subword ids by a public byte-level BPE; the ids of all texts are written once. A word is told
by its ids, so all counts come from them.

The base score is an add-one unigram model over words. Counts are taken over all training texts;
the most frequent words (HEAD at most, a broadcast of bounded size) are looked up on the spot, the
others by a join on the word's hash.

The model predicts each subword from those before it: the VOCABULARY - 1 most frequent ids, the rest
through an escape and their own counts. Its output is a class (a small one for frequent ids) and a
member of the class; both start from the smoothed counts of neighbours over all training texts, and
causal self-attention adds to them. Keys come from a token and the one before it, so that attention
can find what followed earlier. The attention's tables are learnt from every window of every
training text, by Adam in as many tasks as the corpus needs, LEARNER windows each. A pass goes by
SHARE parts of the texts; after each part the tasks' tables are averaged. There is no sample: what
is learnt from grows with the corpus, and texts are dealt by hash, so that it doesn't depend on
their layout. Overlapping windows of WINDOW ids score STRIDE ids each, in batches of masked
attention; every id is scored once, with WINDOW - STRIDE ids before it at least, or all that there
are.

Null and empty texts: the end alone. Training rows are those whose crc32 (of the id as text, mod
7) isn't 2; without any, counts are 0 and the model is uniform. Empty tables: no rows. Repeated
rows count and are scored as often as they stand. Texts of any length are scored whole.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import copy
import functools
import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import bucket, byte_view, cut, mix64, run_hashes, slices, span_hashes, texts, word_spans

HEAD = 1 << 19
#: Words whose ids a worker keeps from block to block.
KNOWN = 1 << 18
#: Classes, and the members of each, by what their table is called: few members in those of the most
#: frequent tokens, so that most tokens take few logits.
SIDES = {"member": (16, 8), "rare": (16, 56)}
CLASSES, VOCABULARY = sum(n for n, _ in SIDES.values()), sum(n * size for n, size in SIDES.values())
WIDTH, WINDOW, STRIDE = 8, 48, 32
#: Steps of BATCH windows that a corpus gives at least, where need be by going through it again.
STEPS, BATCH = 250, 256
#: Passes over all windows of all training texts. A pass goes by SHARE parts of the texts, each text
#: in one of them; after a part, the tasks' tables are averaged. RATE: at first, it falls to nothing.
ROUNDS, SHARE, RATE = 1, 4, 0.05
#: Windows of a pass to a learner (a task), so that their number grows with the corpus.
LEARNER = 256_000
#: Parts of the tables that are averaged at once.
_PARTS = 16
#: Bytes of text, and of ids, that are looked at together: below 2^21 places, so that a worker's table
#: of powers stays small.
_BLOCK, _IDS = 1_900_000, 3_900_000
#: Windows whose targets are grouped together, and that attend together.
_TOGETHER, _AT_ONCE = 256, 64
_PAD = VOCABULARY
#: How far each of a window's last STRIDE places stands behind each of its places.
_BACK = np.arange(WINDOW - STRIDE, WINDOW)[:, None] - np.arange(WINDOW)


# --- subword ids -----------------------------------------------------------------------------


def _expand(values: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of values that picks names, one after the other, and their n + 1 offsets."""
    size = offsets[1:] - offsets[:-1]
    many = size[picks]
    ends = np.cumsum(many)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[:-1][picks] - (ends - many), many)
    return values[at], np.r_[0, ends]


class Subwords:
    """A public byte-level BPE in the tiktoken library; an end stands after its last id."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.end = max(ranks.values()) + 1
        if self.end > 0xFFFF:
            raise ValueError("ids are kept in 16 bits")
        self.begins = np.zeros(self.end + 1, bool)
        self.begins[[i for x, i in ranks.items() if x[:1] == b" "]] = True
        self.begins[self.end] = True
        self.known = np.empty(0, np.uint64), np.empty(0, np.uint16), np.zeros(1, np.int64)

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, each after a space, and the n + 1 offsets of the words. Words with
        white space other than ASCII's are encoded one by one, the others in a row."""
        apart = set()
        if _OTHER_SPACE.search("\n".join(words)):
            apart = {i for i, w in enumerate(words) if _OTHER_SPACE.search(w)}
        plain = [w for i, w in enumerate(words) if i not in apart] if apart else words
        ids = np.array(self.encode(" " + " ".join(plain)) if plain else [], np.uint16)
        at = np.r_[np.flatnonzero(self.begins[ids]), len(ids)]
        if not apart:
            return ids, at
        parts = {i: np.array(self.encode(" " + words[i]), np.uint16) for i in apart}
        if plain:
            parts |= zip((i for i in range(len(words)) if i not in apart), np.split(ids, at[1:-1]), strict=True)
        return np.concatenate([parts[i] for i in range(len(words))]), np.r_[0, np.cumsum([len(parts[i]) for i in range(len(words))])]

    def of_hashed(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words and their offsets, and which of these words each key (rising hashes of the
        words from starts to ends in data) is. Words of the blocks before are kept, KNOWN at most."""
        old, ids, at = self.known
        place = np.searchsorted(old, keys)
        new = np.flatnonzero(old.take(place, mode="clip") != keys) if len(old) else np.arange(len(keys))
        place[new] = len(old) + np.arange(len(new))
        raw = data.tobytes()
        more, ends_of = self.of_words([raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
        ids, at = np.concatenate([ids, more]), np.concatenate([at, at[-1] + ends_of[1:]])
        order = np.argsort(np.concatenate([old, keys[new]]), kind="stable") if len(old) + len(new) <= KNOWN else place
        self.known = np.concatenate([old, keys[new]])[order], *_expand(ids, at, order)
        return ids, at, place


#: Everything that any engine may take for white space, besides what splits words.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")


@functools.lru_cache(maxsize=2)
def subwords(vocabulary: str, pattern: str) -> Subwords:
    return Subwords(vocabulary, pattern)


def encode_texts(column: pa.Array, vocabulary: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids (uint16) of all texts, each with its end, and the n + 1 offsets of the texts."""
    data, offsets = byte_view(column)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, at = word_spans(data, offsets)
    once, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    model = subwords(vocabulary, pattern)
    known, sizes, place = model.of_hashed(once, data, starts[first], ends[first])
    ids, word_at = _expand(known, sizes, place[which])
    text_at = word_at[at]
    return np.insert(ids, text_at[1:], model.end), text_at + np.arange(len(text_at))


def encoded(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """row (a number of its own), doc_id, held_out, ids (bytes of uint16): written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for a, b in slices(batch.column("text"), _BLOCK):
                ids, at = encode_texts(batch.column("text").slice(a, b - a), vocabulary, pattern)
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer((at * 2).astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + b - a)), batch.column("doc_id").slice(a, b - a), packed.cast(pa.binary())], ["row", "doc_id", "ids"])
                row += b - a

    rows = texts(docs).mapInArrow(run, "row long, doc_id long, ids binary")
    return cut(rows.withColumn("held_out", bucket("doc_id", 7) == 2))


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.uint16), (offsets - offsets[0]) // 2


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column("ids"), _IDS):
            yield batch.slice(a, b - a)


class Words:
    """begins: whether an id begins a word (its first byte is a space; the end is a word too)."""

    def __init__(self, begins: np.ndarray) -> None:
        self.begins, self.codes = begins, mix64(np.arange(1, len(begins) + 1, dtype=np.uint64))

    def keys(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words begin, and their hashes."""
        starts = np.flatnonzero(self.begins[ids])
        return starts, run_hashes(self.codes[ids], starts, np.r_[starts[1:], len(ids)]).view(np.int64)


# --- counts ----------------------------------------------------------------------------------


def word_counts(ids: DataFrame, words: Words) -> DataFrame:
    """key, n: how often each word stands in the training texts. Each task adds up its own."""

    def emit(keys: list[np.ndarray], many: list[np.ndarray]) -> pa.RecordBatch:
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(at, np.concatenate(many), minlength=len(key)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, many, held = [], [], 0
        for batch in _blocks(batches):
            key, n = np.unique(words.keys(_ids(batch.column("ids"))[0])[1], return_counts=True)
            keys.append(key)
            many.append(n)
            held += len(key)
            if held > 3_000_000:
                yield emit(keys, many)
                keys, many, held = [], [], 0
        if held:
            yield emit(keys, many)

    return ids.filter("not held_out").select("ids").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _bins(ids: DataFrame, bins: int, index) -> np.ndarray:
    """Counts, over all training texts, of the bins that index finds in (ids, offsets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bins, np.int64)
        for batch in _blocks(batches):
            total += np.bincount(index(*_ids(batch.column("ids"))), minlength=bins)
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(total[i])], ["i", "n"])

    rows = ids.filter("not held_out").select("ids").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(bins, np.int64)  # at most `bins` rows, whatever the corpus
    out[rows["i"].to_numpy()] = rows["n"].to_numpy()
    return out


# --- the model -------------------------------------------------------------------------------


class Model:
    """small: id to place in the vocabulary (the last place is the escape); rest: log-probability
    of an id under the escape; log_class (V, CLASSES) and log_members, by SIDES (V * classes,
    members): from counts; tables: what attention has learnt."""

    def __init__(self, single: np.ndarray, end: int) -> None:
        order = np.argsort(-single, kind="stable")
        self.small = np.full(len(single), VOCABULARY - 1, np.int32)
        self.small[order[: VOCABULARY - 1]] = np.arange(VOCABULARY - 1)
        rare = single[order[VOCABULARY - 1 :]]
        self.rest = np.zeros(len(single))
        self.rest[order[VOCABULARY - 1 :]] = np.log((rare + 1.0) / (rare.sum() + len(rare)))
        self.end = end
        self.tables: dict[str, np.ndarray] = {}
        self.seen = 0

    def pairs(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bins of (before, after) for each id; before a text's first id stands the end."""
        before = np.r_[self.end, ids[:-1]]
        before[offsets[:-1]] = self.end
        return self.small[before] * VOCABULARY + self.small[ids]

    def use_counts(self, pairs: np.ndarray, strength: float = 8.0) -> None:
        n = pairs.reshape(VOCABULARY, VOCABULARY).astype(float)
        single, at, by_class = n.sum(0) + 0.1, 0, []
        self.log_members = {}
        for name, (classes, size) in SIDES.items():
            own, share = n[:, at : at + classes * size].reshape(-1, classes, size), single[at : at + classes * size].reshape(classes, size)
            by_class.append((own.sum(2), share.sum(1)))
            logs = np.log((own + strength * share / share.sum(1, keepdims=True)) / (by_class[-1][0][:, :, None] + strength))
            self.log_members[name] = logs.reshape(-1, size).astype(np.float32)
            at += classes * size
        by_class, of_class = (np.concatenate(x, axis=-1) for x in zip(*by_class, strict=True))
        self.log_class = np.log((by_class + strength * of_class / of_class.sum()) / (by_class.sum(1, keepdims=True) + strength)).astype(np.float32)

    def start(self) -> None:
        r = np.random.default_rng(1)
        t = {k: r.standard_normal((VOCABULARY + 1, WIDTH)) * 0.3 for k in ("query", "key", "key_before", "value")}
        t |= {"near": np.zeros(WINDOW), "class": np.zeros((WIDTH, CLASSES))} | {k: np.zeros((n, WIDTH, size)) for k, (n, size) in SIDES.items()}
        self.tables = {k: v.astype(np.float32) for k, v in t.items()}

    def windows(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """inputs (n, WINDOW), targets (n, STRIDE) in places of the vocabulary, _PAD where there is
        nothing; and where in ids the targets stand (-1 for none)."""
        size = np.diff(offsets)
        many = -(-size // STRIDE)
        text = np.repeat(np.arange(len(size)), many)
        first = (offsets[text] + (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE).astype(np.int32)
        where = first[:, None] + np.arange(STRIDE, dtype=np.int32)
        ends = offsets[text + 1]
        last = np.flatnonzero(first + STRIDE > ends)
        where[last] = np.where(where[last] < ends[last, None], where[last], -1)
        small = np.r_[np.full(WINDOW, _PAD, np.int32), self.small[ids], np.full(STRIDE, _PAD, np.int32)]
        inputs = np.lib.stride_tricks.sliding_window_view(small, WINDOW)[first + (STRIDE - 1)]
        begin = offsets[text]
        for i in range(-(-(WINDOW - STRIDE) // STRIDE) + 1):  # windows that reach before their text
            early = np.flatnonzero(first == begin + i * STRIDE)
            back = WINDOW - STRIDE - i * STRIDE
            if back >= 0:
                inputs[early, :back] = _PAD
                inputs[early, back] = self.small[self.end]
        targets = np.lib.stride_tricks.sliding_window_view(small, STRIDE)[first + WINDOW]
        targets[where < 0] = _PAD
        return inputs, targets, where

    def looked_up(self) -> tuple[np.ndarray, ...]:
        """What attention looks up: queries over the root of their width; keys; keys of the token
        before; values and a one that adds up the weights (of no token: nothing); the weights that
        distances give; and whether no score can be so large that its exponential overflows."""
        t = self.tables
        value = np.ones((VOCABULARY + 1, WIDTH + 1), np.float32)
        value[:, :WIDTH] = t["value"]
        value[_PAD] = 0
        near = np.where(_BACK >= 0, t["near"].take(_BACK, mode="clip"), np.float32(-1e4))
        small = self._small_scores()
        return t["query"] * np.float32(WIDTH**-0.5), t["key"], t["key_before"], value, np.exp(near) if small else near, small

    def attend(self, inputs: np.ndarray, tables: tuple[np.ndarray, ...] | None = None) -> tuple[np.ndarray, ...]:
        """Masked attention of the last STRIDE positions over those up to each: queries, keys,
        values, weights before they are divided, their sums, and the contexts."""
        query, key, key_before, value, near, small = tables or self.looked_up()
        q = query.take(inputs[:, WINDOW - STRIDE :], axis=0)
        k = key.take(inputs, axis=0)
        k[:, 1:] += key_before.take(inputs[:, :-1], axis=0)
        v = value.take(inputs, axis=0)
        s = q @ k.transpose(0, 2, 1)
        if small:
            np.exp(s, out=s)
            s *= near
        else:
            s += near
            s += np.where(inputs == _PAD, np.float32(-1e4), np.float32(0))[:, None, :]
            s -= s.max(2, keepdims=True)
            np.exp(s, out=s)
        mixed = s @ v
        total = mixed[:, :, WIDTH:]
        total[total == 0] = 1  # positions after a text's end
        return q, k, v, s, total, mixed[:, :, :WIDTH] / total

    def _longest(self, *names: str) -> float:
        return sum(float(np.sqrt(np.einsum("ij,ij->i", x, x).max())) for x in (self.tables[n] for n in names))

    def _small_scores(self) -> bool:
        """Whether no score can be so large that its exponential overflows."""
        return self._longest("query") * self._longest("key", "key_before") * WIDTH**-0.5 + self.tables["near"].max() < 60

    def log_probabilities(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Natural log-probability of each id."""
        out = self.rest[ids]
        inputs, targets, where = self.windows(ids, offsets)
        tables = self.looked_up() if self.tables else ()
        for a in range(0, len(inputs), _TOGETHER):
            x, y, w = (z[a : a + _TOGETHER] for z in (inputs, targets, where))
            real, before, kind, member, sides = _by_class(x, y)
            context = None
            if self.tables:
                context = np.concatenate([self.attend(x[i : i + _AT_ONCE], tables)[-1] for i in range(0, len(x), _AT_ONCE)])
                context = context.reshape(-1, WIDTH).take(real, axis=0)
            found = _log_share(self.logits(before, context), kind)
            for side in sides:
                found[side[1]] += _log_share(self.member_logits(side, before, kind, context), member[side[1]])
            out[w.ravel()[real]] += found
        return out

    def logits(self, before: np.ndarray, context: np.ndarray | None) -> np.ndarray:
        """What counts and attention say of the classes."""
        x = self.log_class.take(before, axis=0)
        if context is not None:
            x += context @ self.tables["class"]
        return x

    def member_logits(self, side: tuple, before: np.ndarray, kind: np.ndarray, context: np.ndarray | None) -> np.ndarray:
        """What they say of the members of the classes of a side."""
        name, rows, first, groups = side
        x = self.log_members[name].take(before[rows] * SIDES[name][0] + (kind[rows] - first), axis=0)
        if context is not None:
            for c, own, part in groups:
                x[part] += context[own] @ self.tables[name][c]
        return x

    def step(self, inputs: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of a batch, and the gradients of the tables."""
        t = self.tables
        q, k, v, weight, total, context = self.attend(inputs)
        real, before, kind, member, sides = _by_class(inputs, targets)
        n, flat = max(1, len(real)), context.reshape(-1, WIDTH).take(real, axis=0)
        x = self.logits(before, flat)
        loss = _to_gradient(x, kind, n) / n
        grad = {"class": flat.T @ x} | {name: np.zeros_like(t[name]) for name in SIDES}
        d_flat = x @ t["class"].T
        for side in sides:
            name, rows, _, groups = side
            x = self.member_logits(side, before, kind, flat)
            loss += _to_gradient(x, member[rows], n) / n
            for c, own, part in groups:
                grad[name][c] = flat[own].T @ x[part]
                d_flat[own] += x[part] @ t[name][c].T
        d_mixed = np.zeros((len(inputs), STRIDE, WIDTH + 1), np.float32)  # of the weighted sums; at last, of the weights' sum
        d_mixed.reshape(-1, WIDTH + 1)[real, :WIDTH] = d_flat
        d_mixed /= total
        np.negative(np.einsum("bsd,bsd->bs", d_mixed[:, :, :WIDTH], context), out=d_mixed[:, :, WIDTH])
        d_score = d_mixed @ v.transpose(0, 2, 1)
        d_score *= weight
        d_key = d_score.transpose(0, 2, 1) @ q
        d_query = d_score @ k
        d_query *= np.float32(WIDTH**-0.5)
        cells = _CELLS.take(inputs, axis=0)
        for name, index, value in (
            ("query", cells[:, WINDOW - STRIDE :], d_query),
            ("key", cells, d_key),
            ("key_before", cells[:, :-1], d_key[:, 1:]),
            ("value", cells, weight.transpose(0, 2, 1) @ d_mixed[:, :, :WIDTH]),
        ):
            grad[name] = np.zeros_like(t[name])
            np.add.at(grad[name].reshape(-1).view(np.complex64), index.ravel(), value.ravel().view(np.complex64))
        grad["value"][_PAD] = 0
        by_place = (np.ones(len(inputs), np.float32) @ d_score.reshape(len(inputs), -1)).reshape(_BACK.shape)
        grad["near"] = np.bincount(_BACK[_BACK >= 0], by_place[_BACK >= 0], minlength=WINDOW).astype(np.float32)
        return float(loss), grad

    def learn(self, ids: np.ndarray, offsets: np.ndarray, steps: int, rate: float = 0.02) -> list[float]:
        """Adam over random batches of windows; the losses."""
        self.start()
        inputs, targets, _ = self.windows(ids, offsets)
        random, losses, adam = np.random.default_rng(2), [], Adam(self)
        for i in range(1, steps + 1):
            pick = random.integers(0, len(inputs), BATCH)
            losses.append(adam.step(inputs[pick], targets[pick], rate * min(1.0, i / 20) * (1 - 0.95 * i / steps)))
        return losses


class Adam:
    """Steps of a model of which the tables are copied first."""

    def __init__(self, model: Model) -> None:
        model.tables = {k: v.copy() for k, v in model.tables.items()}
        self.model, self.steps = model, 0
        self.m, self.s = ({k: np.zeros_like(v) for k, v in model.tables.items()} for _ in range(2))

    def step(self, inputs: np.ndarray, targets: np.ndarray, rate: float) -> float:
        loss, grad = self.model.step(inputs, targets)
        self.steps += 1
        rate = np.float32(rate / (1 - 0.9**self.steps))
        scale = np.float32(1 / (1 - 0.99**self.steps))
        for k, g in grad.items():
            m, s = self.m[k], self.s[k]
            m += np.float32(0.1) * (g - m)
            g *= g
            s += np.float32(0.01) * (g - s)
            np.sqrt(np.multiply(s, scale, out=g), out=g)
            g += np.float32(1e-8)
            np.divide(m, g, out=g)
            g *= rate
            self.model.tables[k] -= g
        return loss


#: The class of a place in the vocabulary, and its place there.
_CLASS = np.repeat(np.arange(CLASSES, dtype=np.uint8), np.repeat([size for _, size in SIDES.values()], [n for n, _ in SIDES.values()]))
_MEMBER = np.concatenate([np.tile(np.arange(size), n) for n, size in SIDES.values()])


def _by_class(inputs: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """The places (in targets, ravelled) of all that is there, by class; the token before each, its
    class and member; and by side that occurs its name, its rows, its first class and (class, rows,
    rows among the side's) of the classes that occur."""
    target = targets.ravel()
    real = np.flatnonzero(target != _PAD)
    target = target.take(real)
    kind = _CLASS.take(target)
    order = np.argsort(kind, kind="stable")
    real, target, kind = real.take(order), target.take(order), kind.take(order).astype(np.intp)
    edges = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    sides, first = [], 0
    for name, (n, _) in SIDES.items():
        a, b = edges[first], edges[first + n]
        if a < b:
            groups = [(c, slice(x, y), slice(x - a, y - a)) for c, (x, y) in enumerate(zip(edges[first : first + n], edges[first + 1 : first + n + 1], strict=True)) if x < y]
            sides.append((name, slice(a, b), first, groups))
        first += n
    return real, inputs[:, WINDOW - STRIDE :].ravel().take(real), kind, _MEMBER.take(target), sides


def _picked(x: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Places, in x ravelled, of a column in each row."""
    return np.arange(0, x.size, x.shape[1]) + columns


def _below(x: np.ndarray) -> np.ndarray:
    """x itself, less each row's largest if an exponential could overflow."""
    if x.max(initial=0) > 60:
        x -= x.max(1, keepdims=True)
    return x


def _to_gradient(x: np.ndarray, target: np.ndarray, n: int) -> float:
    """The loss of logits x; x becomes the gradient of its mean over n."""
    at, x = _picked(x, target), _below(x)
    loss = -x.take(at).sum(dtype=float)
    np.exp(x, out=x)
    total = x @ np.ones((x.shape[1], 1), x.dtype)
    loss += np.log(total).sum(dtype=float)
    x /= total * np.float32(n)
    x.reshape(-1)[at] -= np.float32(1 / n)
    return loss


#: Places of a table's numbers, taken in twos (as one complex number, which is added up faster), by token.
_CELLS = np.arange((VOCABULARY + 1) * WIDTH // 2).reshape(-1, WIDTH // 2)


def _log_share(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of the target of each row of logits x, which is overwritten."""
    x = _below(x)
    out = x.take(_picked(x, target))
    np.exp(x, out=x)
    return out - np.log(x @ np.ones(x.shape[1], x.dtype))


_LEARNT = "part int, seen long, table binary"


def _round(ids: DataFrame, model: Model, turn: int, turns: int, repeat: int, learners: int) -> tuple[dict[str, np.ndarray], int]:
    """Tables after a round, and how many windows it has learnt from: every task learns on from the
    model by all windows of its training texts that are in the round's part, `repeat` times, and the
    tables are averaged by the windows that they have seen. Texts are dealt and put in order by hashes
    of what they are, so that what is learnt doesn't depend on where they lay."""
    shared = ids.sparkSession.sparkContext.broadcast(model)
    names = list(model.tables)
    rate = RATE * (1 - turn / turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, held = copy.copy(shared.value), 0, []
        adam, random = Adam(own), np.random.default_rng(turn)
        for batch in _blocks(batches):
            held.append(own.windows(*_ids(batch.column("ids")))[:2])
            if sum(len(x) for x, _ in held) < 16 * BATCH:
                continue
            seen += _learn_on(adam, held, random, rate, repeat)
            held = []
        seen += _learn_on(adam, held, random, rate, repeat)
        if seen:
            parts = [x.tobytes() for x in np.array_split(np.concatenate([own.tables[n].ravel() for n in names]), _PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_PARTS), pa.int32()), pa.array([seen] * _PARTS), pa.array(parts, pa.binary())], ["part", "seen", "table"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        many: dict[int, int] = {}
        for batch in batches:
            for part, seen, x in zip(*(batch.column(k).to_pylist() for k in ("part", "seen", "table")), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(x, np.float32).astype(float) * seen
                many[part] = many.get(part, 0) + seen
        means = pa.array([(x / many[k]).tobytes() for k, x in total.items()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(many.values()), pa.int64()), means], ["part", "seen", "table"])

    mine = ids.filter("not held_out").select(F.xxhash64("doc_id", "ids").alias("at"), "doc_id", "ids").filter(F.pmod("at", F.lit(SHARE)) == turn % SHARE)
    # coalesce: where the session has more partitions for a key, there are still no more learners, and tables
    dealt = mine.repartition(learners, "at").coalesce(learners).sortWithinPartitions("at", "doc_id").select("ids")
    rows = dealt.mapInArrow(run, _LEARNT)
    found = {x["part"]: x for x in rows.repartition(_PARTS, "part").mapInArrow(add_up, _LEARNT).collect()}  # a row a part
    if not found:
        return model.tables, 0
    flat = np.concatenate([np.frombuffer(found[i]["table"]) for i in range(_PARTS)])
    parts = np.split(flat, np.cumsum([model.tables[n].size for n in names])[:-1])
    return {n: x.reshape(model.tables[n].shape).astype(np.float32) for n, x in zip(names, parts, strict=True)}, found[0]["seen"]


def _learn_on(adam: Adam, held: list, random: np.random.Generator, rate: float, repeat: int) -> int:
    """Steps over all held windows, each time in random order; how many windows those are."""
    if not held:
        return 0
    inputs, targets = (np.concatenate(x) for x in zip(*held, strict=True))
    for _ in range(repeat):
        order = random.permutation(len(inputs))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            adam.step(inputs.take(pick, axis=0), targets.take(pick, axis=0), rate * min(1.0, (adam.steps + 1) / 10) * len(pick) / BATCH)
    return len(inputs)


def train(ids: DataFrame, size: int, steps: int = STEPS) -> Model:
    """size: of the subword vocabulary; its last id is the end. A small corpus is gone through again
    until it gives so many steps. model.seen: the windows learnt from, in all passes."""
    single = _bins(ids, size, lambda x, _: x)
    model = Model(single, size - 1)
    model.use_counts(_bins(ids, VOCABULARY * VOCABULARY, model.pairs))
    model.start()
    windows = int(single.sum()) // STRIDE + 1
    repeat = -(-steps * BATCH // windows)
    for turn in range(ROUNDS * SHARE if single.any() else 0):
        model.tables, seen = _round(ids, model, turn, ROUNDS * SHARE, repeat, -(-windows // LEARNER))
        model.seen += seen
    return model


# --- scores ----------------------------------------------------------------------------------

_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, others array<long>"


def scores(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row of
    docs."""
    spark = docs.sparkSession
    words = Words(subwords(vocabulary, pattern).begins)
    ids = encoded(docs, vocabulary, pattern)
    counts = cut(word_counts(ids, words))
    total, distinct = (x or 0 for x in counts.agg(F.sum("n"), F.count("*")).first())
    by_n = counts.groupBy(F.least("n", F.lit(1 << 20)).alias("n")).count().orderBy(F.desc("n")).collect()  # 2^20 rows at most
    least, held = (1 << 20) + 1, 0
    for n, many in by_n:
        if held + many > HEAD:
            break
        least, held = n, held + many
    head = counts.filter(F.col("n") >= least).toArrow()  # HEAD rows at most
    order = np.argsort(head["key"].to_numpy())
    shared = spark.sparkContext.broadcast((words, train(ids, len(words.begins)), head["key"].to_numpy()[order], head["n"].to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model, keys, many = shared.value
        logs = np.log10(many + 1.0)
        for batch in _blocks(batches):
            own, at = _ids(batch.column("ids"))
            starts, key = words.keys(own)
            text = np.searchsorted(at, starts, "right") - 1
            once, which = np.unique(key, return_inverse=True)
            place = np.searchsorted(keys, once).clip(max=max(0, len(keys) - 1))[which]
            known = keys[place] == key if len(keys) else np.zeros(len(key), bool)
            n = batch.num_rows
            others = np.r_[0, np.cumsum(np.bincount(text[~known], minlength=n))]
            score = np.add.reduceat(model.log_probabilities(own, at), at[:-1]) / np.log(10)
            columns = [
                batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(np.bincount(text, minlength=n)), pa.array(np.bincount(text[known], minlength=n)),
                pa.array(np.bincount(text[known], logs[place[known]] if len(keys) else None, minlength=n).astype(float)), pa.array(score), pa.ListArray.from_arrays(pa.array(others, pa.int32()), pa.array(key[~known])),
            ]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _SCORED.split(", ")])

    scored = cut(ids.select("row", "doc_id", "held_out", "ids").mapInArrow(run, _SCORED))
    rare = counts.filter(F.col("n") < least)
    found = scored.select("row", F.explode("others").alias("key")).join(rare, "key")
    more = found.groupBy("row").agg(F.count("*").alias("more_known"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_logs"))
    joined = scored.drop("others").join(more, "row", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(total + distinct + 1.0))).alias("base_score"),
        "score",
    )
