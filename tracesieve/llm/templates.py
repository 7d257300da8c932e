"""Benchmark decontamination by template canonicalisation.

Words lose their case and outer punctuation; numbers (number words too), names and units after a number become typed
placeholders, runs of one type inside a sentence a single slot. A capitalised word is a name inside a sentence, and at its
beginning if no item of the benchmark has it in lower case. Windows of canonical words of the
benchmark's items are looked up in every document by hash. Windows of one item that hit a document
are laid over it, and the slots must be consistent both ways: one value of the item always stands
for one value of the document, and no other value of the item does. So questions with other numbers or names are caught.

A pair counts as contaminated when consistent windows cover COVERED of the item's canonical words,
or LONG of them, and LITERALS of those are literal words, or no slot has another value. Items shorter than
the window are looked up whole; such items of less than LEAST words, half of them no literal ones, never match. Null or empty texts and
empty tables: no rows. Repeated documents and items: a row for each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import byte_view, lowered, slices, span_hashes, texts, trim, word_spans

WINDOW, COVERED, LONG = 7, 0.5, 24
#: Least words of a window of which fewer than half are literal; literal words of a match with other values; rows of hits held at once.
LEAST, LITERALS, AT_ONCE = 4, 3, 1_000_000
#: Bits (2^LOWER) that tell which words the benchmark has in lower case; a clash takes a name at a sentence's beginning for a word.
LOWER = 24
#: Most canonical words of the benchmark in one broadcast; a larger benchmark goes in blocks of
#: items, each a further pass over the documents.
BLOCK_WORDS = 4_000_000
_BLOCK = 500_000

# Words that are units after a number.
UNITS = """mm cm m km in ft yd mi mg g kg t lb oz ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours
day days week weeks month months year years usd eur gbp dollar dollars euro euros cent cents percent pct degrees mph kmh
meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms pound pounds liter liters litre litres""".split()

# Words that are numbers (articles aren't); tens and ones are also joined by a hyphen.
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_ONES = "one two three four five six seven eight nine".split()
NUMBERS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen
zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig hundert tausend
deux trois quatre cinq sept huit neuf dix onze douze vingt cent mille
dos tres cuatro cinco seis siete ocho nueve diez doce veinte cien mil""".split()

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;"]] = True
LITERAL, NUMBER, NAME, UNIT = range(4)


def _hashes(words: list[str]) -> np.ndarray:
    data, offsets = byte_view(pa.array(words))
    return np.unique(span_hashes(data, offsets[:-1], offsets[1:]))


_UNIT_HASHES = _hashes(UNITS)
_NUMBER_HASHES = _hashes([*NUMBERS, *(f"{a}-{b}" for a in _TENS for b in _ONES)])


def _words(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Bytes of all texts in a row; start, end, text and value hash of each word without its outer punctuation; whether a
    sentence begins with it; whether its first character is a capital, and its only one."""
    data, offsets = byte_view(column)
    n = len(offsets) - 1
    starts, ends, at = word_spans(data, offsets)
    owner = np.repeat(np.arange(n), np.diff(at))
    if len(starts):
        where = np.flatnonzero(_ALNUM[data])
        first, last = np.searchsorted(where, starts), np.searchsorted(where, ends) - 1
        has = last >= first
        stop = np.r_[True, _STOP[data[ends[:-1] - 1]] | (owner[1:] != owner[:-1])]
        line = np.append(0, np.cumsum(data == 10, dtype=np.int32))
        stop[1:] |= line[starts[1:]] != line[ends[:-1]]
        starts, ends, owner, stop = where[first[has]], where[last[has]] + 1, owner[has], stop[has]
    else:
        stop = np.empty(0, bool)
    low = lowered(data)
    value = span_hashes(low, starts, ends)
    capital = np.append(low != data, False)
    total = np.append(0, np.cumsum(capital, dtype=np.int32))
    begins = capital[starts] | (np.append(data, np.uint8(0))[starts] == 0xC3) & capital[np.minimum(starts + 1, len(data))]
    return data, starts, ends, owner, value, stop, begins & (total[ends] - total[starts] == 1) & (ends - starts > 1), total[ends] > total[starts]


def lower_words(column: pa.Array) -> np.ndarray:
    """The value hashes of words that stand in lower case."""
    _, _, _, _, value, _, _, capitals = _words(column)
    return np.unique(value[~capitals])


def canonical(column: pa.Array, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts in a row: canonical hash, type and value hash of each slot or word, and the
    n + 1 offsets of the texts. lower: the bytes of the bitmap of words in lower case."""
    n = len(column)
    data, starts, _, owner, value, stop, name, _ = _words(column)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int8), np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    kind = np.zeros(len(starts), np.int8)
    kind[(data[starts] >= 48) & (data[starts] <= 57) | np.isin(value, _NUMBER_HASHES)] = NUMBER
    bit = value & np.uint64((1 << LOWER) - 1)
    known = (lower[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    kind[name & (kind == LITERAL) & ~(stop & known)] = NAME
    after = np.r_[False, (kind[:-1] == NUMBER) & (owner[1:] == owner[:-1])]
    kind[after & np.isin(value, _UNIT_HASHES)] = UNIT
    new = np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == LITERAL) | (owner[1:] != owner[:-1]) | stop[1:]]
    head = np.flatnonzero(new)
    with np.errstate(over="ignore"):
        value = np.add.reduceat(value, head)
    kind, owner = kind[head], owner[head]
    return np.where(kind == LITERAL, value, kind.astype(np.uint64)), kind, value, np.searchsorted(owner, np.arange(n + 1))


def windows(codes: np.ndarray, kinds: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window inside a text; below LEAST words only those half of which are literal."""
    count = len(codes) - size + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    end = np.repeat(offsets[1:], np.diff(offsets))[:count]
    inside = np.arange(count) + size <= end
    if size < LEAST:
        literal = np.r_[0, np.cumsum(kinds == LITERAL)]
        inside &= 2 * (literal[size:] - literal[:-size]) >= size
    start = np.flatnonzero(inside)
    return start, _rolled(codes, size, count)[start]


def _rolled(codes: np.ndarray, size: int, count: int) -> np.ndarray:
    h = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            h = h * np.uint64(0x100000001B3) + codes[j : j + count]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x9E3779B97F4A7C15)
    return h


class Index:
    """Items' canonical words, and their windows by size, sorted by hash."""

    def __init__(self, ids: list[int], column: pa.Array, lower: np.ndarray) -> None:
        self.ids = ids
        self.codes, self.kinds, self.values, self.offsets = canonical(column, lower)
        size = np.diff(self.offsets)
        self.by_size = {}
        for n in sorted({min(WINDOW, int(x)) for x in size if x}):
            start, h = windows(self.codes, self.kinds, self.offsets, n)
            item = np.searchsorted(self.offsets, start, "right") - 1
            own = size[item] >= WINDOW if n == WINDOW else size[item] == n
            start, h, item = start[own], h[own], item[own]
            order = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[h >> np.uint64(44)] = True
            self.by_size[n] = (h[order], start[order], item[order], seen)

    def hits(self, codes: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Rows (text, item, start in the texts, start in the items, size), sorted; in blocks of
        whole items and AT_ONCE rows or so."""
        found = []
        for n, (known, _, _, seen) in self.by_size.items():
            start, h = windows(codes, kinds, offsets, n)
            maybe = seen[h >> np.uint64(44)]
            start, h = start[maybe], h[maybe]
            lo, hi = np.searchsorted(known, h), np.searchsorted(known, h, "right")
            kept = hi > lo
            found.append((n, start[kept], h[kept], int((hi - lo).sum())))
        parts = max(1, -(-sum(x[-1] for x in found) // AT_ONCE))
        for part in range(parts):
            out = [np.empty((0, 5), np.int64)]
            for n, start, h, _ in found:
                known, begin, item, _ = self.by_size[n]
                if parts > 1:
                    own = item % parts == part
                    known, begin, item = known[own], begin[own], item[own]
                lo, hi = np.searchsorted(known, h), np.searchsorted(known, h, "right")
                many = hi - lo
                rows = np.repeat(start, many)
                at = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                out.append(np.stack([np.searchsorted(offsets, rows, "right") - 1, item[at], rows, begin[at], np.full(len(at), n)], axis=1))
            rows = np.concatenate(out)
            yield rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]

    def judge(self, item: int, rows: np.ndarray, values: np.ndarray) -> tuple[int, int, int]:
        """Canonical words of the item that consistent windows cover, its slots among them, and
        the slots with another value. Shifts between item and document are taken by their windows,
        most first; a window whose slots contradict what was taken is left out."""
        size = int(rows[0, 4])
        shift, many = np.unique(rows[:, 2] - rows[:, 3], return_counts=True)
        covered, meaning, source, other = set(), {}, {}, set()
        for s in shift[np.lexsort((shift, -many))].tolist():
            for begin in np.unique(rows[rows[:, 2] - rows[:, 3] == s, 3]).tolist():
                places = range(begin, begin + size)
                to, back = {}, {}
                slots = [(p, (self.kinds[p], self.values[p]), (self.kinds[p], values[p + s])) for p in places if self.kinds[p] != LITERAL]
                if all(to.setdefault(x, meaning.get(x, y)) == y and back.setdefault(y, source.get(y, x)) == x for _, x, y in slots):
                    meaning |= to
                    source |= back
                    covered.update(places)
                    other.update(p for p, x, y in slots if x != y)
        return len(covered), sum(self.kinds[p] != LITERAL for p in covered), len(other)

    def contaminated(self, item: int, covered: int, slots: int, changed: int) -> bool:
        words = int(self.offsets[item + 1] - self.offsets[item])
        return (covered >= COVERED * words or covered >= LONG) and (not changed or covered - slots >= LITERALS)


_MATCHES = "doc_id long, item_id long, covered long, item_words long, slots long, changed_slots long"


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = np.frombuffer(shared.value[2], np.uint8)
        index = Index(shared.value[0], pa.array(shared.value[1], pa.string()), lower)
        for batch in batches:
            out = []
            ids = batch.column("doc_id").to_pylist()
            for a, b in slices(batch.column("text"), _BLOCK):
                codes, kinds, values, offsets = canonical(batch.column("text").slice(a, b - a), lower)
                for rows in index.hits(codes, kinds, offsets):
                    edges = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1), True]) if len(rows) else []
                    for x, y in zip(edges[:-1], edges[1:], strict=True):
                        text, item = int(rows[x, 0]), int(rows[x, 1])
                        words = int(index.offsets[item + 1] - index.offsets[item])
                        covered, slots, changed = index.judge(item, rows[x:y], values)
                        if index.contaminated(item, covered, slots, changed):
                            out.append((ids[a + text], index.ids[item], covered, words, slots, changed))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else [[]] * 6)], _MATCHES.replace(" long", "").split(", "))

    return run


def _lower_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = np.unique(lower_words(batch.column("text")) & np.uint64((1 << LOWER) - 1)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(bits)], ["bit"])


def lower_bitmap(items: DataFrame) -> bytes:
    """Which words any item has in lower case: 2^LOWER bits, whatever the benchmark's size."""
    bits = np.zeros(1 << (LOWER - 3), np.uint8)
    found = items.select("text").mapInArrow(_lower_batches, "bit long").groupBy(F.floor(F.col("bit") / 32768).alias("k")).agg(F.expr("bitmap_construct_agg(bit % 32768)").alias("b"))
    for row in found.collect():
        bits[int(row["k"]) * 4096 : (int(row["k"]) + 1) * 4096] = np.frombuffer(row["b"], np.uint8)
    return bits.tobytes()


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, covered, item_words, slots, changed_slots: a row for each contaminated
    pair of rows. The documents aren't moved."""
    items = texts(benchmark, "item_id").withColumnRenamed("doc_id", "item_id")
    spark = docs.sparkSession
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * BLOCK_WORDS)))  # a word and what follows it: 2 characters at least
    lower, out = lower_bitmap(items), []
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows], lower))
        out.append(texts(docs).mapInArrow(_scan(shared), _MATCHES))
    return reduce(DataFrame.unionByName, out)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, whose text is in no contaminated pair."""
    rows = benchmark.select(F.coalesce("text", F.lit("")).alias("text")).distinct()
    spark = docs.sparkSession
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * BLOCK_WORDS)))
    lower = lower_bitmap(rows)
    for k in range(blocks):
        part = [r[0] for r in rows.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).orderBy("text").collect()]
        scan = _scan(spark.sparkContext.broadcast((list(range(len(part))), part, lower)))
        docs = docs.filter(F.arrow_udf(_bound(scan), "boolean")(F.coalesce(F.col("text"), F.lit(""))))
    return docs


def _bound(scan):
    def clean(column: pa.Array) -> pa.Array:
        numbered = pa.RecordBatch.from_arrays([pa.array(np.arange(len(column))), column], ["doc_id", "text"])
        hit = np.zeros(len(column), bool)
        for found in scan([numbered]):
            hit[found.column("doc_id").to_numpy()] = True
        trim()
        return pa.array(~hit)

    clean.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return clean
