"""Phrase collocations by a multikey quicksort of suffix pointers.

A suffix is what begins at a word and goes on to the end of its piece, three words at most. Words
are counted first; a suffix ends before a word of fewer than LEAST occurrences, which no candidate
can hold. (Which words those are is told by a bitmap of hashes of fixed size; a clash only lets a
rare word through.) Equal suffixes of a slice of texts travel as one with its count, to where
their two leading words are routed, so that all occurrences of a pair meet in one bucket. There
the pointers go through a three-way quicksort, one word deeper in each equal part: the size of an
equal part is the count of its words, and a part of fewer than LEAST is abandoned unsorted. A pair
that stands for a thousandth of all words, or so, is routed by three words; its own count is then
the sum of its buckets.

Null text: empty. Null lang: "und", together with rows that say so. Repeated rows count each time.
Empty tables: no rows. Ties of score and count go by the phrase's bytes. Very long texts are one
slice each, whole. doc_id and other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracesieve.llm.common import byte_view, cut, mix64, slices, span_hashes, trim, word_spans

#: Words of the longest phrase; occurrences of a candidate; of a longer phrase, per cent of the inner one's.
WORDS, LEAST, COVER = 3, 10, 50
#: Phrases of a language that are reported.
TOP = 2000
#: Bytes of text that are counted at once, and bits of the bitmap (2^BITS).
SLICE, BITS = 5 << 20, 26
#: A pair of more than one in HEAVY words is routed by three words; so at most that many are.
HEAVY = 1024
#: Buckets to a shuffle partition, and suffixes to a row on the way there.
FINER, PACK = 4, 512

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 9]] = True

_BLANK = pa.scalar(" ", pa.large_string())

_COUNT_FIELDS = "lang string, word string, h long, n long"
_SUFFIX_FIELDS = "lang string, route int, phrases array<string>, counts array<long>"
_FOUND_FIELDS = "lang string, phrase string, size int, n long"


class Slice:
    """The words of some texts of one language: codes into a dictionary, hashes of its entries,
    and which words follow each other within a piece."""

    def __init__(self, lang: str, texts: pa.Array) -> None:
        data, offsets = byte_view(texts)
        data = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
        starts, ends, at = word_spans(data, offsets, _GAP)
        piece = np.searchsorted(np.flatnonzero(_BREAK[data]), starts) + np.repeat(np.arange(len(texts)), np.diff(at))
        self.next = np.append(piece[1:] == piece[:-1], False)[: len(piece)]
        ends = np.concatenate(([0], np.cumsum(ends - starts)))
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[~_GAP[data]])]).dictionary_encode()
        self.codes, self.words = words.indices.to_numpy().astype(np.int64), words.dictionary
        data, offsets = byte_view(self.words)
        salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big"))
        with np.errstate(over="ignore"):
            self.hashes = mix64(span_hashes(data, offsets[:-1], offsets[1:]) + salt)

    def pair_hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(self.hashes[a] * np.uint64(3) + self.hashes[b])


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Slice]]:
    for batch in batches:
        for lo, hi in slices(batch.column("text"), SLICE):
            part = batch.slice(lo, hi - lo)
            for lang in pc.unique(part.column("lang")).to_pylist():
                yield lang, Slice(lang, part.filter(pc.equal(part.column("lang"), lang)).column("text"))
            trim()


def counted(codes: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct tuples of codes (from 0, below sizes), and how often each stands."""
    key, back = codes[0], None
    if np.prod([float(s) for s in sizes]) < 2**63:
        for c, s in zip(codes[1:], sizes[1:], strict=True):
            key = key * s + c
    else:  # a slice of millions of different words: tuple by tuple
        for c, s in zip(codes[1:], sizes[1:], strict=True):
            _, back = np.unique(key, return_inverse=True)
            key = back * s + c
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in codes], n


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (lang, text) to a slice's counts: of each word; of all words, under the
    empty word; and of pairs that are frequent in it, under both words."""
    for lang, s in by_language(batches):
        total = len(s.codes)
        if not total:
            continue
        n = np.bincount(s.codes, minlength=len(s.words))
        often = (n >= total / HEAVY)[s.codes]
        i = np.flatnonzero(s.next & often & np.append(often[1:], False))
        (a, b), pairs = counted([s.codes[i], s.codes[i + 1]], [len(n)] * 2)
        a, b, pairs = (x[pairs >= total / HEAVY] for x in (a, b, pairs))
        joined = pc.binary_join_element_wise(s.words.take(a), s.words.take(b), _BLANK)
        words = pa.chunked_array([s.words, joined, pa.array([""], pa.large_string())]).combine_chunks()
        h = np.concatenate((s.hashes, s.pair_hashes(a, b), [np.uint64(0)])).view(np.int64)
        n = np.concatenate((n, pairs, [total]))
        for lo in range(0, len(n), 1 << 16):
            w = words.slice(lo, 1 << 16).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(w)), w, pa.array(h[lo : lo + (1 << 16)]), pa.array(n[lo : lo + (1 << 16)].astype(np.int64))], names=["lang", "word", "h", "n"])


def suffix_batches(bitmap, heavy: np.ndarray, buckets: int):
    """For mapInArrow: (lang, text) to the slice's distinct suffixes of two words or three, with
    their counts, by the bucket of their leading words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for lang, s in by_language(batches):
            at = s.hashes & np.uint64((1 << BITS) - 1)
            frequent = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            f = frequent[s.codes]
            on = s.next & f & np.append(f[1:], False)[: len(f)]
            i = np.flatnonzero(on)
            if not len(i):
                continue
            third = np.where(on[i + 1], s.codes[np.minimum(i + 2, len(on) - 1)] + 1, 0)  # 0: the suffix ends
            size = len(s.words) + 1
            (a, b, c), n = counted([s.codes[i], s.codes[i + 1], third], [size] * 3)
            pair = s.pair_hashes(a, b)
            deep = np.isin(pair, heavy)
            with np.errstate(over="ignore"):
                full = mix64(pair + np.where(c > 0, s.hashes[c - 1], np.uint64(0)))
            route = (np.where(deep, full, pair) % np.uint64(buckets)).astype(np.int32) + np.where(deep, buckets, 0).astype(np.int32)
            order = np.argsort(route, kind="stable")
            a, b, c, n, route = (x[order] for x in (a, b, c, n, route))
            for lo in range(0, len(a), 1 << 17):
                hi = lo + (1 << 17)
                last = s.words.take(pa.array(c[lo:hi] - 1, mask=c[lo:hi] == 0))
                phrases = pc.binary_join_element_wise(s.words.take(a[lo:hi]), s.words.take(b[lo:hi]), last, _BLANK, null_handling="skip").cast(pa.string())
                r = route[lo:hi]
                new = np.append(True, r[1:] != r[:-1])
                began = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
                cuts = np.flatnonzero(new | ((np.arange(len(r)) - began) % PACK == 0))
                offsets = pa.array(np.append(cuts, len(r)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, x) for x in (phrases, pa.array(n[lo:hi].astype(np.int64)))]
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(cuts)), pa.array(r[cuts]), *lists], names=["lang", "route", "phrases", "counts"])

    return run


def multikey_quicksort(keys: np.ndarray, weights: np.ndarray, least: int, deep: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sorts pointers to suffixes and yields (words, pointer, count): of the equal parts of two
    words and of three, one pointer into each and its weight. keys: a row of words to a suffix,
    negative where it has ended. All parts of one depth of the recursion are split at once, each
    by its own pivot. Parts that weigh less than least are abandoned; in a deep bucket, which
    doesn't hold all of a pair, only those that have two words in common already."""
    at = np.arange(len(keys))
    starts, depth = np.zeros(min(1, len(keys)), np.int64), np.zeros(min(1, len(keys)), np.int64)
    while len(at):
        sizes = np.diff(np.append(starts, len(at)))
        key = keys[at, np.repeat(depth, sizes)]
        pivot = np.sort(np.stack([key[starts], key[starts + sizes // 2], key[starts + sizes - 1]]), axis=0)[1]
        part = np.repeat(np.arange(len(starts)), sizes) * 3 + 1 + np.sign(key - np.repeat(pivot, sizes))
        order = np.argsort(part, kind="stable")
        at, part = at[order], part[order]
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        part = part[starts]
        sizes = np.diff(np.append(starts, len(at)))
        total = np.add.reduceat(weights[at], starts)
        equal = part % 3 == 1
        ended = equal & (pivot[part // 3] < 0)
        depth = depth[part // 3] + equal
        whole = equal & ~ended
        for words in range(2, keys.shape[1] + 1):
            told = whole & (depth == words) & ((total >= least) | (deep and words == 2))
            if told.any():
                yield words, at[starts[told]], total[told]
        keep = ~ended & (depth < keys.shape[1]) & ((total >= least) | (deep and (depth < 2)))
        at, starts, depth = at[np.repeat(keep, sizes)], np.cumsum(sizes * keep)[keep] - sizes[keep], depth[keep]


def sort_batches(buckets: int, least: int):
    """For mapInArrow: rows by (lang, route) to the frequent phrases of each bucket, and to the
    parts of the pairs that were routed by three words."""

    def sorted_bucket(lang: str, route: int, phrases: list[pa.Array], counts: list[pa.Array]) -> pa.RecordBatch:
        phrases = pa.chunked_array(phrases).combine_chunks()
        weights = pa.chunked_array(counts).to_numpy()
        words = pc.split_pattern(phrases, " ")
        size = pc.list_value_length(words).to_numpy()
        keys = np.full((len(phrases), WORDS), -1, np.int64)
        keys[np.arange(WORDS) < size[:, None]] = words.flatten().dictionary_encode().indices.to_numpy()
        out = list(multikey_quicksort(keys, weights, least, route >= buckets))
        number = np.concatenate([np.full(len(p), k) for k, p, _ in out] or [np.empty(0)]).astype(np.int32)
        picked = np.concatenate([p for _, p, _ in out] or [np.empty(0)]).astype(np.int64)
        n = np.concatenate([x for _, _, x in out] or [np.empty(0)]).astype(np.int64)
        text = [" ".join(x.split(" ")[:k]) for x, k in zip(phrases.take(picked).to_pylist(), number.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.repeat(lang, len(text)), pa.array(text, pa.string()), pa.array(number), pa.array(n)], names=["lang", "phrase", "size", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, phrases, counts, held = None, [], [], 0
        for batch in batches:
            langs, routes = batch.column("lang").to_pylist(), batch.column("route").to_pylist()
            bounds = [i for i in range(len(langs)) if not i or (langs[i], routes[i]) != (langs[i - 1], routes[i - 1])]
            for lo, hi in zip(bounds, [*bounds[1:], len(langs)], strict=True):
                if (langs[lo], routes[lo]) != open_:
                    if open_:
                        yield sorted_bucket(*open_, phrases, counts)
                    open_, phrases, counts, held = (langs[lo], routes[lo]), [], [], 0
                phrases.append(batch.column("phrases").slice(lo, hi - lo).flatten())
                counts.append(batch.column("counts").slice(lo, hi - lo).flatten())
                held += len(phrases[-1])
                if held > 1 << 21:  # equal suffixes become one, so that a bucket holds only different ones
                    t = pa.table({"p": pa.chunked_array(phrases), "n": pa.chunked_array(counts)}).group_by("p").aggregate([("n", "sum")])
                    phrases, counts = t.column("p").chunks, t.column("n_sum").chunks
                    held = len(t) // 2
            trim()
        if open_:
            yield sorted_bucket(*open_, phrases, counts)

    return run


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """lang, word, h, n: words of least occurrences or more; under the empty word the number of all
    words; under two words a pair that stands for more than one in HEAVY of a slice."""
    n = texts.mapInArrow(count_batches, _COUNT_FIELDS).groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))
    return cut(n.filter((F.col("n") >= least) | (F.col("word") == "")))


def _is_pair() -> Column:
    return F.contains("word", F.lit(" "))


def phrase_counts(texts: DataFrame, counts: DataFrame, least: int) -> DataFrame:
    """lang, phrase, size, n: the phrases of two words or three and of least occurrences or more."""
    spark = texts.sparkSession
    # A fixed size comes to the driver: 2^BITS bits, in pieces of 32,768; and HEAVY pairs at most.
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    places = counts.filter(~_is_pair() & (F.col("word") != "")).select((F.col("h") % (1 << BITS)).alias("r")).select(F.when(F.col("r") < 0, F.col("r") + (1 << BITS)).otherwise(F.col("r")).alias("r"))
    for row in places.groupBy(F.floor(F.col("r") / 32768).alias("k")).agg(F.expr("bitmap_construct_agg(r % 32768)").alias("b")).collect():
        bits[int(row["k"]) * 4096 : (int(row["k"]) + 1) * 4096] = np.frombuffer(row["b"], np.uint8)
    total = counts.filter("word = ''").agg(F.sum("n")).first()[0] or 0
    heavy = np.array([r["h"] for r in counts.filter(_is_pair() & (F.col("n") * HEAVY >= total)).select("h").collect()], np.int64).view(np.uint64)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * FINER
    suffixes = texts.mapInArrow(suffix_batches(spark.sparkContext.broadcast(bits.tobytes()), heavy, buckets), _SUFFIX_FIELDS)
    routed = suffixes.repartition(partitions, "lang", "route").sortWithinPartitions("lang", "route")
    found = routed.mapInArrow(sort_batches(buckets, least), _FOUND_FIELDS)
    return cut(found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def _words(lo: int, hi: int | None = None) -> Column:
    parts = F.split("phrase", " ")
    return F.array_join(F.slice(parts, lo, (F.size(parts) if hi is None else hi) - lo + 1), " ")


def exact_score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)) in decimals of 38 digits, for counts below 10^15."""
    a, l, r = (c.cast("decimal(15,0)") for c in (a, l, r))  # noqa: E741
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), l * r)


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the top phrases of each language: those of the
    highest score at their weakest cut, without those that a longer phrase covers.

    Scores are exact: counts stay below 10^15, so that a million times a product of two fits the
    38 digits of a decimal. The top of each language is taken in every task before rows meet."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counts = word_counts(texts, least)
    phrases = phrase_counts(texts, counts, least)
    parts = counts.filter(~_is_pair() & (F.col("word") != "")).select("lang", F.col("word").alias("part"), "n").unionByName(phrases.filter("size = 2").select("lang", F.col("phrase").alias("part"), "n"))
    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "size", k.alias("k")).withColumns({"left": _words(1, F.col("k")), "right": _words(F.col("k") + 1)})
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("part").alias(side), F.col("n").alias(name)), ["lang", side])
    weakest = cuts.withColumn("score", exact_score(F.col("a"), F.col("l"), F.col("r"))).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("w")).select("lang", "phrase", "size", "a", "w.l", "w.r", "w.score")
    longer = phrases.filter("size = 3")
    inside = longer.select("lang", F.explode(F.array(_words(1, F.lit(2)), _words(F.lit(2)))).alias("phrase"), F.col("n").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = weakest.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).filter(F.col("rank") <= top)
    totals = counts.filter("word = ''").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
