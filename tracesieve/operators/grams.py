"""N-grams of hashed words, in numpy over Arrow batches: heads of texts, exact comparison of pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that are taken at once (eight bytes each, and some ten arrays of them).
_WORDS = 1 << 20
#: Odd multipliers of the mixing.
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

#: Common shingles, sorted, and the number of texts of each.
Common = tuple[np.ndarray, np.ndarray]
NONE: Common = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * _A + ((y << np.uint64(31)) | (y >> np.uint64(33))) * _B
    z ^= z >> np.uint64(30)
    z *= _C
    z ^= z >> np.uint64(27)
    z *= _D
    z ^= z >> np.uint64(31)
    return z


def _runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each place on, across texts."""
    out, run = words, 1
    while 2 * run <= n:
        out, run = _mixed(out[: max(0, len(out) - run)], out[run:]), 2 * run
    return _mixed(out[: max(0, len(out) - (n - run))], out[n - run :]) if run < n else out


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and offsets of the texts, from their bytes; none is null."""
    at = _offsets(column)
    data = column.buffers()[2]
    words = np.zeros(0, np.uint64) if data is None else np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.uint64)
    return words, (at - at[0]) // 8


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (rep, w), w an array of longs: w as bytes. Spark's reader of Parquet takes arrays of longs that have a dictionary
    anew for each page."""
    for batch in batches:
        w = batch.column("w")
        at, data = w.offsets.to_numpy().astype(np.int64), w.values.to_numpy(zero_copy_only=False)[: w.offsets[-1].as_py()]
        made = pa.Array.from_buffers(pa.binary(), len(w), [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        yield pa.RecordBatch.from_arrays([batch.column("rep"), made], ["rep", "w"])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1... of each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _of_texts(words: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram) of each place of a text that begins one."""
    many = np.maximum(np.diff(at) - (n - 1), 0)
    return np.repeat(np.arange(len(many)), many), _runs(words, n)[_ranges(at[:-1], many)]


def _distinct(text: np.ndarray, h: np.ndarray, common: Common = NONE) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle), each once, by text: common ones come last, by the number of their texts, others by their hash."""
    rank = np.zeros(len(h), np.int64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], h), len(common[0]) - 1)
        rank = np.where(common[0][at] == h, common[1][at], 0)
    order = np.lexsort((h, rank, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]


def _first(text: np.ndarray, h: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first so many shingles of each text."""
    size = np.bincount(text, minlength=len(many))
    kept = np.arange(len(h)) - (np.cumsum(size) - size)[text] < many[text]
    return text[kept], h[kept]


def _most(words: np.ndarray, at: np.ndarray, size: np.ndarray, ngrams: tuple[int, int]) -> np.ndarray:
    """u: at any length n a text, of so many distinct shortest ones, has at most u - (n - n0) distinct n-grams. Of one length there are
    at most one less than of the one before, so that the longest tell u."""
    k, longer = np.diff(at) - ngrams[0] + 1, ngrams[1] - ngrams[0]
    again = (size < k) & (k > longer)
    text, h = _of_texts(words, at, ngrams[1])
    own = again[text]
    return np.where(again, np.bincount(_distinct(text[own], h[own])[0], minlength=len(k)) + longer, k)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(rep, words, offsets) of some texts of a batch at a time."""
    at = _offsets(batch.column("w")) // 8
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + _WORDS, "right")) - 1)
        yield batch.column("rep").slice(begin, end - begin), *_lists(batch.column("w").slice(begin, end - begin))
        begin = end


def _how_many(u: np.ndarray, ngrams: tuple[int, int], threshold: float) -> np.ndarray:
    return (np.floor(u * (1 - threshold) + 1e-6) + 1 + ngrams[1] - ngrams[0]).astype(np.int64)


def heads(ngrams: tuple[int, int], threshold: float, common: Common) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (rep, w): rep, k shingles with repeats, m without, u (see _most), s: the first ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, words, at in _parts(batch):
                text, h = _distinct(*_of_texts(words, at, ngrams[0]), common)
                size = np.bincount(text, minlength=len(rep))
                u = _most(words, at, size, ngrams)
                text, h = _first(text, h, _how_many(u, ngrams, threshold))
                ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(rep))))).astype(np.int32)
                s = pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))
                sizes = [pa.array(x.astype(np.int32)) for x in (np.diff(at) - ngrams[0] + 1, size, u)]
                yield pa.RecordBatch.from_arrays([rep, *sizes, s], ["rep", "k", "m", "u", "s"])

    return run


def entering(ngrams: tuple[int, int], threshold: float, common: Common, before: Common | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (rep, w): h of each head, without those that were heads under the common shingles before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, words, at in _parts(batch):
                text, h = _distinct(*_of_texts(words, at, ngrams[0]), common)
                many = _how_many(_most(words, at, np.bincount(text, minlength=len(rep)), ngrams), ngrams, threshold)
                if before is not None:  # only texts with a shingle that is common since have others
                    since = np.isin(h, np.setdiff1d(common[0], before[0], assume_unique=True))
                    mine = np.isin(text, text[since])
                    text, h = text[mine], h[mine]
                now, found = _first(text, h, many)
                if before is not None:
                    then, old = _first(*_distinct(text, h, before), many)
                    t, s = np.concatenate((now, then)), np.concatenate((found, old))
                    order = np.lexsort((s, t))  # stable: of two the new one stands first
                    t, s = t[order], s[order]
                    same = np.zeros(len(t), bool)
                    same[order[:-1]] = (t[1:] == t[:-1]) & (s[1:] == s[:-1])
                    found = found[~same[: len(now)]]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])

    return run


def compared(ngrams: tuple[int, int], threshold: float, kind: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """From pairs (a, b) and the texts (rep, w) of both: a, b, n, intersection, total for each n at which they reach the threshold."""

    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        rep = texts.column("rep").combine_chunks()
        words, at = _lists(texts.column("w").combine_chunks())
        a, b = (pc.index_in(pairs.column(c).combine_chunks(), value_set=rep).to_numpy() for c in "ab")
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        begins = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        out = []
        for n in range(ngrams[0], ngrams[1] + 1):
            text, h = _of_texts(words, at, n)
            each, number = np.unique(h, return_inverse=True)
            code = np.unique(text * max(1, len(each)) + number)
            text, number = np.divmod(code, max(1, len(each)))
            size = np.bincount(text, minlength=len(rep))
            start = np.cumsum(size) - size
            mark = np.zeros(len(each), bool)
            both = np.zeros(len(a), np.int64)
            for i, j in zip(begins, [*begins[1:], len(a)], strict=True):
                own = number[start[a[i]] : start[a[i]] + size[a[i]]]
                other = b[i:j]
                mark[own] = True
                held = np.concatenate(([0], np.cumsum(mark[number[_ranges(start[other], size[other])]])))
                ends = np.cumsum(size[other])
                both[i:j] = held[ends] - held[ends - size[other]]
                mark[own] = False
            total = size[a] + size[b] - both
            found = np.flatnonzero((both > 0) & (both >= threshold * total))
            out.append((a[found], b[found], np.full(len(found), n), both[found], total[found]))
        a, b, n, both, total = (np.concatenate(x) for x in zip(*out, strict=True))
        of = lambda x: rep.take(pa.array(x)).cast(kind)
        return pa.table({"a": of(a), "b": of(b), "n": pa.array(n, pa.int32()), "intersection": pa.array(both, pa.int32()), "total": pa.array(total, pa.int32())})

    return run
