"""Languages by mixture inference: expectation-maximisation over n-gram likelihoods.

A text is cut into segments of a few words. Each language gives a segment a likelihood from byte
n-grams, whose counts come from all training texts. A document is a mixture of languages with
proportions of its own; expectation-maximisation estimates them for growing language sets, and a
language joins the set only if the likelihood rises by more than the penalty.

Null texts and texts without a letter: `und`, score 0. No training rows: `und` for all. Repeated
rows: a result for each. Ties go to the first language by name. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import NO_LETTER, bucket, byte_view, lowered, slices, texts, word_spans

BITS = 16
#: Words in a segment, iterations, and nats for a further language per log of the segments.
SEGMENT, ITERATIONS, PENALTY = 4, 8, 2.0
_BLOCK = 2_000_000
_LETTER = regex.compile(r"\p{L}")


def ngrams(data: np.ndarray) -> np.ndarray:
    """A hash of the three bytes that end at each position; what is no letter counts as a gap."""
    x = np.where(NO_LETTER[data], 32, lowered(data)).astype(np.uint32)
    three = x.copy()
    three[1:] |= x[:-1] << 8
    three[2:] |= x[:-2] << 16
    return (three * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def counts(docs: DataFrame) -> DataFrame:
    """lang, i, n: how often the n-grams occur in the training texts of each language."""
    known = docs.filter(F.col("lang").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for a, b in slices(batch.column("text"), _BLOCK):
                langs = batch.column("lang").slice(a, b - a).dictionary_encode()
                data, offsets = byte_view(batch.column("text").slice(a, b - a))
                if not len(data):
                    continue
                grams, codes = ngrams(data), np.repeat(langs.indices.to_numpy(), np.diff(offsets))
                both = np.bincount(codes.astype(np.int64) << BITS | grams, minlength=len(langs.dictionary) << BITS).reshape(-1, 1 << BITS)
                for lang, n in zip(langs.dictionary.to_pylist(), both, strict=True):
                    totals[lang] = totals.get(lang, 0) + n
        for lang, n in totals.items():
            i = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(i), pa.string()), pa.array(i, pa.int32()), pa.array(n[i], pa.int64())], ["lang", "i", "n"])

    return known.filter(bucket("doc_id", 4) != 2).select("text", "lang").mapInArrow(run, "lang string, i int, n long").groupBy("lang", "i").agg(F.sum("n").alias("n"))


def table_of(counts_: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages by name, and log-likelihoods (2^BITS, languages): 2^BITS rows a language."""
    rows = counts_.toPandas()
    langs = sorted(rows["lang"].unique())
    n = np.zeros((1 << BITS, len(langs)))
    for k, lang in enumerate(langs):
        own = rows[rows["lang"] == lang]
        n[own["i"].to_numpy(), k] = own["n"].to_numpy()
    return langs, np.log((n + 0.5) / (n + 0.5).sum(0)).astype(np.float32)


def _mixture(ll: np.ndarray, best: np.ndarray, starts: np.ndarray, owner: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents, languages) over the allowed ones, and log-likelihoods. ll: of the
    segments, less their best."""
    share = allowed / allowed.sum(1, keepdims=True)
    size = np.diff(np.r_[starts, len(ll)])[:, None]
    like = np.exp(ll)
    for _ in range(ITERATIONS):
        joint = like * share[owner]
        share = np.add.reduceat(joint / joint.sum(1, keepdims=True).clip(1e-30), starts, axis=0) / size
    total = np.log((like * share[owner]).sum(1).clip(1e-30)) + best
    return share, np.add.reduceat(total, starts)


def proportions(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """A row for each text: its languages' proportions; zeros if it has no word."""
    out = np.zeros((len(column), table.shape[1]))
    for a, b in slices(column, _BLOCK):
        data, offsets = byte_view(column.slice(a, b - a))
        starts, _, at = word_spans(data, offsets, NO_LETTER)
        words = np.diff(at)
        rows = np.flatnonzero(words)
        if not len(rows):
            continue
        first = np.arange(len(starts)) - np.repeat(at[:-1], words)
        heads = np.flatnonzero(first % SEGMENT == 0)
        ll = np.add.reduceat(table[ngrams(data)], starts[heads], axis=0).astype(np.float64)
        owner = np.repeat(np.arange(len(rows)), -(-words[rows] // SEGMENT))
        seg = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        best = ll.max(1)
        ll -= best[:, None]
        out[a + rows] = _select(ll, best, seg, owner)
    return out


def _select(ll: np.ndarray, best: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    n, langs = len(starts), ll.shape[1]
    alone = np.add.reduceat(ll + best[:, None], starts, axis=0)
    top = alone.argmax(1)
    allowed = np.zeros((n, langs))
    allowed[np.arange(n), top] = 1
    share, score = allowed.copy(), alone[np.arange(n), top]
    if langs == 1:
        return share
    full, _ = _mixture(ll, best, starts, owner, np.ones((n, langs)))
    order = np.argsort(-np.where(allowed > 0, np.inf, full), axis=1, kind="stable")
    cost = PENALTY * np.log(np.diff(np.r_[starts, len(ll)]) + 1.0)
    open_ = np.ones(n, bool)
    for k in range(1, langs):
        wider = allowed.copy()
        wider[np.arange(n), order[:, k]] = 1
        use = np.flatnonzero(open_ & (full[np.arange(n), order[:, k]] > 1e-4))
        if not len(use):
            break
        part = np.isin(owner, use)
        own = np.searchsorted(use, owner[part])
        new, value = _mixture(ll[part], best[part], np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), own, wider[use])
        better = value > score[use] + cost[use]
        took = use[better]
        share[took], score[took], allowed[took] = new[better], value[better], wider[took]
        open_[:] = False
        open_[took] = True
    return share


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_langs: a row for each row of docs."""
    langs, table = table_of(counts(docs))
    shared = docs.sparkSession.sparkContext.broadcast((langs, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs = shared.value
        for batch in batches:
            text = batch.column("text")
            known = np.array([bool(names) and _LETTER.search(x.as_py()) is not None for x in text], bool)
            share = proportions(text, logs) if names else np.zeros((len(text), 1))
            known_words = share.sum(1) > 0
            pick = share.argmax(1)
            lang = [names[k] if ok else "und" for k, ok in zip(pick, known & known_words, strict=True)]
            score = np.where(known & known_words, share.max(1), 0.0).clip(0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array((share > 0).sum(1), pa.int32())], ["doc_id", "lang_pred", "score", "n_langs"])

    out = texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, n_langs int")
    return out.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_langs")
