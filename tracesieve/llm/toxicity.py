"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashes of its words (runs of letters, in lower case), whole and cut
to stems, of pairs of neighbours and of pairs with one word between. Per-coordinate learning rates and L1 leave few
weights other than 0, which are broadcast (2^BITS entries at most) and summed over a text's
distinct features. The classifier learns from a bounded sample of the labelled training rows
(SAMPLE of each class, by the order of a hash of the id); the intercept is corrected for that.

Null and empty texts have no features and get the score of the intercept. No training rows: 0.
Repeated and conflicting labels count as often as they stand, and so do repeated documents. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import NO_LETTER, bucket, byte_view, cut, lowered, mix64, slices, span_hashes, texts, word_spans

THRESHOLD = 0.3
BITS = 20
#: Most labelled rows of each class that the model learns from.
SAMPLE = {0: 11_000, 1: 7_000}
#: Bytes of the stems that longer words are cut to, beside the whole words.
STEMS = (4, 5)
_BLOCK = 2_000_000


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of every gram; not distinct."""
    data, offsets = byte_view(column)
    data = lowered(data)
    starts, ends, at = word_spans(data, offsets, NO_LETTER)
    words, owner = span_hashes(data, starts, ends), np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(at))
    keys, owners = [words], [owner]
    for size in STEMS:
        longer = ends - starts > size
        keys.append(mix64(span_hashes(data, starts[longer], starts[longer] + size) + np.uint64(size)))
        owners.append(owner[longer])
    with np.errstate(over="ignore"):
        for gap, salt in ((1, 0x51), (2, 0x52)):
            inside = owner[gap:] == owner[:-gap]
            keys.append(mix64(words[:-gap] * np.uint64(3) + words[gap:] + np.uint64(salt))[inside])
            owners.append(owner[gap:][inside])
    return np.concatenate(owners), (np.concatenate(keys) >> np.uint64(64 - BITS)).astype(np.int32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, content, text) to (doc_id, content, f): the distinct features."""
    for batch in batches:
        for a, b in slices(batch.column("text"), _BLOCK):
            part = batch.slice(a, b - a)
            owner, key = grams(part.column("text"))
            both = np.unique((owner.astype(np.int64) << 32) | key)
            at = np.searchsorted(both >> 32, np.arange(b - a + 1))
            f = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array((both & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("content"), f], ["doc_id", "content", "f"])


def ftrl(rows: list[tuple[int, np.ndarray]], epochs: int = 6, alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and intercept from (label, features) rows, taken in order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z0 = n0 = 0.0
    for _ in range(epochs):
        for y, f in rows:
            zf, root = z[f], np.sqrt(n[f])
            w = np.where(np.abs(zf) > l1, (np.sign(zf) * l1 - zf) / ((beta + root) / alpha + l2), 0.0)
            b = -z0 / ((beta + np.sqrt(n0)) / alpha)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - y
            after = np.sqrt(n[f] + g * g)
            z[f] += g - (after - root) / alpha * w
            n[f] += g * g
            s0 = (np.sqrt(n0 + g * g) - np.sqrt(n0)) / alpha
            z0, n0 = z0 + g - s0 * b, n0 + g * g
    w = np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    return w, float(-z0 / ((beta + np.sqrt(n0)) / alpha))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, f) of the whole sample to (i, w); the intercept has i = -1."""
    rows = []
    for batch in batches:
        f = batch.column("f")
        values, at = f.values.to_numpy(), f.offsets.to_numpy()
        rows += [(y, values[at[k] : at[k + 1]].copy()) for k, y in enumerate(batch.column("label").to_pylist())]
    if rows:
        w, b = ftrl(rows)
        i = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, i], pa.int32()), pa.array(np.r_[b, w[i]])], ["i", "w"])


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Features that have a weight (in order), their weights, and the intercept. Learns from the
    rows whose bucket (crc32 of the id, mod 4) is not 2."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).filter("label in (0, 1)").filter(bucket("doc_id", 4) != 2)
    own = texts(docs).select("doc_id", F.xxhash64("text").alias("content"))
    there = own.join(known, "doc_id")  # a row for each document and label
    count = dict(there.groupBy("label").count().collect())
    if not count:
        return np.empty(0, np.int32), np.empty(0), -np.inf
    picked = None
    for y, most in SAMPLE.items():
        part = there.filter(F.col("label") == y).withColumn("at", F.xxhash64("doc_id")).orderBy("at", "doc_id", "content").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    picked = cut(picked)  # at most sum(SAMPLE) rows, a bounded broadcast
    key = ["doc_id", "content"]
    rows = texts(docs).withColumn("content", F.xxhash64("text")).join(F.broadcast(picked.select(*key).distinct()), key, "left_semi").dropDuplicates(key)
    sample = rows.mapInArrow(_features, "doc_id long, content long, f array<int>").join(F.broadcast(picked), key)
    weights = sample.repartition(1).sortWithinPartitions("at", "doc_id", "content", "label").select("label", "f").mapInArrow(_learn, "i int, w double").toPandas().sort_values("i")
    drawn = {y: min(count.get(y, 0), most) for y, most in SAMPLE.items()}
    shift = sum((1 - 2 * y) * np.log(max(drawn[y], 1) / max(count.get(y, 0), 1)) for y in SAMPLE)
    i, w = weights["i"].to_numpy(np.int32), weights["w"].to_numpy(float)
    return i[1:], w[1:], float(w[0] + shift)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of docs."""
    index, weights, intercept = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((index, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, w = shared.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[i] = w
        some = dense != 0
        for batch in batches:
            for a, b in slices(batch.column("text"), _BLOCK):
                owner, key = grams(batch.column("text").slice(a, b - a))
                kept = some[key]
                both = np.unique((owner[kept].astype(np.int64) << 32) | key[kept])
                z = np.bincount(both >> 32, dense[both & 0xFFFFFFFF], minlength=b - a) + intercept
                with np.errstate(over="ignore"):
                    score = 1 / (1 + np.exp(-z))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(score)], ["doc_id", "score"])

    out = texts(docs).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
