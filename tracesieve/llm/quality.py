"""Quality: a regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance from all labelled training rows (their sums add up over
partitions; nothing is sampled), shrunk towards its own diagonal and the pooled one. The score is
the posterior of class 1 from the difference of Mahalanobis log-densities, by cached Cholesky
factors.

Null and empty texts: statistics of an empty text, and a score. No training rows: 0.5 for all;
rows of one class only: the smoothed share of class 1. Repeated rows count as often as they stand.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.llm.common import SPACE, bucket, byte_view, cut, slices, span_hashes, sums, texts, trim, word_spans

#: Score from which a document counts as good.
THRESHOLD = 0.7
#: Bytes of text looked at together.
_BLOCK = 2_000_000

_UPPER, _LOWER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_LOWER[128:] = True
_PLAIN = _UPPER | _LOWER | _DIGIT | SPACE
_PLAIN[[ord(c) for c in ".,'-"]] = True
_ODD = ~_PLAIN
_LINE = np.zeros(256, bool)
_LINE[10] = True


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """log-odds of a share, smoothed by half a unit."""
    return np.log((part + 0.5) / (whole - part + 0.5).clip(0.5))


def _distinct(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each owner, and how often the most frequent of them stands."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
    runs = np.diff(np.r_[first, len(k)])
    top = np.zeros(n)
    np.maximum.at(top, o[first], runs)
    return np.bincount(o[first], minlength=n).astype(float), top


NAMES = ("words", "letters", "spread", "upper", "odd", "digits", "distinct", "top", "repeats", "pairs", "lines", "line_length")


def statistics(column: pa.Array) -> np.ndarray:
    """A row of transformed statistics (NAMES) for each text."""
    out = [_block(column.slice(a, b - a)) for a, b in slices(column, _BLOCK)]
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


def _block(column: pa.Array) -> np.ndarray:
    data, offsets = byte_view(column)
    n, size = len(offsets) - 1, np.diff(offsets).astype(float)
    starts, ends, at = word_spans(data, offsets)
    words = np.diff(at).astype(float)
    length = (ends - starts).astype(float)
    mean = sums(length, at) / words.clip(1)
    spread = np.sqrt((sums(length**2, at) / words.clip(1) - mean**2).clip(0))
    upper, lower, digit, odd = (sums(t[data].astype(np.float32), offsets) for t in (_UPPER, _LOWER, _DIGIT, _ODD))
    keys, owner = span_hashes(data, starts, ends), np.repeat(np.arange(n), np.diff(at))
    distinct, top = _distinct(keys, owner, n)
    same = (owner[1:] == owner[:-1]) & (keys[1:] == keys[:-1]) if len(keys) > 1 else np.zeros(0, bool)
    repeats = np.bincount(owner[1:][same], minlength=n).astype(float)
    with np.errstate(over="ignore"):
        joint = keys[1:] * np.uint64(31) + keys[:-1] if len(keys) > 1 else keys[:0]
    inside = owner[1:] == owner[:-1] if len(keys) > 1 else np.zeros(0, bool)
    pairs, _ = _distinct(joint[inside], owner[1:][inside] if len(keys) > 1 else owner[:0], n)
    l_starts, l_ends, l_at = word_spans(data, offsets, _LINE)
    lines = np.diff(l_at).astype(float)
    l_distinct, _ = _distinct(span_hashes(data, l_starts, l_ends), np.repeat(np.arange(n), np.diff(l_at)), n)
    return np.stack([
        np.log1p(words), np.log1p(mean), np.log1p(spread), _share(upper, upper + lower), _share(odd, size), _share(digit, size),
        _share(distinct, words), _share(top, words), _share(repeats, words), _share(pairs, (words - 1).clip(0)), _share(l_distinct, lines), np.log1p(size / lines.clip(1)),
    ], axis=1)


def features(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics, for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(x)], ["doc_id", "x"])
            trim()

    return texts(docs).mapInArrow(run, "doc_id long, x array<double>")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Discriminant:
    log_odds: float
    means: np.ndarray | None = None  # (2, d)
    factors: np.ndarray | None = None  # (2, d, d): inverses of the lower Cholesky factors
    log_dets: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.log_odds)
        if self.means is not None:
            d = [((x - m) @ f.T) for m, f in zip(self.means, self.factors, strict=True)]
            z = z + 0.5 * ((d[0] ** 2).sum(1) + self.log_dets[0] - (d[1] ** 2).sum(1) - self.log_dets[1])
        return 1 / (1 + np.exp(-z.clip(-500, 500)))


def fit(rows: DataFrame, label: str = "label", own: float = 0.05, pooled: float = 0.05) -> Discriminant:
    """rows: label (0 or 1, others dropped) and x. own: share of the diagonal in a class
    covariance; pooled: share of the pooled covariance."""
    d = len(NAMES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            y, x = batch.column("label").to_numpy(zero_copy_only=False), _matrix(batch.column("x"), d)
            for k in (0, 1):
                own = x[y == k]
                totals[k] += np.r_[len(own), own.sum(0), (own.T @ own).ravel()]
        n = totals.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], n), pa.int32()), pa.array(np.tile(np.arange(n), 2), pa.int32()), pa.array(totals.ravel())], ["k", "i", "v"])

    kept = rows.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("label"), "x")
    totals = np.zeros((2, 1 + d + d * d))
    for k, i, v in kept.mapInArrow(partial, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v")).collect():  # 2 * (1 + d + d * d) rows
        totals[k, i] = v
    n = totals[:, 0]
    if not n.sum():
        return Discriminant(0.0)
    odds = float(np.log((n[1] + 0.5) / (n[0] + 0.5)))
    if n.min() < 2:
        return Discriminant(odds)
    means = totals[:, 1 : 1 + d] / n[:, None]
    covs = totals[:, 1 + d :].reshape(2, d, d) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    both = (covs * n[:, None, None]).sum(0) / n.sum()
    covs = [(1 - own - pooled) * c + own * np.diag(np.diag(c)) + pooled * both + 1e-6 * np.eye(d) for c in covs]
    lower = [np.linalg.cholesky(c) for c in covs]
    return Discriminant(odds, means, np.stack([np.linalg.inv(x) for x in lower]), np.array([2 * np.log(np.diag(x)).sum() for x in lower]))


def train(features_: DataFrame, labels: DataFrame) -> Discriminant:
    """Learns from the rows whose bucket (crc32 of the id, mod 4) is not 2."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label")).filter("label is not null")
    return fit(features_.filter(bucket("doc_id", 4) != 2).join(known, "doc_id"))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of docs."""
    x = cut(features(docs))
    model = train(x, labels)

    def run(column: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(column, len(NAMES))))

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return x.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), F.arrow_udf(run, "double")("x").alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns as they are, whose score reaches the threshold."""
    model = train(features(docs), labels)

    def run(column: pa.Array) -> pa.Array:
        out = pa.array(model.score(statistics(column)))
        trim()
        return out

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return docs.filter(F.arrow_udf(run, "double")(F.coalesce(F.col("text"), F.lit(""))) >= threshold)
