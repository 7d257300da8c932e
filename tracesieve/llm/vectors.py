"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are dealt into shards of bounded size by their hash. In each shard every tree has a sorted
array of hash strings: the symbols of a string are the axes, of AXES random ones, on which the
vector reaches furthest, with their sign, furthest first. A query descends each tree to its longest
common prefix; then all trees ascend together, a symbol at a time, until enough different entries
share the prefix; all of them become candidates, and the nearest by exact inner product stay.
Furthest axes tell near from far with far shorter prefixes than signs of projections do. Larger
norms are made up for by one more coordinate, so that the largest inner product is the smallest
angle. Every row is indexed; queries go in blocks of bounded size, one after another.

Null, zero, ragged or non-finite vectors take no part (the dimension is the one that most valid
vectors have, of equals the smaller). Ties go to the smaller id. Repeated rows are indexed once and
stand each for itself in results, except that a query's own id is no candidate; a query id of
several vectors searches for the least of them. Empty tables: no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracesieve.llm.common import cut, shared_folder

NEAREST = 20
TREES, AXES, SYMBOLS, SHARD, QUERIES = 96, 128, 4, 8192, 4096
#: Bits of a symbol: an axis and its sign.
WIDTH = 8
#: Share of a shard's entries, each counted once, to gather before the ascent stops.
GATHER = 0.2
#: Entries to gather at least.
LEAST = 256


def valid(df: DataFrame) -> tuple[DataFrame, int, float]:
    """(vec_id, v) of the vectors that take part, their dimension, and the largest norm."""
    v = F.col("embedding").cast("array<double>")
    finite: Column = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("longest"))
    found = sizes.orderBy(F.desc("n"), "dim").first()
    dim, longest = (found["dim"], found["longest"]) if found else (0, 0.0)
    return rows.filter(F.size("v") == dim), dim, longest


def _keys(v: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """(TREES, rows) hash strings as numbers, the first symbol on top."""
    random, wide = np.random.default_rng(20), np.column_stack([v, extra])
    out = np.zeros((TREES, len(v)), np.int64)
    for t in range(TREES):
        reach = wide @ random.standard_normal((wide.shape[1], AXES))
        length = np.abs(reach)
        for _ in range(SYMBOLS):
            axis = length.argmax(1)[:, None]
            positive = np.take_along_axis(reach, axis, 1) > 0
            out[t] = (out[t] << WIDTH) | (2 * axis + positive)[:, 0]
            np.put_along_axis(length, axis, -1.0, 1)
    return out


def _wide(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


_SHARD = "ids array<long>, times array<long>, v array<double>, keys array<long>, places array<int>"


def forest(rows: DataFrame, dim: int, longest: float) -> DataFrame:
    """A row for each shard: its ids (with how often each row stands) and vectors, and per tree
    the sorted keys and their places."""

    def shard(rows: pa.Table) -> pa.Table:
        v = _wide(rows.column("v").combine_chunks(), dim)
        keys = _keys(v, np.sqrt((longest**2 - (v * v).sum(1)).clip(0)))
        order = np.argsort(keys, axis=1, kind="stable")
        columns = [rows.column(c).to_numpy() for c in ("vec_id", "times")]
        columns += [v.ravel(), np.take_along_axis(keys, order, 1).ravel(), order.astype(np.int32).ravel()]
        return pa.table([pa.array([x]) for x in columns], ["ids", "times", "v", "keys", "places"])

    distinct = cut(rows.groupBy("vec_id", "v").agg(F.count("*").alias("times")))
    shards = max(1, -(-distinct.count() // SHARD))
    place = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards))
    return distinct.withColumn("shard", place).groupBy("shard").applyInArrow(shard, _SHARD)


def _candidates(keys: np.ndarray, places: np.ndarray, query: np.ndarray) -> Iterator[np.ndarray]:
    """keys, places: (TREES, n); query: (TREES, queries). Places for each query, one after another."""
    n = keys.shape[1]
    need = min(max(GATHER * n, LEAST), n)
    levels = []  # from the whole string up to the root, where all share the empty prefix
    for symbols in range(SYMBOLS, -1, -1):
        drop = WIDTH * (SYMBOLS - symbols)
        prefix = query >> drop
        lo = np.stack([np.searchsorted(k, x << drop) for k, x in zip(keys, prefix, strict=True)])
        hi = np.stack([np.searchsorted(k, (x + 1) << drop) for k, x in zip(keys, prefix, strict=True)])
        levels.append((lo, hi, (hi - lo).sum(0)))
    for q in range(query.shape[1]):
        mark = np.zeros(n, bool)
        for lo, hi, entries in levels[:-1]:  # ascending: all trees drop the same symbol at once
            if entries[q] >= need:
                for t in range(TREES):
                    mark[places[t, lo[t, q] : hi[t, q]]] = True
                if mark.sum() >= need:
                    break
        else:
            mark[:] = True
        yield np.flatnonzero(mark)


def _nearest(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: largest score, then smallest id."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        kept = np.flatnonzero(score >= least)
    else:
        kept = np.arange(len(score))
    return kept[np.lexsort((ids[kept], -score[kept]))][:k]


_FOUND = "query_id long, vec_id long, score double, times long"


def _search(shared, dim: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query = shared.value
        keys_of = _keys(query, np.zeros(len(query)))
        best = [(np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)) for _ in query_ids]
        for batch in batches:
            for row in range(batch.num_rows):
                ids, times, v, keys, places = (batch.column(c)[row].values.to_numpy() for c in ("ids", "times", "v", "keys", "places"))
                v = v.reshape(-1, dim)
                shape = (TREES, len(ids))
                for q, found in enumerate(_candidates(keys.reshape(shape), places.reshape(shape), keys_of)):
                    found = found[ids[found] != query_ids[q]]
                    near = ids[found], (v[found] * query[q]).sum(1), times[found]
                    near = [np.concatenate(x) for x in zip(best[q], near, strict=True)]
                    top = _nearest(near[1], near[0], k)
                    best[q] = tuple(x[top] for x in near)
        if any(len(x) for x, _, _ in best):
            columns = [np.repeat(query_ids, [len(x) for x, _, _ in best]), *(np.concatenate(x) for x in zip(*best, strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["query_id", "vec_id", "score", "times"])

    return run


def nearest(df: DataFrame, every: int = 20, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row whose id is divisible
    by `every`. A block of at most about QUERIES vectors is broadcast at a time; what it finds is
    written to the shared folder before the next one comes."""
    spark = df.sparkSession
    rows, dim, longest = valid(df)
    index = cut(forest(rows, dim, longest))
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-queries.count() // QUERIES))
    queries = cut(queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))))
    path = f"{shared_folder(spark)}/found-{uuid.uuid4().hex}"
    for b in range(blocks):
        own = queries.filter(F.col("block") == b).toPandas().sort_values("vec_id")
        shared = spark.sparkContext.broadcast((own["vec_id"].to_numpy(np.int64), np.stack(own["v"].to_numpy()) if len(own) else np.empty((0, dim))))
        index.mapInArrow(_search(shared, dim, k), _FOUND).write.mode("append").parquet(path)
        shared.destroy()
    each = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema(_FOUND).parquet(path)
    copies = found.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.least("times", F.lit(k)).cast("int"))))
    ranked = copies.withColumn("rank", F.row_number().over(each))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
