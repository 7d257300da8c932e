"""A cache of calls as a compacted snapshot and a log of later puts.

A put is a folder of its own, delta-N, renamed into place when it is whole; the highest number wins for a
key. compact() writes what a reader would see as snapshot-N, which stands for all deltas up to N; readers take the newest
snapshot and only the deltas after it. A number is taken by the rename: who comes second takes the next.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.sources.export import file_system

# What a call is known by. An absent rubric is the empty one.
KEYS = ("content_hash", "kind", "model", "rubric_id")


def _versions(spark: SparkSession, path: str, name: str) -> list[int]:
    fs, there = file_system(spark, path)
    if not fs.exists(there):
        return []
    found = (re.fullmatch(rf"{name}-(\d+)", x.getPath().getName()) for x in fs.listStatus(there))
    return sorted(int(m[1]) for m in found if m)


def _placed(rows: DataFrame, path: str, name: str, number: int, again: bool) -> int:
    spark = rows.sparkSession
    fs, there = file_system(spark, path)
    fs.mkdirs(there)
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    while True:
        target = f"{path}/{name}-{number:012d}"
        if not fs.exists(file_system(spark, target)[1]) and fs.rename(file_system(spark, staged)[1], file_system(spark, target)[1]):
            return number
        if not again:
            fs.delete(file_system(spark, staged)[1], True)
            return number
        number += 1


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rubric_id", F.coalesce("rubric_id", F.lit("")))


def put(rows: DataFrame, path: str) -> int:
    """Puts rows (KEYS, value), of which a key stands once, over what the cache has; returns their number."""
    rows = _keyed(rows).select(*KEYS, "value")
    spark = rows.sparkSession
    last = max([0, *_versions(spark, path, "delta"), *_versions(spark, path, "snapshot")])
    return _placed(rows, path, "delta", last + 1, True)


def state(spark: SparkSession, path: str) -> DataFrame | None:
    """KEYS, value, version: the last put of every key; None where nothing was put. A hot key is one row
    a task before it is moved."""
    snapshots = _versions(spark, path, "snapshot")
    base = snapshots[-1] if snapshots else 0
    parts = [spark.read.parquet(f"{path}/snapshot-{base:012d}")] if snapshots else []
    parts += [spark.read.parquet(f"{path}/delta-{v:012d}").withColumn("version", F.lit(v).cast("long")) for v in _versions(spark, path, "delta") if v > base]
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).groupBy(*KEYS).agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))


def get(requests: DataFrame, path: str) -> DataFrame:
    """requests (KEYS, any others) with the value that the cache has, null without one, and hit."""
    known = state(requests.sparkSession, path)
    requests = _keyed(requests)
    if known is None:
        return requests.select("*", F.lit(None).cast("string").alias("value"), F.lit(False).alias("hit"))
    return requests.join(known, list(KEYS), "left").withColumn("hit", F.col("version").isNotNull()).drop("version")


def compact(spark: SparkSession, path: str) -> int:
    """Writes the newest state as one snapshot; returns its number. Deltas stay for those who read now."""
    last = max([0, *_versions(spark, path, "delta")])
    now = state(spark, path)
    if now is None or last in _versions(spark, path, "snapshot"):
        return last
    return _placed(now.filter(F.col("version") <= last), path, "snapshot", last, False)


def vacuum(spark: SparkSession, path: str) -> None:
    """Deletes the deltas and snapshots that the newest snapshot stands for."""
    snapshots = _versions(spark, path, "snapshot")
    if not snapshots:
        return
    old = [f"delta-{v:012d}" for v in _versions(spark, path, "delta") if v <= snapshots[-1]] + [f"snapshot-{v:012d}" for v in snapshots[:-1]]
    for name in old:
        fs, there = file_system(spark, f"{path}/{name}")
        fs.delete(there, True)
