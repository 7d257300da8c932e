"""A tree of digests over sorted rows: an identity of the whole, and of every part of it.

Leaf i is the digest of row i in the order of the key; a node is the digest of up to FAN digests below
it. Where rows are cut into tasks doesn't matter. A level is one aggregation, and FAN times smaller than the one below, so
that the work is that of the leaves. Two trees differ below a node only where its digests differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracesieve.operators.sequences import in_order
from tracesieve.sources.tables import cut

FAN = 256


def row_digest(columns: list[str]):
    """SHA-256 of a row: its columns by name, each as text in JSON, null as nothing."""
    texts = [F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit("{}")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\u0001", *texts), 256)


def tree(rows: DataFrame, key: list[str], fan: int = FAN, digest=None) -> DataFrame:
    """level (0: the leaves), i, digest of every node of the tree of rows; the root is the only node of the last
    level. digest: a column that stands for a row, row_digest of all columns by default. The key should tell rows
    apart: equal ones take the order of their digests. No rows: no nodes."""
    named = rows.withColumn("_digest", row_digest(rows.columns) if digest is None else digest)
    level = cut(in_order(named.select(*key, "_digest"), [], [*key, "_digest"]).select(F.col("ordinal").alias("i"), F.col("_digest").alias("digest")))
    levels, n = [level.withColumn("level", F.lit(0))], level.count()
    while n > 1:
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: x["digest"])
        level = cut(level.groupBy(F.floor(F.col("i") / fan).cast("long").alias("up")).agg(F.sha2(F.array_join(ordered, ""), 256).alias("digest")).withColumnRenamed("up", "i"))
        levels.append(level.withColumn("level", F.lit(len(levels))))
        n = -(-n // fan)
    return reduce(DataFrame.unionByName, levels).select("level", "i", "digest")


def root(nodes: DataFrame) -> str | None:
    """The digest of a tree; None without rows."""
    top = nodes.agg(F.max_by("digest", "level")).first()
    return top[0]


def proof(nodes: DataFrame, leaf: int, fan: int = FAN) -> list[tuple[int, list[str]]]:
    """For each level from the leaves up: the row's place among the digests that its node is made of, and
    those. At most fan digests a level are read."""
    height = nodes.agg(F.max("level")).first()[0]
    wanted = reduce(lambda a, b: a | b, [(F.col("level") == k) & (F.floor(F.col("i") / fan) == leaf // fan ** (k + 1)) for k in range(height)], F.lit(False))
    found: dict[int, list] = {}
    for x in nodes.filter(wanted).orderBy("level", "i").collect():
        found.setdefault(x["level"], []).append(x["digest"])
    return [(leaf // fan**k % fan, found[k]) for k in sorted(found)]


def proven(digest: str, path: list[tuple[int, list[str]]], top: str) -> bool:
    """Whether a row of that digest stands where the proof says, under that root."""
    import hashlib

    for place, below in path:
        if place >= len(below) or below[place] != digest:
            return False
        digest = hashlib.sha256("".join(below).encode()).hexdigest()
    return digest == top


def changed(a: DataFrame, b: DataFrame, fan: int = FAN) -> DataFrame:
    """The numbers of the rows that two trees don't share: from the top down, only what lies below nodes
    that differ is compared; those are as many as the changed rows at most, on each level."""
    levels = max(x.agg(F.coalesce(F.max("level"), F.lit(-1))).first()[0] for x in (a, b))
    open_ = None
    for k in range(levels, -1, -1):
        left, right = (x.filter(F.col("level") == k).select("i", F.col("digest").alias(n)) for x, n in ((a, "left"), (b, "right")))
        if open_ is not None:
            left, right = (x.withColumn("up", F.floor(F.col("i") / fan)).join(open_, "up", "left_semi").drop("up") for x in (left, right))
        open_ = cut(left.join(right, "i", "full").filter(~F.col("left").eqNullSafe(F.col("right"))).select(F.col("i").cast("long").alias("up")))
    if open_ is None:
        return a.select("i").limit(0)
    return open_.select(F.col("up").alias("i"))
