"""Numbers, ranks and predecessors in an order, without a task per key.

Rows are dealt by ranges of (keys, order), so that a key with a third of all rows is spread over as many
parts as it needs. What crosses from one part to the next is one row a part: how many rows came before, where the
last key began, and its last row. Those are carried over the parts, of which there are as many as shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracesieve.sources.tables import cut


def in_order(rows: DataFrame, keys: list[str], order: list[str], carry: list[str] | None = None) -> DataFrame:
    """rows with ordinal (from 0, over all rows by keys, then order), place (from 0, within the keys)
    and, for the columns of carry, before: a struct of them in the row before of the same keys, null for the
    first. (keys, order) should tell rows apart; nulls come first and make a key of their own."""
    spark = rows.sparkSession
    by = [*keys, *order]
    carry = list(carry or [])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a key that is one range's only value, or ties, may leave parts without rows
    dealt = cut(rows.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()))
    key = F.struct(*keys) if keys else F.lit(0)
    told = F.struct(*carry) if carry else F.lit(None).cast("int")
    w = Window.partitionBy("_part").orderBy(*by)
    local = dealt.select("*", (F.row_number().over(w) - 1).cast("long").alias("_at"), F.lag(key).over(w).alias("_key"), F.lag(told).over(w).alias("_told"), key.alias("_own"), told.alias("_mine"))
    starts = F.when((F.col("_at") == 0) | ~F.col("_own").eqNullSafe(F.col("_key")), F.col("_at"))
    local = local.withColumn("_start", F.max(starts).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # a row a part: its rows, its first and last key, where its last key begins in it, its last row
    ends = local.groupBy("_part").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("_own", "_at").alias("first"), F.max_by("_own", "_at").alias("last"), F.max("_start").alias("last_start"), F.max_by("_mine", "_at").alias("told")
    )
    p = Window.orderBy("_part")
    ends = ends.withColumn("base", F.coalesce(F.sum("n").over(p.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    goes_on = F.lag("last").over(p).eqNullSafe(F.col("first")) & (F.row_number().over(p) > 1)
    ends = ends.withColumn("goes_on", goes_on)
    # where the key of the part's first row began: the latest beginning in the parts before
    began = F.when(~(F.col("goes_on") & (F.col("last_start") == 0)), F.col("base") + F.col("last_start"))
    ends = ends.withColumns({"began": F.last(began, True).over(p.rowsBetween(Window.unboundedPreceding, -1)), "before": F.lag("told").over(p)})
    x = local.join(F.broadcast(ends.select("_part", "base", "goes_on", "began", F.col("before").alias("_carried"))), "_part")
    first_key = (F.col("_start") == 0) & F.col("goes_on")
    ordinal = F.col("base") + F.col("_at")
    place = F.when(first_key, ordinal - F.col("began")).otherwise(F.col("_at") - F.col("_start"))
    before = F.when(F.col("_at") == 0, F.when(F.col("goes_on"), F.col("_carried"))).when(F.col("_own").eqNullSafe(F.col("_key")), F.col("_told"))
    out = [ordinal.cast("long").alias("ordinal"), place.cast("long").alias("place")]
    return x.select(*(F.col(c) for c in rows.columns), *out, *([before.alias("before")] if carry else []))


def shards(items: DataFrame, order: list[str], n: int, base_seed: int) -> DataFrame:
    """items with shard, offset and seed: item i of the order goes to shard i mod n, at place i div n."""
    x = in_order(items, [], order)
    i = F.col("ordinal")
    return x.select(*items.columns, (i % n).alias("shard"), F.floor(i / n).cast("long").alias("offset"), (i + base_seed).alias("seed"))


def conflicts(rows: DataFrame, key: str, seq: str, tie: str) -> DataFrame:
    """rows whose number isn't the one before plus one (the first: 1), with the expected one."""
    x = in_order(rows, [key], [seq, tie], [seq])
    expected: Column = F.coalesce(F.col("before")[seq], F.lit(0)) + 1
    return x.select(*rows.columns, expected.cast("long").alias("expected")).filter(F.col(seq) != F.col("expected"))


def prefix_sums(rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """rows with ordinal and, for each of the columns, upto_COLUMN: its sum over the rows up to and with
    this one in the order; nulls add nothing. A part adds its own, what came before it is one row a part."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    w = Window.partitionBy("_part").orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.select("*", F.row_number().over(w).cast("long").alias("_at"), *(F.coalesce(F.sum(c).over(running), F.lit(0)).alias(f"_{c}") for c in columns))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in columns))
    bases = totals.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"), *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in columns))
    x = local.join(F.broadcast(bases), "_part")
    return x.select(*rows.columns, (F.col("_n") + F.col("_at") - 1).alias("ordinal"), *((F.col(f"_{c}") + F.col(f"_before_{c}")).alias(f"upto_{c}") for c in columns))
