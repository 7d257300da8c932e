"""Queries over a cache that is put to, compacted and asked."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.operators import screening
from tracesieve.plans.corpus import _COMP, _edges
from tracesieve.plans.registry import query
from tracesieve.sources import cache
from tracesieve.sources.tables import cut, shared_folder, table

_KEYS = ("'h' || (event_id % 700) as content_hash", "event_type as kind", "'m' || (user_id % 3) as model", "case when event_id % 5 > 0 then 'r' || (event_id % 2) end as rubric_id")


# The events are put in three batches by their time, compacted after the second; all keys and some unknown ones are asked for.
@query(f"""with e as (select {', '.join(_KEYS)}, event_id, value, least(event_id * 3 // (select max(event_id) + 1 from events), 2) as batch from events),
 c as (select content_hash, kind, model, coalesce(rubric_id, '') as rubric_id, arg_max(event_id || ':' || value::decimal(18,4), event_id) as value from e group by all),
 q as (select distinct content_hash, kind, model, coalesce(rubric_id, '') as rubric_id from e union all select distinct 'h' || (event_id % 9), 'unknown', 'm0', '' from e)
 select q.*, c.value, c.value is not null as hit from q left join c using (content_hash, kind, model, rubric_id)""")
def cache_after_compaction(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    n = events.agg(F.max("event_id") + 1).first()[0] or 1
    rows = events.selectExpr(*_KEYS, "event_id", "value")
    rows = rows.withColumns({"batch": F.least(F.floor(F.col("event_id") * 3 / n), F.lit(2)), "value": F.concat(F.col("event_id").cast("string"), F.lit(":"), F.col("value").cast("decimal(18,4)").cast("string"))})
    keys = [F.coalesce(k, F.lit("")).alias(k) if k == "rubric_id" else F.col(k) for k in cache.KEYS]
    last = rows.groupBy("batch", *keys).agg(F.max_by("value", "event_id").alias("value"))
    path = f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}"
    for k in range(3):
        cache.put(last.filter(F.col("batch") == k), path)
        if k == 1:
            cache.compact(spark, path)
            cache.vacuum(spark, path)
    unknown = rows.select(F.concat(F.lit("h"), (F.col("event_id") % 9).cast("string")).alias("content_hash"), F.lit("unknown").alias("kind"), F.lit("m0").alias("model"), F.lit("").alias("rubric_id"))
    return cache.get(rows.select(*keys).distinct().union(unknown.distinct()), path)


@query(_COMP + " select node, root from comp")
def components_extended(spark: SparkSession, d: str) -> DataFrame:
    """Groups of the edges whose later end is even, then extended by the others."""
    edges = cut(_edges(spark, d))
    first, later = edges.filter("b % 2 = 0"), edges.filter("b % 2 <> 0")
    star = screening.components(first)
    return screening.resolved(star, *screening.extended_components(star, later))
