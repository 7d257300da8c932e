"""Queries over complete prompts: edges between conversations, and between them and protected items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.operators import prompts, screening
from tracesieve.plans.registry import query
from tracesieve.plans.sql import WORDS, shingles
from tracesieve.sources.tables import messages, table

# Every conversation has an edited copy: some turns are longer, in capitals, or replaced.
_COPY = 3_000_000
_EDITED = """case when conv_id % 5 = 0 and turn = 2 then 'something else' when (conv_id + turn) % 4 = 0 then text || ' and one more thing' when (conv_id + turn) % 4 = 1 then upper(text) else text end"""
_RECORDS = f"""c as (select conv_id as record, turn, role, text from conversations union all select conv_id + {_COPY}, turn, role, {_EDITED} from conversations),
 e as (select record, turn as i, 0 as j, role, 'content' as field, text from c union all
  select record, turn, 1, role, 'reasoning', split_part(text, ' ', 1) from c where role = 'assistant' and (record + turn) % 3 = 0),
 w as (select *, {WORDS} as words, array_to_string({WORDS}, ' ') as s from e where text is not null),
 u as (select record, i as target from e where j = 0 and role = 'assistant'),
 p as (select u.record, target, string_agg(role || '/' || field || '/' || j, '|' order by i, j) as shape, string_agg(md5(s), '|' order by i, j) as segs, string_agg(sha256(text), '|' order by i, j) as raw,
  bool_or(role = 'user' and field = 'content' and s <> '') as asks from u join w on w.record = u.record and w.i < target group by 1, 2),
 t as (select u.record, target, string_agg(field || sha256(text), '|' order by j) as raw from u join w on w.record = u.record and w.i = target group by 1, 2),
 q as (select p.record, target, shape, segs, sha256(shape || p.raw || t.raw) as rendered, sha256(shape || segs) as exact from p join t using (record, target) where asks)"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    k = (F.col("conv_id") + F.col("turn")) % 4
    edited = F.when((F.col("conv_id") % 5 == 0) & (F.col("turn") == 2), "something else").when(k == 0, F.concat("text", F.lit(" and one more thing"))).when(k == 1, F.upper("text")).otherwise(F.col("text"))
    both = c.union(c.select(F.col("conv_id") + _COPY, "turn", "role", edited))
    return messages(both).withColumnRenamed("conv_id", "record")


@query(f"""with {_RECORDS}, segs as (select md5(s) as seg, any_value(words) as words from w group by 1), g as ({" union all ".join(shingles(n, "segs", "seg") for n in range(8, 14))}),
 m as (select seg, n, count(*) as m from g group by 1, 2), k as (select a.seg as a, b.seg as b, n, count(*) as k from g a join g b using (n, g) where a.seg < b.seg group by 1, 2, 3),
 near as (select a, b, max(k / (ma.m + mb.m - k)) as similarity from k join m ma on ma.seg = a and ma.n = k.n join m mb on mb.seg = b and mb.n = k.n where k >= 0.8 * (ma.m + mb.m - k) group by 1, 2),
 first_ as (select target, exact, shape, segs, min(record) as record from q group by 1, 2, 3, 4),
 x as (select l.target, l.record as a, r.record as b, unnest(string_split(l.segs, '|')) as sa, unnest(string_split(r.segs, '|')) as sb from first_ l join first_ r on l.target = r.target and l.shape = r.shape and l.record < r.record),
 y as (select x.target, x.a, x.b, count(*) as differing, min(similarity) as similarity, bool_and(similarity is not null) as whole from x left join near on near.a = least(sa, sb) and near.b = greatest(sa, sb) where sa <> sb group by 1, 2, 3)
 select 'lexical_complete_prompt' as kind, target, a, b, differing, similarity from y where whole
 union all select 'exact_complete_prompt', target, a, b, null, null from (select target, min(record) over (partition by exact) as a, record as b from q) where a <> b
 union all select 'exact_training_example', target, a, b, null, null from (select target, min(record) over (partition by rendered) as a, record as b from q) where a <> b""")
def complete_prompt_edges(spark: SparkSession, d: str) -> DataFrame:
    return prompts.prompt_edges(_records(spark, d)).withColumn("target", F.col("target").cast("long"))


# Protected items: the first turns of every conversation whose number is divisible by 6, in capitals.
@query(f"""with {_RECORDS}, items as (select conv_id as item_id, {WORDS} as words from (select conv_id, upper(text) as text from conversations where turn = 0 and conv_id % 6 = 0))
 select q.record, target, item_id from q join items on q.shape = 'user/content/0' and q.segs = md5(array_to_string(items.words, ' ')) where len(items.words) > 0""")
def protected_prompts(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "conversations").filter("turn = 0 and conv_id % 6 = 0").select(F.col("conv_id").alias("item_id"), F.upper("text").alias("text"))
    found = prompts.item_prompts(_records(spark, d), items)
    return found.withColumn("target", F.col("target").cast("long"))


_LOOSE = 0.1


@query(f"""with docs as (select doc_id as id, {WORDS} as words from documents), items as (select item_id, {WORDS} as words from benchmark),
 t as ({" union all ".join(shingles(n, "docs", "id") for n in range(8, 14))}), i as ({" union all ".join(shingles(n, "items", "item_id") for n in range(8, 14))}),
 tm as (select id, n, count(*) as m from t group by 1, 2), im as (select item_id, n, count(*) as k from i group by 1, 2), x as (select id, item_id, n, count(*) as intersection from t join i using (n, g) group by 1, 2, 3)
 select id, item_id, n, intersection, m + k - intersection as total from x join tm using (id, n) join im using (item_id, n) where intersection >= {_LOOSE} * (m + k - intersection)""")
def protected_evidence(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return screening.protected_evidence(docs, table(spark, d, "benchmark"), threshold=_LOOSE)


# What conversations declare, by arithmetic on their numbers; some parents are no records, or the record itself.
_DECLARED = {
    "source": "case when conv_id % 3 > 0 then 's' || (conv_id % 40) end", "task_group": "case when conv_id % 4 > 0 then 'g' || (conv_id % 25) end",
    "sibling_group": "'b' || floor(conv_id / 4)", "component": "case when conv_id % 10 = 0 then 'c' || (conv_id % 30) end",
}


@query(f"""with r as (select distinct conv_id as record, {", ".join(f"{v} as {n}" for n, v in _DECLARED.items())} from conversations),
 k as (select 'source_item_revision' as kind, source as key, record from r union all select 'declared_task_group', task_group, record from r union all select 'declared_sibling', sibling_group, record from r union all select 'reference_component', component, record from r),
 s as (select kind, min(record) over (partition by kind, key) as a, record as b from k where key is not null)
 select kind, a, b from s where a <> b union select 'declared_parent', least(record, p), greatest(record, p) from (select record, unnest([record // 2, record * 3]) as p from r) where p <> record and p in (select record from r)""")
def declared_screening_edges(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id").distinct()
    parents = F.array(F.floor(F.col("conv_id") / 2).cast("long"), F.col("conv_id") * 3)
    return screening.declared(c.select(F.col("conv_id").alias("record"), *(F.expr(v).alias(n) for n, v in _DECLARED.items()), parents.alias("parents")))
