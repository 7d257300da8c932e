"""Queries over budgets of work that are charged in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.operators import budgets
from tracesieve.plans.registry import query
from tracesieve.plans.sql import WORDS, shingles
from tracesieve.sources.tables import cut, table

# Limits that these documents pass in turn, each alone and some together; records are sources of documents, their units the documents.
CASES = {
    "defaults": {}, "bytes": {"segment_bytes": 3000}, "number": {"segments": 77}, "all_bytes": {"total_text_bytes": 30_000}, "tokens": {"segment_tokens": 400},
    "work": {"shingle_token_work": 100_000}, "shingles": {"distinct_shingles": 9000}, "pairs": {"comparisons": 3000}, "both": {"segment_tokens": 900, "total_text_bytes": 90_000},
    "ties": {"distinct_shingles": 9000, "shingle_token_work": 76_000}, "later": {"comparisons": 3000, "distinct_shingles": 150_000},
}


def _case(name: str, limits: dict) -> str:
    m = budgets.LIMITS | limits
    taken = [("segment_bytes", "b"), ("segments", "i + 1"), ("total_text_bytes", "sb"), ("segment_tokens", "t")]
    phase0 = "coalesce(" + ", ".join(f"case when {u} > {m[n]} then {{'place': {k}, 'counter': '{n}', 'length': null::int, 'used': ({u})::bigint}} end" for k, (n, u) in enumerate(taken)) + ")"
    one = f"""case when sw > {m['shingle_token_work']} then {{'place': 0, 'counter': 'shingle_token_work', 'length': n::int, 'used': sw::bigint}} when ss > {m['distinct_shingles']} then {{'place': 1, 'counter': 'distinct_shingles', 'length': n::int, 'used': ss::bigint}} end"""
    return f"""select '{name}' as case_, coalesce(x.counter, 'complete') as counter, i as ordinal, x.length as length, x.used as used from (select min({{'phase': phase, 'i': i, 'n': n, 'x': x}}) as f from (
   select 0 as phase, i, 0 as n, {phase0} as x from seg union all select 1, i, n, {one} from made
   union all select 2, i, 0, case when sp > {m['comparisons']} then {{'place': 0, 'counter': 'comparisons', 'length': null::int, 'used': sp::bigint}} end from pairs) where x is not null), lateral (select f.x as x, f.i as i)"""


@query(f"""with docs as (select doc_id, coalesce(text, '') as text, {WORDS.replace('text', "coalesce(text, '')")} as words from documents),
 seg as (select doc_id, row_number() over (order by doc_id) - 1 as i, octet_length(encode(text))::bigint as b, sum(octet_length(encode(text))) over (order by doc_id) as sb, len(words) as t from docs),
 g as ({" union all ".join(f"select doc_id, {n} as n, count(*) as k from ({shingles(n, 'docs', 'doc_id')}) group by 1" for n in budgets.LENGTHS)}),
 made as (select i, n, sum(greatest(0, t - n + 1) * n) over (order by i, n) as sw, sum(coalesce(k, 0)) over (order by i, n) as ss from (select * from seg cross join (select unnest({list(budgets.LENGTHS)}) as n)) left join g using (doc_id, n)),
 units as (select doc_id % 50 as r, count(*) as u from documents group by 1), p as (select r, u, sum(u) over (order by r) - u as before_ from units), pairs as (select row_number() over (order by r) - 1 as i, sum(u * before_) over (order by r) as sp from p)
 {" union all ".join(_case(n, x) for n, x in CASES.items())}""")
def work_budgets(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    segments = cut(budgets.charged_segments(docs.select("doc_id", "text"), ["doc_id"]))
    records = cut(budgets.charged_records(docs.groupBy((F.col("doc_id") % 50).alias("r")).agg(F.count(F.lit(1)).alias("units")), ["r"]))
    return budgets.first_over(segments, CASES, records)
