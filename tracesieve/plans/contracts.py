"""Queries over contracts, suites, protected coverage, siblings and panels of decisive judges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracesieve.operators import consensus, contracts
from tracesieve.plans.registry import query
from tracesieve.plans.sql import VOTES
from tracesieve.sources.tables import table, votes

# Contracts by arithmetic on parts; names of tests are joined by commas. Read by Spark and by DuckDB alike.
_CONTRACT = {
    "answer_policy": "case p_partkey % 5 when 0 then 'absent' when 1 then 'advisory' when 2 then null else 'authoritative' end",
    "execution_policy": "case p_partkey % 7 when 0 then null when 1 then 'authoritative' when 2 then 'authoritative' else 'absent' end",
    "kind": "case when p_partkey % 11 < 4 then 'numeric_match' when p_partkey % 11 < 6 then 'set_match' when p_partkey % 11 < 8 then 'refusal_expected' else 'none' end",
    "oracle": "case when p_partkey % 35 = 15 then 'coding_suite' when p_partkey % 11 in (6, 7) then case when p_size % 2 = 0 then 'refusal_policy' else 'literal' end when p_size % 9 = 0 then 'none' when p_size % 4 = 0 then 'sandbox_execution' else 'literal' end",
    "expected": "case when p_size % 6 = 0 then null when p_size % 5 = 0 then 'about ten' else '1.5e3' end",
    "has_numeric": "(p_partkey % 11 < 4 and p_size % 8 > 0) or p_size % 13 = 0",
    "tests": "case when p_partkey % 35 = 15 then 'a,b' when p_partkey % 3 = 0 then '' when p_partkey % 10 = 1 then 'a,a' when p_partkey % 10 = 2 then 'a, ' else 'a,b,c' end",
    "cases": "case when p_size % 2 = 0 then 'a,b' else 'b,a' end",
}
_ROWS = f"(select p_partkey, {', '.join(f'{v} as {n}' for n, v in _CONTRACT.items())} from part)"


@query(f"""with c as (select *, case when tests = '' then [] else string_split(tests, ',') end as t, string_split(cases, ',') as s from {_ROWS}),
 d as (select *, kind = 'numeric_match' as numeric_, oracle in ('literal', 'sandbox_execution') as told from c)
 select p_partkey, case when answer_policy is null then 'no_answer_policy' when execution_policy is null then 'no_execution_policy'
  when oracle = 'coding_suite' and (answer_policy <> 'absent' or execution_policy <> 'authoritative' or kind <> 'none' or t <> s) then 'inexact_suite'
  when numeric_ and not has_numeric then 'numeric_missing' when numeric_ and told and expected = 'about ten' then 'numeric_expected' when not numeric_ and has_numeric then 'numeric_unused'
  when answer_policy <> 'absent' and not ((kind in ('numeric_match', 'set_match') and told) or (kind = 'refusal_expected' and oracle = 'refusal_policy')) then 'unsupported_comparator'
  when execution_policy = 'authoritative' and len(t) = 0 then 'no_tests' when len(list_filter(t, lambda x: trim(x) = '')) > 0 or len(list_distinct(t)) < len(t) then 'test_names' end as fault from d""")
def contract_faults(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "part").select("p_partkey", *(F.expr(v).alias(n) for n, v in _CONTRACT.items()))
    c = c.withColumns({"required_tests": F.when(F.col("tests") == "", F.array().cast("array<string>")).otherwise(F.split("tests", ",")), "suite_cases": F.split("cases", ",")})
    return c.select("p_partkey", contracts.contract_fault().alias("fault"))


@query("""select l_orderkey as record, case when bool_or(l_quantity < 3 or l_suppkey % 41 = 0) then 'unknown' when bool_or(l_quantity > 46) then 'failed' else 'passed' end as outcome from lineitem group by 1""")
def suite_outcomes(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("l_suppkey") % 41 == 0, "skipped").when(F.col("l_quantity") > 46, "failed").otherwise("passed")
    return contracts.suite_outcomes(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record"), status.alias("status"), (F.col("l_quantity") >= 3).alias("settled")))


# Protected sets are brands of parts; their items the parts; a language is a type's first word.
_SET = {
    "permitted": "b % 7 > 0", "reviewer": "case when b % 11 = 0 then ' ' else 'r' end", "evidence": "case when b % 5 = 0 then '' when b % 13 = 0 then 'a, ' else 'a' end",
    "complete": "b % 6 > 0", "languages": "case when b % 4 = 0 then 'SMALL,MEDIUM,LARGE,ECONOMY,PROMO' else 'SMALL,MEDIUM,LARGE,ECONOMY,PROMO,STANDARD' end", "media": "case when b % 9 = 0 then 'text,image' else 'text' end", "fields": "case when b % 8 = 0 then 'content' else 'content,reasoning' end",
}
_BRAND = "cast(substr(p_brand, 7) as int)"


@query(f"""with s as (select distinct {_BRAND} as b from part where {_BRAND} % 17 <> 3), x as (select b, {', '.join(f'{v} as {n}' for n, v in _SET.items())} from s),
 i as (select {_BRAND} as b, split_part(p_type, ' ', 1) as language from part where {_BRAND} % 19 <> 4), o as (select b, count(*) as items, list(distinct language) as spoken from i group by 1),
 y as (select x.*, string_split(languages, ',') as ls, coalesce(items, 0) as items, coalesce(spoken, []) as spoken from x left join o using (b)),
 z as (select b, unnest([case when not (permitted and trim(reviewer) <> '' and evidence <> '' and not list_contains(list_transform(string_split(evidence, ','), lambda e: trim(e)), '')) then 'unresolved_protected_rights' end,
  case when not (complete and items > 0) then 'incomplete_protected_contents' end,
  case when not (list_has_all(ls, ['SMALL', 'LARGE']) and list_has_all(ls, spoken) and media = 'text' and list_has_all(string_split(fields, ','), ['content', 'reasoning'])) then 'incomplete_protected_coverage' end]) as issue from y)
 select b as set_id, issue from z where issue is not null union all select distinct {_BRAND}, 'missing_protected_set' from part where {_BRAND} not in (select b from s)""")
def protected_coverage_issues(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").withColumn("b", F.expr(_BRAND))
    names = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, ",")).alias(c)
    sets = part.filter("b % 17 <> 3").select("b").distinct().select("b", *(F.expr(v).alias(n) for n, v in _SET.items()))
    sets = sets.select(F.col("b").alias("set_id"), "permitted", "reviewer", "complete", *(names(c) for c in ("evidence", "languages", "media", "fields")))
    items = part.filter("b % 19 <> 4").select(F.col("b").alias("set_id"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("language"))
    return contracts.coverage_issues(sets, items, part.select(F.col("b").alias("set_id")), ["SMALL", "LARGE"], ["content", "reasoning"])


# Siblings are orders, four to a group, some without evidence, some declared otherwise.
_MEMBER = {
    "run_id": "'run' || (cast(floor(o_orderkey / 4) as bigint) % 3)", "group_id": "case when o_orderkey % 47 = 0 then null else 'p' || cast(floor(o_orderkey / 4) as bigint) end",
    "n_completions": "case when o_orderkey % 53 = 0 then 5 when o_orderkey % 59 = 0 then 0 else 4 end", "completion_index": "case when o_orderkey % 61 = 0 then 4 when o_orderkey % 67 = 0 then 0 else o_orderkey % 4 end",
    "prompt_hash": "case when o_orderkey % 71 = 0 then 'other' else 'p' || cast(floor(o_orderkey / 4) as bigint) end", "prefix": "case when o_orderkey % 73 = 0 then 'x' else 'y' end",
}
_DECLARED = "o_orderkey % 79 <> 0 and floor(o_orderkey / 4) % 31 <> 5"


@query(f"""with m as (select o_orderkey as record, {', '.join(f'{v} as {n}' for n, v in _MEMBER.items())} from orders), k as (select * from m where group_id is not null),
 said as (select distinct run_id, 'p' || cast(floor(o_orderkey / 4) as bigint) as group_id, record from (select *, o_orderkey as record, {_MEMBER['run_id']} as run_id from orders where {_DECLARED})), named as (select distinct run_id, group_id from said),
 g as (select run_id, group_id, count(*) as n, min(n_completions) as lo, max(n_completions) as hi, count(distinct completion_index) as ix, count(distinct prefix) as px from k group by 1, 2),
 diff as (select distinct run_id, group_id from (select k.run_id as kr, said.run_id as sr, coalesce(k.run_id, said.run_id) as run_id, coalesce(k.group_id, said.group_id) as group_id from k full join said on k.run_id = said.run_id and k.group_id = said.group_id and k.record = said.record) where kr is null or sr is null)
 select run_id, group_id, record, case when group_id is null then 'missing_sibling_evidence' else 'invalid_sibling_identity' end as issue from m where group_id is null or n_completions = 0 or completion_index >= n_completions or prompt_hash <> group_id
 union all select run_id, group_id, null, 'undeclared_sibling_set' from g where (run_id, group_id) not in (select run_id, group_id from named)
 union all select run_id, group_id, null, 'expected_sibling_membership' from diff where (run_id, group_id) in (select run_id, group_id from named)
 union all select run_id, group_id, null, 'incomplete_or_inconsistent_siblings' from g where (run_id, group_id) in (select run_id, group_id from named) and (lo <> n or hi <> n or ix <> n or px > 1)""")
def sibling_issues(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    members = orders.select(F.col("o_orderkey").alias("record"), *(F.expr(v).alias(n) for n, v in _MEMBER.items()))
    declared = orders.filter(_DECLARED).select(F.col("o_orderkey").alias("record"), F.expr(_MEMBER["run_id"]).alias("run_id"), F.expr("'p' || cast(floor(o_orderkey / 4) as bigint)").alias("group_id"))
    return contracts.sibling_issues(members, declared)


@query(f"""with {VOTES}, v as (select *, row_number() over (partition by record_id order by pos, judge, weight, score, verdict) as p from votes where verdict <> 'uncertain'),
 cross_ as (select a.record_id, sum(2 * a.weight * b.weight * case when a.judge = b.judge then 0.8 when abs(substr(a.judge, 6)::int - substr(b.judge, 6)::int) = 1 then 0.5 else 0.0 end) as x from v a join v b on a.record_id = b.record_id and a.p < b.p group by 1)
 select record_id, count(*) as decisive, round(least(pow(sum(weight), 2) / (sum(weight * weight) + coalesce(max(x), 0)), count(*)), 9) as n_eff from v left join cross_ using (record_id) group by record_id""")
def decisive_effective_n(spark: SparkSession, d: str) -> DataFrame:
    """The correlations of a panel, without the rows and columns of judges that weren't sure."""
    pairs = [(f"judge{i}", f"judge{j}", 0.8 if i == j else 0.5 if abs(i - j) == 1 else 0.0) for i in range(5) for j in range(5)]
    rho = spark.createDataFrame(pairs, "judge_a string, judge_b string, rho double")
    order = Window.partitionBy("record_id").orderBy("pos", "judge", "weight", "score", "verdict")
    sure = votes(table(spark, d, "lineitem")).withColumn("pos", F.row_number().over(order))
    n = consensus.decisive_n(sure, rho)
    return n.withColumn("n_eff", F.round("n_eff", 9))
