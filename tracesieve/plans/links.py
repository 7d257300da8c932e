"""Queries over tool links, execution reports and pairs of preferences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracesieve.operators import links, preference
from tracesieve.plans.registry import query
from tracesieve.sources.tables import table

# Assistants' turns call, users' later turns answer; ids and names by arithmetic, with every fault. Read by Spark and by DuckDB alike.
_CALL = {"call_id": "case when (conv_id + turn) % 7 = 0 then null when conv_id % 11 = 0 and turn > 2 then 'call0' else 'call' || turn end", "name": "'f' || (turn % 3)"}
_RESULT = {
    "call_id": "case when (conv_id + turn) % 13 = 0 then 'call' || (turn + 1) when (conv_id + turn) % 5 = 0 then 'call99' when (conv_id + turn) % 3 = 0 then null when conv_id % 4 = 0 and turn > 3 then 'call1' else 'call' || (turn - 1) end",
    "name": "case when conv_id % 6 = 0 then null when conv_id % 5 = 0 then 'f' || ((turn + 1) % 3) else 'f' || ((turn - 1) % 3) end",
}
_SQL = f"""calls as (select conv_id as record, turn as pos, {', '.join(f'{v} as {n}' for n, v in _CALL.items())} from conversations where role = 'assistant'),
 results as (select conv_id as record, turn as pos, {', '.join(f'{v} as {n}' for n, v in _RESULT.items())} from conversations where role = 'user' and turn > 0),
 links as (select r.record, r.pos, coalesce(case when r.call_id is not null then case when i.calls is null then 'unknown_call' when i.calls > 1 then 'duplicate_call' when i.declared >= r.pos then 'before_call'
    when row_number() over (partition by r.record, r.call_id order by r.pos) > 1 then 'second_result' end
   when n.same is null then 'unknown_name' when n.same > 1 then 'ambiguous_name' when n.with_id = 0 then 'call_without_id' when n.named >= r.pos then 'before_call' end, 'ok') as link
  from results r left join (select record, call_id, min(pos) as declared, count(*) as calls from calls where call_id is not null group by 1, 2) i on i.record = r.record and i.call_id = r.call_id
  left join (select record, name, min(pos) as named, count(*) as same, count(call_id) as with_id from calls group by 1, 2) n on n.record = r.record and n.name = coalesce(r.name, ''))"""


def _linked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "conversations")
    made = lambda rows, fields: rows.select(F.col("conv_id").alias("record"), F.col("turn").alias("pos"), *(F.expr(v).alias(n) for n, v in fields.items()))
    return made(c.filter("role = 'assistant'"), _CALL), made(c.filter("role = 'user' and turn > 0"), _RESULT)


@query(f"with {_SQL} select * from links")
def tool_result_links(spark: SparkSession, d: str) -> DataFrame:
    return links.result_links(*_linked(spark, d))


@query(f"""with {_SQL}, twice as (select record from (select record from calls where call_id is not null group by record, call_id having count(*) > 1) group by 1), bad as (select record, min({{'pos': pos, 'link': link}}) as f from links where link <> 'ok' group by 1)
 select e.record, case when twice.record is not null then 'duplicate_call' else f.link end as fault, case when twice.record is null then f.pos end as pos from (select record from calls union select record from results) e left join twice using (record) left join bad using (record)""")
def tool_record_links(spark: SparkSession, d: str) -> DataFrame:
    return links.record_links(*_linked(spark, d))


# An order is a candidate, its lines the cases of its report.
_REPORT = {
    "task": "'t' || (o_orderkey % 7)", "attempt": "'a' || o_orderkey", "patch": "'p' || o_custkey",
    "bound_task": "case when o_orderkey % 31 = 0 then null when o_orderkey % 19 = 0 then 'other' else 't' || (o_orderkey % 7) end",
    "bound_attempt": "case when o_orderkey % 31 = 0 then null when o_orderkey % 23 = 0 then 'other' else 'a' || o_orderkey end",
    "bound_patch": "case when o_orderkey % 31 = 0 then null when o_orderkey % 17 = 0 then 'old' else 'p' || o_custkey end",
    "outcome": "case when o_orderkey % 13 = 0 then 'unknown' when o_orderkey % 11 = 0 then 'failed' else 'passed' end",
    "exit_code": "case when o_orderkey % 9 = 0 then null when o_orderkey % 8 = 0 then 1 else 0 end",
    "errors": "case when o_orderkey % 29 = 0 then 2 else 0 end",
}
_CASE = {"node": "'n' || (case when l_partkey % 23 = 0 then 1 else l_linenumber end)", "status": "case when l_suppkey % 37 = 0 then 'failed' when l_suppkey % 3 = 0 then 'skipped' else 'passed' end"}
_REQUIRED = {"node": "'n' || l_linenumber"}
_HELD = "l_orderkey % 10 <> 3 and (l_linenumber = 1 or l_partkey % 5 = 0)"


@query(f"""with reports as (select o_orderkey as record, {', '.join(f'{v} as {n}' for n, v in _REPORT.items())} from orders), cases as (select l_orderkey as record, {', '.join(f'{v} as {n}' for n, v in _CASE.items())} from lineitem),
 required as (select distinct l_orderkey as record, {_REQUIRED['node']} as node from lineitem where {_HELD}),
 seen as (select record, count(*) as n, count(distinct node) as nodes, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'passed') as passed from cases group by 1),
 asked as (select r.record, count(*) as asked, count(*) filter (exists (select 1 from cases c where c.record = r.record and c.node = r.node and c.status = 'passed')) as met from required r group by 1),
 x as (select reports.*, coalesce(n, 0) as n, nodes, coalesce(failed, 0) as failed, coalesce(passed, 0) as passed, coalesce(asked, 0) as asked, coalesce(met, 0) as met from reports left join seen using (record) left join asked using (record)),
 y as (select *, case when asked = 0 or exit_code is null then 'unknown' when errors > 0 then 'failed' when n = 0 or nodes < n then 'unknown' when exit_code <> 0 or failed > 0 or met < asked then 'failed' when passed = 0 then 'unknown' else 'passed' end as detail from x),
 z as (select *, case when bound_task is null and bound_attempt is null and bound_patch is null then 'missing' when bound_task is distinct from task or bound_attempt is distinct from attempt then 'other_candidate' when bound_patch is distinct from patch then 'stale' end as why,
  case when outcome = 'unknown' or detail = 'unknown' then 'unknown' when outcome = 'failed' or detail = 'failed' then 'failed' else 'passed' end as both_ from y)
 select record, case why when 'missing' then 'unknown' when 'other_candidate' then 'failed' when 'stale' then 'unknown' else both_ end as verdict, coalesce(why, 'report_' || both_) as reason from z""")
def execution_verdicts(spark: SparkSession, d: str) -> DataFrame:
    reports = table(spark, d, "orders").select(F.col("o_orderkey").alias("record"), *(F.expr(v).alias(n) for n, v in _REPORT.items()))
    lines = table(spark, d, "lineitem")
    cases = lines.select(F.col("l_orderkey").alias("record"), *(F.expr(v).alias(n) for n, v in _CASE.items()))
    required = lines.filter(_HELD).select(F.col("l_orderkey").alias("record"), F.expr(_REQUIRED["node"]).alias("node"))
    return links.execution_verdicts(reports, cases, required)


# Every conversation is chosen over a copy with another last turn, or a fault; pairs with the next conversation share no prefix.
_SIDE = {
    "content": "case when side = 1 and turn = last and k <> 3 then text || ' But no.' when side = 0 and k = 4 and turn = last then ' ' when side = 0 and k = 5 and turn = 0 then '<|im_end|>' when side = 1 and k = 6 and turn = 0 then null when side = 1 and k = 7 and turn = 0 then text || '!' else text end",
    "reasoning": "case when k = 8 and turn = last then 'ab' when k = 9 and side = 1 and turn = 0 then 'why' when k in (10, 11, 12, 13) and side = 0 and turn = last then case when k = 12 then null else 'ab' end end",
    "first_kind": "case when (k = 8 or (k in (10, 11, 12, 13) and side = 0)) and turn = last then 'text' end",
    "second_kind": "case when k = 10 then 'summary' else 'text' end",
    "second_index": "case when k = 11 then 0 else 2 end",
    "second_text": "case when k = 13 then 'c' else 'b' end",
    "name": "case when k = 14 and side = 0 and turn = 0 then 'n' end",
    "tools": "k = 15 and side = 1 and turn = last",
}
_ROWS = "select *, conv_id % 17 as k, max(turn) over (partition by conv_id) as last from conversations"


@query(f"""with s as (select * from ({_ROWS}), (select unnest([0, 1]) as side)), m as (select conv_id, side, turn, role, last, k, {', '.join(f'{v} as {n}' for n, v in _SIDE.items())} from s),
 f as (select *, case when content is null or name is not null then 'not_plain_text' when first_kind is not null and reasoning is null then 'details_alone' when first_kind is not null and second_kind <> 'text' then 'details_not_plain'
   when first_kind is not null and second_index <= 0 then 'details_order' when first_kind is not null and 'a' || second_text <> reasoning then 'details_differ' when role <> 'assistant' and (reasoning is not null or first_kind is not null) then 'reasoning_of_another' end as fault from m),
 c as (select conv_id, side, case when bool_or(coalesce(contains(content, '<|im_end|>'), false)) then 'control_token' when bool_or(tools) then 'tools' else coalesce(arg_min(fault, turn) filter (fault is not null),
   case when arg_max(role, turn) <> 'assistant' or count(*) < 2 then 'not_terminal' when trim(arg_max(coalesce(content, ''), turn)) = '' then 'blank_completion' end) end as fault,
   string_agg(role || chr(1) || coalesce(content, chr(2)) || chr(1) || coalesce(reasoning, chr(2)) || chr(1) || coalesce(first_kind || second_kind || second_index || second_text, '') || coalesce(name, ''), chr(3) order by turn) filter (turn < last) as prefix,
   arg_max(role || chr(1) || coalesce(content, chr(2)) || chr(1) || coalesce(reasoning, chr(2)), turn) as completion, max(length(content)) filter (turn = last) as chars, count(*) - 1 as turns from f group by 1, 2),
 pairs as (select conv_id as a, conv_id as b from c where side = 0 union all select conv_id, conv_id + 1 from c where side = 0)
 select a as chosen_id, b as rejected_id, coalesce('chosen:' || x.fault, case when y.conv_id is null then 'rejected:missing' end, 'rejected:' || y.fault, case when x.prefix <> y.prefix then 'other_prefix' end, case when x.completion = y.completion then 'same_completion' end) as fault,
  case when coalesce(x.fault, y.fault) is null and y.conv_id is not null and x.prefix = y.prefix and x.completion <> y.completion then x.turns end as prompt_turns, case when coalesce(x.fault, y.fault) is null and y.conv_id is not null and x.prefix = y.prefix and x.completion <> y.completion then y.chars end as rejected_chars
 from pairs join c x on x.conv_id = a and x.side = 0 left join c y on y.conv_id = b and y.side = 1""")
def preference_projection(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").withColumns({"k": F.col("conv_id") % 17, "last": F.max("turn").over(Window.partitionBy("conv_id"))})
    m = c.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).select("conv_id", "side", "turn", "role", *(F.expr(v).alias(n) for n, v in _SIDE.items()))
    block = lambda kind, index, text: F.struct(F.col(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), index.cast("int").alias("index"), text.alias("text"))
    details = F.when(F.col("first_kind").isNotNull(), F.array(block("first_kind", F.lit(0), F.lit("a")), block("second_kind", F.col("second_index"), F.col("second_text"))))
    message = F.struct("turn", "role", "content", "reasoning", details.alias("details"), "name", "tools")
    whole = m.groupBy("conv_id", "side").agg(F.array_sort(F.collect_list(message)).alias("x"))
    fields = ("role", "content", "reasoning", "details", "name", "tools")
    convs = whole.select((F.col("conv_id") * 2 + F.col("side")).alias("id"), F.transform("x", lambda y: F.struct(*(y[f].alias(f) for f in fields))).alias("messages"), F.lit(False).alias("tools"))
    ids = table(spark, d, "conversations").select("conv_id").distinct()
    pairs = ids.select((F.col("conv_id") * 2).alias("chosen_id"), F.explode(F.array(F.col("conv_id") * 2 + 1, F.col("conv_id") * 2 + 3)).alias("rejected_id"))
    out = preference.projected_pairs(pairs, convs)
    return out.select(
        F.floor(F.col("chosen_id") / 2).cast("long").alias("chosen_id"), F.floor((F.col("rejected_id") - 1) / 2).cast("long").alias("rejected_id"), "fault",
        F.when(F.col("prompt").isNotNull(), F.size("prompt").cast("long")).alias("prompt_turns"), F.length("rejected.content").cast("long").alias("rejected_chars"),
    )
