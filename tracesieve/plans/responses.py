"""Queries over captured responses. A response is ten events in a row; by its number it has one of
the faults that a stream may have, or none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.operators import responses
from tracesieve.plans.registry import query
from tracesieve.plans.sql import first_token
from tracesieve.sources.tables import table

# Of response r, case k = r % 17, delta s; read by Spark and by DuckDB alike.
_FIELDS = {
    "content": "case when k in (7, 14, 15) then null when k = 2 and s = 9 then null when k between 4 and 13 and (s > 2 or k = 4) then null when k = 16 and s = 5 then '<|im_end|>' else event_type || ';' end",
    "reasoning": "case when k in (0, 3) and s < 3 then '[' || event_type || ']' end",
    "refusal": "case when k = 15 and s in (4, 5) then 'No, ' || event_type end",
    "finish": """case when k = 1 then case when s = 7 then 'stop' end when k = 2 then case s when 8 then 'stop' when 9 then 'length' end when s < 9 then null when k = 3 then 'length'
      when k in (4, 5, 6, 7, 9, 10, 11, 12, 13) then 'tool_calls' else 'stop' end""",
    "native_finish": "case when s = 9 then event_type end",
    "call": "k between 4 and 13 and k <> 7 and s between 3 and 8",
    "call_index": "case when s < 6 then 0 when k = 9 then 2 else 1 end",
    "call_kind": "case when s in (3, 6) then case when k = 5 and s = 6 then 'custom' else 'function' end end",
    "call_id": "case when k = 10 and s = 6 then ' ' when k = 11 and s in (3, 6) then 'same' when k = 6 and s = 7 then 'other' when s = 3 then 'id0' when s = 6 then 'id1' end",
    "call_name": "case when s in (3, 6) then 'get_' when s in (4, 7) then event_type end",
    "call_args": "case when s in (4, 7) then '1' when k = 12 and s = 8 then ',' when k = 13 and s = 6 then '[' when k = 13 and s = 8 then ']' when s in (3, 6) then '{\"a\":' else '}' end",
    "detail_kind": "case when k in (0, 15) and s between 1 and 7 then case s when 4 then 'encrypted' when 5 then 'encrypted' when 7 then 'summary' else 'text' end end",
    "detail_index": "case when s < 3 then 0 when s < 6 then 1 else 2 end",
    "signature": "case when s in (1, 2, 6) then 'sig_' || event_type end",
    "served_by": "case when s >= 8 then 'p_' || event_type end",
    "prompt_tokens": "case when s in (8, 9) then event_id end",
}
_SQL = f"dl as (select r as response_id, s, k, event_type, {', '.join(f'{v} as {n}' for n, v in _FIELDS.items())} from (select *, event_id // 10 as r, event_id % 10 as s, (event_id // 10) % 17 as k from events))"


def _deltas(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumns({"r": F.floor(F.col("event_id") / 10).cast("long"), "s": F.col("event_id") % 10}).withColumn("k", F.col("r") % 17)
    x = e.select(F.col("r").alias("response_id"), F.col("s").alias("seq"), "event_type", *(F.expr(v).alias(n) for n, v in _FIELDS.items()))
    call = F.struct(F.col("call_index").alias("index"), F.col("call_kind").alias("kind"), F.col("call_id").alias("id"), F.col("call_name").alias("name"), F.col("call_args").alias("arguments"))
    block = F.struct(F.col("detail_kind").alias("kind"), F.col("detail_index").alias("index"), F.col("event_type").alias("text"), "signature")
    absent = {n: F.lit(None).cast(t) for n, t in {"model": "string", "generation_id": "string", "completion_tokens": "long", "reasoning_tokens": "long", "cost": "double"}.items()}
    return x.withColumns({"calls": F.when(F.col("call"), F.array(call)), "details": F.when(F.col("detail_kind").isNotNull(), F.array(block)), **absent})


_BLOCKS = """run as (select *, sum(case when before_ = detail_kind and at_ = detail_index and detail_kind <> 'encrypted' then 0 else 1 end) over (partition by response_id order by s) - 1 as place
   from (select *, lag(detail_kind) over w as before_, lag(detail_index) over w as at_ from dl where detail_kind is not null window w as (partition by response_id order by s))),
 blocks as (select response_id, place::bigint as place, any_value(detail_kind) as kind, any_value(detail_index)::bigint as index, string_agg(event_type, '' order by s) as text, first(signature order by s) as signature from run group by 1, 2)"""


@query(f"with {_SQL}, {_BLOCKS} select * from blocks")
def response_details(spark: SparkSession, d: str) -> DataFrame:
    return responses.detail_blocks(_deltas(spark, d)).withColumns({"place": F.col("place").cast("long"), "index": F.col("index").cast("long")})


_CALLS = """calls as (select response_id, call_index::bigint as index, arg_min(call_id, s) as id, string_agg(call_name, '' order by s) as name, string_agg(call_args, '' order by s) as arguments from dl where call group by 1, 2),
 call_errors as (select *, case when row_number() over (partition by response_id order by index) - 1 <> index then 'noncontiguous tool-call indices' when trim(coalesce(id, '')) = '' then 'missing tool-call identity'
   when row_number() over (partition by response_id, id order by index) > 1 or trim(name) = '' then 'duplicate identity or missing function name' when not json_valid(arguments) then 'incomplete or malformed tool arguments'
   when json_type(case when json_valid(arguments) then arguments end) <> 'OBJECT' then 'tool arguments must be an object' end as error from calls)"""


@query(f"with {_SQL}, {_CALLS} select response_id, index, id, name, arguments, error from call_errors")
def response_tool_calls(spark: SparkSession, d: str) -> DataFrame:
    return responses.tool_calls(_deltas(spark, d)).drop("sticky").withColumn("index", F.col("index").cast("long"))


@query(f"""with {_SQL}, {_CALLS}, {_BLOCKS},
 b as (select *, last_value(finish ignore nulls) over (partition by response_id order by s rows between unbounded preceding and 1 preceding) as before_ from dl),
 f as (select *, case when before_ is not null and (content is not null or reasoning is not null or detail_kind is not null or refusal is not null or call) then 'payload after terminal finish'
   when before_ <> finish then 'conflicting terminal reasons' end as fault from b),
 said as (select response_id, coalesce(string_agg(content, '' order by s), '') as content, count(content) > 0 as has_content, string_agg(reasoning, '' order by s) as reasoning, arg_max(refusal, s) as refusal, arg_max(finish, s) as finish,
   arg_max(native_finish, s) as native_finish, arg_min(fault, s) as fault, arg_min(served_by, s) as served_by, arg_min(prompt_tokens, s) as prompt_tokens from f group by 1),
 sticky as (select response_id, arg_max(fault, s) as sticky from (select response_id, s, case when call_id <> first_value(call_id ignore nulls) over (partition by response_id, call_index order by s) then 'conflicting tool-call identity'
   when call_kind <> 'function' then 'unsupported tool-call kind' end as fault from dl where call) group by 1),
 c as (select response_id, count(*) as n_calls, arg_min(error, index) as error from call_errors group by 1), k as (select response_id, count(*) as n_blocks from blocks group by 1),
 x as (select said.*, coalesce(n_calls, 0) as n_calls, coalesce(n_blocks, 0) as n_blocks, {first_token('content')} as token,
   coalesce(sticky, case when n_calls is null and finish = 'tool_calls' then 'tool_calls finish without calls' when n_calls > 0 and finish is distinct from 'tool_calls' then 'tool calls lack a supported terminal finish' else error end) as call_error
   from said left join c using (response_id) left join k using (response_id) left join sticky using (response_id)),
 o as (select *, case when fault is not null then 'invalid_completion' when finish = 'length' and (reasoning is not null or n_blocks > 0) then 'truncated_reasoning' when call_error is not null then 'invalid_completion'
   when content = '' and reasoning is null and n_blocks = 0 and refusal is null and n_calls = 0 then 'empty_response' when token is not null then 'control_token' else 'ok' end as outcome from x)
 select response_id, outcome, case outcome when 'invalid_completion' then coalesce(fault, call_error) when 'control_token' then token end as detail,
  case when content = '' and refusal is not null then refusal when not has_content and n_calls > 0 then null else content end as content, reasoning, refusal, finish, native_finish, n_calls, n_blocks, served_by, prompt_tokens from o""")
def response_turns(spark: SparkSession, d: str) -> DataFrame:
    return responses.turns(_deltas(spark, d)).drop("model", "generation_id", "completion_tokens", "reasoning_tokens", "cost")
