"""Queries over keyed machines: lifecycles of records and receipts of attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.operators import ledger, lifecycle
from tracesieve.plans.registry import query
from tracesieve.sources.tables import table

# The state that an event asks for; read by Spark and by DuckDB alike.
_ASKED = """case (event_id * 7 + user_id) % 16 when 0 then 'user_synthesized' when 1 then 'user_synthesized' when 2 then 'assistant_generated' when 3 then 'assistant_generated' when 4 then 'assistant_generated'
 when 5 then 'verified' when 6 then 'verified' when 7 then 'verified' when 8 then 'judged' when 9 then 'judged' when 10 then 'admitted' when 11 then 'formatted'
 when 12 then case event_id % 4 when 0 then 'exported' when 1 then 'rejected' when 2 then 'revising' else 'needs_review' end when 13 then 'error' when 14 then 'seeded' else 'published' end"""
_STEPS = ", ".join(f"('{s}', '{t}')" for s, to in lifecycle.STEPS.items() for t in to)


def lifecycle_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("record_id"), F.col("ts").alias("at"), "event_id", F.expr(_ASKED).alias("state"))


@query(f"""with recursive steps(s, t) as (values {_STEPS}), e as (select user_id as record_id, {_ASKED} as asked, row_number() over (partition by user_id order by ts, event_id) as i from events),
 r(record_id, i, state, steps, attempts, repeated, illegal, over_cap) as (select distinct record_id, 0::bigint, 'seeded', 0, 0, 0, 0, 0 from e
  union all select r.record_id, e.i, case when goes then asked else state end, steps + goes::int, attempts + (goes and asked = 'seeded')::int, repeated + (asked = state)::int, illegal + (asked <> state and not legal)::int, over_cap + (asked <> state and legal and not goes)::int
  from r join e on e.record_id = r.record_id and e.i = r.i + 1, lateral (select exists (select 1 from steps where s = r.state and t = e.asked) as legal), lateral (select legal and asked <> state and steps < {lifecycle.CAP} as goes))
 select record_id, state, state in ('exported', 'formatted', 'rejected', 'needs_review', 'error', 'revising') as terminal, steps, attempts, repeated, illegal, over_cap from r qualify row_number() over (partition by record_id order by i desc) = 1""")
def record_lifecycles(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.lifecycles(lifecycle_events(spark, d))


# An attempt is eight events in a row: an intent, five observations, a settlement, an interpretation; by its number (a % 11) one of
# the faults. m: the observation whose metadata it carries.
_RECEIPT = {
    "kind": "case when s = 0 then 'intent' when s = 6 or (k = 7 and s = 5) then 'settle' when s = 7 or (k = 8 and s = 5) then 'interpret' else 'observe' end",
    "sequence": "case when k = 1 and s > 2 then s - 2 when k = 2 and s = 3 then 5 else s - 1 end",
    "status": "case when s = 5 then 'other' when s = 6 then 'complete' when s = 7 then 'accepted' end",
    "cost_state": "case when m < 2 then 'missing' else 'known' end",
    "cost_usd": "case when k = 6 and m = 3 then cast(-1 as double) when k = 5 and m = 4 then cast(0.25 as double) when m >= 2 then cast(m as double) * 0.5 end",
    "prompt_tokens": "case when k = 3 and m = 4 then a else a * 10 + m end",
    "completion_tokens": "case when m >= 3 then m end",
    "total_tokens": "case when m = 5 then a * 20 end",
    "reasoning_tokens": "case when m in (2, 4) then m * 2 when k = 9 and m = 5 then 1 end",
    "response_id": "case when m >= 2 then case when k = 10 and m = 5 then 'again' else 'r' end end",
    "model": "case when k = 4 and m = 4 then 'other' else 'm' end",
    "provider": "case when m >= 3 then 'p' end",
}
_EV = f"ev as (select a as attempt_id, event_id, {', '.join(f'{v} as {n}' for n, v in _RECEIPT.items())} from (select *, case when k = 1 and s = 3 then 2 else s end as m from (select event_id, event_id // 8 as a, event_id % 8 as s, (event_id // 8) % 11 as k from events)))"


def receipt_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.floor(F.col("event_id") / 8).cast("long").alias("a"), (F.col("event_id") % 8).alias("s")).withColumn("k", F.col("a") % 11)
    e = e.withColumn("m", F.expr("case when k = 1 and s = 3 then 2 else s end"))
    return e.select(F.col("a").alias("attempt_id"), "event_id", *(F.expr(v).alias(n) for n, v in _RECEIPT.items()))


_VALUES = (*ledger.COUNTERS, *ledger.NAMES)
_META = ", ".join(_VALUES)


@query(f"""with {_EV}, n as (select * replace (case when cost_state = 'known' and not coalesce(cost_usd >= 0 and isfinite(cost_usd), false) then 'invalid' else cost_state end as cost_state) from ev where kind = 'observe'),
 o as (select attempt_id, sequence, cost_state, case when cost_state = 'known' then cost_usd end as cost_usd, {_META}, min(event_id) as event_id from n group by all),
 q as (select *, sequence = coalesce(max(sequence) over (partition by attempt_id order by event_id rows between unbounded preceding and 1 preceding) + 1, 0) as merged from o),
 v as (select attempt_id, event_id, merged, {', '.join(f'case when merged then {c} end as {c}' for c in _VALUES)}, case when merged and cost_state <> 'missing' then cost_state end as state, case when merged then cost_usd end as cost from q),
 l as (select *, {', '.join(f'last_value({c} ignore nulls) over w as {c}_' for c in _VALUES)}, last_value(state ignore nulls) over w as state_, last_value(cost ignore nulls) over w as cost_ from v
   window w as (partition by attempt_id order by event_id rows between unbounded preceding and 1 preceding)),
 f as (select attempt_id, unnest([case when not merged then 'observation_sequence' end, {', '.join(f"case when {c} < {c}_ then '{c}' end" for c in ledger.COUNTERS)}, {', '.join(f"case when {c} <> {c}_ then '{c}' end" for c in ledger.NAMES)},
   case when state = 'known' and state_ = 'known' and cost < cost_ then 'cost_usd' end]) as fault from l
   union all select attempt_id, case when kind = 'settle' then 'transport' else 'interpretation' end from ev where kind in ('settle', 'interpret') group by attempt_id, kind having count(distinct status) > 1),
 c as (select attempt_id, string_agg(distinct fault, ',' order by fault) as conflicts from f where fault is not null group by 1),
 m as (select attempt_id, count(*) as observations, arg_max(state, event_id) as cost_state, arg_max({{'c': cost, 's': state}}, event_id) filter (state is not null) as paid, coalesce(bool_or(state = 'invalid'), false) as cost_invalid, {', '.join(f'arg_max({c}, event_id) as {c}' for c in _VALUES)} from l group by 1),
 e as (select attempt_id, count(*) as events, arg_min(status, event_id) filter (kind = 'settle') as transport, arg_min(status, event_id) filter (kind = 'interpret') as interpretation from ev group by 1)
 select attempt_id, coalesce(observations, 0) as observations, transport, interpretation, coalesce(cost_state, 'missing') as cost_state, paid.c as cost_usd, coalesce(cost_invalid, false) as cost_invalid, coalesce(conflicts, '') as conflicts, events, {_META}
 from e left join m using (attempt_id) left join c using (attempt_id)""")
def attempt_ledger(spark: SparkSession, d: str) -> DataFrame:
    return ledger.attempt_ledger(receipt_events(spark, d))
