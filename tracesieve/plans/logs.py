"""Queries over the event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.functions import text as T
from tracesieve.operators import ledger, responses, sequences
from tracesieve.plans.registry import query
from tracesieve.sources.tables import table

# Event types as states of the record user_id.
_STATE = "case event_type when 'signup' then 'generated' when 'view' then 'verifying' when 'click' then 'judged' when 'error' then 'errored' else 'admitted' end"


def _state() -> Column:
    t = F.col("event_type")
    return F.when(t == "signup", "generated").when(t == "view", "verifying").when(t == "click", "judged").when(t == "error", "errored").otherwise("admitted")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


@query(f"select user_id as record_id, event_id, {_STATE} as state, row_number() over (partition by user_id order by event_id) as ordinal from events")
def lifecycle_history(spark: SparkSession, d: str) -> DataFrame:
    rows = _events(spark, d).select(F.col("user_id").alias("record_id"), "event_id", _state().alias("state"))
    return sequences.in_order(rows, ["record_id"], ["event_id"]).select("record_id", "event_id", "state", (F.col("place") + 1).alias("ordinal"))


@query(f"select record_id, state, event_id, state in ('admitted', 'errored') as terminal from (select user_id as record_id, {_STATE} as state, event_id, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k = 1")
def lifecycle_state(spark: SparkSession, d: str) -> DataFrame:
    rows = _events(spark, d).select(F.col("user_id").alias("record_id"), "ts", "event_id", _state().alias("state"))
    return ledger.latest(rows, "record_id", ["ts", "event_id"], ["state", "event_id"]).withColumn("terminal", F.col("state").isin("admitted", "errored"))


@query("select record_id, revision, value from (select user_id as record_id, event_id // 7 as revision, value, row_number() over (partition by user_id order by event_id // 7 desc, event_id desc) as k from events) where k = 1")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    rows = _events(spark, d).select(F.col("user_id").alias("record_id"), F.floor(F.col("event_id") / 7).cast("long").alias("revision"), "value", "event_id")
    return ledger.latest(rows, "record_id", ["revision", "event_id"], ["revision", "value"])


@query("""with s as (select user_id, event_id, row_number() over (partition by user_id order by event_id) + case when event_id % 97 = 0 then 1 else 0 end as seq from events),
 l as (select *, coalesce(lag(seq) over (partition by user_id order by seq, event_id), 0) + 1 as expected from s) select user_id, event_id, seq, expected from l where seq <> expected""")
def sequence_conflicts(spark: SparkSession, d: str) -> DataFrame:
    placed = sequences.in_order(_events(spark, d).select("user_id", "event_id"), ["user_id"], ["event_id"])
    seq = F.col("place") + 1 + F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)
    return sequences.conflicts(placed.select("user_id", "event_id", seq.alias("seq")), "user_id", "seq", "event_id")


@query("""with e as (select user_id, event_id, event_type in ('error', 'view') as failed from events), f as (select user_id, min(event_id) filter (not failed) as first_success from e group by 1)
 select user_id, count(e.event_id) filter (first_success is null or e.event_id < first_success) >= 3 as tripped from f join e using (user_id) group by 1""")
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    rows = _events(spark, d).select("user_id", F.col("event_id").alias("at"), F.col("event_type").isin("error", "view").alias("failed"))
    return ledger.breaker(rows, "user_id", 3)


# Receipts of attempts; read by Spark and by DuckDB alike.
_ATTEMPT = {
    "run_id": "'run' || (user_id % 40)",
    "cost_state": "case when event_id % 50 = 0 then 'missing' when event_id % 173 = 0 then 'invalid' else 'known' end",
    "cost_usd": "case when event_id % 50 <> 0 and event_id % 173 <> 0 then value / 100 end",
    "conflicts": "case when event_id % 211 = 0 then 'cost_usd' when event_id % 97 = 0 then 'model,prompt_tokens' when event_id % 89 = 0 then 'completion_tokens' else '' end",
    "invalid_fields": "case when event_id % 157 = 0 then 'cost' when event_id % 151 = 0 then 'total_tokens,prompt_tokens' end",
    "prompt_tokens": "case when event_id % 9 > 0 then event_id % 1000 end",
    "completion_tokens": "case when event_id % 7 > 0 then event_id % 300 end",
    "total_tokens": "event_id % 1300",
    "reasoning_tokens": "case when event_type = 'click' then event_id % 70 end",
    "transport": "case when event_type <> 'view' or event_id % 3 > 0 then 'complete' end",
    "elapsed_ms": "event_id % 60",
}
_ATTEMPTS = f"attempts as (select {', '.join(f'{v} as {n}' for n, v in _ATTEMPT.items())} from events)"


def _accounts(attempts: str) -> str:
    held = lambda c, x: f"list_contains(string_split(coalesce({c}, ''), ','), '{x}')"
    bad = {c: f"({held('invalid_fields', c)} or {held('conflicts', c)})" for c in ledger.COUNTERS}
    invalid = f"({held('invalid_fields', 'cost')} or cost_state = 'invalid')"
    counted = ", ".join(f"coalesce(sum({c}) filter (not {b}), 0)::bigint as {c}_known, count(*) filter (not {b} and {c} is null) as {c}_missing, count(*) filter ({b}) as {c}_invalid" for c, b in bad.items())
    return f"""accounts as (select run_id, count(*) as attempts, coalesce(sum(cost_usd) filter (not {invalid} and cost_state = 'known' and not {held('conflicts', 'cost_usd')}), 0) as known_usd,
  count(*) filter (not {invalid} and cost_state = 'missing') as unknown_cost, count(*) filter ({invalid}) as invalid_cost, count(*) filter (coalesce(conflicts, '') <> '') as conflicting, count(*) filter (transport is null) as unresolved,
  {counted}, coalesce(sum(elapsed_ms) filter (transport is not null), 0)::bigint as elapsed_ms from {attempts} group by run_id)"""


_ACCOUNTS = _accounts("attempts")


def _attempts(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select(*(F.expr(v).alias(n) for n, v in _ATTEMPT.items()))


@query(f"with {_ATTEMPTS}, {_ACCOUNTS} select * replace (round(known_usd, 6) as known_usd) from accounts")
def accounting_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return ledger.accounting(_attempts(spark, d)).withColumn("known_usd", F.round("known_usd", 6))


# Four runs of each kind of evidence show every answer: runs by their number.
@query(f"""with {_ATTEMPTS}, {_ACCOUNTS}, a as (select *, substr(run_id, 4)::int as k from accounts), b as (select run_id, k, known_usd, unknown_cost * (k % 2) as unknown_cost, (invalid_cost + conflicting) * (k % 3) as bad, unresolved * (case when k % 4 = 0 then 1 else 0 end) as unresolved from a)
 select run_id, case when unresolved > 0 and k % 8 = 0 then 'wait' when unresolved > 0 then 'denied_unresolved' when bad > 0 then 'denied_invalid' when unknown_cost > 0 then 'denied_unknown' when known_usd >= 80 then 'denied_limit' else 'admitted' end as admission from b""")
def spend_gate(spark: SparkSession, d: str) -> DataFrame:
    k = F.substring("run_id", 4, 9).cast("int")
    a = ledger.accounting(_attempts(spark, d))
    a = a.withColumns({"unknown_cost": F.col("unknown_cost") * (k % 2), "invalid_cost": F.col("invalid_cost") * (k % 3), "conflicting": F.col("conflicting") * (k % 3), "unresolved": F.col("unresolved") * (k % 4 == 0).cast("int")})
    return ledger.spend_gate(a, 80.0, k % 8 == 0).select("run_id", "admission")


_RECEIPT = """ev as (select event_id // 5 as attempt_id, event_id, ts as tick, case event_id % 5 when 0 then 'intent' when 4 then 'settle' when 3 then case when event_id % 7 = 0 then 'settle' else 'observe' end else 'observe' end as kind,
  case when event_type = 'error' then 'failed' else 'complete' end as status, (value * 10)::bigint as tokens from events)"""


@query(f"""with {_RECEIPT}, b as (select *, max(tokens) filter (kind = 'observe') over (partition by attempt_id order by tick, event_id rows between unbounded preceding and 1 preceding) as before_ from ev)
 select attempt_id, count(*) filter (kind = 'observe') as observations, min(status) filter (kind = 'settle') as transport, coalesce(bool_or(kind = 'observe' and tokens < before_), false) or count(distinct status) filter (kind = 'settle') > 1 as conflict,
 arg_max(tokens, (tick, event_id)) filter (kind = 'observe') as tokens from b group by attempt_id""")
def attempt_receipts(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    k = e % 5
    ev = _events(spark, d).select(
        F.floor(e / 5).cast("long").alias("attempt_id"), "event_id", F.col("ts").alias("at"),
        F.when(k == 0, "intent").when(k == 4, "settle").when((k == 3) & (e % 7 == 0), "settle").otherwise("observe").alias("kind"),
        F.when(F.col("event_type") == "error", "failed").otherwise("complete").alias("status"), F.bround(F.col("value") * 10).cast("long").alias("tokens"),
    )
    r = ledger.receipts(ev)
    return r.withColumn("conflict", F.coalesce("conflict", F.lit(False)))


@query("""with log as (select 'h' || (event_id % 500) as content_hash, event_type as kind, event_id as tick, value from events where event_id % 4 <> 0), last as (select content_hash, kind, arg_max(value, tick) as value from log group by 1, 2),
 req as (select distinct 'h' || (event_id % 500) as content_hash, event_type as kind from events where event_id % 4 = 0) select content_hash, kind, value from req left join last using (content_hash, kind)""")
def cache_lookup(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select(F.concat(F.lit("h"), (F.col("event_id") % 500).cast("string")).alias("content_hash"), F.col("event_type").alias("kind"), F.col("event_id").alias("at"), "value")
    return ledger.cache_lookup(e.filter("at % 4 = 0").select("content_hash", "kind").distinct(), e.filter("at % 4 != 0"), ["content_hash", "kind"])


@query("""select distinct 'h' || (event_id % 3000) as content_hash, event_type as kind from events where event_id % 4 = 0 and ('h' || (event_id % 3000), event_type) not in (select 'h' || (event_id % 3000), event_type from events where event_id % 4 <> 0)""")
def cache_misses(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select(F.concat(F.lit("h"), (F.col("event_id") % 3000).cast("string")).alias("content_hash"), F.col("event_type").alias("kind"), F.col("event_id").alias("at"))
    return e.filter("at % 4 = 0").select("content_hash", "kind").distinct().join(e.filter("at % 4 != 0"), ["content_hash", "kind"], "left_anti")


@query("""with m as (select event_id // 4 as command, min(event_id % 4) as lo, max(event_id % 4) as hi, count(*) as declared from events group by 1), h as (select event_id // 4 as command, event_id % 4 as ordinal from events where event_id % 101 <> 0)
 select command, declared, count(ordinal) as found, count(ordinal) = declared and min(ordinal) = min(lo) and max(ordinal) = max(hi) as intact from m left join h using (command) group by 1, 2""")
def history_integrity(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    rows = _events(spark, d).select(F.floor(e / 4).cast("long").alias("command"), (e % 4).alias("ordinal"), (e % 101 != 0).alias("kept"))
    m = rows.groupBy("command").agg(F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi"), F.count("*").alias("declared"))
    h = rows.filter("kept").groupBy("command").agg(F.count("*").alias("n"), F.min("ordinal").alias("a"), F.max("ordinal").alias("b"))
    x = m.join(h, "command", "left")
    intact = F.when(F.col("n").isNotNull(), (F.col("n") == F.col("declared")) & (F.col("a") == F.col("lo")) & (F.col("b") == F.col("hi")))
    return x.select("command", "declared", F.coalesce("n", F.lit(0)).alias("found"), intact.alias("intact"))


@query("select user_id % 16 as shard, max(event_id) filter (event_type <> 'error') + 1 as next_offset, count(*) filter (event_type <> 'error') as committed from events group by 1")
def resume_cursor(spark: SparkSession, d: str) -> DataFrame:
    done = F.when(F.col("event_type") != "error", F.col("event_id"))
    return _events(spark, d).groupBy((F.col("user_id") % 16).alias("shard")).agg((F.max(done) + 1).alias("next_offset"), F.count(done).alias("committed"))


@query("select strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M') as minute, count(*) as requests, greatest(count(*) - 2, 0) as over_quota from events group by 1")
def rate_per_minute(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).groupBy(F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd'T'HH:mm").alias("minute")).agg(F.count("*").alias("requests"), F.greatest(F.count("*") - 2, F.lit(0)).alias("over_quota"))


@query(f"""with e as (select user_id, {_STATE} as state, event_id, value from events), d as (select user_id, bool_or(state = 'admitted') as decided, arg_max(state, event_id) filter (state <> 'errored') as last_state, arg_max(state, event_id) as raw, max(event_id) as last_event from e group by 1)
 select user_id, case when raw = 'errored' and decided then 'admitted' else raw end as shown, last_event from d""")
def dashboard_fold(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).select("user_id", "event_id", _state().alias("state"))
    g = e.groupBy("user_id").agg(F.bool_or(F.col("state") == "admitted").alias("decided"), F.max_by("state", "event_id").alias("raw"), F.max("event_id").alias("last_event"))
    return g.select("user_id", F.when((F.col("raw") == "errored") & F.col("decided"), "admitted").otherwise(F.col("raw")).alias("shown"), "last_event")


@query("select event_id, case when event_id % 6 = 0 then null when event_id % 6 = 1 then null when event_id % 6 = 2 then event_id::double else floor(value) end as tokens from events")
def usage_coerce(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 6
    raw = F.when(k == 0, F.concat(F.lit("-"), F.col("value").cast("string"))).when(k == 1, "n/a").when(k == 2, F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit(" "))).otherwise(F.col("value").cast("string"))
    return _events(spark, d).select("event_id", T.to_count(raw).cast("double").alias("tokens"))


# A response is 10 events in a row; each is a delta of text, and a last one with a finish reason.
_DELTA = "dl as (select event_id // 10 as response_id, event_id % 10 as seq, event_type || ';' as piece, case when event_id % 10 = 9 and event_id % 70 <> 69 then case when event_id % 3 = 0 then 'length' else 'stop' end end as finish, case when event_id % 10 < 3 then '[' || user_id || ']' end as thought from events)"


def _deltas(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    finish = F.when((e % 10 == 9) & (e % 70 != 69), F.when(e % 3 == 0, "length").otherwise("stop"))
    return _events(spark, d).select(
        F.floor(e / 10).cast("long").alias("response_id"), (e % 10).alias("seq"), F.concat("event_type", F.lit(";")).alias("piece"), finish.alias("finish"), F.when(e % 10 < 3, F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit("]"))).alias("thought")
    )


@query(f"with {_DELTA} select response_id, string_agg(piece, '' order by seq) as content, string_agg(thought, '' order by seq) as reasoning, max(finish) as finish from dl group by 1")
def accumulate_deltas(spark: SparkSession, d: str) -> DataFrame:
    from tracesieve.streaming.folds import accumulated

    return accumulated(_deltas(spark, d))


@query(f"""with {_DELTA}, a as (select response_id, string_agg(piece, '' order by seq) as content, string_agg(thought, '' order by seq) as reasoning, max(finish) as finish from dl group by 1)
 select response_id, case when finish is null then 'reset' when finish = 'length' and reasoning is not null then 'truncated' when content = '' then 'error' else 'complete' end as status from a""")
def classify_completion(spark: SparkSession, d: str) -> DataFrame:
    from tracesieve.streaming.folds import accumulated

    a = accumulated(_deltas(spark, d))
    status = F.when(F.col("finish").isNull(), "reset").when((F.col("finish") == "length") & F.col("reasoning").isNotNull(), "truncated").when(F.col("content") == "", "error").otherwise("complete")
    return a.select("response_id", status.alias("status"))


@query("""with f as (select event_id // 12 as response_id, event_id % 3 as idx, event_id % 12 as seq, case when event_id % 12 < 3 then 'id' || (event_id % 3) when event_id % 131 = 0 then 'other' end as id, case when event_id % 12 < 6 then event_type end as name, '<' || (event_id % 12) || '>' as args from events)
 select response_id, idx, coalesce(string_agg(name, '' order by seq), '') as name, string_agg(args, '' order by seq) as arguments, count(distinct id) > 1 as conflict from f group by 1, 2""")
def assemble_tool_calls(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    s = e % 12
    call = F.struct(
        (e % 3).alias("index"), F.lit("function").alias("kind"), F.when(s < 3, F.concat(F.lit("id"), (e % 3).cast("string"))).when(e % 131 == 0, "other").alias("id"),
        F.when(s < 6, F.col("event_type")).alias("name"), F.concat(F.lit("<"), s.cast("string"), F.lit(">")).alias("arguments"),
    )
    calls = responses.tool_calls(_events(spark, d).select(F.floor(e / 12).cast("long").alias("response_id"), s.alias("seq"), F.array(call).alias("calls")))
    return calls.select("response_id", F.col("index").alias("idx"), "name", "arguments", F.col("sticky").isNotNull().alias("conflict"))


@query("""with c as (select event_id // 10 as response_id, event_id % 10 as seq, event_type from events) select response_id, string_agg(event_type, '' order by seq) as content, bool_or(seq = 9) as done, case when bool_or(seq = 9) then null else 'reset' end as error from c group by 1""")
def sse_parse(spark: SparkSession, d: str) -> DataFrame:
    from tracesieve.streaming.folds import parse_sse

    e = F.col("event_id")
    line = F.concat(F.lit('data: {"choices":[{"index":0,"delta":{"content":"'), F.col("event_type"), F.lit('"}}]}\n\n: keep-alive\n\n'))
    tail = F.when(e % 10 == 9, F.lit("data: [DONE]\n\n")).otherwise("")
    raw = _events(spark, d).select(F.floor(e / 10).cast("long").alias("response_id"), (e % 10).alias("seq"), F.concat(line, tail).alias("chunk"))
    return parse_sse(raw)


# Ours, not one of the folds above: counts in windows of event time, the batch form of streaming.folds.
@query("select strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as hour, event_type, count(*) as n, round(sum(value), 6) as total from events group by 1, 2")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    from tracesieve.streaming.folds import tumbling

    t = tumbling(_events(spark, d), "1 hour")
    return t.select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", F.round("total", 6).alias("total"))
