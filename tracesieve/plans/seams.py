"""Queries over recorded answers of outside services, catalogues, artifacts and schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.functions import json as J
from tracesieve.functions import messages as M
from tracesieve.functions import text as T
from tracesieve.operators import seams
from tracesieve.plans.records import _case
from tracesieve.plans.registry import query
from tracesieve.plans.sql import framed
from tracesieve.sources.tables import table


def _h(k: Column) -> Column:
    return F.concat(F.lit("h"), k.cast("string"))


# Requests are orders, recorded calls the earlier orders; the last one counts where a key was called twice.
_CALLS = """log as (select 'h' || (o_custkey % 700) as content_hash, o_orderstatus as kind, o_orderkey as "at", o_totalprice as value from orders where o_orderdate < date '1997-07-01'),
 kept as (select content_hash, kind, arg_max(value, "at") as value, max("at") as "at" from log group by 1, 2)"""


def _log(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    calls = table(spark, d, "orders").select(F.col("o_orderkey").alias("at"), _h(F.col("o_custkey") % 700).alias("content_hash"), F.col("o_orderstatus").alias("kind"), F.col("o_totalprice").alias("value"), "o_orderdate")
    return calls.select("at", "content_hash", "kind"), calls.filter("o_orderdate < date '1997-07-01'").drop("o_orderdate")


@query(f'with {_CALLS} select content_hash, kind, "at", value from kept')
def cache_state(spark: SparkSession, d: str) -> DataFrame:
    return seams.latest(_log(spark, d)[1], ["content_hash", "kind"], "at").select("content_hash", "kind", "at", "value")


@query(f"""with {_CALLS}, req as (select o_orderkey as "at", 'h' || (o_custkey % 700) as content_hash, o_orderstatus as kind from orders)
 select req."at", content_hash, kind, coalesce(value, length(content_hash)) as value, case when value is null then 'fresh' else 'recorded' end as origin from req left join kept using (content_hash, kind)""")
def replayed_calls(spark: SparkSession, d: str) -> DataFrame:
    requests, log = _log(spark, d)
    ask = lambda missing: missing.withColumn("value", F.length("content_hash").cast("double"))
    recorded = seams.latest(log, ["content_hash", "kind"], "at").drop("at")
    return seams.answered(requests, recorded, ["content_hash", "kind"], "value", ask)


@query("""select doc_id, case when embedding is null then null else length(lang) end as lang_chars, embedding is null as novel, case when embedding is null then 'unavailable' else 'recorded' end as origin from documents left join embeddings on doc_id = vec_id""")
def embedded_items(spark: SparkSession, d: str) -> DataFrame:
    """Without an embedder an item that has no recorded vector is novel."""
    recorded = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    found = seams.answered(table(spark, d, "documents").select("doc_id", "lang"), recorded, ["doc_id"], "embedding")
    none = F.col("embedding").isNull()
    return found.select("doc_id", F.when(~none, F.length("lang").cast("long")).alias("lang_chars"), none.alias("novel"), "origin")


@query("""select l_orderkey as record_id, l_linenumber as idx, coalesce(case when p_size > 40 then 'failed' when p_size is not null then 'passed' end, 'unknown') as evidence from lineitem left join (select * from part where p_size % 3 <> 0) on l_partkey = p_partkey""")
def sandbox_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Candidates without a recorded run are unknown, never passed."""
    ran = table(spark, d, "part").filter("p_size % 3 != 0").select(F.col("p_partkey").alias("code"), F.when(F.col("p_size") > 40, "failed").otherwise("passed").alias("evidence"))
    asked = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("idx"), F.col("l_partkey").alias("code"))
    return seams.answered(asked, ran, ["code"], "evidence").select("record_id", "idx", F.coalesce("evidence", F.lit("unknown")).alias("evidence"))


@query("select c_custkey, c_mktsegment as area, coalesce(case c_mktsegment when 'BUILDING' then 'teacher-a' when 'MACHINERY' then 'teacher-b' end, 'teacher-x') as teacher from customer")
def teacher_selection(spark: SparkSession, d: str) -> DataFrame:
    teachers = spark.createDataFrame([("BUILDING", "teacher-a"), ("MACHINERY", "teacher-b")], "area string, teacher string")
    areas = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("area"))
    return seams.chosen(areas, teachers, "teacher-x").select("c_custkey", "area", "teacher")


@query("""with u as (select user_id as run_id, event_id as "at", event_type as status from events where event_type <> 'view'), l as (select run_id, arg_max(status, "at") as status from u group by 1)
 select c_custkey as run_id, coalesce(l.status, 'halted') as status from customer left join l on c_custkey = run_id""")
def run_status(spark: SparkSession, d: str) -> DataFrame:
    updates = table(spark, d, "events").filter("event_type != 'view'").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("at"), F.col("event_type").alias("status"))
    return seams.run_states(table(spark, d, "customer").select(F.col("c_custkey").alias("run_id")), updates)


_MEMBERS = """m as (select case when s_suppkey % 20 = 3 then s_suppkey - 1 else s_suppkey end as member_id, s_nationkey as family, s_suppkey // 2 as component, case when s_nationkey % 6 = 0 and s_suppkey % 2 = 0 then 'test' else 'train' end as split from supplier)"""


@query(f"""with {_MEMBERS} select 'member_count' as problem, count(*)::varchar as subject from m having count(*) <> 112 union all select 'duplicate_member', member_id::varchar from m group by member_id having count(*) > 1
 union all select 'family_crosses_splits', family::varchar from m group by family having count(distinct split) > 1 union all select 'component_crosses_splits', component::varchar from m group by component having count(distinct split) > 1""")
def reference_catalogue(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    split = F.when((n % 6 == 0) & (k % 2 == 0), "test").otherwise("train")
    members = table(spark, d, "supplier").select((k - F.when(k % 20 == 3, 1).otherwise(0)).alias("member_id"), n.alias("family"), F.floor(k / 2).alias("component"), split.alias("split"))
    return seams.catalogue_problems(members, 112)


@query("""with r as (select p_partkey as member_id, p_size as digest from part where p_partkey % 9 <> 0), o as (select p_partkey as member_id, p_size + case when p_partkey % 11 = 0 then 1 else 0 end as seen from part where p_partkey % 7 <> 0)
 select member_id, case when digest is null then 'unregistered' when seen is null then 'missing' when digest <> seen then 'digest_mismatch' else 'match' end as status from r full join o using (member_id)""")
def reference_import(spark: SparkSession, d: str) -> DataFrame:
    k, part = F.col("p_partkey"), table(spark, d, "part")
    registered = part.filter(k % 9 != 0).select(k.alias("member_id"), F.col("p_size").alias("digest"))
    observed = part.filter(k % 7 != 0).select(k.alias("member_id"), (F.col("p_size") + F.when(k % 11 == 0, 1).otherwise(0)).alias("digest"))
    return seams.imported(registered, observed)


_BODY = """case when l_linenumber % 5 = 4 then '{"b": 1}' else '{"a":' || l_partkey || '}' end"""
_RECORD = "l_linenumber * 10 + case when l_linenumber = 3 and l_orderkey % 4 = 0 then -15 else 0 end"


@query(f"""with r as (select l_orderkey as artifact_id, l_linenumber as place, {_RECORD} as record_id, {_BODY} as body from (select l_orderkey, l_linenumber, min(l_partkey) as l_partkey from lineitem group by 1, 2)), b as (select *, lag(record_id) over (partition by artifact_id order by place) as former from r)
 select artifact_id, place, record_id, case when body like '%: %' then 'body' when artifact_id % 6 = 1 and place = 2 then 'identity' when former >= record_id then 'order' end as problem from b""")
def artifact_rows(spark: SparkSession, d: str) -> DataFrame:
    place, order = F.col("l_linenumber"), F.col("l_orderkey")
    record = place * 10 + F.when((place == 3) & (order % 4 == 0), -15).otherwise(0)
    body = F.when(place % 5 == 4, '{"b": 1}').otherwise(F.concat(F.lit('{"a":'), F.col("l_partkey").cast("string"), F.lit("}")))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    rows = lines.select(order.alias("artifact_id"), place.alias("place"), record.alias("record_id"), body.alias("body"))
    made = F.when((F.col("artifact_id") % 6 == 1) & (F.col("place") == 2), "0").otherwise(T.framed_digest(F.lit("row-v5"), F.col("record_id").cast("string"), F.col("body")))
    return seams.artifact_rows(rows.withColumn("row_id", made)).select("artifact_id", "place", "record_id", "problem")


_TASK = """'"' || c_name || '"', '"p"', '"r"', '"u"', '"b"', '"e"', '{"x":1}'"""
_CAPTURE = """'{"candidate":{"attempt":' || c_custkey || ',"delta":{"changes":[{"path":"z.py","text":"1"},{"path":"a.py","text":"2"}]},"messages":[],"tools":[]},"task":{"actor_baseline":"b","environment":"e","label":"l' || c_custkey || '","private_contract":{"x":1},' || case when c_custkey % 4 <> 0 then '"problem":"p",' else '' end || '"repository":"r","source":"' || c_name || '","upstream_base":"u"}}'"""


@query(f"""with t as (select c_custkey, case when c_custkey % 4 <> 0 then {framed("'repository-task-v1'", *_TASK.split(', '))} end as task, c_custkey::varchar as attempt, {framed("'repository-capture-v1'", f'({_CAPTURE})')} as capture from customer)
 select c_custkey, task, case when task is not null then {framed("'repository-candidate-v1'", 'task', 'attempt', "'[]'", "'[]'", repr('{"path":"a.py","text":"2"},{"path":"z.py","text":"1"}'))} end as candidate, capture from t""")
def episode_identities(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    problem = F.when(k % 4 != 0, '"problem": "p", ').otherwise("")
    text = F.concat(
        F.lit('{"task": {"label": "l'), k.cast("string"), F.lit('", "source": "'), F.col("c_name"), F.lit('", '), problem,
        F.lit('"repository": "r", "upstream_base": "u", "actor_baseline": "b", "environment": "e", "private_contract": {"x": 1}}, "candidate": {"attempt": '),
        k.cast("string"), F.lit(', "messages": [], "tools": [], "delta": {"changes": [{"path": "z.py", "text": "1"}, {"text": "2", "path": "a.py"}]}}}'),
    )
    return table(spark, d, "customer").select(k, seams.episode_identities(text).alias("x")).select("c_custkey", "x.*")


# Plans of a chain group records by customer; each version holds more orders, and one was altered later.
_CHAIN = """v as (select unnest(range(1, 21)) as version), c as (select version, o_orderkey as record_id, o_custkey, o_orderkey % 500 as day from v, orders where o_orderkey % 500 < version * 25), g as (select *, min(record_id) over (partition by version, o_custkey) as group_id from c)"""


@query(f"""with {_CHAIN}, e as (select version, record_id, case when version = 18 and day = 3 then -1 else group_id end as group_id, group_id as was from g)
 select version, case when 20 - version >= 16 then 'too_deep' when version = 19 then 'missing_member' when bool_or(group_id <> was) then 'altered' else 'ok' end as status from e group by version""")
def predecessor_revalidation(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), "o_custkey")
    first = F.greatest(F.lit(1), F.floor(F.col("record_id") % 500 / 25) + 1).cast("int")
    populations = records.select("*", F.explode(F.sequence(first, F.lit(20))).alias("version"))

    def group(members: DataFrame) -> DataFrame:
        least = members.groupBy("version", "o_custkey").agg(F.min("record_id").alias("group_id"))
        return members.join(least.hint("merge"), ["version", "o_custkey"])

    frozen = group(populations).select("version", "record_id", F.when((F.col("version") == 18) & (F.col("record_id") % 500 == 3), -1).otherwise(F.col("group_id")).alias("group_id"))
    gone = spark.createDataFrame([(19, -7, -7)], "version int, record_id long, group_id long")
    return seams.revalidated(frozen.unionByName(gone), records, group)


_SCHEMAS = (
    '{"type":"object"}', '{"type":"object","properties":{"a":{"type":"array","items":{"type":"string"}}},"required":["a"]}',
    '{"type":"object","properties":{"a":{"type":"array","items":{"$ref":"x"}}}}', '{"type":"object","required":["a","a"],"properties":{"a":{"type":"null"}}}',
    '{"type":["string"]}', '{"type":"string","enum":[]}', '{"type":"string","properties":{}}', '{"type":"object","properties":{"a":{"type":"string","items":{"type":"null"}},"b":"x"}}',
    '{"type":"object","additionalProperties":{}}', "[]",
)
_SCHEMA_PROBLEMS = "[(2, '$.a[]', 'keyword'), (3, '$', 'required'), (4, '$', 'type'), (5, '$', 'annotation'), (6, '$', 'properties'), (7, '$.a', 'items'), (7, '$.b', 'not_an_object'), (8, '$', 'annotation'), (9, '$', 'not_an_object')]"


@query(f"with p as (select unnest({_SCHEMA_PROBLEMS}) as x) select p_partkey, x[2] as path, x[3] as problem from part join p on p_partkey % {len(_SCHEMAS)} = x[1]")
def tool_schemas(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", _case("p_partkey", *_SCHEMAS).alias("schema"))
    return J.schema_problems(rows, "p_partkey", "schema")


_TOOL_TURNS = """t as (select conv_id, turn, text, case when conv_id % 7 = 0 and turn = 2 then 'tool' else role end as role, case when role = 'assistant' and turn % 4 = 1 and conv_id % 3 = 0 then '[]' end as calls, case when conv_id % 5 = 0 and turn % 4 = 2 then 'c1' end as link from conversations),
 s as (select conv_id, turn * 10 + 1 as o, 'tool_calls' as signal from t where calls is not null union all select conv_id, turn * 10 + 2, 'tool_call_id' from t where link is not null union all select conv_id, turn * 10 + 3, 'tool_role' from t where role = 'tool'),
 f as (select conv_id, signal, min(o) as o from s group by 1, 2), g as (select conv_id, min(o) // 10 as first, string_agg(signal, ',' order by o) as signals from f group by 1)"""


@query(f"""with {_TOOL_TURNS}, c as (select conv_id, conv_id % 8 = 4 as leaks from conversations group by 1)
 select c.conv_id, first, signals, case when leaks then 'control_token' when signals is not null then 'unsupported_tools' end as chatml, case when leaks then 'control_token' end as openai from c left join g using (conv_id)""")
def render_issues(spark: SparkSession, d: str) -> DataFrame:
    c, t = F.col("conv_id"), F.col("turn")
    role = F.when((c % 7 == 0) & (t == 2), "tool").otherwise(F.col("role"))
    calls = F.when((F.col("role") == "assistant") & (t % 4 == 1) & (c % 3 == 0), "[]")
    content = F.when((c % 8 == 4) & (t == 0), F.concat("text", F.lit("<|im_start|>"))).otherwise(F.col("text"))
    turn = F.struct("turn", role.alias("role"), content.alias("content"), F.lit(None).cast("string").alias("reasoning"), calls.alias("tool_calls"), F.when((c % 5 == 0) & (t % 4 == 2), "c1").alias("tool_call_id"))
    conversations = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("m"))
    m, issue = F.col("m"), lambda target: M.render_issue(F.col("m"), F.lit(target))
    return conversations.select("conv_id", M.tool_signals(m).alias("x"), issue("chatml").alias("chatml"), issue("openai_messages").alias("openai")).select("conv_id", F.col("x.first").cast("long").alias("first"), F.array_join("x.signals", ",").alias("signals"), "chatml", "openai")
