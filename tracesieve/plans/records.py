"""Queries over record stores, JSON documents, tasks and screening states, on the star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.functions import json as J
from tracesieve.functions import text as T
from tracesieve.operators import records as R
from tracesieve.operators import screening
from tracesieve.plans.judging import calibration_fit
from tracesieve.plans.registry import ORACLES, query
from tracesieve.plans.sql import CANDIDATES, VOTES, framed, shingles
from tracesieve.sources.tables import candidates, table, votes


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return candidates(table(spark, d, "orders"))


def _case(n: Column | str, *values) -> Column:
    """The value at n modulo their number."""
    n = F.col(n) if isinstance(n, str) else n
    out = F.lit(None)
    for k, v in enumerate(values):
        out = F.when(n % len(values) == k, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


# --- stores ----------------------------------------------------------------------------------


@query(f"""with {CANDIDATES}, w as (select record_id from cand union all select -record_id from cand)
 select record_id, cand.state, case when cand.run_id is null then 'not_found' else 'found' end as status from w left join cand using (record_id)""")
def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    c = _candidates(spark, d)
    wanted = c.select("record_id").union(c.select(-F.col("record_id")))
    return R.get(c.select("record_id", "state"), wanted, "record_id")


@query(f"with {CANDIDATES} select run_id, record_id, state from cand where run_id in ('run0', 'run2')")
def screening_population(spark: SparkSession, d: str) -> DataFrame:
    runs = spark.createDataFrame([("run0",), ("run2",), ("run7",)], "run_id string")
    return R.population(_candidates(spark, d), runs).select("run_id", "record_id", "state")


@query("""select conv_id, turn, case when (conv_id + turn) % 7 <> 0 then role end as role, case when (conv_id + turn) % 7 <> 0 then length(text) end as chars,
 case when (conv_id + turn) % 7 = 0 then 'malformed' end as error from conversations""")
def scan_with_errors(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "conversations").select("conv_id", "turn", F.to_json(F.struct("role", "text")).alias("line"))
    broken = lines.withColumn("line", F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, F.substring("line", 1, 12)).otherwise(F.col("line")))
    read = R.decoded(broken, "line", "role string, text string")
    return read.select("conv_id", "turn", "row.role", F.length("row.text").cast("long").alias("chars"), "error")


@query("select o_orderkey as record_key, 'run' || (o_custkey % 3) || '-s' || (o_orderkey % 4) || '-seed' || o_custkey || '-a' || (o_orderkey % 2) || '-c' || (o_orderkey % 5) as record_id from orders")
def deterministic_ids(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    made = R.record_id(F.concat(F.lit("run"), (c % 3).cast("string")), k % 4, c, k % 2, k % 5)
    return table(spark, d, "orders").select(k.alias("record_key"), made.alias("record_id"))


@query("""with recursive c as (select 'c' || (o_orderkey % 7) as command_id, o_custkey as record_id, o_orderkey % 4 as expected, o_orderkey as placed, row_number() over (partition by o_custkey order by o_orderkey) as i from orders),
 v as (select c_custkey as record_id, c_custkey % 3 as version from customer where c_mktsegment <> 'BUILDING'),
 r(record_id, i, version, done, command_id, placed, outcome) as (select distinct c.record_id, 0::bigint, version, []::varchar[], null::varchar, null::bigint, null::varchar from c left join v using (record_id)
  union all select r.record_id, c.i, version + (o = 'applied')::int, case when o = 'applied' then list_append(done, c.command_id) else done end, c.command_id, c.placed, o from r join c on c.record_id = r.record_id and c.i = r.i + 1,
  lateral (select case when list_contains(done, c.command_id) then 'already_applied' when version is null then 'not_found' when version = c.expected then 'applied' else 'conflict' end as o))
 select command_id, record_id, placed, outcome from r where i > 0""")
def guarded_transition(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    commands = table(spark, d, "orders").select(F.concat(F.lit("c"), (k % 7).cast("string")).alias("command_id"), F.col("o_custkey").alias("record_id"), (k % 4).alias("expected"), k.alias("placed"))
    current = table(spark, d, "customer").filter("c_mktsegment != 'BUILDING'").select(F.col("c_custkey").alias("record_id"), (F.col("c_custkey") % 3).alias("version"))
    return R.guarded(commands, current)


@query("select user_id as window_id, least(count(*), 5) as taken, greatest(count(*) - 5, 0) as dropped from events group by user_id")
def bounded_channel(spark: SparkSession, d: str) -> DataFrame:
    return R.bounded(table(spark, d, "events"), F.col("user_id"), ["event_id"], 5).withColumnRenamed("window", "window_id")


@query("select event_id, user_id from events order by event_id desc limit 200")
def bounded_log(spark: SparkSession, d: str) -> DataFrame:
    return R.latest(table(spark, d, "events").select("event_id", "user_id"), [F.desc("event_id")], 200)


@query(f"with {CANDIDATES} select run_id, count(*) as n_records, count(*) filter (state = 'admitted') as n_admitted, sha256(run_id || ':' || count(*)) as manifest_id from cand group by run_id")
def export_counts(spark: SparkSession, d: str) -> DataFrame:
    n = F.count("*")
    return _candidates(spark, d).groupBy("run_id").agg(n.alias("n_records"), F.count_if(F.col("state") == "admitted").alias("n_admitted")).withColumn("manifest_id", F.sha2(F.concat("run_id", F.lit(":"), F.col("n_records").cast("string")), 256))


# --- JSON ------------------------------------------------------------------------------------

_RAW = """'{"z": [{"b": ' || c_custkey || ', "a": null}, []], "a": "' || c_name || '", "m": {"y": true, "x": {}}}'"""
_SORTED = """'{"a":"' || c_name || '","m":{"x":{},"y":true},"z":[{"a":null,"b":' || c_custkey || '},[]]}'"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", F.format_string('{"z": [{"b": %d, "a": null}, []], "a": "%s", "m": {"y": true, "x": {}}}', "c_custkey", "c_name").alias("raw"))


@query(f"select c_custkey, {_SORTED} as canonical, sha256({_SORTED}) as canonical_hash from customer")
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("c_custkey", J.canonical(F.col("raw")).alias("canonical")).withColumn("canonical_hash", F.sha2("canonical", 256))


@query("""select c_custkey, unnest(['~$.a', '~$.m', '~$.z', '$.a', '~$.m.x', '~$.m.y', '~$.z[0].a', '~$.z[0].b']) as path, unnest(['a', 'm', 'z', c_name, 'x', 'y', 'a', 'b']) as text from customer""")
def json_leaves(spark: SparkSession, d: str) -> DataFrame:
    return J.leaves(_raw(spark, d), "c_custkey", "raw")


@query(f"select o_orderkey as record_id, {framed(repr('row-v5'), 'o_orderstatus', 'o_orderpriority', 'o_custkey::varchar')} as row_id from orders")
def projected_identity(spark: SparkSession, d: str) -> DataFrame:
    parts = (F.lit("row-v5"), F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_custkey").cast("string"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), T.framed_digest(*parts).alias("row_id"))


@query(f"""with j as (select conv_id, turn, role, text, case conv_id % 3 when 0 then 'rubric-a' when 1 then '' end as rubric from conversations)
 select conv_id, turn, 'judge-request-v2:' || {framed("'judge-' || (conv_id % 5)", 'role', 'text', 'rubric', "'json_score'", "'2'", "'0.7'")} as fingerprint from j""")
def request_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    judge = F.concat(F.lit("judge-"), (F.col("conv_id") % 5).cast("string"))
    rubric = F.when(F.col("conv_id") % 3 == 0, "rubric-a").when(F.col("conv_id") % 3 == 1, "")
    made = T.framed_digest(judge, F.col("role"), F.col("text"), rubric, F.lit("json_score"), F.lit("2"), F.lit(0.7).cast("string"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("judge-request-v2:"), made).alias("fingerprint"))


@query("select conv_id, turn, case turn % 3 when 0 then text when 1 then text || '!' end as flat from conversations")
def message_text(spark: SparkSession, d: str) -> DataFrame:
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    plain = F.regexp_extract(F.to_json(F.struct(F.array("text").alias("x"))), r'(?s)^\{"x":\[(.*)\]\}$', 1)
    parts = F.to_json(F.array(part("text", F.col("text")), part("image_url", F.lit("ignored")), part("text", F.lit("!"))))
    content = F.when(F.col("turn") % 3 == 0, plain).when(F.col("turn") % 3 == 1, parts).otherwise("null")
    return table(spark, d, "conversations").withColumn("content", content).select("conv_id", "turn", J.content_text(F.col("content")).alias("flat"))


_TOOLS = (
    '{"type":"function","function":{"name":"f","description":"d","parameters":{"type":"object"}}}', '{"type":"function","function":{"name":"f","parameters":{"type":"object"},"strict":true}}',
    '{"type":"function","function":{"name":" ","parameters":{"type":"object"}}}', '{"type":"function","function":{"name":"f","parameters":{"type":"array"}}}',
    '{"type":"function","function":{"name":"f","extra":1,"parameters":{"type":"object"}}}', '{"type":"function","function":{"name":"f","description":3,"parameters":{"type":"object"}}}',
    '{"type":"function"}', '{"type":"tool","function":{"name":"f"}}', '[1]', '{"type":"function","function":{"name":"f"},"id":1}', '{"type":"function","function":{"name":"f"}}',
)
_TOOL_PROBLEMS = "[null, null, 'name', 'parameters', 'field', 'field', 'wrapper', 'wrapper', 'not_an_object', 'wrapper', 'parameters']"


@query(f"select p_partkey, ({_TOOL_PROBLEMS})[(p_partkey % {len(_TOOLS)}) + 1] as problem from part")
def tool_definitions(spark: SparkSession, d: str) -> DataFrame:
    tools = table(spark, d, "part").select("p_partkey", _case("p_partkey", *_TOOLS).alias("tool"))
    return tools.select("p_partkey", J.tool_problem(F.col("tool")).alias("problem"))


_CHUNKS = (
    '{"choices":[{"index":0,"delta":{"content":"x"}}]}', '{"error":{"code":500}}', '{"choices":[{"index":1,"delta":{}}]}', '{"choices":[{"delta":{}},{"delta":{}}]}',
    '{"choices":[{"delta":{"function_call":{"name":"f"}}}]}', '{"choices":[{"delta":{"reasoning":"a","reasoning_content":"b"}}]}',
    '{"choices":[{"delta":{"reasoning":"a","reasoning_content":"a"}}]}', '{"choices":[', '{"choices":[]}',
)
_CHUNK_STATES = "['ok', 'provider_error', 'choice', 'choice', 'legacy_call', 'conflicting_reasoning', 'ok', 'malformed', 'ok']"


@query(f"select event_id, ({_CHUNK_STATES})[(event_id % {len(_CHUNKS)}) + 1] as status from events")
def chunk_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", J.chunk_status(_case("event_id", *_CHUNKS)).alias("status"))


@query("""with m as (select conv_id, case conv_id % 4 when 0 then text || '<tool_call>' when 1 then text || '<tool_cal' else text end as t, case when conv_id % 6 = 5 then '</tool_call>' else 'k' end as k from conversations)
 select conv_id, bool_or(contains(t, '<tool_call>') or contains(t, '</tool_call>') or contains(k, '</tool_call>')) as ambiguous from m group by conv_id""")
def projection_delimiters(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("conv_id")
    text = F.when(c % 4 == 0, F.concat("text", F.lit("<tool_call>"))).when(c % 4 == 1, F.concat("text", F.lit("<tool_cal"))).otherwise(F.col("text"))
    argument = F.create_map(F.when(c % 6 == 5, "</tool_call>").otherwise("k"), F.lit("v"))
    whole = F.to_json(F.struct(text.alias("text"), argument.alias("arguments")))
    hit = F.contains(whole, F.lit("<tool_call>")) | F.contains(whole, F.lit("</tool_call>"))
    return table(spark, d, "conversations").select("conv_id", hit.alias("hit")).groupBy("conv_id").agg(F.bool_or("hit").alias("ambiguous"))


@query("""select p_partkey, n as name, regexp_full_match(n, '[A-Za-z_][A-Za-z0-9_]{0,63}') and n not in ('class', 'None') as valid
 from (select p_partkey, case p_partkey % 5 when 0 then 'f_' || p_partkey when 1 then p_partkey || 'f' when 2 then 'class' when 3 then repeat('a', (60 + p_partkey % 9)::int) else replace(p_type, ' ', '_') end as n from part)""")
def python_identifier(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    name = _case(k, F.concat(F.lit("f_"), k.cast("string")), F.concat(k.cast("string"), F.lit("f")), "class", F.repeat(F.lit("a"), (k % 9 + 60).cast("int")), F.replace("p_type", F.lit(" "), F.lit("_")))
    return table(spark, d, "part").select("p_partkey", name.alias("name")).withColumn("valid", J.identifier(F.col("name")))


@query("""with b as (select p_partkey, upper(to_hex(length(p_name))) as a, upper(to_hex(length(p_type))) as c, p_name, p_type from part), f as (select *, lpad(a, 16, '0') || lpad(c, 16, '0') || p_name || p_type as body from b)
 select p_partkey, hex(encode('FRAME001')) || upper(sha256(body)) || hex(encode(body)) as frame, p_name as payload, p_type as source, null::varchar as torn from f""")
def prepared_frames(spark: SparkSession, d: str) -> DataFrame:
    framed_ = table(spark, d, "part").select("p_partkey", R.frame(F.col("p_name"), F.col("p_type")).alias("f"))
    read, torn = R.unframed(F.col("f")), R.unframed(F.substring("f", F.lit(1), F.octet_length("f") - 1))
    return framed_.select("p_partkey", F.hex("f").alias("frame"), read["payload"].cast("string").alias("payload"), read["source"].cast("string").alias("source"), torn["payload"].cast("string").alias("torn"))


# --- tasks and splits ------------------------------------------------------------------------

_TASKS = """task as (select case when p_partkey % 50 = 7 then ' ' else 't' || (p_partkey - case when p_partkey % 40 = 3 then 1 else 0 end) end as task_id, p_brand as namespace, 'i' || (p_partkey - case when p_partkey % 60 = 5 then 1 else 0 end) as item,
 p_name || ' ' || (p_partkey // 2) as prompt, case when p_partkey % 30 = 11 then 'seven' else (p_size / 4.0)::varchar end as answer, 'g' || (p_partkey // 3) as "group", case when p_partkey % 21 = 0 then 'validation' when (p_partkey // 3) % 5 = 1 then 'test' else 'train' end as split, p_partkey from part)"""


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    label = F.when(k % 50 == 7, " ").otherwise(F.concat(F.lit("t"), (k - F.when(k % 40 == 3, 1).otherwise(0)).cast("string")))
    item = F.concat(F.lit("i"), (k - F.when(k % 60 == 5, 1).otherwise(0)).cast("string"))
    third = F.floor(k / 3)
    split = F.when(k % 21 == 0, "validation").when(third % 5 == 1, "test").otherwise("train")
    return table(spark, d, "part").select(
        label.alias("task_id"), F.col("p_brand").alias("namespace"), item.alias("item"), F.concat("p_name", F.lit(" "), F.floor(k / 2).cast("string")).alias("prompt"),
        F.when(k % 30 == 11, "seven").otherwise((F.col("p_size") / 4.0).cast("string")).alias("answer"), F.concat(F.lit("g"), third.cast("string")).alias("group"), split.alias("split"), "p_partkey",
    )


@query(f"""with {_TASKS} select p_partkey, p_partkey % 4 as shard, array_to_string(list_filter([case when trim(task_id) = '' or trim(namespace) = '' or trim(item) = '' or trim(prompt) = '' then 'blank_field' end, case when answer = 'seven' then 'answer' end,
 case when count(*) over (partition by task_id) > 1 then 'repeated_label' end, case when count(*) over (partition by namespace, item) > 1 then 'repeated_source' end, case when count(*) over (partition by prompt, answer) > 1 then 'repeated_question' end,
 case when min(split) over (partition by "group") <> max(split) over (partition by "group") then 'split_conflict' end], lambda x: x is not null), ',') as problems from task""")
def task_source(spark: SparkSession, d: str) -> DataFrame:
    """Tasks come as JSON lines and are read strictly."""
    lines = _tasks(spark, d).select("p_partkey", F.to_json(F.struct("task_id", "namespace", "item", "prompt", "answer", "group", "split")).alias("line"))
    read = R.decoded(lines, "line", "task_id string, namespace string, item string, prompt string, answer string, `group` string, split string")
    return R.task_problems(read.filter("error is null").select("p_partkey", "row.*")).select("p_partkey", (F.col("p_partkey") % 4).alias("shard"), "problems")


@query(f"with {_TASKS} select p_partkey, case when split <> 'train' then 'held_out:' || split end as rejection from task")
def held_out_rejections(spark: SparkSession, d: str) -> DataFrame:
    return R.held_out(_tasks(spark, d)).select("p_partkey", "rejection")


@query(f"with {_TASKS} select split, count(*) as tasks, count(*) filter (split = 'train' and answer <> 'seven') as rewarded from task group by split")
def train_only_rewards(spark: SparkSession, d: str) -> DataFrame:
    rows = R.held_out(_tasks(spark, d)).withColumn("ok", F.col("rejection").isNull() & T.parse_decimal(F.col("answer")).isNotNull())
    return rows.groupBy("split").agg(F.count("*").alias("tasks"), F.count_if("ok").alias("rewarded"))


@query("""select doc_id, source as area, lang as domain, case when n_chars < 500 then 'short' when n_chars < 5000 then 'medium' else 'long' end as difficulty, len(list_filter(regexp_split_to_array(text, '[\\t\\n\\x0B\\f\\r ]+'), lambda w: w <> '')) as tokens from documents""")
def strata(spark: SparkSession, d: str) -> DataFrame:
    band = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 5000, "medium").otherwise("long")
    words = F.filter(F.split("text", "[\\t\\n\\x0B\\f\\r ]+"), lambda w: w != "")
    return table(spark, d, "documents").select("doc_id", F.col("source").alias("area"), F.col("lang").alias("domain"), band.alias("difficulty"), F.when(F.col("text").isNotNull(), F.size(words)).cast("long").alias("tokens"))


@query("""with w as (select conv_id, role, len(list_filter(string_split(text, ' '), lambda x: x <> '')) as n from conversations)
 select conv_id % 10 as shard, count(distinct conv_id) filter (s > 0) as accepted, count(distinct conv_id) filter (s = 0) as rejected, sum(s)::bigint as supervised_tokens, sum(c)::bigint as context_tokens
 from (select conv_id, coalesce(sum(n) filter (role = 'assistant'), 0) as s, coalesce(sum(n) filter (role <> 'assistant'), 0) as c from w group by conv_id) group by 1""")
def sft_counts(spark: SparkSession, d: str) -> DataFrame:
    n = F.size(F.filter(F.split("text", " "), lambda x: x != ""))
    answer = F.col("role") == "assistant"
    each = table(spark, d, "conversations").groupBy("conv_id").agg(F.coalesce(F.sum(F.when(answer, n)), F.lit(0)).alias("s"), F.coalesce(F.sum(F.when(~answer, n)), F.lit(0)).alias("c"))
    return each.groupBy((F.col("conv_id") % 10).alias("shard")).agg(F.count_if(F.col("s") > 0).alias("accepted"), F.count_if(F.col("s") == 0).alias("rejected"), F.sum("s").alias("supervised_tokens"), F.sum("c").alias("context_tokens"))


@query("""select c_custkey, n_name as batch, r_name as registration from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name <> 'AFRICA' and c_acctbal > 0""")
def reference_eligibility(spark: SparkSession, d: str) -> DataFrame:
    members = table(spark, d, "customer").filter("c_acctbal > 0")
    batches = table(spark, d, "nation").join(table(spark, d, "region").filter("r_name != 'AFRICA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return members.join(batches, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("batch"), F.col("r_name").alias("registration"))


# --- judging and screening -------------------------------------------------------------------


@query(f"""with {VOTES}, k as (select record_id, judge, weight from votes where verdict <> 'uncertain'),
 p as (select a.record_id, sum(a.weight * b.weight * case when a.judge = b.judge then 1 else 0.3 end) as q from k a join k b using (record_id) group by 1), s as (select record_id, count(*) as decisive, sum(weight) as w from k group by 1)
 select record_id, decisive, round(w * w / q, 9) as n_eff from s join p using (record_id) where q > 0""")
def decisive_submatrix(spark: SparkSession, d: str) -> DataFrame:
    """With the correlation 1 inside a judge and 0.3 between two, the sum over the submatrix is
    0.3 of the square of all weights and 0.7 of the squares of each judge's."""
    kept = votes(table(spark, d, "lineitem")).filter("verdict != 'uncertain'")
    each = kept.groupBy("record_id", "judge").agg(F.count("*").alias("n"), F.sum("weight").cast("double").alias("w"))
    whole = each.groupBy("record_id").agg(F.sum("n").alias("decisive"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("w")).alias("q"))
    n_eff = F.round(F.col("w") * F.col("w") / (0.3 * F.col("w") * F.col("w") + 0.7 * F.col("q")), 9)
    return whole.filter("w > 0").select("record_id", "decisive", n_eff.alias("n_eff"))


@query("""select o_orderkey as record_id, case when o_orderstatus = 'F' then 'reject' when o_orderpriority = '1-URGENT' or o_custkey % 5 = 0 then 'uncertain' else 'accept' end as verdict from orders""")
def verifier_verdict(spark: SparkSession, d: str) -> DataFrame:
    v = R.verifier_verdict(F.col("o_orderstatus") != "F", F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey") % 5 == 0)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), v.alias("verdict"))


@query("""with s as (select s_suppkey, s_suppkey % 7 * 0.2 as low, s_suppkey % 5 * 0.3 as high, s_suppkey % 4 - 1.0 as least, s_suppkey % 3 * 0.6 as ratio, s_suppkey % 6 as judges, s_suppkey % 9 * 0.2 - 0.2 as rho from supplier)
 select s_suppkey, case when low > high or high > 1 then 'bands' when least < 0 then 'min_n_eff' when ratio > 1 then 'min_n_eff_ratio' when rho < 0 or rho > 1 then 'rho' when judges > 1 and rho <= 0 then 'identity' end as problem from s""")
def panel_preflight(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    tenth = lambda x, by, less="0": (x * F.lit(by).cast("decimal(3,1)") - F.lit(less).cast("decimal(3,1)")).cast("double")
    found = R.preflight(tenth(k % 7, "0.2"), tenth(k % 5, "0.3"), (k % 4 - 1).cast("double"), tenth(k % 3, "0.6"), k % 6, tenth(k % 9, "0.2", "0.2"))
    return table(spark, d, "supplier").select("s_suppkey", found.alias("problem"))


@query(f"""with fit as ({ORACLES['calibration_fit']}), snap as (select judge, loss, case when judge = 'judge3' then weight + 0.5 else weight end as weight from fit)
 select *, 'left' as only_in from (select * from fit except all select * from snap) union all select *, 'right' from (select * from snap except all select * from fit)""")
def calibration_verify(spark: SparkSession, d: str) -> DataFrame:
    fit = calibration_fit(spark, d)
    snapshot = fit.withColumn("weight", F.when(F.col("judge") == "judge3", F.col("weight") + 0.5).otherwise(F.col("weight")))
    return R.differing(fit, snapshot)


@query(f"select name from (select unnest([{', '.join(repr(x) for x in R.PROTECTED)}]) as name union select 'local-' || lang from documents where lang is not null)")
def required_protected_sets(spark: SparkSession, d: str) -> DataFrame:
    return R.protected(spark, table(spark, d, "documents").filter("lang is not null").select(F.concat(F.lit("local-"), "lang")).distinct())


@query("""select source, case when count(*) filter (text is null) > 0 then 'incomplete' when count(*) filter (contains(text, 'password')) = 0 then 'complete_no_match' else 'match_quarantined' end as status from documents group by source""")
def screening_status(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    counts = table(spark, d, "documents").groupBy("source").agg(F.count_if(t.isNull()).alias("gaps"), F.count_if(F.contains(t, F.lit("password"))).alias("matches"))
    return counts.select("source", R.screening_status(F.col("gaps"), F.col("matches")).alias("status"))


_PROMPTS = """lp as (select conv_id, turn, text from conversations where role = 'user'), rp as (select conv_id, turn, case when turn % 4 = 0 and conv_id % 2 = 0 then text || ' and one more thing' when conv_id % 5 = 0 and turn % 4 = 0 then 'something else' else text end as text from lp where not (conv_id % 7 = 0 and turn = 0))"""


@query(f"""with {_PROMPTS}, lt as (select conv_id * 1000 + turn as k, string_split(text, ' ') as words from lp), rt as (select conv_id * 1000 + turn as k, string_split(text, ' ') as words from rp),
 ls as ({shingles(8, 'lt', 'k')}), rs as ({shingles(8, 'rt', 'k')}), b as (select k, count(*) as n from ls join rs using (k, g) group by k), ln as (select k, count(*) as n from ls group by k), rn as (select k, count(*) as n from rs group by k),
 p as (select conv_id, lp.text is not null and rp.text is not null and (lp.text = rp.text or coalesce(b.n, 0) / (ln.n + rn.n - coalesce(b.n, 0)) >= 0.8) as ok from lp full join rp using (conv_id, turn) left join b on b.k = conv_id * 1000 + turn left join ln on ln.k = conv_id * 1000 + turn left join rn on rn.k = conv_id * 1000 + turn)
 select conv_id, bool_and(coalesce(ok, false)) as matches from p group by conv_id""")
def complete_prompt_match(spark: SparkSession, d: str) -> DataFrame:
    """Prompts match if they have the same segments and each one that differs is similar."""
    c, t = F.col("conv_id"), F.col("turn")
    left = table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", "text")
    text = F.when((t % 4 == 0) & (c % 2 == 0), F.concat("text", F.lit(" and one more thing"))).when((c % 5 == 0) & (t % 4 == 0), "something else").otherwise(F.col("text"))
    right = left.filter(~((c % 7 == 0) & (t == 0))).select("conv_id", "turn", text.alias("other"))
    grams = lambda x: T.shingles(F.split(x, " "), 8)
    similar = T.jaccard(grams(F.col("text")), grams(F.col("other"))) >= 0.8
    ok = F.coalesce((F.col("text") == F.col("other")) | similar, F.lit(False))
    return left.join(right, ["conv_id", "turn"], "full").groupBy("conv_id").agg(F.bool_and(ok).alias("matches"))


@query("""with recursive e as (select doc_id as child, (doc_id // 8) * 8 + (doc_id * 3 + 1) % 8 as parent from documents where doc_id % 5 <> 0),
 r as (select child, parent from e union select r.child, e.parent from r join e on e.child = r.parent)
 select distinct child as node from e where not exists (select 1 from r where r.child = e.child and r.parent not in (select child from e))""")
def lineage_in_cycles(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    edges = table(spark, d, "documents").filter(k % 5 != 0).select(k.alias("child"), (F.floor(k / 8) * 8 + (k * 3 + 1) % 8).alias("parent"))
    return screening.cyclic_nodes(edges)
