"""Queries over conversations, and over answers and replies made from the star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.functions import messages as M
from tracesieve.functions import text as T
from tracesieve.plans.registry import query
from tracesieve.plans.sql import LOWER, MESSAGES, REFUSAL, SEPARATORS, first_token, framed
from tracesieve.sources.tables import messages, prompt_lines, table


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return messages(table(spark, d, "conversations"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("conv_id", F.posexplode("messages").alias("turn", "m")).select("conv_id", F.col("turn").cast("long").alias("turn"), "m.*")


def _render(one: str, start: str = "''", end: str = "''") -> str:
    return f"with {MESSAGES} select conv_id, {start} || string_agg({one}, '' order by turn) || {end} as rendered from turns group by conv_id"


_THINK = "case when role = 'assistant' and reasoning is not null then '<think>' || reasoning || '</think>' else '' end"


@query(_render(f"'<|im_start|>' || case when role = 'developer' then 'system' else role end || chr(10) || {_THINK} || coalesce(content, '') || '<|im_end|>' || chr(10)"))
def render_chatml(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("conv_id", M.chatml(F.col("messages")).alias("rendered"))


_ANALYSIS = "case when reasoning is not null then '<|start|>assistant<|channel|>analysis<|message|>' || reasoning || '<|end|>' else '' end"


@query(_render(f"case when role = 'assistant' then {_ANALYSIS} || '<|start|>assistant<|channel|>final<|message|>' || coalesce(content, '') || '<|return|>' else '<|start|>' || role || '<|message|>' || coalesce(content, '') || '<|end|>' end"))
def render_harmony(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("conv_id", M.harmony(F.col("messages")).alias("rendered"))


_JSON = "case when reasoning is not null then json_object({0}, {1}, 'reasoning', reasoning) else json_object({0}, {1}) end::varchar"


@query(_render("case when turn > 0 then ',' else '' end || " + _JSON.format("'from', case role when 'user' then 'human' when 'assistant' then 'gpt' when 'tool' then 'tool' else 'system' end", "'value', content"), "'{\"conversations\":['", "']}'"))
def render_sharegpt(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("conv_id", M.sharegpt(F.col("messages")).alias("rendered"))


@query(_render("case when turn > 0 then ',' else '' end || " + _JSON.format("'role', role", "'content', content"), "'{\"messages\":['", "']}'"))
def render_openai(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("conv_id", M.openai(F.col("messages")).alias("rendered"))


@query(f"""with {MESSAGES}, l as (select *, max(turn) over (partition by conv_id) as last from turns), e as (select * from l where conv_id in (select conv_id from l where turn = last and role = 'assistant'))
 select conv_id, '{{"prompt":[' || coalesce(string_agg({_JSON.format("'role', role", "'content', content")}, ',' order by turn) filter (turn < last), '') || '],"completion":[' || max({_JSON.format("'role', role", "'content', content")}) filter (turn = last) || ']}}' as rendered from e group by conv_id""")
def render_prompt_completion(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("conv_id", M.prompt_completion(F.col("messages")).alias("rendered")).filter("rendered is not null")


_MODEL = "'<|turn>model' || chr(10) || '<|channel>thought' || chr(10) || coalesce(reasoning || chr(10), '') || '<channel|>' || content || '<turn|>' || chr(10)"


@query(_render(f"case when role = 'assistant' then {_MODEL} when role = 'system' then '' else '<|turn>user' || chr(10) || coalesce((select s.content || chr(10) || chr(10) from turns s where s.conv_id = turns.conv_id and s.turn = turns.turn - 1 and s.role = 'system'), '') || content || '<turn|>' || chr(10) end", "'<bos>'"))
def render_gemma(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("conv_id", M.gemma(F.col("messages")).alias("rendered"))


@query(f"""with {MESSAGES} select a.conv_id, a.turn + 1 as target, count(b.turn) as prompt_turns, length(min(a.content)) as completion_chars, string_agg(b.role, ',' order by b.turn) as prompt_roles
 from turns a left join turns b on a.conv_id = b.conv_id and b.turn < a.turn where a.role = 'assistant' group by 1, 2""")
def sft_units(spark: SparkSession, d: str) -> DataFrame:
    u = _messages(spark, d).select("conv_id", F.explode(M.sft_units(F.col("messages"))).alias("u"))
    return u.select("conv_id", F.col("u.target").cast("long").alias("target"), F.size("u.prompt").cast("long").alias("prompt_turns"), F.length("u.completion.content").cast("long").alias("completion_chars"), F.array_join("u.prompt.role", ",").alias("prompt_roles"))


@query(f"""with {MESSAGES} select conv_id, case when count(*) filter (role = 'assistant') = 0 then 'no_assistant' when count(*) filter (role = 'assistant') > 1 then 'needs_final_only' else 'ok' end as status, count(*) filter (role = 'assistant') as assistants from turns group by conv_id""")
def sft_projection(spark: SparkSession, d: str) -> DataFrame:
    n = F.size(F.filter("messages", lambda m: m["role"] == "assistant"))
    return _messages(spark, d).select("conv_id", F.when(n == 0, "no_assistant").when(n > 1, "needs_final_only").otherwise("ok").alias("status"), n.cast("long").alias("assistants"))


@query(f"""with {MESSAGES}, b as (select conv_id, role, row_number() over (partition by conv_id order by turn) - 1 as i, count(*) over (partition by conv_id) as n from turns where not (turn = 0 and role = 'system'))
 select conv_id, bool_and(role = case when i % 2 = 0 then 'user' else 'assistant' end) and max(n) % 2 = 0 as alternates from b group by conv_id""")
def alternation(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("conv_id", M.alternates(F.col("messages")).alias("alternates"))


# Every fifth turn is given a control token, so that there are leaks to find.
_LEAKY = "case (conv_id + turn) % 5 when 0 then content || ' <|im_end|> <think>' when 1 then '<bos>' || content else content end"


@query(f"with {MESSAGES}, t as (select conv_id, turn, role, {first_token(_LEAKY)} as token from turns), f as (select *, row_number() over (partition by conv_id order by turn) as k from t where token is not null) select conv_id, role, token from f where k = 1")
def control_tokens(spark: SparkSession, d: str) -> DataFrame:
    k = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(5))
    conv = table(spark, d, "conversations").withColumn("text", F.when(k == 0, F.concat("text", F.lit(" <|im_end|> <think>"))).when(k == 1, F.concat(F.lit("<bos>"), "text")).otherwise(F.col("text")))
    return messages(conv).select("conv_id", M.first_leak(F.col("messages")).alias("x")).filter("x is not null").select("conv_id", "x.role", "x.token")


# Turns are wrapped in one of the reasoning channels.
_WRAPPED = """case turn % 4 when 0 then '<think>plan' || turn || '</think>' || content when 1 then '<|channel>thought' || chr(10) || 'idea' || chr(10) || '<channel|>' || content
  when 2 then '<|start|>assistant<|channel|>analysis<|message|>why<|end|><|start|>assistant<|channel|>final<|message|>' || content || '<|return|>' else content || '<think>late</think>' end"""


def _wrapped(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("turn") % 4
    c = F.col("text")
    text = (
        F.when(t == 0, F.concat(F.lit("<think>plan"), F.col("turn").cast("string"), F.lit("</think>"), c)).when(t == 1, F.concat(F.lit("<|channel>thought\nidea\n<channel|>"), c))
        .when(t == 2, F.concat(F.lit("<|start|>assistant<|channel|>analysis<|message|>why<|end|><|start|>assistant<|channel|>final<|message|>"), c, F.lit("<|return|>"))).otherwise(F.concat(c, F.lit("<think>late</think>")))
    )
    return table(spark, d, "conversations").select("conv_id", "turn", "role", text.alias("text"))


@query(f"""with {MESSAGES} select conv_id, turn, case when turn % 4 = 3 then content || '<think>late</think>' else content end as content, case turn % 4 when 0 then 'plan' || turn when 1 then 'idea' when 2 then 'why' end as reasoning from turns""")
def strip_channels(spark: SparkSession, d: str) -> DataFrame:
    return _wrapped(spark, d).select("conv_id", "turn", T.strip_channels(F.col("text")).alias("x")).select("conv_id", "turn", "x.*")


@query(f"""with {MESSAGES} select conv_id, turn, case role when 'tool' then 'tool' when 'system' then 'system' when 'user' then 'user' else 'assistant' end as role,
 case when turn % 4 = 3 then content || '<think>late</think>' else content end as content, case when turn % 6 = 0 then 'given' else case turn % 4 when 0 then 'plan' || turn when 1 then 'idea' when 2 then 'why' end end as reasoning,
 turn % 4 = 3 as residual from turns""")
def ingest_messages(spark: SparkSession, d: str) -> DataFrame:
    given = F.when(F.col("turn") % 6 == 0, "given")
    reply = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("role"), F.col("text").alias("content"), given.alias("reasoning")).alias("message"))).alias("choices")))
    body = _wrapped(spark, d).select("conv_id", "turn", F.from_json(reply, "choices array<struct<message struct<role string, content string, reasoning string>>>").alias("r"))
    m = body.select("conv_id", "turn", F.col("r.choices")[0]["message"].alias("m")).withColumn("x", T.strip_channels(F.col("m.content")))
    role = F.when(F.col("m.role").isin("tool", "system", "user"), F.col("m.role")).otherwise("assistant")
    return m.select("conv_id", "turn", role.alias("role"), F.col("x.content").alias("content"), F.coalesce(F.when(F.col("m.reasoning") != "", F.col("m.reasoning")), F.col("x.reasoning")).alias("reasoning"), T.first_control_token(F.col("x.content")).isNotNull().alias("residual"))




@query("with t as (select conv_id, turn, trim(text) as v from conversations where turn = 0) select conv_id, v as value from t where v <> '' and not starts_with(v, '#')")
def prompt_lines_query(spark: SparkSession, d: str) -> DataFrame:
    first = table(spark, d, "conversations").filter("turn = 0")
    return prompt_lines(first.select("conv_id", F.col("text").alias("value")))


@query(f"with {MESSAGES} select conv_id, string_agg({framed('role', 'content')}, '' order by turn) as prompt_hash from turns where role <> 'assistant' group by conv_id")
def prompt_hash(spark: SparkSession, d: str) -> DataFrame:
    parts = F.transform(F.filter("messages", lambda m: m["role"] != "assistant"), lambda m: T.framed_digest(m["role"], m["content"]))
    return _messages(spark, d).select("conv_id", F.array_join(parts, "").alias("prompt_hash")).filter("prompt_hash != ''")


@query(f"with {MESSAGES} select conv_id, string_agg({framed('content')}, '' order by turn) as completion_hash from turns where role = 'assistant' group by conv_id")
def completion_hash(spark: SparkSession, d: str) -> DataFrame:
    parts = F.transform(F.filter("messages", lambda m: m["role"] == "assistant"), lambda m: T.framed_digest(m["content"]))
    return _messages(spark, d).select("conv_id", F.array_join(parts, "").alias("completion_hash")).filter("completion_hash != ''")


_SAID = "case turn % 5 when 0 then 'I''m sorry, but ' || text when 1 then 'Sure, ' || text when 2 then 'STEP ONE: ' || text when 3 then 'As an AI, I must decline.' else text end"


@query(f"with s as (select conv_id, turn, {LOWER.format(f'trim({_SAID})')} as t from conversations) select conv_id, turn, {REFUSAL} as class from s")
def refusal_class(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("turn") % 5
    said = F.when(k == 0, F.concat(F.lit("I'm sorry, but "), "text")).when(k == 1, F.concat(F.lit("Sure, "), "text")).when(k == 2, F.concat(F.lit("STEP ONE: "), "text")).when(k == 3, "As an AI, I must decline.").otherwise(F.col("text"))
    return table(spark, d, "conversations").select("conv_id", "turn", T.refusal_class(said).alias("class"))


@query(f"""with {MESSAGES}, l as (select *, row_number() over (partition by conv_id order by turn desc) as k from turns where role = 'assistant')
 select conv_id, case when conv_id % 4 = 0 then 'inert' when trim(coalesce(reasoning, '')) <> '' and length(content) % 3 > 0 then 'pass' else 'fail' end as reasoning_check from l where k = 1""")
def reasoning_present(spark: SparkSession, d: str) -> DataFrame:
    last = F.try_element_at(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(-1))
    m = _messages(spark, d).select("conv_id", last.alias("m")).filter("m is not null")
    present = (F.trim(F.coalesce("m.reasoning", F.lit(""))) != "") & (F.length("m.content") % 3 > 0)
    return m.select("conv_id", F.when(F.col("conv_id") % 4 == 0, "inert").when(present, "pass").otherwise("fail").alias("reasoning_check"))


@query(f"""with {MESSAGES} select conv_id, list_sort(list_distinct(list_concat(['content'], list(case when reasoning is not null then 'reasoning' end) filter (reasoning is not null), list(case when length(content) > 1500 then 'long' end) filter (length(content) > 1500)))) as fields from turns group by conv_id""")
def screening_fields(spark: SparkSession, d: str) -> DataFrame:
    per = F.flatten(F.transform("messages", lambda m: F.array_compact(F.array(F.lit("content"), F.when(m["reasoning"].isNotNull(), F.lit("reasoning")), F.when(F.length(m["content"]) > 1500, F.lit("long"))))))
    return _messages(spark, d).select("conv_id", F.array_sort(F.array_distinct(per)).alias("fields"))


# Calls and results by arithmetic: turn t of a conversation calls, turn t + 1 answers, some twice or never.
@query("""with c as (select conv_id, turn as pos, 'call' || (turn // 2) as call_id from conversations where role = 'assistant'), r as (select conv_id, turn as pos, case when (conv_id + turn) % 5 = 0 then 'call99' else 'call' || (turn // 2 - case when turn % 2 = 0 then 1 else 0 end) end as call_id from conversations where role = 'user' and turn > 0),
 dup as (select conv_id, call_id from c group by 1, 2 having count(*) > 1), a as (select r.conv_id, r.pos, r.call_id, count(c.pos) as calls from r left join c on c.conv_id = r.conv_id and c.call_id = r.call_id and c.pos < r.pos group by 1, 2, 3),
 n as (select conv_id, call_id, count(*) as answers from r group by 1, 2)
 select a.conv_id, a.pos, case when d.call_id is not null then 'duplicate_call' when calls = 0 then 'no_earlier_call' when answers > 1 then 'answered_twice' else 'ok' end as link from a left join dup d using (conv_id, call_id) join n using (conv_id, call_id)""")
def tool_links(spark: SparkSession, d: str) -> DataFrame:
    conv = table(spark, d, "conversations")
    call = lambda n: F.concat(F.lit("call"), n.cast("string"))
    half = F.floor(F.col("turn") / 2)
    c = conv.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("call_pos"), call(half).alias("call_id"))
    r = conv.filter("role = 'user' and turn > 0").select("conv_id", F.col("turn").alias("pos"), F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, "call99").otherwise(call(half - (F.col("turn") % 2 == 0).cast("int"))).alias("call_id"))
    dup = c.groupBy("conv_id", "call_id").agg((F.count("*") > 1).alias("dup"), F.array_agg("call_pos").alias("at"))
    n = r.groupBy("conv_id", "call_id").agg(F.count("*").alias("answers"))
    x = r.join(dup, ["conv_id", "call_id"], "left").join(n, ["conv_id", "call_id"])
    earlier = F.exists(F.coalesce("at", F.array().cast("array<bigint>")), lambda p: p < F.col("pos"))
    return x.select("conv_id", "pos", F.when(F.coalesce("dup", F.lit(False)), "duplicate_call").when(~earlier, "no_earlier_call").when(F.col("answers") > 1, "answered_twice").otherwise("ok").alias("link"))


@query("""select conv_id, turn, case turn % 4 when 0 then '{}' when 1 then '{"k":' || turn || '}' when 2 then '{"n":' || conv_id || '}' end as arguments, case turn % 4 when 1 then '{"k":' || turn || '}' end as raw_arguments, turn % 4 = 3 as invalid from conversations""")
def tool_arguments(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("turn") % 4
    raw = F.when(k == 1, F.concat(F.lit('"{\\"k\\":'), F.col("turn").cast("string"), F.lit('}"'))).when(k == 2, F.concat(F.lit('{"n":'), F.col("conv_id").cast("string"), F.lit("}"))).when(k == 3, F.lit("[1]"))
    v = F.try_parse_json(raw)
    inner = F.try_variant_get(v, "$", "string")
    text = F.when(raw.startswith('"'), inner)
    body = F.when(raw.isNull(), F.lit("{}")).when(text.isNotNull(), text).otherwise(raw)
    ok = F.startswith(F.schema_of_variant(F.try_parse_json(body)), F.lit("OBJECT"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.when(ok, body).alias("arguments"), text.alias("raw_arguments"), (~F.coalesce(ok, F.lit(False))).alias("invalid"))


@query(f"""with {MESSAGES} select conv_id, turn, role = 'assistant' and length(content) % 2 = 0 as has_calls, role = 'user' and turn % 5 = 2 as has_link, case when (role = 'assistant' and length(content) % 2 = 0) or (role = 'user' and turn % 5 = 2) then 'lost' else 'kept' end as chatml from turns""")
def tool_signals(spark: SparkSession, d: str) -> DataFrame:
    t = _turns(spark, d)
    calls, link = (F.col("role") == "assistant") & (F.length("content") % 2 == 0), (F.col("role") == "user") & (F.col("turn") % 5 == 2)
    return t.select("conv_id", "turn", calls.alias("has_calls"), link.alias("has_link"), F.when(calls | link, "lost").otherwise("kept").alias("chatml"))


@query(f"""with {MESSAGES}, e as (select conv_id, string_agg(role || ':' || left(content, 2), chr(1) order by turn) filter (turn < 2) as prefix, max(content) filter (turn = 1) as last, count(*) as n from turns group by 1)
 select a.conv_id as chosen, b.conv_id as rejected from e a join e b on a.conv_id < b.conv_id and a.prefix = b.prefix and a.n >= 2 and b.n >= 2""")
def preference_messages(spark: SparkSession, d: str) -> DataFrame:
    """No two conversations share a prompt, so that two characters of each turn stand for it."""
    prefix = F.array_join(F.transform(F.slice("messages", 1, 2), lambda m: F.concat(m["role"], F.lit(":"), F.substring(m["content"], 1, 2))), "\u0001")
    e = _messages(spark, d).filter(F.size("messages") >= 2).select("conv_id", prefix.alias("prefix"))
    return e.toDF("chosen", "prefix").join(e.toDF("rejected", "prefix"), "prefix").filter("chosen < rejected").select("chosen", "rejected")


@query(f"select p_partkey, {LOWER.format(f'''trim(regexp_replace('  ' || upper(p_name) || chr(9) || p_type || ' ', '{SEPARATORS}', ' ', 'g'))''')} as answer from part")
def normalize_answer(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit("\t"), F.col("p_type"), F.lit(" "))
    return table(spark, d, "part").select("p_partkey", T.normalize_answer(raw).alias("answer"))


@query("select p_partkey, list_sort([p_brand, p_type, p_brand]) = list_sort([p_type, p_brand, case when p_size % 2 = 0 then p_brand else p_type end]) as same from (select p_partkey, p_size, lower(p_brand) as p_brand, lower(p_type) as p_type from part)")
def set_match(spark: SparkSession, d: str) -> DataFrame:
    a = F.concat_ws(", ", "p_brand", "p_type", "p_brand")
    b = F.concat_ws("; ", F.upper("p_type"), "p_brand", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(F.col("p_type")))
    return table(spark, d, "part").select("p_partkey", T.same_set(a, b).alias("same"))


# Answers by arithmetic, some of which are no plain decimals.
_ANSWER = "case p_partkey % 8 when 0 then p_size::varchar when 1 then '-' || p_size || '.50' when 2 then '1,000' when 3 then p_size || 'd' when 4 then '1e400' when 5 then '1e-400' when 6 then '.' || p_size else p_size || 'e1' end"
_VALUE = "case p_partkey % 8 when 0 then p_size::double when 1 then -(p_size + 0.5)::double when 6 then ('0.' || p_size)::double when 7 then p_size * 10.0::double end"


def _answer() -> Column:
    k, s = F.col("p_partkey") % 8, F.col("p_size").cast("string")
    fixed = {2: F.lit("1,000"), 3: F.concat(s, F.lit("d")), 4: F.lit("1e400"), 5: F.lit("1e-400"), 6: F.concat(F.lit("."), s), 7: F.concat(s, F.lit("e1"))}
    out = F.when(k == 0, s).when(k == 1, F.concat(F.lit("-"), s, F.lit(".50")))
    for n, x in fixed.items():
        out = out.when(k == n, x)
    return out


@query(f"select p_partkey, {_ANSWER} as answer, {_VALUE} as value from part")
def parse_decimal(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", _answer().alias("answer")).withColumn("value", T.parse_decimal(F.col("answer")))


@query(f"select p_partkey, case when p_partkey % 5 <> 1 then {_ANSWER} end as answer from part")
def numeric_extract(spark: SparkSession, d: str) -> DataFrame:
    twice = F.when(F.col("p_partkey") % 5 == 1, "ANSWER: 1\n").otherwise("so\n")
    said = F.concat(twice, F.lit("thinking\nANSWER: "), _answer(), F.lit("\n  \n"))
    return table(spark, d, "part").select("p_partkey", T.extract_marked(said, "ANSWER:").alias("answer"))


@query(f"select p_partkey, case when v is null then 'unknown' when abs(v - p_size) <= greatest(0.001, abs(p_size) * 0.1) then 'pass' else 'fail' end as outcome from (select p_partkey, p_size, {_VALUE} as v from part)")
def numeric_match(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.numeric_outcome(_answer(), F.col("p_size").cast("string"), 0.001, 0.1).alias("outcome"))


@query(f"select p_partkey, case when v is null then null when abs(v - p_size) <= greatest(0.001, abs(p_size) * 0.1) then 1.0 else 0.0 end::double as reward from (select p_partkey, p_size, {_VALUE} as v from part)")
def numeric_reward(spark: SparkSession, d: str) -> DataFrame:
    outcome = T.numeric_outcome(_answer(), F.col("p_size").cast("string"), 0.001, 0.1)
    return table(spark, d, "part").select("p_partkey", F.when(outcome == "pass", 1.0).when(outcome == "fail", 0.0).alias("reward"))


@query(f"""select p_partkey, case p_partkey % 3 when 0 then case when v is null then 'undecided' when abs(v - p_size) <= greatest(1e-6, abs(p_size) * 1e-6) then 'match' else 'mismatch' end
 when 1 then case when p_size % 2 = 0 then 'match' else 'mismatch' end else case when p_size % 2 = 0 then 'match' else 'undecided' end end as answer from (select p_partkey, p_size, {_VALUE} as v from part)""")
def answer_compare(spark: SparkSession, d: str) -> DataFrame:
    k, even = F.col("p_partkey") % 3, F.col("p_size") % 2 == 0
    numeric = T.numeric_outcome(_answer(), F.col("p_size").cast("string"), 1e-6, 1e-6)
    as_set = T.same_set(F.lit("b a, b"), F.when(even, "A b B").otherwise("a b"))
    as_text = T.normalize_answer(F.lit(" Select  1 ")) == T.normalize_answer(F.when(even, "select 1").otherwise("select 2"))
    out = F.when(k == 0, F.when(numeric == "pass", "match").when(numeric == "fail", "mismatch").otherwise("undecided")).when(k == 1, F.when(as_set, "match").otherwise("mismatch")).otherwise(F.when(as_text, "match").otherwise("undecided"))
    return table(spark, d, "part").select("p_partkey", out.alias("answer"))


@query("""select p_partkey, case when p_partkey % 4 = 3 then null when p_size > 1 then least(1.0, p_size / 10.0::double) else p_size::double end as score,
 case when p_partkey % 4 = 3 then null when p_partkey % 3 = 0 then 'accept' when p_partkey % 3 = 1 then 'reject' else 'uncertain' end as verdict from part""")
def judge_parse(spark: SparkSession, d: str) -> DataFrame:
    verdict = F.when(F.col("p_partkey") % 3 == 0, "Admit").when(F.col("p_partkey") % 3 == 1, " REJECT ").otherwise("maybe")
    body = F.concat(F.lit('{"score": '), F.col("p_size").cast("string"), F.lit(', "verdict": "'), verdict, F.lit('"}'))
    k = F.col("p_partkey") % 4
    reply = F.when(k == 0, body).when(k == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 2, F.concat(F.lit("I think "), body, F.lit(" is right"))).otherwise("no idea")
    return table(spark, d, "part").select("p_partkey", T.judge_reply(reply).alias("r")).select("p_partkey", "r.score", "r.verdict")


@query("select s_suppkey, case when s_suppkey % 10 = 0 then 0.0 when s_nationkey > 1 then least(1.0, s_nationkey / 10.0::double) else s_nationkey::double end::double as score from supplier")
def normalize_score(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("s_suppkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("s_nationkey").cast("double"))
    return table(spark, d, "supplier").select("s_suppkey", T.normalize_score(raw).alias("score"))


@query("select c_custkey, case when (c_custkey % 101) / 100.0::double >= 0.8 then 'accept' when (c_custkey % 101) / 100.0::double < 0.6 then 'reject' else 'revise' end as band from customer")
def score_band(spark: SparkSession, d: str) -> DataFrame:
    from tracesieve.operators.consensus import band

    return table(spark, d, "customer").select("c_custkey", band((F.col("c_custkey") % 101) / 100.0).alias("band"))


# A conversation's characters in tokens of four; the assistant's turns are supervised.
@query(f"""with {MESSAGES}, o as (select conv_id, turn, role, sum(length(content)) over (partition by conv_id order by turn) as e, length(content) as n from turns),
 t as (select conv_id, unnest(range(0, (max(e) // 4)::bigint)) as i from o group by 1),
 l as (select t.conv_id, t.i, bool_or(o.e - o.n <= 4 * i and 4 * i + 4 <= o.e) filter (role = 'assistant') as inside, bool_or(o.e - o.n < 4 * i + 4 and 4 * i < o.e) filter (role = 'assistant') as touches from t join o using (conv_id) group by 1, 2)
 select conv_id, count(*) as tokens, count(*) filter (inside) as supervised, coalesce(bool_or(touches and not inside), false) as mixed from l group by 1""")
def label_tokens(spark: SparkSession, d: str) -> DataFrame:
    from tracesieve.operators.selection import label_tokens as labelled

    step = lambda s, m: F.struct((s["e"] + F.length(m["content"])).alias("e"), F.when(m["role"] == "assistant", F.concat(s["o"], F.array(F.struct(s["e"].alias("start"), (s["e"] + F.length(m["content"])).alias("end"))))).otherwise(s["o"]).alias("o"))
    start = F.struct(F.lit(0).alias("e"), F.array().cast("array<struct<start:int,end:int>>").alias("o"))
    rows = _messages(spark, d).select("conv_id", F.aggregate("messages", start, step).alias("x"))
    places = F.slice(F.sequence(F.lit(0), F.floor(F.col("x.e") / 4).cast("int")), 1, F.floor(F.col("x.e") / 4).cast("int"))
    rows = rows.select("conv_id", "x", places.alias("ids"))
    spans = F.transform("ids", lambda i: F.struct((i * 4).alias("start"), (i * 4 + 4).alias("end")))
    rows = rows.select("conv_id", "ids", F.col("x.o").alias("owners"), spans.alias("spans"))
    whole = F.filter("spans", lambda t: F.exists("owners", lambda o: (o["start"] <= t["start"]) & (t["end"] <= o["end"])))
    return rows.filter("size(ids) > 0").select("conv_id", F.size("ids").cast("long").alias("tokens"), F.size(whole).cast("long").alias("supervised"), labelled(F.col("spans"), F.col("owners"), F.col("ids")).isNull().alias("mixed"))
