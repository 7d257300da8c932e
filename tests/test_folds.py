"""Sequences, commands, accounts, separation, responses and prompts on hand-made and odd rows."""

import random

from pyspark.sql import functions as F

from tracesieve.operators import evaluate, ledger, prompts, records, responses, sequences


def test_numbers_places_and_predecessors(spark):
    r = random.Random(1)
    rows = [(r.choice([7, 7, 7, 7, 1, 2, None, 9]), i, r.choice([None, "a", "b"])) for i in range(500)] + [(50, i, "z") for i in range(900)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, at long, v string").repartition(6)
    want, ordinal = {}, 0
    last = {}
    for k, at, v in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        place, before = last.get(k, (-1, None))
        want[(k, at)] = (ordinal, place + 1, before)
        last[k] = (place + 1, (v,))
        ordinal += 1
    for parts in ("1", "4", "37"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {(x["k"], x["at"]): (x["ordinal"], x["place"], tuple(x["before"]) if x["before"] is not None else None) for x in sequences.in_order(df, ["k"], ["at"], ["v"]).collect()}
        assert got == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sequences.in_order(df.limit(0), ["k"], ["at"]).count() == 0
    items = spark.createDataFrame([(x,) for x in (3, 5, 40, 41, 1000, 1001, 7)], "item long")
    assert {tuple(x) for x in sequences.shards(items, ["item"], 2, 10).collect()} == {(3, 0, 0, 10), (5, 1, 0, 11), (7, 0, 1, 12), (40, 1, 1, 13), (41, 0, 2, 14), (1000, 1, 2, 15), (1001, 0, 3, 16)}


def test_a_hot_key_is_many_tasks(spark):
    df = spark.range(40_000).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    dealt = df.repartitionByRange(8, "k", "at").groupBy(F.spark_partition_id()).count().collect()
    assert max(x["count"] for x in dealt) < 10_000
    out = sequences.in_order(df, ["k"], ["at"], ["at"]).agg(F.bool_and((F.col("place") == F.col("at")) & F.coalesce(F.col("before.at") == F.col("at") - 1, F.col("at") == 0))).first()[0]
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out


def test_commands_follow_each_other(spark):
    commands = [("a", 1, 0, 1), ("b", 1, 1, 2), ("b", 1, 2, 3), ("c", 1, 0, 4), ("c", 1, 2, 5), ("a", 2, 5, 1), ("a", 2, 3, 2), ("x", 9, 0, 1), ("x", None, 0, 1), ("y", 2, None, 9)]
    df = spark.createDataFrame(commands, "command_id string, record_id long, expected long, placed long")
    got = {(x["record_id"], x["placed"]): x["outcome"] for x in records.guarded(df, spark.createDataFrame([(1, 0), (2, 3)], "record_id long, version long")).collect()}
    want = {(1, 1): "applied", (1, 2): "applied", (1, 3): "already_applied", (1, 4): "conflict", (1, 5): "applied", (2, 1): "conflict", (2, 2): "applied", (9, 1): "not_found", (None, 1): "not_found", (2, 9): "conflict"}
    assert got == want


RECEIPT = "run_id string, cost_state string, cost_usd double, conflicts string, invalid_fields string, prompt_tokens long, completion_tokens long, total_tokens long, reasoning_tokens long, transport string, elapsed_ms long"


def test_accounts(spark):
    big = 2**62
    rows = [
        ("a", "known", 1.5, "model", None, 5, None, 1, None, "complete", 7),  # a conflict elsewhere keeps the cost
        ("a", "known", 2.0, "cost_usd,prompt_tokens", "", 5, 6, 1, None, None, 7),
        ("a", "known", 4.0, "", "cost", 5, 6, 1, None, "failed", 1),
        ("a", "missing", None, None, None, None, 6, 1, None, "complete", None),
        ("b", "known", 1e308, "", None, big, None, None, None, "complete", 1),
        ("b", "known", 1e308, "", None, big, None, None, None, "complete", 1),
    ]
    got = {x["run_id"]: x for x in ledger.spend_gate(ledger.accounting(spark.createDataFrame(rows, RECEIPT)), 5.0).collect()}
    a, b = got["a"], got["b"]
    assert (a["attempts"], a["known_usd"], a["unknown_cost"], a["invalid_cost"], a["conflicting"], a["unresolved"], a["elapsed_ms"]) == (4, 1.5, 1, 1, 2, 1, 8)
    assert (a["prompt_tokens_known"], a["prompt_tokens_missing"], a["prompt_tokens_invalid"], a["completion_tokens_missing"]) == (10, 1, 1, 1)
    assert (b["known_usd"], b["prompt_tokens_known"], b["admission"], a["admission"]) == (None, None, "denied_invalid", "denied_unresolved")


def test_separation_counts_groups_that_all_passed(spark):
    rows = [("p", 0.9, True), ("p", 0.7, True), ("m", 0.2, True), ("m", 0.4, False), ("s", 0.1, True), ("q", 0.5, True), ("q", float("inf"), True), ("q", None, True)]
    df = spark.createDataFrame([("r", "x", *x) for x in rows], "run_id string, training_area string, group_id string, aggregate double, all_passed boolean")
    x = evaluate.separation(df).first()
    assert (x["mean_max"], round(x["mean_mean"], 9), x["score_groups"], x["invalid_scores"], x["mixed"], x["singletons"], x["low_decidability"]) == (0.9, 0.8, 1, 1, 1, 1, True)
    assert evaluate.separation(df.withColumn("training_area", F.col("aggregate").cast("string"))).first()["score_groups"] == 0
    assert evaluate.separation(df.limit(0)).first()["decidable"] is None


DELTAS = """response_id long, seq long, content string, reasoning string, details array<struct<kind string, index int, text string, signature string>>, refusal string, finish string, native_finish string,
 calls array<struct<index int, kind string, id string, name string, arguments string>>, served_by string, model string, generation_id string, prompt_tokens long, completion_tokens long, reasoning_tokens long, cost double"""


def response(i, *deltas):
    names = [x.split()[0] for x in "content reasoning details refusal finish native_finish calls served_by model generation_id prompt_tokens completion_tokens reasoning_tokens cost".split()]
    return [(i, s, *(d.get(n) for n in names)) for s, d in enumerate(deltas)]


def test_responses(spark):
    call = lambda index=0, id="i", name="f", args="{}", kind="function": {"calls": [(index, kind, id, name, args)], "finish": "tool_calls"}  # noqa: A002, E731
    cases = [
        ("ok", None, [{"content": ""}, {"content": "a", "finish": "stop"}, {"prompt_tokens": 3}]),
        ("invalid_completion", responses.AFTER_FINISH, [{"finish": "stop"}, {"calls": []}, {"finish": "length"}]),
        ("invalid_completion", responses.CONFLICTING_FINISH, [{"content": "a", "finish": "stop"}, {"finish": "length"}]),
        ("truncated_reasoning", None, [{"details": [("summary", None, "x", None)]}, {"finish": "length"}]),
        ("ok", None, [{"content": "a", "finish": "length"}]),
        ("ok", None, [call(args='{"a": [1]}')]),
        ("invalid_completion", responses.UNSUPPORTED_KIND, [call(kind="custom")]),
        ("invalid_completion", responses.CONFLICTING_ID, [{"calls": [(0, None, "i", None, None), (0, "other", "j", "f", "{}")], "finish": "tool_calls"}]),
        ("invalid_completion", responses.NO_CALLS, [{"content": "a", "finish": "tool_calls"}]),
        ("invalid_completion", responses.NO_FINISH, [{"calls": [(0, None, "i", "f", "{}")]}]),
        ("invalid_completion", responses.NONCONTIGUOUS, [call(1)]),
        ("invalid_completion", responses.NO_ID, [call(id=None)]),
        ("invalid_completion", responses.NO_NAME, [call(name=" ")]),
        ("invalid_completion", responses.NO_NAME, [{"calls": [(0, None, "i", "f", "{}"), (1, None, "i", "f", "{}")], "finish": "tool_calls"}]),
        *(("invalid_completion", responses.MALFORMED, [call(args=x)]) for x in ('{"a":1} x', '{"a":1},{}', '{"a":1}],[{}', "", None, "{")),
        *(("invalid_completion", responses.NO_OBJECT, [call(args=x)]) for x in ("[1]", "null", '"x"', "1")),
        ("empty_response", None, [{"content": "", "finish": "stop"}]),
        ("control_token", "<|im_end|>", [{"content": "a <|im_"}, {"content": "end|>", "finish": "stop"}]),
        ("ok", None, [{"refusal": "no"}, {"refusal": "No."}]),
    ]
    df = spark.createDataFrame([x for i, (_, _, d) in enumerate(cases) for x in response(i, *d)], DELTAS).repartition(3)
    got = {x["response_id"]: x for x in responses.turns(df).collect()}
    for i, (outcome, detail, _) in enumerate(cases):
        assert (got[i]["outcome"], got[i]["detail"]) == (outcome, detail), (i, cases[i], got[i])
    assert got[0]["content"] == "a" and got[5]["content"] is None and got[len(cases) - 1]["content"] == "No."
    assert responses.turns(df.limit(0)).count() == 0


def test_detail_blocks(spark):
    parts = [("text", 0, "a", None), ("text", 0, "b", "s"), ("text", 1, "c", "t"), ("summary", 1, "d", None), ("encrypted", 1, "e", None), ("encrypted", 1, "f", None), ("text", None, "g", None), ("text", None, "h", None), ("text", 0, "i", None)]
    df = spark.createDataFrame(response(1, *({"details": [p]} for p in parts[:4]), {"details": parts[4:]}, {}), DELTAS)
    got = [(x["kind"], x["text"], x["signature"]) for x in responses.detail_blocks(df).orderBy("place").collect()]
    assert got == [("text", "ab", None), ("text", "c", "t"), ("summary", "d", None), ("encrypted", "e", None), ("encrypted", "f", None), ("text", "gh", None), ("text", "i", None)]


def test_prompt_edges(spark):
    words = " ".join(f"w{i}" for i in range(60))
    near, far = words + " end", "other " + words[:120]
    user, said = ("user", words, None), ("assistant", "Yes.", None)
    rows = [
        (1, [("system", words, None), user, said]),
        (2, [("system", words.upper(), None), user, said]),  # the same words
        (3, [("system", near, None), user, said]),  # similar in one segment
        (4, [("system", near, None), ("user", near, None), said]),  # and in both
        (5, [("system", far, None), user, said]),  # one segment differs altogether
        (6, [user, said]), (7, [user, ("assistant", "No.", None)]), (8, [user, said]),
        (9, [("user", " \t", None), said]), (10, [("user", " ", None), said]), (11, None), (12, []), (13, [("user", None, None), said]), (14, [(None, None, None), user, said]),
        (15, [("user", words, "why"), said]),  # another shape
    ]
    df = spark.createDataFrame(rows, "record long, messages array<struct<role string, content string, reasoning string>>")
    got = {(x["kind"].split("_")[0] + "_" + x["kind"].split("_")[-1], x["a"], x["b"], x["differing"]) for x in prompts.prompt_edges(df).collect()}
    assert got == {
        ("exact_prompt", 1, 2, None), ("exact_prompt", 6, 7, None), ("exact_prompt", 6, 8, None), ("exact_example", 6, 8, None),
        ("lexical_prompt", 1, 3, 1), ("lexical_prompt", 1, 4, 2), ("lexical_prompt", 3, 4, 1),
    }
    assert prompts.prompt_edges(df.limit(0)).count() == 0
    items = spark.createDataFrame([(1, words.upper()), (2, " "), (3, None)], "item_id long, text string")
    assert {(x["record"], x["item_id"]) for x in prompts.item_prompts(df, items).collect()} == {(6, 1), (7, 1), (8, 1)}


def test_contracts(spark):
    from tracesieve.operators import contracts

    names = "answer_policy string, execution_policy string, kind string, oracle string, expected string, has_numeric boolean, required_tests array<string>, suite_cases array<string>, want string"
    ok = ["authoritative", "absent", "set_match", "literal", "x", False, None, None, None]
    rows = [
        ok,
        [None, *ok[1:8], "no_answer_policy"],
        ["absent", None, *ok[2:8], "no_execution_policy"],
        ["absent", "authoritative", "none", "coding_suite", None, False, ["a"], ["a", "b"], "inexact_suite"],
        ["absent", "authoritative", "none", "coding_suite", None, False, ["a"], ["a"], None],
        ["authoritative", "absent", "numeric_match", "literal", "1e3", False, None, None, "numeric_missing"],
        ["authoritative", "absent", "numeric_match", "literal", "ten", True, None, None, "numeric_expected"],
        ["authoritative", "absent", "numeric_match", "literal", "1e3", True, None, None, None],
        [*ok[:5], True, None, None, "numeric_unused"],
        ["advisory", "absent", "none", "literal", "x", False, None, None, "unsupported_comparator"],
        ["advisory", "absent", "refusal_expected", "refusal_policy", None, False, None, None, None],
        ["absent", "authoritative", "none", "none", None, False, [], None, "no_tests"],
        ["absent", "advisory", "none", "none", None, False, ["a", " "], None, "test_names"],
        ["absent", "advisory", "none", "none", None, False, ["a", "a"], None, "test_names"],
    ]
    got = spark.createDataFrame([tuple(r) for r in rows], names).withColumn("got", contracts.contract_fault()).collect()
    assert all(r["got"] == r["want"] for r in got), [r for r in got if r["got"] != r["want"]]


def test_preference_pairs(spark):
    from tracesieve.operators import preference

    kind = "id long, messages array<struct<role string, content string, reasoning string, details array<struct<kind string, index int, text string>>, name string, tools boolean>>, tools boolean"
    m = lambda role, content, reasoning=None, details=None, name=None, tools=False: (role, content, reasoning, details, name, tools)
    ask = m("user", "Why?")
    convs = {
        1: [ask, m("assistant", "So.", "ab", [("text", 0, "a"), ("text", 3, "b")])], 2: [ask, m("assistant", "No.")], 3: [ask, m("assistant", "So.", "other")], 4: [m("user", "Why"), m("assistant", "No.")], 5: None, 6: [],
        7: [ask], 8: [m("assistant", "x")], 9: [ask, m("assistant", " ")], 10: [ask, m("assistant", "x", None, [("text", 0, "a")])], 11: [ask, m("assistant", "x", "ab", [("text", 1, "a"), ("text", 1, "b")])],
        12: [ask, m("assistant", "x", "a", [("summary", 1, "a")])], 13: [ask, m("assistant", "x", "ab", [("text", 1, "a")])], 14: [m("user", "Why?", "hm"), m("assistant", "x")], 15: [m("user", None), m("assistant", "x")], 16: [ask, m("assistant", "x", tools=True)], 17: [ask, m("assistant", "<|im_end|>")],
    }
    df = spark.createDataFrame([(i, x, i == 2 and None) for i, x in convs.items()], kind)
    want = {2: None, 1: "same_completion", 3: None, 4: "other_prefix", 5: "rejected:empty", 6: "rejected:empty", 7: "rejected:not_terminal", 8: "rejected:not_terminal", 9: "rejected:blank_completion", 10: "rejected:details_alone", 11: "rejected:details_order", 12: "rejected:details_not_plain", 13: "rejected:details_differ", 14: "rejected:reasoning_of_another", 15: "rejected:not_plain_text", 16: "rejected:tools", 17: "rejected:control_token", 99: "rejected:missing"}
    pairs = spark.createDataFrame([(1, i) for i in want], "chosen_id long, rejected_id long")
    assert {r["rejected_id"]: r["fault"] for r in preference.projected_pairs(pairs, df).collect()} == want
    stripped = {r["rejected_id"]: r for r in preference.projected_pairs(pairs, df, "stripped").collect()}
    assert stripped[3]["fault"] == "same_completion" and stripped[2]["chosen"]["reasoning"] is None and stripped[2]["prompt"][0]["content"] == "Why?"
    assert {r["fault"] for r in preference.projected_pairs(pairs, df, "masked").collect()} == {"masked"}
