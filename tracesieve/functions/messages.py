"""Renderers and checks of a conversation: an array of struct(role, content, reasoning)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracesieve.functions.text import first_control_token


def _joined(messages: Column, one) -> Column:
    return F.array_join(F.transform(messages, one), "")


def _reasoning(m: Column, keep: bool) -> Column:
    return m["reasoning"] if keep else F.lit(None).cast("string")


def _as_system(role: Column) -> Column:
    return F.when(role == "developer", "system").otherwise(role)


def chatml(messages: Column, reasoning: bool = True) -> Column:
    def one(m: Column) -> Column:
        thought = F.when((m["role"] == "assistant") & _reasoning(m, reasoning).isNotNull(), F.concat(F.lit("<think>"), _reasoning(m, reasoning), F.lit("</think>"))).otherwise("")
        return F.concat(F.lit("<|im_start|>"), _as_system(m["role"]), F.lit("\n"), thought, F.coalesce(m["content"], F.lit("")), F.lit("<|im_end|>\n"))

    return _joined(messages, one)


def harmony(messages: Column, reasoning: bool = True) -> Column:
    def one(m: Column) -> Column:
        text = F.coalesce(m["content"], F.lit(""))
        thought = F.when(_reasoning(m, reasoning).isNotNull(), F.concat(F.lit("<|start|>assistant<|channel|>analysis<|message|>"), _reasoning(m, reasoning), F.lit("<|end|>"))).otherwise("")
        answer = F.concat(thought, F.lit("<|start|>assistant<|channel|>final<|message|>"), text, F.lit("<|return|>"))
        return F.when(m["role"] == "assistant", answer).otherwise(F.concat(F.lit("<|start|>"), m["role"], F.lit("<|message|>"), text, F.lit("<|end|>")))

    return _joined(messages, one)


def sharegpt(messages: Column, reasoning: bool = True) -> Column:
    """JSON; a turn has reasoning only if it is an assistant's that has one."""
    names = F.create_map(*(F.lit(x) for x in ("system", "system", "developer", "system", "user", "human", "assistant", "gpt", "tool", "tool")))
    turns = F.transform(
        messages,
        lambda m: F.struct(
            names[m["role"]].alias("from"),
            F.coalesce(m["content"], F.lit("")).alias("value"),
            F.when(m["role"] == "assistant", _reasoning(m, reasoning)).alias("reasoning"),
        ),
    )
    return F.to_json(F.struct(turns.alias("conversations")))


def openai(messages: Column, reasoning: bool = True) -> Column:
    turns = F.transform(
        messages,
        lambda m: F.struct(
            m["role"].alias("role"),
            F.coalesce(m["content"], F.lit("")).alias("content"),
            F.when(m["role"] == "assistant", _reasoning(m, reasoning)).alias("reasoning"),
        ),
    )
    return F.to_json(F.struct(turns.alias("messages")))


def prompt_completion(messages: Column, reasoning: bool = True) -> Column:
    """JSON; null unless the last turn is an assistant's."""

    def part(x: Column) -> Column:
        return F.transform(x, lambda m: F.struct(m["role"].alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"), F.when(m["role"] == "assistant", _reasoning(m, reasoning)).alias("reasoning")))

    ends = F.element_at(messages, -1)["role"] == "assistant"
    whole = F.struct(part(F.slice(messages, 1, F.size(messages) - 1)).alias("prompt"), part(F.slice(messages, -1, 1)).alias("completion"))
    return F.when(ends, F.to_json(whole))


def gemma(messages: Column, reasoning: bool = True) -> Column:
    """System text goes, after a blank line, before the next user turn, or at the end becomes one."""

    def turn(role: str, text: Column, thought: Column | None = None) -> Column:
        inner = [] if thought is None else [F.lit("<|channel>thought\n"), F.coalesce(F.concat(thought, F.lit("\n")), F.lit("")), F.lit("<channel|>")]
        return F.concat(F.lit(f"<|turn>{role}\n"), *inner, text, F.lit("<turn|>\n"))

    def step(state: Column, m: Column) -> Column:
        text, held = F.coalesce(m["content"], F.lit("")), state["held"]
        system = m["role"].isin("system", "developer")
        more = F.coalesce(F.concat(held, F.lit("\n\n"), text), text)
        flushed = F.when(system, "").when(m["role"] == "assistant", turn("model", text, _reasoning(m, reasoning))).otherwise(turn("user", more))
        keeps = F.when(system, more).when(m["role"] == "assistant", held)
        return F.struct(F.concat(state["out"], flushed).alias("out"), keeps.alias("held"))

    start = F.struct(F.lit("<bos>").alias("out"), F.lit(None).cast("string").alias("held"))
    return F.aggregate(messages, start, step, lambda s: F.concat(s["out"], F.coalesce(turn("user", s["held"]), F.lit(""))))


def first_leak(messages: Column) -> Column:
    """struct(role, token): the first control token, message by message, content before reasoning."""
    found = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), F.coalesce(first_control_token(m["content"]), first_control_token(m["reasoning"])).alias("token")))
    return F.try_element_at(F.filter(found, lambda x: x["token"].isNotNull()), F.lit(1))


def alternates(messages: Column) -> Column:
    """Whether, after a system turn if there is one, user and assistant take turns, the user first
    and the assistant last."""
    body = F.when(F.element_at(messages, 1)["role"] == "system", F.slice(messages, 2, F.size(messages))).otherwise(messages)
    want = F.transform(body, lambda m, i: m["role"] == F.when(i % 2 == 0, "user").otherwise("assistant"))
    return (F.size(body) > 0) & F.forall(want, lambda x: x) & (F.size(body) % 2 == 0)


def sft_units(messages: Column) -> Column:
    """array of struct(target, prompt, completion): one for each assistant turn, with all before it."""
    places = F.filter(F.sequence(F.lit(1), F.size(messages)), lambda i: F.element_at(messages, i)["role"] == "assistant")
    return F.transform(places, lambda i: F.struct(i.alias("target"), F.slice(messages, 1, i - 1).alias("prompt"), F.element_at(messages, i).alias("completion")))


def tool_signals(messages: Column) -> Column:
    """struct(first, signals): place of the first message with a tool signal (tool_calls,
    tool_call_id or a tool's role) and all signals in the order of meeting; null if there is none."""
    present = lambda m: F.array_compact(F.array(F.when(m["tool_calls"].isNotNull(), "tool_calls"), F.when(m["tool_call_id"].isNotNull(), "tool_call_id"), F.when(m["role"] == "tool", "tool_role")))
    each = F.transform(messages, lambda m, i: F.struct(i.alias("at"), present(m).alias("s")))
    some = F.filter(each, lambda x: F.size(x["s"]) > 0)
    return F.when(F.size(some) > 0, F.struct(F.get(some, F.lit(0))["at"].alias("first"), F.array_distinct(F.flatten(some["s"])).alias("signals")))


# The targets that keep tool signals.
TOOL_TARGETS = ("openai_messages", "prompt_completion")


def render_issue(messages: Column, target: Column) -> Column:
    """Why a conversation can't be rendered for a target: control_token first, then
    unsupported_tools; null if it can."""
    return F.when(first_leak(messages).isNotNull(), "control_token").when(~target.isin(*TOOL_TARGETS) & tool_signals(messages).isNotNull(), "unsupported_tools")
