"""Pairs of a chosen and a rejected conversation, projected for training on preferences.

Messages: an array of struct(role, content, reasoning, details: array of struct(kind, index, text), name, tools).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracesieve.functions.text import first_control_token


def _first(faults: Column) -> Column:
    return F.try_element_at(F.array_compact(faults), F.lit(1))


def _details_fault(m: Column) -> Column:
    """Details can only repeat the flat reasoning: plain text, in rising order, together equal to it."""
    d = m["details"]
    each = F.transform(d, lambda x, i: F.when(x["kind"] != "text", "details_not_plain").when((i > 0) & (x["index"] <= F.get(d, i - 1)["index"]), "details_order"))
    joined = F.array_join(F.transform(d, lambda x: x["text"]), "")
    fault = F.when(m["reasoning"].isNull(), "details_alone").otherwise(F.coalesce(_first(each), F.when(joined != m["reasoning"], "details_differ")))
    return F.when(F.coalesce(F.size(d), F.lit(0)) > 0, fault)


def _message_fault(m: Column) -> Column:
    plain = F.when(m["content"].isNull() | m["name"].isNotNull(), "not_plain_text")
    owner = F.when((m["role"] != "assistant") & (m["reasoning"].isNotNull() | m["details"].isNotNull()), "reasoning_of_another")
    return F.coalesce(plain, _details_fault(m), owner)


def unsupported(messages: Column, tools: Column) -> Column:
    """Why a conversation can't be one side of a pair, the first reason; null if it can. tools: whether it
    declares tools. Null or no messages: empty."""
    last = F.try_element_at(messages, F.lit(-1))
    leaks = F.exists(messages, lambda m: first_control_token(F.concat_ws(" ", m["content"], m["reasoning"])).isNotNull())
    signals = F.exists(messages, lambda m: F.coalesce(m["tools"], F.lit(False)) | (m["role"] == "tool"))
    return (
        F.when(F.coalesce(leaks, F.lit(False)), "control_token")
        .when(tools | F.coalesce(signals, F.lit(False)), "tools")
        .otherwise(
            F.coalesce(
                _first(F.transform(messages, _message_fault)),
                F.when(F.coalesce(F.size(messages), F.lit(0)) == 0, "empty").when((last["role"] != "assistant") | (F.size(messages) < 2), "not_terminal").when(F.trim(last["content"]) == "", "blank_completion"),
            )
        )
    )


def _projected(m: Column, cot: str) -> Column:
    thought = F.lit(None).cast("string") if cot == "stripped" else F.when(m["reasoning"] != "", m["reasoning"])
    return F.struct(m["role"].alias("role"), m["content"].alias("content"), thought.alias("reasoning"))


def projected_pairs(pairs: DataFrame, conversations: DataFrame, cot: str = "kept") -> DataFrame:
    """chosen_id, rejected_id, fault, prompt, chosen, rejected of pairs (chosen_id, rejected_id) of conversations (id, messages,
    tools). The prompt is the whole original prefix, which both must share; the sides are the last turns under the reasoning policy (kept or
    stripped; masked isn't supported for pairs). fault: of the policy, of the chosen one, of the rejected one, other_prefix, same_completion,
    missing (an id without a conversation), in this order; null if the pair stands, and only then are there messages."""
    sides = [conversations.select(F.col("id").alias(f"{s}_id"), F.col("messages").alias(s), F.coalesce("tools", F.lit(False)).alias(f"{s}_tools"), F.lit(True).alias(f"{s}_there")) for s in ("chosen", "rejected")]
    x = pairs.select("chosen_id", "rejected_id").join(sides[0], "chosen_id", "left").join(sides[1], "rejected_id", "left")
    head = lambda s: F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0)))
    last = lambda s: F.try_element_at(F.col(s), F.lit(-1))
    side = lambda s: F.when(F.col(f"{s}_there").isNull(), "missing").otherwise(unsupported(F.col(s), F.col(f"{s}_tools")))
    named = lambda s: F.when(side(s).isNotNull(), F.concat(F.lit(f"{s}:"), side(s)))
    ends = [_projected(last(s), cot) for s in ("chosen", "rejected")]
    fault = F.coalesce(
        F.lit("masked" if cot == "masked" else None).cast("string"),
        named("chosen"),
        named("rejected"),
        F.when(F.to_json(head("chosen")) != F.to_json(head("rejected")), "other_prefix"),
        F.when(F.to_json(ends[0]) == F.to_json(ends[1]), "same_completion"),
    )
    x = x.withColumn("fault", fault)
    stands = F.col("fault").isNull()
    return x.select(
        "chosen_id", "rejected_id", "fault", F.when(stands, F.transform(head("chosen"), lambda m: _projected(m, cot))).alias("prompt"), F.when(stands, ends[0]).alias("chosen"), F.when(stands, ends[1]).alias("rejected")
    )
