"""The fold of a response's deltas into a turn, in the order in which they came.

Everything of a response is sorted once; what was before a row (the finish so far, the block that it
may go on) is told by windows over that order, and what fails first or last by the least or greatest
place. All of it is partitioned by the response, so that the deltas are moved once.

deltas: response_id, seq (distinct in a response), content, reasoning, details (array of struct kind,
index, text, signature), refusal, finish, native_finish, calls (array of struct index, kind, id, name,
arguments), served_by, model, generation_id, prompt_tokens, completion_tokens, reasoning_tokens, cost.
A null is an absent field; an empty array is a present one. Tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracesieve.functions import text as T

# What is said of a response that can't be used.
AFTER_FINISH, CONFLICTING_FINISH = "payload after terminal finish", "conflicting terminal reasons"
UNSUPPORTED_KIND, CONFLICTING_ID = "unsupported tool-call kind", "conflicting tool-call identity"
NO_CALLS, NO_FINISH = "tool_calls finish without calls", "tool calls lack a supported terminal finish"
NONCONTIGUOUS, NO_ID = "noncontiguous tool-call indices", "missing tool-call identity"
NO_NAME, MALFORMED, NO_OBJECT = "duplicate identity or missing function name", "incomplete or malformed tool arguments", "tool arguments must be an object"

_PAYLOAD = ("content", "reasoning", "details", "refusal", "calls")
_FIRST = ("served_by", "model", "generation_id", "prompt_tokens", "completion_tokens", "reasoning_tokens", "cost")


def _joined(value: str, *order: str) -> Column:
    parts = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(*order, value))))
    return F.array_join(F.transform(parts, lambda x: x[value]), "")


def _pick(f, value: str, at: Column) -> Column:
    return f(value, F.when(F.col(value).isNotNull(), at))


def json_kind(x: Column) -> Column:
    """object, other, or null if x isn't one whole JSON document. A parser may stop behind the first
    value of a text: it has to stand inside of brackets of both kinds, too."""
    boxed = [F.try_parse_json(F.concat(F.lit(a), x, F.lit(b))) for a, b in (("[", "]"), ('{"x":', "}"))]
    inner = F.schema_of_variant(F.try_variant_get(boxed[1], "$.x", "variant"))
    single = F.try_variant_get(boxed[0], "$[1]", "variant").isNull()
    return F.when(boxed[0].isNull() | boxed[1].isNull() | inner.isNull() | ~single, F.lit(None)).when(F.startswith(inner, F.lit("OBJECT")), "object").otherwise("other")


def detail_blocks(deltas: DataFrame) -> DataFrame:
    """response_id, place (from 0), kind, index, text, signature: fragments of one kind and index that
    follow each other are one block, with the signature of its first; encrypted ones stay apart."""
    rows = deltas.select("response_id", "seq", F.posexplode("details").alias("pos", "d")).select("response_id", "seq", "pos", "d.*")
    w = Window.partitionBy("response_id").orderBy("seq", "pos")
    goes_on = (F.lag("kind").over(w) == F.col("kind")) & F.lag("index").over(w).eqNullSafe(F.col("index")) & (F.col("kind") != "encrypted")
    runs = rows.withColumn("place", F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(w) - 1)
    first = F.struct("seq", "pos")
    return runs.groupBy("response_id", "place").agg(F.first("kind").alias("kind"), F.first("index").alias("index"), _joined("text", "seq", "pos").alias("text"), F.min_by("signature", first).alias("signature"))


def tool_calls(deltas: DataFrame) -> DataFrame:
    """response_id, index, id, name, arguments, sticky, error: the calls of each response, pieces joined
    in order. sticky: the last fault of its fragments; error: what is wrong with the call itself."""
    rows = deltas.select("response_id", "seq", F.posexplode("calls").alias("pos", "c")).select("response_id", "seq", "pos", "c.*")
    of_call = Window.partitionBy("response_id", "index").orderBy("seq", "pos")
    rows = rows.withColumn("first_id", F.first("id", True).over(of_call.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    fault = F.when(F.col("id") != F.col("first_id"), CONFLICTING_ID).when(F.col("kind") != "function", UNSUPPORTED_KIND)
    rows = rows.withColumn("fault", fault)
    at = F.struct("seq", "pos")
    calls = rows.groupBy("response_id", "index").agg(
        _pick(F.min_by, "id", at).alias("id"),
        _joined("name", "seq", "pos").alias("name"),
        _joined("arguments", "seq", "pos").alias("arguments"),
        F.max(F.when(F.col("fault").isNotNull(), F.struct("seq", "pos", "fault"))).alias("last"),
    )
    by_index = Window.partitionBy("response_id").orderBy("index")
    calls = calls.withColumns({"rank": F.row_number().over(by_index) - 1, "again": F.row_number().over(Window.partitionBy("response_id", "id").orderBy("index")) > 1})
    kind = json_kind(F.col("arguments"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    error = (
        F.when(F.col("rank") != F.col("index"), NONCONTIGUOUS).when(blank("id"), NO_ID).when(F.col("again") | blank("name"), NO_NAME).when(kind.isNull(), MALFORMED).when(kind != "object", NO_OBJECT)
    )
    return calls.select("response_id", "index", "id", "name", "arguments", F.col("last").alias("sticky"), error.alias("error"))


def turns(deltas: DataFrame) -> DataFrame:
    """response_id, outcome, detail and what the response says: content, reasoning, refusal, finish,
    n_calls, n_blocks and the first value of each field that rides on a chunk.

    outcome, the first that holds: invalid_completion (detail: the fault), truncated_reasoning (ends for its
    length while reasoning), empty_response, control_token (detail: the token), ok. A refusal is the content where
    there is none; content is null if none came but calls did."""
    w = Window.partitionBy("response_id").orderBy("seq")
    before = F.last("finish", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = deltas.withColumn("before", before)
    payload = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(True)) for c in _PAYLOAD), F.lit(False))
    fault = F.when(F.col("before").isNotNull() & payload, AFTER_FINISH).when(F.col("before") != F.col("finish"), CONFLICTING_FINISH)
    rows = rows.withColumn("fault", fault)
    seq = F.col("seq")
    said = rows.groupBy("response_id").agg(
        _joined("content", "seq").alias("content"),
        (F.count("content") > 0).alias("has_content"),
        _joined("reasoning", "seq").alias("reasoning"),
        _pick(F.max_by, "refusal", seq).alias("refusal"),
        _pick(F.max_by, "finish", seq).alias("finish"),
        _pick(F.max_by, "native_finish", seq).alias("native_finish"),
        _pick(F.min_by, "fault", seq).alias("fault"),
        *(_pick(F.min_by, c, seq).alias(c) for c in _FIRST),
    )
    calls = tool_calls(deltas).groupBy("response_id").agg(
        F.count(F.lit(1)).alias("n_calls"), F.max("sticky")["fault"].alias("sticky"), F.min_by("error", F.when(F.col("error").isNotNull(), F.col("index"))).alias("call_error")
    )
    blocks = detail_blocks(deltas).groupBy("response_id").agg(F.count(F.lit(1)).alias("n_blocks"))
    x = said.join(calls, "response_id", "left").join(blocks, "response_id", "left").fillna(0, ["n_calls", "n_blocks"])
    finish, some = F.col("finish"), F.col("n_calls") > 0
    ends_in_calls = F.coalesce(finish == "tool_calls", F.lit(False))
    call_error = F.coalesce("sticky", F.when(~some & ends_in_calls, NO_CALLS).when(some & ~ends_in_calls, NO_FINISH).when(some, F.col("call_error")))
    thought = (F.col("reasoning") != "") | (F.col("n_blocks") > 0)
    token = T.first_control_token(T.strip_channels(F.col("content"))["content"])
    x = x.withColumns({"call_error": call_error, "token": token})
    cut_off = F.coalesce(finish == "length", F.lit(False)) & thought
    empty = (F.col("content") == "") & ~thought & F.col("refusal").isNull() & ~some
    outcome = (
        F.when(F.col("fault").isNotNull(), "invalid_completion").when(cut_off, "truncated_reasoning").when(F.col("call_error").isNotNull(), "invalid_completion")
        .when(empty, "empty_response").when(F.col("token").isNotNull(), "control_token").otherwise("ok")
    )
    detail = F.when(outcome == "invalid_completion", F.coalesce("fault", "call_error")).when(outcome == "control_token", F.col("token"))
    content = F.when((F.col("content") == "") & F.col("refusal").isNotNull(), F.col("refusal")).when(~F.col("has_content") & some, F.lit(None)).otherwise(F.col("content"))
    reasoning = F.when(F.col("reasoning") != "", F.col("reasoning"))
    return x.select("response_id", outcome.alias("outcome"), detail.alias("detail"), content.alias("content"), reasoning.alias("reasoning"), "refusal", "finish", "native_finish", "n_calls", "n_blocks", *_FIRST)
