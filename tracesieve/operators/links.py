"""Links of tool results to calls, and what execution reports prove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def result_links(calls: DataFrame, results: DataFrame) -> DataFrame:
    """record, pos, link of each result (record, pos, call_id, name) among the calls (record, pos, call_id, name)
    of its record: ok, or why it isn't linked.

    By id: duplicate_call (two calls have the id), unknown_call, before_call (declared at its place or later),
    second_result. Without an id, by name: unknown_name, call_without_id, before_call, ambiguous_name. Nothing
    is guessed; a call without a result is none of this."""
    by_id = calls.filter("call_id is not null").groupBy("record", "call_id").agg(F.min("pos").alias("declared"), F.count(F.lit(1)).alias("calls"))
    by_name = calls.groupBy("record", "name").agg(F.min("pos").alias("named"), F.count(F.lit(1)).alias("same"), F.count("call_id").alias("with_id"))
    again = F.row_number().over(Window.partitionBy("record", "call_id").orderBy("pos")) > 1
    x = results.select("record", "pos", "call_id", F.coalesce("name", F.lit("")).alias("name")).withColumn("again", again)
    x = x.join(by_id, ["record", "call_id"], "left").join(by_name, ["record", "name"], "left")
    explicit = F.when(F.col("calls").isNull(), "unknown_call").when(F.col("calls") > 1, "duplicate_call").when(F.col("declared") >= F.col("pos"), "before_call").when(F.col("again"), "second_result")
    implicit = F.when(F.col("same").isNull(), "unknown_name").when(F.col("same") > 1, "ambiguous_name").when(F.col("with_id") == 0, "call_without_id").when(F.col("named") >= F.col("pos"), "before_call")
    link = F.coalesce(F.when(F.col("call_id").isNotNull(), explicit).otherwise(implicit), F.lit("ok"))
    return x.select("record", "pos", link.alias("link"))


def record_links(calls: DataFrame, results: DataFrame) -> DataFrame:
    """record, fault, pos for every record with calls or results: duplicate_call if two of its calls share an id,
    whatever answers them; else the first result that isn't linked and where it stands; else null."""
    shared = calls.filter("call_id is not null").groupBy("record", "call_id").agg(F.count(F.lit(1)).alias("n")).groupBy("record").agg(F.max("n").alias("n"))
    bad = result_links(calls, results).filter("link <> 'ok'").groupBy("record").agg(F.min(F.struct("pos", "link")).alias("first"))
    every = calls.select("record").union(results.select("record")).distinct()
    twice = F.coalesce(F.col("n") > 1, F.lit(False))
    x = every.join(shared, "record", "left").join(bad, "record", "left")
    return x.select("record", F.when(twice, "duplicate_call").otherwise(F.col("first.link")).alias("fault"), F.when(~twice, F.col("first.pos")).alias("pos"))


def _conservative(a: Column, b: Column) -> Column:
    """unknown before failed before passed."""
    return F.when((a == "unknown") | (b == "unknown"), "unknown").when((a == "failed") | (b == "failed"), "failed").otherwise("passed")


def execution_verdicts(reports: DataFrame, cases: DataFrame, required: DataFrame) -> DataFrame:
    """record, verdict, reason of the candidates' reports.

    reports: record, its own task, attempt and patch, those that the report is bound to (bound_task, bound_attempt,
    bound_patch; all null: no report), outcome, exit_code, errors; cases: record, node, status (passed, failed, skipped); required:
    record, node, as the task declares them. A report of another task or attempt has failed; one of an older patch is stale and proves
    nothing. Else the more conservative of what it says and of what its detail shows: nothing without required nodes, exit code or cases,
    or with a node told twice; failed with errors, another exit code than 0, a failed node or a required one that didn't pass."""
    seen = cases.groupBy("record").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("node").alias("nodes"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "passed").alias("passed")
    )
    good = cases.filter("status = 'passed'").select("record", "node").distinct().withColumn("good", F.lit(1))
    asked = required.select("record", "node").distinct().join(good, ["record", "node"], "left").groupBy("record").agg(F.count(F.lit(1)).alias("asked"), F.count("good").alias("met"))
    x = reports.join(seen, "record", "left").join(asked, "record", "left").fillna(0, ["n", "nodes", "failed", "passed", "asked", "met", "errors"])
    detail = (
        F.when((F.col("asked") == 0) | F.col("exit_code").isNull(), "unknown")
        .when(F.col("errors") > 0, "failed")
        .when((F.col("n") == 0) | (F.col("nodes") < F.col("n")), "unknown")
        .when((F.col("exit_code") != 0) | (F.col("failed") > 0) | (F.col("met") < F.col("asked")), "failed")
        .when(F.col("passed") == 0, "unknown")
        .otherwise("passed")
    )
    missing = F.col("bound_task").isNull() & F.col("bound_attempt").isNull() & F.col("bound_patch").isNull()
    other = ~F.col("bound_task").eqNullSafe(F.col("task")) | ~F.col("bound_attempt").eqNullSafe(F.col("attempt"))
    stale = ~F.col("bound_patch").eqNullSafe(F.col("patch"))
    told = F.when(F.col("outcome").isin("passed", "failed"), F.col("outcome")).otherwise("unknown")
    verdict = F.when(missing, "unknown").when(other, "failed").when(stale, "unknown").otherwise(_conservative(told, detail))
    reason = F.when(missing, "missing").when(other, "other_candidate").when(stale, "stale").otherwise(F.concat(F.lit("report_"), verdict))
    return x.select("record", verdict.alias("verdict"), reason.alias("reason"))
