"""Seams to what runs elsewhere (providers, embedders, sandboxes, catalogues): recorded answers
are joined, what lacks one goes to an injected function of DataFrames, and states are folds of
appended rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracesieve.functions import json as J
from tracesieve.functions import text as T
from tracesieve.functions.text import once
from tracesieve.operators import sequences
from tracesieve.sources.tables import cut

Answer = Callable[[DataFrame], DataFrame]


def answered(requests: DataFrame, recorded: DataFrame, keys: list[str], value: str, ask: Answer | None = None) -> DataFrame:
    """Each request with `value` and `origin`: recorded, fresh or unavailable. `recorded` has a row
    a key (see latest); `ask` gets the keys without one, each once, and returns keys and value.
    Nothing is called where none is given."""
    answers = recorded.select(*keys, F.col(value), F.lit("recorded").alias("origin"))
    if ask is not None:
        missing = requests.join(recorded, keys, "left_anti").dropDuplicates(keys)
        answers = answers.unionByName(ask(missing).select(*keys, F.col(value), F.lit("fresh").alias("origin")))
    return requests.join(answers, keys, "left").withColumn("origin", F.coalesce("origin", F.lit("unavailable")))


def latest(log: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key of an append-only log; combines before the shuffle."""
    rest = [c for c in log.columns if c not in (*keys, order)]
    return log.groupBy(*keys).agg(F.max_by(F.struct(order, *rest), order).alias("x")).select(*keys, "x.*")


def chosen(areas: DataFrame, teachers: DataFrame, fallback: str) -> DataFrame:
    """The teacher of each training area (area, teacher): its own, or the fallback."""
    return areas.join(teachers, "area", "left").withColumn("teacher", F.coalesce("teacher", F.lit(fallback)))


def run_states(runs: DataFrame, updates: DataFrame) -> DataFrame:
    """The status of each run: halted until an update comes; updates of unknown runs do nothing."""
    last = latest(updates.select("run_id", "at", "status"), ["run_id"], "at").drop("at")
    return runs.join(last, "run_id", "left").withColumn("status", F.coalesce("status", F.lit("halted")))


def catalogue_problems(members: DataFrame, expected: int) -> DataFrame:
    """(problem, subject) of a reference catalogue (member_id, family, component, split): another
    number of members than expected, ids that repeat, families or components in several splits."""
    crossing = lambda c: members.groupBy(F.col(c).alias("subject")).agg(F.min("split").alias("a"), F.max("split").alias("b")).filter("a != b").select(F.lit(f"{c}_crosses_splits").alias("problem"), F.col("subject").cast("string"))
    size = members.agg(F.count("*").alias("n")).filter(F.col("n") != expected).select(F.lit("member_count").alias("problem"), F.col("n").cast("string").alias("subject"))
    repeated = members.groupBy("member_id").count().filter("count > 1").select(F.lit("duplicate_member").alias("problem"), F.col("member_id").cast("string").alias("subject"))
    return size.unionAll(repeated).unionAll(crossing("family")).unionAll(crossing("component"))


def imported(registered: DataFrame, observed: DataFrame) -> DataFrame:
    """Each registered member (member_id, digest) against what was observed of it: match,
    digest_mismatch, missing, or unregistered. An import commits only if all match."""
    both = registered.join(observed.select("member_id", F.col("digest").alias("seen")), "member_id", "full")
    status = F.when(F.col("digest").isNull(), "unregistered").when(F.col("seen").isNull(), "missing").when(F.col("digest") != F.col("seen"), "digest_mismatch").otherwise("match")
    return both.select("member_id", status.alias("status"))


def artifact_rows(rows: DataFrame) -> DataFrame:
    """What is wrong with each row (artifact_id, place, record_id, row_id, body) of published
    artifacts: artifact_id, place, record_id, problem. It is body (its JSON isn't canonical), identity
    (row_id isn't its digest) or order (record ids don't rise strictly by place); null if nothing is. Bodies
    are judged once, where they are read, so that only numbers are put in order; a large artifact isn't one task."""
    made = T.framed_digest(F.lit("row-v5"), F.col("record_id").cast("string"), F.col("body"))
    own = F.when(~J.canonical(F.col("body")).eqNullSafe(F.col("body")), "body").when(~made.eqNullSafe(F.col("row_id")), "identity")
    narrow = rows.select("artifact_id", F.col("place").alias("at"), "record_id", own.alias("own"))
    x = sequences.in_order(cut(narrow), ["artifact_id"], ["at"], ["at", "record_id"])
    falls = F.col("before.at").isNotNull() & (F.col("before.record_id") >= F.col("record_id"))
    return x.select("artifact_id", F.col("at").alias("place"), "record_id", F.coalesce("own", F.when(falls, "order")).alias("problem"))


# What the identity of a repository task covers.
TASK_FIELDS = ("source", "problem", "repository", "upstream_base", "actor_baseline", "environment", "private_contract")


def episode_identities(x: Column) -> Column:
    """struct(task, candidate, capture): digests of a repository episode, a JSON text. The task's
    leaves out label, rights, group and split; changes count in the order of their paths. Task
    and candidate are null while one of their parts is missing."""
    # each step stands once: an expression that is used again is evaluated again
    return once(F.struct(F.try_parse_json(x).alias("v")), lambda p: once(_episode_parts(p["v"]), _episode_digests))


def _episode_parts(v: Column) -> Column:
    """struct(task, rest, changes, whole): the parts of a parsed episode, as JSON texts."""
    part = lambda path: F.to_json(F.try_variant_get(v, path, "variant"))
    changes = F.try_variant_get(v, "$.candidate.delta.changes", "array<variant>")
    ordered = F.array_sort(F.transform(changes, lambda c: F.struct(F.try_variant_get(c, "$.path", "string").alias("path"), F.to_json(c).alias("json"))))
    return F.struct(
        F.array(*(part(f"$.task.{f}") for f in TASK_FIELDS)).alias("task"), F.array(*(part(f"$.candidate.{f}") for f in ("attempt", "messages", "tools"))).alias("rest"),
        F.transform(ordered, lambda c: c["json"]).alias("changes"), F.to_json(v).alias("whole"),
    )


def _episode_digests(p: Column) -> Column:
    def whole(name: str, parts: Column, n: int) -> Column:
        return F.when(F.size(F.array_compact(parts)) == n, T.framed_digest(F.lit(name), *(parts[k] for k in range(n))))

    def told(task: Column) -> Column:
        candidate = once(F.concat(F.array(task), p["rest"], F.array(F.array_join(p["changes"], ","))), lambda c: whole("repository-candidate-v1", c, 5))
        return F.struct(task.alias("task"), candidate.alias("candidate"), T.framed_digest(F.lit("repository-capture-v1"), p["whole"]).alias("capture"))

    return once(whole("repository-task-v1", p["task"], len(TASK_FIELDS)), told)


#: Plans of a predecessor chain at most.
CHAIN = 16


def revalidated(chain: DataFrame, records: DataFrame, group: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(version, status) of each plan of a predecessor chain, recomputed from the records of today:
    chain has (version, record_id, group_id) rows, records have record_id and what `group` needs to
    give (version, record_id, group_id) anew. ok, missing_member, altered, or too_deep beyond CHAIN
    plans from the newest. A chain holds many times its records: what is told of it is joined by sorting, never broadcast."""
    members = chain.select("version", "record_id").join(records.hint("merge"), "record_id")
    anew = group(members).select("version", "record_id", F.col("group_id").alias("anew"))
    held = chain.join(anew.hint("merge"), ["version", "record_id"], "left")
    per = held.groupBy("version").agg(F.count_if(F.col("anew").isNull()).alias("gone"), F.count_if(F.col("anew") != F.col("group_id")).alias("altered"))
    newest = chain.agg(F.max("version").alias("newest"))
    status = F.when(F.col("newest") - F.col("version") >= CHAIN, "too_deep").when(F.col("gone") > 0, "missing_member").when(F.col("altered") > 0, "altered").otherwise("ok")
    return per.join(F.broadcast(newest)).select("version", status.alias("status"))
