"""Record stores as tables: lookups, guarded changes, bounded logs, tasks and their splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracesieve.functions import text as T

# Benchmark sets that are always protected.
PROTECTED = ("gsm8k", "math_500", "aime_2024", "aime_2025", "mmlu", "mmlu_stem", "gpqa", "humaneval", "livecodebench", "ifeval")


def get(records: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """A row for each wanted key, with the record's columns and status: found or not_found."""
    marked = records.withColumn("status", F.lit("found"))
    return wanted.join(marked, key, "left").withColumn("status", F.coalesce("status", F.lit("not_found")))


def population(records: DataFrame, runs: DataFrame) -> DataFrame:
    """All records of the declared runs."""
    return records.join(runs, "run_id", "left_semi")


def decoded(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """lines with `row`, the text read by the schema, and `error` where it can't be read: a bad
    line is a row of its own and ends no scan."""
    read = F.from_json(column, f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    out = lines.withColumn("row", read)
    bad = F.col("row._bad").isNotNull() | F.col(column).isNull()
    return out.withColumn("error", F.when(bad, "malformed")).withColumn("row", F.when(~bad, F.col("row").dropFields("_bad")))


def record_id(run: Column, shard: Column, seed: Column, attempt: Column, place: Column) -> Column:
    return F.format_string("%s-s%d-seed%d-a%d-c%d", run, shard, seed, attempt, place)


def task_problems(tasks: DataFrame) -> DataFrame:
    """tasks (task_id, namespace, item, prompt, answer, group, split) with `problems`, joined: blank
    fields, answers that are no number, labels, sources or questions that repeat, and groups of
    more than one split."""
    many = lambda *keys: F.count("*").over(Window.partitionBy(*keys)) > 1
    splits = Window.partitionBy("group")
    blank = F.lit(False)
    for c in ("task_id", "namespace", "item", "prompt", "group", "split"):
        blank = blank | F.col(c).isNull() | (F.trim(c) == "")
    found = [
        F.when(blank, "blank_field"),
        F.when(T.parse_decimal(F.col("answer")).isNull(), "answer"),
        F.when(many("task_id"), "repeated_label"),
        F.when(many("namespace", "item"), "repeated_source"),
        F.when(many("prompt", "answer"), "repeated_question"),
        F.when(F.min("split").over(splits) != F.max("split").over(splits), "split_conflict"),
    ]
    return tasks.withColumn("problems", F.array_join(F.array_compact(F.array(*found)), ","))


def held_out(rows: DataFrame, split: str = "split") -> DataFrame:
    """rows with `rejection`: null for those to train on, else why not."""
    return rows.withColumn("rejection", F.when(F.col(split).isNull(), "no_split").when(F.col(split) != "train", F.concat(F.lit("held_out:"), split)))


def guarded(commands: DataFrame, current: DataFrame) -> DataFrame:
    """Outcome of every command (command_id, record_id, expected, placed) on the records' versions (record_id,
    version), in the order of (placed, command_id): already_applied if the record has committed that id before, not_found
    without a record, applied if the version is the expected one, which it raises by one, else conflict. Only what was applied
    is remembered. One record's commands depend on each other and are folded together, as one array of small rows."""
    rows = commands.select("command_id", "record_id", "expected", "placed").join(current.select("record_id", "version"), "record_id", "left")
    each = F.array_sort(F.collect_list(F.struct("placed", "command_id", F.col("expected").cast("long").alias("expected"))))
    of = rows.groupBy("record_id").agg(F.first("version").cast("long").alias("version"), each.alias("c"))
    told = "array<struct<command_id string, placed long, outcome string>>"
    zero = F.struct(F.col("version").alias("version"), F.array().cast("array<string>").alias("done"), F.array().cast(told).alias("told"))

    def step(a: Column, c: Column) -> Column:
        again = F.array_contains(a["done"], c["command_id"])
        fits = F.coalesce(a["version"] == c["expected"], F.lit(False)) & ~again
        outcome = F.when(again, "already_applied").when(a["version"].isNull(), "not_found").when(fits, "applied").otherwise("conflict")
        row = F.struct(c["command_id"].alias("command_id"), c["placed"].alias("placed"), outcome.alias("outcome"))
        return F.struct((a["version"] + fits.cast("int")).alias("version"), F.when(fits, F.array_append(a["done"], c["command_id"])).otherwise(a["done"]).alias("done"), F.array_append(a["told"], row).alias("told"))

    return of.select("record_id", F.inline(F.aggregate("c", zero, step)["told"])).select("command_id", "record_id", "placed", "outcome")


def bounded(events: DataFrame, window: Column, order: list[str], capacity: int) -> DataFrame:
    """Per window how many events a channel of that capacity takes, and how many it drops."""
    n = F.count("*")
    return events.groupBy(window.alias("window")).agg(F.least(n, F.lit(capacity)).alias("taken"), F.greatest(n - capacity, F.lit(0)).alias("dropped"))


def latest(events: DataFrame, order: list, most: int) -> DataFrame:
    """A log that keeps its last `most` lines."""
    return events.orderBy(*order).limit(most)


def protected(spark, additional: DataFrame) -> DataFrame:
    """The names of all protected sets, once each."""
    return spark.createDataFrame([(x,) for x in PROTECTED], "name string").union(additional).distinct()


def verifier_verdict(passed: Column, review: Column, advisory: Column) -> Column:
    """reject unless all passed; uncertain if held for review or an advisory fact didn't pass."""
    return F.when(~passed, "reject").when(review | advisory, "uncertain").otherwise("accept")


def preflight(reject_below: Column, accept: Column, least: Column, ratio: Column, judges: Column, rho: Column) -> Column:
    """What is wrong with a panel's settings; null if nothing is."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (
        F.when(bad(reject_below) | bad(accept) | (reject_below < 0) | (reject_below > accept) | (accept > 1), "bands")
        .when(bad(least) | (least < 0), "min_n_eff")
        .when(bad(ratio) | ~ratio.between(0, 1), "min_n_eff_ratio")
        .when(bad(rho) | ~rho.between(0, 1), "rho")
        .when((judges > 1) & (rho <= 0), "identity")
    )


def screening_status(incomplete: Column, matches: Column) -> Column:
    return F.when(incomplete > 0, "incomplete").when(matches == 0, "complete_no_match").otherwise("match_quarantined")


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of the two has, and which: empty if they are equal."""
    one = a.exceptAll(b).withColumn("only_in", F.lit("left"))
    return one.unionByName(b.exceptAll(a).withColumn("only_in", F.lit("right")))


def frame(payload: Column, source: Column, magic: str = "FRAME001") -> Column:
    """Magic, digest of the rest, lengths as 16 hexadecimal digits, payload and source, as binary."""
    length = lambda x: F.lpad(F.hex(F.octet_length(x)), 16, "0")
    body = F.concat(length(payload), length(source), payload, source)
    return F.concat(F.lit(magic).cast("binary"), F.unhex(F.sha2(body, 256)), body.cast("binary"))


def unframed(x: Column, magic: str = "FRAME001") -> Column:
    """struct(payload, source) of a frame; null if its magic, lengths or digest don't hold."""
    size = len(magic)
    body = F.substring(x, size + 33, 1 << 30)
    digits = lambda at: F.conv(F.substring(body, at, 16).cast("string"), 16, 10).cast("int")
    payload, source = digits(1), digits(17)
    whole = (F.substring(x, 1, size) == F.lit(magic).cast("binary")) & (F.octet_length(body) == payload + source + 32) & (F.hex(F.substring(x, size + 1, 32)) == F.upper(F.sha2(body, 256)))
    return F.when(whole, F.struct(F.substring(body, F.lit(33), payload).alias("payload"), F.substring(body, payload + 33, source).alias("source")))
