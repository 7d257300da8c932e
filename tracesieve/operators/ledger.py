"""Folds of event logs: lifecycle, attempts, spending, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: What an observation of an attempt may carry: counters, which only grow, and names, which don't change.
COUNTERS = ("prompt_tokens", "completion_tokens", "total_tokens", "reasoning_tokens")
NAMES = ("response_id", "model", "provider")


def latest(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The columns of each key's last row by order; aggregation, not a window, so that a hot key is
    combined before it is moved."""
    picked = rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r"))
    return picked.select(key, "r.*")


def tally(rows: DataFrame) -> DataFrame:
    """run_id, one count for each group of states."""
    s = F.col("state")
    return rows.groupBy("run_id").agg(
        F.count("*").alias("total"),
        F.count_if(s.isin("admitted", "formatted", "exported")).alias("admitted"),
        F.count_if(s == "rejected").alias("rejected"),
        F.count_if(s == "needs_review").alias("needs_review"),
        F.count_if(s == "errored").alias("errored"),
    )


def admit_rate(tallied: DataFrame) -> DataFrame:
    return tallied.select("run_id", F.try_divide(F.col("admitted").cast("double"), F.col("admitted") + F.col("rejected")).alias("admit_rate"))


def breaker(rows: DataFrame, key: str, trip: int) -> DataFrame:
    """key, tripped: whether `trip` failures in a row came before any success. Without a window:
    the first success, and the failures before it (all, if there is none)."""
    first = rows.groupBy(key).agg(F.min(F.when(~F.col("failed"), F.col("at"))).alias("first_success"))
    early = rows.join(first, key).filter(F.col("first_success").isNull() | (F.col("at") < F.col("first_success")))
    return first.join(early.groupBy(key).agg(F.count("*").alias("failures")), key, "left").select(key, (F.coalesce("failures", F.lit(0)) >= trip).alias("tripped"))


def accounting(receipts: DataFrame, key: str = "run_id") -> DataFrame:
    """Per run, from receipts (cost_state, cost_usd, conflicts and invalid_fields as joined names, COUNTERS,
    transport, elapsed_ms): attempts; known_usd, the sum of the known costs that are neither invalid nor in conflict, null if it
    overflows; how many costs are missing or invalid; conflicting and unresolved attempts; of each counter the known sum
    (null if it overflows), and how many attempts lack it or have it in conflict or invalid; elapsed_ms of settled attempts."""
    names = lambda c: F.split(F.coalesce(c, F.lit("")), ",")
    held = lambda c, name: F.array_contains(names(c), name)
    invalid = held("invalid_fields", "cost") | (F.col("cost_state") == "invalid")
    known = ~invalid & (F.col("cost_state") == "known") & ~held("conflicts", "cost_usd")
    usd = F.coalesce(F.sum(F.when(known, F.col("cost_usd"))), F.lit(0.0))
    counted = []
    for c in COUNTERS:
        bad = held("invalid_fields", c) | held("conflicts", c)
        total = F.sum(F.when(~bad, F.col(c)).cast("decimal(20,0)"))
        counted += [
            F.when(total.isNull(), F.lit(0)).when(total <= F.lit((1 << 63) - 1), total.cast("long")).alias(f"{c}_known"),
            F.count_if(~bad & F.col(c).isNull()).alias(f"{c}_missing"),
            F.count_if(bad).alias(f"{c}_invalid"),
        ]
    return receipts.groupBy(key).agg(
        F.count("*").alias("attempts"),
        F.when(F.abs(usd) < float("inf"), usd).alias("known_usd"),
        F.count_if(~invalid & (F.col("cost_state") == "missing")).alias("unknown_cost"),
        F.count_if(invalid).alias("invalid_cost"),
        F.count_if(F.coalesce("conflicts", F.lit("")) != "").alias("conflicting"),
        F.count_if(F.col("transport").isNull()).alias("unresolved"),
        *counted,
        F.coalesce(F.try_sum(F.when(F.col("transport").isNotNull(), F.col("elapsed_ms"))), F.lit(0)).alias("elapsed_ms"),
    )


def spend_gate(accounts: DataFrame, limit: float, live: Column | None = None) -> DataFrame:
    """accounts with admission: what the next attempt of the run gets."""
    live = F.lit(False) if live is None else live
    out = (
        F.when((F.col("unresolved") > 0) & live, "wait")
        .when(F.col("unresolved") > 0, "denied_unresolved")
        .when(F.col("known_usd").isNull() | (F.col("invalid_cost") > 0) | (F.col("conflicting") > 0), "denied_invalid")
        .when(F.col("unknown_cost") > 0, "denied_unknown")
        .when(F.col("known_usd") >= limit, "denied_limit")
        .otherwise("admitted")
    )
    return accounts.withColumn("admission", out)


def receipts(events: DataFrame) -> DataFrame:
    """attempt_id, observations, transport, conflict, tokens: a fold of intent, observe and settle
    events. Repeated equal settlements are one, differing ones a conflict; counters may only grow."""
    w = Window.partitionBy("attempt_id").orderBy("at", "event_id")
    seen = events.withColumn("before", F.max(F.when(F.col("kind") == "observe", F.col("tokens"))).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    shrinks = (F.col("kind") == "observe") & (F.col("tokens") < F.col("before"))
    return seen.groupBy("attempt_id").agg(
        F.count_if(F.col("kind") == "observe").alias("observations"),
        F.min(F.when(F.col("kind") == "settle", F.col("status"))).alias("transport"),
        (F.bool_or(shrinks) | (F.countDistinct(F.when(F.col("kind") == "settle", F.col("status"))) > 1)).alias("conflict"),
        F.max_by(F.when(F.col("kind") == "observe", F.col("tokens")), F.when(F.col("kind") == "observe", F.struct("at", "event_id"))).alias("tokens"),
    )


def attempt_ledger(events: DataFrame) -> DataFrame:
    """attempt_id, observations, transport, interpretation, cost_state, cost_usd, cost_invalid, conflicts,
    events and the merged COUNTERS and NAMES, from events (attempt_id, event_id, kind, sequence, status,
    cost_state, cost_usd, COUNTERS, NAMES) in the order of event_id.

    A repeated observation is none. One out of sequence (from 0) is kept, not merged, and a conflict; so is a counter or
    a known cost that falls and a name that changes, but the new value lands. A cost that isn't a finite number from 0 on is
    invalid, for good. The first settlement and the first interpretation stay; another one is a conflict."""
    cost = F.col("cost_usd")
    bad = (F.col("cost_state") == "known") & (cost.isNull() | F.isnan(cost) | (F.abs(cost) == float("inf")) | (cost < 0))
    observed = events.filter("kind = 'observe'").withColumn("cost_state", F.when(bad, "invalid").otherwise(F.col("cost_state")))
    observed = observed.withColumn("cost_usd", F.when(F.col("cost_state") == "known", cost))
    same = ["attempt_id", "sequence", "cost_state", "cost_usd", *COUNTERS, *NAMES]
    observed = observed.groupBy(*same).agg(F.min("event_id").alias("event_id"))
    before = Window.partitionBy("attempt_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = observed.withColumn("merged", F.col("sequence") == F.coalesce(F.max("sequence").over(before) + 1, F.lit(0)))
    told = lambda c: F.when(F.col("merged"), F.col(c))
    paid = F.when(F.col("merged") & (F.col("cost_state") != "missing"), F.struct("cost_state", "cost_usd"))
    last = lambda c: F.last(c, True).over(before)
    rows = rows.withColumns({**{f"{c}_": last(told(c)) for c in COUNTERS + NAMES}, "paid": paid, "paid_": last(paid)})
    faults = [F.when(~F.col("merged"), "observation_sequence")]
    faults += [F.when(told(c) < F.col(f"{c}_"), c) for c in COUNTERS]
    faults += [F.when(told(c) != F.col(f"{c}_"), c) for c in NAMES]
    faults.append(F.when((F.col("paid.cost_state") == "known") & (F.col("paid_.cost_state") == "known") & (F.col("paid.cost_usd") < F.col("paid_.cost_usd")), "cost_usd"))
    merged = rows.groupBy("attempt_id").agg(
        F.count(F.lit(1)).alias("observations"),
        F.max_by("paid", F.when(F.col("paid").isNotNull(), F.col("event_id"))).alias("paid"),
        F.bool_or(F.coalesce(F.col("paid.cost_state") == "invalid", F.lit(False))).alias("cost_invalid"),
        F.flatten(F.collect_set(F.array_compact(F.array(*faults)))).alias("faults"),
        *(F.max_by(c, F.when(F.col("merged") & F.col(c).isNotNull(), F.col("event_id"))).alias(c) for c in COUNTERS + NAMES),
    )
    ends = {"transport": "settle", "interpretation": "interpret"}
    status = {n: F.when(F.col("kind") == k, F.col("status")) for n, k in ends.items()}
    settled = events.groupBy("attempt_id").agg(
        F.count(F.lit(1)).alias("events"),
        *(F.min_by(s, F.when(s.isNotNull(), F.col("event_id"))).alias(n) for n, s in status.items()),
        *((F.countDistinct(s) > 1).alias(f"{n}_conflict") for n, s in status.items()),
    )
    x = settled.join(merged, "attempt_id", "left")
    more = F.array_compact(F.array(*(F.when(F.col(f"{n}_conflict"), F.lit(n)) for n in ends)))
    conflicts = F.array_sort(F.array_distinct(F.concat(F.coalesce("faults", F.array().cast("array<string>")), more)))
    return x.select(
        "attempt_id", F.coalesce("observations", F.lit(0)).alias("observations"), "transport", "interpretation", F.coalesce("paid.cost_state", F.lit("missing")).alias("cost_state"),
        F.col("paid.cost_usd").alias("cost_usd"), F.coalesce("cost_invalid", F.lit(False)).alias("cost_invalid"), F.array_join(conflicts, ",").alias("conflicts"), "events", *COUNTERS, *NAMES,
    )


def cache_lookup(requests: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """requests with the last value that the append log has for their key; null if none."""
    last = log.groupBy(*keys).agg(F.max_by("value", "at").alias("value"))
    return requests.join(last, keys, "left")


def backoff(i: Column, base_ms: int = 500, cap_ms: int = 30_000, hint_ms: Column | None = None) -> Column:
    own = F.least(F.lit(float(base_ms)) * F.pow(F.lit(2.0), i), F.lit(float(cap_ms)))
    return (own if hint_ms is None else F.coalesce(hint_ms.cast("double"), own)).cast("long")


def retry_budget(tokens: Column, cap: int = 32_000) -> Column:
    """Half as much again, rounded up, up to the cap; null at the cap or over it."""
    return F.when(tokens < cap, F.least(F.ceil(tokens * 1.5), F.lit(cap)).cast("long"))
