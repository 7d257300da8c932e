"""The lifecycle of records as a checked machine: legal steps only, at most CAP of them.

An event asks for a state. It is repeated if the record is in it already, illegal if no step leads
there, over the cap if CAP steps were made, else a step. Events count in the order of (at, event_id).

What the events of a span of time do is a function of the state that they find: twelve answers,
whatever their number. So each (record, span) is folded by itself, for all twelve; the functions
are then chained, which tells the state that each span finds; and each is folded once more from
there. A record with a third of all events is as many small groups as it has spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracesieve.sources.tables import cut

# The states of a record, the steps between them, and the most steps of one record.
STATES = ("seeded", "user_synthesized", "assistant_generated", "verified", "judged", "admitted", "formatted", "exported", "rejected", "needs_review", "revising", "error")
STEPS = {
    "seeded": ("user_synthesized", "assistant_generated", "error"),
    "user_synthesized": ("assistant_generated", "error"),
    "assistant_generated": ("verified", "error"),
    "verified": ("judged", "error"),
    "judged": ("admitted", "rejected", "needs_review", "revising", "error"),
    "admitted": ("formatted", "error"),
    "formatted": ("exported", "error"),
    "error": ("seeded",),
}
CAP = 16
#: No automatic step leads on from these.
TERMINAL = ("exported", "formatted", "rejected", "needs_review", "error", "revising")

LEGAL = [[t in STEPS.get(s, ()) for t in STATES] for s in STATES]
_COUNTS = ("attempts", "repeated", "illegal", "over_cap")


def _legal(s: Column, t: Column) -> Column:
    table = F.array(*(F.array(*(F.lit(x) for x in row)) for row in LEGAL))
    return F.get(F.get(table, s), t)


def _step(a: Column, t: Column) -> Column:
    again, legal = a["state"] == t, _legal(a["state"], t)
    goes = ~again & legal & (a["steps"] < CAP)
    more = lambda name, on: (a[name] + on.cast("int")).alias(name)
    return F.struct(
        F.when(goes, t).otherwise(a["state"]).alias("state"),
        more("steps", goes),
        more("attempts", goes & (t == 0)),
        more("repeated", again),
        more("illegal", ~again & ~legal),
        more("over_cap", ~again & legal & ~goes),
    )


def lifecycles(events: DataFrame, span: str = "1 day", start: str = "seeded") -> DataFrame:
    """record_id, state, terminal, steps, attempts (returns to seeded), repeated, illegal, over_cap for
    events (record_id, at, event_id, state); a state of another name is illegal everywhere. Nulls:
    an event without a time comes first, one without a state is illegal."""
    code = F.coalesce(F.array_position(F.array(*(F.lit(s) for s in STATES)), F.col("state")).cast("int") - 1, F.lit(-1))
    rows = events.select("record_id", F.window("at", span)["start"].alias("span"), F.struct("at", "event_id", F.when(code < 0, len(STATES)).otherwise(code).alias("t")).alias("e"))
    # a row without a time has no window: it is the first span
    rows = rows.unionByName(events.filter("at is null").select("record_id", F.lit(None).cast("timestamp").alias("span"), F.struct("at", "event_id", F.when(code < 0, len(STATES)).otherwise(code).alias("t")).alias("e")))
    ordered = F.transform(F.array_sort(F.collect_list("e")), lambda e: e["t"])
    chunks = cut(rows.groupBy("record_id", "span").agg(ordered.alias("ts")))

    every = F.sequence(F.lit(0), F.lit(len(STATES) - 1))
    free = lambda a, t: F.when((a["s"] != t) & F.coalesce(_legal(a["s"], t), F.lit(False)), F.struct(t.alias("s"), (a["n"] + 1).alias("n"))).otherwise(a)
    ends = F.transform(every, lambda s: F.aggregate("ts", F.struct(s.alias("s"), F.lit(0).alias("n")), free))
    spans = F.array_sort(F.collect_list(F.struct("span", "ends")))
    kind = "struct<s int, n int, found array<struct<span timestamp, s int, n int>>>"
    zero = F.from_json(F.lit(f'{{"s":{STATES.index(start)},"n":0,"found":[]}}'), kind)

    def chained(a: Column, x: Column) -> Column:
        to = F.get(x["ends"], a["s"])
        found = F.array_append(a["found"], F.struct(x["span"].alias("span"), a["s"].alias("s"), a["n"].alias("n")))
        return F.struct(to["s"].alias("s"), (a["n"] + to["n"]).alias("n"), found.alias("found"))

    found = chunks.select("record_id", "span", ends.alias("ends")).groupBy("record_id").agg(spans.alias("x"))
    found = found.select("record_id", F.inline(F.aggregate("x", zero, chained)["found"]))
    both = chunks.alias("c").join(found.alias("f"), F.col("c.record_id").eqNullSafe(F.col("f.record_id")) & F.col("c.span").eqNullSafe(F.col("f.span")))
    both = both.select("c.record_id", "c.span", "ts", "s", "n")

    first = F.struct(F.col("s").alias("state"), F.col("n").alias("steps"), *(F.lit(0).alias(c) for c in _COUNTS))
    safe = lambda a, t: F.when(t < len(STATES), _step(a, t)).otherwise(F.struct(a["state"].alias("state"), a["steps"].alias("steps"), *((a[c] + int(c == "illegal")).alias(c) for c in _COUNTS)))
    folded = both.filter(F.col("n") <= CAP).select("record_id", "span", F.aggregate("ts", first, safe).alias("a"))
    out = folded.groupBy("record_id").agg(
        F.max_by("a", F.struct(F.col("span").isNotNull(), "span"))["state"].alias("s"), F.max("a.steps").alias("steps"), *(F.sum(f"a.{c}").alias(c) for c in _COUNTS)
    )
    # spans that begin after the last step: their events meet the state that stands
    rest = both.filter(F.col("n") > CAP).select(F.col("record_id").alias("id"), F.explode("ts").alias("t")).groupBy("id", "t").agg(F.count(F.lit(1)).alias("k"))
    rest = rest.join(out.select("record_id", "s"), F.col("id").eqNullSafe(F.col("record_id")))
    again, legal = F.col("t") == F.col("s"), F.coalesce(_legal(F.col("s"), F.col("t")), F.lit(False))
    kinds = {"repeated": again, "over_cap": ~again & legal, "illegal": ~again & ~legal}
    rest = rest.groupBy("id").agg(*(F.sum(F.when(on, F.col("k")).otherwise(0)).alias(f"more_{c}") for c, on in kinds.items()))
    x = out.join(rest, F.col("record_id").eqNullSafe(F.col("id")), "left")
    state = F.get(F.array(*(F.lit(s) for s in STATES)), F.col("s"))
    return x.select(
        "record_id", state.alias("state"), state.isin(*TERMINAL).alias("terminal"), F.col("steps").cast("long").alias("steps"), F.col("attempts"),
        *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("repeated", "illegal", "over_cap")),
    )
