"""Keyed machines: batch against plain folds, streams against batch."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tracesieve.operators import ledger, lifecycle
from tracesieve.plans import machines as P
from tracesieve.streaming import machines as M

DIR = "/root/testdata/sf0.001"
START = datetime.datetime(2026, 1, 1)
EVENTS = "record_id long, at timestamp, event_id long, state string"
LIFE = ("state", "terminal", "steps", "attempts", "repeated", "illegal", "over_cap")


def made_events(seed, n=900):
    """Mostly steps forward, so that some records reach the cap; repeated, illegal and unknown ones between."""
    r, rows, at = random.Random(seed), [], {}
    forward = ["assistant_generated", "verified", "error", "seeded", "user_synthesized"]
    for e in range(n):
        k = r.choice([0, 0, 1, 2, 3])  # one record has far more than the others
        at[k] = at.get(k, START) + datetime.timedelta(minutes=r.choice([0, 1, 7, 45]))
        state = r.choice(forward) if r.random() < 0.8 else r.choice([*lifecycle.STATES, "published"])
        rows.append((k, at[k], e, state))
    return rows


def plain(rows):
    out = {}
    for k, _, _, state in sorted(rows, key=lambda x: (x[1], x[2])):
        out[k] = out.get(k, M.Life()).asked(state)
    return {k: (lifecycle.STATES[v.state], lifecycle.STATES[v.state] in lifecycle.TERMINAL, *v[1:]) for k, v in out.items()}


@pytest.mark.parametrize("span", ["1 minute", "2 hours", "400 days"])
def test_lifecycles_by_spans(spark, span):
    rows = made_events(1)
    want = plain(rows)
    assert any(v[2] == lifecycle.CAP and v[6] for v in want.values())
    got = {r["record_id"]: tuple(r[c] for c in LIFE) for r in lifecycle.lifecycles(spark.createDataFrame(rows, EVENTS).repartition(5), span).collect()}
    assert got == want


def test_lifecycles_of_odd_rows(spark):
    rows = [(None, START, 1, "assistant_generated"), (None, None, 2, "verified"), (1, START, 1, None), (1, START, 2, ""), (2, None, 5, "error"), (2, START, 1, "seeded"), (2, START, 1, "seeded")]
    got = {r["record_id"]: r.asDict() for r in lifecycle.lifecycles(spark.createDataFrame(rows, EVENTS)).collect()}
    assert (got[None]["state"], got[None]["illegal"]) == ("assistant_generated", 1)
    assert (got[1]["state"], got[1]["illegal"]) == ("seeded", 2)
    assert (got[2]["state"], got[2]["attempts"], got[2]["repeated"], got[2]["steps"]) == ("seeded", 1, 1, 2)
    assert lifecycle.lifecycles(spark.createDataFrame([], EVENTS)).count() == 0


def streamed(spark, tmp_path, batches, schema, start, run):
    """The rows that run makes of batches, each a micro-batch, restarted from its checkpoint before the last."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", M.PROVIDER)
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    for i, part in enumerate(batches):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        if i in (len(batches) - 2, len(batches) - 1):
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(source)
            q = run(stream).writeStream.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{sink}/epoch={n}")).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            assert q.awaitTermination(180)
    return spark.read.parquet(sink)


def test_lifecycle_stream_is_the_batch(spark, tmp_path):
    rows = made_events(2, 300)
    rows += rows[40:60]  # sent twice
    r = random.Random(7)
    order = sorted(rows, key=lambda x: x[1] + datetime.timedelta(minutes=r.uniform(0, 50)))  # late, by less than the delay
    last = max(x[1] for x in rows) + datetime.timedelta(days=1)
    parts = [order[:120], order[120:200], order[200:], [(99, last, 0, "error")], [(99, last, 1, "error")]]
    out = streamed(spark, tmp_path, parts, EVENTS, START, lambda s: M.lifecycle_stream(s, "3 hours"))
    ended = out.groupBy("record_id").agg(F.max_by(F.struct(*LIFE), "folded").alias("x")).filter("record_id <> 99").select("record_id", "x.*")
    got = {x["record_id"]: tuple(x[c] for c in LIFE) for x in ended.collect()}
    want = {x["record_id"]: tuple(x[c] for c in LIFE) for x in lifecycle.lifecycles(spark.createDataFrame(rows, EVENTS)).collect()}
    assert got == want == plain(rows)


def test_receipt_stream_is_the_batch(spark, tmp_path):
    events = P.receipt_events(spark, DIR).filter("attempt_id < 44")
    rows = [tuple(x) for x in events.orderBy("event_id").collect()]
    columns = ["observations", "transport", "interpretation", "cost_state", "cost_usd", "cost_invalid", "conflicts", "events", *ledger.COUNTERS, *ledger.NAMES]
    schema = events.schema
    out = streamed(spark, tmp_path, [rows[:100], rows[100:101], rows[101:300], rows[300:]], schema, START, M.receipt_stream)
    got = {x["attempt_id"]: tuple(x[c] for c in columns) for x in out.groupBy("attempt_id").agg(F.max_by(F.struct(*columns), "events").alias("x")).select("attempt_id", "x.*").collect()}
    want = {x["attempt_id"]: tuple(x[c] for c in columns) for x in ledger.attempt_ledger(events).collect()}
    assert got == want
    assert {c for v in want.values() for c in v[6].split(",")} >= {"observation_sequence", "prompt_tokens", "reasoning_tokens", "response_id", "model", "cost_usd", "transport", "interpretation"}
