"""Folds that run over a batch or a stream: deltas, server-sent events, windows of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accumulated(deltas: DataFrame) -> DataFrame:
    """response_id, content, reasoning, finish from deltas (seq, piece, thought, finish): texts are
    joined in the order of seq, the last finish reason counts; reasoning is null if none came."""
    parts = F.array_sort(F.collect_list(F.struct("seq", "piece", "thought", "finish")))
    out = deltas.groupBy("response_id").agg(parts.alias("p"))
    thoughts = F.array_compact(F.transform("p", lambda x: x["thought"]))
    return out.select(
        "response_id",
        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("content"),
        F.when(F.size(thoughts) > 0, F.array_join(thoughts, "")).alias("reasoning"),
        F.try_element_at(F.array_compact(F.transform("p", lambda x: x["finish"])), F.lit(-1)).alias("finish"),
    )


_CHUNK = "choices array<struct<index int, delta struct<content string, reasoning string>>>, error string"


def parse_sse(chunks: DataFrame) -> DataFrame:
    """response_id, content, done, error from raw chunks (seq, chunk) of captured streams: comments
    are ignored, only choice 0 counts, and a stream without its end is a reset."""
    raw = chunks.groupBy("response_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "chunk"))), lambda x: x["chunk"]), "").alias("raw"))
    lines = F.filter(F.split("raw", "\r?\n"), lambda x: F.startswith(x, F.lit("data: ")))
    bodies = raw.select("response_id", F.transform(lines, lambda x: F.substring(x, 7, 1 << 30)).alias("b"))
    done = F.array_contains("b", "[DONE]")
    parsed = F.transform(F.filter("b", lambda x: x != "[DONE]"), lambda x: F.from_json(x, _CHUNK))
    text = F.transform(parsed, lambda c: F.array_join(F.transform(F.filter(c["choices"], lambda y: y["index"] == 0), lambda y: F.coalesce(y["delta"]["content"], F.lit(""))), ""))
    return bodies.select("response_id", F.array_join(text, "").alias("content"), done.alias("done"), F.when(~done, "reset").alias("error"))


def tumbling(events: DataFrame, size: str, late: str | None = None) -> DataFrame:
    """start, event_type, n, total in windows of event time; late: the watermark of a stream. This
    operator is our own."""
    rows = events if late is None else events.withWatermark("ts", late)
    out = rows.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def latest_states(events: DataFrame, sink: str, checkpoint: str):
    """A running query that keeps each record's last state in the Delta-less way: every micro-batch
    writes the states it has seen under its epoch; read_states takes the last of each record."""

    def write(batch: DataFrame, epoch: int) -> None:
        last = batch.groupBy("record_id").agg(F.max_by(F.struct("state", "event_id"), "event_id").alias("r")).select("record_id", "r.*")
        last.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")  # a retried epoch replaces itself

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_states(spark, sink: str) -> DataFrame:
    rows = spark.read.parquet(sink)
    return rows.groupBy("record_id").agg(F.max_by(F.struct("state", "event_id"), F.struct("event_id", "epoch")).alias("r")).select("record_id", "r.*")
