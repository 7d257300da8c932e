"""Captured streams, trees of digests and artifacts."""

import json
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tracesieve.operators import merkle
from tracesieve.sources import artifacts, captures

TEXTS = {
    "plain": 'data: {"a":1}\n\ndata: {"b":"é日😀"}\r\n\r\n: keep-alive\nevent: x\nid: 3\ndata:\ndata: \r\ndata:{"c":2}  \ndata: [DONE]\ndata: after\n',
    "cut": 'data: one\ndata: tw',
    "open": 'data: one\r\n\r',
    "empty": "",
    "late": "\n" * 50 + "data:   [DONE]   ",
    "bad": b"data: \xff\xfe x\ndata: [DONE]\n",
}


def plain(data):
    out, place = [], 0
    for i, line in enumerate(parts := data.split(b"\n")):
        at, place = place, place + len(line) + 1
        if i == len(parts) - 1 and not line:
            break
        text = line.removesuffix(b"\r").decode("utf-8", "replace").rstrip()
        payload = text[5:].lstrip() if text.startswith("data:") else ""
        if payload == "[DONE]":
            return [*out, (at, "done", "")]
        if payload:
            out.append((at, "data", payload))
    return [*out, (len(data), "reset", "")]


def test_captures_as_a_batch(spark, tmp_path):
    spark.dataSource.register(captures.Captures)
    for n, t in TEXTS.items():
        (tmp_path / f"{n}.sse").write_bytes(t if isinstance(t, bytes) else t.encode())
    (tmp_path / "other.txt").write_text("data: no\n")
    got = {}
    for r in spark.read.format("captures").load(str(tmp_path)).orderBy("capture", "at").collect():
        got.setdefault(r["capture"], []).append((r["at"], r["kind"], r["payload"]))
    for r in got.values():
        r.sort(key=lambda x: (x[1] == "reset", x[0]))
    assert got == {n: plain(t if isinstance(t, bytes) else t.encode()) for n, t in TEXTS.items()}
    empty = tmp_path / "none"
    empty.mkdir()
    assert spark.read.format("captures").load(str(empty)).count() == 0


def test_any_cut_gives_the_same_rows(tmp_path, monkeypatch):
    r = random.Random(3)
    for size in (1, 3, 1 << 20):
        monkeypatch.setattr(captures, "_READ", size)
        for n, t in TEXTS.items():
            data = t if isinstance(t, bytes) else t.encode()
            path = tmp_path / f"{n}-{size}.sse"
            path.write_bytes(data)
            cuts = sorted({0, len(data), *(r.randint(0, len(data)) for _ in range(6))})
            ranges = [captures.Range(n, str(path), a, b, False) for a, b in zip(cuts, cuts[1:], strict=False)] + [captures.Range(n, str(path), len(data), len(data), True)]
            assert [x[1:] for p in ranges for x in captures.rows_of(p)] == plain(data), (n, cuts)


def test_captures_as_a_stream(spark, tmp_path):
    spark.dataSource.register(captures.Captures)
    folder, sink, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    r = random.Random(1)
    data = {n: t if isinstance(t, bytes) else t.encode() for n, t in TEXTS.items()}
    told = dict.fromkeys(data, 0)
    for step in range(5):  # each step is a new query that goes on from the checkpoint
        for n, d in data.items():
            upto = len(d) if step == 3 else r.randint(told[n], len(d))
            with (folder / f"{n}.sse").open("ab") as f:
                f.write(d[told[n] : upto])
            told[n] = upto
            if step == 4 and n != "open":
                (folder / f"{n}.end").write_text("")
        stream = spark.readStream.format("captures").load(str(folder))
        assert stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination(120)
    got = {}
    for x in spark.read.parquet(sink).collect():
        got.setdefault(x["capture"], []).append((x["at"], x["kind"], x["payload"]))
    want = {n: plain(d) for n, d in data.items()}
    want["open"] = want["open"][:-1]  # it may go on
    assert {n: sorted(v, key=lambda x: (x[1] == "reset", x[0])) for n, v in got.items()} == want


def test_tree(spark):
    rows = spark.range(1000).select(F.col("id").alias("record_id"), F.concat(F.lit("t"), "id").alias("text"))
    a = merkle.tree(rows, ["record_id"], 8)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    same = merkle.tree(rows.repartition(13), ["record_id"], 8)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert merkle.root(a) == merkle.root(same) and a.exceptAll(same).count() == 0
    assert [x[0] for x in a.groupBy("level").count().orderBy("level").select("count").collect()] == [1000, 125, 16, 2, 1]
    other = merkle.tree(rows.withColumn("text", F.when(F.col("record_id").isin(3, 777), "x").otherwise(F.col("text"))), ["record_id"], 8)
    assert merkle.root(other) != merkle.root(a)
    assert sorted(x["i"] for x in merkle.changed(a, other, 8).collect()) == [3, 777]
    assert merkle.changed(a, same, 8).count() == 0
    shorter = merkle.tree(rows.filter("record_id < 990"), ["record_id"], 8)
    assert sorted(x["i"] for x in merkle.changed(a, shorter, 8).collect()) == list(range(990, 1000))
    leaf = a.filter("level = 0 and i = 777").first()["digest"]
    path = merkle.proof(a, 777, 8)
    assert len(path) == 4 and merkle.proven(leaf, path, merkle.root(a))
    assert not merkle.proven(other.filter("level = 0 and i = 777").first()["digest"], path, merkle.root(a))
    none = merkle.tree(rows.limit(0), ["record_id"])
    assert merkle.root(none) is None and merkle.changed(none, none).count() == 0
    one = merkle.tree(rows.limit(1), ["record_id"])
    assert one.count() == 1 and merkle.proof(one, 0) == []


def test_artifacts(spark, tmp_path):
    rows = spark.range(200).select(F.format_string("r%03d", "id").alias("record_id"), (F.col("id") / 7).alias("score"), F.when(F.col("id") % 3 > 0, F.array(F.col("id"))).alias("ids"))
    folder = str(tmp_path / "a")
    about = artifacts.write_artifact(rows, folder, {"scope": "run1"})
    assert about["n_records"] == 200 and artifacts.verify_artifact(spark, folder) == []
    assert sorted(os.listdir(folder)) == sorted([artifacts.LIST, *(f["file"] for f in artifacts.listed(folder)["files"])])
    assert artifacts.write_artifact(rows.repartition(3), folder, {"scope": "run1"}) == about
    with pytest.raises(ValueError, match="another"):
        artifacts.write_artifact(rows.limit(5), folder, {"scope": "run1"})
    with pytest.raises(ValueError, match="repeats"):
        artifacts.write_artifact(rows.union(rows), str(tmp_path / "b"), {})
    first = artifacts.listed(folder)["files"][0]["file"]
    footer = json.loads(pq.read_metadata(f"{folder}/{first}").metadata[artifacts.KEY])
    assert footer["artifact"] == about
    kept = open(f"{folder}/{first}", "rb").read()
    t = pq.read_table(f"{folder}/{first}")
    pq.write_table(t.slice(1).replace_schema_metadata({artifacts.KEY: json.dumps(footer)}), f"{folder}/{first}")
    assert artifacts.verify_artifact(spark, folder) == ["content"]
    pq.write_table(t, f"{folder}/{first}")
    assert artifacts.verify_artifact(spark, folder) == ["no_footer"]
    open(f"{folder}/{first}", "wb").write(kept[:-20])
    assert artifacts.verify_artifact(spark, folder) == ["no_footer"]
    os.remove(f"{folder}/{first}")
    assert artifacts.verify_artifact(spark, folder) == ["missing_file"]
    data, told = artifacts.artifact_bytes(rows, {"scope": "run1"})
    assert told == about and pq.read_table(pa.BufferReader(data)).num_rows == 200
    with pytest.raises(ValueError, match="more than"):
        artifacts.artifact_bytes(rows, {}, most=10)
    none = str(tmp_path / "none")
    assert artifacts.write_artifact(rows.limit(0), none, {})["n_records"] == 0 and artifacts.verify_artifact(spark, none) == []
    assert artifacts.verify_artifact(spark, str(tmp_path / "nothing")) == ["no_artifact"]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    folder = str(tmp_path / "a")
    bad = spark.range(100, numPartitions=4).select(F.format_string("r%d", "id").alias("record_id"), F.col("id"))
    spark.dataSource.register(artifacts.Artifacts)
    failing = bad.withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        failing.write.format("artifact").option("artifact", "{}").mode("append").save(folder)
    assert not os.path.exists(folder) or set(os.listdir(folder)) <= {artifacts.STAGED}  # tasks that are still being stopped may write there
    assert artifacts.verify_artifact(spark, folder) == ["no_artifact"]
    os.makedirs(f"{folder}/{artifacts.STAGED}/killed")  # a job that was killed before it could clean up
    open(f"{folder}/{artifacts.STAGED}/killed/part-1.parquet", "wb").write(b"half")
    artifacts.write_artifact(bad, folder, {})
    assert artifacts.verify_artifact(spark, folder) == [] and artifacts.STAGED not in os.listdir(folder)
