"""Parquet artifacts whose files carry their own description, as a data source.

spark.dataSource.register(Artifacts); write_artifact(rows, folder, manifest); verify_artifact(spark, folder).

Every task writes one file into a folder of the attempt's own, with the artifact's JSON and the file's number, rows and digest
in its footer. When all tasks have ended, the driver moves the files that they told of into place and writes the list of them last: a
folder without that list holds no artifact. A job that fails, or is killed, leaves nothing under the names that a reader looks
at; its attempts' folders go when it is aborted, or with the next artifact that is written there.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tracesieve.operators import merkle

KEY = b"artifact"
LIST, STAGED = "_artifact.json", "_staged"
VERSION = 5


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int
    digest: str


@dataclass
class File(InputPartition):
    path: str


def opened(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _content(digest, batch: pa.RecordBatch) -> None:
    """Adds a batch's values to a digest: as JSON lines, which don't depend on how rows fell into batches."""
    for row in batch.to_pylist():
        digest.update(json.dumps(row, sort_keys=True, default=str, ensure_ascii=False).encode() + b"\n")


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, schema) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.artifact = options["path"].rstrip("/"), options["artifact"]
        self.schema = to_arrow_schema(schema)
        self.attempt = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, inner = opened(self.path)
        staged = f"{inner}/{STAGED}/{self.attempt}"
        system.create_dir(staged, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex}.parquet"
        digest, rows = hashlib.sha256(), 0
        with system.open_output_stream(f"{staged}/{name}") as out, pq.ParquetWriter(out, self.schema) as writer:
            for batch in iterator:
                batch = batch.cast(self.schema)
                writer.write_batch(batch)
                _content(digest, batch)
                rows += len(batch)
            about = {"artifact": json.loads(self.artifact), "part": part, "rows": rows, "digest": digest.hexdigest()}
            writer.add_key_value_metadata({KEY: json.dumps(about, sort_keys=True).encode()})
        return Written(name, rows, digest.hexdigest())

    def commit(self, messages: list) -> None:
        system, inner = opened(self.path)
        told = sorted((m for m in messages if m is not None), key=lambda m: m.file)
        kept = [m for m in told if m.rows] or told[:1]  # an artifact of no rows is one file without any
        for m in kept:
            system.move(f"{inner}/{STAGED}/{self.attempt}/{m.file}", f"{inner}/{m.file}")
        listed = {"artifact": json.loads(self.artifact), "files": [{"file": m.file, "rows": m.rows, "digest": m.digest} for m in kept]}
        with system.open_output_stream(f"{inner}/{STAGED}/{self.attempt}.json") as out:
            out.write(json.dumps(listed, sort_keys=True).encode())
        system.move(f"{inner}/{STAGED}/{self.attempt}.json", f"{inner}/{LIST}")
        system.delete_dir(f"{inner}/{STAGED}")

    def abort(self, messages: list) -> None:
        system, inner = opened(self.path)
        if system.get_file_info(f"{inner}/{STAGED}").type != fs.FileType.NotFound:
            system.delete_dir(f"{inner}/{STAGED}")


class _Footers(DataSourceReader):
    """A row for each file: file, about (its footer's JSON, null if it has none), rows, digest (of what it holds now)."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[File]:
        system, inner = opened(self.path)
        return [File(f"{self.path}/{x.base_name}") for x in system.get_file_info(fs.FileSelector(inner)) if x.base_name.endswith(".parquet")]

    def read(self, partition: File) -> Iterator[tuple]:
        if partition is None:
            return
        system, inner = opened(partition.path)
        digest, rows = hashlib.sha256(), 0
        try:
            with system.open_input_file(inner) as file:
                f = pq.ParquetFile(file)
                about = (f.metadata.metadata or {}).get(KEY)
                for batch in f.iter_batches(4096):
                    _content(digest, batch)
                    rows += len(batch)
        except (pa.ArrowInvalid, OSError):  # no whole Parquet file
            about, rows = None, -1
        yield inner.rsplit("/", 1)[-1], about.decode() if about else None, rows, digest.hexdigest()


class Artifacts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "artifact"

    def schema(self) -> str:
        return "file string, about string, rows long, digest string"

    def reader(self, schema) -> DataSourceReader:
        return _Footers(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, schema)


def described(rows: DataFrame, key: str, manifest: dict) -> dict:
    """The artifact's JSON: the manifest, the schema, the number of rows and its identity, which is the root of
    the rows' tree of digests and of all the rest."""
    nodes = merkle.tree(rows, [key])
    about = {"version": VERSION, **manifest, "schema": [[f.name, f.dataType.simpleString()] for f in rows.schema], "n_records": nodes.filter("level = 0").count(), "root": merkle.root(nodes)}
    return about | {"artifact_id": hashlib.sha256(json.dumps(about, sort_keys=True).encode()).hexdigest()}


def write_artifact(rows: DataFrame, folder: str, manifest: dict, key: str = "record_id") -> dict:
    """Writes rows, sorted by their key, and returns the artifact's JSON. A folder that holds an artifact already is left as it
    is if it is this one, and an error otherwise. Repeated and null keys are errors."""
    spark = rows.sparkSession
    nulls, n, different = rows.agg(F.count_if(F.col(key).isNull()), F.count(F.lit(1)), F.countDistinct(key)).first()
    if nulls or n != different:
        raise ValueError(f"{key} has {nulls} nulls and {n - nulls - different} repeats")
    artifact = described(rows, key, manifest)
    old = listed(folder)
    if old is not None:
        if old["artifact"]["artifact_id"] != artifact["artifact_id"]:
            raise ValueError(f"{folder} holds another artifact")
        return old["artifact"]
    spark.dataSource.register(Artifacts)
    rows.repartitionByRange(key).sortWithinPartitions(key).write.format("artifact").option("artifact", json.dumps(artifact, sort_keys=True)).mode("append").save(folder)
    return artifact


def listed(folder: str) -> dict | None:
    """What a folder's list says; None without one."""
    system, inner = opened(folder.rstrip("/"))
    if system.get_file_info(f"{inner}/{LIST}").type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(f"{inner}/{LIST}") as f:
        return json.loads(f.read())


def verify_artifact(spark: SparkSession, folder: str, key: str = "record_id") -> list[str]:
    """What is wrong with an artifact, sorted; empty if nothing is. Every file is read by its own task, against its footer and the
    list; then the rows' tree is built again."""
    about = listed(folder)
    if about is None:
        return ["no_artifact"]
    spark.dataSource.register(Artifacts)
    files = spark.read.format("artifact").load(folder)
    of_list = spark.createDataFrame([(f["file"], f["rows"], f["digest"]) for f in about["files"]], "file string, want_rows long, want_digest string")
    x = files.join(of_list, "file", "full").withColumn("told", F.from_json("about", "artifact struct<artifact_id string>, rows long, digest string"))
    sound = (F.col("rows") == F.col("want_rows")) & (F.col("digest") == F.col("want_digest")) & (F.col("told.rows") == F.col("rows")) & (F.col("told.digest") == F.col("digest"))
    problem = (
        F.when(F.col("rows").isNull(), "missing_file").when(F.col("want_rows").isNull(), "unlisted_file").when(F.col("told").isNull(), "no_footer")
        .when(F.col("told.artifact.artifact_id") != about["artifact"]["artifact_id"], "other_artifact").when(~F.coalesce(sound, F.lit(False)), "content")
    )
    wrong = {r["problem"] for r in x.select(problem.alias("problem")).filter("problem is not null").distinct().collect()}
    if not wrong:
        paths = [f"{folder.rstrip('/')}/{f['file']}" for f in about["files"]]
        rows = spark.read.parquet(*paths)
        again = described(rows, key, {k: v for k, v in about["artifact"].items() if k not in ("version", "schema", "n_records", "root", "artifact_id")})
        wrong |= {k for k in ("n_records", "root", "schema") if again[k] != about["artifact"][k]}
    return sorted(wrong)


#: Most rows of an artifact that is made in memory.
IN_MEMORY = 100_000


def artifact_bytes(rows: DataFrame, manifest: dict, key: str = "record_id", most: int = IN_MEMORY) -> tuple[bytes, dict]:
    """The artifact as one Parquet file in memory, and its JSON; more than `most` rows are an error."""
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows: write_artifact takes them")
    artifact = described(rows, key, manifest)
    out = rows.orderBy(key).toArrow().replace_schema_metadata({KEY: json.dumps({"artifact": artifact}, sort_keys=True)})
    sink = pa.BufferOutputStream()
    pq.write_table(out, sink)
    return sink.getvalue().to_pybytes(), artifact
