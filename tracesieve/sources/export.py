"""Publication of a dataset: written aside, described by a manifest, moved into place at once."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 5


def row_digest(columns: list[str]) -> Column:
    """A row's identity: SHA-256 over its columns in the order of their names."""
    texts = [F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit("{}")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\u0001", *texts), 256)


def digest(rows: DataFrame) -> dict:
    """Counts and an identity of the rows that depends on no order: exclusive or and sum of parts of
    the rows' hashes, which add up in parallel."""
    h = row_digest(rows.columns)
    part = lambda at: F.conv(F.substring(h, at, 15), 16, 10).cast("long")
    n, x, s = rows.agg(F.count("*"), F.bit_xor(part(1)), F.sum(part(20).cast("decimal(38,0)"))).first()
    return {"n_records": n, "xor": x or 0, "sum": str(s or 0)}


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def publish(rows: DataFrame, destination: str, key: str = "record_id") -> dict:
    """Writes rows sorted by key and a manifest beside them, then renames the folder. A destination
    that already holds the same rows is left as it is; one that holds others is an error."""
    spark = rows.sparkSession
    fs, there = file_system(spark, destination)
    manifest = {"version": VERSION, "schema": rows.schema.jsonValue(), **digest(rows)}
    if fs.exists(there):
        old = read_manifest(spark, destination)
        if {k: old.get(k) for k in ("n_records", "xor", "sum")} != {k: manifest[k] for k in ("n_records", "xor", "sum")}:
            raise ValueError(f"{destination} holds other rows")
        return old
    staged = f"{destination}.staged-{uuid.uuid4().hex}"
    rows.repartitionByRange(key).sortWithinPartitions(key).write.parquet(f"{staged}/data")
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.text(f"{staged}/manifest")
    if not fs.rename(file_system(spark, staged)[1], there):
        raise OSError(f"{staged} can't be renamed")
    return manifest


def read_manifest(spark: SparkSession, destination: str) -> dict:
    return json.loads(spark.read.text(f"{destination}/manifest").first()["value"])


def verify(spark: SparkSession, destination: str, key: str = "record_id") -> list[str]:
    """What is wrong with a published dataset; empty if nothing is."""
    manifest, rows = read_manifest(spark, destination), spark.read.parquet(f"{destination}/data")
    wrong = []
    if [f["name"] for f in manifest["schema"]["fields"]] != rows.columns:
        wrong.append("schema")
    wrong += [k for k, v in digest(rows).items() if manifest[k] != v]
    nulls, repeats = rows.agg(F.count_if(F.col(key).isNull()), F.count("*") - F.countDistinct(key)).first()
    return wrong + ["null_key"] * bool(nulls) + ["repeated_key"] * bool(repeats)
