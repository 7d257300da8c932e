"""Receipts of publications: prepared before the rows are moved, acknowledged after, resumable.

A store is a shared folder with a log of receipts, to which rows are only appended, and the members
(key and row digest) of each artifact, written once."""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.sources import export

#: An engine or reference publication advances its records; a standalone one leaves them as they are.
PURPOSES = ("engine", "standalone", "reference")
_LOG = "publication_id string, artifact_id string, destination string, purpose string, state string, at bigint"


def _identity(*parts: str) -> str:
    return hashlib.sha256("".join(f"{len(p)}:{p};" for p in parts).encode()).hexdigest()


def _members(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("string").alias("key"), export.row_digest(rows.columns).alias("row_id"))


def _append(spark: SparkSession, store: str, receipt: dict, state: str) -> dict:
    row = {**receipt, "state": state, "at": time.time_ns()}
    spark.createDataFrame([tuple(row[c.split()[0]] for c in _LOG.split(", "))], _LOG).coalesce(1).write.mode("append").json(f"{store}/log")
    return row


def receipts(spark: SparkSession, store: str) -> DataFrame:
    """The last receipt of every publication."""
    fs, there = export.file_system(spark, f"{store}/log")
    if not fs.exists(there):
        return spark.createDataFrame([], _LOG)
    log = spark.read.schema(_LOG).json(f"{store}/log")
    rest = F.struct("at", "artifact_id", "destination", "purpose", "state")
    return log.groupBy("publication_id").agg(F.max(rest).alias("r")).select("publication_id", "r.artifact_id", "r.destination", "r.purpose", "r.state", "r.at")


def load(spark: SparkSession, store: str, publication_id: str) -> dict:
    """The receipt of that publication; KeyError if there is none."""
    row = receipts(spark, store).filter(F.col("publication_id") == publication_id).first()
    if row is None:
        raise KeyError(publication_id)
    return row.asDict()


def pending(spark: SparkSession, store: str, destination: str, purpose: str) -> dict | None:
    """The prepared, not yet acknowledged receipt of a destination; more than one is an error."""
    found = receipts(spark, store).filter((F.col("destination") == destination) & (F.col("purpose") == purpose) & (F.col("state") == "prepared")).limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"more than one pending publication for {destination}")
    return found[0].asDict() if found else None


def prepare(rows: DataFrame, store: str, destination: str, purpose: str, key: str = "record_id") -> dict:
    """Writes the members once and the intent; nothing stands at the destination yet."""
    if purpose not in PURPOSES:
        raise ValueError(f"unknown purpose {purpose}")
    spark = rows.sparkSession
    artifact = _identity("artifact", str(export.VERSION), json.dumps(export.digest(rows), sort_keys=True))
    fs, there = export.file_system(spark, f"{store}/members/{artifact}/_SUCCESS")
    if not fs.exists(there):
        _members(rows, key).write.mode("overwrite").parquet(f"{store}/members/{artifact}")
    receipt = {"publication_id": _identity("publication", artifact, destination, purpose), "artifact_id": artifact, "destination": destination, "purpose": purpose}
    return _append(spark, store, receipt, "prepared")


def acknowledge(rows: DataFrame, store: str, publication_id: str, history: DataFrame, key: str = "record_id") -> DataFrame:
    """(record_id, state, detail): what the publication adds to the history (record_id, state,
    detail): an `exported` of its artifact for each member that has none, nothing for a standalone
    one. Until it is in the history, asking again gives it again. rows must still be the members as
    prepared."""
    spark = rows.sparkSession
    receipt = load(spark, store, publication_id)
    members = spark.read.parquet(f"{store}/members/{receipt['artifact_id']}")
    now = _members(rows, key)
    if not (members.exceptAll(now).isEmpty() and now.exceptAll(members).isEmpty()):
        raise ValueError("the rows have changed since the publication was prepared")
    detail = F.lit(f"artifact:{receipt['artifact_id']}")
    added = members.select(F.col("key").alias("record_id"), F.lit("exported").alias("state"), detail.alias("detail"))
    if receipt["purpose"] == "standalone":
        added = added.limit(0)
    if receipt["state"] != "acknowledged":
        _append(spark, store, receipt, "acknowledged")
    return added.join(history, ["record_id", "state", "detail"], "left_anti")


def resume(rows: DataFrame, store: str, publication_id: str, history: DataFrame, key: str = "record_id") -> DataFrame:
    """Ends a publication wherever it has stopped: rows that stand at the destination stay."""
    receipt = load(rows.sparkSession, store, publication_id)
    export.publish(rows, receipt["destination"], key)
    return acknowledge(rows, store, publication_id, history, key)


def publish(rows: DataFrame, store: str, destination: str, purpose: str, history: DataFrame, key: str = "record_id", validate=None) -> DataFrame:
    """Prepares, publishes and acknowledges; what is added to the history. validate(rows) may name
    what is wrong with them (an empty list: nothing), and then nothing is prepared."""
    wrong = validate(rows) if validate else []
    if wrong:
        raise ValueError(f"rows may not be published: {wrong}")
    return resume(rows, store, prepare(rows, store, destination, purpose, key)["publication_id"], history, key)
