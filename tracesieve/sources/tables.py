"""Tables, and the shared folder in which lineage is cut."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table with place, a struct of file and row in it: the order in which one reader meets the rows."""
    return table(spark, sf_dir, name).select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("place"))


@functools.lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; only where it is unset, a temporary folder.
    On a cluster an unset one is an error: executors wouldn't see each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
    return path or f"file://{_own_folder()}"


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prompt_lines(lines: DataFrame) -> DataFrame:
    """The rows whose value is a prompt, trimmed; blank lines and those from # on go."""
    trimmed = lines.withColumn("value", F.trim("value"))
    return trimmed.filter((F.col("value") != "") & ~F.startswith("value", F.lit("#")))


def messages(conversations: DataFrame) -> DataFrame:
    """conv_id and messages, an array of struct(role, content, reasoning), by turn. The table has no
    reasoning; every third assistant turn takes its first word as one, so that both cases occur."""
    turn = F.struct(
        "turn",
        "role",
        F.col("text").alias("content"),
        F.when((F.col("role") == "assistant") & (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(3)) == 0), F.split_part("text", F.lit(" "), F.lit(1))).alias("reasoning"),
    )
    grouped = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("m"))
    return grouped.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), x["reasoning"].alias("reasoning"))).alias("messages"))


def votes(lineitem: DataFrame, *more: str) -> DataFrame:
    """Judges' votes by arithmetic on lineitem: record_id, pos, judge, score, weight, verdict, and more of its columns."""
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_orderkey").alias("record_id"),
        F.col("l_linenumber").alias("pos"),
        F.concat(F.lit("judge"), (F.col("l_suppkey") % 5).cast("string")).alias("judge"),
        (F.col("l_discount") * 10).alias("score"),
        F.col("l_quantity").alias("weight"),
        F.when(flag == "A", "accept").when(flag == "R", "reject").when(F.col("l_linestatus") == "F", "revise").otherwise("uncertain").alias("verdict"),
        *more,
    )


def candidates(orders: DataFrame) -> DataFrame:
    """Candidate records by arithmetic on orders, four to a prompt group."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    p = F.col("o_orderpriority")
    state = F.array(*(F.lit(x) for x in STATES))
    return orders.select(
        k.alias("record_id"),
        F.floor(k / 4).cast("long").alias("group_id"),
        (k % 4).alias("idx"),
        F.concat(F.lit("run"), (F.floor(k / 4) % 3).cast("string")).alias("run_id"),
        F.when(c % 13 != 0, (c % 101) / 100.0).alias("aggregate"),
        (F.col("o_orderstatus") != "F").alias("all_passed"),
        F.when(p.isin("1-URGENT", "2-HIGH"), "accept").when(p == "3-MEDIUM", "revise").when(p == "5-LOW", "escalate").otherwise("reject").alias("decision"),
        F.get(state, (c % 12).cast("int")).alias("state"),
        (c % 7).alias("cost"),
    )


# The states of a record.
STATES = (
    "planned", "generated", "verifying", "verified", "judging", "judged", "admitted", "formatted", "exported", "rejected", "needs_review", "errored",
)
