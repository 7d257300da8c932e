"""Queries over identities of whole datasets and over artifacts that are written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracesieve.functions import text as T
from tracesieve.operators import merkle
from tracesieve.operators.sequences import in_order
from tracesieve.plans.registry import query
from tracesieve.plans.sql import framed
from tracesieve.sources import artifacts
from tracesieve.sources.tables import shared_folder, table

_UP = "select i // 256 as i, sha256(string_agg(digest, '' order by i)) as digest from {0} where (select count(*) from {0}) > 1 group by 1"


@query(f"""with l0 as (select row_number() over (order by doc_id) - 1 as i, {framed('lang', 'source', 'text')} as digest from documents), l1 as ({_UP.format('l0')}), l2 as ({_UP.format('l1')}), l3 as ({_UP.format('l2')}), l4 as ({_UP.format('l3')})
 select 0 as level, * from l0 union all select 1, * from l1 union all select 2, * from l2 union all select 3, * from l3 union all select 4, * from l4""")
def digest_tree(spark: SparkSession, d: str) -> DataFrame:
    return merkle.tree(table(spark, d, "documents"), ["doc_id"], digest=T.framed_digest(F.col("lang"), F.col("source"), F.col("text")))


# A second version of the documents has other texts for every 97th.
@query("select row_number() over (order by doc_id) - 1 as i, doc_id from documents qualify doc_id % 97 = 5")
def digest_tree_changes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    later = docs.withColumn("text", F.when(F.col("doc_id") % 97 == 5, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text")))
    found = merkle.changed(merkle.tree(docs, ["doc_id"]), merkle.tree(later, ["doc_id"]))
    return in_order(docs.select("doc_id"), [], ["doc_id"]).join(found, F.col("ordinal") == F.col("i")).select("i", "doc_id")


@query("""select 'r' || o_orderkey as record_id, o_custkey % 9 as area, o_totalprice as score, o_comment is null as plain from (select *, null as o_comment from orders where o_orderstatus = 'F')""")
def artifact_rows_read_back(spark: SparkSession, d: str) -> DataFrame:
    """The rows of an artifact that was written and verified; an artifact that isn't sound is an error."""
    rows = table(spark, d, "orders").filter("o_orderstatus = 'F'")
    rows = rows.select(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("record_id"), (F.col("o_custkey") % 9).alias("area"), F.col("o_totalprice").alias("score"), F.lit(True).alias("plain"))
    folder = f"{shared_folder(spark)}/artifact-{uuid.uuid4().hex}"
    artifacts.write_artifact(rows, folder, {"scope": "finished"})
    wrong = artifacts.verify_artifact(spark, folder)
    if wrong:
        raise ValueError(f"{folder}: {wrong}")
    return spark.read.schema(rows.schema).parquet(*(f"{folder}/{f['file']}" for f in artifacts.listed(folder)["files"]))
