"""Streaming queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.plans import standins as S
from civicledger.plans.manifest_queries import LATEST_SQL
from civicledger.plans.registry import query
from civicledger.session import scratch_dir
from civicledger.sources.tables import table
from civicledger.streaming.changes import listing_changes
from civicledger.streaming.ingest import file_stream, ingest, ingested


@query("stream_ingest", LATEST_SQL)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive as files; the manifest they leave behind is read back."""
    scratch = scratch_dir(spark, "ingest")
    schema = table(spark, folder, "events").schema
    stream = file_stream(spark, folder, schema, "events.parquet")
    ingest(stream, S.entries_of, f"{scratch}/manifest", f"{scratch}/checkpoint")
    return ingested(spark, f"{scratch}/manifest")


@query(
    "folder_changes",
    """
WITH before AS (SELECT source || '/' || doc_id AS relative_path, doc_id, coalesce(CAST(strlen(text) AS BIGINT), 0) AS size_bytes, doc_id AS modified FROM documents)
SELECT relative_path, CASE doc_id % 5 WHEN 0 THEN 'removed' ELSE 'changed' END AS kind, size_bytes + CASE doc_id % 5 WHEN 1 THEN 1 ELSE 0 END AS size_bytes,
  modified - CASE doc_id % 5 WHEN 2 THEN 1 ELSE 0 END AS modified FROM before WHERE doc_id % 5 < 3
UNION ALL SELECT 'new/' || relative_path, 'added', size_bytes, modified FROM before WHERE doc_id % 7 = 0""",
)
def folder_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as two listings, between which some are added, some removed, some longer and some restored from earlier."""
    part = F.col("doc_id") % 5
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    before = table(spark, folder, "documents").select("doc_id", path.alias("relative_path"), size.alias("size_bytes"), F.col("doc_id").alias("modified"))
    longer, older = (F.col("size_bytes") + F.when(part == 1, 1).otherwise(0)).alias("size_bytes"), (F.col("modified") - F.when(part == 2, 1).otherwise(0)).alias("modified")
    kept = before.where(part > 0).select("relative_path", longer, older)
    new = before.where("doc_id % 7 = 0").select(F.concat(F.lit("new/"), "relative_path").alias("relative_path"), "size_bytes", "modified")
    return listing_changes(before, kept.union(new))
