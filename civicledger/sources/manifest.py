"""The manifest: which file holds which content.

Runs append to a Parquet log; the current manifest is the latest entry per path. Manifests kept as one
JSON object per file are read for migration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.operators.manifest import latest_entries

ENTRY_FIELDS = """
    source STRING, url STRING, filename STRING, relative_path STRING, year STRING, quarter STRING,
    link_text STRING, timestamp STRING, size_bytes BIGINT, checksum STRING
"""
ENTRY_TYPE = f"STRUCT<{', '.join(field.strip().replace(' ', ': ', 1) for field in ENTRY_FIELDS.split(','))}>"


def manifest_entries(documents: DataFrame, body: Column, *keep: str) -> DataFrame:
    """One row per entry of each JSON manifest; a document that does not parse has no entries."""
    parsed = F.from_json(body, f"MAP<STRING, {ENTRY_TYPE}>", {"mode": "PERMISSIVE"})
    return documents.select(*keep, F.explode(parsed).alias("key", "entry")).select(*keep, "key", "entry.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of JSON manifests: one whole object per file, any number of files."""
    return manifest_entries(spark.read.text(path, wholetext=True), F.col("value")).drop("key")


def append_manifest(entries: DataFrame, path: str) -> None:
    """Add entries to the log; earlier ones stay."""
    entries.write.mode("append").parquet(path)


def current_manifest(spark: SparkSession, path: str) -> DataFrame:
    return latest_entries(spark.read.parquet(path))
