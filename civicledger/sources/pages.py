"""Snapshots of listing pages and published statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.sources.files import read_files

# File name of a published statement, ``{year}_{quarter}_...``.
PERIOD_IN_NAME = r"(?:^|/)([0-9]{4})_(Q[1-4])_"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page snapshots (page_id, url, html)."""
    return spark.read.schema("page_id BIGINT, url STRING, html STRING").parquet(path)


def read_page_files(spark: SparkSession, root: str, charset: str = "UTF-8", glob: str = "*.htm*") -> DataFrame:
    """HTML files as (file, html)."""
    return read_files(spark, root, glob).select(
        F.col("relative_path").alias("file"), F.decode("content", charset).alias("html")
    )


def read_statements(spark: SparkSession, root: str) -> DataFrame:
    """Quarterly statements as (file, fiscal_year, quarter, html); they are declared as ISO-8859-1."""
    return read_page_files(spark, root, "ISO-8859-1").select(
        "file",
        F.regexp_extract("file", PERIOD_IN_NAME, 1).try_cast("int").alias("fiscal_year"),
        F.regexp_extract("file", PERIOD_IN_NAME, 2).alias("quarter"),
        "html",
    )
