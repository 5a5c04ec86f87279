"""Re-runnable ingestion as a stream: every run handles only the files that arrived since the last one."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.operators.manifest import latest_entries, worklist

QUERY, BATCH = "query_id", "batch_id"


def file_stream(spark: SparkSession, folder: str, schema, glob: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Files of a folder as a stream. A file rewritten under its old path is not seen again: compare
    checksums with :func:`~civicledger.operators.manifest.worklist` for that."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    return reader.options(**options).load(folder)


def _log(spark: SparkSession, manifest: str) -> DataFrame | None:
    """The manifest log with the query and batch that wrote each entry; none before the first batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(manifest)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(manifest)


def ingest(
    stream: DataFrame,
    to_entries: Callable[[DataFrame], DataFrame],
    manifest: str,
    checkpoint: str,
) -> None:
    """Process all available files once; new or changed content is added to the manifest log.

    Each micro-batch owns one partition of the log, named by its query (which the checkpoint keeps) and number,
    and overwrites it, so a batch that is repeated after a failure leaves no duplicates and a fresh checkpoint
    none of the earlier entries behind. It is compared with all other batches, but only on the paths it holds.
    """

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        entries = to_entries(batch)
        log = _log(spark, manifest)
        if log is not None:
            others = log.where((F.col(QUERY) != query) | (F.col(BATCH) < number)).drop(QUERY, BATCH)
            known = others.join(entries.select("relative_path").distinct(), "relative_path", "left_semi")
            entries = worklist(entries, latest_entries(known))
        entries.write.mode("overwrite").parquet(f"{manifest}/{QUERY}={query}/{BATCH}={number}")

    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(commit)
        .start()
    )
    query.awaitTermination()


def ingested(spark: SparkSession, manifest: str) -> DataFrame:
    """The current manifest over all batches."""
    return latest_entries(spark.read.parquet(manifest).drop(QUERY, BATCH))


def compact(spark: SparkSession, manifest: str, target: str) -> None:
    """Write a log that holds the current entries only; runs may go on from ``target``."""
    ingested(spark, manifest).write.parquet(f"{target}/{QUERY}=compacted/{BATCH}=0")
