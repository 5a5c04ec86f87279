"""The queries of this package and the SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civicledger.llm import centroids, conversation_trie, credential_links, fmindex, grammar, mixing, oracles, packing, partenum, radix_dedup, sharding, toxicity, url_templates, weighted_fingerprint
from civicledger.session import scratch_dir

ARROW_ROWS = 1000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op3_partenum_groups": oracles.OP3, "op7_fm_index": oracles.OP7, "op10_radix_dedup": oracles.OP10, "op12_prefix_trie": oracles.OP12, "op13_sharded_lloyd": oracles.OP13}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder.

    Python workers on this machine find the package where the driver found it, and get texts in batches of rows that
    long texts don't make too large for them.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_repair_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "repair")
    grammar.write(table(spark, folder, "documents"), path)
    return grammar.read_digests(spark, path)


@query
def op4_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"))


@query
def op6_shortest_pack_first(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "pieces")
    packing.write_pieces(table(spark, folder, "documents"), path)
    return packing.place(spark, path)


@query
def op7_fm_index(spark: SparkSession, folder: str) -> DataFrame:
    return fmindex.digests(fmindex.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


@query
def op9_segment_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_partenum_groups(spark: SparkSession, folder: str) -> DataFrame:
    return partenum.groups(spark, table(spark, folder, "documents"))


@query
def op10_radix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return radix_dedup.digests(radix_dedup.cleaned(spark, table(spark, folder, "documents")))


@query
def op5_credential_links(spark: SparkSession, folder: str) -> DataFrame:
    return credential_links.digests(spark, table(spark, folder, "documents"))


@query
def op8_weighted_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return weighted_fingerprint.compared(spark, table(spark, folder, "documents"))


@query
def op2_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.judged(spark, table(spark, folder, "pages"), table(spark, folder, "labels"))


@query
def op11_entropy_balancing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digests(spark, table(spark, folder, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.digests(spark, table(spark, folder, "conversations"))


@query
def op13_sharded_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.digests(spark, table(spark, folder, "embeddings"))
