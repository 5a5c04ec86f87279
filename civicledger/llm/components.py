"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.session import scratch_dir


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(spark: SparkSession, edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """``node`` and ``root`` (the smallest node that edges lead to) of every node that has an edge and isn't a root.

    ``edges``: ``u`` and ``v``, not null, in any direction, repeated or not. Rounds of large and small stars: in each,
    a node hands its larger, then its smaller neighbours to the smallest one. Minima combine before the shuffle, so a
    node with very many neighbours costs no more than its edges. Every round is written to the shared folder.
    """
    base, round_ = scratch_dir(spark, "components"), 0

    def kept(df: DataFrame) -> DataFrame:
        nonlocal round_
        round_ += 1
        df.write.parquet(f"{base}/{round_}")
        return spark.read.schema("u bigint, v bigint").parquet(f"{base}/{round_}")

    def stars(both: DataFrame, least: DataFrame) -> DataFrame:
        return both.join(least, "u").filter("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))

    edges = kept(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(edges)
    for _ in range(most_rounds):
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stars(both.filter("v > u"), least).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = stars(large, smallest).union(smallest.select("u", F.col("m").alias("v")))
        edges = kept(small.distinct())
        after = _state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
    raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
