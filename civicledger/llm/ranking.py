"""Gapless ranks within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, key: str, order: list[str], name: str, buckets: int) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... within each value of ``key``, in no particular order across buckets.

    A group is dealt into ``buckets`` parts by a hash of ``order``. Parts are counted, which combines before the
    shuffle, and ranked apart; a rank is the size of the parts in front plus the place in its own. ``df`` is read
    twice and must give the same rows both times. ``key`` isn't null; rows equal in all of ``order`` are
    interchangeable.
    """
    parts = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    in_front = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    fronts = parts.groupBy(key, "_part").agg(F.count("*").alias("_n")).select(key, "_part", F.coalesce(F.sum("_n").over(in_front), F.lit(0)).alias("_front"))
    places = parts.withColumn("_place", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1)
    return places.join(fronts, [key, "_part"]).withColumn(name, F.col("_front") + F.col("_place")).drop("_part", "_place", "_front")
