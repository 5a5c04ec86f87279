"""Shards by jump consistent hashing of the document id.

The shard depends on ``doc_id`` and the number of shards alone; one more shard takes rows only into itself, about
1/(n+1) of all. Null ids count as one id. Null texts have no bytes. Repeated rows get slots of their own. Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicledger.llm.ranking import ranked


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: it jumps ahead with falling probability until it passes the last shard."""
    key = keys.astype(np.uint64)
    shard, ahead = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    open_ = np.arange(len(key))
    while len(open_):
        shard[open_] = ahead[open_]
        key[open_] = key[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        ahead[open_] = ((shard[open_] + 1) * (float(1 << 31) / ((key[open_] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        open_ = open_[ahead[open_] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Column of shards, from 0, for a column of 64-bit keys."""

    @F.pandas_udf("int")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards), dtype="int32")

    return run(key)


def assign(docs: DataFrame, shards: int = 16, rows_a_part: int = 100_000) -> DataFrame:
    """Shard, slot in the shard (gapless from 0) and the shard after one more was appended, for every document."""
    parts = max(64, docs.count() // (shards * rows_a_part))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id").alias("_key"),
    ).withColumn("shard", shard_of(F.col("_key"), shards))
    out = ranked(rows, "shard", ["doc_id", "size", "text_crc32"], "slot", parts)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", shard_of(F.col("_key"), shards + 1).alias("grown_shard"))
