"""Splits rows by a set of keys without shuffling all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 62
BITS = WORD << 16


def split(rows: DataFrame, column: str, keys: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``column`` may be among the keys (one column), and rows where it isn't.

    The keys are hashed into a bit array of fixed size, which is broadcast as at most ``bits`` / 62 rows. With far more
    keys than bits every row may be among them; a join with the first part is always exact. A null is no key.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    at = keys.select(place(F.col(keys.columns[0])).alias("_b"))
    set_ = at.groupBy((F.col("_b") / WORD).cast("int").alias("_w")).agg(F.expr(f"bit_or(shiftleft(1L, cast(_b % {WORD} as int)))").alias("_bits"))
    own = rows.withColumn("_b", place(F.col(column))).withColumn("_w", (F.col("_b") / WORD).cast("int")).join(F.broadcast(set_), "_w", "left")
    hit: Column = F.expr(f"{column} is not null and coalesce(shiftright(_bits, cast(_b % {WORD} as int)) & 1, 0) = 1")
    return own.filter(hit).select(*rows.columns), own.filter(~hit).select(*rows.columns)
