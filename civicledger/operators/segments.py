"""Subtotals, shares and ranks of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicledger.operators.columns import add_once

# Classes of about as many distinct values each, between which ranks are added up; the table of classes is as long.
_CLASSES = 200


def hierarchy(df: DataFrame, levels: list[str], value: str) -> DataFrame:
    """Subtotals at every level of a hierarchy, from the full key up to the grand total.

    ``depth`` says how many levels a row still distinguishes, so a null in the data is not mistaken for a
    subtotal. The finest level is summed first; only its result is expanded into the upper levels.
    """
    finest = df.groupBy(*levels).agg(F.sum(value).alias("subtotal"))
    rolled = finest.rollup(*levels).agg(F.sum("subtotal").alias("amount"), F.grouping_id().alias("grouping"))
    depth = len(levels) - F.bit_count("grouping")
    return rolled.withColumn("depth", depth.cast("int")).drop("grouping")


def cube_totals(df: DataFrame, dimensions: list[str], value: str) -> DataFrame:
    """Subtotals over every combination of dimensions, labelled by ``grouping``."""
    finest = df.groupBy(*dimensions).agg(F.sum(value).alias("subtotal"))
    return finest.cube(*dimensions).agg(
        F.sum("subtotal").alias("amount"), F.grouping_id().cast("int").alias("grouping")
    )


def _signed_totals(df: DataFrame, dimensions: list[str], amount: Column, sign: Column, cube: bool) -> DataFrame:
    known = F.when(amount.isNotNull(), sign).otherwise(0)
    finest = df.groupBy(*dimensions).agg(F.sum(amount * sign).alias("_amount"), F.sum(sign).alias("_n"), F.sum(known).alias("_known"))
    expanded = finest.cube(*dimensions) if cube else finest.rollup(*dimensions)
    sums = [F.sum(f"_{c}").alias(c) for c in ("amount", "n", "known")]
    return expanded.agg(*sums, F.grouping_id().cast("int").alias("grouping"))


def kept_subtotals(df: DataFrame, dimensions: list[str], value: str, cube: bool = False) -> DataFrame:
    """Subtotals that can be kept up: ``amount``, ``n`` (facts), ``known`` (facts with an amount), ``grouping``.

    Over the levels of a hierarchy, or over every combination of dimensions. ``grouping`` tells a subtotal from a null.
    """
    return _signed_totals(df, dimensions, F.col(value), F.lit(1).cast("long"), cube)


def changed_subtotals(stored: DataFrame, changes: DataFrame, dimensions: list[str], value: str, sign: str = "sign", cube: bool = False) -> DataFrame:
    """Stored subtotals after facts were added (``sign`` 1) or deleted (-1); a replaced fact is both.

    Only the changes are expanded over the levels; what they add up to is merged into the stored rows by one grouping.
    A subtotal is dropped when its last fact is deleted, its amount is null when no fact with an amount is left.
    """
    delta = _signed_totals(changes, dimensions, F.col(value), F.col(sign).cast("long"), cube)
    both = stored.select(*delta.columns).unionByName(delta)
    sums = [F.sum(c).alias(c) for c in ("n", "known")]
    merged = both.groupBy(*dimensions, "grouping").agg(F.sum("amount").alias("amount"), *sums).where("n <> 0")
    return merged.select(*dimensions, F.when(F.col("known") > 0, F.col("amount")).alias("amount"), "n", "known", "grouping")


def pivot_classes(df: DataFrame, by: list[str], column: str, values: list, value: str) -> DataFrame:
    """One column per expense class plus their total; the classes are given, so no scan looks for them."""
    wide = df.groupBy(*by).pivot(column, values).agg(F.sum(value))
    zero = F.lit(0)
    total = sum((F.coalesce(F.col(str(v)), zero) for v in values[1:]), F.coalesce(F.col(str(values[0])), zero))
    return wide.withColumn("total", total)


def rate_percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; null when there is no whole."""
    return F.round(F.try_divide(100 * part, whole), digits)


def rank_segments(segments: DataFrame, value: str) -> DataFrame:
    """Adds ``rank``, ``dense_rank`` and ``percent_rank`` by descending value over all segments; nulls come last.

    A window without partitions would sort everything in one task. Instead equal values are counted first,
    distinct values are ranked within classes that hold about equally many of them (split at approximate
    percentiles of the distinct values, whatever their distribution), and each class starts where the larger
    ones end. ``segments`` is read several times: hand in a written table.
    """
    counted = segments.groupBy(value).agg(F.count("*").alias("_n"))
    cuts = [i / _CLASSES for i in range(1, _CLASSES)]
    splits = counted.agg(F.percentile_approx(value, cuts).alias("splits")).scalar()
    larger = F.coalesce(F.size(F.filter("_splits", lambda s: s > F.col(value))), F.lit(0))
    counted = add_once(counted, _splits=splits)
    counted = counted.withColumn("_class", F.when(F.col(value).isNull(), _CLASSES).otherwise(larger)).drop("_splits")
    classes = counted.groupBy("_class").agg(F.sum("_n").alias("_rows"), F.count("*").alias("_values"))
    above = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    offsets = classes.select(
        "_class",
        F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_rows_above"),
        F.coalesce(F.sum("_values").over(above), F.lit(0)).alias("_values_above"),
        F.sum("_rows").over(Window.partitionBy()).alias("_all"),
    )
    within = Window.partitionBy("_class").orderBy(F.col(value).desc())
    ranked = (
        counted.withColumn("_before", F.sum("_n").over(within) - F.col("_n"))
        .withColumn("_place", F.row_number().over(within))
        .join(offsets, "_class")
        .select(
            F.col(value).alias("_value"),
            (F.col("_rows_above") + F.col("_before") + 1).alias("rank"),
            (F.col("_values_above") + F.col("_place")).alias("dense_rank"),
            "_all",
        )
    )
    percent = F.when(F.col("_all") > 1, (F.col("rank") - 1).cast("double") / (F.col("_all") - 1)).otherwise(F.lit(0.0))
    joined = segments.join(ranked, F.col(value).eqNullSafe(F.col("_value")))
    return joined.withColumn("percent_rank", F.round(percent, 6)).drop("_all", "_value")


def share_of_total(segments: DataFrame, value: str, out: str = "share") -> DataFrame:
    """Adds each segment's share of the overall total, which is one scalar computed by partial sums."""
    total = segments.select(F.sum(F.col(value))).scalar()
    return segments.withColumn(out, F.round(F.try_divide(F.col(value).cast("double"), total.cast("double")), 6))


def top_segments(segments: DataFrame, value: str, k: int, *tie: str) -> DataFrame:
    """The ``k`` largest segments: each task keeps only its own ``k`` candidates."""
    return segments.orderBy(F.col(value).desc(), *tie).limit(k)
