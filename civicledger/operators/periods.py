"""Operators over fiscal periods, which are keyed by (year, quarter).

Windows partition by entity (and year), so each holds at most one row per period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUARTERS = 4


def period_index(year: str | Column = "year", quarter: str | Column = "quarter") -> Column:
    """Consecutive number of a quarter, so that distances in time are differences."""
    y = F.col(year) if isinstance(year, str) else year
    q = F.col(quarter) if isinstance(quarter, str) else quarter
    return (y * QUARTERS + q - 1).cast("int")


def ytd_to_flow(df: DataFrame, entity: list[str], value: str = "ytd", out: str = "flow") -> DataFrame:
    """Quarterly flow from amounts that accumulate over the year.

    The first quarter is its own flow. Where the previous quarter is missing, the flow is unknown (null).
    """
    previous = Window.partitionBy(*entity, "year").orderBy("quarter").rangeBetween(-1, -1)
    before = F.sum(value).over(previous)
    return df.withColumn(out, F.when(F.col("quarter") == 1, F.col(value)).otherwise(F.col(value) - before))


def flow_to_ytd(df: DataFrame, entity: list[str], value: str = "flow", out: str = "ytd") -> DataFrame:
    """Running total within the fiscal year, the inverse of :func:`ytd_to_flow` on complete years."""
    upto = Window.partitionBy(*entity, "year").orderBy("quarter").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(upto))


def trend(df: DataFrame, entity: list[str], value: str) -> DataFrame:
    """Adds the amount one quarter and one year earlier, and the change against each in percent.

    Frames range over the period number, so a missing quarter gives null instead of a wrong neighbour and
    no spine of empty periods is needed.
    """
    ordered = Window.partitionBy(*entity).orderBy(period_index())

    def earlier(distance: int) -> Column:
        return F.sum(value).over(ordered.rangeBetween(-distance, -distance))

    def change(base: str) -> Column:
        ratio = F.try_divide(F.col(value).cast("double"), F.col(base).cast("double"))
        return F.round(100 * (ratio - 1), 4)

    return (
        df.withColumn("previous_quarter", earlier(1))
        .withColumn("previous_year", earlier(QUARTERS))
        .withColumn("qoq_pct", change("previous_quarter"))
        .withColumn("yoy_pct", change("previous_year"))
    )


def period_gaps(df: DataFrame, entity: list[str]) -> DataFrame:
    """Quarters missing between the first and the last quarter of each entity.

    One aggregation: an entity's distinct quarters are a set no longer than its calendar, collected on the
    map side first, so many rows of one entity stay small.
    """
    periods = df.groupBy(*entity).agg(F.collect_set(period_index()).alias("present"))
    spine = F.sequence(F.array_min("present"), F.array_max("present"))
    missing = periods.select(*entity, F.explode(F.array_except(spine, F.col("present"))).alias("period"))
    return missing.select(
        *entity,
        F.floor(F.col("period") / QUARTERS).cast("int").alias("year"),
        (F.col("period") % QUARTERS + 1).cast("int").alias("quarter"),
    )


def reconcile(months: DataFrame, years: DataFrame, keys: list[str], value: str = "amount") -> DataFrame:
    """Sum of the monthly figures against the published annual figure, per key and year."""
    summed = months.groupBy(*keys, "year").agg(
        F.sum(value).alias("monthly_total"), F.count_distinct("month").alias("n_months")
    )
    annual = years.select(*keys, "year", F.col(value).alias("annual_total"))
    return summed.join(annual, [*keys, "year"], "full_outer").withColumn(
        "difference", F.coalesce("annual_total", F.lit(0)) - F.coalesce("monthly_total", F.lit(0))
    )
