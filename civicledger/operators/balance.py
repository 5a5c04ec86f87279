"""The core question: what a region contributes against what it gets back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicledger.functions.money import MONEY
from civicledger.operators.segments import rate_percent


def merge_phases(phases: dict[str, DataFrame], keys: list[str], value: str = "amount", kind: str = MONEY) -> DataFrame:
    """One row per key with the amount of each phase; a phase that lacks the key is null.

    Stacking the phases and grouping once does the work of a full outer join per phase with a single
    exchange, and partial sums keep large keys small.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [df.select(*keys, F.lit(name).alias("phase"), F.col(value).alias("amount")) for name, df in phases.items()],
    )
    return merge_stacked(stacked, keys, list(phases), kind)


def region_balance(collected: DataFrame, spent: DataFrame, region: str = "region") -> DataFrame:
    """Each region's share of collections against its share of spending.

    ``ratio`` is spending share over collection share (1 = proportional), ``gap`` their difference. ``region``
    may be any key: totals are scalars summed in part by every task.
    """
    both = merge_phases({"collected": collected, "spent": spent}, [region], kind="decimal(38,4)")

    def share(phase: str) -> F.Column:
        total = both.select(F.sum(phase)).scalar()
        return F.try_divide(F.col(phase).cast("double"), total.cast("double"))

    shares = both.withColumn("collected_share", share("collected")).withColumn("spent_share", share("spent"))
    ratio = F.try_divide(F.col("spent_share"), F.col("collected_share"))
    return shares.select(
        region,
        F.col("collected"),
        F.col("spent"),
        F.round("collected_share", 6).alias("collected_share"),
        F.round("spent_share", 6).alias("spent_share"),
        F.round(ratio, 4).alias("ratio"),
        F.round(F.col("spent_share") - F.col("collected_share"), 6).alias("gap"),
    )


def merge_stacked(stacked: DataFrame, keys: list[str], phases: list[str], kind: str = MONEY) -> DataFrame:
    """As :func:`merge_phases`, from rows of (keys, phase, amount)."""
    sums = [F.sum(F.when(F.col("phase") == name, F.col("amount"))).cast(kind).alias(name) for name in phases]
    return stacked.groupBy(*keys).agg(*sums)


def obligation_rate(facts: DataFrame, by: list[str], obligations: str, allotment: str) -> DataFrame:
    """Obligations as a percentage of allotments, as a ratio of sums."""
    sums = facts.groupBy(*by).agg(F.sum(obligations).alias("obligations"), F.sum(allotment).alias("allotment"))
    rate = rate_percent(F.col("obligations").cast("double"), F.col("allotment").cast("double"))
    return sums.withColumn("obligation_rate", rate)


def compliance(agencies: DataFrame, reports: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Share of agencies that handed in a report."""
    reported = reports.select(key).distinct().withColumn("reported", F.lit(True))
    counts = agencies.join(reported, key, "left").groupBy(*by).agg(
        F.count("*").alias("n_agencies"), F.count_if(F.col("reported")).alias("n_reported")
    )
    rate = rate_percent(F.col("n_reported").cast("double"), F.col("n_agencies").cast("double"))
    return counts.withColumn("compliance_pct", rate)


def allocate_by_share(totals: DataFrame, weights: DataFrame, key: str, segment: str) -> DataFrame:
    """Estimate of spending by segment: a key's total split by the segments' share of its appropriation.

    Statements have no regional breakdown, so this is an allocation rule; rows are marked as estimates.
    ``weights`` has one ``weight`` per (key, segment), so a window holds as many rows as there are segments.
    """
    whole = F.sum("weight").over(Window.partitionBy(key))
    shares = weights.withColumn("share", F.try_divide(F.col("weight").cast("double"), whole.cast("double")))
    return totals.join(shares, key).select(
        key,
        segment,
        (F.col("amount").cast("double") * F.col("share")).cast(MONEY).alias("amount"),
        F.lit(True).alias("estimated"),
    )


def kpi_cards(phases: DataFrame, period: str) -> DataFrame:
    """Key figures per period as (kpi, period, value, change_pct), from rows of merged phases.

    ``obligation_rate`` is spending as a percentage of what was authorised, ``returned_share`` spending as a
    percentage of collections. The change compares with the period before.
    """
    sums = phases.groupBy(period).agg(*[F.sum(c).cast("decimal(38,4)").alias(c) for c in ("collected", "authorised", "spent")])
    percent = lambda whole: rate_percent(F.col("spent").cast("double"), F.col(whole).cast("double"), 4).cast("decimal(38,4)")
    figures = sums.withColumn("obligation_rate", percent("authorised")).withColumn("returned_share", percent("collected"))
    names = ["collected", "authorised", "spent", "obligation_rate", "returned_share"]
    cards = figures.unpivot([period], names, "kpi", "value").where(F.col("value").isNotNull())
    before = F.sum("value").over(Window.partitionBy("kpi").orderBy(period).rangeBetween(-1, -1))
    change = F.round(100 * (F.try_divide(F.col("value").cast("double"), before.cast("double")) - 1), 4)
    return cards.select("kpi", F.col(period).alias("period"), "value", change.alias("change_pct"))
