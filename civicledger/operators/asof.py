"""The value that holds at a point in time: the last one known at or before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a stretch of time, in days, and of numbers.
STRETCH_DAYS, STRETCH_NUMBERS = 32, 64


def _stretch(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    if kind.startswith(("date", "timestamp")):
        return F.floor(F.col(column).cast("timestamp").cast("long") / (86400 * STRETCH_DAYS))
    return F.floor(F.col(column) / STRETCH_NUMBERS)


def as_of(facts: DataFrame, steps: DataFrame, by: str, at: str, since: str, value: str) -> DataFrame:
    """Facts with ``value`` and ``since`` of the last step of their ``by`` at or before ``at``; every fact stays one row.

    A step whose ``since`` has several different values, or none, holds a null until the next one. Facts without ``by``
    or ``at``, or before the first step, get nulls.

    Not facts but their distinct points are sorted together with the steps, and these in stretches of time: each
    stretch starts with the last step of those before it. So neither a very common ``by`` nor a very common day puts
    its facts into one task, and no fact meets a step but its own.
    """
    points = facts.select(F.col(by).alias("_by"), F.col(at).alias("_at")).where("_by IS NOT NULL AND _at IS NOT NULL").distinct()
    own = steps.where(F.col(by).isNotNull() & F.col(since).isNotNull()).groupBy(F.col(by).alias("_by"), F.col(since).alias("_at"))
    known = own.agg(F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(value).alias("_n"), F.count("*").alias("_all"))
    single = F.when((F.col("_low") == F.col("_high")) & (F.col("_n") == F.col("_all")), F.col("_low"))
    changes = known.select("_by", "_at", F.struct(F.col("_at").alias("since"), single.alias("value")).alias("_step"))
    rows = points.withColumn("_step", F.lit(None).cast(changes.schema["_step"].dataType)).unionByName(changes.withColumn("_at", F.col("_at").cast(points.schema["_at"].dataType)))
    rows = rows.withColumn("_asked", F.col("_step").isNull()).withColumn("_stretch", _stretch(rows, "_at"))
    last = F.max("_step").alias("_last")  # by since, which a struct is compared by first
    front = Window.partitionBy("_by").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("_by", "_stretch").agg(last).select("_by", "_stretch", F.last("_last", ignorenulls=True).over(front).alias("_carried"))
    inside = Window.partitionBy("_by", "_stretch").orderBy("_at", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_own", F.last("_step", ignorenulls=True).over(inside)).where("_asked")
    held = found.join(carried, ["_by", "_stretch"]).select("_by", "_at", F.coalesce("_own", "_carried").alias("_held"))
    joined = facts.join(held, (facts[by] == held["_by"]) & (facts[at] == held["_at"]), "left")
    return joined.select(*[facts[c] for c in facts.columns], F.col("_held.value").alias(value), F.col("_held.since").alias(since))
