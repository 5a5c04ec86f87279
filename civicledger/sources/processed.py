"""Sink for cleaned and merged facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PERIOD = ["fiscal_year", "quarter"]


def write_processed(facts: DataFrame, path: str, files_per_period: int | None = None) -> None:
    """Replace exactly the periods present in ``facts``; the other periods stay as they are.

    Rows are written where they are. ``files_per_period`` gathers each period into that many files first:
    the period alone would send a large period to one task, so a row hash spreads it.
    """
    if files_per_period:
        salt = F.pmod(F.xxhash64(*[c for c in facts.columns if c not in PERIOD]), F.lit(files_per_period))
        facts = facts.withColumn("_salt", salt).repartition(*PERIOD, "_salt").drop("_salt")
    facts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PERIOD).parquet(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def period_digests(facts: DataFrame) -> DataFrame:
    """Per period the number of facts and two sums over their hashes, which the order of rows doesn't change."""
    columns = sorted(facts.columns)
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit("digest"), *reversed(columns))
    total = lambda c: F.sum(c.cast("decimal(38,0)")).cast("string")
    return facts.groupBy(*PERIOD).agg(F.count("*").alias("n"), F.concat_ws(":", total(one), total(two)).alias("digest"))


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def write_changed(spark: SparkSession, facts: DataFrame, path: str) -> list[tuple]:
    """Make ``path`` hold exactly ``facts``, writing only periods whose facts have changed; gives (period..., action).

    A digest per period is kept beside the data, in a folder that readers pass over, and compared first. Changed and new
    periods are overwritten (``written``), periods without facts deleted (``removed``). Digests are written last: a run
    that fails before only leads to writing the same periods again. The periods themselves, a few a year, go through the
    driver; ``facts`` is read twice and must give the same rows, and not from ``path``.
    """
    stored_at = f"{path}/_digests"
    fs, folder = _hadoop_path(spark, stored_at)
    now = period_digests(facts)
    kind = now.schema
    rows = [tuple(r) for r in now.collect()]
    before = {tuple(r)[: len(PERIOD)]: tuple(r) for r in spark.read.schema(kind).parquet(stored_at).collect()} if fs.exists(folder) else {}
    new = {r[: len(PERIOD)]: r for r in rows}
    written = [k for k, r in new.items() if before.get(k) != r]
    removed = [k for k in before if k not in new]
    if written:
        wanted = spark.createDataFrame(written, StructType(kind.fields[: len(PERIOD)])).alias("w")
        same = [facts[c].eqNullSafe(F.col(f"w.{c}")) for c in PERIOD]
        write_processed(facts.join(F.broadcast(wanted), same, "left_semi"), path)
    for key in removed:
        place = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(PERIOD, key, strict=True))
        fs.delete(_hadoop_path(spark, f"{path}/{place}")[1], True)
    if written or removed:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(stored_at)
    return [(*k, "written") for k in written] + [(*k, "removed") for k in removed]
