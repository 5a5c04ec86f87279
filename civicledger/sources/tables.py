"""Readers for the columnar fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.functions.money import MONEY

# The columns of the appropriation data set.
APPROPRIATION_SCHEMA = """
    id BIGINT, department STRING, uacs_dpt_dsc STRING, agency STRING, uacs_agy_dsc STRING,
    prexc_fpap_id STRING, dsc STRING, operunit STRING, uacs_oper_dsc STRING, uacs_reg_id STRING,
    fundcd STRING, uacs_fundsubcat_dsc STRING, uacs_exp_cd STRING, uacs_exp_dsc STRING,
    uacs_sobj_cd STRING, uacs_sobj_dsc STRING, amt DOUBLE, year BIGINT, prexc_level STRING,
    sorder STRING, uacs_operdiv_id STRING, uacs_div_dsc STRING
"""

COLLECTION_SCHEMA = """
    period_type STRING, year INT, month INT, district STRING, revenue_type STRING, amount DECIMAL(20,2)
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_appropriations(spark: SparkSession, path: str) -> DataFrame:
    """Appropriations with the declared schema: codes stay zero-padded text, ``amt`` becomes exact pesos."""
    return spark.read.schema(APPROPRIATION_SCHEMA).parquet(path).withColumn("amt", F.col("amt").cast(MONEY))


def read_collections(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Collections exported as a long table of (period, district, revenue type, amount)."""
    reader = spark.read.schema(COLLECTION_SCHEMA)
    return reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)
