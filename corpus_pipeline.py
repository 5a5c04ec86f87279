"""A training corpus from documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, folder of tables) and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of documents. Nulls, empty texts, repeated rows and empty
tables are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.llm import credential_links, fmindex, packing, partenum, prefilter, toxicity
from civicledger.llm.queries import table
from civicledger.session import scratch_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones, doesn't call toxic."""
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.scored(docs, model, COLUMNS).filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of similar rows the one with the smallest id (null last), whether or not rows share an id.

    Rows get numbers of their own, written once. Rows without words are like none and stay.
    """
    base = scratch_dir(spark, "copies")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    rows = kept(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "rows")
    found = partenum.groups(spark, rows.select(F.col("_row").alias("doc_id"), "text"))
    linked = kept(found.filter("doc_id != component_id").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "linked")
    roots = linked.select("_group").distinct().select(F.col("_group").alias("_row"), "_group")
    members = kept(linked.union(roots).join(rows.select("_row", "doc_id"), "_row").select("_row", "_group", "doc_id"), "members")
    least = members.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("least"))
    copies = kept(members.select("_row").join(least.select(F.col("least._row").alias("_row")), "_row", "left_anti"), "drop")
    maybe, others = prefilter.split(rows, "_row", copies)
    return others.select(*COLUMNS).union(maybe.join(copies, "_row", "left_anti").select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = fmindex.hits(docs, table(spark, folder, "benchmark"), COLUMNS)
    return found.filter(F.size("spans") == 0).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets and linked credential parts masked; ``n_chars`` follows the text."""
    masked = credential_links.redacted(spark, docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 2048 tokens."""
    path = scratch_dir(spark, "pieces")
    packing.write_pieces(docs, path)
    return packing.place(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: SQL can't express fitted models, tokenizers and packing.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        out = stage(spark, docs, folder)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
