"""Fingerprints by consistent weighted sampling. DataFrame and SQL functions only.

A text is a vector of weighted terms: hashed words and how often they occur. For each of ``samples`` draws every term
gets its own r and c from Gamma(2, 1) and b from (0, 1); with weight S it takes t = floor(ln S / r + b) and
a = c / exp(r (t - b + 1)); the term with the smallest a, together with t, is the sample. Two texts share a sample with
a probability equal to the generalised Jaccard similarity of their vectors.

A term is the 64-bit hash of a word, and its draws are hashes of the term, so no table of terms is needed. The logarithm
of a is a function of term, t and the number of the draw, and serves as the sample itself: samples of different terms
are equal with a probability of about 2^-49, so a text costs one aggregation of numbers. Texts are dealt out by document
once; terms are counted and minima taken where the text lies.

The next document is the one with the next smaller id, after the smallest the largest; ids are dealt into ranges, and
a range finds the next of its last id from the first of the range below. Null texts are empty; an empty text has the
fingerprint of no terms, which equals itself only. A null id comes last. Rows that share an id are ordered by a hash of
the text; rows equal in both are one document (one next document, one result for each row). Other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import operator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicledger.session import scratch_dir

SAMPLES = 32
LEAST = -(1 << 63)
_HALF = float(1 << 32)


def _draw(k: int, j: int) -> Column:
    """64 random bits of a term for sample ``k``."""
    salt = int.from_bytes(hashlib.sha256(f"{k}/{j}".encode()).digest()[:8], "big", signed=True)
    return F.xxhash64(F.col("term").bitwiseXOR(F.lit(salt)))


def _product(bits: Column) -> Column:
    """Product of two numbers from (0, 1)."""
    return ((F.shiftrightunsigned(bits, 32) + 0.5) / _HALF) * ((bits.bitwiseAND(0xFFFFFFFF) + 0.5) / _HALF)


def sample(k: int) -> Column:
    """Logarithm of a, from ``term`` and ``ln_s``."""
    r, ln_c = -F.log(_product(_draw(k, 0))), F.log(-F.log(_product(_draw(k, 1))))
    b = (F.shiftrightunsigned(_draw(k, 2), 12) + 0.5) / float(1 << 52)
    return ln_c - r * (F.floor(F.col("ln_s") / r + b) - b + 1)


def fingerprints(spark: SparkSession, texts: DataFrame, key: list[str], samples: int = SAMPLES, terms: int | None = None) -> DataFrame:
    """``key`` and the array ``f`` of samples, for each text of ``texts`` (``key`` and ``text``) that has a word.

    ``terms`` folds the words into so many terms; without it every word is its own.
    """
    words = F.split(F.translate("text", "\t\n\r\x0b\x0c", "     "), " ")
    each = texts.select(*key, F.explode(words).alias("word")).filter("word != ''")
    term = F.xxhash64("word") if terms is None else F.pmod(F.xxhash64("word"), F.lit(terms))
    weights = each.select(*key, term.alias("term")).groupBy(*key, "term").agg(F.count("*").alias("n")).withColumn("ln_s", F.log("n"))
    mins = weights.groupBy(*key).agg(*[F.min(sample(k)).alias(f"f{k}") for k in range(samples)])
    return mins.select(*key, F.array(*[F.col(f"f{k}") for k in range(samples)]).alias("f"))


def following(spark: SparkSession, keys: DataFrame) -> DataFrame:
    """The distinct keys ``d``, ``h`` with ``n``, ``rows`` and ``nd``, ``nh``: the next key, descending, and after the last the first."""
    path = scratch_dir(spark, "order")
    keys.repartitionByRange("d", "h").withColumn("part", F.spark_partition_id()).write.parquet(path)
    keys = spark.read.schema("d bigint, h bigint, n bigint, rows bigint, part int").parquet(path)
    # One row per range: the largest key in it, and that of the range below; below the lowest comes the highest.
    tops = keys.groupBy("part").agg(F.max(F.struct("d", "h")).alias("top"))
    down = Window.orderBy(F.desc("part"))
    tops = tops.select("part", F.coalesce(F.lead("top").over(down), F.first("top").over(down)).alias("below"))
    own = Window.partitionBy("part").orderBy(F.desc("d"), F.desc("h"))
    follower = F.coalesce(F.lead(F.struct("d", "h")).over(own), F.col("below"))
    return keys.join(F.broadcast(tops), "part").withColumn("to", follower).select("d", "h", "n", "rows", F.col("to.d").alias("nd"), F.col("to.h").alias("nh"))


def likeness(one: str, two: str, samples: int) -> Column:
    """Share of equal samples; texts without words are alike."""
    same = functools.reduce(operator.add, [(F.col(one)[k] == F.col(two)[k]).cast("int") for k in range(samples)]) / samples
    none = F.col(one).isNull() & F.col(two).isNull()
    return F.when(none, F.lit(1.0)).otherwise(F.coalesce(same, F.lit(0.0)))


def shown(f: str, samples: int) -> Column:
    """Hashes of the samples as 16 hex digits each; no words: as many x."""
    return F.coalesce(F.array_join(F.transform(f, lambda x: F.lpad(F.lower(F.hex(F.xxhash64(x))), 16, "0")), ""), F.lit("x" * (16 * samples)))


def compared(spark: SparkSession, docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half comes from the next document."""
    base = scratch_dir(spark, "fingerprints")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(LEAST)).alias("d"), F.xxhash64(text).alias("h"), text.alias("text"))
    sizes = rows.select("d", "h", F.length("text").cast("bigint").alias("n")).groupBy("d", "h").agg(F.max("n").alias("n"), F.count("*").alias("rows"))
    sizes.write.parquet(f"{base}/sizes")
    sizes = spark.read.schema("d bigint, h bigint, n bigint, rows bigint").parquet(f"{base}/sizes")
    order = following(spark, sizes)
    order.write.parquet(f"{base}/order")
    order = spark.read.schema("d bigint, h bigint, n bigint, rows bigint, nd bigint, nh bigint").parquet(f"{base}/order")

    one_each = rows.select("d", "h", "text").groupBy("d", "h").agg(F.first("text").alias("text")) if sizes.filter("rows > 1").head(1) else rows.select("d", "h", "text")
    half = (F.col("n") / 2).cast("int")
    wanted = order.select(F.col("nd").alias("d"), F.col("nh").alias("h"), F.col("d").alias("pd"), F.col("h").alias("ph"), "n", "rows", half.alias("take"))
    heads = one_each.join(wanted, ["d", "h"]).select(F.col("pd").alias("d"), F.col("ph").alias("h"), "n", "rows", F.col("d").alias("nd"), F.col("h").alias("nh"), F.substr("text", F.lit(1), F.col("take")).alias("head"))
    keep = (F.length("text") - (F.length("text") / 2).cast("int")).cast("int")
    both = one_each.join(heads, ["d", "h"]).select("d", "h", "n", "rows", "nd", "nh", "text", F.concat(F.substr("text", F.lit(1), keep), "head").alias("edited"))
    made = both.select("d", "h", F.inline(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))))
    marks = fingerprints(spark, made, ["d", "h", "which"], samples)
    sums = both.select("d", "h", "n", "rows", "nd", "nh", F.sha2("edited", 256).alias("edited_sha256"))
    pair = lambda k: F.max(F.when(F.col("which") == k, F.col("f")))
    marks.groupBy("d", "h").agg(pair(0).alias("f"), pair(1).alias("g")).join(sums, ["d", "h"], "right").write.parquet(f"{base}/marks")
    marks = spark.read.schema("d bigint, h bigint, f array<double>, g array<double>, n bigint, rows bigint, nd bigint, nh bigint, edited_sha256 string").parquet(f"{base}/marks")
    after = marks.select(F.col("d").alias("nd"), F.col("h").alias("nh"), F.col("f").alias("next_f"))
    id_ = F.when(F.col("d") == LEAST, F.lit(None).cast("bigint")).otherwise(F.col("d")).alias("doc_id")
    out = marks.join(after, ["nd", "nh"]).select(
        id_, "rows", F.col("n").alias("n_chars"), "edited_sha256", shown("f", samples).alias("fingerprint"), shown("g", samples).alias("edited_fingerprint"),
        likeness("f", "g", samples).alias("near_edited"), likeness("f", "next_f", samples).alias("near_next"),
    )
    return out.select("*", F.explode(F.sequence(F.lit(1), "rows")).alias("_")).drop("_", "rows")
