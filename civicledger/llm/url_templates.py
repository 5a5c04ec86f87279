"""Judges URLs by rules and, where none fits, by a tree of path templates per host.

Below each host a path segment is kept literally if it holds at least 1/``children`` of its parent's pages, or
``enough`` labelled ones, or if the share of good ones among its labelled pages differs significantly from that of its
siblings (Chernoff's bound, divided by the number of labelled siblings); digits only by their labels, of more than one
document. All other segments become wildcards by their shape (digits, digits with a suffix, anything). Below ``depth``
segments a template goes on as long as its labelled pages are both good and bad; otherwise the rest is one wildcard.
Sibling templates whose labelled shares don't differ
significantly are merged; those without labels join none and keep the prior. A template's purity is its share of good labelled pages, smoothed towards its host,
which is smoothed towards all pages; templates below ``least`` are blocked.

Null URLs and those without "://" have an empty host and path and the template of no segments. Pages without a label
count for the tree but not for purity; without any labels everything not blocked by a rule is allowed. Repeated pages
are judged each on its own. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import string

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.session import scratch_dir

#: Verdict, host and path. Fixed by the contract of the query.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
CHILDREN = 16
DEPTH = 8
SMOOTHING = 2.0
LEAST = 0.5
ALIKE_Z = 1.96
ENOUGH = 32
CHANCE = 0.05


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty if there are none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    pick = lambda value: F.coalesce(*[F.when(fits(h, p), F.lit(value(v, h, p))) for v, h, p in ordered], F.lit(None).cast("string"))
    return pick(lambda v, h, p: h + p), pick(lambda v, h, p: v)


def shape(segment: Column) -> Column:
    return F.when(segment.rlike(r"^[0-9]+$"), "{n}").when(segment.rlike(r"^[0-9]+\."), "{n}.*").otherwise("*")


def differs(chance: float = CHANCE) -> Column:
    """Whether ``_l`` labels, ``_g`` of them good, differ from the others of ``_la`` and ``_ga``, one of ``_m`` siblings."""
    good, bad = F.col("_g"), F.col("_l") - F.col("_g")
    rest = (F.col("_ga") - good + 1) / (F.col("_la") - F.col("_l") + 2)
    part = lambda n, share: F.when(n > 0, n * F.log(n / (F.col("_l") * share))).otherwise(0.0)
    return (F.col("_l") > 0) & (F.col("_la") > F.col("_l")) & (part(good, rest) + part(bad, 1 - rest) >= F.log(2 * F.col("_m") / chance))


def templates(spark: SparkSession, rows: DataFrame, children: int = CHILDREN, depth: int = DEPTH, enough: int = ENOUGH) -> DataFrame:
    """``rows`` (with ``host``, ``path``, ``doc_id`` and ``good``) and their ``template`` and its ``parent``."""
    base = scratch_dir(spark, "templates")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    at = kept(rows.withColumn("_segments", segments).withColumn("template", F.col("host")).withColumn("parent", F.lit("")), "0")
    labelled = lambda f: f(F.when(F.col("good").isNotNull(), F.col("doc_id")))
    k = 0
    while (at.agg(F.max(F.size("_segments"))).first()[0] or 0) > k:
        at = at.withColumn("_s", F.get("_segments", F.lit(k)))
        if k >= depth:
            # Only templates with good and bad pages go on.
            mixed = at.filter("_s is not null").groupBy("template").agg(F.min("good").alias("_low"), F.max("good").alias("_high")).filter("_low < _high").select("template", F.lit(True).alias("_open"))
            at = at.join(mixed, "template", "left")
            closed = F.col("_s").isNotNull() & F.col("_open").isNull()
            at = at.select(*rows.columns, F.when(closed, F.slice("_segments", 1, k)).otherwise(F.col("_segments")).alias("_segments"), F.when(closed, F.concat("template", F.lit("/**"))).otherwise(F.col("template")).alias("template"), "parent", F.when(~closed, F.col("_s")).alias("_s"))
        counts = at.filter("_s is not null").groupBy("template", "_s").agg(F.count("*").alias("_n"), F.coalesce(F.sum("good"), F.lit(0)).alias("_g"), F.count("good").alias("_l"), (labelled(F.min) < labelled(F.max)).alias("_several"))
        wholes = counts.groupBy("template").agg(F.sum("_n").alias("_all"), F.sum("_g").alias("_ga"), F.sum("_l").alias("_la"), F.sum(F.signum("_l")).alias("_m"))
        many = (F.col("_n") * children >= F.col("_all")) & ~F.col("_s").rlike(r"^[0-9]+(\.|$)")
        told = F.coalesce("_several", F.lit(False)) & ((F.col("_l") >= enough) | differs())
        literal = counts.join(wholes, "template").filter(many | told).select("template", "_s", F.col("_s").alias("_literal"))
        step = at.join(literal, ["template", "_s"], "left")
        token = F.coalesce("_literal", shape(F.col("_s")))
        longer = F.col("_s").isNotNull()
        at = step.select(*rows.columns, "_segments", F.when(longer, F.concat_ws("/", "template", token)).otherwise(F.col("template")).alias("template"), F.when(longer, F.col("template")).otherwise(F.col("parent")).alias("parent"))
        k += 1
        at = kept(at, str(k))
    return at.drop("_segments")


def _merge(parent: pd.DataFrame) -> pd.DataFrame:
    """Numbers the groups of labelled siblings whose shares are alike; the labels bound the number of siblings."""
    own = parent.assign(rate=(parent.good + 1) / (parent.labelled + 2)).sort_values(["rate", "template"])
    group, good, labelled, numbers = -1, 0.0, 0.0, []
    for row in own.itertuples():
        pooled = (good + row.good) / max(1.0, labelled + row.labelled)
        spread = math.sqrt(max(1e-9, pooled * (1 - pooled)) * (1 / max(1.0, labelled) + 1 / row.labelled))
        if group < 0 or abs(row.good / row.labelled - good / max(1.0, labelled)) > ALIKE_Z * spread:
            group, good, labelled = group + 1, 0.0, 0.0
        good, labelled = good + row.good, labelled + row.labelled
        numbers.append(group)
    return own.assign(branch=numbers)[["host", "parent", "template", "good", "labelled", "branch"]]


def purities(tagged: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """``host``, ``template`` and ``purity`` of its merged branch. ``tagged`` has ``good`` (0 or 1, null: unknown)."""
    one = tagged.groupBy("host", "parent", "template").agg(F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good"), F.count("good").cast("double").alias("labelled"))
    merged = one.filter("labelled > 0").groupBy("host", "parent").applyInPandas(_merge, "host string, parent string, template string, good double, labelled double, branch int")
    merged = merged.union(one.filter("labelled = 0").select("host", "parent", "template", "good", "labelled", F.lit(-1)))
    total = tagged.agg(F.avg("good")).first()[0]
    overall = 1.0 if total is None else float(total)
    smooth = lambda good, all_, prior: (good + smoothing * prior) / (all_ + smoothing)
    hosts = one.groupBy("host").agg(F.sum("good").alias("_g"), F.sum("labelled").alias("_l")).select("host", smooth(F.col("_g"), F.col("_l"), F.lit(overall)).alias("_host"))
    branches = merged.groupBy("host", "parent", "branch").agg(F.sum("good").alias("_g"), F.sum("labelled").alias("_l"))
    found = merged.select("host", "parent", "template", "branch").join(branches, ["host", "parent", "branch"]).join(hosts, "host")
    return found.select("host", "parent", "template", smooth(F.col("_g"), F.col("_l"), F.col("_host")).alias("purity"))


def judged(spark: SparkSession, pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, least: float = LEAST) -> DataFrame:
    """Every page's host, path, rule, verdict, template and purity.

    A page's label is the quality of the document whose id is the number in the last segment of its path.
    """
    host, path = parsed(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    number = F.regexp_extract("path", r"([0-9]{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    tagged = templates(spark, rows.withColumn("doc_id", F.when(number != "", number).cast("bigint")).join(known, "doc_id", "left"))
    found = tagged.join(purities(tagged), ["host", "parent", "template"])
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    return found.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("purity") < least, "block").otherwise("allow")).alias("verdict"), "template", "purity")
