"""Secrets in texts, with multipart credentials linked by place. DataFrame and SQL functions only.

Strong parts stand alone: assignments to password-like names, access identifiers and long hex strings. Weak parts
(names of accounts, random-looking values, addresses of services) mean little; an interval join of parts within one
scope (a distance in the text) reports a weak part only if a complementary part is near: a value for a name or an
address, a name or an address for a value.

The text is read once. Matches and the gaps between them give places by running sums, in code points. Only matches
are shuffled, by row and by scope-sized bucket, so no more than the parts of neighbouring buckets meet.

Null texts are empty and have no parts; so have texts without matches. Repeated rows are searched each on its own.
Ties (parts with one start) are ordered by kind, as listed in ``KINDS``. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicledger.session import scratch_dir

SCOPE = 256
MASK = "[SECRET]"

#: Fixed patterns of the three strong kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
NAME = r"""(?i)\b(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
VALUE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9a-z+/_=-]*[A-Z])(?=[0-9A-Z+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}"
ADDRESS = r"""(?i)\b(?:https?|ftp|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+"""

#: Kind, pattern, class of the part, strong or not; in the order of ties.
KINDS = [
    ("assign", ASSIGN, "value", True),
    ("access", ACCESS, "name", True),
    ("hex", HEX, "value", True),
    ("linked_name", NAME, "name", False),
    ("linked_value", VALUE, "value", False),
    ("linked_address", ADDRESS, "address", False),
]
STRONG = sum(strong for *_, strong in KINDS)


def _matches(text: Column, pattern: str) -> Column:
    """Array of the matches, each with the length of the gap in front of it; null where there is none."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, F.lit(pattern), F.lit(-1)), F.length)
    return F.when(text.rlike(pattern), F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit"))))


def scan(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of every row as ``c0``, ``c1``, ..., a ``row`` number and the matches of each kind as ``m0``, ``m1``, ..."""
    text = F.coalesce("text", F.lit(""))
    kept = [F.col(c).alias(f"c{k}") for k, c in enumerate(columns)]
    return docs.select(F.monotonically_increasing_id().alias("row"), *kept, *[_matches(text, pattern).alias(f"m{k}") for k, (_, pattern, *_) in enumerate(KINDS)])


def _parts(found: DataFrame) -> DataFrame:
    """One row per part: ``row``, ``kind`` (its number), ``s`` and ``e`` (code points, end exclusive)."""
    listed = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"m{k}").alias("m")) for k in range(len(KINDS))])
    each = found.select("row", F.inline(listed)).filter("m is not null").select("row", "kind", F.posexplode("m").alias("i", "x"))
    length = F.length("x.hit")
    upto = Window.partitionBy("row", "kind").orderBy("i")
    placed = each.select("row", "kind", (F.sum(F.col("x.gap") + length).over(upto)).alias("e"), length.alias("n"), "x.hit")
    enough = F.when(F.col("kind") == 0, F.length(F.regexp_extract("hit", ASSIGN, 2)) >= 6).when(F.col("kind") == 1, F.col("n") >= 20).otherwise(F.lit(True))
    return placed.filter(enough).select("row", "kind", (F.col("e") - F.col("n")).alias("s"), "e")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts that a complementary part is near, and that no strong part overlaps."""
    classes = F.element_at(F.array(*[F.lit(c) for _, _, c, _ in KINDS]), F.col("kind") + 1)
    parts = parts.withColumn("class", classes)
    weak = parts.filter(F.col("kind") >= STRONG)
    # A part joins every bucket that it or its scope touches, so near parts meet wherever they begin.
    first, last = F.greatest(F.lit(0), F.floor((F.col("s") - scope) / scope)), F.floor((F.col("e") + scope) / scope)
    other = parts.select("row", F.col("kind").alias("k"), F.col("class").alias("c"), F.col("s").alias("a"), F.col("e").alias("b"), F.explode(F.sequence(first, last)).alias("bucket"))
    own = weak.withColumn("bucket", F.floor(F.col("s") / scope))
    near = (F.col("a") <= F.col("e") + scope) & (F.col("b") >= F.col("s") - scope)
    met = own.join(other, ["row", "bucket"]).filter(near & ~((F.col("k") == F.col("kind")) & (F.col("a") == F.col("s"))))
    overlaps = (F.col("k") < STRONG) & (F.col("a") < F.col("e")) & (F.col("s") < F.col("b"))
    fits = (F.col("c") != F.col("class")) & ((F.col("c") == "value") | (F.col("class") == "value"))
    judged = met.groupBy("row", "kind", "s", "e").agg(F.max(fits).alias("fits"), F.max(overlaps).alias("overlaps"))
    return judged.filter("fits and not overlaps").select("row", "kind", "s", "e")


def spans(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row with any: ``parts``, an array of (s, kind, e) in order. ``found`` is a written scan."""
    parts = _parts(found)
    every = parts.filter(F.col("kind") < STRONG).union(_linked(parts, scope))
    return every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("s", "kind", "e"))).alias("parts"))


def written(spark: SparkSession, docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    path = scratch_dir(spark, "secrets")
    rows = scan(docs, columns)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def digests(spark: SparkSession, docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document the numbers of strong parts, a checksum of them and all reported parts."""
    found = written(spark, docs, ("doc_id",))
    rows = found.select("row", F.col("c0").alias("doc_id")).join(spans(found, scope), "row", "left")
    parts = F.coalesce("parts", F.array().cast("array<struct<s:bigint,kind:int,e:bigint>>"))
    name = lambda p: F.element_at(F.array(*[F.lit(k) for k, *_ in KINDS]), p["kind"] + 1)
    shown = lambda p: F.concat_ws(":", name(p), p["s"].cast("string"), p["e"].cast("string"))
    joined = lambda a: F.array_join(F.transform(a, shown), ",")
    number = lambda k: F.size(F.filter(parts, lambda p: p["kind"] == k)).cast("bigint")
    base = joined(F.filter(parts, lambda p: p["kind"] < STRONG))
    return rows.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(parts).alias("spans"))


def redacted(spark: SparkSession, docs: DataFrame, scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """All rows and columns; reported parts of ``text`` are replaced by ``mask``, overlapping ones by one."""
    names = tuple(docs.columns)
    found = written(spark, docs, names)
    cells = [f"c{k}" for k in range(len(names))]
    any_ = functools.reduce(operator.or_, [F.col(f"m{k}").isNotNull() for k in range(len(KINDS))])
    touched = found.filter(any_).select("row", *cells).join(spans(found, scope), "row", "left")
    text = F.col(f"c{names.index('text')}")
    # A part keeps the text between the furthest end so far and its own start; parts inside others keep nothing.
    ends = F.transform("parts", lambda p: p["e"])
    far = lambda i: F.when(i > 0, F.array_max(F.slice(ends, 1, F.greatest(i, F.lit(1))))).otherwise(F.lit(0))
    before = F.transform("parts", lambda p, i: F.when(p["s"] >= far(i), F.concat(F.substr(text, (far(i) + 1).cast("int"), (p["s"] - far(i)).cast("int")), F.lit(mask))).otherwise(F.lit("")))
    rest = F.substr(text, (F.array_max(ends) + 1).cast("int"), F.length(text))
    masked = F.when(F.col("parts").isNotNull(), F.concat(F.array_join(before, ""), rest)).otherwise(text)
    new = lambda c: (masked if c == f"c{names.index('text')}" else F.col(c)).alias(names[cells.index(c)])
    untouched = found.filter(~any_).select(*[F.col(c).alias(n) for c, n in zip(cells, names, strict=True)])
    return untouched.union(touched.select(*[new(c) for c in cells]))
