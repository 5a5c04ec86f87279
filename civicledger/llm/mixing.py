"""Mixing sources to target weights by entropy balancing.

Every document gets a number of copies, 0 to ``MOST``. Among all laws of copies whose expected words per source equal
that source's target, entropy balancing takes the one closest (in relative entropy) to fair coin tosses, one for each
possible copy. Its solution tilts exponentially: a document of s words has the rate

    MOST * exp(t * s) / (1 + exp(t * s)),

with one multiplier t per source. Multipliers are the minimum of a convex dual, found by Newton steps that halve their
bracket where a step would leave it. Gradient and curvature are sums over documents; since a rate depends on source
and size alone, they are taken over the histogram of sizes, for all sources at once, and added up as whole numbers, so
that the order of sums can't change a result.

Rates are rounded into copies in three steps: within a source, sizes in falling order get the difference of the rounded
running sums of their rates (the error of a source is at most half its largest document); what remains is mended by
single copies, one size of each class (four in a power of two), the largest first; the copies of one size go to its documents evenly, in
the order of a hash. So two runs over the same rows agree.

Targets: sources in order of code points, null last, have weights 3, 1, 2, 3, 1, 2, ... and share 150 % of all words. A
target stops at ``MOST`` times its source's words; what is over goes to the others by weight, until none is above.

Null or empty texts have no words and are taken 0 times. Repeated rows are documents of their own; rows equal in id,
source and size are interchangeable. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicledger.llm.ranking import ranked
from civicledger.session import scratch_dir

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST = 2
#: Rates are whole numbers of 1 / UNIT copies once the multipliers are known.
UNIT = 1 << 20
STEPS = 60
#: A source is settled when its expected words differ from its target by less than this share of a word.
CLOSE = 0.01
BUCKETS = 64
#: Classes of sizes in a power of two.
CLASSES = 4


def sizes(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``source``, the number of words and a hash that orders documents of one size."""
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    return docs.select(F.col(key).alias("doc_id"), "source", words.alias("size"), F.xxhash64(F.lit("copies"), F.col(key), "text").alias("order"))


class _Tables:
    """Tables written to the shared folder and read again."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.n = spark, scratch_dir(spark, "mixing"), 0

    def kept(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def weighted(tables: _Tables, histogram: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources with their words ``total``, number ``k`` in order of code points (null last) and ``weight``.

    Sources are sorted by ranges and numbered by part; only the sizes of parts come together.
    """
    sums = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("total"))
    sorted_ = tables.kept(sums.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    parts = sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    first = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    numbered = sorted_.withColumn("part", part).join(F.broadcast(first), "part").withColumn("k", F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("k", F.lit(len(weights))) + 1).cast("int"))
    return tables.kept(numbered.select("source", "total", "k", weight.cast("bigint").alias("weight")))


def targets(sources: DataFrame, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target``. Each round fixes the sources that their share would lift above the limit; three sums a round."""
    whole = F.lit(0).cast("decimal(38,0)")
    spread = sources.agg(F.coalesce(F.sum(F.col("total").cast("decimal(38,0)")), whole)).first()[0]
    words, limit = share * int(spread), most * F.col("total").cast("decimal(38,0)")
    level, before = Fraction(0), None
    while level != before:
        before = level
        full = limit * level.denominator <= F.col("weight") * F.lit(level.numerator).cast("decimal(38,0)")
        sums = sources.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        if not sums[1]:
            break
        level = (words - int(sums[0] or 0)) / int(sums[1])
    own = F.col("weight") * F.lit(float(level.numerator)) / F.lit(float(level.denominator))
    return sources.withColumn("target", F.least(own.cast("double"), (most * F.col("total")).cast("double")))


def _rate(tilt: str, size: str, most: int):
    """Expected copies, without overflow on either side."""
    x = F.col(tilt) * F.col(size)
    small = F.exp(-F.abs(x))
    return F.when(x > 0, most / (1 + small)).otherwise(most * small / (1 + small))


def tilts(tables: _Tables, histogram: DataFrame, sources: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """``k`` and the multiplier ``tilt`` of every source, by Newton steps on the dual within a bracket.

    A target of all possible words has no finite multiplier; there the bracket's end gives the limit's rates. Steps
    start where documents of the mean size (weighted by words) would meet the target. One small table per step, a row a
    source; gradients are sums of whole numbers.
    """
    own = histogram.filter("size > 0")
    end = 45.0
    at_limit = F.col("target") >= most * F.col("total")
    mean = own.groupBy("k").agg((F.sum(F.col("size").cast("decimal(38,0)") * F.col("size") * F.col("n")).cast("double") / F.sum(F.col("size") * F.col("n"))).alias("mean"))
    share = F.col("target") / (most * F.col("total"))
    start = F.when(at_limit, end).otherwise(F.greatest(F.least(F.log(share / (1 - share)) / F.col("mean"), F.lit(end)), F.lit(-end)))
    state = sources.filter("total > 0").join(mean, "k").select("k", "target", start.alias("tilt"), F.lit(-end).alias("low"), F.lit(end).alias("high"), at_limit.alias("done"))
    state = tables.kept(state)
    exact = lambda c: F.sum(F.round(c * UNIT).cast("decimal(38,0)")).cast("double") / UNIT
    for _ in range(steps):
        rate = _rate("tilt", "size", most)
        slope = rate * (1 - rate / most) * F.col("size") * F.col("size")
        sums = own.join(state.filter("not done").select("k", "tilt"), "k").groupBy("k").agg(exact(rate * F.col("size") * F.col("n")).alias("words"), exact(slope * F.col("n")).alias("slope"))
        seen = state.join(sums, "k", "left").withColumn("over", F.col("words") - F.col("target"))
        done = F.col("done") | (F.abs("over") < CLOSE) | (F.col("high") - F.col("low") < 1e-13)
        low, high = F.when(F.col("over") < 0, F.col("tilt")).otherwise(F.col("low")), F.when(F.col("over") > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide("over", "slope")
        step = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        state = tables.kept(seen.select("k", "target", F.when(done, F.col("tilt")).otherwise(step).alias("tilt"), low.alias("low"), high.alias("high"), done.alias("done")))
        if not state.filter("not done").head(1):
            break
    return state.select("k", "tilt")


def _running(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the source's larger sizes, in two levels: classes of sizes, then within one."""
    classes = df.groupBy(*keys, "class").agg(F.sum(value).alias("_all"))
    above = Window.partitionBy(*keys).orderBy(F.col("class").desc()).rowsBetween(Window.unboundedPreceding, -1)
    fronts = classes.select(*keys, "class", F.coalesce(F.sum("_all").over(above), F.lit(0)).alias("_front"))
    within = Window.partitionBy(*keys, "class").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    own = df.withColumn("_own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return own.join(fronts, [*keys, "class"]).withColumn(name, F.col("_front") + F.col("_own")).drop("_front", "_own")


def bin_copies(tables: _Tables, histogram: DataFrame, sources: DataFrame, tilt: DataFrame, most: int = MOST) -> DataFrame:
    """``k``, ``size``, ``n`` and the whole number of ``copies`` of all documents of that source and size."""
    rate = F.round(_rate("tilt", "size", most) * UNIT).cast("bigint") * F.col("n")
    bins = histogram.filter("size > 0").join(tilt, "k").select("k", "size", "n", F.floor(F.log2("size") * CLASSES).cast("int").alias("class"), rate.alias("units"))
    bins = _running(tables.kept(bins), ["k"], "units", "front")
    rounded = lambda c: F.floor((c + UNIT // 2) / UNIT)
    bins = tables.kept(bins.withColumn("copies", rounded(F.col("front") + F.col("units")) - rounded(F.col("front"))).select("k", "size", "n", "class", "copies"))
    taken = bins.groupBy("k").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
    gap = sources.join(taken, "k").select("k", F.round(F.col("target") - F.col("taken")).cast("bigint").alias("gap"))
    room = F.when(F.col("gap") > 0, most * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
    spare = bins.join(gap.filter("gap <> 0"), "k").withColumn("room", room).filter("room > 0")
    largest = spare.groupBy("k", "gap", "class").agg(F.max(F.struct("room", "size")).alias("c"))
    chosen = largest.groupBy("k", "gap").agg(F.sort_array(F.collect_list(F.struct("c.size", "c.room")), asc=False).alias("sizes"))
    start = F.struct(F.abs("gap").alias("left"), F.array().cast("array<struct<size:bigint,change:bigint>>").alias("done"))

    def mend(state, c):
        change = F.least(c["room"], F.floor(state["left"] / c["size"]))
        own = F.struct(c["size"].alias("size"), change.alias("change"))
        return F.struct((state["left"] - change * c["size"]).alias("left"), F.array_append(state["done"], own).alias("done"))

    mended = chosen.select("k", F.signum("gap").cast("bigint").alias("sign"), F.inline(F.aggregate("sizes", start, mend)["done"])).select("k", "size", (F.col("sign") * F.col("change")).alias("change"))
    return bins.join(mended, ["k", "size"], "left").select("k", "size", "n", (F.col("copies") + F.coalesce("change", F.lit(0))).cast("bigint").alias("copies"))


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """Per document ``doc_id``, ``source``, ``size``, ``order`` (a hash of id and text), ``source_size``, ``target`` and ``copies``."""
    tables = _Tables(spark)
    sized = tables.kept(sizes(docs))
    counts = tables.kept(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = tables.kept(targets(weighted(tables, counts, weights), share, most))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    histogram = tables.kept(counts.alias("a").join(sources.select("source", "k").alias("b"), same).select("k", "size", "n"))
    bins = tables.kept(bin_copies(tables, histogram, sources, tilts(tables, histogram, sources, most), most))
    named = sources.select("source", "k", F.col("total").alias("source_size"), "target").alias("b")
    rows = sized.alias("a").join(named, same).select("doc_id", "a.source", "k", "size", "order", "source_size", "target")
    rows = tables.kept(rows.withColumn("bin", F.struct("k", "size")))
    places = ranked(rows, "bin", ["order", "doc_id"], "place", BUCKETS).join(bins, ["k", "size"], "left")
    copies = F.floor(F.col("copies") / F.col("n")) + (F.col("place") < F.col("copies") % F.col("n")).cast("int")
    return places.select("doc_id", "source", "size", "order", "source_size", "target", F.coalesce(copies, F.lit(0)).cast("int").alias("copies"))


def mixed(spark: SparkSession, docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: the columns of ``docs`` and ``copy_no`` (1, 2, ...), a row for every copy of every document.

    Rows equal in id and text are one document with the copies of all of them.
    """
    chosen = mix(spark, docs, **parameters).groupBy(F.col("doc_id").alias("_doc"), F.col("order").alias("_hash")).agg(F.sum("copies").cast("int").alias("_copies"))
    rows = docs.withColumn("_order", F.xxhash64(F.lit("copies"), F.col("doc_id"), "text")).dropDuplicates(["doc_id", "_order"])
    joined = rows.join(chosen.filter("_copies > 0"), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_order") == F.col("_hash")))
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy_no"))


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    chosen = mix(spark, docs)
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
