"""The prefix trie of conversations, rolled up by bands of depth.

A node is a distinct sequence of first turns; its key is the exclusive or of 128-bit hashes of (depth, role, text), so
a node knows its parent's key by taking its own turn out again. Turns are numbered by one sort over ranges, and running
hashes are taken in stretches of ``STRETCH`` turns that are then chained, so a conversation of any length is spread
over tasks.

Sums over subtrees go by bands of ``HEIGHT`` depths: a node hands its values to its ancestors within the band alone, at
most ``HEIGHT`` rows. The sums of whole bands form a trie of their own, of the bands' roots, one ``HEIGHT``-th as deep,
which is rolled up the same way; its completed totals are then handed to the band above. So the number of rounds grows
with the logarithm of the depth and the rows by at most ``HEIGHT``.

Turns are ordered by number (null first), turns with the same number by a hash of role and text. Null role and text
count as empty; a text may be of any length, only its hash and size leave the first task. Repeated rows are turns of
their own. Rows without ``conv_id`` belong to no conversation. An empty table has no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicledger.session import scratch_dir

HEIGHT = 8
STRETCH = 512
HEADS = 9
SIBLINGS = 5
IDS_A_PIECE = 4096
_NODE = "struct<a:bigint,b:bigint>"


class _Tables:
    """Tables written to the shared folder and read again."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.n = spark, scratch_dir(spark, "trie"), 0

    def kept(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def numbered(tables: _Tables, conversations: DataFrame) -> DataFrame:
    """Turns as ``conv_id``, ``at`` (place among all rows, those of a conversation in a row), two hashes and ``n_bytes``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    hashes = F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit("turn"), text, role).alias("h2")
    turns = tables.kept(conversations.filter("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", *hashes, F.octet_length(text).cast("bigint").alias("n_bytes")))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "h1", "h2"]
    dealt = turns.withColumn("salt", F.rand(7)).repartitionByRange(*order, "salt").sortWithinPartitions(*order)
    rows = tables.kept(dealt.select("conv_id", "h1", "h2", "n_bytes", F.monotonically_increasing_id().alias("id")))
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each part written
    first = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return rows.withColumn("part", part).join(F.broadcast(first), "part").select("conv_id", (F.col("first") + place).alias("at"), "h1", "h2", "n_bytes")


def rebuilt(tables: _Tables, conversations: DataFrame, heads: int = HEADS, siblings: int = SIBLINGS) -> tuple[DataFrame, DataFrame]:
    """Turns ``(conv_id, depth, length, h1, h2, n_bytes)`` of conversations that share their first turns, and ``(conv_id, length)``.

    Conversation c begins with the first h turns of conversation c - c % ``siblings``, h being its hash modulo ``heads``.
    """
    turns = tables.kept(numbered(tables, conversations))
    own = turns.groupBy("conv_id").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % siblings
    own = tables.kept(own.withColumn("head", F.crc32(F.col("conv_id").cast("string")) % heads).withColumn("base", base))
    bases = own.filter(F.col("conv_id") == F.col("base")).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("head", F.coalesce("n_base", F.lit(0)))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    convs = tables.kept(own.join(bases, "base", "left").withColumn("taken", taken).withColumn("length", length).select("conv_id", "start", "head", "base", "taken", "length"))
    placed = tables.kept(turns.join(convs.drop("base"), "conv_id").withColumn("place", F.col("at") - F.col("start")).drop("at", "start"))
    rest = placed.filter("place >= head").select("conv_id", (F.col("taken") + F.col("place") - F.col("head") + 1).alias("depth"), "length", "h1", "h2", "n_bytes")
    shared = placed.filter(F.col("place") < heads - 1).filter(F.col("conv_id") % siblings == 0).select(F.col("conv_id").alias("base"), "place", "h1", "h2", "n_bytes")
    first = shared.join(convs.select("conv_id", "base", "head", "length"), "base").filter("place < head")
    return rest.union(first.select("conv_id", F.col("place") + 1, "length", "h1", "h2", "n_bytes")), convs.select("conv_id", "length")


def _xor(column: str, window: Window) -> Column:
    return F.coalesce(F.bit_xor(column).over(window), F.lit(0).cast("bigint"))


def _before(rows: DataFrame, top: int, stretch: int = STRETCH) -> DataFrame:
    """For rows ``(conv_id, i, x1, x2)`` with i up to ``top``, adds ``y1`` and ``y2``, the hashes of all rows in front."""
    rows = rows.withColumn("stretch", F.floor(F.col("i") / stretch))
    window = Window.partitionBy("conv_id", "stretch").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("y1", _xor("x1", window)).withColumn("y2", _xor("x2", window))
    if top < stretch:
        return local.drop("stretch")
    sums = rows.groupBy("conv_id", F.col("stretch").alias("i")).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    front = _before(sums, top // stretch, stretch).select("conv_id", F.col("i").alias("stretch"), F.col("y1").alias("f1"), F.col("y2").alias("f2"))
    joined = local.join(front, ["conv_id", "stretch"])
    return joined.withColumn("y1", F.col("y1").bitwiseXOR(F.col("f1"))).withColumn("y2", F.col("y2").bitwiseXOR(F.col("f2"))).drop("stretch", "f1", "f2")


def _node(a: Column | str, b: Column | str) -> Column:
    return F.struct(F.col(a).alias("a") if isinstance(a, str) else a.alias("a"), F.col(b).alias("b") if isinstance(b, str) else b.alias("b"))


def keyed(turns: DataFrame, top: int, height: int = HEIGHT, stretch: int = STRETCH) -> DataFrame:
    """Turns with the keys of their node (``a0``, ``b0``), its parent (``a1``, ``b1``) and the ancestors in its band."""
    terms = turns.withColumn("x1", F.xxhash64("h1", "h2", "depth")).withColumn("x2", F.xxhash64("h2", "depth", "h1")).drop("h1", "h2")
    rows = _before(terms.withColumn("i", F.col("depth")), top, stretch).withColumn("stretch", F.floor(F.col("depth") / stretch))
    window = Window.partitionBy("conv_id", "stretch").orderBy("depth")  # stretches hold whole bands
    ups = []
    for j in range(2, height):
        inside = F.col("depth") % height >= j
        for name, column in (("a", "y1"), ("b", "y2")):
            ups.append(F.when(inside, F.coalesce(F.lag(column, j - 1).over(window), F.lit(0))).otherwise(0).cast("bigint").alias(f"{name}{j}"))
    own = F.col("y1").bitwiseXOR(F.col("x1")).alias("a0"), F.col("y2").bitwiseXOR(F.col("x2")).alias("b0")
    return rows.select("conv_id", "depth", "length", "n_bytes", *own, F.col("y1").alias("a1"), F.col("y2").alias("b1"), *ups)


def _line(height: int) -> Column:
    """A node and its ancestors in its band, the nearest first."""
    return F.slice(F.array(*[_node(f"a{j}", f"b{j}") for j in range(height)]), F.lit(1), (F.col("depth") % height + 1).cast("int"))


def _with_lines(nodes: DataFrame, height: int) -> DataFrame:
    """Adds ``line`` to nodes that know their parent alone, by a join for each depth of the band."""
    link = nodes.select(F.col("node").alias("_at"), F.col("parent").alias("_next"))
    low = F.col("depth") % height
    lines = nodes.withColumn("line", F.when(low > 0, F.array("node", "parent")).otherwise(F.array("node")))
    for j in range(2, height):
        lines = lines.withColumn("_last", F.when(low >= j, F.element_at("line", -1))).join(link, F.col("_last") == F.col("_at"), "left")
        lines = lines.withColumn("line", F.when(F.col("_next").isNotNull(), F.array_append("line", F.col("_next"))).otherwise(F.col("line"))).drop("_last", "_at", "_next")
    return lines


def rolled_up(tables: _Tables, nodes: DataFrame, top: int, values: list[str], height: int = HEIGHT) -> DataFrame:
    """``node``, the sums of ``values`` over its subtree, and ``n_children``.

    ``nodes``: ``node``, ``parent`` (null at the root), ``depth`` up to ``top``, ``line`` and the values.
    """
    add = lambda df: df.groupBy("node").agg(*[F.sum(v).alias(v) for v in values], F.sum("child").alias("n_children"))
    child = (F.col("up") == 1).cast("bigint").alias("child")
    inside = nodes.select(*values, F.posexplode("line").alias("up", "node")).select("node", *values, child)
    if top < height:
        return add(inside)
    low = F.col("depth") % height
    above = nodes.filter(low == height - 1).select(F.col("node").alias("parent"), F.col("line").alias("hook"))
    hooks = tables.kept(nodes.filter((low == 0) & (F.col("depth") > 0)).select("node", "parent").join(above, "parent").select("node", "hook"))
    bands = nodes.groupBy(F.element_at("line", -1).alias("node")).agg(*[F.sum(v).alias(v) for v in values])
    places = nodes.filter(low == 0).select("node", F.floor(F.col("depth") / height).alias("depth"))
    upper = bands.join(places, "node").join(hooks, "node", "left").select("node", F.element_at("hook", -1).alias("parent"), "depth", *values)
    totals = rolled_up(tables, tables.kept(_with_lines(tables.kept(upper), height)), top // height, values, height)
    handed = hooks.join(totals.drop("n_children"), "node").select(*values, F.posexplode("hook").alias("up", "node"))
    return add(inside.union(handed.select("node", *values, (F.col("up") == 0).cast("bigint").alias("child"))))


def _pieces(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of one node after the other as comma-joined pieces of bounded size."""
    for batch in stream:
        if not batch.num_rows:
            continue
        a, b, ids = (batch.column(c).to_numpy() for c in ("a", "b", "conv_id"))
        starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        cuts = sorted({*starts.tolist(), *range(0, len(a), IDS_A_PIECE)})
        text = [",".join(map(str, ids[s:e].tolist())) for s, e in zip(cuts, [*cuts[1:], len(a)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(a[cuts]), pa.array(b[cuts]), pa.array(ids[cuts]), pa.array(text)], names=["a", "b", "first", "piece"])


def _hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's pieces, taken one after the other."""
    current, state = None, None
    of = lambda key, state: pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])], names=["a", "b", "ends_sha256"])
    for batch in stream:
        for a, b, piece in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "piece")), strict=True):
            if (a, b) == current:
                state.update(b"," + piece.encode())
                continue
            if current is not None:
                yield of(current, state)
            current, state = (a, b), hashlib.sha256(piece.encode())
    if current is not None:
        yield of(current, state)


def ends(rows: DataFrame) -> DataFrame:
    """``node`` and the hash of the ids of the conversations ``(a, b, conv_id)`` that end there, in ascending order.

    Ids are joined to pieces by tasks over ranges of (node, id); a node's task then hashes its pieces as they come.
    """
    pieces = rows.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInArrow(_pieces, "a bigint, b bigint, first bigint, piece string")
    hashed = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_hashed, "a bigint, b bigint, ends_sha256 string")
    return hashed.select(_node("a", "b").alias("node"), "ends_sha256")


def trie(spark: SparkSession, turns: DataFrame, convs: DataFrame, tables: _Tables | None = None, height: int = HEIGHT, stretch: int = STRETCH) -> DataFrame:
    """The nodes of the trie of ``turns`` (as :func:`rebuilt` gives them) of all ``convs`` (``conv_id``, ``length``).

    Per node: ``node`` (its key), ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    tables = tables or _Tables(spark)
    top = int(convs.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0])
    rows = tables.kept(keyed(turns, top, height, stretch))
    keys = [f"{c}{j}" for j in range(1, height) for c in "ab"]
    found = rows.groupBy("a0", "b0").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("length").alias("longest"), *[F.min(c).alias(c) for c in ["depth", "n_bytes", *keys]])
    zero = F.lit(0).cast("bigint")
    whole = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("length").alias("longest")).filter("n_convs > 0")
    root = whole.select(*[zero.alias(c) for c in ("a0", "b0")], "conv_id", "n_convs", "longest", *[zero.alias(c) for c in ["depth", "n_bytes", *keys]])
    saved = ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")
    leaf = (F.col("longest") == F.col("depth")).cast("bigint").alias("n_leaves")
    parent = F.when(F.col("depth") > 0, _node("a1", "b1")).alias("parent")
    nodes = tables.kept(found.unionByName(root).select(_node("a0", "b0").alias("node"), parent, "depth", _line(height).alias("line"), "conv_id", "n_convs", leaf, saved))
    totals = rolled_up(tables, nodes.select("node", "parent", "depth", "line", "n_leaves", "saved_tokens"), top, ["n_leaves", "saved_tokens"], height)
    at_root = convs.filter("length = 0").select(zero.alias("a"), zero.alias("b"), "conv_id")
    last = ends(rows.filter("depth = length").select(F.col("a0").alias("a"), F.col("b0").alias("b"), "conv_id").union(at_root))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = nodes.select("node", "parent", "conv_id", "depth", "n_convs").join(totals, "node").join(above, "parent", "left").join(last, "node", "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return named.select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def digests(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    tables = _Tables(spark)
    turns, convs = rebuilt(tables, conversations)
    return trie(spark, turns, convs, tables).drop("node")
