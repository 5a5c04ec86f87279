"""Exact Jaccard join of word shingles by PartEnum signatures.

A set of s features and one of t features (s <= t) with Jaccard similarity 0.8 or more differ in (s + t) / 9 features
at most. Sets are banded by size, a band reaching to four times the one before; a set that may have a larger partner
in the next band joins that band too. In a band the feature domain is dealt into n cells. Two similar sets agree on all
but k of their cells, so if each enumerates k + 1 cells chosen by their content alone (those with the most features
first), they share at least one: the choice orders cells the same way in both, and of the k + 1 cells of the set whose
choice reaches less far down, at least one is the same in the other, which then has chosen it too. The hash of such a
cell is a signature.

Sets that share a signature are compared in two steps, so that a group of near copies isn't compared pair by pair:
each with the first of its bucket, then, in buckets that still hold several components, those outside the largest
component with the others. The second step first compares parities: each feature flips one bit of its set's sketch, so
two sets differ in at least as many features as their sketches in bits. Rows with a partner that may be similar leave
the bucket, in groups; the sets of a group then come together and are compared exactly, on 64-bit shingle hashes,
unless links already join them, and only the links that joined two parts are passed on: fewer than rows. Large buckets
and groups are cut into blocks, and pairs of blocks are compared apart.

Null and empty texts, and texts without words, have no shingles and no links. Rows that share an id are one document
with the links of each. A row without an id has no links and no component. Ties don't arise. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicledger.llm import prefilter
from civicledger.llm import textbytes as tb
from civicledger.llm.components import components
from civicledger.session import scratch_dir

WORDS = 5
SLOT_BITS = 22
SLOT_SHIFT = np.uint64(64 - SLOT_BITS)
#: Sizes of sets and the bits of their sketches; beyond the last size the last number of bits.
SKETCHES = [(256, 512), (1024, 2048), (4096, 8192)]
BLOCK = 4096
#: Features that a block of rows to be compared exactly has at most, but for one row with more.
BLOCK_FEATURES = 1 << 20
#: Share of a task's documents, and their number, from which a slot of features is counted.
OFTEN, LEAST_OFTEN = 0.002, 8
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; one hash of all words if there are fewer than ``words``."""
    hashed, first = tb.lowered_words(column, tb.NOT_SPACE)
    rolled = hashed[: max(0, len(hashed) - words + 1)].copy()
    for k in range(1, words):
        rolled = rolled * _STEP + hashed[k : len(hashed) - words + 1 + k]
    rolled = tb.mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for x in hashed[a:b]:
                whole = tb.mix(whole * _STEP + x)
            yield whole
        else:
            yield np.empty(0, np.uint64)


def band(size: int) -> int:
    """The first band that holds sets of this size."""
    level = 0
    while 4**level < size:
        level += 1
    return level


def signatures(features: np.ndarray, rarity: np.ndarray | None = None) -> np.ndarray:
    """Signatures of one set: in each of its bands, the cells it enumerates. ``rarity``: of each slot of features."""
    size, out = len(features), []
    if not size:
        return np.empty(0, np.uint64)
    partner = size * 5 // 4
    weight = np.ones(size, np.int64) if rarity is None else rarity[(features >> SLOT_SHIFT).astype(np.int64)].astype(np.int64)
    for level in sorted({band(size), band(partner)}):
        top = 4**level
        differ = (size + min(partner, top)) // 9
        cells = -(-5 * (2 * top // 9 + 1) // 4)
        spread = tb.mix(features + np.uint64((level + 1) * int(_STEP) & (1 << 64) - 1))
        cell = ((spread >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0])
        filled = cell[order][starts]
        count = np.diff(np.r_[starts, size])
        content = np.add.reduceat(tb.mix(spread)[order], starts)
        score = np.add.reduceat(weight[order], starts)
        if len(filled) <= differ:
            empty = np.setdiff1d(np.arange(cells), filled)
            filled, count, content = np.r_[filled, empty], np.r_[count, np.zeros(len(empty), np.int64)], np.r_[content, np.zeros(len(empty), np.uint64)]
            score = np.r_[score, np.zeros(len(empty), np.int64)]
        name = tb.mix(content + tb.mix((filled * 64 + level).astype(np.uint64)) + count.astype(np.uint64))
        chosen = np.lexsort((name, -score))[: differ + 1]
        out.append(name[chosen])
    return np.concatenate(out)


def parities(features: np.ndarray) -> bytes:
    """A sketch in which every feature flips one bit; larger sets have longer ones."""
    bits = next((b for most, b in SKETCHES if len(features) <= most), SKETCHES[-1][1])
    set_ = np.bincount((tb.mix(features) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(set_.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """The same parities with fewer bits."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def near_pairs(n: np.ndarray, c: np.ndarray, minor: np.ndarray, side: np.ndarray, sketches: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of a bucket that may be similar, of two components, not both of the largest, and of different sides.

    They come in portions of bounded size.
    """
    width = np.array([len(x) // 8 for x in sketches])
    for low in np.unique(width):
        for high in np.unique(width[width >= low]):
            one, two = np.flatnonzero(width == low), np.flatnonzero(width == high)
            a, b = (_folded(np.frombuffer(b"".join([sketches[i] for i in rows]), np.uint64).reshape(len(rows), -1), int(low)) for rows in (one, two))
            step = max(1, (1 << 21) // max(1, len(two) * int(low)))
            for at in range(0, len(one), step):
                i, j = one[at : at + step, None], two[None, :]
                fits = (c[i] != c[j]) & (minor[i] | minor[j]) & ((side[i] != side[j]) | (side[i] < 0)) & (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j]))
                if low == high:
                    fits &= i < j
                x, y = np.nonzero(fits)
                for k in range(0, len(x), 1 << 17):
                    p, q = x[k : k + (1 << 17)], y[k : k + (1 << 17)]
                    differ = np.bitwise_count(a[at + p] ^ b[q]).sum(axis=1, dtype=np.int64)
                    good = 9 * differ <= n[one[at + p]] + n[two[q]]
                    if good.any():
                        yield one[at + p[good]], two[q[good]]


def united(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest place that each place is joined with, given what it was so far and further pairs."""
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            return root
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _stretches(stream: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Sorted rows as tables that hold whole groups of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in stream:
        if not batch.num_rows:
            continue
        held.append(batch)
        t = pa.Table.from_batches(held).combine_chunks()
        last = _starts(t, keys)[-1]
        if last:
            yield t.slice(0, last).combine_chunks()
        held = t.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(t: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    columns = np.stack([t.column(x).to_numpy() for x in keys])
    return np.flatnonzero(np.r_[True, (columns[:, 1:] != columns[:, :-1]).any(axis=0)])


_DEALT = ("s", "i", "j")


def _near_groups(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of bucket and pair of blocks, those with a partner that may be similar.

    They come once each, with a group: rows of the part that such partners connect. A group is named by its members, so
    that one that several buckets find is one; its size is bounded by that of a pair of blocks.
    """
    for t in _stretches(stream, _DEALT):
        keys = np.stack([t.column(x).to_numpy() for x in _DEALT])
        doc, n, c, major, block = (t.column(x).to_numpy() for x in ("doc_id", "n", "c", "major", "block"))
        sketches = t.column("sketch").to_pylist()
        starts = _starts(t, _DEALT)
        found = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows], strict=True):
            side = block[a:b] if keys[1, a] != keys[2, a] else np.full(b - a, -1)
            root, paired = np.arange(b - a), np.zeros(b - a, bool)
            for u, v in near_pairs(n[a:b], c[a:b], c[a:b] != major[a:b], side, sketches[a:b]):
                paired[u] = paired[v] = True
                root = united(root, u, v)
            at = np.flatnonzero(paired)
            name, size = np.zeros(b - a, np.uint64), np.bincount(root[at], minlength=b - a)
            np.bitwise_xor.at(name, root[at], tb.mix(doc[a:b][at].astype(np.uint64)))
            group = tb.mix(name + tb.mix(size.astype(np.uint64)))[root[at]]
            found.append(np.stack([group.view(np.int64), doc[a:b][at], n[a:b][at], c[a:b][at]]))
        rows = np.concatenate(found, axis=1)
        rows = np.unique(rows, axis=1) if rows.size else rows
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["s", "doc_id", "n", "c"])


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= 80 * (len(a) + len(b) - shared)


def _links(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of similar rows that connect all that are linked, over rows in order of group and pair of blocks.

    Every pair of two components that may be similar is compared exactly unless links found before have joined them; so
    fewer pairs come out than rows went in, and none is missing from what they connect.
    """
    for t in _stretches(stream, _DEALT):
        keys = np.stack([t.column(x).to_numpy() for x in _DEALT])
        doc, c, block = (t.column(x).to_numpy() for x in ("doc_id", "c", "block"))
        starts, out = _starts(t, _DEALT), []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows], strict=True):
            sets = [x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in t.column("features").slice(a, b - a)]
            side = block[a:b] if keys[1, a] != keys[2, a] else np.full(b - a, -1)
            _, own = np.unique(c[a:b], return_inverse=True)
            first = np.full(own.max() + 1, b - a)
            np.minimum.at(first, own, np.arange(b - a))
            root = first[own]  # rows of one component are joined from the start
            sizes = np.array([len(x) for x in sets])
            for u, v in near_pairs(sizes, own, np.ones(b - a, bool), side, [parities(x) for x in sets]):
                while len(u):
                    for x, y in zip(u[:32].tolist(), v[:32].tolist(), strict=True):
                        if root[x] != root[y] and _similar(sets[x], sets[y]):
                            out.append((max(doc[a + x], doc[a + y]), min(doc[a + x], doc[a + y])))
                            root[root == max(root[x], root[y])] = min(root[x], root[y])
                    apart = root[u[32:]] != root[v[32:]]
                    u, v = u[32:][apart], v[32:][apart]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def _often(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots of features that many documents of this task have, and (slot -1) the number of its documents."""
    counts, n = np.zeros(1 << SLOT_BITS, np.int32), 0
    for batch in tb.batches(stream):
        for features in shingle_sets(batch.column("text")):
            slot = (features >> SLOT_SHIFT).astype(np.int64)
            counts[slot] += 1  # a repeated slot of one document counts once
        n += batch.num_rows
    slots = np.flatnonzero(counts >= max(LEAST_OFTEN, OFTEN * n))
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[slots, -1]), pa.array(np.r_[counts[slots], n].astype(np.int64))], names=["slot", "n"])


def rarities(docs: DataFrame) -> np.ndarray:
    """For each slot of features minus the binary logarithm of the share of documents that have one, 16 if few do."""
    found = docs.select("text").mapInArrow(_often, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = (found.column(c).to_numpy() for c in ("slot", "n"))
    rarity = np.full(1 << SLOT_BITS, 16, np.uint8)
    total = max(1, int(n[slot == -1].sum()))
    rarity[slot[slot >= 0]] = np.clip(np.round(-np.log2(n[slot >= 0] / total)), 0, 15)
    return rarity


def _signed(rarity: Broadcast):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.batches(stream):
            sizes, same, lists, sketches, seen = [], [], [], [], {}
            for doc, features in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text")), strict=True):
                sizes.append(len(features))
                print_ = (len(features), int(features.sum()), int(np.bitwise_xor.reduce(features))) if len(features) else None
                first = None if doc is None or print_ is None else seen.setdefault(print_, doc)
                same.append(None if first == doc else first)
                sketches.append(parities(features))
                lists.append(signatures(features, rarity.value) if first is not None and first == doc else np.empty(0, np.uint64))
            ends = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int32)
            flat = np.concatenate(lists).view(np.int64) if lists else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(same, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(sketches, pa.binary())], names=["doc_id", "n", "same", "signatures", "sketch"]
            )

    return run


def _sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tb.batches(stream):
        sets = list(shingle_sets(batch.column("text")))
        ends = np.r_[0, np.cumsum([len(x) for x in sets])].astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))], names=["doc_id", "features"])


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (``u``, ``v``) whose shingle sets are similar enough."""
    ids = pairs.select(F.col("u").alias("doc_id")).union(pairs.select(F.col("v").alias("doc_id"))).distinct()
    sets = prefilter.split(docs.select("doc_id", "text"), "doc_id", ids)[0].mapInArrow(_sets, "doc_id bigint, features array<bigint>")
    one, two = (sets.select(F.col("doc_id").alias(c), F.col("features").alias(f"_{c}")) for c in "uv")
    both = pairs.join(one, "u").join(two, "v")
    shared = F.size(F.array_intersect("_u", "_v"))
    return both.withColumn("_s", shared).filter(F.col("_s") * 100 >= (F.size("_u") + F.size("_v") - F.col("_s")) * 80).select("u", "v")


def _close(a: str, b: str):
    """Sizes that similar sets can have."""
    return F.greatest(a, b) * 4 <= F.least(a, b) * 5


def groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: ``n_shingles`` and ``component_id``, the smallest id that links lead to."""
    base = scratch_dir(spark, "partenum")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    docs = docs.select("doc_id", "text")
    rarity = spark.sparkContext.broadcast(rarities(docs))
    signed = kept(docs.mapInArrow(_signed(rarity), "doc_id bigint, n bigint, same bigint, signatures array<bigint>, sketch binary"), "signed")
    bucket = Window.partitionBy("s")
    rows = signed.select("doc_id", "n", F.explode("signatures").alias("s"))
    full = rows.withColumn("first", F.min(F.struct("doc_id", "n")).over(bucket)).withColumn("last", F.max("doc_id").over(bucket))
    # Similar sets share many signatures. Buckets with the same members become one, named by a hash of them; should
    # two others get one name, they are compared together, which only adds comparisons.
    members = F.xxhash64(F.expr("bit_xor(xxhash64(doc_id))").over(bucket), F.count("*").over(bucket))
    shared = full.withColumn("members", members).filter("first.doc_id < last")
    live = kept(shared.select(F.col("members").alias("s"), "doc_id", "n", F.col("first.doc_id").alias("head"), F.col("first.n").alias("head_n")).distinct(), "live")
    equal = signed.filter("same is not null").select(F.col("doc_id").alias("u"), F.col("same").alias("v"))
    tried = kept(live.filter("doc_id != head").filter(_close("n", "head_n")).select(F.col("doc_id").alias("u"), F.col("head").alias("v")).distinct(), "tried")
    links = kept(verified(docs, tried).union(equal).distinct(), "links")
    found = components(spark, links)

    placed = live.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("s", "doc_id", "n", F.coalesce("root", "doc_id").alias("c"))
    open_ = placed.withColumn("a", F.min("c").over(bucket)).withColumn("b", F.max("c").over(bucket)).filter("a < b").select("s", "doc_id", "n", "c")
    sized = open_.groupBy("s", "c").agg(F.count("*").alias("k")).groupBy("s").agg(F.max(F.struct("k", "c")).alias("most"), F.sum("k").alias("rows"))
    open_ = kept(open_.join(sized.select("s", F.col("most.c").alias("major"), F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")), "s"), "open")
    sketches = signed.filter("size(signatures) > 0").select("doc_id", "sketch")

    def dealt(rows: DataFrame, each: DataFrame, columns: list[str]) -> DataFrame:
        """Rows of a bucket or group, in blocks, once for each pair of blocks, with what is known of each document."""
        own = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
        pairs = own.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = pairs.select("*", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j")).join(each, "doc_id")
        return placed.select(*columns).repartition("s", "i", "j").sortWithinPartitions("s", "i", "j")

    near = dealt(open_, sketches, ["s", "i", "j", "block", "doc_id", "n", "c", "major", "sketch"]).mapInArrow(_near_groups, "s bigint, doc_id bigint, n bigint, c bigint")
    near = kept(near.distinct(), "near")
    large = near.groupBy("s").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_FEATURES)).cast("int").alias("blocks"))
    sets = prefilter.split(docs.filter("doc_id is not null"), "doc_id", near.select("doc_id").distinct())[0].mapInArrow(_sets, "doc_id bigint, features array<bigint>")
    checked = dealt(near.join(large, "s"), sets, ["s", "i", "j", "block", "doc_id", "c", "features"]).mapInArrow(_links, "u bigint, v bigint")
    more = kept(checked.distinct(), "more")
    root = (components(spark, found.toDF("u", "v").union(more)) if more.head(1) else found).withColumnRenamed("node", "doc_id")
    return signed.select("doc_id", "n").join(root, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))
