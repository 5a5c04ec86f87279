"""Removes every byte that a string of ``depth`` bytes covers which also starts earlier in the corpus.

All windows of ``depth`` bytes are ordered most significant digit first, and no deeper than that: groups that are
equal at the end are exactly the repeated windows. The first digit is a window's anchor, the k-gram in it with the
smallest hash: equal windows have equal anchors at equal places, and neighbouring windows mostly share one, so one row
stands for a run of windows (a stretch). Stretches are dealt out by anchor. A stretch whose anchor occurs nowhere else
is done; one that is equal to an earlier stretch as a whole is repeated as a whole. Only the others have their bytes
fetched, and their windows go through passes of further digits, in which single windows drop out. A digit is a block
of bytes coded by a 64-bit hash.

Anchors with more than ``hot`` different stretches, which a common passage has at its edges, take the same digits at
once through a hash aggregation, which combines before the shuffle; results are the same.

Order is that of ``doc_id`` (null first), then of the start. Null texts are empty; texts shorter than ``depth`` lose
nothing. Rows that share an id are told apart, and ordered, by a 64-bit hash of their text; rows equal in both are one
document and get equal results, one each. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicledger.llm import prefilter
from civicledger.llm import textbytes as tb
from civicledger.session import scratch_dir

DEPTH = 100
GRAM = 24
BLOCK = 25
HOT = 50_000
GROUP_ROWS = 20_000

_STRETCH = "anchor bigint, whole bigint, d bigint, h bigint, pos bigint"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def stretches(data: np.ndarray, offsets: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with a common anchor: text number, first and last start, anchor place, hashes of anchor and bytes."""
    none = np.empty(0, np.int64)
    if len(data) < depth:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    running = tb.prefix(data)
    place = np.arange(len(data) - gram + 1)
    grams = tb.cut(running, place, place + gram)
    least = sliding_least((grams & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64), depth - gram + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.maximum(np.diff(offsets) - depth + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    start = np.repeat(offsets[:-1], sizes) + tb.ranges(sizes)
    if not len(start):
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    anchor = anchor[start]
    first = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(text) != 0)])
    last = np.r_[first[1:], len(start)] - 1
    a, b, p, text = start[first], start[last], anchor[first], text[first]
    whole = tb.mix(tb.cut(running, a, b + depth) + ((p - a) * 256 + (b - a)).astype(np.uint64) * tb._PRIME)
    return text, a, b, p, grams[p], whole


def _packed(a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
    """First start, anchor and last start behind it (8 bits each): ordered by start."""
    return (a << 16) | ((p - a) << 8) | (b - a)


def _same(*columns: np.ndarray) -> np.ndarray:
    """Whether each row equals the one before it."""
    same = np.ones(len(columns[0]), bool)
    same[:1] = False
    for x in columns:
        same[1:] &= x[1:] == x[:-1]
    return same


def _stretch(depth: int, gram: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.batches(stream):
            data, offsets = tb.buffer(batch.column("text"))
            text, a, b, p, anchor, whole = stretches(data, offsets, depth, gram)
            d = batch.column("d").to_numpy(zero_copy_only=False)[text]
            h = batch.column("h").to_numpy(zero_copy_only=False)[text]
            base = offsets[text]
            pos = _packed(a - base, b - base, p - base)
            # Of equal stretches in one batch only the first can be the first of all.
            order = np.lexsort((pos, h, d, whole, anchor))
            anchor, whole, d, h, pos = (x[order] for x in (anchor, whole, d, h, pos))
            # Rows equal in id and text are one document, whose stretches don't repeat each other.
            once = ~_same(anchor, whole, d, h, pos)
            anchor, whole, d, h, pos = (x[once] for x in (anchor, whole, d, h, pos))
            again = _same(anchor, whole)
            # Odd anchors: known to be repeated, each on its own.
            anchor = np.where(again, tb.mix(tb.mix(d.view(np.uint64) * tb._PRIME + h.view(np.uint64)) + pos.view(np.uint64)) | np.uint64(1), anchor & ~np.uint64(1))
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(d), pa.array(h), pa.array(pos)], names=["anchor", "whole", "d", "h", "pos"])

    return run


def _fetch(depth: int):
    """The bytes of the listed stretches of each text."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.batches(stream):
            data, offsets = tb.buffer(batch.column("text"))
            raw, out = data.tobytes(), {"anchor": [], "d": [], "h": [], "pos": [], "bytes": []}
            for k, (d, h, listed) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("d", "h", "listed")), strict=True)):
                for one in listed:
                    pos = one["pos"]
                    start = int(offsets[k]) + (pos >> 16)
                    out["anchor"].append(one["anchor"])
                    out["d"].append(d)
                    out["h"].append(h)
                    out["pos"].append(pos)
                    out["bytes"].append(raw[start : start + (pos & 0xFF) + depth])
            yield pa.RecordBatch.from_arrays([pa.array(out["anchor"], pa.int64()), pa.array(out["d"], pa.int64()), pa.array(out["h"], pa.int64()), pa.array(out["pos"], pa.int64()), pa.array(out["bytes"], pa.binary())], names=list(out))

    return run


def _windows(column: pa.Array, pos: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the windows of some stretches: stretch, place in it, place of the anchor, and the digits."""
    data, offsets = tb.buffer(column)
    running = tb.prefix(data)
    counts = (pos & 0xFF) + 1
    row, place = np.repeat(np.arange(len(pos)), counts), tb.ranges(counts)
    start = offsets[row] + place
    digits = [tb.cut(running, start + at, np.minimum(start + at + BLOCK, start + depth)) for at in range(0, depth, BLOCK)]
    return row, place, ((pos >> 8) & 0xFF)[row] - place, digits


def repeated(groups: np.ndarray, digits: list[np.ndarray]) -> np.ndarray:
    """Windows that equal an earlier one of their group, by passes from the first digit on."""
    live = np.arange(len(groups))
    for digit in [None, *digits]:
        if not len(live):
            return live
        key = groups if digit is None else digit[live]
        order = np.argsort(key, kind="stable") if digit is None else np.lexsort((key, groups))
        key, groups, live = key[order], groups[order], live[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (groups[1:] != groups[:-1])]
        alone = new & np.r_[new[1:], True]
        groups = np.cumsum(new)[~alone]
        live = live[~alone]
    return live[np.r_[False, groups[1:] == groups[:-1]]] if len(live) else live


def _spans(row: np.ndarray, place: np.ndarray, d: np.ndarray, h: np.ndarray, pos: np.ndarray, depth: int) -> pa.RecordBatch:
    """The repeated windows of a stretch overlap: one span from the first to the end of the last."""
    order = np.lexsort((place, row))
    row, place = row[order], place[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
    last = np.r_[first[1:], len(row)] - 1 if len(row) else first
    own = row[first]
    a = pos[own] >> 16
    return pa.RecordBatch.from_arrays([pa.array(d[own]), pa.array(h[own]), pa.array(a + place[first]), pa.array(a + place[last] + depth)], names=["d", "h", "s", "e"])


def _radix(depth: int, most: int):
    """Over stretches in order of anchor, id and place."""

    def flush(batches: list[pa.RecordBatch], end: int | None) -> tuple[pa.RecordBatch, list[pa.RecordBatch]]:
        table = pa.Table.from_batches(batches).combine_chunks()
        anchor = table.column("anchor").to_numpy()
        cut = len(anchor) if end is None else int(np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])[-1])
        own = table.slice(0, cut).combine_chunks()
        rest = table.slice(cut).combine_chunks().to_batches()
        # Rows equal in id and text bring the same stretches, next to each other.
        again = _same(*(own.column(c).to_numpy() for c in ("anchor", "d", "h", "pos")))
        if again.any():
            own, anchor = own.filter(pa.array(~again)).combine_chunks(), anchor[:cut][~again]
        d, h, pos = (own.column(c).to_numpy() for c in ("d", "h", "pos"))
        column = own.column("bytes").combine_chunks() if own.num_rows else pa.array([], pa.binary())
        row, place, before, digits = _windows(column, pos, depth)
        first = np.cumsum(np.r_[0, np.diff(anchor[: own.num_rows]) != 0]) if cut else np.empty(0, np.int64)
        found = repeated(first[row] * 256 + before, digits)
        return _spans(row[found], place[found], d, h, pos, depth), rest

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in stream:
            for at in range(0, batch.num_rows, most):
                held.append(batch.slice(at, most))
                if sum(b.num_rows for b in held) >= most and held[0].column("anchor")[0].as_py() != held[-1].column("anchor")[-1].as_py():
                    out, held = flush(held, 1)
                    yield out
        if held:
            yield flush(held, None)[0]

    return run


def _hot(depth: int):
    """All digits of each window, folded to 128 bits."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for at in range(0, whole.num_rows, GROUP_ROWS):
                batch = whole.slice(at, GROUP_ROWS)
                d, h, pos = (batch.column(c).to_numpy() for c in ("d", "h", "pos"))
                row, place, _, digits = _windows(batch.column("bytes"), pos, depth)
                one, two = np.zeros(len(row), np.uint64), np.zeros(len(row), np.uint64)
                for digit in digits:
                    one, two = tb.mix(one + digit), tb.mix(two * tb._PRIME + digit)
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(d[row]), pa.array(h[row]), pa.array((pos[row] >> 16) + place)], names=["one", "two", "d", "h", "at"])

    return run


def _remove(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tb.batches(stream):
        data, offsets = tb.buffer(batch.column("text"))
        out = []
        for k, listed in enumerate(batch.column("listed").to_pylist()):
            own = data[offsets[k] : offsets[k + 1]]
            edge = np.zeros(len(own) + 1, np.int64)
            if listed:
                edge += np.bincount([x["s"] for x in listed], minlength=len(edge))
                edge -= np.bincount([x["e"] for x in listed], minlength=len(edge))
            gone = np.cumsum(edge)[:-1] > 0
            out.append((len(own), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum()), own[~gone].tobytes()))
        n, removed, spans, kept = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def repeats(spark: SparkSession, docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Spans to remove: ``d``, ``h`` (the row's key), ``s`` and ``e`` (bytes, end exclusive); they may overlap."""
    base = scratch_dir(spark, "radix")
    rows = once(spark, keyed(docs).select("d", "h", "text"), base)
    found = rows.mapInArrow(_stretch(depth, gram), _STRETCH)
    same, any_ = Window.partitionBy("anchor", "whole"), Window.partitionBy("anchor")
    dealt = found.repartition("anchor")
    marked = (
        dealt.withColumn("first", F.min(F.struct("d", "h", "pos")).over(same))
        .withColumn("again", (F.col("anchor").bitwiseAND(1) == 1) | (F.col("first") != F.struct("d", "h", "pos")))
        .withColumn("low", F.min("whole").over(any_))
        .withColumn("high", F.max("whole").over(any_))
        .withColumn("many", F.sum(F.when(~F.col("again"), 1).otherwise(0)).over(any_))
        .filter("again or low != high")
        .select("anchor", "d", "h", "pos", "again", (F.col("many") > hot).alias("hot"))
    )
    marked.write.parquet(f"{base}/marked")
    marked = spark.read.schema("anchor bigint, d bigint, h bigint, pos bigint, again boolean, hot boolean").parquet(f"{base}/marked")
    a = F.shiftright("pos", 16)
    whole = marked.filter("again").select("d", "h", a.alias("s"), (a + F.col("pos").bitwiseAND(0xFF) + depth).alias("e"))

    def fetched(of: DataFrame) -> DataFrame:
        listed = of.groupBy("d", "h").agg(F.collect_list(F.struct("anchor", "pos")).alias("listed"))
        texts = prefilter.split(rows, "d", of.select("d"))[0].join(listed, ["d", "h"]).select("d", "h", "listed", "text")
        return texts.mapInArrow(_fetch(depth), "anchor bigint, d bigint, h bigint, pos bigint, bytes binary")

    cold = fetched(marked.filter("not again and not hot")).repartition("anchor").sortWithinPartitions("anchor", "d", "h", "pos")
    out = whole.union(cold.mapInArrow(_radix(depth, GROUP_ROWS), "d bigint, h bigint, s bigint, e bigint"))
    of_hot = marked.filter("not again and hot")
    if not of_hot.head(1):
        return out
    digits = "one bigint, two bigint, d bigint, h bigint, at bigint"
    fetched(of_hot).mapInArrow(_hot(depth), digits).write.parquet(f"{base}/hot")
    windows = spark.read.schema(digits).parquet(f"{base}/hot")
    firsts = windows.groupBy("one", "two").agg(F.min(F.struct("d", "h", "at")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(firsts, ["one", "two"]).filter(F.col("first") != F.struct("d", "h", "at"))
    return out.union(later.select("d", "h", F.col("at").alias("s"), (F.col("at") + depth).alias("e")))


def once(spark: SparkSession, rows: DataFrame, base: str) -> DataFrame:
    """One of all rows that share ``d`` and ``h``; only texts whose key may occur again are shuffled."""
    own = rows.withColumn("k", F.xxhash64("d", "h"))
    own.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1").select("k").write.parquet(f"{base}/again")
    again, others = prefilter.split(own, "k", spark.read.schema("k bigint").parquet(f"{base}/again"))
    again.groupBy("d", "h").agg(F.first("text").alias("text")).write.parquet(f"{base}/once")
    return others.select("d", "h", "text").union(spark.read.schema("d bigint, h bigint, text string").parquet(f"{base}/once"))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.xxhash64(text).alias("h"), text.alias("text"))


def cleaned(spark: SparkSession, docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Per document ``kept`` (the remaining bytes) with ``n_bytes``, ``n_removed`` and ``n_spans``."""
    path = scratch_dir(spark, "spans")
    repeats(spark, docs, depth, gram, hot).write.parquet(path)
    spans = spark.read.schema("d bigint, h bigint, s bigint, e bigint").parquet(path)
    touched, others = prefilter.split(keyed(docs), "d", spans.select("d"))
    listed = spans.groupBy("d", "h").agg(F.collect_list(F.struct("s", "e")).alias("listed"))
    out = touched.join(listed, ["d", "h"], "left").select("doc_id", "text", "listed").mapInArrow(_remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    zero = F.lit(0).cast("bigint")
    return out.union(others.select("doc_id", F.octet_length("text").cast("bigint"), zero, zero, F.col("text").cast("binary")))


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
