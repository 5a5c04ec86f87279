"""Packs documents into token sequences of bounded length, shortest pack first over the length histogram.

A document's ids are cut at multiples of the sequence length. Only the histogram of piece lengths (one number per
length) reaches the driver: going from the longest length down, pieces join the pattern with the most room left, and
counts of patterns are split as pieces of one length run out. A piece finds its pattern, sequence and offset from its
rank among the pieces of its length.

Null or empty texts are documents of the end id alone. Repeated rows are packed each on its own. Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.llm import bpe
from civicledger.llm import textbytes as tb
from civicledger.llm.ranking import ranked

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"


def _cut(tokenizer: str, end_id: int, room: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(tokenizer)
        for batch in tb.batches(stream):
            ids, starts = encoder.encode(batch.column("text"))
            n = batch.num_rows
            at = starts[1:] + np.arange(n)
            whole = np.full(len(ids) + n, end_id, "<u4")
            inside = np.ones(len(whole), bool)
            inside[at] = False
            whole[inside] = ids
            first = np.r_[0, at[:-1] + 1]
            tokens = at + 1 - first
            pieces = -(-tokens // room)
            doc = np.repeat(np.arange(n), pieces)
            start = tb.ranges(pieces) * room
            length = np.minimum(room, tokens[doc] - start)
            begin = first[doc] + start
            view = memoryview(whole).cast("B")
            parts = [view[4 * b : 4 * e] for b, e in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            offsets = np.r_[begin, len(whole)].astype(np.int64) * 4
            kept = pa.Array.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(whole)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(list(map(zlib.crc32, parts)), pa.int64()), pa.array(tokens[doc]), kept.cast(pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    return run


@dataclass
class Pattern:
    """``items``: lengths and how often each occurs in a sequence; ``count``: how many sequences look like this."""

    items: tuple[tuple[int, int], ...]
    count: int


def pack_histogram(histogram: dict[int, int], room: int) -> list[Pattern]:
    """Patterns that hold every piece of the histogram exactly once."""
    by_space: dict[int, list[Pattern]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max(by_space, default=0)
            if space < length:
                by_space.setdefault(room - length, []).append(Pattern(((length, 1),), left))
                break
            found = by_space[space].pop()
            if not by_space[space]:
                del by_space[space]
            used = min(left, found.count)
            if found.count > used:
                by_space.setdefault(space, []).append(Pattern(found.items, found.count - used))
            last, times = found.items[-1]
            items = (*found.items[:-1], (last, times + 1)) if last == length else (*found.items, (length, 1))
            by_space.setdefault(space - length, []).append(Pattern(items, used))
            left -= used
    return [p for space in sorted(by_space) for p in by_space[space]]


@dataclass
class Places:
    """For runs of ranks of each length: the first sequence, pieces per sequence and the first offset."""

    keys: np.ndarray
    first: np.ndarray
    times: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, patterns: list[Pattern]) -> Places:
        rows, used, sequence = [], {}, 0
        for p in patterns:
            offset = 0
            for length, times in p.items:
                rank = used.get(length, 0)
                rows.append(((length << 40) + rank, sequence, times, offset))
                used[length] = rank + p.count * times
                offset += length * times
            sequence += p.count
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(*table.T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << 40) + rank
        at = np.searchsorted(self.keys, key, side="right") - 1
        nth = key - self.keys[at]
        return self.first[at] + nth // self.times[at], self.offset[at] + nth % self.times[at] * length


def write_pieces(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1, room: int = 2048) -> None:
    """Writes the pieces of all documents, with their ids."""
    run = _cut(tokenizer or bpe.default_path(), end_id, room)
    docs.select("doc_id", "text").mapInArrow(run, PIECES).write.option("compression", "zstd").parquet(path)


def place(spark: SparkSession, path: str, room: int = 2048, columns: tuple[str, ...] = ("doc_id", "start", "length", "ids_crc32", "doc_tokens"), rows_a_part: int = 100_000) -> DataFrame:
    """The written pieces with ``sequence_id`` and ``offset`` (the place of the first id in the sequence)."""
    pieces = spark.read.schema(PIECES).parquet(path)
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places.of(pack_histogram(histogram, room))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    parts = max(32, max(histogram.values(), default=0) // rows_a_part)
    with_rank = ranked(pieces.select(*columns), "length", ["doc_id", "start", "ids_crc32"], "_rank", parts)
    return with_rank.withColumn("_place", find("length", "_rank")).select(*columns, "_place.sequence_id", "_place.offset")


def sequences(spark: SparkSession, path: str, room: int = 2048, pad_id: int = 0) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids`` (binary uint32, padded unless the length is a power of two)."""
    placed = place(spark, path, room, ("doc_id", "start", "length", "ids_crc32", "ids"))
    joined = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    @F.pandas_udf("binary")
    def join(parts: pd.Series) -> pd.Series:
        def one(row) -> bytes:
            ids = b"".join(p["ids"] for p in row)
            n = len(ids) // 4
            return ids if n & (n - 1) == 0 else ids + np.full(room - n, pad_id, "<u4").tobytes()

        return parts.map(one)

    return joined.select("sequence_id", join("parts").alias("ids"))
