"""Token-id files compressed by Re-Pair grammars, with random access to any document.

Documents are ordered by id and dealt into shards by range. A shard holds blocks of whole documents. In each block
frequent pairs of neighbouring ids are replaced by new symbols, round after round, until no pair is frequent; the block keeps the rules and the
number of ids each rule expands to, so any range of ids is decoded without the rest.

File format (Parquet, one row per block): ``shard``, ``block`` (order in the shard), ``before`` (ids of the shard in
front of the block), ``n_tokens``, ``doc_ids`` and ``doc_tokens`` (ids per document, its end id included), ``base``
(the smallest rule symbol), ``rules`` (two uint32 per rule), ``lengths`` (uint32 per rule), ``symbols`` (the rewritten
sequence, uint16 if all symbols fit, else uint32).

Null or empty texts are documents of the end id alone. Null ids come first. Rows that share an id are in the order
of a hash of their texts; repeated rows are kept, next to each other. An empty table gives an empty folder of the same schema. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.llm import bpe
from civicledger.llm import textbytes as tb

BLOCK_TOKENS = 1 << 20
#: Rules made at once, before pairs are counted anew; rounds go on as long as a pair occurs ``LEAST_COUNT`` times.
RULES_A_ROUND = 1024
LEAST_COUNT = 16
SYMBOLS = 1 << 24

BLOCKS = (
    "shard int, block int, before bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, "
    "base bigint, rules binary, lengths binary, symbols binary"
)


def choose_pairs(sequence: np.ndarray, most: int, least: int) -> list[tuple[int, int]]:
    """Frequent pairs, the most frequent first, no symbol being first in one and second in another.

    Occurrences of such pairs can't overlap, so all are replaced at once. A pair of one symbol twice is taken if the
    symbol is in no other; in a run of it, every second occurrence counts.
    """
    keys = (sequence[:-1].astype(np.uint64) << np.uint64(24)) | sequence[1:].astype(np.uint64)
    keys.sort()
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.r_[starts, len(keys)])
    often = np.flatnonzero(counts >= least)
    often = often[np.lexsort((keys[starts[often]], -counts[often]))][: 4 * most]
    left, right, twice, chosen = set(), set(), set(), []
    for key in keys[starts[often]].tolist():
        a, b = key >> 24, key & (SYMBOLS - 1)
        if a in right or b in left or a in twice or b in twice or (a == b and (a in left or b in right)):
            continue
        if a == b:
            twice.add(a)
        else:
            left.add(a)
            right.add(b)
        chosen.append((a, b))
        if len(chosen) == most:
            break
    return chosen


def compress(ids: np.ndarray, base: int, a_round: int = RULES_A_ROUND, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (n x 2) and expansion lengths. Symbol ``base + i`` stands for rule i.

    Ends when no pair occurs ``least`` times: each round replaces every occurrence of its pairs but those that runs of
    one symbol overlap.
    """
    sequence, rules, lengths = ids.astype(np.int64), [], []
    while True:
        pairs = choose_pairs(sequence, min(a_round, SYMBOLS - base - len(rules)), least) if len(sequence) > 1 else []
        if not pairs:
            break
        firsts, seconds = sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})
        top = base + len(rules)
        row, column = np.zeros(top, np.int32), np.zeros(top, np.int32)
        row[firsts], column[seconds] = np.arange(1, len(firsts) + 1), np.arange(1, len(seconds) + 1)
        a, b = np.array(pairs).T
        table = np.zeros((len(firsts) + 1, len(seconds) + 1), np.int32)
        table[row[a], column[b]] = np.arange(top, top + len(pairs))
        starts = np.flatnonzero(row[sequence[:-1]])
        found = table[row[sequence[starts]], column[sequence[starts + 1]]]
        starts, found = starts[found > 0], found[found > 0]
        even = sequence[starts] == sequence[starts + 1]
        if even.any():  # in runs of one symbol, from the start of the run
            run = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
            offset = starts - run[np.searchsorted(run, starts, side="right") - 1]
            kept = ~even | (offset % 2 == 0)
            starts, found = starts[kept], found[kept]
        rules += pairs
        lengths += [sum(lengths[x - base] if x >= base else 1 for x in pair) for pair in pairs]
        sequence[starts] = found
        kept = np.ones(len(sequence), bool)
        kept[starts + 1] = False
        sequence = sequence[kept]
    return sequence, np.array(rules, np.int64).reshape(-1, 2), np.array(lengths, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    while len(rules) and len(symbols) and symbols.max() >= base:
        is_rule = symbols >= base
        place = np.cumsum(1 + is_rule) - 1 - is_rule
        out = np.empty(len(symbols) + int(is_rule.sum()), symbols.dtype)
        out[place] = symbols
        pair = rules[symbols[is_rule] - base]
        out[place[is_rule]], out[place[is_rule] + 1] = pair[:, 0], pair[:, 1]
        symbols = out
    return symbols


def expand_all(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for, by expanding every rule once; for whole blocks."""
    ends = np.cumsum(lengths)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, symbols.dtype)
    place = np.r_[0, ends].tolist()
    for k, (a, b) in enumerate(rules.tolist()):
        at = place[k]
        for x in (a, b):
            if x < base:
                flat[at] = x
                at += 1
            else:
                part = flat[place[x - base] : place[x - base + 1]]
                flat[at : at + len(part)] = part
                at += len(part)
    is_rule = symbols >= base
    which = symbols[is_rule].astype(np.int64) - base
    sizes = np.ones(len(symbols), np.int64)
    sizes[is_rule] = lengths[which]
    before = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), symbols.dtype)
    out[before[~is_rule]] = symbols[~is_rule]
    own = sizes[is_rule]
    steps = tb.ranges(own)
    out[np.repeat(before[is_rule], own) + steps] = flat[np.repeat((ends - lengths)[which], own) + steps]
    return out


def decode(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block; only the symbols that cover them are expanded."""
    sizes = np.r_[np.ones(base, np.int64), lengths][symbols] if len(lengths) else np.ones(len(symbols), np.int64)
    ends = np.cumsum(sizes)
    stop = int(ends[-1]) if stop is None and len(ends) else stop or 0
    if stop <= start:
        return np.empty(0, symbols.dtype)
    first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left")
    skip = start - (int(ends[first - 1]) if first else 0)
    return expand(symbols[first : last + 1], rules, base)[skip : skip + stop - start]


def _block(shard: int, block: int, before: int, doc_ids: list, doc_tokens: list[int], ids: np.ndarray, vocabulary: int) -> pa.RecordBatch:
    base = max(vocabulary, int(ids.max()) + 1)
    symbols, rules, lengths = compress(ids, base)
    width = np.uint16 if base + len(rules) <= 1 << 16 else np.uint32
    return pa.RecordBatch.from_pylist(
        [
            {
                "shard": shard, "block": block, "before": before, "n_tokens": len(ids), "doc_ids": doc_ids, "doc_tokens": doc_tokens, "base": base,
                "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(), "symbols": symbols.astype(width).tobytes(),
            }
        ],
        schema=_BLOCKS,
    )


_BLOCKS = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("base", pa.int64()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary())]
)


def _encode_shard(tokenizer: str, end_id: int, block_tokens: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        encoder = bpe.encoder(tokenizer)
        vocabulary = encoder.tokenizer.get_vocab_size()
        doc_ids, doc_tokens, parts, held = [], [], [], 0
        for batch in tb.batches(stream):
            ids, starts = encoder.encode(batch.column("text"))
            n = batch.num_rows
            at = starts[1:] + np.arange(n)  # the end id of each document
            whole = np.full(len(ids) + n, end_id, np.uint32)
            inside = np.ones(len(whole), bool)
            inside[at] = False
            whole[inside] = ids
            ends = np.r_[0, at + 1]
            names, done = batch.column("doc_id").to_pylist(), 0
            while done < n:
                upto = max(done + 1, int(np.searchsorted(ends, ends[done] + block_tokens - held, side="right")) - 1)
                doc_ids += names[done:upto]
                doc_tokens += np.diff(ends[done : upto + 1]).tolist()
                parts.append(whole[ends[done] : ends[upto]])
                held += len(parts[-1])
                done = upto
                if held >= block_tokens or done < n:
                    yield _block(shard, block, before, doc_ids, doc_tokens, np.concatenate(parts), vocabulary)
                    block, before = block + 1, before + held
                    doc_ids, doc_tokens, parts, held = [], [], [], 0
        if doc_ids:
            yield _block(shard, block, before, doc_ids, doc_tokens, np.concatenate(parts), vocabulary)

    return run


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes the ids of all texts in ascending ``doc_id`` order as shards of Re-Pair blocks below ``path``."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("order"))
    ordered = keyed.repartitionByRange("doc_id", "order").sortWithinPartitions("doc_id", "order")
    run = _encode_shard(tokenizer or bpe.default_path(), end_id, block_tokens)
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(path)


def _decode_blocks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for row in batch.to_pylist():
            base = row["base"]
            rules, lengths = np.frombuffer(row["rules"], "<u4").reshape(-1, 2), np.frombuffer(row["lengths"], "<u4").astype(np.int64)
            width = np.uint16 if base + len(rules) <= 1 << 16 else np.uint32
            ids = expand_all(np.frombuffer(row["symbols"], width).astype(np.uint32), rules, lengths, base).astype("<u4")
            counts = np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(counts)
            starts, view = ends - counts, memoryview(ids).cast("B")
            sums = [zlib.crc32(view[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["before"] + row["base_tokens"]), pa.array(counts), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document: ids before it, number of ids and their checksum, all from decoded blocks.

    Where a shard starts needs one number per shard; their number is that of the partitions written.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = sorted(blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    bases, at = [], 0
    for shard, n in totals:
        bases.append((shard, at))
        at += n
    starts = spark.createDataFrame(bases, "shard int, base_tokens bigint")
    return blocks.join(F.broadcast(starts), "shard").mapInArrow(_decode_blocks, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id (end id included), decoded from the covering symbols only."""
    out = []
    for row in spark.read.schema(BLOCKS).parquet(path).filter(F.array_contains("doc_ids", F.lit(doc_id).cast("bigint"))).toLocalIterator():
        rules = np.frombuffer(row.rules, "<u4").reshape(-1, 2)
        width = np.uint16 if row.base + len(rules) <= 1 << 16 else np.uint32
        symbols, lengths = np.frombuffer(row.symbols, width).astype(np.uint32), np.frombuffer(row.lengths, "<u4").astype(np.int64)
        ends = np.cumsum(row.doc_tokens)
        for k, found in enumerate(row.doc_ids):
            if found == doc_id:
                out.append(decode(symbols, rules, lengths, row.base, int(ends[k] - row.doc_tokens[k]), int(ends[k])).tolist())
    return out
