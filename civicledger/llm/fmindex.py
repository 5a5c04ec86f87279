"""Finds benchmark passages in documents by an FM-index per shard of text.

Words are runs of letters and digits (A-Z lower-cased; every character outside ASCII counts as a letter). A window is
``width`` consecutive words of a benchmark item, or the whole item if it has fewer words (but some). Tasks cut the items
into windows; distinct windows are a written table, dealt by hash into blocks of about ``BLOCK_WINDOWS``. Only one block
at a time is sent to the tasks, and what it finds is written before the next one, so neither the driver nor a worker
ever holds the whole benchmark. Which items a window belongs to is a join, done by Spark.

Each task cuts its documents into shards of bounded size. A word outside the block's vocabulary can't be part of a
match, so a shard indexes only the runs of known words that are long enough, and searches only the windows all of whose
words it holds. These are searched backwards at once through the ranks of a wavelet matrix; matches are located by
sampled suffix positions, and the word spans of a document are merged.

Equal texts have equal hits: what is found is kept once per distinct text, under two 64-bit hashes, and joined back.
Null or empty documents have no words. Items without words have no windows. Repeated documents and items are handled
each on its own (an item id counts once). With an empty table of either kind nothing is hit. A very long text or item is
a shard or a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicledger.llm import prefilter
from civicledger.llm import textbytes as tb
from civicledger.session import scratch_dir

WIDTH = 10
#: Windows in a block: what the driver and each worker hold of the benchmark, 80 bytes a window of ten words.
BLOCK_WINDOWS = 1 << 19
_CUT_WINDOWS = 1 << 16
_SALTS = 16
_FOUND = "a bigint, b bigint, spans array<bigint>, windows array<bigint>"
# The complement of the bytes that ``textbytes.ALNUM`` leaves out, with capitals.
_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class WaveletMatrix:
    """Ranks of any symbol in a sequence, one bit array per binary digit of the symbols."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max()).bit_length() if len(symbols) else 1)
        self.ones, self.zeros = [], []
        for digit in range(self.bits - 1, -1, -1):
            bit = (symbols >> digit) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)])
            self.zeros.append(len(symbols) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in front of each position."""
        low, high = np.zeros_like(before), before
        for level, digit in enumerate(range(self.bits - 1, -1, -1)):
            ones, bit = self.ones[level], (symbol >> digit) & 1 == 1
            a, b = ones[low], ones[high]
            low, high = np.where(bit, self.zeros[level] + a, low - a), np.where(bit, self.zeros[level] + b, high - b)
        return high - low


class FMIndex:
    """Of a sequence of positive symbols, in which 0 separates runs."""

    def __init__(self, sequence: np.ndarray, sample: int = 8):
        text = np.r_[sequence + 1, 0].astype(np.int64)  # the end is the only smallest symbol
        self.sample, n = sample, len(text)
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.wavelet = WaveletMatrix(self.bwt)
        self.smaller = np.r_[0, np.cumsum(np.bincount(text))]
        sampled = order % sample == 0
        self.sampled, self.nth, self.places = sampled, np.cumsum(sampled) - 1, order[sampled]
        self.n = n

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of suffixes that start with each pattern (a row of ``patterns``, filled from the left)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for step in range(patterns.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                continue
            symbol = patterns[live, step] + 1
            known = symbol < len(self.smaller) - 1
            symbol = np.where(known, symbol, 0)
            low[live] = self.smaller[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = np.where(known, self.smaller[symbol] + self.wavelet.rank(symbol, high[live]), low[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of suffixes, by walking back to the next sampled one."""
        out, steps, at = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64), rows.copy()
        open_ = np.arange(len(rows))
        while len(open_):
            here = self.sampled[at[open_]]
            done = open_[here]
            out[done] = self.places[self.nth[at[done]]] + steps[done]
            open_ = open_[~here]
            symbol = self.bwt[at[open_]]
            at[open_] = self.smaller[symbol] + self.wavelet.rank(symbol, at[open_])
            steps[open_] += 1
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a text that ends with its only smallest last suffix, by doubling."""
    n, ahead = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        following = np.zeros(n, np.int64)
        following[: n - ahead] = rank[ahead:] + 1 if ahead < n else 0
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        changed = np.r_[0, np.diff(key[order]) != 0]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(changed)
        if rank[order[-1]] == n - 1:
            return order
        ahead *= 2


class Windows:
    """A block of windows as rows of vocabulary numbers (from 1), filled up with 0. ``ids`` names them."""

    def __init__(self, ids: np.ndarray, words: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids, lengths.astype(np.int64)
        self.vocabulary, number = np.unique(words, return_inverse=True)
        self.patterns = np.zeros((len(ids), int(lengths.max(initial=1))), np.int32)
        self.patterns[np.repeat(np.arange(len(ids)), self.lengths), tb.ranges(self.lengths)] = number + 1

    def numbers(self, hashed: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of words, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashed), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashed, at + 1, 0)

    def matches(self, hashed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions and windows of all matches in texts whose words start at ``first``."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(self.lengths) or not len(hashed):
            return none
        # A separator in front of each text, then runs of known words that are long enough, a separator after each.
        sequence = np.insert(self.numbers(hashed), first[:-1], 0)
        word = np.arange(len(sequence)) - np.searchsorted(first[:-1] + np.arange(len(first) - 1), np.arange(len(sequence)), side="right")
        step = np.diff(np.r_[0, sequence > 0, 0].astype(np.int8))
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        long = ends - starts >= self.lengths.min()
        if not long.any():
            return none
        sizes = (ends - starts)[long] + 1
        place = np.repeat(starts[long], sizes) + tb.ranges(sizes)
        last = np.cumsum(sizes) - 1
        text = sequence[np.minimum(place, len(sequence) - 1)]
        text[last] = 0
        held = np.zeros(len(self.vocabulary) + 1, bool)
        held[text] = held[0] = True
        possible = np.flatnonzero(held[self.patterns].all(1))
        index = FMIndex(text)
        low, high = index.search(self.patterns[possible].astype(np.int64), self.lengths[possible])
        counts = np.maximum(high - low, 0)
        window = np.repeat(possible, counts)
        found = index.locate(np.repeat(low, counts) + tb.ranges(counts))
        return word[place[found]], window


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _cut(width: int):
    """Windows of items as arrays of word hashes."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.batches(stream):
            hashed, first = tb.lowered_words(batch.column("text"), tb.ALNUM)
            counts = np.diff(first)
            size = np.minimum(counts, width)
            number = np.where(counts > 0, counts - size + 1, 0)
            row = np.repeat(np.arange(len(counts)), number)
            start = first[:-1][row] + tb.ranges(number)
            for at in range(0, len(row), _CUT_WINDOWS):
                own, n = row[at : at + _CUT_WINDOWS], size[row[at : at + _CUT_WINDOWS]]
                words = hashed[np.repeat(start[at : at + _CUT_WINDOWS], n) + tb.ranges(n)].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(words))
                yield pa.RecordBatch.from_arrays([lists, batch.column("name").take(pa.array(own))], names=["words", "name"])

    return run


def _search(block: Broadcast):
    """Rows of texts that hold windows of the block: merged spans and the distinct windows found."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = block.value
        for batch in tb.batches(stream):
            hashed, first = tb.lowered_words(batch.column("text"), tb.ALNUM)
            position, window = windows.matches(hashed, first)
            if not len(position):
                continue
            row = np.searchsorted(first, position, side="right") - 1
            within = position - first[row]
            spans: dict[int, list[tuple[int, int]]] = {}
            found: dict[int, set[int]] = {}
            for k, at, w, n in zip(row.tolist(), within.tolist(), windows.ids[window].tolist(), windows.lengths[window].tolist(), strict=True):
                spans.setdefault(k, []).append((at, at + n))
                found.setdefault(k, set()).add(w)
            rows = sorted(spans)
            flat = [[x for span in _merge(spans[k]) for x in span] for k in rows]
            made = [pa.array(flat, pa.list_(pa.int64())), pa.array([sorted(found[k]) for k in rows], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(rows)) for c in ("a", "b")] + made, names=["a", "b", "spans", "windows"])

    return run


def _united(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges what several blocks found in a text."""
    for batch in stream:
        flat = batch.column("spans").to_pylist()
        merged = [[{"start": a, "end": b} for a, b in _merge(list(zip(f[::2], f[1::2], strict=True)))] for f in flat]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(merged, kind)], names=["a", "b", "spans"])


def _found(docs: DataFrame, benchmark: DataFrame, width: int, block_windows: int) -> DataFrame:
    """(a, b, spans, items) of each distinct text that is hit; ``a`` and ``b`` are its hashes."""
    spark, base = docs.sparkSession, scratch_dir(docs.sparkSession, "windows")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), "text")
    items.mapInArrow(_cut(width), "words array<bigint>, name string").distinct().write.parquet(f"{base}/names")
    named = spark.read.schema("words array<bigint>, name string").parquet(f"{base}/names")
    named.select("words").distinct().select(F.xxhash64("words").alias("id"), "words").write.parquet(f"{base}/windows")
    windows = spark.read.schema("id bigint, words array<bigint>").parquet(f"{base}/windows")
    blocks = -(-windows.count() // block_windows)
    texts = docs.select(*_hashes(), "text").where("text != ''")
    for k in range(blocks):
        own = windows.where(F.pmod("id", F.lit(blocks)) == k).toArrow()
        words = own.column("words").combine_chunks()
        block = spark.sparkContext.broadcast(Windows(own.column("id").to_numpy(), words.flatten().to_numpy().view(np.uint64), words.value_lengths().to_numpy()))
        texts.mapInArrow(_search(block), _FOUND).distinct().write.parquet(f"{base}/found/{k}")
        block.destroy()
    paths = [f"{base}/found/{k}" for k in range(blocks)]
    found = spark.read.schema(_FOUND).parquet(*paths) if paths else spark.createDataFrame([], _FOUND)
    spans = found.groupBy("a", "b").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = spans.mapInArrow(_united, "a bigint, b bigint, spans array<struct<start:bigint,end:bigint>>")
    # A window may lie in a third of the texts: its rows are dealt over salts.
    salted = named.select(F.xxhash64("words").alias("id"), "name", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    held = found.select("a", "b", F.pmod("a", F.lit(_SALTS)).cast("int").alias("salt"), F.explode("windows").alias("id"))
    names = held.join(salted, ["id", "salt"]).groupBy("a", "b").agg(F.collect_set("name").alias("items"))
    spans.join(names, ["a", "b"]).write.parquet(f"{base}/hits")
    return spark.read.schema("a bigint, b bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>").parquet(f"{base}/hits")


def _hashes() -> list:
    return [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")]


def hits(docs: DataFrame, benchmark: DataFrame, columns: tuple[str, ...] = ("doc_id",), width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``columns`` of every document with ``n_words``, ``spans`` (merged, of words, ends exclusive) and ``items``.

    Other columns of either table are ignored. A null item id is named "null".
    """
    found = _found(docs, benchmark, width, block_windows)
    words = F.coalesce(F.regexp_count("_text", F.lit(_WORDS)), F.lit(0)).cast("bigint")
    kept = [F.col(c).alias(f"_{k}") for k, c in enumerate(columns)]
    maybe, others = prefilter.split(docs.select(*kept, *_hashes(), F.col("text").alias("_text")), "a", found.select("a"))
    # Words are counted behind the split, once a row.
    own = [*[f"_{k}" for k in range(len(columns))], words.alias("n_words")]
    none = others.select(*own, F.lit(None).cast(found.schema["spans"].dataType).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    both = maybe.select("a", "b", *own).join(found, ["a", "b"], "left").select(*none.columns).union(none)
    empty = lambda c: F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c)
    return both.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(columns)], "n_words", empty("spans"), empty("items"))


def digests(found: DataFrame) -> DataFrame:
    """Per document: words, hit words, items and their checksum."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated")
    )
