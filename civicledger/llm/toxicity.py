"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

Words are runs of letters and digits, A-Z lower-cased. A word's score is its log-odds between toxic and other labelled
texts with an informative Dirichlet prior (the pooled frequencies; a text counts a word once, and a near copy of another
one doesn't count); only words with a large likelihood ratio keep it, all others get a small negative score, so that the drift in
clean text is negative. In each
text all maximal segments (those that no neighbour improves) are found in one pass. Under the clean word frequencies
the best score of n words follows an extreme-value law with parameters lambda and K; it turns scores into expected
numbers of such segments by chance. A logistic curve over the significant segments gives the document's score.

Bounded, and documented as such: the model is fitted on at most ``sample_rows`` labelled rows (the smallest by a hash
of their id), which bound its words. Everything else covers all rows. Scores of words are multiples of 2^-20, so sums
are exact and neither the model nor a score depends on how rows are dealt out.

Only rows that may be learnt from are used: those for which crc32 of the id, as text, modulo 3 isn't 1. Labels are
used in no other way. Null and empty texts have no segments and get the score of a text without any. Without usable
labels, or with one class only, every score is 0. A null id counts as not held out. Of texts that share an id one is
learnt from. Repeated rows and other columns change nothing; an empty table gives an empty result. A text of any length
is scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicledger.llm import textbytes as tb
from civicledger.session import scratch_dir

SAMPLE_ROWS = 30_000
LEAST_GAIN = 18.0
LEAST_ODDS = 1.0
PRIOR_TEXTS = 2.0
#: Scores are multiples of 1 / UNIT.
UNIT = 1 << 20
DRIFT = round(0.05 * UNIT) / UNIT
ALIKE = 0.8
SKETCHES = 4
SIGNIFICANT = 0.05
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    """Sorted word hashes with their scores, the law of chance segments and the logistic curve."""

    words: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    scores: np.ndarray = field(default_factory=lambda: np.empty(0))
    rate: float = 1.0
    scale: float = 1.0
    curve: np.ndarray | None = None

    def token_scores(self, hashed: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashed), -DRIFT)
        at = np.minimum(np.searchsorted(self.words, hashed), len(self.words) - 1)
        return np.where(self.words[at] == hashed, self.scores[at], -DRIFT)

    def log_expected(self, score: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Log of the number of segments of that score that n clean words hold by chance."""
        return np.log(self.scale * np.maximum(words, 1)) - self.rate * score

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(np.c_[np.ones(len(features)), features] @ self.curve, -40, 40)))


def maximal_segments(scores: np.ndarray, positive: np.ndarray, before: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of one text as (first word, end, score), in time linear in its positive words.

    ``positive``: places of words with a positive score. ``before``: sums of the scores in front of each word.
    """
    stack: list[tuple[float, float, int, int]] = []  # sum in front, sum behind, first word, end
    for place in positive.tolist():
        low, high, first, end = before[place], before[place] + scores[place], place, place + 1
        while stack:
            # The nearest earlier segment that begins lower; those between can't be part of a larger one.
            k = len(stack) - 1
            while k >= 0 and stack[k][0] >= low:
                k -= 1
            if k < 0 or stack[k][1] >= high:
                break
            low, first = stack[k][0], stack[k][2]
            del stack[k:]
        stack.append((low, high, first, end))
    return [(first, end, high - low) for low, high, first, end in stack]


def segments(model: Model, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """For each text its number of words and its maximal segments."""
    hashed, first = tb.lowered_words(column, tb.ALNUM)
    scores = model.token_scores(hashed)
    positive = np.flatnonzero(scores > 0)
    bounds = np.searchsorted(positive, first)
    sums = np.r_[0.0, np.cumsum(scores)]
    for a, b, p, q in zip(first[:-1].tolist(), first[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield b - a, maximal_segments(scores[a:b], positive[p:q] - a, sums[a : b + 1]) if q > p else []


def features(model: Model, n_words: int, found: list[tuple[int, int, float]]) -> tuple[float, float, float]:
    """The best segment, all significant ones together, and their share of the text; in units of the chance law."""
    if not found:
        return 0.0, 0.0, 0.0
    value = -model.log_expected(np.array([s for _, _, s in found]), np.full(len(found), n_words))
    good = value[value > -np.log(SIGNIFICANT)]
    return float(np.log1p(max(0.0, value.max()))), float(np.log1p(good.sum())), float(np.log1p(1000 * len(good) / max(n_words, 1)))


def _triples(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of three consecutive words of each text (with fewer, all of them as one), and its smallest members by some hashes."""
    for batch in tb.batches(stream):
        hashed, first = tb.lowered_words(batch.column("text"), tb.ALNUM)
        triples = tb.mix(hashed[2:] + np.uint64(3) * hashed[1:-1] + np.uint64(7) * hashed[:-2])
        sets, sketches = [], []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            few = tb.mix((hashed[a:b] * np.array([5, 11], np.uint64)[: b - a]).sum(keepdims=True) + np.uint64(b - a)) if b - a < 3 else None
            sets.append(np.unique(triples[a : b - 2] if few is None else few).view(np.int64))
            sketches.append([int(tb.mix(sets[-1].view(np.uint64) + np.uint64(k) * tb._PRIME).min() >> np.uint64(1)) for k in range(SKETCHES)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(sets, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))], names=["doc_id", "toxic", "triples", "sketches"])


def copies(texts: DataFrame, alike: float = ALIKE) -> DataFrame:
    """(doc_id, toxic) of the texts that are near copies of one of their class with a smaller id.

    Each is compared with the smallest id that has the same member of its set by one of ``SKETCHES`` hashes, and is a copy
    if the Jaccard similarity of the whole sets is ``alike`` or more. Ids must be distinct within a class.
    """
    sets = texts.mapInArrow(_triples, "doc_id bigint, toxic int, triples array<bigint>, sketches array<bigint>")
    keys = sets.select("doc_id", "toxic", F.posexplode("sketches").alias("k", "least"))
    firsts = keys.groupBy("toxic", "k", "least").agg(F.min("doc_id").alias("first"))
    pairs = keys.join(firsts, ["toxic", "k", "least"]).filter("first < doc_id").select("doc_id", "toxic", "first").distinct()
    other = sets.select(F.col("doc_id").alias("first"), "toxic", F.col("triples").alias("others"))
    both = pairs.join(sets.select("doc_id", "toxic", "triples"), ["doc_id", "toxic"]).join(other, ["first", "toxic"])
    common = F.size(F.array_intersect("triples", "others"))
    return both.filter(common >= alike * (F.size("triples") + F.size("others") - common)).select("doc_id", "toxic").distinct()


def _count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of either class that hold each word."""
    for batch in tb.batches(stream):
        hashed, first = tb.lowered_words(batch.column("text"), tb.ALNUM)
        own = [np.unique(hashed[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        toxic = np.repeat(batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64), [len(x) for x in own])
        distinct, which = np.unique(np.concatenate(own), return_inverse=True)
        yes = np.bincount(which, toxic, len(distinct)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(yes), pa.array(np.bincount(which, minlength=len(distinct)) - yes)], names=["word", "yes", "no"])


def _features(model: Model):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.batches(stream):
            rows = [(n, max((s for _, _, s in found), default=0.0), *features(model, n, found)) for n, found in segments(model, batch.column("text"))]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), *columns], names=["toxic", "n", "best", "a", "b", "c"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    x, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _chance_rate(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive solution of sum(share * exp(rate * score)) = 1."""
    low, high = 1e-6, 1.0
    total = lambda rate: float((share * np.exp(np.minimum(rate * scores, 700))).sum())
    while total(high) < 1 and high < 1e4:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return (low + high) / 2


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, least_gain: float = LEAST_GAIN) -> Model:
    """Learns from the labelled rows that aren't held out."""
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    few = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct().orderBy(F.xxhash64("doc_id", "toxic")).limit(sample_rows)
    known = [tuple(r) for r in few.collect()]
    if len({toxic for _, toxic in known}) < 2:
        return Model()
    session, path = docs.sparkSession, scratch_dir(docs.sparkSession, "toxicity")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return session.read.schema(df.schema).parquet(f"{path}/{name}")

    labelled = docs.select("doc_id", "text").join(F.broadcast(session.createDataFrame(known, "doc_id bigint, toxic int")), "doc_id")
    texts = kept(labelled.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "texts")
    # A copied text would make all its words look telling.
    sample = texts.join(F.broadcast(kept(copies(texts), "copies")), ["doc_id", "toxic"], "left_anti").select("text", "toxic")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_yes, n_no = sizes.get(1, 0), sizes.get(0, 0)
    if not n_yes or not n_no:
        return Model()
    counts = sample.mapInArrow(_count, "word bigint, yes bigint, no bigint").groupBy("word").agg(F.sum("yes").cast("double").alias("yes"), F.sum("no").cast("double").alias("no"))
    pooled = F.lit(PRIOR_TEXTS) * (F.col("yes") + F.col("no")) / (n_yes + n_no)
    rate = lambda n, all_: (n + pooled) / (all_ + PRIOR_TEXTS)
    odds = lambda p: F.log(p / (1 - p))
    yes_rate, no_rate = rate(F.col("yes"), n_yes), rate(F.col("no"), n_no)
    delta = odds(yes_rate) - odds(no_rate)
    term = lambda n, all_: F.when(n > 0, 2 * n * F.log(n * (n_yes + n_no) / ((F.col("yes") + F.col("no")) * all_))).otherwise(F.lit(0.0))
    gain = term(F.col("yes"), n_yes) + term(F.col("no"), n_no)
    rated = counts.select("word", no_rate.alias("no_rate"), delta.alias("delta"), gain.alias("gain")).filter((F.col("gain") >= least_gain) & (F.abs("delta") >= LEAST_ODDS))
    words = sorted(rated.collect(), key=lambda r: r.word & (1 << 64) - 1)
    words_a_text = counts.agg(F.sum("no")).first()[0] or n_no
    model = Model(np.array([r.word for r in words], np.int64).view(np.uint64), np.round(np.array([r.delta - DRIFT for r in words]) * UNIT) / UNIT)
    share = np.array([r.no_rate for r in words]) * n_no / words_a_text
    model.rate = _chance_rate(np.r_[model.scores, -DRIFT], np.r_[share, max(0.0, 1 - share.sum())])
    rows = np.array(sorted(_collect(sample, model)))
    clean = rows[rows[:, 0] == 0]
    model.scale = float(len(clean) / max(1e-9, (np.maximum(clean[:, 1], 1) * np.exp(-model.rate * clean[:, 2])).sum()))
    rows = np.array(sorted(_collect(sample, model)))
    model.curve = _logistic(rows[:, 3:], rows[:, 0])
    return model


def _collect(sample: DataFrame, model: Model) -> list[tuple]:
    """One row of figures per row of the bounded sample."""
    out = sample.mapInArrow(_features(model), "toxic int, n double, best double, a double, b double, c double")
    return [tuple(r) for r in out.collect()]


def _score(model: Model, text: str, names: list[str]):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
        for batch in tb.batches(stream, text):
            rows, spans = [], []
            for n, found in segments(model, batch.column(text)):
                rows.append(features(model, n, found))
                expected = np.exp(np.minimum(700, model.log_expected(np.array([s for _, _, s in found]), np.full(len(found), n)))).tolist()
                spans.append([{"start": a, "end": b, "score": s, "expected": e} for (a, b, s), e in zip(found, expected, strict=True) if e < SIGNIFICANT])
            score = model.score(np.array(rows))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(score), pa.array(spans, kind)], names=[*names, "score", "passages"])

    return run


def scored(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of every document with ``score`` and ``passages`` (word spans that chance doesn't explain)."""
    names = [f"_{k}" for k in range(len(columns))]
    text = names[columns.index("text")] if "text" in columns else "_text"
    rows = docs.select(*[F.col(c).alias(n) for n, c in zip(names, columns, strict=True)], *[F.col("text").alias("_text")] * (text == "_text"))
    made = T.StructType.fromDDL("score double, passages array<struct<start:bigint,end:bigint,score:double,expected:double>>")
    schema = T.StructType([rows.schema[n] for n in names] + made.fields)
    out = rows.mapInArrow(_score(model, text, names), schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns, strict=True)], "score", "passages")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(docs, fit(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
