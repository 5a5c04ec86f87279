"""Mixing, prefix tries and clustering against plain versions, on awkward rows and empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from civicledger.llm import centroids, conversation_trie, mixing, queries

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, node string, depth int, at bigint"
VECTORS = "vec_id bigint, embedding array<float>, label int, row bigint, block int, cluster string"
DOCUMENTS = "doc_id bigint, text string, source string, size string, copies int, k int, order string"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    queries.table(spark, "/root/testdata/sf0.001", "region")  # lets the workers find the package


def plain_targets(totals: dict) -> dict:
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, out, open_ = 1.5 * sum(totals.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * totals[s]}
        if not over:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: 2.0 * totals[s] for s in over}
        left -= sum(2 * totals[s] for s in over)
        open_ -= over
    return out


def plain_tilt(sizes: list[int], target: float) -> float:
    low, high = -45.0, 45.0
    for _ in range(200):
        mid = (low + high) / 2
        got = sum(2 * s / (1 + math.exp(-max(-700.0, min(700.0, mid * s)))) for s in sizes)
        low, high = (mid, high) if got < target else (low, mid)
    return (low + high) / 2


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choices(["a", "bc", "dé", "☃"], k=n))
    rows = [(k, text(int(rng.paretovariate(0.9)) + rng.randint(0, 40)), rng.choice(["s1", "s2", "s2", "s2", "é", None]), "x", 1, 2, "o") for k in range(900)]
    rows += [(5000 + k, "one two\tthree\x0bfour five", "hot", None, None, None, None) for k in range(700)]  # copies of one size
    rows += [(None, None, "s1", "", 0, 0, ""), (7, "", None, "", 0, 0, ""), (None, " \n", "empty", "", 0, 0, ""), (8, text(9000), "s2", "", 0, 0, "")]
    return rows + rows[:3] * 2


def test_mixing(spark, documents):
    docs = spark.createDataFrame(documents, DOCUMENTS).repartition(5)
    got = mixing.digests(spark, docs).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    source = collections.defaultdict(list)
    for _, t, s, *_ in documents:
        source[s].append(words(t))
    totals = {s: sum(v) for s, v in source.items()}
    want = plain_targets(totals)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.source_size) for r in got) == sorted((d if d is not None else -1, words(t), totals[s]) for d, t, s, *_ in documents)
    by_size = {v: s for s, v in totals.items()}
    taken = collections.Counter()
    for r in got:
        s = by_size[r.source_size]
        assert r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 12, (s, t, taken[s])
    assert sorted(map(str, got)) == sorted(map(str, mixing.digests(spark, docs.repartition(3, "text")).collect()))


def test_mixing_rates_are_tilted_exponentially(spark, documents):
    docs = spark.createDataFrame(documents, DOCUMENTS)
    tables = mixing._Tables(spark)
    counts = mixing.sizes(docs).groupBy("source", "size").count().withColumnRenamed("count", "n")
    sources = tables.kept(mixing.targets(mixing.weighted(tables, counts)))
    named = tables.kept(counts.alias("a").join(sources.select("source", "k").alias("b"), counts.source.eqNullSafe(sources.source)).select("k", "size", "n"))
    tilt = {r.k: r.tilt for r in mixing.tilts(tables, named, sources).collect()}
    histogram = collections.defaultdict(list)
    for r in named.collect():
        histogram[r.k] += [r.size] * r.n
    for r in sources.collect():
        if 0 < r.target < 2 * r.total:
            assert tilt[r.k] == pytest.approx(plain_tilt(histogram[r.k], r.target), rel=1e-3, abs=1e-9)
    copies = {(r.k, r["size"]): r.copies for r in mixing.bin_copies(tables, named, sources, spark.createDataFrame(list(tilt.items()), "k bigint, tilt double")).collect()}
    assert all(0 <= copies[r.k, r["size"]] <= 2 * r.n for r in named.filter("size > 0").collect())


def test_mixed_rows(spark, documents):
    docs = spark.createDataFrame(documents, DOCUMENTS)
    rows = mixing.mixed(spark, docs).collect()
    chosen = mixing.mix(spark, docs).groupBy("doc_id", "order").sum("copies").collect()
    assert len(rows) == sum(r["sum(copies)"] for r in chosen) and rows[0].asDict().keys() == {*docs.columns, "copy_no"}
    assert all(r.text.strip() for r in rows)


@pytest.mark.parametrize("rows", [[], [(None,) * 7] * 2, [(1, "", "a", "", 0, 0, "")], [(1, "one", None, "", 0, 0, "")]])
def test_mixing_small(spark, rows):
    got = mixing.digests(spark, spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert len(got) == len(rows) and sum(r.taken for r in got) <= 2


def plain_trie(rows, height_free=True) -> list[tuple]:
    convs = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    own = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        own[c] = tuple(original.get(c - c % 5, [])[:h] + turns[h:])
    nodes = collections.defaultdict(list)
    for c in sorted(own):
        for d in range(len(own[c]) + 1):
            nodes[own[c][:d]].append(c)
    children, leaves, saved = collections.Counter(p[:-1] for p in nodes if p), collections.Counter(), collections.Counter()
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1].encode()) if path else 0
    sha = lambda p: hashlib.sha256(",".join(str(c) for c in nodes[p] if own[c] == p).encode()).hexdigest()
    return sorted(map(str, ((m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], sha(p)) for p, m in nodes.items())))


def trie_rows(got) -> list[str]:
    return sorted(str((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)) for r in got)


def conversations(seed=3):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", None]), rng.choice(["hi", "é" * 3, "", None, f"own {c}"] if t else ["hello", "hi"]), "n", 1, 2) for c in range(80) for t in range(rng.randint(0, 14))]
    rows += [(c, t, "user", f"same {t}", "n", 1, 2) for c in range(100, 140) for t in range(6)]  # one conversation many times
    rows += [(c, t, "x", f"long {t if c < 210 or t < 90 else -t}", "n", 1, 2) for c in (200, 205, 210) for t in range(150)]
    rows += [(300, None, "a", "null turn", "", 0, 0), (300, 1, None, None, "", 0, 0), (None, 1, "a", "b", "", 0, 0), (400, -5, "a", "z" * 100_000, "", 0, 0)]
    rng.shuffle(rows)
    return rows


def test_trie(spark):
    rows = conversations()
    got = conversation_trie.digests(spark, spark.createDataFrame(rows, CONVERSATIONS).repartition(5)).collect()
    assert trie_rows(got) == plain_trie(rows)


def test_trie_bands_and_stretches(spark):
    """Small bands and stretches give the same nodes, through several levels of both."""
    rows = conversations(4)
    frame = spark.createDataFrame(rows, CONVERSATIONS)
    for height, stretch in ((2, 4), (3, 9)):
        tables = conversation_trie._Tables(spark)
        turns, convs = conversation_trie.rebuilt(tables, frame)
        got = conversation_trie.trie(spark, tables.kept(turns), convs, tables, height, stretch).collect()
        assert trie_rows(got) == plain_trie(rows)


def test_trie_repeated_rows_and_empty(spark):
    rows = [(5, 1, "a", "b", "", 0, 0)] * 3 + [(6, 0, "a", "b", "", 0, 0)] * 2 + [(1, None, None, None, "", 0, 0)]
    assert trie_rows(conversation_trie.digests(spark, spark.createDataFrame(rows, CONVERSATIONS)).collect()) == plain_trie(rows)
    for nothing in ([], [(None,) * 7]):
        assert conversation_trie.digests(spark, spark.createDataFrame(nothing, CONVERSATIONS)).count() == 0


def plain_lloyd(rows, dims, clusters, rounds=3):
    kept = [(v, [math.floor(64 * float(x)) for x in e]) for v, e, *_ in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    name = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [q for _, q in sorted(kept, key=name)[:clusters]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, q in kept:
            members[near(q)[1]].append(q)
        for k, qs in members.items():
            centres[k] = [sum(col) // len(qs) for col in zip(*qs, strict=True)]
    found = [(v, *near(q)) for v, q in kept]
    inertia = collections.Counter()
    for _, d, k in found:
        inertia[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(str((v, k, d, inertia[k], sum(inertia.values()), sha[k])) for v, d, k in found)


def test_lloyd(spark):
    rng = random.Random(9)
    rows = [(k, [rng.gauss((k % 7) - 3, 0.4) for _ in range(10)], 1, 2, 3, "c") for k in range(400)]
    rows = [(a, [float(f"{x:.3f}") for x in e], *r) for a, e, *r in rows]
    rows += [(1000 + k, [0.5] * 10, 0, 0, 0, "") for k in range(200)] + [rows[0]] * 3  # ties and copies
    rows += [(None, [1.0] * 10, 0, 0, 0, ""), (1, None, 0, 0, 0, ""), (2, [], 0, 0, 0, ""), (3, [1.0] * 9, 0, 0, 0, ""), (4, [1.0] * 9 + [None], 0, 0, 0, "")]
    rows += [(5, [float("nan")] + [0.0] * 9, 0, 0, 0, ""), (6, [float("-inf")] + [0.0] * 9, 0, 0, 0, ""), (9, [-0.001] * 10, 0, 0, 0, "")]
    frame = spark.createDataFrame(rows, VECTORS).repartition(4)
    exact = [tuple(r) for r in frame.collect()]  # floats as the table holds them
    for width, clusters in ((4, 16), (10, 3)):
        got = centroids.digests(spark, frame, dims=10, width=width, clusters=clusters)
        shown = sorted(str((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)) for r in got.collect())
        assert shown == plain_lloyd(exact, 10, clusters)


def test_lloyd_small(spark):
    few = [(k, [float(k)] * 10, 0, 0, 0, "") for k in range(3)]
    got = centroids.digests(spark, spark.createDataFrame(few, VECTORS), dims=10, width=4).collect()
    assert [r.distance for r in got] == [0, 0, 0] and len({r.cluster for r in got}) == 3
    big = [(0, [1e30] * 10, 0, 0, 0, ""), (1, [-1e30] * 10, 0, 0, 0, "")]
    assert centroids.digests(spark, spark.createDataFrame(big, VECTORS), dims=10, width=4, clusters=1).count() == 2
    for nothing in ([], [(None,) * 6]):
        assert centroids.digests(spark, spark.createDataFrame(nothing, VECTORS), dims=10).count() == 0
