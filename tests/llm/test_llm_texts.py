"""Operators over whole texts, against plain versions, on awkward rows, empty tables and the test tables."""

from __future__ import annotations

import collections
import functools
import hashlib
import zlib

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from civicledger.llm import bpe, components, credential_links, fmindex, grammar, packing, partenum, queries, radix_dedup, sharding, weighted_fingerprint
from civicledger.session import scratch_dir


@pytest.fixture(scope="module")
def rows():
    return brute.awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    queries.table(spark, "/root/testdata/sf0.001", "region")  # lets the workers find the package
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


@pytest.fixture(scope="module")
def nulls(spark):
    """Rows that are null in every column, twice."""
    return spark.createDataFrame([(None,) * 10] * 2, brute.SCHEMA)


@functools.cache
def untouched():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def encoded(text, end):
    return untouched().encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_encode_like_whole_texts():
    texts = ["a  b.\n\nC,d 'll I'm\n x", ".a .b..,c\r\n\r\n", "x y   z　　q", "\x1c a\x85\x85 b", "n1,2.5 é.é, end ", " \n a", "<|endoftext|> x", None, "", "a  \n\n<|endoftext|>\n\n b. <|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext", "z"]
    for kind in (pa.string(), pa.large_string()):
        ids, at = bpe.encoder(bpe.default_path()).encode(pa.array(texts, kind))
        assert len(at) == len(texts) + 1 and at[-1] == len(ids)
        for k, text in enumerate(texts):
            assert ids[at[k] : at[k + 1]].tolist() + [9] == encoded(text, 9)
    assert encoded("<|endoftext|> x", 9) == [50256, 2124, 9]


def test_tokens_of_rows_that_share_an_id_have_one_order(spark):
    rows = [(None, f"text {k}", "x") for k in range(60)] + [(5, f"other {k % 7}", "y") for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, order string")
    got = []
    for parts in (1, 7):
        path = scratch_dir(spark, "t")
        grammar.write(frame.repartition(parts, "text"), path)
        got.append(sorted(map(str, grammar.read_digests(spark, path).collect())))
    assert got[0] == got[1]


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    ids = np.r_[np.tile([5, 6, 7], 400), rng.integers(0, 9, 3000), np.zeros(500, int)].astype(np.uint32)
    symbols, rules, lengths = grammar.compress(ids, 100, least=4)
    assert len(symbols) < len(ids) / 2 and len(rules)
    assert (grammar.expand(symbols, rules, 100) == ids).all() and (grammar.expand_all(symbols, rules, lengths, 100) == ids).all()
    for start, stop in [(0, 1), (17, 18), (1199, 1300), (4000, len(ids)), (5, 5)]:
        assert (grammar.decode(symbols, rules, lengths, 100, start, stop) == ids[start:stop]).all()
    assert not len(grammar.expand(np.empty(0, np.int64), rules, 100)) and not len(grammar.expand_all(np.empty(0, np.int64), rules, lengths, 100))
    plain = np.arange(9, dtype=np.int64)
    assert (grammar.expand_all(plain, np.empty((0, 2), np.int64), np.empty(0, np.int64), 100) == plain).all()


def test_repeated_passages_become_one_symbol():
    passage = np.random.default_rng(5).permutation(500) + 100
    ids = np.concatenate([np.r_[k, passage] for k in range(40)]).astype(np.uint32)
    symbols, rules, lengths = grammar.compress(ids, 1000)
    assert len(symbols) == 80 and len(set(symbols[1::2].tolist())) == 1 and lengths[symbols[1] - 1000] == 500
    assert (grammar.decode(symbols, rules, lengths, 1000, 507, 1100) == ids[507:1100]).all()
    # Nothing frequent is left, however the pairs came about.
    ids = np.random.default_rng(6).zipf(1.3, 60_000) % 50
    symbols, rules, lengths = grammar.compress(ids, 50)
    pairs = collections.Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist()))
    assert max(n for (a, b), n in pairs.items() if a != b) < grammar.LEAST_COUNT and (grammar.expand(symbols, rules, 50) == ids).all()


def test_token_files(spark, docs, rows, empty, nulls):
    path = scratch_dir(spark, "t")
    grammar.write(docs, path, block_tokens=5000)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in grammar.read_digests(spark, path).collect())
    at, want = 0, []
    for r in sorted(rows, key=lambda r: r[0]):
        ids = encoded(r[1], 0)
        want.append((at, r[0], len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    chosen = rows[3]
    assert grammar.read_document(spark, path, chosen[0]) == [encoded(chosen[1], 0)] * 3
    for frame, n in ((empty, 0), (nulls, 2)):
        path = scratch_dir(spark, "t")
        grammar.write(frame, path)
        assert grammar.read_digests(spark, path).count() == n


def test_jump_hash_moves_rows_into_the_new_shard_only():
    keys = np.random.default_rng(2).integers(0, 1 << 63, 20_000).astype(np.uint64)
    for n in (1, 2, 16, 99):
        one, two = sharding.jump(keys, n), sharding.jump(keys, n + 1)
        moved = one != two
        assert one.max() < n and (two[moved] == n).all()
        assert abs(moved.mean() - 1 / (n + 1)) < 0.02


def test_shards(docs, rows, empty, nulls):
    got = sharding.assign(docs).collect()
    assert len(got) == len(rows)
    slots = collections.defaultdict(list)
    for r in got:
        raw = (brute.by_id(rows)[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key") and r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(empty).count() == 0
    assert sorted(r.slot for r in sharding.assign(nulls).collect()) == [0, 1]


def test_patterns_hold_every_piece_once():
    rng = np.random.default_rng(3)
    for _ in range(20):
        room = int(rng.integers(1, 60))
        histogram = {int(k): int(rng.integers(1, 50)) for k in rng.integers(1, room + 1, 12)}
        patterns = packing.pack_histogram(histogram, room)
        used = collections.Counter()
        for p in patterns:
            assert sum(n * t for n, t in p.items) <= room
            for n, t in p.items:
                used[n] += t * p.count
        assert used == histogram
        places = packing.Places.of(patterns)
        cells = set()
        for n, count in histogram.items():
            sequence, offset = places.find(np.full(count, n), np.arange(count))
            for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
                own = {(s, o + k) for k in range(n)}
                assert o + n <= room and not own & cells
                cells |= own
    assert packing.pack_histogram({}, 8) == []


def test_packing(spark, docs, rows, empty, nulls):
    path = scratch_dir(spark, "t")
    packing.write_pieces(docs, path)
    got = packing.place(spark, path).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for r in set(rows):
        ids = encoded(r[1], 1)
        want = collections.Counter((s, len(ids[s : s + 2048]), crc(ids[s : s + 2048]), len(ids)) for s in range(0, len(ids), 2048))
        times = sum(x == r for x in rows)
        assert collections.Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[r[0]]) == {k: v * times for k, v in want.items()}
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    whole = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(spark, path).collect()}
    for s, parts in by_sequence.items():
        n = sum(k for _, k in parts)
        assert whole[s] == (n if n & (n - 1) == 0 else 2048)
    for frame, n in ((empty, 0), (nulls, 2)):
        path = scratch_dir(spark, "t")
        packing.write_pieces(frame, path)
        assert packing.place(spark, path).count() == n


def test_components(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 90), (90, 100), (95, 100), (7, 7)]
    got = dict(map(tuple, components.components(spark, spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {**{k: 0 for k in range(1, 41)}, 95: 90, 100: 90}
    assert components.components(spark, spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for size in [1, 2, 3, 4, 5, 7, 9, 16, 17, 40, 64, 65, 130, 257, 700, 1025]:
        for _ in range(25):
            one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            gone = int(rng.integers(0, size // 5 + 1))
            more = int(max(0, (len(one) - gone) * 10 // 8 - len(one)))
            two = np.unique(np.r_[rng.permutation(one)[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, more + 1))).astype(np.uint64)])
            shared = len(np.intersect1d(one, two))
            if 100 * shared >= 80 * (len(one) + len(two) - shared):
                assert set(partenum.signatures(one).tolist()) & set(partenum.signatures(two).tolist())


def test_near_copies(spark, docs, rows, empty, nulls):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.groups(spark, docs).collect()}
    assert got == brute.groups(brute.by_id(rows))
    assert len({c for _, c in got.values()}) < len(got)
    assert partenum.groups(spark, docs).count() == len(rows)
    assert partenum.groups(spark, empty).count() == 0
    assert [tuple(r) for r in partenum.groups(spark, nulls).collect()] == [(None, 0, None)] * 2


def test_unlike_texts_in_one_bucket(spark, monkeypatch):
    """Hundreds of texts with a common passage aren't alike; chains of like ones among them are still found, in blocks of any size."""
    rng = np.random.default_rng(8)
    common = [f"c{i}" for i in range(160)]
    rows = []
    for k in range(240):
        rows.append((k, " ".join(common + [f"k{k}x{i}" for i in range(60)])))
    chain = rows[0][1].split(" ")
    for k in range(240, 300):  # each is like the one before, the ends aren't
        for at in rng.choice(220, 2, replace=False):
            chain[at] = f"e{k}x{at}"
        rows.append((k, " ".join(chain)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = brute.groups(dict(rows))
    assert len({c for _, c in want.values()}) > 200
    for block, features in ((partenum.BLOCK, partenum.BLOCK_FEATURES), (32, 4000)):
        monkeypatch.setattr(partenum, "BLOCK", block)
        monkeypatch.setattr(partenum, "BLOCK_FEATURES", features)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.groups(spark, frame).collect()} == want


def test_links_of_a_group_are_a_forest():
    """However many pairs are alike, fewer links come out than rows went in, and they connect the same rows."""
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64))
    sets = [np.unique(np.r_[base[: 300 - k % 20], rng.integers(0, 1 << 62, 5).astype(np.uint64)]) for k in range(200)]
    sets += [np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64)) for _ in range(100)]
    n = len(sets)
    table = pa.table({"s": [7] * n, "i": pa.array([0] * n, pa.int32()), "j": pa.array([0] * n, pa.int32()), "block": pa.array([0] * n, pa.int32()), "doc_id": list(range(n)), "c": list(range(n)), "features": [x.view(np.int64).tolist() for x in sets]})
    out = pa.Table.from_batches(partenum._links(iter(table.to_batches(max_chunksize=50))))
    u, v = (out.column(c).to_numpy() for c in "uv")
    root = partenum.united(np.arange(n), u, v)
    assert len(u) == 199 and (root[:200] == 0).all() and (root[200:] == np.arange(200, 300)).all()


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Copies with edits of their own: no two are as like each other as each is to the first."""
    rows = []
    for k in range(60):
        w = [f"w{i}" for i in range(60)]
        if k:
            w[(7 * k) % 55] = f"x{k}"
        rows.append((k, " ".join(w)))
    got = partenum.groups(spark, spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = brute.groups(dict(rows))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_wavelet_ranks_and_search():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 37, 500)
    wavelet = fmindex.WaveletMatrix(symbols)
    for _ in range(200):
        c, p = int(rng.integers(0, 37)), int(rng.integers(0, 501))
        assert wavelet.rank(np.array([c]), np.array([p]))[0] == (symbols[:p] == c).sum()
    text = np.r_[rng.integers(1, 4, 300), 0, np.full(50, 2), 0]
    index = fmindex.FMIndex(text, sample=4)
    patterns = [tuple(rng.integers(1, 5, n)) for n in (1, 2, 3, 5) for _ in range(20)] + [(2,) * 30]
    table = np.zeros((len(patterns), 30), np.int64)
    for k, p in enumerate(patterns):
        table[k, : len(p)] = p
    low, high = index.search(table, np.array([len(p) for p in patterns]))
    for k, p in enumerate(patterns):
        want = [i for i in range(len(text) - len(p) + 1) if tuple(text[i : i + len(p)]) == p]
        assert sorted(index.locate(np.arange(low[k], max(low[k], high[k]))).tolist()) == want


def test_decontamination(spark, docs, rows, empty, nulls):
    passage = next(r[1] for r in rows if r[1] and "\n" in r[1] and len(r[1]) > 300).split("\n")[0]
    items = [(1, passage), (2, " ".join(passage.split()[5:12])), (2, "nowhere to be found"), (10, "Two Words"), (11, None), (12, "!?"), (None, passage.upper()), (13, "ab ab ab ab ab ab ab ab ab ab ab")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute.contamination(brute.by_id(rows), items)
    for most in (fmindex.BLOCK_WINDOWS, 20):  # one block, several
        got = fmindex.digests(fmindex.hits(docs, bench, block_windows=most)).collect()
        assert len(got) == len(rows) and {r.doc_id: tuple(r)[1:] for r in got} == want
    assert sum(w[-1] for w in want.values()) > 20
    assert fmindex.hits(empty, bench).count() == 0
    assert [tuple(r)[1:3] for r in fmindex.digests(fmindex.hits(nulls, bench)).collect()] == [(0, 0)] * 2
    assert not fmindex.digests(fmindex.hits(docs, bench.limit(0))).filter("contaminated").count()


def test_secrets(spark, empty, nulls):
    value = "Zx9" + "aB3dE5fG7hJ9kL1mN2" + "q"
    texts = [
        None, "", 'token = "abc"', "password: token: abcdefgh", "API_KEY='abcdef' x \U0001f600 passwd=1234567", "AKIA" + "A" * 16 + " " + "AKIA" + "B" * 15, "x" + "0f" * 12 + "g" + "0f" * 11,
        f"login: alice and then {value} here", f"{value} alone", f"see https://api.example.com/v1 with {value}", f"login: bob {'z' * 400} {value}", "https://api.example.com alone", "secret=" + "ab" * 20, ("AKIA" + "C" * 16 + " ") * 300,
    ]
    frame = spark.createDataFrame([(k, t, "y", 5) for k, t in enumerate(texts)] * 2, "doc_id bigint, text string, row string, m0 int")
    got = credential_links.digests(spark, frame).collect()
    assert len(got) == 2 * len(texts)
    linked = {}
    for r in got:
        want = brute.secrets(texts[r.doc_id])
        base = ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w[1] == k for w in want) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        parts = [p for p in r.spans.split(",") if p]
        assert [p for p in parts if not p.startswith("linked")] == [p for p in base.split(",") if p]
        linked[r.doc_id] = [p.split(":")[0] for p in parts if p.startswith("linked")]
    assert {k: v for k, v in linked.items() if v} == {7: ["linked_name", "linked_value"], 9: ["linked_address", "linked_value"]}
    masked = {r.doc_id: r for r in credential_links.redacted(spark, frame).collect()}
    assert masked[2].text == texts[2] and masked[0].text is None and masked[12].text == "[SECRET]" and masked[12].row == "y"
    assert masked[7].text == "[SECRET] and then [SECRET] here"
    assert masked[13].text == "[SECRET] " * 300
    assert credential_links.digests(spark, empty).count() == 0 and credential_links.redacted(spark, empty).count() == 0
    assert [r.spans for r in credential_links.digests(spark, nulls).collect()] == ["", ""]


def test_fingerprints(spark, docs, rows, empty, nulls):
    got = weighted_fingerprint.compared(spark, docs).collect()
    assert len(got) == len(rows)
    texts, marks = brute.by_id(rows), {}
    ids = sorted(texts, reverse=True)
    errors = []
    for r in got:
        own, after = texts[r.doc_id] or "", texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert marks.setdefault(own, r.fingerprint) == r.fingerprint
        one, two = (collections.Counter(t.replace("\n", " ").replace("\t", " ").split(" ")) for t in (own, edited))
        del one[""], two[""]
        if one or two:
            errors.append(r.near_edited - sum((one & two).values()) / sum((one | two).values()))
        else:
            assert r.near_edited == 1
    assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.12
    assert weighted_fingerprint.compared(spark, empty).count() == 0
    assert [(r.doc_id, r.near_edited, r.near_next) for r in weighted_fingerprint.compared(spark, nulls).collect()] == [(None, 1.0, 1.0)] * 2


def test_collisions_estimate_weighted_jaccard(spark):
    texts = [("a " * 9 + "b " * 3, "a " * 3 + "b " * 3 + "c " * 6), ("x y z " * 5, "x y z " * 5), ("p " * 40, "p " * 10), ("q r", "s t")]
    frame = spark.createDataFrame([(2 * k + j, t) for k, pair in enumerate(texts) for j, t in enumerate(pair)], "id bigint, text string")
    f = {r.id: np.array(r.f) for r in weighted_fingerprint.fingerprints(spark, frame, ["id"], samples=256, terms=1 << 10).collect()}
    for k, (one, two) in enumerate(texts):
        a, b = collections.Counter(one.split()), collections.Counter(two.split())
        true = sum((a & b).values()) / sum((a | b).values())
        assert abs((f[2 * k] == f[2 * k + 1]).mean() - true) < 0.11


def test_long_texts_without_a_common_word_share_no_sample(spark):
    texts = [" ".join(f"{c}{k}" for k in range(20_000)) for c in "ab"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    one, two = (r.f for r in weighted_fingerprint.fingerprints(spark, frame, ["id"]).collect())
    assert not any(x == y for x, y in zip(one, two, strict=True))


def test_repeats(spark, docs, rows, empty, nulls):
    want = brute.without_repeats(brute.by_id(rows))
    for hot in (radix_dedup.HOT, 1):
        got = radix_dedup.digests(radix_dedup.cleaned(spark, docs, hot=hot)).collect()
        assert len(got) == len(rows) and {r.doc_id: tuple(r)[1:] for r in got} == want
    assert sum(w[1] > 0 for w in want.values()) > 20
    assert radix_dedup.cleaned(spark, empty).count() == 0
    assert [tuple(r)[1:4] for r in radix_dedup.digests(radix_dedup.cleaned(spark, nulls)).collect()] == [(0, 0, 0)] * 2


def test_repeats_among_rows_that_share_an_id(spark):
    """As if each distinct text had an id of its own, in the order of the keys; equal rows are one document."""
    rng = np.random.default_rng(7)
    prose = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passages = [prose(150) for _ in range(20)]
    texts = [prose(int(rng.integers(0, 300))) + passages[k % 20] + prose(int(rng.integers(0, 300))) for k in range(1000)]
    frame = spark.createDataFrame([(None, t) for t in [*texts, *texts[:50]]], "doc_id bigint, text string")
    keys = {r.text: r.h for r in radix_dedup.keyed(frame).collect()}
    want = brute.without_repeats({keys[t]: t for t in texts})
    expected = sorted([want[keys[t]] for t in [*texts, *texts[:50]]])
    for docs, hot in ((frame.coalesce(1), radix_dedup.HOT), (frame.repartition(3), 1)):
        got = radix_dedup.digests(radix_dedup.cleaned(spark, docs, hot=hot)).collect()
        assert sorted(tuple(r)[1:] for r in got) == expected


def test_equal_rows_are_one_document_from_the_start(spark):
    """However often a text is repeated, its stretches are looked at once."""
    rng = np.random.default_rng(9)
    prose = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared = prose(400)
    one, two = (5, prose(200) + shared), (6, shared[:250] + prose(300) + shared)
    spans = {}
    for n in (1, 300):
        frame = spark.createDataFrame([one] * n + [two] * n + [(7, "")] * n, "doc_id bigint, text string").repartition(4)
        spans[n] = sorted(map(tuple, radix_dedup.repeats(spark, frame).collect()))
        got = radix_dedup.digests(radix_dedup.cleaned(spark, frame)).collect()
        want = brute.without_repeats({5: one[1], 6: two[1], 7: ""})
        assert len(got) == 3 * n and {(r.doc_id, *tuple(r)[1:]) for r in got} == {(k, *v) for k, v in want.items()}
    assert spans[1] == spans[300] and spans[1]


def test_stretches_cover_every_window_once():
    rng = np.random.default_rng(6)
    data = rng.integers(0, 3, 3000).astype(np.uint8)
    offsets = np.array([0, 0, 99, 199, 199, 1000, 3000])
    text, a, b, p, anchor, whole = radix_dedup.stretches(data, offsets, 100, 24)
    covered = sorted(s for x, y in zip(a.tolist(), b.tolist(), strict=True) for s in range(x, y + 1))
    assert covered == [s for k in range(6) for s in range(offsets[k], offsets[k + 1] - 99)]
    assert ((p >= b) & (p <= a + 76)).all() and (b - a < 77).all()
