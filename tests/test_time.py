"""Values that hold at a time, validity spans, one-to-one choices, and tables kept up while facts change."""

from __future__ import annotations

import glob
import os
import random
import threading
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from civicledger.operators import crosswalk as C
from civicledger.operators import segments as G
from civicledger.operators.asof import as_of
from civicledger.session import scratch_dir
from civicledger.sources.manifest_versions import VersionedManifest
from civicledger.sources.processed import read_processed, write_changed


def plain_as_of(facts, steps):
    held = {}
    for by, since, value in steps:
        if by is not None and since is not None:
            held.setdefault(by, {}).setdefault(since, set()).add(value)
    out = []
    for key, by, at in facts:
        earlier = [s for s in held.get(by, {}) if at is not None and s <= at]
        last = max(earlier, default=None)
        values = held[by][last] if last is not None else {None}
        out.append((key, by, at, next(iter(values)) if len(values) == 1 else None, last))
    return sorted(out, key=str)


def test_as_of(spark):
    rng = random.Random(2)
    day = lambda: date(2010, 1, 1) + timedelta(days=rng.randrange(900))
    facts = [(k, rng.choice(["hot", "hot", "hot", "A", "B", "none", None]), day() if rng.random() > 0.05 else None) for k in range(600)]
    facts += [(1000 + k, "hot", date(2011, 5, 5)) for k in range(300)]
    steps = [(rng.choice(["hot", "A", "B", None]), day(), rng.choice([1, 2, 3, None])) for _ in range(120)]
    steps += [("A", date(2010, 6, 1), 7), ("A", date(2010, 6, 1), 8), ("B", None, 5), ("hot", date(2009, 1, 1), 9)] + steps[:5]
    frame = spark.createDataFrame(facts, "k int, by string, at date").repartition(4)
    known = spark.createDataFrame(steps, "by string, since date, value int").repartition(3)
    got = sorted(((r.k, r.by, r.at, r.value, r.since) for r in as_of(frame, known, "by", "at", "since", "value").collect()), key=str)
    assert got == plain_as_of(facts, steps)
    assert as_of(frame, known.limit(0), "by", "at", "since", "value").where("value IS NOT NULL").count() == 0
    assert as_of(frame.limit(0), known, "by", "at", "since", "value").count() == 0


def test_spans_are_disjoint_and_complete(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["A b", "a-B", "c"]), rng.choice("XYZ"), y, y + rng.randint(0, 4)) for y in [rng.randint(2000, 2020) for _ in range(25)]] + [("open", "X", None, 2005), ("open", "Y", 2004, None), ("none", None, 1, 2)]
    crosswalk = spark.createDataFrame(rows, "alias string, canonical string, valid_from int, valid_to int")
    spans = C.crosswalk_spans(crosswalk).collect()
    for alias in ("a b", "c", "open"):
        own = sorted((s for s in spans if s.alias == alias), key=lambda s: s.valid_from)
        assert all(a.valid_to < b.valid_from for a, b in zip(own, own[1:]))
        assert all((a.valid_to + 1, a.canonical, a.n_keys) != (b.valid_from, b.canonical, b.n_keys) or a.n_keys > 1 for a, b in zip(own, own[1:]))
        for year in range(1998, 2028):
            keys = {k for n, k, f, t in rows if k and n.lower().replace("-", " ") == alias and (f or 0) <= year <= (t or 9999)}
            found = [s for s in own if s.valid_from <= year <= s.valid_to]
            assert len(found) == (1 if keys else 0) and (not keys or (found[0].n_keys, found[0].canonical) == (len(keys), keys.pop() if len(keys) == 1 else None))
    facts = spark.createDataFrame([("A-B!", y) for y in range(1995, 2030)] + [("new", 2010), (None, 2010), ("c", None)], "name string, year int")
    by_span = C.apply_spans(facts, C.crosswalk_spans(crosswalk), "name", "year")
    assert sorted(map(str, by_span.collect())) == sorted(map(str, C.apply_crosswalk(facts, crosswalk, "name", "year").collect()))


def test_one_to_one_choice_is_greedy(spark):
    rng = random.Random(6)
    pairs = [(f"n{rng.randrange(25)}", f"c{rng.randrange(20)}", rng.randrange(4)) for _ in range(160)] + [("n0", None, 0), (None, "c0", 0)]
    cheapest = {}
    for n, c, e in pairs:
        if n and c:
            cheapest[n, c] = min(e, cheapest.get((n, c), 9))
    left, right, want = set(), set(), set()
    for e, n, c in sorted((e, n, c) for (n, c), e in cheapest.items()):
        if n not in left and c not in right:
            left.add(n), right.add(c), want.add((n, c, e))
    frame = spark.createDataFrame(pairs, "name string, canonical string, edits int")
    assert {tuple(r) for r in C.assign_matches(spark, frame).collect()} == want
    assert C.assign_matches(spark, frame.limit(0)).count() == 0


def entries(spark, run, paths):
    return spark.createDataFrame([(p, f"2024-01-{run:02d}T00:00:00Z", run, "x") for p in paths], "relative_path string, timestamp string, size_bytes int, checksum string")


def test_writers_at_the_same_time_lose_nothing(spark):
    path = scratch_dir(spark, "versions")
    assert VersionedManifest(spark, path).versions() == []
    with pytest.raises(ValueError):
        VersionedManifest(spark, path).read()
    VersionedManifest(spark, path).commit(entries(spark, 1, ["first"]))
    errors = []

    def write(writer):
        try:
            for k in range(4):
                VersionedManifest(spark, path).commit(entries(spark, 2 + writer, [f"w{writer}-{k}", "shared"]))
        except Exception as error:  # shown by the assertion below
            errors.append(error)

    threads = [threading.Thread(target=write, args=(w,)) for w in range(3)]
    for t in threads:
        t.start()
    VersionedManifest(spark, path).compact()
    for t in threads:
        t.join()
    assert not errors
    manifest = VersionedManifest(spark, path)
    assert manifest.versions() == list(range(1, 15))
    assert {r.relative_path for r in manifest.read().collect()} == {"first", "shared"} | {f"w{w}-{k}" for w in range(3) for k in range(4)}
    assert [r.relative_path for r in manifest.read(1).collect()] == ["first"]


def test_versions_stay_as_they_were(spark):
    manifest = VersionedManifest(spark, scratch_dir(spark, "versions"))
    for run, paths in ((5, ["a", "b"]), (3, ["b", "c"]), (9, ["d"])):  # a later commit wins, whatever its times
        manifest.commit(entries(spark, run, paths))
    before = {v: sorted(map(tuple, manifest.read(v).collect())) for v in manifest.versions()}
    assert [r[2] for r in before[2]] == [5, 3, 3]
    assert manifest.compact() == 4 and len(manifest.commit_info(4)["live"]) == 1
    manifest.commit(entries(spark, 1, ["a"]))
    assert {v: sorted(map(tuple, manifest.read(v).collect())) for v in (1, 2, 3)} == before and sorted(map(tuple, manifest.read(4).collect())) == before[3]
    assert {r.relative_path: r.size_bytes for r in manifest.read().collect()} == {"a": 1, "b": 3, "c": 3, "d": 9}
    stale = VersionedManifest(spark, manifest.path)
    stale.versions = lambda: [1]  # a writer that hasn't seen the others: its number is taken
    assert stale._put_if_absent(2, {"live": []}) is False
    assert manifest.read().where(F.col("relative_path") == "a").count() == 1


def test_subtotals_kept_up_equal_full_ones(spark):
    rng = random.Random(7)
    fact = lambda: (rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), rng.choice([None, Decimal(1), Decimal(rng.randint(-9, 9))]))
    schema = "d string, e string, v decimal(20,2)"
    for cube in (False, True):
        held = [fact() for _ in range(40)]
        stored = G.kept_subtotals(spark.createDataFrame(held, schema), ["d", "e"], "v", cube)
        for _ in range(3):
            gone = [held.pop(rng.randrange(len(held))) for _ in range(min(len(held), rng.randint(5, 18)))]
            new = [fact() for _ in range(rng.randint(0, 6))]
            held += new
            changes = spark.createDataFrame([(*f, -1) for f in gone] + [(*f, 1) for f in new], schema + ", sign int")
            stored = G.changed_subtotals(stored, changes, ["d", "e"], "v", cube=cube)
            full = G.kept_subtotals(spark.createDataFrame(held, schema), ["d", "e"], "v", cube)
            assert sorted(map(str, stored.collect())) == sorted(map(str, full.select(*stored.columns).collect()))
        everything = spark.createDataFrame([(*f, -1) for f in held], schema + ", sign int")
        assert G.changed_subtotals(stored, everything, ["d", "e"], "v", cube=cube).count() == 0


def test_only_changed_periods_are_written(spark):
    path = scratch_dir(spark, "changed")
    rows = [(y, q, k, Decimal(k)) for y in (2011, 2012, None) for q in ("Q1", "Q2") for k in range(5)]
    frame = lambda rows: spark.createDataFrame(rows, "fiscal_year int, quarter string, k int, amount decimal(20,2)").repartition(2)
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/fiscal_year=*/*/*.parquet")}
    assert len(write_changed(spark, frame(rows), path)) == 6
    before = files()
    assert write_changed(spark, frame(rows[::-1]), path) == [] and files() == before
    changed = [(y, q, k, a + 1 if (y, q, k) == (2012, "Q1", 3) else a) for y, q, k, a in rows if (y, q) != (None, "Q2")]
    assert sorted(write_changed(spark, frame(changed), path), key=str) == [(2012, "Q1", "written"), (None, "Q2", "removed")]
    assert {f.split("fiscal_year=")[1][:7] for f in set(files()) ^ set(before)} == {"2012/qu", "__HIVE_"}
    assert sorted(map(str, read_processed(spark, path).select("fiscal_year", "quarter", "k", "amount").collect())) == sorted(map(str, frame(changed).collect()))
    assert write_changed(spark, frame(rows), path) and write_changed(spark, frame([rows[0], rows[0]]).limit(0), path)
