"""Operators on small invented inputs and their properties."""

from __future__ import annotations

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from civicledger.operators import balance as B
from civicledger.operators import crosswalk as C
from civicledger.operators import links as L
from civicledger.operators import manifest as M
from civicledger.operators import periods as P
from civicledger.operators import segments as G
from civicledger.operators.columns import add_once
from civicledger.session import scratch_dir
from civicledger.sources import manifest as store
from civicledger.sources.files import file_ends, file_inventory, read_files
from civicledger.sources.processed import read_processed, write_processed
from civicledger.sources.registry import SourceRegistry
from civicledger.sources.tables import read_appropriations, read_collections
from civicledger.functions.files import ZIP_TAIL_BYTES, parquet_status, workbook_status
from civicledger.streaming.ingest import compact, file_stream, ingest, ingested


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- links


def test_anchors(spark):
    html = """<!-- <a href="/no">x</a> --><script>"<a href=/no2>"</script><A class=x HREF = '/a b.pdf' >One <b> two</b></A>
      <a name="n">no address</a> <a data-href="/no3" href=/c.htm>Three<a href="&#47;d&amp;e">  </a><a href="/open">never closed"""
    df = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id int, html string")
    got = [(r.page_id, r.href, r.text) for r in L.page_anchors(df).orderBy("page_id", "pos").collect()]
    assert got == [(1, "/a b.pdf", "Onetwo"), (1, "/c.htm", "Three"), (1, "/d&e", ""), (1, "/open", "never closed")]


def links(spark, rows):
    return spark.createDataFrame(rows, "year int, quarter string, pos int, ext string, score int, url string")


def test_best_link_prefers_status_then_pdf_then_order(spark):
    rows = [
        (2013, "Q1", 0, "htm", 3, "a"),
        (2013, "Q1", 1, "pdf", 6, "b"),
        (2013, "Q2", 2, "htm", 1, "c"),
        (2013, "Q2", 3, "pdf", 1, "d"),
        (2013, "Q2", 4, "pdf", 1, "e"),
        (2013, "Q3", 5, "xlsx", 1, "f"),
        (2013, "Q4", 6, "pdf", 99, "g"),
        (2014, "Q1", 7, "htm", 7, "h"),
        (2014, "Q1", 8, "htm", 7, "i"),
    ]
    best = L.best_links(links(spark, rows))
    assert {(r.year, r.quarter, r.url) for r in best.collect()} == {(2013, "Q1", "a"), (2013, "Q2", "d"), (2014, "Q1", "h")}
    covered = L.coverage(best).first()
    assert (covered.n_quarters, covered.first_year, covered.last_year, covered.years) == (3, 2013, 2014, "2013,2014")


def test_empty_selection(spark):
    none = links(spark, [])
    assert L.best_links(none).collect() == []
    covered = L.coverage(L.best_links(none)).first()
    assert (covered.n_quarters, covered.first_year, covered.years) == (0, None, "")


def test_one_link_per_group_in_random_data(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice([2011, 2012]), f"Q{rng.randint(1, 4)}", i, rng.choice(["pdf", "htm", "xlsx"]), rng.choice([1, 3, 7, 99]), str(i))
        for i in range(500)
    ]
    want = {}
    for row in rows:
        year, quarter, pos, ext, score, url = row
        if ext != "xlsx" and score < 99:
            rank = (score, ext != "pdf", pos, url)
            want[year, quarter] = min(rank, want.get((year, quarter), rank))
    got = {(r.year, r.quarter): r.url for r in L.best_links(links(spark, rows).repartition(7)).collect()}
    assert got == {key: rank[3] for key, rank in want.items()}


def test_json_values_but_not_keys(spark):
    body = {"a": ["x.xlsx", {"b.xlsx": "plain", "n": 1}], "u": "/f.XLS?x=1", "esc": 'q"\\uoted.xls', "last": [[["https://o.org/z.xls"]]]}
    text = json.dumps(body).replace("/f", "\\/f").replace("x.xlsx", "\\u0078.xlsx", 1)
    html = f"<script type='a' id=\"__NEXT_DATA__\">{text}</script>"
    broken = html.replace("]]]", "")
    long = '<script id="__NEXT_DATA__">["' + '\\"' * 20000 + ' w.xls"]</script>'
    df = spark.createDataFrame([(1, html), (2, broken), (3, "<p>x.xlsx</p>"), (4, long)], "id int, html string")
    got = {r.id: r.u for r in df.select("id", L.json_urls(F.col("html"), F.lit("https://e.org/d/p")).alias("u")).collect()}
    assert got[1] == ["https://e.org/d/x.xlsx", "https://e.org/f.XLS?x=1", "https://e.org/d/q\"\\uoted.xls", "https://o.org/z.xls"]
    assert got[2] == [] and got[3] == []
    assert len(got[4]) == 1 and got[4][0].endswith(" w.xls")


def test_harvest_keeps_first_strategy_and_falls_back(spark):
    anchor = '<a href="/a.xlsx">x</a>'
    stream = "<script>self.__next_f.push(['\\/a.xlsx', \"https:\\/\\/o.org\\/b.xls?c\"])</script>"
    pages = [
        (1, "https://e.org/p", anchor + stream + anchor),
        (2, "https://e.org/p", "<p>nothing</p>"),
        (3, "https://e.org/direct.xls?x", anchor),
        (4, "https://e.org/p", "<script>'/c.xlsx'</script>"),
        (5, "https://e.org/p", f"<!-- {anchor}{stream}<script id='__NEXT_DATA__'>[\"a.xls\"]</script> -->"),
        (6, "https://e.org/d/p", "<script>'<!--'</script><script id=__NEXT_DATA__>[\"a.xls\"]</script>"),
    ]
    schema = "page_id int, url string, html string"
    rendered = [(i, u, f'<a href="/r{i}.xls">r</a><a href="/r{i}.xls">r</a><a href="/r.pdf">no</a>') for i, u, _ in pages[:3]]
    found = L.harvest_workbooks(spark.createDataFrame(pages, schema), spark.createDataFrame(rendered, schema))
    assert sorted((r.page_id, r.strategy, r.url) for r in found.collect()) == [
        (1, "anchor", "https://e.org/a.xlsx"),
        (1, "stream", "https://o.org/b.xls?c"),
        (2, "rendered", "https://e.org/r2.xls"),
        (3, "direct", "https://e.org/direct.xls?x"),
        (6, "json", "https://e.org/d/a.xls"),
    ]


# ---------------------------------------------------------------- manifests and files


def test_worklist_and_skipped_partition_the_input(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", "4")], "relative_path string, checksum string")
    manifest = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None), ("z", "4")], "relative_path string, checksum string")
    todo = {r.relative_path for r in M.worklist(files, manifest).collect()}
    done = {r.relative_path for r in M.skipped(files, manifest).collect()}
    assert todo == {"b", "c", "d"} and done == {"a"}
    assert {r.relative_path for r in M.orphans(manifest, files).collect()} == {"z"}


def test_upsert_is_idempotent_and_widens(spark):
    old = spark.createDataFrame([("a", "1", "t1"), ("b", "1", "t1")], "relative_path string, checksum string, timestamp string")
    new = spark.createDataFrame([("a", "2", "t2", "Q1")], "relative_path string, checksum string, timestamp string, quarter string")
    once = M.upsert(old, new)
    assert {(r.relative_path, r.checksum, r.quarter) for r in once.collect()} == {("a", "2", "Q1"), ("b", "1", None)}
    assert sorted(map(str, M.upsert(once, new).collect())) == sorted(map(str, once.collect()))


def test_arrival_decides_then_the_point_in_time(spark):
    schema = "relative_path string, checksum string, timestamp string, size_bytes int"
    old = spark.createDataFrame([("a", "9", "2024-05-01T00:00:00Z", 900), ("b", "1", "2024-01-01T00:00:00Z", 1)], schema)
    tie = spark.createDataFrame([("a", "1", "2024-05-01T00:00:00Z", 1)], schema)
    assert {(r.relative_path, r.checksum) for r in M.upsert(old, tie).collect()} == {("a", "1"), ("b", "1")}
    earlier = spark.createDataFrame([("a", "2", "2020-01-01T00:00:00Z", 1)], schema)
    assert {r.checksum for r in M.upsert(old, earlier).where("relative_path = 'a'").collect()} == {"2"}
    zones = spark.createDataFrame([("a", "late", "2024-01-01T00:00:00-05:00", 1), ("a", "early", "2024-01-01T03:00:00+00:00", 1)], schema)
    assert M.latest_entries(zones).first().checksum == "late"


def test_validation_counts_every_source(spark):
    files = spark.createDataFrame([("gaa/1", "gaa"), ("x/1", "new"), ("y/1", None)], "relative_path string, source string")
    entries = spark.createDataFrame([("gaa/1",), ("gone/1",)], "relative_path string")
    books = spark.createDataFrame([("b", "no_end_of_directory")], "relative_path string, status string")
    tables = spark.createDataFrame([("t", "truncated"), ("u", "ok")], "relative_path string, status string")
    got = M.validation_summary(files, entries.limit(0), books, tables, manifest_exists=True).first()
    assert (got.gaa_files, got.tax_files, got.other_files, got.manifest_entries, got.manifest_exists) == (1, 0, 2, 0, True)
    full = M.validation_summary(files, entries, books, tables, manifest_exists=False).first()
    assert (full.manifest_entries, full.manifest_orphans, full.parquet_errors, full.saaodb_xlsx_corrupt, full.manifest_exists) == (2, 1, 1, 1, False)
    kinds = {(r.file, r.error) for r in M.validation_details(files, entries, books, tables).collect()}
    assert kinds == {("gone/1", "orphan"), ("b", "corrupt_workbook"), ("t", "corrupt_table")}
    runs = spark.createDataFrame([(1, "a", True, 1, 0, 2.5, None)], "run_id int, name string, success boolean, files_downloaded int, files_skipped int, duration_seconds double, error string")
    report = json.loads(M.ingest_report(runs, M.validation_summary(files, entries, books, tables), "2024-02-01T00:00:00Z").first().report)
    assert report["timestamp"] == "2024-02-01T00:00:00Z" and report["validation"]["other_files"] == 2 and report["overall_success"] is True


def test_manifest_files(spark, tmp_path):
    entry = {"source": "s", "relative_path": "x/a.pdf", "size_bytes": 3, "checksum": "c", "timestamp": "2024-01-01T00:00:00Z", "extra": 1}
    (tmp_path / "one.json").write_text(json.dumps({"x/a.pdf": entry, "x/b.pdf": {**entry, "relative_path": "x/b.pdf", "year": "2013"}}, indent=4))
    (tmp_path / "two.json").write_text('{"x/c.pdf": {"source"')
    (tmp_path / "three.json").write_text("")
    got = {(r.relative_path, r.size_bytes, r.year) for r in store.read_manifest(spark, str(tmp_path)).collect()}
    assert got == {("x/a.pdf", 3, None), ("x/b.pdf", 3, "2013")}


def test_severity_and_ratio(spark):
    runs = spark.createDataFrame(
        [("GAA", True, None), ("my gaa", False, None), ("Tax", False, None), ("Tax", False, "boom")],
        "name string, success boolean, error string",
    )
    severity = runs.select(M.run_severity(F.col("name"), F.col("success"), F.col("error")).alias("s"))
    assert [r.s for r in severity.collect()] == ["info", "error", "warning", "exception"]
    assert M.overall_success(runs).first()[0] is True
    assert M.overall_success(runs.limit(0)).first()[0] is False
    outcomes = spark.createDataFrame([("downloaded",), ("skipped",), ("failed",), ("skipped",)], "status string")
    ratio = M.success_ratio(outcomes).first()
    assert (ratio.n_selected, ratio.n_success, ratio.n_downloaded, ratio.n_skipped, ratio.success_ratio) == (4, 3, 1, 2, 0.75)


def test_files_below_a_folder(spark, tmp_path):
    import zipfile

    root = tmp_path / "raw data"
    (root / "gaa").mkdir(parents=True)
    (root / "gaa" / "good.parquet").write_bytes(b"PAR1" + b"x" * 50 + b"PAR1")
    (root / "gaa" / "cut.parquet").write_bytes(b"PAR1" + b"x" * 50)
    (root / "gaa" / "empty.parquet").write_bytes(b"")
    (root / ".gitkeep").write_bytes(b"")
    (root / "_odd").write_bytes(b"x")
    below = root / "nested" / str(root)[1:]
    below.mkdir(parents=True)
    (below / "f.txt").write_bytes(b"PAR1")
    with zipfile.ZipFile(root / "book.xlsx", "w") as book:
        book.writestr("a", "b" * 1000)
        book.comment = b"c" * 60000
    (root / "bad.xlsx").write_bytes((root / "book.xlsx").read_bytes()[:500])
    listing = {r.relative_path: r.size_bytes for r in file_inventory(spark, str(root)).collect()}
    assert set(listing) == {"gaa/good.parquet", "gaa/cut.parquet", "gaa/empty.parquet", "book.xlsx", "bad.xlsx", "_odd", f"nested{root}/f.txt"}
    assert listing["gaa/good.parquet"] == 58 and listing["gaa/empty.parquet"] == 0
    status = parquet_status(F.col("head"), F.col("tail"))
    checked = file_ends(spark, str(root), "*.parquet").select("relative_path", status.alias("s"))
    assert {r.relative_path: r.s for r in checked.collect()} == {
        "gaa/good.parquet": "ok", "gaa/cut.parquet": "truncated", "gaa/empty.parquet": "bad_header",
    }
    assert {r.relative_path for r in read_files(spark, str(root), "f.txt").collect()} == {f"nested{root}/f.txt"}
    ends = file_ends(spark, str(root), "*.parquet")
    (root / "gaa" / "cut.parquet").unlink()
    errors = {r.relative_path: r.error for r in ends.collect()}
    assert errors["gaa/cut.parquet"].startswith("unreadable") and errors["gaa/good.parquet"] is None
    books = file_ends(spark, str(root), "*.xlsx", ZIP_TAIL_BYTES).select("relative_path", workbook_status(F.col("head"), F.col("tail")).alias("s"))
    assert {r.relative_path: r.s for r in books.collect()} == {"book.xlsx": "valid", "bad.xlsx": "no_end_of_directory"}
    assert {r.size_bytes for r in read_files(spark, str(root), "*.xlsx").collect()} == {listing["book.xlsx"], 500}


def test_readers_keep_codes_as_text(spark, tmp_path):
    path = str(tmp_path / "gaa")
    row = spark.range(1).select(F.col("id"), F.lit("01").alias("department"), F.lit(1.005).alias("amt"), F.lit(2020).cast("long").alias("year"))
    row.write.parquet(path)
    read = read_appropriations(spark, path)
    got = read.first()
    assert len(read.columns) == 22 and got.department == "01" and got.amt == Decimal("1.01") and got.uacs_oper_dsc is None
    pruned = plan(read.where("year = 2020").select("amt"))
    assert "EqualTo(year,2020)" in pruned and "ReadSchema: struct<amt:double,year:bigint>" in pruned
    (tmp_path / "c.csv").write_text("period_type,year,month,district,revenue_type,amount\nmonthly,2016,1,RDO 001,VAT,12.50\n")
    assert read_collections(spark, str(tmp_path / "c.csv")).first().amount == Decimal("12.50")


def test_sink_replaces_only_the_written_periods(spark):
    path = scratch_dir(spark, "test-sink")
    rows = [(2013, "Q1", 1), (2013, "Q2", 2), (2014, "Q1", 3)]
    df = spark.createDataFrame(rows, "fiscal_year int, quarter string, amount int")
    write_processed(df, path)
    write_processed(df.where("quarter = 'Q2'").withColumn("amount", F.lit(20)), path, files_per_period=2)
    got = sorted((r.fiscal_year, r.quarter, r.amount) for r in read_processed(spark, path).collect())
    assert got == [(2013, "Q1", 1), (2013, "Q2", 20), (2014, "Q1", 3)]
    assert "PartitionFilters: [isnotnull(fiscal_year" in plan(read_processed(spark, path).where("fiscal_year = 2013"))


def test_registry(spark):
    registry = SourceRegistry()

    @registry.register("a")
    def a(session, options):
        return session.range(options["n"]).select(F.lit("p").alias("phase"), F.lit("r").alias("region"), F.lit(2020).alias("fiscal_year"), F.col("id").alias("amount"))

    registry.register("b")(a)
    loaded = registry.load(spark, {"n": 2})
    assert loaded.count() == 4 and dict(loaded.dtypes)["amount"] == "decimal(20,2)"
    assert registry.load(spark, {"n": 2}, [" A "]).select("source").distinct().first()[0] == "a"
    with pytest.raises(ValueError, match="nope"):
        registry.load(spark, {"n": 1}, ["nope"])


def test_stream_handles_only_new_files(spark, tmp_path):
    schema = "relative_path string, checksum string, timestamp string"
    folder, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folder)

    def run():
        ingest(file_stream(spark, folder, schema, "*.parquet"), lambda batch: batch, log, checkpoint)
        return {(r.relative_path, r.checksum) for r in ingested(spark, log).collect()}

    arrive(("a", "1", "t1"), ("b", "1", "t1"))
    assert run() == {("a", "1"), ("b", "1")}
    arrive(("a", "1", "t2"), ("b", "2", "t2"), ("c", "1", "t2"))
    assert run() == {("a", "1"), ("b", "2"), ("c", "1")}
    assert spark.read.parquet(log).where("relative_path = 'a'").count() == 1
    before = spark.read.parquet(log).count()
    run()
    assert spark.read.parquet(log).count() == before
    # A fresh checkpoint on the same log keeps what is there and adds nothing that is known.
    ingest(file_stream(spark, folder, schema, "*.parquet"), lambda batch: batch, log, str(tmp_path / "cp2"))
    assert {(r.relative_path, r.checksum) for r in ingested(spark, log).collect()} >= {("a", "1"), ("c", "1")}
    assert spark.read.parquet(log).where("relative_path = 'c'").count() == 1
    compact(spark, log, str(tmp_path / "compacted"))
    assert spark.read.parquet(str(tmp_path / "compacted")).count() == 3


# ---------------------------------------------------------------- periods, segments, crosswalk


def test_flows_and_running_totals_are_inverse(spark):
    rng = random.Random(3)
    rows = [(e, y, q, Decimal(rng.randint(-500, 500))) for e in "ab" for y in (2011, 2012) for q in (1, 2, 3, 4)]
    flows = spark.createDataFrame(rows, "e string, year int, quarter int, flow decimal(20,2)")
    back = P.ytd_to_flow(P.flow_to_ytd(flows, ["e"]).drop("flow"), ["e"])
    assert {(r.e, r.year, r.quarter, r.flow) for r in back.collect()} == {(e, y, q, f.quantize(Decimal("0.01"))) for e, y, q, f in rows}


def test_flow_is_unknown_after_a_gap(spark):
    ytd = spark.createDataFrame([("a", 2011, 1, 10), ("a", 2011, 3, 30), ("a", 2011, 4, 45), ("b", 2011, 2, 5)], "e string, year int, quarter int, ytd int")
    got = {(r.e, r.quarter): r.flow for r in P.ytd_to_flow(ytd, ["e"]).collect()}
    assert got == {("a", 1): 10, ("a", 3): None, ("a", 4): 15, ("b", 2): None}


def test_trend_uses_time_not_row_order(spark):
    rows = [("a", 2011, 1, 100), ("a", 2011, 2, 150), ("a", 2011, 4, 300), ("a", 2012, 1, 200)]
    got = {(r.year, r.quarter): (r.qoq_pct, r.yoy_pct) for r in P.trend(spark.createDataFrame(rows, "e string, year int, quarter int, v int"), ["e"], "v").collect()}
    assert got == {(2011, 1): (None, None), (2011, 2): (50.0, None), (2011, 4): (None, None), (2012, 1): (-33.3333, 100.0)}


def test_gaps(spark):
    df = spark.createDataFrame([("a", 2011, 3), ("a", 2012, 2), ("a", 2012, 2), ("b", 2011, 1)], "e string, year int, quarter int")
    assert {(r.e, r.year, r.quarter) for r in P.period_gaps(df, ["e"]).collect()} == {("a", 2011, 4), ("a", 2012, 1)}


def test_reconcile(spark):
    months = spark.createDataFrame([("d", 2016, 1, 5), ("d", 2016, 2, 7), ("e", 2016, 1, 1)], "d string, year int, month int, amount int")
    years = spark.createDataFrame([("d", 2016, 13), ("f", 2016, 2)], "d string, year int, amount int")
    got = {r.d: (r.monthly_total, r.n_months, r.annual_total, r.difference) for r in P.reconcile(months, years, ["d"]).collect()}
    assert got == {"d": (12, 2, 13, 1), "e": (1, 1, None, -1), "f": (None, None, 2, 2)}


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_like_a_window(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([0, 1, 5, -3, None, rng.randint(-10**9, 10**9), rng.randint(0, 50)]) for _ in range(400)]
    df = spark.createDataFrame([(i, v if v is None else Decimal(v)) for i, v in enumerate(values)], "id int, v decimal(20,2)")
    values = [-(10**12) if v is None else v for v in values]  # nulls come last
    ranked = {r.id: (r["rank"], r.dense_rank, r.percent_rank) for r in G.rank_segments(df, "v").collect()}
    distinct = sorted(set(values), reverse=True)
    want = {
        i: (1 + sum(w > v for w in values), 1 + distinct.index(v), round(sum(w > v for w in values) / (len(values) - 1), 6))
        for i, v in enumerate(values)
    }
    assert ranked == want


def test_subtotals_tell_null_keys_from_totals(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, None, 4)], "k1 string, k2 string, v int")
    got = sorted(((r.k1, r.k2, r.depth, r.amount) for r in G.hierarchy(df, ["k1", "k2"], "v").collect()), key=str)
    want = [("a", None, 2, 1), ("a", "x", 2, 2), (None, None, 2, 4), ("a", None, 1, 3), (None, None, 1, 4), (None, None, 0, 7)]
    assert got == sorted(want, key=str)


def test_shares_and_merge(spark):
    a = spark.createDataFrame([("N", 3), ("N", 1), ("S", 4)], "region string, amount int")
    b = spark.createDataFrame([("N", 6), ("W", 2)], "region string, amount int")
    got = {r.region: (r.collected_share, r.spent_share, r.ratio, r.gap) for r in B.region_balance(a, b).collect()}
    assert got == {"N": (0.5, 0.75, 1.5, 0.25), "S": (0.5, None, None, None), "W": (None, 0.25, None, None)}
    zero = B.obligation_rate(spark.createDataFrame([("a", 1, 0)], "k string, o int, a int"), ["k"], "o", "a").first()
    assert zero.obligation_rate is None


def test_allocation_adds_up(spark):
    totals = spark.createDataFrame([("d", 100)], "dept string, amount int")
    weights = spark.createDataFrame([("d", "N", 3), ("d", "S", 1)], "dept string, region string, weight int")
    got = B.allocate_by_share(totals, weights, "dept", "region").collect()
    assert {(r.region, r.amount, r.estimated) for r in got} == {("N", Decimal("75.00"), True), ("S", Decimal("25.00"), True)}


def test_crosswalk_validity_and_suggestions(spark):
    facts = spark.createDataFrame([("ARMM ", 2012), ("armm", 2020), ("Automous Region", 2012)], "name string, year int")
    crosswalk = spark.createDataFrame(
        [("A.R.M.M.", "R15", None, 2018), ("ARMM", "R15", None, 2018), ("ARMM", "BARMM", 2019, None), ("Autonomous Region", "R15", None, None)],
        "alias string, canonical string, valid_from int, valid_to int",
    )
    joined = C.apply_crosswalk(facts, crosswalk, "name", "year")
    assert [(r.name, r.canonical) for r in joined.orderBy("year", "name").collect()] == [("ARMM ", "R15"), ("Automous Region", None), ("armm", "BARMM")]
    unknown = C.unmatched_names(facts, crosswalk, "name")
    assert [(r.name, r.n_rows) for r in unknown.collect()] == [("automous region", 1)]
    assert [(r.name, r.canonical, r.edits) for r in C.suggest_matches(unknown, crosswalk).collect()] == [("automous region", "R15", 2)]


def test_money_is_not_multiplied(spark):
    facts = spark.createDataFrame([("Region IV-A", 2012, "kept", 10), ("two", 2012, "kept", 5)], "name string, year int, valid_from string, amount int")
    crosswalk = spark.createDataFrame(
        [("Region IV-A", "R4", 2000, 2015), ("REGION IV A", "R4", 2010, 2020), ("two", "A", None, 2012), ("two", "B", 2012, None), ("three", "A", None, 2011), ("three", "B", 2012, None)],
        "alias string, canonical string, valid_from int, valid_to int",
    )
    for year in ("year", None):
        got = C.apply_crosswalk(facts, crosswalk, "name", year)
        assert got.columns == [*facts.columns, "canonical"]
        assert {(r.name, r.valid_from, r.amount, r.canonical) for r in got.collect()} == {("Region IV-A", "kept", 10, "R4"), ("two", "kept", 5, None)} and got.count() == 2
    assert [(r.alias, r.canonical_keys) for r in C.ambiguous_aliases(crosswalk).collect()] == [("two", "A,B")]
    rates = spark.createDataFrame([("X", 2), ("X", 2), ("Y", 1), ("Y", 3)], "currency string, rate int")
    money = spark.createDataFrame([("X", 10), ("Y", 10), ("Z", 10)], "currency string, amount int")
    assert sorted((r.currency, r.amount_common and int(r.amount_common)) for r in C.align_currency(money, rates).collect()) == [("X", 20), ("Y", None), ("Z", None)]


def test_short_names_meet_too(spark):
    names = spark.createDataFrame([("a",), ("bc",), ("xyz",)], "name string")
    crosswalk = spark.createDataFrame([("d", "d"), ("ef", "ef"), ("xy", "xy")], "alias string, canonical string")
    got = {(r.name, r.alias) for r in C.suggest_matches(names, crosswalk).collect()}
    pairs = names.crossJoin(crosswalk).where(F.levenshtein("name", "alias") <= 2)
    assert got == {(r.name, r.alias) for r in pairs.collect()}


def test_json_of_any_size_and_depth(spark):
    def page(body):
        return f"<script id='__NEXT_DATA__'>{body}</script>"

    deep = "[" * 1200 + '"/d.xlsx"' + "]" * 1200
    bodies = ['{"k":"/a.xlsx","k":"/b.xlsx"}', deep, '{"k": "/c.xlsx"', '["/e.xlsx"]', '"/f.xlsx"', "", '{"k":"' + "x" * (17 << 20) + '","l":"/g.xlsx"}']
    pages = spark.createDataFrame([(i, "https://e.org/p", page(b)) for i, b in enumerate(bodies)], "page_id int, url string, html string")
    got = {r.page_id: (r.s, r.u) for r in pages.select("page_id", L.json_status(F.col("html")).alias("s"), L.json_urls(F.col("html"), F.col("url")).alias("u")).collect()}
    urls = lambda *names: [f"https://e.org/{n}.xlsx" for n in names]
    assert got[0] == ("json", urls("a", "b")) and got[1] == ("json", urls("d")) and got[2] == ("not_json", [])
    assert got[3] == ("json", urls("e")) and got[5] == ("none", []) and got[6] == ("json", urls("g"))


def test_suggestions_find_every_close_pair(spark):
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(60)})
    names = spark.createDataFrame([(w,) for w in words[:30]], "name string")
    crosswalk = spark.createDataFrame([(w, w) for w in words[30:]], "alias string, canonical string")
    got = {(r.name, r.alias) for r in C.suggest_matches(names, crosswalk).collect()}
    pairs = names.crossJoin(crosswalk).where(F.levenshtein("name", "alias") <= 2)
    assert got == {(r.name, r.alias) for r in pairs.collect()}


def test_checks_and_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", 2), (2, None, 3)], "k int, l string, v int")
    got = C.key_checks(df, ["k"], ["l", "v"]).first().asDict()
    assert got == {"n_rows": 3, "n_keys": 2, "n_duplicated_keys": 1, "missing_l": 1, "missing_v": 1}
    assert C.clean_columns(df.toDF(" A (b)", "C--d", "E"), required=["c_d"]).collect() == [(1, "a", None), (1, "a", 2)]
    assert C.key_checks(df.limit(0), ["k"], []).first().n_rows == 0


def test_add_once_blocks_substitution(spark):
    df = add_once(spark.range(3), x=F.col("id") * 2).where("x > 1 AND x < 9").select((F.col("x") + F.col("x")).alias("y"))
    assert plan(df).count("* 2") == 1
    assert sorted(r.y for r in df.collect()) == [4, 8]
