"""Archives, listings and streams of changes over real files."""

from __future__ import annotations

import hashlib
import os
import random
import zipfile

from pyspark.sql import functions as F

from civicledger.functions.files import ZIP_TAIL_BYTES
from civicledger.sources.files import archive_status, checksums, file_ends, file_listing
from civicledger.streaming.changes import FolderChanges, listing_changes
from civicledger.streaming.ingest import ingested


def book(path, parts, comment=b"", noise=False):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in parts:
            out.writestr(name, text)
        out.comment = comment
    return bytearray(path.read_bytes())


def test_archives_by_their_directory(spark, tmp_path):
    parts = [("[Content_Types].xml", "x" * 500), ("xl/workbook.xml", os.urandom(300)), ("xl/\u00e4.xml", ""), ("again", "PK\5\6" * 5)]
    good = book(tmp_path / "good.xlsx", parts, b"PK\5\6" + b"c" * 300)
    many = parts + [(f"xl/media/image{k:05}.png", os.urandom(3)) for k in range(1500)]
    book(tmp_path / "many.xlsx", many)
    assert len((tmp_path / "many.xlsx").read_bytes()) - (tmp_path / "many.xlsx").read_bytes().rindex(b"[Content_Types].xml") > ZIP_TAIL_BYTES
    book(tmp_path / "other.xlsx", parts[1:])
    with zipfile.ZipFile(tmp_path / "none.xlsx", "w"):
        pass
    end, entry = good.rindex(b"PK\5\6", 0, len(good) - 304), [m for m in range(len(good)) if good[m : m + 4] == b"PK\1\2"]

    def damaged(name, at, value, width=4):
        data = bytearray(good)
        data[at : at + width] = value.to_bytes(width, "little")
        (tmp_path / name).write_bytes(data)

    start = int.from_bytes(good[end + 16 : end + 20], "little")
    damaged("overlap.xlsx", entry[1] + 42, 3)
    damaged("long.xlsx", entry[3] + 20, 1 << 20)
    damaged("count.xlsx", end + 10, 3, 2)
    damaged("more.xlsx", end + 10, 5, 2)
    damaged("signature.xlsx", entry[2], 0)
    damaged("names.xlsx", entry[0] + 28, 5000, 2)
    damaged("place.xlsx", end + 16, start + 1)
    damaged("far.xlsx", end + 16, 0xFFFFFFF0)
    damaged("zip64.xlsx", end + 16, 0xFFFFFFFF)
    (tmp_path / "cut.xlsx").write_bytes(good[:-1])
    (tmp_path / "web.xlsx").write_bytes(b"<!DOCTYPE html>")
    (tmp_path / "empty.xlsx").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"x")
    want = {
        "good": "valid", "many": "valid", "other": "missing_parts", "none": "not_a_zip", "overlap": "overlapping_entries", "long": "truncated_entries", "count": "broken_directory",
        "more": "broken_directory", "signature": "broken_directory", "names": "broken_directory", "place": "impossible_directory", "far": "impossible_directory", "zip64": "zip64",
        "cut": "no_end_of_directory", "web": "not_a_zip", "empty": "not_a_zip",
    }
    got = {r.relative_path.split(".")[0]: r.status for r in archive_status(spark, str(tmp_path), "*.xlsx").collect()}
    assert got == want
    # The same without seeking, as in a store that only the session can read, which leaves out empty files.
    whole = {r.relative_path.split(".")[0]: r.status for r in archive_status(spark, str(tmp_path), "*.xlsx", ()).collect()}
    assert {k: v for k, v in whole.items() if k != "empty"} == {k: v for k, v in want.items() if k != "empty"}


def test_listings_by_tasks_and_by_the_driver_agree(spark, tmp_path):
    rng = random.Random(3)
    for k in range(40):
        folder = tmp_path.joinpath(*(rng.choice(["a", "b c", "%20", "_d", ".e"]) for _ in range(rng.randrange(4))))
        folder.mkdir(parents=True, exist_ok=True)
        (folder / rng.choice([f"f{k}.txt", f"_f{k}", f".git{k}", f"[{k}].TXT", f"x=y {k}.txt"])).write_bytes(b"x" * rng.randrange(9))
    for glob in (None, "*.txt", "f[!1]*", "?f*"):
        one, two = (sorted(map(tuple, file_listing(spark, str(tmp_path), glob, direct).collect())) for direct in (("file",), ()))
        assert one == two and (len(one) > 3)
        assert all(os.path.getsize(tmp_path / r[1]) == r[2] for r in one)
    names = file_listing(spark, str(tmp_path)).select("relative_path")
    sums = dict(map(tuple, checksums(spark, str(tmp_path), names).collect()))
    assert sums == {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in sums} and len(sums) == names.count()
    (tmp_path / "none").mkdir()
    assert file_listing(spark, str(tmp_path / "none")).count() == 0 and file_ends(spark, str(tmp_path / "none")).count() == 0


def test_rewritten_files_arrive_once(spark, tmp_path):
    root, state, log, checkpoint = (tmp_path / n for n in ("in", "state", "log", "cp"))
    (root / "d").mkdir(parents=True)

    def put(name, text, time):
        (root / name).write_text(text)
        os.utime(root / name, (time, time))

    changes = FolderChanges(spark, str(root), str(state))

    def run():
        changes.ingest(str(log), str(checkpoint))
        known = {r.relative_path: r.checksum for r in ingested(spark, str(log)).collect()}
        return {n for n in known if known[n] == hashlib.sha256((root / n).read_bytes()).hexdigest()} if root.exists() else known, spark.read.parquet(str(log)).count()

    put("a", "one", 1000), put("d/b", "two", 1000), put("_c", "", 1000)
    assert run() == ({"a", "d/b", "_c"}, 3)
    assert run() == ({"a", "d/b", "_c"}, 3)
    put("a", "ONE", 2000), put("d/b", "two", 3000), put("new", "x", 1000)  # rewritten, touched, added
    assert run() == ({"a", "d/b", "_c", "new"}, 5)
    # Two polls before a run, in which a file changes twice; an interrupted poll goes on from its listing.
    put("a", "three", 4000)
    changes.poll()
    put("a", "four", 5000)
    file_listing(spark, str(root)).drop("path").write.parquet(f"{state}/listings/number=5")
    put("new", "y", 6000)
    assert changes.poll() == 5 and sorted(map(tuple, spark.read.parquet(f"{state}/changes/number=5").select("relative_path", "kind").collect())) == [("a", "changed")]
    assert run() == ({"a", "d/b", "_c", "new"}, 7)
    assert run()[1] == 7
    # The same changes once more, under a fresh checkpoint.
    changes.ingest(str(log), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(log)).count() == 7


def test_changes_between_listings(spark):
    rng = random.Random(4)
    one, two = ({f"p{rng.randrange(60)}": (rng.randrange(3), rng.randrange(2)) for _ in range(50)} for _ in range(2))
    frame = lambda rows: spark.createDataFrame([(k, *v) for k, v in rows.items()], "relative_path string, size_bytes bigint, modified bigint").repartition(3)
    want = {(k, "added", *two[k]) for k in two.keys() - one} | {(k, "removed", *one[k]) for k in one.keys() - two} | {(k, "changed", *two[k]) for k in one.keys() & two if one[k] != two[k]}
    assert {tuple(r) for r in listing_changes(frame(one), frame(two)).collect()} == want
    assert listing_changes(frame(one), frame(one)).count() == 0 and listing_changes(frame(one).limit(0), frame(one)).where(F.col("kind") == "added").count() == len(one)
