"""Raw files: listings, whole contents, checksums, first and last bytes, and directories of archives."""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.functions.archive import ZIP_TAIL_BYTES, archive_checked, directory_place, place_status
from civicledger.functions.files import content_sha256, is_hidden
from civicledger.operators.columns import add_once
from civicledger.session import scratch_dir

HIDDEN = ".git"
_LISTED = 10_000
_PIECE = 1 << 20
# Schemes that tasks can open by themselves, and the name they go by there.
_OPENED = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs"}


def _base(spark: SparkSession, root: str) -> tuple[object, str]:
    """The file system of ``root`` and its full address, with a closing slash."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(path).toString().rstrip("/") + "/"


def _located(path: str):
    """File system and name there of a Hadoop-style path, whose characters are not percent-encoded."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return LocalFileSystem(), "/" + rest.lstrip("/")
    return FileSystem.from_uri(_OPENED[scheme] + ":" + quote(rest, safe=":/"))


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each folder holds."""
    from pyarrow.fs import FileSelector, FileType

    for folder in (path for batch in batches for path in batch["path"]):
        system, name = _located(folder)
        found = system.get_file_info(FileSelector(name))
        for at in range(0, len(found), _LISTED):
            rows = [(f"{folder}/{i.base_name}", i.size or 0, (i.mtime_ns or 0) // 1_000_000, i.type == FileType.Directory) for i in found[at : at + _LISTED]]
            yield pd.DataFrame(rows, columns=["path", "size_bytes", "modified", "is_folder"])


def file_listing(spark: SparkSession, root: str, glob: str | None = None, direct: tuple[str, ...] = ("file",)) -> DataFrame:
    """(path, relative_path, size_bytes, modified in ms) of every file below ``root``, of any size and name but hidden ones.

    Spark's own file sources leave out empty files and names that begin with a dot or an underscore. In the schemes of
    ``direct`` tasks list the folders, level by level, and the listing is a written table; elsewhere the driver lists
    through the session's file system. Call it again for a newer listing.
    """
    system, base = _base(spark, root)
    start = spark._jvm.org.apache.hadoop.fs.Path(root)
    if base.split(":", 1)[0] in set(direct) & set(_OPENED) and system.getFileStatus(start).isDirectory():
        scratch, kind = scratch_dir(spark, "listing"), "path string, size_bytes bigint, modified bigint, is_folder boolean"
        folders, levels = spark.createDataFrame([(base.rstrip("/"),)], "path string"), []
        while not levels or folders.head(1):
            folders.repartition("path").mapInPandas(_list, kind).write.parquet(f"{scratch}/{len(levels)}")
            levels.append(f"{scratch}/{len(levels)}")
            folders = spark.read.schema(kind).parquet(levels[-1]).where("is_folder").select("path")
        # What Hadoop's local file system keeps beside its files are not files to it.
        files = spark.read.schema(kind).parquet(*levels).where(~F.col("is_folder") & ~F.col("path").rlike(r"/\.[^/]*\.crc\z"))
    else:
        rows, found = [], system.listFiles(start, True)
        while found.hasNext():
            status = found.next()
            rows.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
        files = spark.createDataFrame(rows, "path string, size_bytes bigint, modified bigint")
    name = F.element_at(F.split("path", "/"), -1)
    wanted = ~name.startswith(HIDDEN)
    if glob is not None:
        wanted &= name.rlike("^" + fnmatch.translate(glob).removesuffix(r"\Z") + r"\z")
    relative = F.when(F.col("path").startswith(base), F.substr("path", F.lit(len(base) + 1))).otherwise(F.col("path"))
    return files.where(wanted).select("path", relative.alias("relative_path"), "size_bytes", "modified")


def file_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(relative_path, size_bytes) of every file below ``root``; names starting ``.git`` are left out."""
    return file_listing(spark, root, glob).select("relative_path", "size_bytes")


def read_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(relative_path, size_bytes, content) of every file that is neither empty nor named with a dot or underscore.

    Every file must fit a row (2 GiB).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    base = _base(spark, root)[1]
    relative = F.when(F.col("path").startswith(base), F.substr("path", F.lit(len(base) + 1))).otherwise(F.col("path"))
    rows = reader.load(root).where(~is_hidden(F.col("path")))
    return rows.select(relative.alias("relative_path"), F.col("length").alias("size_bytes"), "content")


def _open(path: str):
    system, name = _located(path)
    return system.open_input_file(name)


def _read_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        heads, tails, errors = [], [], []
        for path, size, tail_bytes in zip(batch["path"], batch["size_bytes"], batch["tail_bytes"]):
            head = tail = error = None
            try:
                with _open(path) as handle:
                    start = max(size - tail_bytes, 0)
                    head, tail = handle.read_at(min(4, size), 0), handle.read_at(size - start, start)
            except OSError as failure:  # what one file suffers from must not end the check of the others
                head = tail = None
                error = f"unreadable: {failure}"
            heads.append(head)
            tails.append(tail)
            errors.append(error)
        yield batch[["relative_path", "size_bytes"]].assign(head=heads, tail=tails, error=errors)


def file_ends(spark: SparkSession, root: str, glob: str | None = None, tail_bytes: int = 4, direct: tuple[str, ...] = ("file",)) -> DataFrame:
    """First four and last ``tail_bytes`` bytes of each file, or the ``error`` that reading it met.

    Spark has no reader for a byte range, and ``binaryFile`` would load whole files. In the schemes of ``direct`` the
    tasks seek instead, so the bytes read per file are constant and files may exceed 2 GiB. An object store may be named
    there if the workers' own credentials reach it; by default it is read through the session's file system, whole
    files then.
    """
    listing = file_listing(spark, root, glob, direct).drop("modified")
    if _base(spark, root)[1].split(":", 1)[0] in set(direct) & set(_OPENED):
        dealt = listing.withColumn("tail_bytes", F.lit(tail_bytes)).repartition("path")
        return dealt.mapInPandas(_read_ends, "relative_path string, size_bytes long, head binary, tail binary, error string")
    whole = read_files(spark, root, glob).select("relative_path", F.substring("content", 1, 4).alias("head"), F.substring("content", -tail_bytes, tail_bytes).alias("tail"))
    return listing.drop("path").join(whole, "relative_path", "left").withColumn("error", F.when((F.col("size_bytes") > 0) & F.col("head").isNull(), "unreadable"))


def _read_directories(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes that ``start`` and ``length`` name, where ``directory`` doesn't hold them yet."""
    for batch in batches:
        out = []
        for path, start, length, known in zip(batch["path"], batch["start"], batch["length"], batch["directory"]):
            if known is None and not pd.isna(start):
                try:
                    with _open(path) as handle:
                        known = handle.read_at(int(length), int(start))
                except OSError:  # gone since its ends were read: its directory is broken then
                    known = b""
            out.append(known)
        yield batch[["path"]].assign(directory=out)


def archive_status(spark: SparkSession, root: str, glob: str | None = None, direct: tuple[str, ...] = ("file",)) -> DataFrame:
    """(relative_path, size_bytes, status) of zip-based workbooks by a walk through their directories.

    Read are the ends of each file and, where the last bytes don't include it, the directory. In schemes other than
    those of ``direct`` the session's file system is used, whole files then.
    """
    base = _base(spark, root)[1]
    ends = file_ends(spark, root, glob, ZIP_TAIL_BYTES, direct)
    placed = add_once(ends, place=directory_place(F.col("tail"), F.col("size_bytes")))
    good = place_status(F.col("place")).isNull()
    inside = F.col("place.start") - F.col("size_bytes") + F.octet_length("tail")
    length = F.col("place.length").cast("int")
    held = F.when(good & (inside >= 0), F.substring("tail", inside.cast("int") + 1, length))
    parts = add_once(placed, directory=held, start=F.when(good, F.col("place.start")), length=length)
    if base.split(":", 1)[0] in set(direct) & set(_OPENED):
        far = parts.where("start IS NOT NULL AND directory IS NULL").select(F.concat(F.lit(base), "relative_path").alias("path"), "start", "length", "directory")
        read = far.mapInPandas(_read_directories, "path string, directory binary").withColumnRenamed("directory", "_far")
    else:
        read = read_files(spark, root, glob).select(F.concat(F.lit(base), "relative_path").alias("path"), F.col("content").alias("_far"))
        read = read.join(parts.select(F.concat(F.lit(base), "relative_path").alias("path"), "start", "length"), "path").select("path", F.substring("_far", F.col("start").cast("int") + 1, F.col("length")).alias("_far"))
    whole = parts.withColumn("path", F.concat(F.lit(base), "relative_path")).join(read, "path", "left")
    whole = whole.withColumn("directory", F.coalesce("directory", "_far")).drop("path", "start", "length", "_far")
    return archive_checked(whole)


def _hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sums = []
        for path in batch["path"]:
            digest = hashlib.sha256()
            try:
                with _open(path) as handle:
                    while piece := handle.read(_PIECE):
                        digest.update(piece)
                sums.append(digest.hexdigest())
            except OSError:  # gone since the listing; the next listing tells
                sums.append(None)
        yield batch[["relative_path"]].assign(checksum=sums)


def checksums(spark: SparkSession, root: str, files: DataFrame, direct: tuple[str, ...] = ("file",)) -> DataFrame:
    """(relative_path, checksum) of the ``files`` (relative_path) below ``root``; null for one that is gone.

    In the schemes of ``direct`` tasks read them piece by piece, so a file of any size takes little memory.
    """
    base = _base(spark, root)[1]
    if base.split(":", 1)[0] in set(direct) & set(_OPENED):
        paths = files.select("relative_path", F.concat(F.lit(base), "relative_path").alias("path")).repartition("path")
        return paths.mapInPandas(_hash, "relative_path string, checksum string")
    found = read_files(spark, root).select("relative_path", content_sha256(F.col("content")).alias("checksum"))
    return files.select("relative_path").join(found, "relative_path", "left")
