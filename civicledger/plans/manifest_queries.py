"""Queries over raw files, manifests and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.functions.archive import ZIP_DIRECTORY_ENTRY, archive_checked, directory_place, place_status
from civicledger.functions.files import (
    PARQUET_MAGIC,
    ZIP_END_OF_DIRECTORY,
    ZIP_LOCAL_HEADER,
    ZIP_TAIL_BYTES,
    content_sha256,
    parquet_footer_status,
    parquet_status,
    workbook_status,
)
from civicledger.operators import manifest as M
from civicledger.operators.columns import add_once
from civicledger.plans import standins as S
from civicledger.plans.registry import query
from civicledger.session import scratch_dir
from civicledger.sources import manifest as store
from civicledger.sources.files import file_ends, file_inventory
from civicledger.sources.manifest_versions import VersionedManifest
from civicledger.sources.tables import table

FILES_SQL = """
files AS (
  SELECT doc_id, source || '/' || doc_id || '.txt' AS relative_path, CAST(strlen(text) AS BIGINT) AS size_bytes,
         sha256(text) AS checksum FROM documents
),
manifest AS (
  SELECT doc_id, relative_path, size_bytes, CASE WHEN quality = 1 THEN checksum ELSE repeat('0', 64) END AS checksum
  FROM files JOIN labels USING (doc_id)
)"""


def _written(spark: SparkSession, folder: str, label: str, text: Column, fmt: str) -> str:
    """Documents as files below a folder per source."""
    path = scratch_dir(spark, label)
    table(spark, folder, "documents").select(text.alias("value"), "source").write.partitionBy("source").format(fmt).save(path)
    return path


def _source() -> Column:
    return F.regexp_extract("relative_path", r"^source=([^/]*)/", 1).alias("source")


@query("file_inventory", "SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY source UNION ALL SELECT '', CAST(0 AS BIGINT)")
def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as text, and all files listed; the writer's empty mark of success is one of them."""
    files = file_inventory(spark, _written(spark, folder, "texts", F.col("text"), "text"))
    return files.groupBy(_source()).agg(F.sum("size_bytes").alias("n_bytes"))


@query("parquet_magic", "SELECT DISTINCT source, 'ok' AS status FROM documents UNION ALL SELECT '', 'bad_header'")
def parquet_magic(spark: SparkSession, folder: str) -> DataFrame:
    """Signatures at both ends of documents written as Parquet; the empty mark of success has none."""
    ends = file_ends(spark, _written(spark, folder, "parquet", F.col("text"), "parquet"))
    status = F.coalesce("error", parquet_status(F.col("head"), F.col("tail")))
    return ends.select(_source(), status.alias("status")).distinct()


@query(
    "parquet_footers",
    """SELECT source, CASE doc_id % 5 WHEN 0 THEN 'ok' WHEN 3 THEN 'truncated' WHEN 4 THEN 'bad_header' ELSE 'impossible_footer' END AS status, count(*) AS n_files
FROM documents GROUP BY ALL""",
)
def parquet_footers(spark: SparkSession, folder: str) -> DataFrame:
    """Documents between the marks of Parquet, whose stated footer fits or doesn't: files by status."""
    kind = (F.col("doc_id") % 5).cast("int")
    body = F.encode(F.concat(F.lit("."), F.coalesce("text", F.lit(""))), "UTF-8")
    length = F.octet_length(body) + F.when(kind == 1, 1).otherwise(0)
    digits = F.lpad(F.hex(F.when(kind == 2, 0).otherwise(length)), 8, "0")
    stated = F.unhex(F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)]))
    magic, other = F.lit(PARQUET_MAGIC), F.lit(b"none")
    content = F.concat(F.when(kind == 4, other).otherwise(magic), body, stated, F.when(kind == 3, other).otherwise(magic))
    files = table(spark, folder, "documents").select("source", content.alias("content"))
    status = parquet_footer_status(F.substring("content", 1, 4), F.substring("content", -8, 8), F.octet_length("content"))
    return files.groupBy("source", status.alias("status")).agg(F.count("*").alias("n_files"))


# A zip's end record that states a comment of one byte: the line end that the text writer adds.
_END_RECORD = ZIP_END_OF_DIRECTORY + b"\0" * 16 + b"\1\0"


@query(
    "xlsx_files",
    """SELECT DISTINCT source, CASE CAST(substr(source, 4) AS INTEGER) % 3 WHEN 0 THEN 'valid' WHEN 1 THEN 'no_end_of_directory' ELSE 'not_a_zip' END AS status
FROM documents UNION ALL SELECT '', 'not_a_zip'""",
)
def xlsx_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written between the marks of a zip, with the end cut off for some sources and no marks for others."""
    kind = F.substr("source", F.lit(4)).cast("int") % 3
    start, end = F.lit(ZIP_LOCAL_HEADER.decode("latin-1")), F.lit(_END_RECORD.decode("latin-1"))
    plain = F.regexp_replace("text", "^PK", "pk")
    text = F.when(kind == 0, F.concat(start, "text", end)).when(kind == 1, F.concat(start, "text", end, F.lit("cut"))).otherwise(plain)
    ends = file_ends(spark, _written(spark, folder, "books", text, "text"), tail_bytes=ZIP_TAIL_BYTES)
    status = F.coalesce("error", workbook_status(F.col("head"), F.col("tail")))
    return ends.select(_source(), status.alias("status")).distinct()


def _little(value: Column, width: int) -> Column:
    digits = F.lpad(F.hex(value), 2 * width, "0")
    return F.unhex(F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(width))]))


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as the second part of archives with two parts, most of them damaged; ``kind`` says how."""
    zeros = lambda n: F.lit(b"\0" * n)
    kind = (F.col("doc_id") % 7).cast("int")
    name = F.when(kind == 5, F.lit(b"xl/workbook.bin")).otherwise(F.lit(b"xl/workbook.xml"))
    size, named = (lambda k: F.octet_length(f"body{k}")), (lambda k: F.col(f"name{k}"))

    def local(k: int) -> Column:
        return F.concat(F.lit(ZIP_LOCAL_HEADER), zeros(14), _little(size(k), 4), _little(size(k), 4), _little(F.octet_length(named(k)), 2), zeros(2), named(k), f"body{k}")

    def entry(k: int, packed: Column, place: Column) -> Column:
        return F.concat(F.lit(ZIP_DIRECTORY_ENTRY), zeros(16), _little(packed, 4), _little(packed, 4), _little(F.octet_length(named(k)), 2), zeros(12), _little(place, 4), named(k))

    docs = table(spark, folder, "documents").select("source", "doc_id", "text")
    bodies = {"body0": F.encode("source", "UTF-8"), "body1": F.encode(F.coalesce("text", F.lit("")), "UTF-8")}
    made = add_once(docs, name0=F.lit(b"[Content_Types].xml"), name1=name, **bodies)
    made = add_once(made, local0=local(0), local1=local(1))
    second = F.when(kind == 1, 0).otherwise(F.octet_length("local0"))
    made = add_once(made, entry0=entry(0, size(0), F.lit(0)), entry1=entry(1, size(1) + F.when(kind == 2, 1000).otherwise(0), second))
    count = _little(F.when(kind == 3, 1).otherwise(2), 2)
    length = F.octet_length("entry0") + F.octet_length("entry1")
    start = F.octet_length("local0") + F.octet_length("local1") + F.when(kind == 4, 1).otherwise(0)
    made = add_once(made, ending=F.concat(F.lit(ZIP_END_OF_DIRECTORY), zeros(4), count, count, _little(length, 4), _little(start, 4), zeros(2), F.when(kind == 6, F.lit(b"x")).otherwise(F.lit(b""))))
    return add_once(made, content=F.concat("local0", "local1", "entry0", "entry1", "ending")).select("source", "content")


@query(
    "xlsx_directories",
    """SELECT source, CASE doc_id % 7 WHEN 0 THEN 'valid' WHEN 1 THEN 'overlapping_entries' WHEN 2 THEN 'truncated_entries' WHEN 3 THEN 'broken_directory'
  WHEN 4 THEN 'impossible_directory' WHEN 5 THEN 'missing_parts' ELSE 'no_end_of_directory' END AS status, count(*) AS n_files
FROM documents GROUP BY ALL""",
)
def xlsx_directories(spark: SparkSession, folder: str) -> DataFrame:
    """Files by what the walk through their directory shows."""
    size = F.octet_length("content")
    tail = F.substring("content", -ZIP_TAIL_BYTES, ZIP_TAIL_BYTES)
    files = add_once(_archives(spark, folder), tail=tail, size_bytes=size)
    files = add_once(files, place=directory_place(F.col("tail"), F.col("size_bytes")))
    place = F.col("place")
    directory = F.when(place_status(place).isNull(), F.substring("content", place["start"].cast("int") + 1, place["length"].cast("int")))
    read = files.select("source", F.substring("content", 1, 4).alias("head"), "tail", "place", directory.alias("directory"), F.lit(None).cast("string").alias("error"))
    return archive_checked(read).groupBy("source", "status").agg(F.count("*").alias("n_files"))


_END = ZIP_END_OF_DIRECTORY + b"\0" * 18
_WORKBOOK_BYTES = {0: (ZIP_LOCAL_HEADER, _END), 1: (ZIP_LOCAL_HEADER + _END, b"cut"), 2: (b"<!DO", _END), 3: (PARQUET_MAGIC, PARQUET_MAGIC)}


def _stored_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents wrapped in the signatures of several file kinds."""
    kind = (F.col("doc_id") % 4).cast("int")
    heads = F.array(*[F.lit(_WORKBOOK_BYTES[i][0]) for i in range(4)])
    tails = F.array(*[F.lit(_WORKBOOK_BYTES[i][1]) for i in range(4)])
    body = F.encode(F.regexp_replace("text", "PK", "pk"), "UTF-8")
    content = F.concat(F.get(heads, kind), body, F.get(tails, kind))
    return table(spark, folder, "documents").select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".xlsx")).alias("relative_path"),
        content.alias("content"),
    )


WORKBOOKS_SQL = """
checked AS (
  SELECT source || '/' || doc_id || '.xlsx' AS relative_path,
    CASE doc_id % 4 WHEN 0 THEN 'valid' WHEN 1 THEN 'no_end_of_directory' ELSE 'not_a_zip' END AS status
  FROM documents)"""


def _checked_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    content = F.col("content")
    return _stored_bytes(spark, folder).select("relative_path", workbook_status(content, content).alias("status"))


@query("xlsx_integrity", f"WITH {WORKBOOKS_SQL} SELECT relative_path, status FROM checked")
def xlsx_integrity(spark: SparkSession, folder: str) -> DataFrame:
    return _checked_workbooks(spark, folder)


@query(
    "parquet_magic_bytes",
    """
SELECT source || '/' || doc_id || '.xlsx' AS relative_path, CASE doc_id % 4 WHEN 3 THEN 'ok' ELSE 'bad_header' END AS status
FROM documents""",
)
def parquet_magic_bytes(spark: SparkSession, folder: str) -> DataFrame:
    content = F.col("content")
    return _stored_bytes(spark, folder).select("relative_path", parquet_status(content, content).alias("status"))


@query(
    "integrity_totals",
    f"""WITH {WORKBOOKS_SQL} SELECT count(*) AS n_total, count(*) FILTER (status = 'valid') AS n_valid,
count(*) FILTER (status <> 'valid') AS n_corrupt FROM checked""",
)
def integrity_totals(spark: SparkSession, folder: str) -> DataFrame:
    return M.integrity_totals(_checked_workbooks(spark, folder))


@query(
    "integrity_errors",
    f"WITH {WORKBOOKS_SQL} SELECT relative_path AS file, 'corrupt_workbook' AS error, status AS detail FROM checked WHERE status <> 'valid'",
)
def integrity_errors(spark: SparkSession, folder: str) -> DataFrame:
    return M.integrity_errors(_checked_workbooks(spark, folder))


@query("content_sha256", "SELECT doc_id, sha256(text) AS checksum FROM documents")
def checksums(spark: SparkSession, folder: str) -> DataFrame:
    content = F.encode("text", "UTF-8")
    return table(spark, folder, "documents").select("doc_id", content_sha256(content).alias("checksum"))


@query("sorted_files", f"WITH {FILES_SQL} SELECT relative_path, size_bytes FROM files ORDER BY relative_path")
def sorted_files(spark: SparkSession, folder: str) -> DataFrame:
    return S.document_files(spark, folder).select("relative_path", "size_bytes").orderBy("relative_path")


@query(
    "match_counts",
    """SELECT count(*) FILTER (doc_id % 6 < 4) AS n_matched, count(*) AS n_total FROM documents""",
)
def match_counts(spark: SparkSession, folder: str) -> DataFrame:
    from civicledger.functions.files import matches_allowed

    suffix = S.choose(F.col("doc_id") % 6, [".parquet", ".JSON", ".csv", ".md", ".md5", ".xlsx"])
    name = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), suffix)
    matched = F.count_if(matches_allowed(name)).alias("n_matched")
    return table(spark, folder, "documents").agg(matched, F.count("*").alias("n_total"))


@query(
    "manifest_read",
    f"""WITH {FILES_SQL}
SELECT doc_id, relative_path AS key, relative_path, 'documents' AS source, size_bytes, checksum FROM files JOIN documents USING (doc_id)
WHERE lang <> 'de'""".replace("SELECT doc_id, relative_path AS key", "SELECT files.doc_id, relative_path AS key"),
)
def manifest_read(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON manifest per document; those in German are cut off and thus empty."""
    lang = table(spark, folder, "documents").select("doc_id", "lang")
    files = S.document_files(spark, folder).join(lang, "doc_id")
    entry = F.struct(F.lit("documents").alias("source"), "relative_path", "size_bytes", "checksum")
    body = F.to_json(F.create_map("relative_path", entry))
    cut = F.when(F.col("lang") == "de", F.substring(body, 1, 40)).otherwise(body)
    entries = store.manifest_entries(files.select("doc_id", cut.alias("body")), F.col("body"), "doc_id")
    return entries.select("doc_id", "key", "relative_path", "source", "size_bytes", "checksum")


LATEST_SQL = f"""WITH {S.EVENT_ENTRIES_SQL}, ranked AS (
SELECT *, row_number() OVER (PARTITION BY relative_path ORDER BY timestamp DESC, size_bytes DESC) AS rn FROM entries)
SELECT relative_path, timestamp, size_bytes, checksum FROM ranked WHERE rn = 1"""


@query("manifest_write", LATEST_SQL)
def manifest_write(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs append to the log; the current manifest is read back."""
    log = scratch_dir(spark, "manifest-log")
    entries = S.event_entries(spark, folder)
    first_run = F.col("timestamp") < "2024-01-15"
    store.append_manifest(entries.where(first_run), log)
    store.append_manifest(entries.where(~first_run), log)
    return store.current_manifest(spark, log)


_CUTS = ["2024-01-10", "2024-01-20"]


@query(
    "manifest_versions",
    f"""WITH {S.EVENT_ENTRIES_SQL}, v AS (SELECT unnest([1, 2, 3, 4]) AS version),
upto AS (SELECT v.version, e.*, row_number() OVER (PARTITION BY v.version, relative_path ORDER BY timestamp DESC, size_bytes DESC) AS rn
  FROM entries e JOIN v ON (timestamp < '{_CUTS[0]}' OR (timestamp < '{_CUTS[1]}' AND version >= 2) OR version >= 3))
SELECT CAST(version AS INTEGER) AS version, relative_path, timestamp, size_bytes, checksum FROM upto WHERE rn = 1""",
)
def manifest_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Three commits and a compaction; every version reads back."""
    store_ = VersionedManifest(spark, scratch_dir(spark, "manifest-versions"))
    entries = S.event_entries(spark, folder)
    early, middle = F.col("timestamp") < _CUTS[0], F.col("timestamp") < _CUTS[1]
    for run in (early, middle & ~early, ~middle):
        store_.commit(entries.where(run))
    store_.compact()
    read = [store_.read(v).select(F.lit(v).alias("version"), "relative_path", "timestamp", "size_bytes", "checksum") for v in store_.versions()]
    return read[0].union(read[1]).union(read[2]).union(read[3])


@query("manifest_upsert", LATEST_SQL)
def manifest_upsert(spark: SparkSession, folder: str) -> DataFrame:
    entries = S.event_entries(spark, folder)
    older = F.col("timestamp") < "2024-01-15"
    return M.upsert(entries.where(older), entries.where(~older))


@query(
    "incremental_worklist",
    f"""WITH {FILES_SQL} SELECT f.doc_id, f.relative_path, f.size_bytes, f.checksum FROM files f
WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.relative_path = f.relative_path AND m.checksum = f.checksum)""",
)
def incremental_worklist(spark: SparkSession, folder: str) -> DataFrame:
    files = S.document_files(spark, folder)
    return M.worklist(files, S.document_manifest(spark, folder)).select(*files.columns)


@query(
    "incremental_skipped",
    f"""WITH {FILES_SQL} SELECT f.doc_id, f.relative_path, f.size_bytes, f.checksum FROM files f
WHERE EXISTS (SELECT 1 FROM manifest m WHERE m.relative_path = f.relative_path AND m.checksum = f.checksum)""",
)
def incremental_skipped(spark: SparkSession, folder: str) -> DataFrame:
    files = S.document_files(spark, folder)
    return M.skipped(files, S.document_manifest(spark, folder)).select(*files.columns)


@query(
    "manifest_orphans",
    f"""WITH {FILES_SQL} SELECT relative_path, size_bytes FROM files
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def manifest_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as entries, labelled documents as the files that exist."""
    entries = S.document_files(spark, folder).select("relative_path", "size_bytes")
    return M.orphans(entries, S.document_manifest(spark, folder)).select("relative_path", "size_bytes")


@query("files_per_source", "SELECT source, count(*) AS n_files FROM documents GROUP BY source")
def files_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return M.files_per_source(table(spark, folder, "documents"), F.col("source"))


@query(
    "source_filter",
    """SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src7')""",
)
def source_filter(spark: SparkSession, folder: str) -> DataFrame:
    chosen = M.requested_sources(" SRC1,src7", valid=[f"src{i}" for i in range(20)])
    return table(spark, folder, "documents").where(F.col("source").isin(chosen)).select("doc_id", "source")


@query(
    "set_difference",
    """SELECT DISTINCT 'src' || (label * 5) AS source FROM embeddings EXCEPT SELECT source FROM documents""",
)
def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Requested sources that do not exist."""
    requested = table(spark, folder, "embeddings").select(F.concat(F.lit("src"), F.col("label") * 5).alias("source"))
    return requested.subtract(table(spark, folder, "documents").select("source"))


@query(
    "run_severity",
    f"""WITH {S.RUNS_SQL} SELECT run_id, name, CASE WHEN error IS NOT NULL THEN 'exception' WHEN success THEN 'info'
WHEN contains(lower(name), 'gaa') THEN 'error' ELSE 'warning' END AS severity FROM runs""",
)
def run_severity(spark: SparkSession, folder: str) -> DataFrame:
    severity = M.run_severity(F.col("name"), F.col("success"), F.col("error"))
    return S.runs(spark, folder).select("run_id", "name", severity.alias("severity"))


@query(
    "success_ratio",
    f"""WITH {S.RUNS_SQL} SELECT name, day, count(*) AS n_selected, count(*) FILTER (status <> 'failed') AS n_success,
count(*) FILTER (status = 'downloaded') AS n_downloaded, count(*) FILTER (status = 'skipped') AS n_skipped,
round(count(*) FILTER (status <> 'failed') / count(*), 6) AS success_ratio FROM runs GROUP BY name, day""",
)
def success_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return M.success_ratio(S.runs(spark, folder), "name", "day")


@query("overall_success", f"WITH {S.RUNS_SQL} SELECT coalesce(bool_or(success), FALSE) AS overall_success FROM runs")
def overall_success(spark: SparkSession, folder: str) -> DataFrame:
    return M.overall_success(S.runs(spark, folder))


@query(
    "run_summary_json",
    f"""WITH {S.RUNS_SQL} SELECT run_id, '{{"name":"' || name || '","success":' || CASE WHEN success THEN 'true' ELSE 'false' END
|| ',"files_downloaded":' || files_downloaded || ',"files_skipped":' || files_skipped || ',"duration_seconds":' || duration_seconds || ',"error":'
|| coalesce('"' || replace(error, '"', '\\"') || '"', 'null') || '}}' AS summary FROM runs""",
)
def run_summary_json(spark: SparkSession, folder: str) -> DataFrame:
    return M.run_summary_json(S.runs(spark, folder))


TABLE_FILES_SQL = """
signed AS (
  SELECT source || '/' || doc_id || '.xlsx' AS relative_path, CASE doc_id % 4 WHEN 3 THEN 'ok' ELSE 'bad_header' END AS status
  FROM documents)"""


def _validated(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Labelled documents as the files on disk, all documents as entries, and the checked contents."""
    source = S.choose(F.col("doc_id") % 4, ["gaa", "tax", "saaodb", "new"])
    files = S.document_manifest(spark, folder).withColumn("source", source)
    entries = S.document_files(spark, folder).select("relative_path", "size_bytes")
    return files, entries, _checked_workbooks(spark, folder), parquet_magic_bytes(spark, folder)


VALIDATION_SQL = f"""{FILES_SQL}, named AS (
  SELECT doc_id, relative_path, CASE doc_id % 4 WHEN 0 THEN 'gaa' WHEN 1 THEN 'tax' WHEN 2 THEN 'saaodb' ELSE 'new' END AS source FROM files
), disk AS (SELECT * FROM named WHERE doc_id IN (SELECT doc_id FROM labels)), {WORKBOOKS_SQL}, {TABLE_FILES_SQL}, v AS (
SELECT count(*) FILTER (source = 'gaa') AS gaa_files, count(*) FILTER (source = 'tax') AS tax_files,
  count(*) FILTER (source = 'saaodb') AS saaodb_files, count(*) FILTER (source = 'new') AS other_files, (SELECT count(*) FROM checked) AS saaodb_xlsx_total,
  (SELECT count(*) FROM checked WHERE status = 'valid') AS saaodb_xlsx_valid,
  (SELECT count(*) FROM checked WHERE status <> 'valid') AS saaodb_xlsx_corrupt,
  (SELECT count(*) FROM files) AS manifest_entries,
  (SELECT count(*) FROM files WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS manifest_orphans,
  (SELECT count(*) FROM signed WHERE status <> 'ok') AS parquet_errors, TRUE AS manifest_exists
FROM disk)"""


@query("validation_summary", f"WITH {VALIDATION_SQL} SELECT * FROM v")
def validation_summary(spark: SparkSession, folder: str) -> DataFrame:
    return M.validation_summary(*_validated(spark, folder))


@query(
    "validation_details",
    f"""WITH {FILES_SQL}, {WORKBOOKS_SQL}, {TABLE_FILES_SQL}
SELECT relative_path AS file, 'orphan' AS error, 'missing from disk' AS detail FROM files WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT relative_path, 'corrupt_workbook', status FROM checked WHERE status <> 'valid'
UNION ALL SELECT relative_path, 'corrupt_table', status FROM signed WHERE status <> 'ok'""",
)
def validation_details(spark: SparkSession, folder: str) -> DataFrame:
    return M.validation_details(*_validated(spark, folder))


@query(
    "ingest_report",
    f"""WITH {S.RUNS_SQL}, last AS (SELECT name, max_by(run_id, run_id) AS run_id FROM runs GROUP BY name),
e AS (SELECT name, '"' || name || '":{{"success":' || CASE WHEN success THEN 'true' ELSE 'false' END || ',"files_downloaded":' || files_downloaded
  || ',"files_skipped":' || files_skipped || ',"duration_seconds":' || duration_seconds || ',"error":' || coalesce('"' || replace(error, '"', '\\"') || '"', 'null') || '}}' AS body, success
  FROM runs JOIN last USING (name, run_id)), {VALIDATION_SQL}
SELECT '{{"timestamp":"2024-02-01T00:00:00Z","extractors":{{' || string_agg(body, ',' ORDER BY name) || '}},"overall_success":' || CASE WHEN bool_or(success) THEN 'true' ELSE 'false' END
  || ',"validation":' || (SELECT to_json(v)::VARCHAR FROM v) || '}}' AS report FROM e""",
)
def ingest_report(spark: SparkSession, folder: str) -> DataFrame:
    return M.ingest_report(S.runs(spark, folder), M.validation_summary(*_validated(spark, folder)), "2024-02-01T00:00:00Z")
