"""Incremental ingestion: what to fetch, what to skip, what the manifest says, how a run went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTENT_KEY = ["relative_path", "checksum"]

# The sources that validation counts apart.
KNOWN_SOURCES = ["gaa", "tax", "saaodb"]


def requested_sources(spec: str, valid: list[str]) -> list[str]:
    """Names in a comma-separated request, ``all`` meaning every source; an unknown name is refused."""
    if spec == "all":
        return sorted(valid)
    names = sorted({name.strip().lower() for name in spec.split(",")})
    invalid = [name for name in names if name not in valid]
    if invalid:
        raise ValueError(f"invalid sources: {', '.join(invalid)}; valid: {', '.join(valid)}")
    return names


def worklist(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Candidates whose content the manifest does not know yet; one without a checksum is always due."""
    return candidates.join(manifest.select(*CONTENT_KEY), CONTENT_KEY, "left_anti")


def skipped(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Candidates that the manifest already holds with the same content."""
    return candidates.join(manifest.select(*CONTENT_KEY), CONTENT_KEY, "left_semi")


def orphans(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest entries whose file is gone."""
    return manifest.join(files.select("relative_path"), "relative_path", "left_anti")


def latest_entries(entries: DataFrame, key: str = "relative_path", order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """The newest entry per key; texts are compared as points in time, whatever their zone notation.

    A maximum over structs combines on the map side, so a key with very many versions moves one row per
    task; a window would bring all its versions together.
    """
    rest = [c for c in entries.columns if c != key and c not in order]
    kinds = dict(entries.dtypes)
    ranks = [x for c in order for x in ([F.try_to_timestamp(c).alias(f"_{c}"), c] if kinds[c] == "string" else [c])]
    newest = entries.groupBy(key).agg(F.max(F.struct(*ranks, *rest)).alias("newest"))
    return newest.select(key, "newest.*").select(*entries.columns)


def upsert(manifest: DataFrame, entries: DataFrame, order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """New entries replace older ones of the same path, whatever their times; of several new ones the latest wins.

    Columns missing on either side are null.
    """
    both = manifest.withColumn("_new", F.lit(0)).unionByName(entries.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_entries(both, order=("_new", *order)).drop("_new")


def run_severity(name: Column, success: Column, error: Column) -> Column:
    """How loudly a run is reported: an empty appropriation source is an error, other empty sources a warning."""
    return (
        F.when(error.isNotNull(), "exception")
        .when(success, "info")
        .when(F.lower(name).contains("gaa"), "error")
        .otherwise("warning")
    )


def success_ratio(outcomes: DataFrame, *by: str) -> DataFrame:
    """Share of files that are in place, with downloads and skips counted apart.

    ``outcomes`` has one row per selected file with ``status`` downloaded, skipped or failed.
    """
    done = F.col("status").isin("downloaded", "skipped")
    counts = outcomes.groupBy(*by).agg(
        F.count("*").alias("n_selected"),
        F.count_if(done).alias("n_success"),
        F.count_if(F.col("status") == "downloaded").alias("n_downloaded"),
        F.count_if(F.col("status") == "skipped").alias("n_skipped"),
    )
    ratio = F.round(F.try_divide(F.col("n_success").cast("double"), F.col("n_selected").cast("double")), 6)
    return counts.withColumn("success_ratio", ratio)


def overall_success(runs: DataFrame) -> DataFrame:
    """Did any source succeed?  An empty log did not."""
    return runs.agg(F.coalesce(F.bool_or("success"), F.lit(False)).alias("overall_success"))


def files_per_source(files: DataFrame, source: Column) -> DataFrame:
    return files.groupBy(source.alias("source")).agg(F.count("*").alias("n_files"))


def integrity_totals(checked: DataFrame, status: str = "status", good: str = "valid") -> DataFrame:
    """Counts of readable and unreadable files; the unreadable ones are rows of :func:`integrity_errors`."""
    ok = F.col(status) == good
    return checked.agg(
        F.count("*").alias("n_total"), F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_corrupt")
    )


def integrity_errors(checked: DataFrame, status: str = "status", good: str = "valid", kind: str = "corrupt_workbook") -> DataFrame:
    return checked.where(F.col(status) != good).select(
        F.col("relative_path").alias("file"), F.lit(kind).alias("error"), F.col(status).alias("detail")
    )


def validation_summary(
    files: DataFrame, manifest: DataFrame, workbooks: DataFrame, tables: DataFrame, manifest_exists: bool = True
) -> DataFrame:
    """One row of validation counts.

    ``files`` have a ``source``, ``workbooks`` and ``tables`` a ``status`` per checked file; whether the manifest
    exists is a fact about its file, not about its entries. Files and entries become rows with marks, one
    aggregation matches them by path and a second one counts. Sources beyond the three known ones are counted
    together; :func:`files_per_source` tells them apart. Lists of offending files can be of any length: they are
    the rows of :func:`validation_details`.
    """
    none = F.lit(None).cast("string")

    def marked(df: DataFrame, path: Column, metric: Column, entry: bool) -> DataFrame:
        return df.select(path.alias("path"), metric.alias("metric"), F.lit(entry).alias("entry"))

    path = F.col("relative_path")
    matched = (
        marked(files, path, F.coalesce("source", F.lit("")), False)
        .unionByName(marked(manifest, path, none, True))
        .groupBy("path")
        .agg(F.count("metric").alias("on_disk"), F.count_if("entry").alias("entries"), *[F.count_if(F.col("metric") == s).alias(s) for s in KNOWN_SOURCES])
    )
    orphaned = F.when(F.col("on_disk") == 0, F.col("entries")).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    known = [total(F.col(s)).alias(f"{s}_files") for s in KNOWN_SOURCES]
    others = total(F.col("on_disk") - sum((F.col(s) for s in KNOWN_SOURCES[1:]), F.col(KNOWN_SOURCES[0]))).alias("other_files")
    counts = matched.agg(*known, others, total(F.col("entries")).alias("manifest_entries"), total(orphaned).alias("manifest_orphans"))
    books = integrity_totals(workbooks)
    book = lambda c: books.select(c).scalar()
    broken = tables.agg(F.count_if(F.col("status") != "ok").alias("n")).scalar()
    return counts.select(
        *[f"{s}_files" for s in KNOWN_SOURCES],
        "other_files",
        book("n_total").alias("saaodb_xlsx_total"),
        book("n_valid").alias("saaodb_xlsx_valid"),
        book("n_corrupt").alias("saaodb_xlsx_corrupt"),
        "manifest_entries",
        "manifest_orphans",
        broken.alias("parquet_errors"),
        F.lit(manifest_exists).alias("manifest_exists"),
    )


def validation_details(files: DataFrame, manifest: DataFrame, workbooks: DataFrame, tables: DataFrame) -> DataFrame:
    """Every file that validation objects to, as (file, error, detail)."""
    missing = orphans(manifest, files).select(
        F.col("relative_path").alias("file"), F.lit("orphan").alias("error"), F.lit("missing from disk").alias("detail")
    )
    return missing.unionByName(integrity_errors(workbooks)).unionByName(integrity_errors(tables, good="ok", kind="corrupt_table"))


def run_summary_json(runs: DataFrame) -> DataFrame:
    """The run log as one JSON object per run."""
    fields = ["name", "success", "files_downloaded", "files_skipped", "duration_seconds", "error"]
    return runs.select("run_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("summary"))


def ingest_report(runs: DataFrame, validation: DataFrame, timestamp: str, order: str = "run_id") -> DataFrame:
    """When, the last result of every source, the whole validation and the overall outcome, as one JSON object.

    ``timestamp`` is the time of the report as ISO text. The map has one entry per source name, so it is as long
    as the list of sources.
    """
    fields = ["success", "files_downloaded", "files_skipped", "duration_seconds", "error"]
    last = runs.groupBy("name").agg(F.max(F.struct(order, *fields)).alias("last"))
    result = F.struct(*[F.col(f"last.{f}").alias(f) for f in fields])
    extractors = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", result.alias("result")))))
    counts = validation.select(F.to_json(F.struct(*validation.columns))).scalar()
    summary = last.agg(
        extractors.alias("extractors"), F.coalesce(F.bool_or("last.success"), F.lit(False)).alias("overall_success")
    )
    body = F.to_json(F.struct(F.lit(timestamp).alias("timestamp"), "extractors", "overall_success"), {"ignoreNullFields": "false"})
    joined = F.concat(F.rtrim(body, F.lit("}")), F.lit(',"validation":'), counts, F.lit("}"))
    return summary.select(joined.alias("report"))
