"""Queries over pages and report links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.functions.files import matches_allowed
from civicledger.functions.links import detect_quarter, detect_year, link_extension, score_text, slug_name
from civicledger.functions.urls import path_has_suffix, resolve_url, url_basename
from civicledger.operators import links as L
from civicledger.plans import standins as S
from civicledger.plans.registry import query
from civicledger.sources.tables import table

PAGE_ANCHORS_SQL = """
anchors AS (
  SELECT page_id, url, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS a
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS a FROM pages)
),
hrefs AS (
  SELECT page_id, url, CAST(pos AS INTEGER) AS pos, regexp_extract(a, 'href="([^"]*)"', 1) AS href,
         regexp_extract(a, '>([^<]*)<', 1) AS text
  FROM anchors
)"""


def _page_anchors(spark: SparkSession, folder: str) -> DataFrame:
    return L.page_anchors(table(spark, folder, "pages"))


@query(
    "page_anchors",
    f"WITH {PAGE_ANCHORS_SQL} SELECT page_id, pos, href, text FROM hrefs",
)
def page_anchors(spark: SparkSession, folder: str) -> DataFrame:
    return _page_anchors(spark, folder).select("page_id", "pos", "href", "text")


@query(
    "url_resolve",
    f"""
WITH {PAGE_ANCHORS_SQL}, parts AS (
  SELECT *, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin,
    regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query
  FROM hrefs
), dirs AS (
  SELECT *, CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS dir FROM parts
)
SELECT page_id, pos,
  CASE pos % 6
    WHEN 0 THEN origin || href
    WHEN 1 THEN origin || dir || substr(href, 2)
    WHEN 2 THEN origin || CASE WHEN dir = '/' THEN '/' ELSE regexp_replace(dir, '[^/]+/$', '') END || substr(href, 2)
    WHEN 3 THEN regexp_extract(origin, '^https?', 0) || '://cdn.example.org' || href
    WHEN 4 THEN origin || path || '?v=1'
    ELSE origin || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END || '#top'
  END AS resolved
FROM dirs""",
)
def url_resolve(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of reference: rooted, relative, parent, other host, query only and fragment only."""
    anchors = _page_anchors(spark, folder)
    relative = F.substr("href", F.lit(2))
    kind = F.col("pos") % 6
    reference = (
        F.when(kind == 0, F.col("href"))
        .when(kind == 1, relative)
        .when(kind == 2, F.concat(F.lit("./../"), relative))
        .when(kind == 3, F.concat(F.lit("//cdn.example.org"), F.col("href")))
        .when(kind == 4, "?v=1")
        .otherwise("#top")
    )
    return anchors.select("page_id", "pos", resolve_url(F.col("url"), reference).alias("resolved"))


@query(
    "url_basename",
    """
WITH p AS (
  SELECT page_id, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages
)
SELECT page_id, coalesce(nullif(regexp_extract(path, '([^/]*)$', 1), ''), 'download_' || page_id || '.xlsx') AS filename
FROM p""",
)
def basename_of_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return pages.select("page_id", url_basename(F.col("url"), F.col("page_id")).alias("filename"))


@query(
    "url_path_filter",
    f"""
WITH {S.ORDER_LINKS_SQL}, u AS (
  SELECT page_id, pos, href || CASE pos % 3 WHEN 0 THEN '?v=2' WHEN 1 THEN '#a.xls' ELSE '' END AS url FROM links
)
SELECT page_id, pos, url FROM u WHERE regexp_matches(lower(regexp_extract(url, '^[^?#]*', 0)), '\\.xlsx?$')""",
)
def url_path_filter(spark: SparkSession, folder: str) -> DataFrame:
    suffix = S.choose(F.col("pos") % 3, ["?v=2", "#a.xls", ""])
    urls = S.order_links(spark, folder).withColumn("url", F.concat("href", suffix))
    return urls.where(path_has_suffix(F.col("url"))).select("page_id", "pos", "url")


@query(
    "glob_filter",
    """
WITH f AS (SELECT doc_id, source || '/' || doc_id || CASE doc_id % 6 WHEN 0 THEN '.parquet' WHEN 1 THEN '.JSON'
    WHEN 2 THEN '.csv' WHEN 3 THEN '.md' WHEN 4 THEN '.md5' ELSE '.xlsx' END AS filename FROM documents)
SELECT doc_id, filename FROM f WHERE regexp_matches(lower(filename), '\\.(parquet|json|csv|md)$')""",
)
def glob_filter(spark: SparkSession, folder: str) -> DataFrame:
    suffix = S.choose(F.col("doc_id") % 6, [".parquet", ".JSON", ".csv", ".md", ".md5", ".xlsx"])
    name = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), suffix)
    files = table(spark, folder, "documents").select("doc_id", name.alias("filename"))
    return files.where(matches_allowed(F.col("filename")))


@query("link_extension", f"{S.LINKS_SQL} SELECT page_id, pos, href, ext FROM records")
def extension_of_links(spark: SparkSession, folder: str) -> DataFrame:
    return S.order_links(spark, folder).select("page_id", "pos", "href", link_extension(F.col("href")).alias("ext"))


@query("detect_year", f"{S.LINKS_SQL} SELECT page_id, pos, year FROM records")
def year_of_links(spark: SparkSession, folder: str) -> DataFrame:
    return S.order_links(spark, folder).select("page_id", "pos", detect_year(F.col("href")).alias("year"))


@query("detect_quarter", f"{S.LINKS_SQL} SELECT page_id, pos, href, text, quarter FROM records")
def quarter_of_links(spark: SparkSession, folder: str) -> DataFrame:
    quarter = detect_quarter(F.col("href"), F.col("text"), detect_year(F.col("href")))
    return S.order_links(spark, folder).select("page_id", "pos", "href", "text", quarter.alias("quarter"))


@query("score_text", f"{S.LINKS_SQL} SELECT page_id, pos, text, score FROM records")
def score_of_links(spark: SparkSession, folder: str) -> DataFrame:
    return S.order_links(spark, folder).select("page_id", "pos", "text", score_text(F.col("text")).alias("score"))


@query(
    "slug_name",
    f"""{S.LINKS_SQL}
SELECT page_id, pos, year || '_' || quarter || '_'
    || substr(coalesce(nullif(trim(regexp_replace(text || CASE WHEN pos % 4 = 0 THEN repeat(' / annex', 12) ELSE '' END,
                                                '[^a-zA-Z0-9._-]+', '_', 'g'), '_'), ''), year || '_' || quarter), 1, 80)
    || '.' || ext AS filename
FROM kept""",
)
def names_of_links(spark: SparkSession, folder: str) -> DataFrame:
    annex = F.when(F.col("pos") % 4 == 0, " / annex" * 12).otherwise("")
    name = slug_name(F.col("year"), F.col("quarter"), F.concat("text", annex), F.col("ext"))
    return L.link_records(S.order_links(spark, folder)).select("page_id", "pos", name.alias("filename"))


@query(
    "harvest_links",
    f"""{S.LINKS_SQL}
SELECT page_id AS customer, pos AS page_id, year, quarter, text, 'https://portal.example.org' || href AS link_url, ext, score
FROM kept""",
)
def harvest_links(spark: SparkSession, folder: str) -> DataFrame:
    """Listing pages to link records, end to end."""
    anchors = L.page_anchors(S.order_listing_pages(spark, folder))
    records = L.link_records(anchors, base=F.lit(S.PORTAL))
    return records.select("customer", "page_id", "year", "quarter", "text", "link_url", "ext", "score")


@query("link_counts", f"{S.LINKS_SQL} SELECT count(*) AS n_links, count(DISTINCT year) AS n_years FROM kept")
def link_counts(spark: SparkSession, folder: str) -> DataFrame:
    return L.link_counts(L.link_records(S.order_links(spark, folder)))


@query(
    "group_min_score",
    f"""{S.LINKS_SQL}
SELECT page_id, year, quarter, count(*) AS n_links, min(score) AS best_score
FROM kept WHERE ext <> 'xlsx' AND score < 99 GROUP BY ALL""",
)
def group_min_score(spark: SparkSession, folder: str) -> DataFrame:
    return L.group_scores(L.link_records(S.order_links(spark, folder)), "page_id", "year", "quarter")


BEST_SQL = f"""{S.LINKS_SQL}, best AS (
SELECT *, row_number() OVER (PARTITION BY page_id, year, quarter ORDER BY score, CASE ext WHEN 'pdf' THEN 0 ELSE 1 END, pos) AS rn
FROM kept WHERE ext <> 'xlsx' AND score < 99
)"""


@query("best_per_group", f"{BEST_SQL} SELECT page_id, year, quarter, pos, href, text, ext, score FROM best WHERE rn = 1")
def best_per_group(spark: SparkSession, folder: str) -> DataFrame:
    best = L.best_links(L.link_records(S.order_links(spark, folder)), "page_id", "year", "quarter")
    return best.select("page_id", "year", "quarter", "pos", "href", "text", "ext", "score")


@query(
    "best_per_period",
    f"""{S.LINKS_SQL}, best AS (
SELECT *, row_number() OVER (PARTITION BY year, quarter ORDER BY score, CASE ext WHEN 'pdf' THEN 0 ELSE 1 END, pos) AS rn
FROM kept WHERE ext <> 'xlsx' AND score < 99)
SELECT year, quarter, pos, href, text, ext, score FROM best WHERE rn = 1 ORDER BY year, quarter""",
)
def best_per_period(spark: SparkSession, folder: str) -> DataFrame:
    """The selection over one portal: a few very large groups, in order of period."""
    best = L.best_links(L.link_records(S.order_links(spark, folder)), "year", "quarter")
    return best.select("year", "quarter", "pos", "href", "text", "ext", "score").orderBy("year", "quarter")


@query(
    "coverage",
    f"""{BEST_SQL}
SELECT count(*) AS n_quarters, min(year) AS first_year, max(year) AS last_year,
       string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years
FROM best WHERE rn = 1""",
)
def coverage(spark: SparkSession, folder: str) -> DataFrame:
    return L.coverage(L.best_links(L.link_records(S.order_links(spark, folder)), "page_id", "year", "quarter"))


@query(
    "link_dedupe",
    f"WITH {PAGE_ANCHORS_SQL} SELECT DISTINCT href FROM hrefs",
)
def link_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return L.dedupe_links(_page_anchors(spark, folder).select("href"), "href")


@query(
    "json_walk_urls",
    """
SELECT event_id AS page_id, unnest([
  'https://portal.example.org/api/f' || event_id || '.xls', 'https://files.example.org/a' || event_id || '.XLSX']) AS url
FROM events WHERE event_type = 'click'""",
)
def json_walk_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = S.event_pages(spark, folder)
    urls = L.json_urls(F.col("html"), F.col("url"))
    return pages.select("page_id", F.explode(urls).alias("url"))


_JSON_KINDS = "[" + ", ".join(f"'{status}'" for status, _ in S.JSON_BODIES) + "]"


@query(
    "json_status",
    f"""SELECT event_id AS page_id, CASE event_type WHEN 'click' THEN 'json' ELSE 'none' END AS status FROM events
UNION ALL SELECT -1 - event_id, {_JSON_KINDS}[event_id % {len(S.JSON_BODIES)} + 1] FROM events""",
)
def json_status(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies count as JSON by their grammar: keys may repeat, depth and size don't matter, errors anywhere do."""
    pages = S.event_pages(spark, folder).select("page_id", "html")
    forms = S.json_pages(spark, folder).select((-1 - F.col("page_id")).alias("page_id"), "html")
    return pages.union(forms).select("page_id", L.json_status(F.col("html")).alias("status"))


@query(
    "json_values",
    f"""WITH forms(kind, pos, form_path, form_value) AS (VALUES
  (0, 0, '$["a"]', '1'), (0, 1, '$["a"]', 'two'), (0, 2, '$["list"][0]', 'true'), (0, 3, '$["list"][1]', 'null'), (0, 4, '$["list"][2]["n"]', '-1.5e3'),
  (1, 0, NULL, NULL), (4, 0, '$[0]', 'x y'), (4, 1, '$[1]', 'A/b'))
SELECT -1 - event_id AS page_id, pos, coalesce(form_path, '$' || repeat('[0]', CASE WHEN event_id % {S.JSON_FEW} < {len(S.JSON_BODIES)} THEN {S.JSON_FAR} ELSE {S.JSON_DEPTH} END)) AS path,
  coalesce(form_value, '/d' || event_id || '.xls') AS value FROM events JOIN forms ON kind = event_id % {len(S.JSON_BODIES)}
UNION ALL
SELECT event_id, unnest(range(5 + n))::INTEGER, unnest(list_concat(['$["props"]["items"][0]["file"]', '$["props"]["items"][0]["note"]'], list_concat(
    CASE n WHEN 1 THEN ['$["props"]["items"][0]["note"]'] ELSE [] END, ['$["props"]["items"][1]["deep"]["k"][0]', '$["props"]["items"][1]["deep"]["k"][1]["alt"]',
    '$["props"]["key' || event_id || '.xlsx"]']))),
  unnest(list_concat(['/api/f' || event_id || '.xls', 'plain'], list_concat(CASE n WHEN 1 THEN ['a repeated key'] ELSE [] END,
    ['1', 'https://files.example.org/a' || event_id || '.XLSX', 'only a key'])))
FROM (SELECT event_id, 1 - event_id % 2 AS n FROM events WHERE event_type = 'click')""",
)
def json_values(spark: SparkSession, folder: str) -> DataFrame:
    """Paths and values of embedded JSON, among them lists in lists hundreds deep and keys that repeat."""
    pages = S.event_pages(spark, folder).select("page_id", "html")
    forms = S.json_pages(spark, folder).select((-1 - F.col("page_id")).alias("page_id"), "html")
    return L.json_values(pages.union(forms))


@query(
    "script_url_scan",
    """
SELECT event_id AS page_id, 'https://portal.example.org/cdn/s' || event_id || '.xlsx?d=2' AS url
FROM events WHERE event_type = 'signup'""",
)
def script_url_scan(spark: SparkSession, folder: str) -> DataFrame:
    pages = S.event_pages(spark, folder)
    urls = L.stream_urls(F.col("html"), F.col("url"))
    return pages.select("page_id", F.explode(urls).alias("url"))


@query(
    "fallback_union",
    """
SELECT event_id AS page_id, 'anchor' AS strategy, 'https://portal.example.org/dl/' || event_id || '.xlsx?v=1' AS url
FROM events WHERE event_type IN ('view', 'signup')
UNION ALL
SELECT event_id, 'json', unnest(['https://portal.example.org/api/f' || event_id || '.xls', 'https://files.example.org/a' || event_id || '.XLSX'])
FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, 'stream', 'https://portal.example.org/cdn/s' || event_id || '.xlsx?d=2' FROM events WHERE event_type = 'signup'
UNION ALL
SELECT event_id, 'direct', 'https://portal.example.org/direct/p' || event_id || '.xlsx' FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, 'rendered', 'https://portal.example.org/r/' || event_id || '.xls#x' FROM events WHERE event_type = 'error'""",
)
def fallback_union(spark: SparkSession, folder: str) -> DataFrame:
    return L.harvest_workbooks(S.event_pages(spark, folder), S.rendered_pages(spark, folder))
