"""Inputs of this domain derived from the test tables.

The test tables hold no report links, statements or manifests. These functions derive such inputs from
whole tables with Spark, one page or file per source row or per bounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.functions.files import content_sha256
from civicledger.operators.columns import add_once
from civicledger.sources.tables import APPROPRIATION_SCHEMA, table

PORTAL = "https://portal.example.org/stats/index"
YEAR_SHIFT = 14  # moves the order years into the range that the quarter rules distinguish


def choose(key: Column, values: list[str | None]) -> Column:
    """The value at position ``key`` (from zero)."""
    return F.get(F.array(*[F.lit(v) for v in values]), key.cast("int"))


# ---------------------------------------------------------------- report links


def order_links(spark: SparkSession, folder: str) -> DataFrame:
    """One report link per order: (page_id, pos, href, text)."""
    o = table(spark, folder, "orders")
    year = (F.year("o_orderdate") + YEAR_SHIFT).cast("string")
    quarter = F.quarter("o_orderdate")
    ordinal = choose(quarter - 1, ["1st", "2nd", "3rd", "4th"])
    month = F.date_format("o_orderdate", "MMMM")
    status = F.when(F.col("o_orderstatus") == "F", "Final").when(F.col("o_orderstatus") == "O", "Updated")
    status = status.otherwise("Preliminary")
    style = F.substring("o_orderpriority", 1, 1).cast("int")
    bare = F.concat(ordinal, F.lit(" Quarter"))
    last = (
        F.when(F.col("o_orderstatus") == "F", "Download Excel")
        .when(F.col("o_orderstatus") == "O", "Final Summary")
        .otherwise(bare)
    )
    dated = F.format_string("%s (%s - %s %d, %s)", bare, status, month, F.dayofmonth("o_orderdate"), year)
    text = (
        F.when(style == 1, dated)
        .when(style == 2, F.concat(status, F.lit("-Revised")))
        .when(style == 3, F.concat(F.lit("("), status, F.lit(")")))
        .when(style == 4, F.concat(bare, F.lit(" ("), status, F.lit(")")))
        .otherwise(last)
    )
    subfolder = (
        F.when(style == 1, F.concat(ordinal, F.lit("Quarter")))
        .when(style == 2, F.concat(F.lit("Q"), quarter.cast("string")))
        .when(style == 3, F.concat(ordinal, F.lit("_Quarter")))
        .when(style == 4, F.concat(F.lit("SAOB-"), month, F.lit(" "), year))
        .otherwise("reports")
    )
    suffix = choose(F.col("o_orderkey") % 5, [".pdf", ".htm", ".html", ".XLSX", ".doc"])
    href = F.concat(F.lit("/files/SAOB"), year, F.lit("/"), subfolder, F.lit("/doc"), F.col("o_orderkey"), suffix)
    links = add_once(o, href=href, text=text)
    return links.select(F.col("o_custkey").alias("page_id"), F.col("o_orderkey").alias("pos"), "href", "text")


ORDER_LINKS_SQL = """
links AS (
  SELECT o_custkey AS page_id, o_orderkey AS pos,
    '/files/SAOB' || y || '/' || CASE s
      WHEN 1 THEN ord || 'Quarter' WHEN 2 THEN 'Q' || q WHEN 3 THEN ord || '_Quarter'
      WHEN 4 THEN 'SAOB-' || mon || ' ' || y ELSE 'reports' END
      || '/doc' || o_orderkey
      || CASE o_orderkey % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.htm' WHEN 2 THEN '.html' WHEN 3 THEN '.XLSX' ELSE '.doc' END
      AS href,
    CASE s
      WHEN 1 THEN ord || ' Quarter (' || word || ' - ' || mon || ' ' || day(o_orderdate) || ', ' || y || ')'
      WHEN 2 THEN word || '-Revised'
      WHEN 3 THEN '(' || word || ')'
      WHEN 4 THEN ord || ' Quarter (' || word || ')'
      ELSE CASE o_orderstatus WHEN 'F' THEN 'Download Excel' WHEN 'O' THEN 'Final Summary' ELSE ord || ' Quarter' END
    END AS text
  FROM (SELECT *, CAST(year(o_orderdate) + 14 AS VARCHAR) AS y, quarter(o_orderdate) AS q,
               CASE quarter(o_orderdate) WHEN 1 THEN '1st' WHEN 2 THEN '2nd' WHEN 3 THEN '3rd' ELSE '4th' END AS ord,
               monthname(o_orderdate) AS mon,
               CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Updated' ELSE 'Preliminary' END AS word,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS s
        FROM orders)
)"""

# The clue words, patterns and ranks in these rules must equal those of `functions/links.py`.
LINK_RULES_SQL = """
ruled AS (
  SELECT *,
    CASE WHEN contains(lower(href), '.xls') THEN 'xlsx' WHEN contains(lower(href), '.pdf') THEN 'pdf'
         WHEN contains(lower(href), '.htm') THEN 'htm' END AS ext,
    TRY_CAST(nullif(regexp_extract(href, '/SAOB([0-9]{4})/', 1), '') AS INTEGER) AS year,
    lower(text) AS t, lower(href) AS h
  FROM links
),
records AS (
  SELECT page_id, pos, href, text, ext, year,
    CASE
      WHEN regexp_matches(h, '/1stquarter') THEN 'Q1' WHEN regexp_matches(h, '/2nd_?quarter') THEN 'Q2'
      WHEN regexp_matches(h, '/3rdquarter') THEN 'Q3' WHEN regexp_matches(h, '/4th_?quarter') THEN 'Q4'
      WHEN regexp_matches(h, '/q[1-4]/') THEN upper(regexp_extract(h, '/(q[1-4])/', 1))
      WHEN year IS NULL THEN '?'
      WHEN year <= 2013 AND regexp_matches(href, 'SAOB2\\.htm|SAOB2_|March|1stQ') THEN 'Q1'
      WHEN year <= 2013 AND regexp_matches(href, 'June|2ndQ|FirstQ') THEN 'Q2'
      WHEN year <= 2013 AND regexp_matches(href, 'Sept|3rdQ') THEN 'Q3'
      WHEN year <= 2013 AND regexp_matches(href, 'Dec|4th|4TH') THEN 'Q4'
      WHEN year = 2014 THEN CASE
        WHEN contains(t, '1st') THEN 'Q1' WHEN contains(t, '2nd') OR contains(href, '2ND') THEN 'Q2'
        WHEN contains(t, '3rd') OR contains(href, '3rd') THEN 'Q3'
        WHEN contains(t, '4th') OR contains(href, '4TH') OR contains(href, 'FINAL') THEN 'Q4' ELSE '?' END
      WHEN regexp_matches(t, '1st|first') THEN 'Q1' WHEN regexp_matches(t, '2nd|second') THEN 'Q2'
      WHEN regexp_matches(t, '3rd|third') THEN 'Q3' WHEN regexp_matches(t, '4th|fourth') THEN 'Q4'
      ELSE '?' END AS quarter,
    CASE
      WHEN regexp_matches(t, 'download|excel') THEN 99
      WHEN contains(t, 'final -') AND regexp_matches(t, 'january|february|march|april|may|june|july|august|september|october|november|december') THEN 1
      WHEN contains(t, 'final') AND NOT contains(t, 'preliminary') AND regexp_matches(t, 'jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec') THEN 1
      WHEN contains(t, 'final') AND contains(t, 'revised') THEN 2
      WHEN trim(t, '() ') = 'final' THEN 3
      WHEN contains(t, 'updated') AND NOT contains(t, 'preliminary') AND regexp_matches(t, 'jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec') THEN 4
      WHEN trim(t, '() ') = 'updated' THEN 5
      WHEN contains(t, 'prelim') THEN 6
      ELSE 7 END AS score
  FROM ruled
),
kept AS (SELECT * FROM records WHERE ext IS NOT NULL AND year IS NOT NULL AND quarter <> '?')"""

LINKS_SQL = f"WITH {ORDER_LINKS_SQL}, {LINK_RULES_SQL}"


def order_listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One small listing page per order, holding its link as HTML."""
    anchor = F.concat(
        F.lit('<ul class="reports">\n<li><a class="f" href="'), "href", F.lit('">\n<b>'), "text", F.lit("</b> </a></li></ul>")
    )
    hidden = F.lit('<!-- <a href="/files/SAOB2012/Q1/old.pdf">Final</a> --><script>var a = "<a href=x.pdf>";</script>')
    return order_links(spark, folder).select(
        F.col("page_id").alias("customer"), F.col("pos").alias("page_id"), F.concat(hidden, anchor).alias("html")
    )


# ---------------------------------------------------------------- portal pages


def event_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One portal page per event; its type decides how the page carries its links."""
    e = table(spark, folder, "events")
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    anchor = F.concat(
        F.lit('<a href="../dl/'), number, F.lit('.xlsx?v=1">get</a><a href="dl/'), number, F.lit('.pdf">pdf</a>')
    )
    data = F.concat(
        F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"items":[{"file":"\\/api\\/f'),
        number,
        F.lit('.xls","note":"plain"'),
        F.when(F.col("event_id") % 2 == 0, ',"note":"a repeated key"').otherwise(""),
        F.lit('},{"deep":{"k":[1,{"alt":"https://files.example.org/a'),
        number,
        F.lit('.XLSX"}]}}],"key'),
        number,
        F.lit('.xlsx":"only a key"}}</script>'),
    )
    stream = F.concat(
        F.lit("<script>self.__next_f.push([1,'\\/cdn\\/s"),
        number,
        F.lit(".xlsx?d=2','/about'])</script><script>var other = '/cdn/none.xlsx';</script>"),
    )
    html = (
        F.when(kind == "view", anchor)
        .when(kind == "click", data)
        .when(kind == "signup", F.concat(anchor, stream, anchor))
        .otherwise("<p>loading</p>")
    )
    url = F.when(kind == "purchase", F.concat(F.lit("https://portal.example.org/direct/p"), number, F.lit(".xlsx")))
    pages = add_once(e, url=url.otherwise(PORTAL), html=html)
    return pages.select(F.col("event_id").alias("page_id"), "url", "html")


# Bodies of embedded JSON by the remainder of the event's number: what grammar accepts and what it doesn't.
JSON_BODIES = [
    ("json", '{"a": 1, "a": "two", "list": [true, null, {"n": -1.5e3}]}'),
    ("json", "DEEP"),
    ("not_json", "HALF"),
    ("not_json", '{"a": [1, 2,]}'),
    ("json", ' ["x y", "\\u0041\\/b", [], {}] '),
    ("not_json", '{"a": 01}'),
    ("none", ""),
    ("not_json", '{"file": "/a.xlsx"} {"more": 1}'),
]
# Lists in lists: usually so deep, and far deeper for a few events.
JSON_DEPTH, JSON_FAR, JSON_FEW = 12, 2000, 8000


def json_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages whose embedded JSON is well formed or not, in one way or another: (page_id, url, html)."""
    e = table(spark, folder, "events")
    number = F.col("event_id").cast("string")
    depth = F.when(F.col("event_id") % JSON_FEW < len(JSON_BODIES), JSON_FAR).otherwise(JSON_DEPTH)
    deep = F.concat(F.repeat(F.lit("["), depth), F.lit('"/d'), number, F.lit('.xls"'), F.repeat(F.lit("]"), depth))
    half = F.concat(F.repeat(F.lit("["), depth), F.lit('"/h'), number, F.lit('.xls"'), F.repeat(F.lit("]"), depth - 1))
    kinds = {"DEEP": deep, "HALF": half}
    body = F.get(F.array(*[kinds.get(text, F.lit(text)) for _, text in JSON_BODIES]), (F.col("event_id") % len(JSON_BODIES)).cast("int"))
    html = F.concat(F.lit('<main>list</main><script id="__NEXT_DATA__">'), body, F.lit("</script>"))
    return e.select(F.col("event_id").alias("page_id"), F.lit(PORTAL).alias("url"), html.alias("html"))


def rendered_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots of the same pages after rendering."""
    e = table(spark, folder, "events")
    html = F.concat(F.lit("<main><a href='/r/"), F.col("event_id").cast("string"), F.lit(".xls#x'>file</a></main>"))
    return e.select(F.col("event_id").alias("page_id"), F.lit(PORTAL).alias("url"), html.alias("html"))


# ---------------------------------------------------------------- files and manifests


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as raw files: (doc_id, relative_path, size_bytes, checksum)."""
    d = table(spark, folder, "documents")
    content = F.encode("text", "UTF-8")
    return d.select(
        "doc_id",
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("relative_path"),
        F.octet_length("text").cast("long").alias("size_bytes"),
        content_sha256(content).alias("checksum"),
    )


def document_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Entries for the labelled documents; those of low quality recorded an older content."""
    stale = F.when(F.col("quality") == 1, F.col("checksum")).otherwise(F.lit("0" * 64))
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return document_files(spark, folder).join(labels, "doc_id").withColumn("checksum", stale).drop("quality")


def event_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest entries written over time, several per path."""
    return entries_of(table(spark, folder, "events"))


def entries_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("/"), "event_type").alias("relative_path"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("event_id").alias("size_bytes"),
        F.md5(F.col("props")).alias("checksum"),
    )


EVENT_ENTRIES_SQL = """
entries AS (
  SELECT 'u' || user_id || '/' || event_type AS relative_path, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp,
         event_id AS size_bytes, md5(props) AS checksum
  FROM events)"""


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """A run log: one run per event."""
    e = table(spark, folder, "events")
    failed = F.col("event_type") == "error"
    return e.select(
        F.col("event_id").alias("run_id"),
        choose(F.col("user_id") % 3, ["GAA (hub)", "Tax collection", "Quarterly statements"]).alias("name"),
        ((F.col("value") >= 50) & ~failed).alias("success"),
        F.when(failed, 0).otherwise(F.floor("value")).cast("int").alias("files_downloaded"),
        (F.col("user_id") % 5).cast("int").alias("files_skipped"),
        F.round("value", 2).alias("duration_seconds"),
        F.when(failed, F.concat(F.lit('timeout "'), F.col("user_id").cast("string"), F.lit('"'))).alias("error"),
        F.to_date("ts").alias("day"),
        F.when(failed, "failed").when(F.col("user_id") % 5 == 0, "skipped").otherwise("downloaded").alias("status"),
    )


RUNS_SQL = """
runs AS (
  SELECT event_id AS run_id,
    CASE user_id % 3 WHEN 0 THEN 'GAA (hub)' WHEN 1 THEN 'Tax collection' ELSE 'Quarterly statements' END AS name,
    (value >= 50 AND event_type <> 'error') AS success,
    CAST(CASE WHEN event_type = 'error' THEN 0 ELSE floor(value) END AS INTEGER) AS files_downloaded,
    CAST(user_id % 5 AS INTEGER) AS files_skipped, round(value, 2) AS duration_seconds,
    CASE WHEN event_type = 'error' THEN 'timeout "' || user_id || '"' END AS error,
    CAST(ts AS DATE) AS day,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN user_id % 5 = 0 THEN 'skipped' ELSE 'downloaded' END AS status
  FROM events)"""


# ---------------------------------------------------------------- appropriations


def appropriations(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in the appropriation schema: supplier = agency, its nation = department."""
    agencies = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    joined = table(spark, folder, "lineitem").join(agencies, F.col("l_suppkey") == F.col("s_suppkey"))
    text = F.lit(None).cast("string")
    columns = {
        "id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "department": F.lpad(F.col("s_nationkey").cast("string"), 2, "0"),
        "uacs_dpt_dsc": F.col("n_name"),
        "agency": F.lpad((F.col("l_suppkey") % 1000).cast("string"), 3, "0"),
        "uacs_agy_dsc": F.col("s_name"),
        "prexc_fpap_id": F.lpad(F.col("l_partkey").cast("string"), 15, "0"),
        "dsc": F.concat(F.lit("Program "), F.col("l_partkey").cast("string")),
        "operunit": F.lit("0000000"),
        "uacs_reg_id": F.lpad(F.col("n_regionkey").cast("string"), 2, "0"),
        "fundcd": F.lit("101101"),
        "uacs_exp_cd": F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "N", "2").otherwise("6"),
        "uacs_sobj_cd": F.lpad(F.col("l_linenumber").cast("string"), 10, "0"),
        "amt": F.col("l_extendedprice"),
        "year": F.year("l_shipdate").cast("long"),
    }
    names = [line.split()[0] for line in APPROPRIATION_SCHEMA.replace("\n", " ").split(",")]
    return joined.select(*[columns.get(name, text).alias(name) for name in names])
