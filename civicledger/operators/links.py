"""Harvesting links from page snapshots and choosing the file to fetch per period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicledger.functions.links import (
    SKIP_SCORE,
    UNKNOWN_QUARTER,
    detect_quarter,
    detect_year,
    link_extension,
    score_text,
)
from civicledger.functions.json_text import is_json, json_scalars, json_string
from civicledger.functions.text import decode_entities, from_index, html_text, let, strip_ws, without_hidden_markup
from civicledger.functions.urls import path_has_suffix, resolve_url
from civicledger.operators.columns import add_once

_ANCHOR_OPEN = r"(?i)<a(?=\s)"
_ANCHOR = r"""(?is)^[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)[^>]*>(.*?)(?:</a\s*>.*)?\z"""
_MARK = "\u0001"

# Comments are matched too, so that scripts inside them are passed over.
_SCRIPT_OR_COMMENT = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>"
_SCRIPT_BODY = r"(?is)^<script\b[^>]*>(.*?)</script\s*>\z"
_DATA_SCRIPT = r"""(?is)^<script\b[^>]*\bid\s*=\s*["']?__NEXT_DATA__["'\s>]"""
_STREAM_MARK = "self.__next_f.push"

# A JSON string together with a following colon, which tells a key from a value. The possessive
# quantifiers keep the match iterative, so long strings cannot exhaust the stack.
_JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*:?'
_QUOTED_WORKBOOK = r"""["']((?:https?:/)?/[^"']+\.xlsx?[^"']*)["']"""


# A workbook address spells its extension out unless character references or escapes hide it.
_MAY_NAME_WORKBOOK = r"(?i)xls|&#|\\u"


def _no_urls() -> Column:
    return F.array().cast("array<string>")


def _split_open(text: Column, pattern: str) -> Column:
    """Pieces that follow each opening tag."""
    return from_index(F.split(text, pattern), 1)


def _anchors(html: Column) -> Column:
    """What follows each ``<a``, as address and inner HTML with a mark between; no mark, no address."""
    chunks = _split_open(F.translate(without_hidden_markup(html), _MARK, ""), _ANCHOR_OPEN)
    return F.transform(chunks, lambda chunk: F.regexp_replace(chunk, _ANCHOR, f"$1{_MARK}$2"))


def _href(anchor: Column) -> Column:
    return strip_ws(decode_entities(F.trim(F.substring_index(anchor, _MARK, 1), F.lit("\"'"))))


def page_anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every ``<a href>`` of each page with its position on the page, address and text."""
    rest = [c for c in pages.columns if c != html]
    anchors = pages.select(*rest, F.posexplode(_anchors(F.col(html))).alias("pos", "anchor"))
    anchor = F.col("anchor")
    href, text = _href(anchor), html_text(F.substring_index(anchor, _MARK, -1))
    return add_once(anchors.where(anchor.contains(_MARK)), href=href, text=text).select(*rest, "pos", "href", "text")


def anchor_urls(html: Column, base: Column) -> Column:
    """Workbook addresses among a page's anchors, as an array."""
    likely = F.filter(_anchors(html), lambda a: a.contains(_MARK) & a.rlike(_MAY_NAME_WORKBOOK))
    urls = F.transform(likely, lambda a: resolve_url(base, _href(a)))
    return F.when(html.rlike(_MAY_NAME_WORKBOOK), F.filter(urls, lambda u: path_has_suffix(u))).otherwise(_no_urls())


def _scripts(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(_SCRIPT_OR_COMMENT), F.lit(0))


def _script_body(script: Column) -> Column:
    return F.regexp_extract(script, _SCRIPT_BODY, 1)


def _json_body(html: Column) -> Column:
    return _script_body(F.get(F.filter(_scripts(html), lambda s: s.rlike(_DATA_SCRIPT)), F.lit(0)))


def json_status(html: Column) -> Column:
    """What a page's embedded JSON is: ``none``, ``json`` (keys may repeat) or ``not_json``, whatever its size and depth."""
    judged = let(_json_body(html), lambda body: F.when(F.coalesce(body == "", F.lit(True)), "none").when(is_json(body), "json").otherwise("not_json"))
    return F.when(html.contains("__NEXT_DATA__"), judged).otherwise("none")


def json_urls(html: Column, base: Column) -> Column:
    """Workbook addresses among the string values, at any depth, of a page's embedded JSON.

    Object keys do not count and a body that is not JSON has no addresses; see :func:`json_status`.
    """

    def found(body: Column) -> Column:
        literals = F.regexp_extract_all(body, F.lit(_JSON_STRING), F.lit(0))
        values = F.filter(literals, lambda s: ~s.endswith(":") & s.rlike(_MAY_NAME_WORKBOOK))
        decoded = F.transform(values, lambda s: json_string(F.regexp_replace(s, r"\s+\z", "")))
        wanted = F.filter(decoded, lambda u: F.lower(u).rlike(r"\.xlsx?\z") | path_has_suffix(u))
        return F.when(is_json(body), F.transform(wanted, lambda u: resolve_url(base, u))).otherwise(_no_urls())

    worthwhile = html.contains("__NEXT_DATA__") & html.rlike(_MAY_NAME_WORKBOOK)
    return F.when(worthwhile, let(F.coalesce(_json_body(html), F.lit("")), found)).otherwise(_no_urls())


def json_values(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every scalar of each page's embedded JSON: ``pos`` (order in the text), ``path`` and ``value``.

    Pages without embedded JSON, or with a body that is not JSON, have none.
    """
    rest = [c for c in pages.columns if c != html]
    body = _json_body(F.col(html))
    values = F.when(F.col(html).contains("__NEXT_DATA__"), let(body, json_scalars))
    return pages.select(*rest, F.posexplode(values).alias("pos", "v")).select(*rest, "pos", "v.path", "v.value")


def stream_urls(html: Column, base: Column) -> Column:
    """Quoted workbook addresses in streamed page scripts, whose slashes may be escaped."""
    streamed = F.filter(_scripts(html), lambda s: ~s.startswith("<!--") & s.contains(_STREAM_MARK))
    found = F.transform(
        streamed, lambda s: F.regexp_extract_all(F.replace(_script_body(s), F.lit("\\/"), F.lit("/")), F.lit(_QUOTED_WORKBOOK), F.lit(1))
    )
    return F.when(html.contains(_STREAM_MARK), F.transform(F.flatten(found), lambda u: resolve_url(base, u))).otherwise(_no_urls())


def _static_links(pages: DataFrame) -> DataFrame:
    """Adds ``links``, the (strategy, url) pairs of each page; an address belongs to the first strategy that
    finds it."""
    url, html = F.col("url"), F.col("html")

    def tagged(name: str, urls: Column) -> Column:
        return F.transform(urls, lambda u: F.struct(F.lit(name).alias("strategy"), u.alias("url")))

    found = add_once(
        pages,
        anchor=F.array_distinct(anchor_urls(html, url)),
        embedded=json_urls(html, url),
        streamed=stream_urls(html, url),
    ).drop("html")
    links = F.concat(
        tagged("anchor", F.col("anchor")),
        tagged("json", F.array_except("embedded", "anchor")),
        tagged("stream", F.array_except(F.array_except("streamed", "anchor"), "embedded")),
    )
    return found.withColumn("links", F.when(path_has_suffix(url), tagged("direct", F.array(url))).otherwise(links))


def harvest_workbooks(pages: DataFrame, rendered: DataFrame | None = None) -> DataFrame:
    """Workbook links of each page as (page_id, strategy, url).

    A page address that is itself a workbook stands for itself. ``rendered`` holds snapshots (page_id, url,
    html) taken after scripts ran; their anchors serve only the pages whose static snapshot has no link at
    all. Every snapshot is read once and reduced to its links in place, so the join moves one short row per
    page instead of HTML, and a page with very many links is still one row.
    """
    found = _static_links(pages).select("page_id", "links")
    if rendered is not None:
        snapshot = add_once(rendered, fallback=F.array_distinct(anchor_urls(F.col("html"), F.col("url"))))
        tagged = F.transform("fallback", lambda u: F.struct(F.lit("rendered").alias("strategy"), u.alias("url")))
        found = found.join(snapshot.select("page_id", tagged.alias("fallback")), "page_id", "left")
        found = found.withColumn("links", F.when(F.size("links") > 0, F.col("links")).otherwise(F.col("fallback")))
    return found.select("page_id", F.explode("links").alias("link")).select("page_id", "link.*")


def link_records(anchors: DataFrame, base: Column | None = None) -> DataFrame:
    """Report links: anchors with a known format, year and quarter, plus their status score."""
    href, text = F.col("href"), F.col("text")
    dated = add_once(anchors, ext=link_extension(href), year=detect_year(href))
    known = dated.where(F.col("ext").isNotNull() & F.col("year").isNotNull())
    quarter = detect_quarter(href, text, F.col("year"))
    records = add_once(known, quarter=quarter, score=score_text(text)).where(F.col("quarter") != UNKNOWN_QUARTER)
    return records if base is None else records.withColumn("link_url", resolve_url(base, href))


def fetchable(links: DataFrame) -> DataFrame:
    """Links that may be chosen: no spreadsheets, nothing marked to be skipped."""
    return links.where((F.col("ext") != "xlsx") & (F.col("score") < SKIP_SCORE))


def best_links(links: DataFrame, *by: str, position: tuple[str, ...] = ("pos",)) -> DataFrame:
    """The one link to fetch per group: best status, then PDF, then first in page order.

    The minimum of a struct needs no window: each task reduces a group to one row before the exchange,
    however many links the group holds.
    """
    keys = list(by) or ["year", "quarter"]
    rest = [c for c in links.columns if c not in keys and c not in position and c != "score"]
    rank = F.struct("score", (F.col("ext") != "pdf").alias("not_pdf"), *position, *rest)
    best = fetchable(links).groupBy(*keys).agg(F.min(rank).alias("best"))
    return best.select(*keys, "best.*").select(*links.columns)


def group_scores(links: DataFrame, *by: str) -> DataFrame:
    """Candidates and best status per group."""
    return fetchable(links).groupBy(*by).agg(F.count("*").alias("n_links"), F.min("score").alias("best_score"))


def link_counts(links: DataFrame) -> DataFrame:
    return links.agg(F.count("*").alias("n_links"), F.count_distinct("year").alias("n_years"))


def coverage(selected: DataFrame) -> DataFrame:
    """First, last and all covered years; a year has four digits, so the list is bounded."""
    years = F.array_sort(F.collect_set("year"))
    return selected.agg(
        F.count("*").alias("n_quarters"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.array_join(years.cast("array<string>"), ",").alias("years"),
    )


def dedupe_links(links: DataFrame, *by: str) -> DataFrame:
    return links.dropDuplicates(list(by) or ["url"])
