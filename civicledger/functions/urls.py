"""URL parts and reference resolution as Column expressions.

The pattern is the one of RFC 3986 appendix B, so addresses that contain blanks still split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicledger.functions.text import blank_to_null, let

_URI = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
_PARTS = ["scheme", "authority", "path", "query", "fragment"]
_SEPARATOR = "\u0001"


def url_parts(url: Column) -> Column:
    """Scheme, authority, path, query and fragment as an array; absent parts are empty."""
    numbered = _SEPARATOR.join(f"${i + 1}" for i in range(len(_PARTS)))
    return F.split(F.regexp_replace(url, _URI, numbered), _SEPARATOR)


def url_part(url: Column, part: str) -> Column:
    return F.regexp_extract(url, _URI, _PARTS.index(part) + 1)


def url_path(url: Column) -> Column:
    """Path without the parameters of its last segment."""
    return F.regexp_replace(url_part(url, "path"), r";[^/]*\z", "")


def path_has_suffix(url: Column, suffixes: tuple[str, ...] = ("xlsx", "xls")) -> Column:
    """Does the URL *path* end in one of the extensions (query and fragment ignored)?"""
    return F.lower(url_path(url)).rlike(rf"\.(?:{'|'.join(suffixes)})\z")


def url_basename(url: Column, fetched_at: Column | None = None) -> Column:
    """Last path segment; a URL without one is named after the time it was fetched."""
    epoch = F.unix_timestamp() if fetched_at is None else fetched_at
    name = F.element_at(F.split(url_path(url), "/"), -1)
    return F.coalesce(blank_to_null(name), F.concat(F.lit("download_"), epoch.cast("string"), F.lit(".xlsx")))


def _remove_dots(path: Column) -> Column:
    def step(kept: Column, segment: Column) -> Column:
        parent = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(segment == "..", parent).when(segment == ".", kept).otherwise(F.array_append(kept, segment))

    def rebuilt(segments: Column) -> Column:
        kept = F.reduce(segments, F.array().cast("array<string>"), step)
        closed = F.element_at(segments, -1).isin(".", "..")
        return F.concat(F.lit("/"), F.array_join(F.when(closed, F.array_append(kept, F.lit(""))).otherwise(kept), "/"))

    segments = F.split(F.substr(path, F.lit(2)), "/")
    return F.when(path.rlike(r"/\.\.?(?:/|\z)"), let(segments, rebuilt)).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` found on the page ``base``."""
    given = F.struct(
        base.alias("base"), href.alias("href"), url_parts(base).alias("base_parts"), url_parts(href).alias("parts")
    )
    return let(given, _resolved)


def _resolved(given: Column) -> Column:
    scheme, authority, path, query, fragment = (F.get(given["parts"], F.lit(i)) for i in range(5))
    base_scheme, base_authority, base_path, base_query, _ = (F.get(given["base_parts"], F.lit(i)) for i in range(5))
    network = F.concat(F.lower(base_scheme), F.lit("://"))
    origin = F.concat(network, base_authority)

    directory = F.concat(F.regexp_replace(base_path, r"[^/]*\z", ""), path)
    lead = F.when(base_path.startswith("/"), "").otherwise("/")
    joined = F.regexp_replace(F.concat(lead, directory), r"/{2,}", "/")
    rooted = F.when(path.startswith("/"), path).otherwise(joined)

    def merged(q: Column) -> Column:
        return let(rooted, lambda p: F.concat(origin, _remove_dots(p), q))

    def tail(q: Column) -> Column:
        return F.concat(
            F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""),
            F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
        )

    return (
        F.when(given["href"] == "", given["base"])
        .when((scheme != "") & (F.lower(scheme) != F.lower(base_scheme)), given["href"])
        .when(authority != "", F.concat(network, authority, path, tail(query)))
        .when(path == "", F.concat(origin, base_path, tail(F.when(query != "", query).otherwise(base_query))))
        .otherwise(merged(tail(query)))
    )
