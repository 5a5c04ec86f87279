"""Classification of report links: format, year, quarter, status and file name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicledger.functions.text import blank_to_null, contains_any, first_match, strip_ws

# Format markers in a link address, in the order they are tried.
FORMAT_MARKERS = [(".xls", "xlsx"), (".pdf", "pdf"), (".htm", "htm")]

# Address fragments that name a quarter, in the order they are tried.
QUARTER_IN_PATH = [
    (r"(?:/|^)1stQuarter", "Q1"),
    (r"(?:/|^)2ndQuarter", "Q2"),
    (r"(?:/|^)2nd_Quarter", "Q2"),
    (r"(?:/|^)3rdQuarter", "Q3"),
    (r"(?:/|^)4thQuarter", "Q4"),
    (r"(?:/|^)4th_Quarter", "Q4"),
    (r"/Q1/", "Q1"),
    (r"/Q2/", "Q2"),
    (r"/Q3/", "Q3"),
    (r"/Q4/", "Q4"),
]

# Case-sensitive address clues used up to 2013.
EARLY_CLUES = [
    (["SAOB2.htm", "SAOB2_", "March", "1stQ"], "Q1"),
    (["June", "2ndQ", "FirstQ"], "Q2"),
    (["Sept", "3rdQ"], "Q3"),
    (["Dec", "4th", "4TH"], "Q4"),
]

# Ordinals in the link text.
ORDINALS = [(["1st", "first"], "Q1"), (["2nd", "second"], "Q2"), (["3rd", "third"], "Q3"), (["4th", "fourth"], "Q4")]

# What decides the quarter in 2014, as (text clue, address clues).
CLUES_2014 = [("1st", [], "Q1"), ("2nd", ["2ND"], "Q2"), ("3rd", ["3rd"], "Q3"), ("4th", ["4TH", "FINAL"], "Q4")]

# Month names.
MONTHS = "january february march april may june july august september october november december".split()

UNKNOWN_QUARTER = "?"
SKIP_SCORE = 99


def link_extension(href: Column) -> Column:
    """Format class by substring of the address; null when none is named."""
    lowered = F.lower(href)
    return first_match([(lowered.contains(marker), ext) for marker, ext in FORMAT_MARKERS])


def detect_year(href: Column) -> Column:
    """The year of a ``/SAOBYYYY/`` folder, or null."""
    return blank_to_null(F.regexp_extract(href, r"/SAOB([0-9]{4})/", 1)).cast("int")


def detect_quarter(href: Column, text: Column, year: Column) -> Column:
    """Quarter from the address, else from clues that depend on the year, else ``?``."""
    words = F.lower(text)
    unknown = F.lit(UNKNOWN_QUARTER)
    by_path = [(href.rlike("(?i)" + pattern), quarter) for pattern, quarter in QUARTER_IN_PATH]
    by_text = first_match([(contains_any(words, names), q) for names, q in ORDINALS], unknown)
    early = first_match([(contains_any(href, clues), q) for clues, q in EARLY_CLUES], by_text)
    in_2014 = first_match([(words.contains(w) | contains_any(href, clues), q) for w, clues, q in CLUES_2014], unknown)
    by_year = [(year.isNull(), unknown), (year <= 2013, early), (year == 2014, in_2014)]
    return first_match(by_path + by_year, by_text)


def score_text(text: Column) -> Column:
    """Publication status of a link as a rank: 1 is best, 7 is a bare quarter name, 99 is to be skipped."""
    t = F.lower(strip_ws(text))
    bare = F.trim(t, F.lit("() "))
    final, updated = t.contains("final"), t.contains("updated")
    settled = ~t.contains("preliminary")
    dated = t.rlike("|".join(month[:3] for month in MONTHS))
    rules = [
        (contains_any(t, ["download", "excel"]), SKIP_SCORE),
        (t.contains("final -") & t.rlike("|".join(MONTHS)), 1),
        (final & settled & dated, 1),
        (final & t.contains("revised"), 2),
        (bare == "final", 3),
        (updated & settled & dated, 4),
        (bare == "updated", 5),
        (t.contains("prelim"), 6),
    ]
    return first_match(rules, F.lit(7))


def slug_name(year: Column, quarter: Column, text: Column, ext: Column, width: int = 80) -> Column:
    """Safe file name ``{year}_{quarter}_{slug}.{ext}``; the slug falls back to the period."""
    period = F.concat_ws("_", year.cast("string"), quarter)
    slug = F.trim(F.regexp_replace(text, r"[^a-zA-Z0-9._\-]+", "_"), F.lit("_"))
    slug = F.coalesce(blank_to_null(slug), period)
    return F.concat(period, F.lit("_"), F.substring(slug, 1, width), F.lit("."), ext)
