"""Rule-by-rule cases of the scalar functions."""

from __future__ import annotations

import json
from decimal import Decimal
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from civicledger.functions.files import ZIP_END_OF_DIRECTORY, matches_allowed, parquet_footer_status, parquet_status, workbook_status
from civicledger.functions.json_text import is_json, json_scalars
from civicledger.functions.links import detect_quarter, detect_year, link_extension, score_text, slug_name
from civicledger.functions.money import clean_amount, clean_rate, is_quarantined
from civicledger.functions.text import decode_entities, html_text
from civicledger.functions.urls import path_has_suffix, resolve_url, url_basename
from civicledger.operators.manifest import requested_sources

NBSP = " "


def evaluate(spark, rows, names, expression):
    """Values of an expression over rows, in order."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, " + names)
    return [r.v for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def test_score(spark):
    cases = {
        "Final - July 9, 2024": 1,
        "4th Quarter (Final - December 31, 2013)": 1,
        "Preliminary Final - March 5": 1,
        "Final Summary": 1,
        "Final (Dec)": 1,
        "(Final-Revised)": 2,
        "Final": 3,
        " (FINAL) ": 3,
        "Updated - May 29, 2023": 4,
        "Updated": 5,
        "(updated)": 5,
        "Preliminary": 6,
        "Prelim": 6,
        "Preliminary-Updated - May 2": 6,
        "1st Quarter": 7,
        "2nd Quarter (Updated)": 7,
        "2nd Quarter (Final)": 7,
        "": 7,
        "Download Excel": 99,
        "Final - July 9 (excel)": 99,
    }
    assert evaluate(spark, [(t,) for t in cases], "t string", score_text(F.col("t"))) == list(cases.values())


def test_extension(spark):
    cases = {"a.XLSX": "xlsx", "a.xls?x": "xlsx", "a.pdf": "pdf", "a.xls.pdf": "xlsx", "b.html": "htm", "b.HTM": "htm", "c.doc": None, "": None}
    assert evaluate(spark, [(h,) for h in cases], "h string", link_extension(F.col("h"))) == list(cases.values())


def test_year(spark):
    cases = {"/x/SAOB2013/a.pdf": 2013, "/SAOB13/a.pdf": None, "/saob2013/a": None, "/SAOB2014x/": None, "/SAOB2011/SAOB2012/": 2011}
    assert evaluate(spark, [(h,) for h in cases], "h string", detect_year(F.col("h"))) == list(cases.values())


def test_quarter(spark):
    cases = [
        ("/SAOB2020/1stQuarter/a.pdf", "", 2020, "Q1"),
        ("/SAOB2013/4thQuarter-Final/a.pdf", "1st", 2013, "Q4"),
        ("/SAOB2015/q3/a.pdf", "", 2015, "Q3"),
        ("/SAOB2012/2ND_QUARTER/a", "", 2012, "Q2"),
        ("/SAOB2012/3rd_Quarter_2012/a.pdf", "", 2012, "?"),
        ("/SAOB2012/3rd_Quarter_2012/a.pdf", "3rd Quarter", 2012, "Q3"),
        ("/SAOB2012/First_Quarter/a.pdf", "First", 2012, "Q1"),
        ("/SAOB2011/FirstQ/a.pdf", "first", 2011, "Q2"),
        ("/SAOB2011/march/a.pdf", "", 2011, "?"),
        ("/SAOB2011/SAOB-March 2011/a.pdf", "", 2011, "Q1"),
        ("/SAOB2011/SAOB2.htm", "4th", 2011, "Q1"),
        ("/SAOB2011/Sept/a.pdf", "", 2011, "Q3"),
        ("/SAOB2014/2ND/a.pdf", "", 2014, "Q2"),
        ("/SAOB2014/FINAL/a.pdf", "", 2014, "Q4"),
        ("/SAOB2014/a.pdf", "Preliminary", 2014, "?"),
        ("/SAOB2014/a.pdf", "first", 2014, "?"),
        ("/SAOB2016/a.pdf", "Second Quarter", 2016, "Q2"),
        ("/SAOB2016/a.pdf", "report", 2016, "?"),
        ("/a.pdf", "1st", None, "?"),
    ]
    got = evaluate(spark, [c[:3] for c in cases], "h string, t string, y int", detect_quarter(F.col("h"), F.col("t"), F.col("y")))
    assert got == [c[3] for c in cases]


def test_slug(spark):
    cases = [
        ("4th Quarter (Final - Dec 31)", "2013_Q4_4th_Quarter_Final_-_Dec_31.pdf"),
        ("(..)", "2013_Q4_...pdf"),
        ("()", "2013_Q4_2013_Q4.pdf"),
        ("a" * 100, "2013_Q4_" + "a" * 80 + ".pdf"),
    ]
    name = slug_name(F.lit(2013), F.lit("Q4"), F.col("t"), F.lit("pdf"))
    assert evaluate(spark, [c[:1] for c in cases], "t string", name) == [c[1] for c in cases]


@pytest.mark.parametrize("base", ["https://www.example.org/index.php/report", "http://example.org", "https://e.org/a/b/?q=1#f", "https://e.org/a/./b/../c"])
def test_resolve_like_the_standard_library(spark, base):
    hrefs = [
        "", "x.pdf", "./x", "../x", "../../../x", "/x//y/", "/a/./b/../c", "a/..", "..", "/a/..", "?z=2", "#top", "?z#t",
        "//cdn.example.com/x", "https://other.org/a/../b", "mailto:a@b.c", "javascript:void(0)", "/a b/c d.pdf", "x?y=/../z",
    ]
    got = evaluate(spark, [(h,) for h in hrefs], "h string", resolve_url(F.lit(base), F.col("h")))
    assert got == [urljoin(base, h) for h in hrefs]


def test_path_suffix_and_basename(spark):
    urls = ["https://e.org/a.XLSX?v=1", "https://e.org/a.xls#s", "https://e.org/a.xls;v=2", "https://e.org/a?f=b.xlsx", "https://e.org/a.xlsb", "https://e.org/d/"]
    assert evaluate(spark, [(u,) for u in urls], "u string", path_has_suffix(F.col("u"))) == [True, True, True, False, False, False]
    names = evaluate(spark, [(u,) for u in urls], "u string", url_basename(F.col("u"), F.lit(7)))
    assert names == ["a.XLSX", "a.xls", "a.xls", "a", "a.xlsb", "download_7.xlsx"]


def test_entities_and_text(spark):
    texts = ["a &amp; b", "&#65;&#x42;&#128512;", "&eacute;&nope;&", "no", "&#0;", "&lt;b&gt;"]
    want = ["a & b", "AB\U0001f600", "é&nope;&", "no", "�", "<b>"]
    assert evaluate(spark, [(t,) for t in texts], "t string", decode_entities(F.col("t"))) == want
    assert evaluate(spark, [("&#0000000065;&#x00000041;&#99999999999;&#xFFFFFFFFFFFFFFFFFFFF;",)], "t string", decode_entities(F.col("t"))) == ["AA\ufffd\ufffd"]
    html = [f"<b> Congress </b>&nbsp; of<i> x</i>", "a\n b"]
    assert evaluate(spark, [(h,) for h in html], "h string", html_text(F.col("h"))) == ["Congressofx", "a\n b"]


def test_amounts(spark):
    cases = {
        "4,321,098 ": (4321098, False),
        "(30,742)": (-30742, False),
        "-6,208": (-6208, False),
        "-2,971,519": (-2971519, False),
        "-": (0, False),
        "": (0, False),
        f"-{NBSP}-": (0, False),
        f"{NBSP}7{NBSP}": (7, False),
        "1234": (1234, False),
        "46,670,858,": (None, True),
        "2,79,674": (None, True),
        "3,,638,147": (None, True),
        "(891, 918)": (None, True),
        "240,329-": (None, True),
        "272.437,697": (None, True),
        "< 438,372": (None, True),
        "`": (None, True),
        "(12": (None, True),
        "8,552.086": (None, True),
        None: (None, True),
        "9" * 30: (int("9" * 30), False),
        "9" * 31: (None, True),
    }
    amounts = evaluate(spark, [(c,) for c in cases], "c string", clean_amount(F.col("c")))
    assert amounts == [None if v is None else Decimal(v) for v, _ in cases.values()]
    flags = evaluate(spark, [(c,) for c in cases], "c string", is_quarantined(F.col("c")))
    assert flags == [q for _, q in cases.values()]


def test_rates(spark):
    cases = {"94.65%": "94.65", "84,40%": "84.40", "1,234.50 %": "1234.50", "-3.1%": "-3.10", "12345678901%": "12345678901.00", "n/a": None, "": None}
    got = evaluate(spark, [(c,) for c in cases], "c string", clean_rate(F.col("c")))
    assert [None if v is None else str(v) for v in got] == list(cases.values())


def test_allow_list(spark):
    names = ["a.parquet", "A.JSON", "d/b.csv", "README.md", "x.md5", "parquet", "a.xlsx"]
    assert evaluate(spark, [(n,) for n in names], "n string", matches_allowed(F.col("n"))) == [True] * 4 + [False] * 3


def test_signatures(spark):
    parquet = [(b"PAR1....PAR1",), (b"PAR1....PA",), (b"XXXX....PAR1",), (b"PA",), (b"",)]
    status = parquet_status(F.col("c"), F.col("c"))
    assert evaluate(spark, parquet, "c binary", status) == ["ok", "truncated", "bad_header", "bad_header", "bad_header"]
    end = ZIP_END_OF_DIRECTORY + b"\0" * 16
    good = b"PK\x03\x04..." + end + b"\0\0"
    commented = b"PK\x03\x04..." + end + b"\x2c\x01" + b"PK\x05\x06" * 75
    embedded = good + b"more content that was cut off"
    books = [(good,), (commented,), (embedded,), (commented[:-1],), (b"PK\x03\x04...",), (b"<html>",), (b"PK\x03\x04\x05\x04\xb0\x50\x60",), (None,)]
    got = evaluate(spark, books, "c binary", workbook_status(F.col("c"), F.col("c")))
    assert got == ["valid", "valid", *["no_end_of_directory"] * 3, "not_a_zip", "no_end_of_directory", "not_a_zip"]


def test_requested_sources():
    valid = ["gaa", "tax", "saaodb"]
    assert requested_sources("all", valid) == ["gaa", "saaodb", "tax"]
    assert requested_sources(" GAA,tax", valid) == ["gaa", "tax"]
    with pytest.raises(ValueError, match="nope"):
        requested_sources("gaa,nope", valid)


class _Pairs(list):
    """The members of an object, repeated keys included."""


def _scalars(value, path="$"):
    if isinstance(value, _Pairs):
        for key, member in value:
            yield from _scalars(member, f"{path}[{json.dumps(key, ensure_ascii=False)}]")
    elif isinstance(value, list):
        for i, item in enumerate(value):
            yield from _scalars(item, f"{path}[{i}]")
    else:
        yield path, value


def test_json_by_structure(spark):
    many = json.dumps([{"i": i, "l": [i, [str(i)]]} for i in range(1500)])
    good = ["{}", "[]", ' {"a":1}\n', '"x.xlsx"', "12", "-0.5e+3", '[1,2,[3,{"a":[],"b":{}}]]', '{"a":1,"a":"two"}', '{"k\\"1":"v\\u0041\\n","t":true,"n":null}']
    good += ["[NaN,-Infinity]", '[" ,:{}[]\\\\"]', '["é☃", {"ü": ["x"]}]', many, json.dumps("y" * 300_000), "[" * 2000 + '"deep"' + "]" * 2000]
    bad = ["", "  ", "{", "}", "{]", "[1,]", '{"a"}', '{"a":}', '{"a":1,}', "{1:2}", "[01]", "[1 2]", "[.5]", "[1.]", '["a" "b"]', "tru", "truefalse", "[tru e]", "{'a':1}", '["a\nb"]']
    bad += ['["\\x"]', '["\\u12"]', '{"a":1}}', '{"a":1}{}', "[" * 2000 + "]" * 1999, "[\x01]", "\x01", '{"a":\x02}', "[1e]", "- 1", '["a]', '{"a":1 "b":2}', many[:-1], "[+1]", '{"a"::1}', "{:1}", "[,]", "[1,,2]"]
    rows = spark.createDataFrame(list(enumerate(good + bad)), "i int, t string").repartition(4)
    got = {r.i: (r.ok, r.found) for r in rows.select("i", is_json(F.col("t")).alias("ok"), json_scalars(F.col("t")).alias("found")).collect()}
    for i, text in enumerate(good):
        want = [("$" + "[0]" * 2000, "deep")] if i == len(good) - 1 else list(_scalars(json.loads(text, object_pairs_hook=_Pairs)))
        assert got[i][0] and [r.path for r in got[i][1]] == [p for p, _ in want]
        assert all(r.value == v for r, (_, v) in zip(got[i][1], want) if isinstance(v, str))
    assert all(got[i] == (False, None) for i in range(len(good), len(good) + len(bad)))
    assert spark.range(1).select(json_scalars(F.lit(None).cast("string")).alias("x")).first().x is None


def test_parquet_footers(spark):
    size = lambda n: n.to_bytes(4, "little")
    cases = {
        b"PAR1" + b"x" * 300 + size(300) + b"PAR1": "ok",
        b"PAR1" + b"x" * 300 + size(301) + b"PAR1": "impossible_footer",
        b"PAR1" + b"x" * 300 + size(0) + b"PAR1": "impossible_footer",
        b"PAR1" + b"x" * 300 + b"\xff\xff\xff\xffPAR1": "impossible_footer",
        b"PAR1": "impossible_footer",
        b"PAR1" + b"x" * 300: "truncated",
        b"PAR2" + b"x" * 300 + size(300) + b"PAR1": "bad_header",
        b"": "bad_header",
    }
    rows = [(bytearray(c[:4]), bytearray(c[-8:]), len(c)) for c in cases]
    assert evaluate(spark, rows, "head binary, tail binary, size bigint", parquet_footer_status(F.col("head"), F.col("tail"), F.col("size"))) == list(cases.values())
