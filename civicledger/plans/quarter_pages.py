"""Cumulative quarterly statements in all three layouts, rendered from line items: one page per agency and quarter.

Years take turns with the layouts: without a rate, with one, with one and an appropriation. A page has two sections,
their totals, and a line whose cells ran together for one agency.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicledger.operators.columns import add_once
from civicledger.operators.statements import CLASSES
from civicledger.plans.statement_pages import _cell, _printed, _with_total
from civicledger.sources.tables import table

AGENCIES = 10
SPOILT_AGENCY = 7
_STATUSES = {"f": "F", "o": "O"}
_DATES = ["March 31", "June 30", "September 30", "December 31"]


def _totals(spark: SparkSession, folder: str) -> DataFrame:
    """Cents per agency, year, quarter, status and class, accumulated over the year."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    klass = F.when(F.col("l_returnflag") == "A", "ps").when(F.col("l_returnflag") == "N", "mooe").otherwise("co")
    leaf = table(spark, folder, "lineitem").select(
        (F.col("l_suppkey") % AGENCIES).alias("agency"), F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter"), "l_linestatus", klass.alias("class"), cents.alias("cents")
    )
    names = [f"{s}_{k}" for s in _STATUSES for k in CLASSES[:3]]
    sums = [F.sum(F.when((F.col("l_linestatus") == _STATUSES[n[0]]) & (F.col("class") == n[2:]), F.col("cents")).otherwise(0)).alias(n) for n in names]
    found = leaf.groupBy("agency", "year", "quarter").agg(*sums)
    # A quarter without items still has a statement: its cents are zero.
    quarters = found.select("agency", "year").distinct().withColumn("quarter", F.explode(F.sequence(F.lit(1), F.lit(4))))
    every = quarters.join(found, ["agency", "year", "quarter"], "left")
    upto = Window.partitionBy("agency", "year").orderBy("quarter")
    return every.select("agency", "year", "quarter", *[F.sum(F.coalesce(n, F.lit(0))).over(upto).alias(n) for n in names])


def _line(label: Column, indent: Column, allotment: Column, twice: Column) -> Column:
    spent = F.transform(allotment, lambda a: F.floor(a * 9 / 10).cast("long"))
    al, ob = _with_total(allotment), _with_total(spent)
    left = F.zip_with(al, ob, lambda a, o: a - o)
    cells = F.array_join(F.transform(F.concat(al, ob, left), lambda amount: _cell(_printed(amount, indent))), "")
    appropriation = F.when(F.col("layout") == 2, _cell(_printed(F.get(al, F.lit(3)), indent))).otherwise("")
    rate = F.when(F.col("layout") > 0, _cell(F.lit("&nbsp;"))).otherwise("")
    name = F.concat(F.lit("<td>"), F.repeat(F.lit("&nbsp;"), indent), label, F.lit("</td>"))
    return F.concat(F.lit("<tr>"), name, appropriation, cells, F.when(twice, cells).otherwise(""), rate, F.lit("</tr>\n"))


def quarter_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(file, fiscal_year, quarter, agency, html)."""
    totals = _totals(spark, folder).withColumn("layout", F.col("year") % 3)
    one, two = (F.array(*[f"{s}_{k}" for k in CLASSES[:3]]) for s in _STATUSES)
    both = F.zip_with(one, two, lambda a, b: a + b)
    deep = F.when(F.col("layout") == 0, 3).otherwise(6)
    flat, never = F.lit(0), F.lit(False)
    none = F.array(*[F.lit(0).cast("long")] * 3)
    office = F.concat(F.lit("Office "), F.col("agency").cast("string"))
    date = F.get(F.array(*[F.lit(d) for d in _DATES]), F.col("quarter") - 1)
    head = F.concat(
        F.lit("<table><tr><th>Budget execution as of "), date, F.lit(", "), F.col("year").cast("string"), F.lit(", in thousand pesos</th></tr>\n<tr><th>PARTICULARS</th>"),
        F.when(F.col("layout") == 2, "<th>Appropriations</th>").otherwise(""), F.when(F.col("layout") > 0, "<th>OBLIGATION RATE</th>").otherwise(""),
        F.lit("</tr>\n<tr><th>Released</th><th>Spent</th><th>Left</th></tr>\n<tr>" + "".join(f"<td>{c}</td>" for c in ["PS", "MOOE", "CO", "Total"] * 3) + "</tr>\n"),
    )
    body = F.concat(
        _line(office, flat, one, never),
        _line(F.lit("Agency Specific Budget"), deep, one, never),
        _line(F.lit("Continuing Appropriation"), deep, none, F.col("agency") == SPOILT_AGENCY),
        _line(F.lit("SUB-TOTAL, NGAs"), flat, one, never),
        _line(F.lit("B. Corporations"), flat, two, never),
        _line(F.lit("GRAND TOTAL"), flat, both, never),
    )
    file = F.format_string("%d_Q%d_%d.htm", "year", "quarter", "agency")
    pages = add_once(totals, file=file, html=F.concat(head, body, F.lit("</table>")))
    return pages.select("file", F.col("year").alias("fiscal_year"), F.concat(F.lit("Q"), "quarter").alias("quarter"), "agency", "html")


# The same accumulated sums straight from the tables.
QUARTER_SQL = """
leaf AS (
  SELECT l_suppkey % 10 AS agency, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter, l_linestatus AS s,
    CASE l_returnflag WHEN 'A' THEN 'ps' WHEN 'N' THEN 'mooe' ELSE 'co' END AS c, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem
), every AS (SELECT DISTINCT agency, year, q.quarter, k.c FROM leaf, (SELECT unnest([1, 2, 3, 4]) AS quarter) AS q, (SELECT unnest(['ps', 'mooe', 'co']) AS c) AS k),
sums AS (
  SELECT e.agency, e.year, e.quarter, e.c, coalesce(sum(cents) FILTER (s = 'F'), 0) AS f, coalesce(sum(cents) FILTER (s = 'O'), 0) AS o
  FROM every AS e LEFT JOIN leaf AS l ON l.agency = e.agency AND l.year = e.year AND l.quarter = e.quarter AND l.c = e.c GROUP BY ALL
), ytd AS (
  SELECT agency, year, quarter, c, sum(f) OVER (PARTITION BY agency, year, c ORDER BY quarter) AS f, sum(o) OVER (PARTITION BY agency, year, c ORDER BY quarter) AS o FROM sums
)"""
