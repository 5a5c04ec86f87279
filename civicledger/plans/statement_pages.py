"""Quarterly statements rendered from line items: one page per supplier and year.

A page always has six lines, so its size is fixed whatever the number of line items behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.operators.columns import add_once
from civicledger.operators.statements import CLASSES, MEASURES
from civicledger.sources.tables import table

# Labels of lines. (label, indent, budget sources that the line adds up)
LINES = [
    (None, 0, ["f1", "f2", "f3", "o"]),
    ("Current Year Budget", 6, ["f1", "f2", "f3"]),
    ("Agency Specific Budget", 12, ["f1"]),
    ("Special Purpose Funds", 12, ["f2"]),
    ("Automatic Appropriation", 12, ["f3"]),
    ("Continuing Appropriation", 5, ["o"]),
]

# Fixed words, which the parser looks for: PARTICULARS, the class names, "as of" with a date, the unit, the beginning
# of the appropriation heading and the rate heading. All else is an own layout.
_HEADER = """<html><body><h1>Statement</h1><table border=1>
<tr><th colspan=15>Budget execution by object, final figures as of December 31, %d, in thousand pesos</th></tr>
<tr><th rowspan=3>PARTICULARS</th><th rowspan=3>Full-year %d appropriations</th><th rowspan=3>OBLIGATION RATE</th></tr>
<tr><th colspan=4>Released</th><th colspan=4>Spent</th><th colspan=4>Left</th></tr>
<tr>"""
_CLASS_CELLS = "".join(f"<td>{c}</td>" for c in ["PS", "MOOE", "CO", "Total"]) * 3
_BLANK_ROW = "</tr>\n<tr>" + "<td>&nbsp;</td>" * 15 + "</tr>\n"
_NOTES = (
    """<tr><td colspan=15>Notes:</td></tr>
<tr><td colspan=15>1) Figures come from the agencies; 98%% reported.</td></tr>
<tr><td colspan=15>2) Except %s Office, %s News and Press, and
 the Council.</td></tr>
<tr><td>3/ Units without the required SAOB submission are as follows:</td>"""
    + "<td></td>" * 14
    + """</tr>
<tr><td colspan=15>First %s Unit; Second %s Unit</td></tr>
<tr><td colspan=15>NOTE : EXCEPT %s Board</td></tr></table></body></html>"""
)


def _budget(spark: SparkSession, folder: str) -> DataFrame:
    """Allotments and obligations in cents per supplier, year, budget source and class, side by side."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    discount, tax = (F.round(F.col(c) * 100).cast("long") for c in ("l_discount", "l_tax"))
    source = F.when(F.col("l_linestatus") == "O", "o").otherwise(
        F.when(F.col("l_linenumber") <= 3, "f1").when(F.col("l_linenumber") <= 5, "f2").otherwise("f3")
    )
    klass = F.when(F.col("l_returnflag") == "A", "ps").when(F.col("l_returnflag") == "N", "mooe").otherwise("co")
    items = table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.year("l_shipdate").alias("fiscal_year"),
        source.alias("budget"),
        klass.alias("class"),
        cents.alias("allotment"),
        (cents * (100 - discount) * (100 + tax)).alias("obligations"),
    ).withColumn("obligations", F.expr("obligations div 10000"))
    sums = [
        F.expr(f"sum(if(budget = '{b}' and class = '{c}', {m}, 0L)) AS {m}_{b}_{c}")
        for m in MEASURES[:2]
        for b in ["f1", "f2", "f3", "o"]
        for c in CLASSES[:3]
    ]
    return items.groupBy("l_suppkey", "fiscal_year").agg(*sums)


def _printed(amount: Column, indent: Column) -> Column:
    """Amount as the statements print it: dash for zero, two ways to write a negative."""
    digits = F.format_number(F.abs(amount), 0)
    negative = F.when(indent == 0, F.concat(F.lit("("), digits, F.lit(")"))).otherwise(F.concat(F.lit("-"), digits))
    return F.when(amount == 0, "- ").when(amount < 0, negative).otherwise(F.concat(digits, F.lit(" ")))


def _cell(text: Column) -> Column:
    return F.concat(F.lit('<td><div align="right">'), text, F.lit("</div></td>\n"))


def _with_total(classes: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.concat(classes, F.array(F.reduce(classes, zero, lambda total, amount: total + amount)))


def _row_html(line: Column) -> Column:
    """One table row from a struct of label, indent, the two measures by class, and the two faults."""
    allotment, obligations = _with_total(line["allotment"]), _with_total(line["obligations"])
    printed = F.transform(allotment, lambda a, i: F.when(i == 3, a + line["error"]).otherwise(a))
    unobligated = F.zip_with(allotment, obligations, lambda a, o: a - o)
    show = lambda cells: F.transform(cells, lambda amount: _printed(amount, line["indent"]))
    spoiled = F.transform(
        show(obligations), lambda cell, i: F.when((i == 2) & line["stray"], F.concat(F.trim(cell), F.lit("- "))).otherwise(cell)
    )
    cells = F.transform(F.concat(show(printed), spoiled, show(unobligated)), _cell)
    rate = F.round(F.try_divide(F.get(obligations, F.lit(3)) * 100, F.get(allotment, F.lit(3))), 2)
    return F.concat(
        F.lit("<tr><td><div>"),
        F.repeat(F.lit("&nbsp;"), line["indent"]),
        line["label"],
        F.lit("</div></td>\n"),
        _cell(_printed(F.get(allotment, F.lit(3)), line["indent"])),
        F.array_join(cells, ""),
        _cell(F.when(rate.isNull(), "&nbsp;").otherwise(F.concat(F.format_number(rate, 2), F.lit("%")))),
        F.lit("</tr>\n"),
    )


def statement_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(file, fiscal_year, quarter, html).

    Suppliers in debt print a wrong allotment total on their first line; rich ones a stray sign in one cell.
    """
    agencies = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    wide = _budget(spark, folder).join(agencies, F.col("l_suppkey") == F.col("s_suppkey"))
    balance = F.round(F.col("s_acctbal") * 100).cast("long")
    linked = F.concat(
        F.lit('<a href="/files/SAOB2013/Final/'), "s_name", F.lit('.pdf"><strong>'), "s_name", F.lit("</strong></a>")
    )

    wide = wide.withColumns({"linked": linked, "fault": F.when(balance < 0, balance).otherwise(F.lit(0).cast("long"))})

    def amounts(measure: str, sources: list[str]) -> str:
        return ", ".join(" + ".join(f"{measure}_{b}_{k}" for b in sources) for k in CLASSES[:3])

    def line(label: str | None, indent: int, sources: list[str]) -> str:
        stray = "s_acctbal > 9000 and obligations_o_co > 0" if label == "Continuing Appropriation" else "false"
        return (
            f"named_struct('label', {'linked' if label is None else repr(label)}, 'indent', {indent}, "
            f"'allotment', array({amounts('allotment', sources)}), 'obligations', array({amounts('obligations', sources)}), "
            f"'error', {'fault' if label is None else '0L'}, 'stray', {stray})"
        )

    year = F.col("fiscal_year")
    head = F.concat(F.format_string(_HEADER, year, year), F.lit(_CLASS_CELLS + _BLANK_ROW))
    body = F.array_join(F.transform("lines", _row_html), "")
    html = F.concat(head, body, F.format_string(_NOTES, *[F.col("s_name")] * 5))
    file = F.format_string("%d_Q4_%d.htm", year, F.col("l_suppkey"))
    lines = F.expr(f"array({', '.join(line(*definition) for definition in LINES)})")
    spread = wide.select("l_suppkey", "s_name", "fiscal_year", lines.alias("lines"))
    pages = add_once(spread, file=file, html=html)
    return pages.select("file", "fiscal_year", F.lit("Q4").alias("quarter"), "html")


# The same statement lines straight from the tables. ``printed`` applies the two deliberate faults.
STATEMENT_SQL = """
leaf AS (
  SELECT l_suppkey AS k, CAST(year(l_shipdate) AS INTEGER) AS fiscal_year,
    CASE WHEN l_linestatus = 'O' THEN 'o' WHEN l_linenumber <= 3 THEN 'f1' WHEN l_linenumber <= 5 THEN 'f2' ELSE 'f3' END AS b,
    CASE l_returnflag WHEN 'A' THEN 'ps' WHEN 'N' THEN 'mooe' ELSE 'co' END AS c,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS al,
    (CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))
      * (100 + CAST(round(l_tax * 100) AS BIGINT))) // 10000 AS ob
  FROM lineitem
),
defs(row_no, label, indent, level, parent_off, sources) AS (VALUES
  (5, NULL, 0, 0, NULL, 'f1 f2 f3 o'), (6, 'Current Year Budget', 6, 1, 5, 'f1 f2 f3'),
  (7, 'Agency Specific Budget', 12, 2, 6, 'f1'), (8, 'Special Purpose Funds', 12, 2, 6, 'f2'),
  (9, 'Automatic Appropriation', 12, 2, 6, 'f3'), (10, 'Continuing Appropriation', 5, 1, 5, 'o')
),
sums AS (
  SELECT f.k, f.fiscal_year, d.row_no,
    coalesce(sum(al) FILTER (c = 'ps'), 0) AS al_ps, coalesce(sum(al) FILTER (c = 'mooe'), 0) AS al_mooe,
    coalesce(sum(al) FILTER (c = 'co'), 0) AS al_co, coalesce(sum(al), 0) AS al_total,
    coalesce(sum(ob) FILTER (c = 'ps'), 0) AS ob_ps, coalesce(sum(ob) FILTER (c = 'mooe'), 0) AS ob_mooe,
    coalesce(sum(ob) FILTER (c = 'co'), 0) AS ob_co, coalesce(sum(ob), 0) AS ob_total
  FROM (SELECT DISTINCT k, fiscal_year FROM leaf) f CROSS JOIN defs d
  LEFT JOIN leaf l ON l.k = f.k AND l.fiscal_year = f.fiscal_year AND contains(d.sources, l.b)
  GROUP BY ALL
),
printed AS (
  SELECT fiscal_year || '_Q4_' || s.k || '.htm' AS file, fiscal_year, 'Q4' AS quarter, s.row_no,
    coalesce(label, s_name) AS label, indent, level, parent_off AS parent_row, s_name,
    al_ps, al_mooe, al_co,
    al_total + CASE WHEN s.row_no = 5 AND s_acctbal < 0 THEN CAST(round(s_acctbal * 100) AS BIGINT) ELSE 0 END AS al_total,
    ob_ps, ob_mooe, ob_co, ob_total,
    al_ps - ob_ps AS un_ps, al_mooe - ob_mooe AS un_mooe, al_co - ob_co AS un_co, al_total - ob_total AS un_total,
    al_total AS appropriation,
    CASE WHEN al_total > 0 THEN round(CAST(ob_total AS DOUBLE) * 100 / al_total, 2) END AS rate,
    (s.row_no = 10 AND s_acctbal > 9000 AND ob_co > 0) AS stray
  FROM sums s JOIN defs USING (row_no) JOIN supplier ON s_suppkey = s.k
),
cells AS (
  SELECT p.*, m.measure, m.expense_class,
    CASE m.measure WHEN 'allotment' THEN CASE m.expense_class WHEN 'ps' THEN al_ps WHEN 'mooe' THEN al_mooe WHEN 'co' THEN al_co ELSE al_total END
      WHEN 'obligations' THEN CASE m.expense_class WHEN 'ps' THEN ob_ps WHEN 'mooe' THEN ob_mooe WHEN 'co' THEN ob_co ELSE ob_total END
      ELSE CASE m.expense_class WHEN 'ps' THEN un_ps WHEN 'mooe' THEN un_mooe WHEN 'co' THEN un_co ELSE un_total END END AS n,
    (stray AND m.measure = 'obligations' AND m.expense_class = 'co') AS quarantined
  FROM printed p CROSS JOIN (SELECT unnest(['allotment', 'obligations', 'unobligated']) AS measure) x
  CROSS JOIN (SELECT unnest(['ps', 'mooe', 'co', 'total']) AS expense_class) y
  CROSS JOIN LATERAL (SELECT x.measure, y.expense_class) m
)"""
