"""Long statements in four column orders, rendered from line items: a page per year and block of suppliers.

Years take turns with the orders: amounts alone, with an appropriation and a rate, with a rate, and one that no official
statement has: rate first, blocks of measures swapped, the appropriation last. Headers are proper grids. A supplier has
three lines, so a page has up to ``3 * BLOCK``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.operators.columns import add_once
from civicledger.operators.statements import CLASSES, MEASURES
from civicledger.plans.statement_pages import _cell, _printed, _with_total
from civicledger.sources.tables import table

BLOCK = 170
HEADER_ROWS = 4
# Header texts that the parser looks for, and the columns of each order: a measure stands for its four classes.
_TEXTS = {"allotment": "ALLOTMENT", "obligations": "OBLIGATIONS<br> INCURRED", "unobligated": "UNOBLIGATED\n BALANCES", "appropriation": "Adjusted<br>Appros", "rate": "OBLIGATION RATE (In %)"}
ORDERS = [
    [*MEASURES],
    ["appropriation", *MEASURES, "rate"],
    [*MEASURES, "rate"],
    ["rate", "unobligated", "allotment", "obligations", "appropriation"],
]


def _header(order: list[str]) -> str:
    single = lambda c: f"<td width='9' rowspan=\"3\"><b>{_TEXTS[c]}</b>&nbsp;</td>"
    blocks = [c for c in order if c in MEASURES]
    top, done = [], False
    for c in order:
        if c not in MEASURES:
            top.append(single(c))
        elif not done:
            top.append("<td colspan='12'>so far</td>")
            done = True
    middle = "".join(f"<td colspan=4>{_TEXTS[c]}</td>" for c in blocks)
    low = "".join(f"<td>{c}</td>" for c in ["PS", "MOOE", "CO", "Total"]) * len(blocks)
    return f"<tr><td rowspan=3>PARTICULARS</td>{''.join(top)}</tr>\n<tr>{middle}</tr>\n<tr>{low}</tr>\n"


def _spent(allotment: Column) -> Column:
    return F.transform(allotment, lambda a: F.floor(a * 9 / 10).cast("long"))


def _row(label: Column, indent: int, allotment: Column, spent: Column, spoilt: Column, wrong: Column) -> Column:
    """A table row; ``spoilt`` lists the amounts (by measure and class) that get a stray comma, ``wrong`` is added to the
    unobligated balance of the first class."""
    al, ob = _with_total(allotment), _with_total(spent)
    left = F.transform(F.zip_with(al, ob, lambda a, o: a - o), lambda u, i: F.when(i == 0, u + wrong).otherwise(u))
    block = {}
    for m, amounts in enumerate([al, ob, left]):
        printed = F.transform(amounts, lambda amount: _printed(amount, F.lit(indent)))
        block[MEASURES[m]] = F.array_join(F.transform(printed, _stray(spoilt, 4 * m)), "")
    block["appropriation"] = _cell(_printed(F.get(al, F.lit(0)), F.lit(indent)))
    block["rate"] = _cell(F.concat((F.col("s_suppkey") % 100).cast("string"), F.lit(".50%")))
    kinds = F.array(*[F.concat(*[block[c] for c in order]) for order in ORDERS])
    name = F.concat(F.lit("<tr><td>" + "&nbsp;" * indent), label, F.lit("</td>"))
    return F.concat(name, F.get(kinds, F.col("layout")), F.lit("</tr>\n"))


def _stray(spoilt: Column, first: int):
    return lambda text, i: _cell(F.when(F.array_contains(spoilt, i + first), F.concat(F.trim(text), F.lit(","))).otherwise(text))


#: What is unreadable on spoilt pages, by the supplier's remainder: (line, amounts by measure and class).
SPOILT = {1: [(1, [0, 1])], 2: [(0, [3]), (1, [3])], 3: [(2, [4])], 4: [(2, [2, 6, 10])]}
KINDS = 6
#: The supplier's remainder whose third line has a wrong balance, so that equations contradict each other.
WRONG = 3


def long_pages(spark: SparkSession, folder: str, spoilt: bool = False) -> DataFrame:
    """(file, fiscal_year, quarter, html); ``spoilt`` makes the cells of ``SPOILT`` unreadable."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    klass = F.when(F.col("l_returnflag") == "A", "ps").when(F.col("l_returnflag") == "N", "mooe").otherwise("co")
    items = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year"), F.lower("l_linestatus").alias("s"), klass.alias("class"), cents.alias("cents"))
    sums = [F.sum(F.when((F.col("s") == s) & (F.col("class") == c), F.col("cents")).otherwise(0)).alias(f"{s}_{c}") for s in "fo" for c in CLASSES[:3]]
    wide = items.groupBy("s_suppkey", "year").agg(*sums).withColumn("layout", (F.col("year") % len(ORDERS)).cast("int"))
    one, two = (F.array(*[f"{s}_{c}" for c in CLASSES[:3]]) for s in "fo")
    office = F.concat(F.lit("Office "), F.col("s_suppkey").cast("string"))
    kind = F.col("s_suppkey") % KINDS
    none = F.array().cast("array<int>")

    def strays(line: int) -> Column:
        cells = none
        for remainder, faults in SPOILT.items():
            for at, amounts in faults:
                if at == line:
                    cells = F.when(kind == remainder, F.array(*[F.lit(c) for c in amounts])).otherwise(cells)
        return cells if spoilt else none

    both = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    wrong = F.when((kind == WRONG) & F.lit(spoilt), 1).otherwise(0)
    lines = F.concat(
        _row(office, 0, both(one, two), both(_spent(one), _spent(two)), strays(0), F.lit(0)),
        _row(F.lit("Current Year Budget"), 6, one, _spent(one), strays(1), F.lit(0)),
        _row(F.lit("Continuing Appropriation"), 5, two, _spent(two), strays(2), wrong),
    )
    block = F.floor(F.col("s_suppkey") / BLOCK).cast("int")
    pages = add_once(wide, lines=lines, block=block).groupBy("year", "layout", "block").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "lines"))).alias("parts"))
    body = F.array_join(F.transform("parts", lambda p: p["lines"]), "")
    title = F.concat(F.lit("<table><tr><th colspan=15>Budget execution as of December 31, "), F.col("year").cast("string"), F.lit(", in thousand pesos</th></tr>\n"))
    head = F.get(F.array(*[F.lit(_header(order)) for order in ORDERS]), F.col("layout"))
    file = F.format_string("%d_Q4_block%d.htm", "year", "block")
    return pages.select(file.alias("file"), F.col("year").alias("fiscal_year"), F.lit("Q4").alias("quarter"), F.concat(title, head, body, F.lit("</table>")).alias("html"))


# The same lines straight from the tables, and the column of every measure and class in each order.
LONG_SQL = f"""
leaf AS (
  SELECT l_suppkey AS k, CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus AS s,
    CASE l_returnflag WHEN 'A' THEN 'ps' WHEN 'N' THEN 'mooe' ELSE 'co' END AS c, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem
), parts(off, label, level, s) AS (VALUES (0, NULL, 0, 'FO'), (1, 'Current Year Budget', 1, 'F'), (2, 'Continuing Appropriation', 1, 'O')),
ranked AS (
  SELECT k, year, k // {BLOCK} AS block, row_number() OVER (PARTITION BY year, k // {BLOCK} ORDER BY k) - 1 AS place FROM (SELECT DISTINCT k, year FROM leaf)
), sums AS (
  SELECT k, year, s, coalesce(sum(cents) FILTER (c = 'ps'), 0) AS ps, coalesce(sum(cents) FILTER (c = 'mooe'), 0) AS mooe, coalesce(sum(cents) FILTER (c = 'co'), 0) AS co
  FROM leaf GROUP BY ALL
), printed AS (
  SELECT r.year || '_Q4_block' || block || '.htm' AS file, r.year, r.k, off, CAST({HEADER_ROWS} + 3 * place + off AS INTEGER) AS row_no, coalesce(label, 'Office ' || r.k) AS label, level,
    CAST(CASE WHEN level = 1 THEN {HEADER_ROWS} + 3 * place END AS INTEGER) AS parent_row, coalesce(sum(ps), 0) AS ps, coalesce(sum(mooe), 0) AS mooe, coalesce(sum(co), 0) AS co,
    coalesce(sum(ps * 9 // 10), 0) AS ob_ps, coalesce(sum(mooe * 9 // 10), 0) AS ob_mooe, coalesce(sum(co * 9 // 10), 0) AS ob_co
  FROM ranked AS r CROSS JOIN parts LEFT JOIN sums AS l ON l.k = r.k AND l.year = r.year AND contains(parts.s, l.s) GROUP BY ALL
)"""


def places_sql() -> str:
    """Rows (layout, measure, expense_class, place) of every order."""
    rows = []
    for layout, order in enumerate(ORDERS):
        at = 1
        for c in order:
            for k in CLASSES if c in MEASURES else [""]:
                rows.append(f"({layout}, '{c}', '{k}', {at})")
                at += 1
    return ", ".join(rows)
