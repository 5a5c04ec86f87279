"""Queries over quarterly statements, which are rendered from line items and parsed back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.functions.money import MONEY, parse_amount
from civicledger.functions.text import strip_ws
from civicledger.operators import statements as T
from civicledger.operators.columns import add_once
from civicledger.plans.long_pages import KINDS, LONG_SQL, ORDERS, WRONG, long_pages, places_sql
from civicledger.plans.quarter_pages import QUARTER_SQL, quarter_pages
from civicledger.plans.registry import query
from civicledger.plans.statement_pages import STATEMENT_SQL, statement_pages
from civicledger.sources.tables import table


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return T.with_amounts(T.statement_lines(statement_pages(spark, folder)))


_SHOW = "CASE WHEN {n} = 0 THEN '-' WHEN {n} < 0 AND indent = 0 THEN '(' || format('{{:,}}', -{n}) || ')' ELSE format('{{:,}}', {n}) END"
_CELLS = [f"{m}_{k}" for m in ("al", "ob", "un") for k in ("ps", "mooe", "co", "total")]
_ROW_TEXT = " || '|' || ".join(
    ["label", _SHOW.format(n="appropriation")]
    + [(_SHOW.format(n=c) + (" || CASE WHEN stray THEN '-' ELSE '' END" if c == "ob_co" else "")) for c in _CELLS]
    + ["coalesce(format('{:.2f}%', rate), '')"]
)


@query(
    "html_table_rows",
    f"""WITH {STATEMENT_SQL}, doc AS (SELECT DISTINCT file, fiscal_year, s_name FROM printed)
SELECT file, CAST(row_no AS INTEGER) AS row_no, 15 AS n_cells, {_ROW_TEXT} AS text FROM printed
UNION ALL SELECT file, 0, 1, 'Budget execution by object, final figures as of December 31, ' || fiscal_year || ', in thousand pesos' FROM doc
UNION ALL SELECT file, 1, 3, 'PARTICULARS|Full-year ' || fiscal_year || ' appropriations|OBLIGATION RATE' FROM doc
UNION ALL SELECT file, 2, 3, 'Released|Spent|Left' FROM doc
UNION ALL SELECT file, 3, 12, 'PS|MOOE|CO|Total|PS|MOOE|CO|Total|PS|MOOE|CO|Total' FROM doc
UNION ALL SELECT file, 4, 15, repeat('|', 14) FROM doc
UNION ALL SELECT file, 11, 1, 'Notes:' FROM doc
UNION ALL SELECT file, 12, 1, '1) Figures come from the agencies; 98% reported.' FROM doc
UNION ALL SELECT file, 13, 1, '2) Except ' || s_name || ' Office, ' || s_name || ' News and Press, and the Council.' FROM doc
UNION ALL SELECT file, 14, 15, '3/ Units without the required SAOB submission are as follows:' || repeat('|', 14) FROM doc
UNION ALL SELECT file, 15, 1, 'First ' || s_name || ' Unit; Second ' || s_name || ' Unit' FROM doc
UNION ALL SELECT file, 16, 1, 'NOTE : EXCEPT ' || s_name || ' Board' FROM doc""",
)
def html_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = T.table_rows(statement_pages(spark, folder))
    text = F.array_join(F.transform("cells", strip_ws), "|")
    return rows.select("file", "row_no", F.size("cells").alias("n_cells"), text.alias("text"))


@query("title_date", f"WITH {STATEMENT_SQL} SELECT DISTINCT file, make_date(fiscal_year, 12, 31) AS as_of, 1000 AS unit, TRUE AS has_appropriation, TRUE AS has_rate FROM printed")
def title_date(spark: SparkSession, folder: str) -> DataFrame:
    titles = T.title_facts(statement_pages(spark, folder))
    return titles.select("file", "as_of", "unit", "has_appropriation", "has_rate")


@query("indent_level", f"WITH {STATEMENT_SQL} SELECT file, row_no, label, indent, level FROM printed")
def indent_level(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder).select("file", "row_no", "label", "indent", "level")


@query("row_parent", f"WITH {STATEMENT_SQL} SELECT file, row_no, label, level, parent_row FROM printed")
def row_parent(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder).select("file", "row_no", "label", "level", "parent_row")


@query(
    "unpivot_measures",
    f"""WITH {STATEMENT_SQL}
SELECT file, fiscal_year, quarter, make_date(fiscal_year, 12, 31) AS as_of, 'A' AS section, row_no, label, level, measure, expense_class,
  CASE WHEN quarantined THEN NULL ELSE CAST(n * 1000 AS DECIMAL(20, 2)) END AS amount, quarantined
FROM cells""",
)
def unpivot_measures(spark: SparkSession, folder: str) -> DataFrame:
    facts = T.long_facts(_lines(spark, folder))
    return facts.select(
        "file", "fiscal_year", "quarter", "as_of", "section", "row_no", "label", "level", "measure", "expense_class",
        F.col("amount").cast(MONEY).alias("amount"), "quarantined",
    )


@query(
    "footnote_explode",
    f"""WITH {STATEMENT_SQL}, doc AS (SELECT DISTINCT file, s_name FROM printed)
SELECT file, 2 AS note_no, unnest([s_name || ' Office', s_name || ' News and Press', 'the Council']) AS name FROM doc
UNION ALL SELECT file, 3, unnest(['First ' || s_name || ' Unit', 'Second ' || s_name || ' Unit']) FROM doc
UNION ALL SELECT file, NULL, s_name || ' Board' FROM doc""",
)
def footnote_explode(spark: SparkSession, folder: str) -> DataFrame:
    notes = T.footnotes(statement_pages(spark, folder).select("file", "html"))
    return T.listed_names(notes).select("file", "note_no", "name")


# Notes by the supplier's remainder, with the names they list and the share they report. Names that statements use.
_NOTE_FORMS = [
    ("EXCEPT {n} COMMISSION and the following SUCs: {n} University, {n} Academy and {n} College of Arts and Trades", ["{n} COMMISSION", "{n} University", "{n} Academy", "{n} College of Arts and Trades"], None),
    ("For units without a report, as follows: Bureau of {n} and Securities and Exchange Commission, News and {n} Bureau and {n} Agency", ["Bureau of {n}", "Securities and Exchange Commission", "News and {n} Bureau", "{n} Agency"], None),
    ("Compliance on the requirement is 97.5%. Those without submission are the following : SUCs (A-{n}, B-{n} and CD-{n})", ["A-{n}", "B-{n}", "CD-{n}"], "97.5"),
    ("The average rate is 25% of the releases; 57% have been used by units that submitted.", [], None),
    ("Except Supreme Court of {n} and the Lower Courts, Office of {n} and Press, {n} Tribunal.", ["Supreme Court of {n} and the Lower Courts", "Office of {n} and Press", "{n} Tribunal"], None),
    ("So far 80 % of the agencies have submitted.", [], "80"),
]


def _form_notes(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    form = F.get(F.array(*[F.lit(text) for text, _, _ in _NOTE_FORMS]), (F.col("s_suppkey") % len(_NOTE_FORMS)).cast("int"))
    known = F.array(F.lower(F.concat(F.lit("Office of "), "s_name", F.lit(" and Press"))))
    return supplier.select("s_suppkey", F.replace(form, F.lit("{n}"), F.col("s_name")).alias("text"), known.alias("known"))


_FORM_NAMES_SQL = ", ".join(f"({i}, '{n}')" for i, (_, names, _) in enumerate(_NOTE_FORMS) for n in names)


@query("note_names", f"SELECT s_suppkey, replace(name, '{{n}}', s_name) AS name FROM supplier JOIN (VALUES {_FORM_NAMES_SQL}) AS f(form, name) ON form = s_suppkey % {len(_NOTE_FORMS)}")
def note_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names in lists that hold further lead-ins, prefixes, and "and" inside and between names."""
    return T.listed_names(_form_notes(spark, folder), known="known")


@query("note_shares", f"SELECT s_suppkey, CAST(CASE s_suppkey % {len(_NOTE_FORMS)} WHEN 2 THEN 97.5 ELSE 80 END AS DECIMAL(9, 2)) AS reported_pct FROM supplier WHERE s_suppkey % {len(_NOTE_FORMS)} IN (2, 5)")
def note_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Only percentages of compliance, not rates or other shares."""
    return T.reported_share(_form_notes(spark, folder).drop("known"))


@query("reported_share", f"WITH {STATEMENT_SQL} SELECT DISTINCT file, 1 AS note_no, CAST(98 AS DECIMAL(9, 2)) AS reported_pct FROM printed")
def reported_share(spark: SparkSession, folder: str) -> DataFrame:
    notes = T.footnotes(statement_pages(spark, folder).select("file", "html"))
    return T.reported_share(notes).select("file", "note_no", "reported_pct")


@query(
    "identity_sum",
    f"""WITH {STATEMENT_SQL}, d AS (
SELECT file, row_no, 'allotment' AS measure, al_ps + al_mooe + al_co - al_total AS difference FROM printed
UNION ALL SELECT file, row_no, 'obligations', ob_ps + ob_mooe + ob_co - ob_total FROM printed WHERE NOT stray
UNION ALL SELECT file, row_no, 'unobligated', un_ps + un_mooe + un_co - un_total FROM printed)
SELECT file, row_no, measure, CAST(difference AS BIGINT) AS difference FROM d WHERE abs(difference) > 2""",
)
def identity_sum(spark: SparkSession, folder: str) -> DataFrame:
    broken = T.class_identity(_lines(spark, folder))
    return broken.select("file", "row_no", "measure", F.col("difference").cast("long").alias("difference"))


@query(
    "identity_balance",
    f"""WITH {STATEMENT_SQL}
SELECT file, row_no, 'total' AS expense_class, CAST(al_total - ob_total - un_total AS BIGINT) AS difference
FROM printed WHERE abs(al_total - ob_total - un_total) > 2""",
)
def identity_balance(spark: SparkSession, folder: str) -> DataFrame:
    broken = T.balance_identity(_lines(spark, folder))
    return broken.select("file", "row_no", "expense_class", F.col("difference").cast("long").alias("difference"))


@query(
    "identity_parent",
    f"""WITH {STATEMENT_SQL}, readable AS (SELECT file, row_no, parent_row, measure, expense_class, CASE WHEN NOT quarantined THEN n * 1000 END AS n FROM cells),
children AS (SELECT file, parent_row, measure, expense_class, sum(n) AS total, count(*) AS n_children, count(*) - count(n) AS n_unreadable FROM readable WHERE parent_row IS NOT NULL GROUP BY ALL),
judged AS (
  SELECT p.file, p.row_no, p.measure, p.expense_class, c.n_children, c.n_unreadable + CASE WHEN p.n IS NULL THEN 1 ELSE 0 END AS n_unreadable, p.n - c.total AS gap
  FROM readable p JOIN children c ON c.file = p.file AND c.parent_row = p.row_no AND c.measure = p.measure AND c.expense_class = p.expense_class)
SELECT file, row_no, measure, expense_class, CASE WHEN n_unreadable = 0 THEN CAST(gap AS DECIMAL(20, 2)) END AS difference, n_children, CAST(n_unreadable AS BIGINT) AS n_unreadable
FROM judged WHERE n_unreadable > 0 OR gap <> 0""",
)
def identity_parent(spark: SparkSession, folder: str) -> DataFrame:
    facts = T.long_facts(_lines(spark, folder))
    broken = T.parent_identity(facts)
    return broken.select(
        "file", "row_no", "measure", "expense_class", F.col("difference").cast(MONEY).alias("difference"), "n_children", "n_unreadable"
    )


@query(
    "identity_rate",
    f"""WITH {STATEMENT_SQL}
SELECT file, row_no, label, CAST(rate AS DECIMAL(9, 2)) AS published_rate,
  CAST(round(100.0 * CAST(ob_total AS DOUBLE) / al_total, 2) AS DECIMAL(18, 2)) AS recomputed_rate
FROM printed
WHERE al_total <> 0 AND abs(CAST(rate AS DECIMAL(18, 2)) - CAST(round(100.0 * CAST(ob_total AS DOUBLE) / al_total, 2) AS DECIMAL(18, 2))) > 0.01""",
)
def identity_rate(spark: SparkSession, folder: str) -> DataFrame:
    broken = T.rate_identity(_lines(spark, folder))
    return broken.select("file", "row_no", "label", F.col("published_rate").cast("decimal(9,2)").alias("published_rate"), "recomputed_rate")


@query(
    "repaired_cells",
    f"WITH {STATEMENT_SQL} SELECT file, row_no, 'obligations.co' AS cell, CAST(ob_co AS BIGINT) AS amount FROM printed WHERE stray",
)
def repaired_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Unreadable cells that both identities determine."""
    repaired = T.repaired_amounts(_lines(spark, folder)).where(F.size("repaired") > 0)
    obligations_co = F.get("amounts", F.lit(6)).cast("long")
    return repaired.select("file", "row_no", F.array_join("repaired", ",").alias("cell"), obligations_co.alias("amount"))


_STYLES = 12


@query(
    "numeric_clean",
    """
WITH c AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS n, l_orderkey % 12 AS style FROM lineitem)
SELECT l_orderkey, l_linenumber, n AS cents,
  CAST(CASE WHEN style IN (1, 2) THEN -n WHEN style IN (3, 4, 5) THEN 0 WHEN style >= 6 AND style <= 9 THEN NULL ELSE n END AS DECIMAL(20, 0)) AS amount,
  (style >= 6 AND style <= 9) AS quarantined
FROM c""",
)
def numeric_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Prices printed in every way that the statements use, and read back."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents")
    )
    plain = F.format_number("cents", 0)
    styles = [
        plain,
        F.concat(F.lit("("), plain, F.lit(") ")),
        F.concat(F.lit(" -"), plain),
        F.lit("-"),
        F.lit(" "),
        F.lit("- -"),
        F.concat(plain, F.lit(",")),
        F.concat(plain, F.lit("-")),
        F.concat(F.lit("< "), plain),
        F.regexp_replace(plain, ",", ",,"),
        F.concat(F.lit(" "), plain, F.lit(" ")),
        F.col("cents").cast("string"),
    ]
    raw = F.get(F.array(*styles), (F.col("l_orderkey") % _STYLES).cast("int"))
    read = add_once(add_once(items, cell=strip_ws(raw)), amount=parse_amount(F.col("cell"), "decimal(20,0)"))
    return read.select("l_orderkey", "l_linenumber", "cents", "amount", F.col("amount").isNull().alias("quarantined"))


# ---------------------------------------------------------------- all layouts, quarter by quarter


@query(
    "statement_sections",
    f"""WITH {QUARTER_SQL}, doc AS (SELECT DISTINCT agency, year, quarter FROM ytd),
defs(row_no, label, section, level, parent_row) AS (VALUES (4, NULL, 'A', 0, NULL), (5, 'Agency Specific Budget', 'A', 1, 4),
  (6, 'Continuing Appropriation', 'A', 1, 4), (7, 'SUB-TOTAL, NGAs', 'subtotal', 0, NULL), (8, 'B. Corporations', 'B', 0, NULL), (9, 'GRAND TOTAL', 'grand_total', 0, NULL)),
al AS (SELECT agency, year, quarter, sum(CAST(f AS BIGINT)) AS f, sum(CAST(o AS BIGINT)) AS o FROM ytd GROUP BY ALL)
SELECT year || '_Q' || quarter || '_' || agency || '.htm' AS file, row_no, coalesce(label, 'Office ' || agency) AS label, section, level, parent_row,
  (row_no = 6 AND agency = 7) AS irregular, make_date(year, quarter * 3, CASE WHEN quarter IN (1, 4) THEN 31 ELSE 30 END) AS as_of,
  CASE WHEN row_no = 6 THEN CASE WHEN agency <> 7 THEN CAST(0 AS DECIMAL(20, 2)) END WHEN row_no < 8 THEN CAST(f * 1000 AS DECIMAL(20, 2))
    WHEN row_no = 8 THEN CAST(o * 1000 AS DECIMAL(20, 2)) ELSE CAST((f + o) * 1000 AS DECIMAL(20, 2)) END AS allotment
FROM doc JOIN al USING (agency, year, quarter), defs""",
)
def statement_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all layouts with their sections, parents and total allotment."""
    lines = T.with_amounts(T.statement_lines(quarter_pages(spark, folder)))
    total = (F.get("amounts", F.lit(3)) * F.col("unit")).cast(MONEY)
    return lines.select("file", "row_no", "label", "section", "level", "parent_row", "irregular", "as_of", total.alias("allotment"))


@query(
    "statement_trend",
    f"""WITH {QUARTER_SQL}, b AS (
  SELECT agency, year, quarter, c AS expense_class, CAST(f AS BIGINT) AS al, CAST(f AS BIGINT) * 9 // 10 AS ob FROM ytd
), t AS (SELECT * FROM b UNION ALL SELECT agency, year, quarter, 'total', CAST(sum(al) AS BIGINT), CAST(sum(ob) AS BIGINT) FROM b GROUP BY ALL),
m AS (SELECT agency, year, quarter, expense_class, 'allotment' AS measure, al AS n FROM t UNION ALL SELECT agency, year, quarter, expense_class, 'obligations', ob FROM t
  UNION ALL SELECT agency, year, quarter, expense_class, 'unobligated', al - ob FROM t)
SELECT agency, measure, expense_class, year, quarter, CAST(1000 * (n - lag(n, 1, 0) OVER (PARTITION BY agency, measure, expense_class, year ORDER BY quarter)) AS DECIMAL(20, 2)) AS flow FROM m""",
)
def statement_trend(spark: SparkSession, folder: str) -> DataFrame:
    """What each quarter added to the comparable total, from statements that accumulate over the year."""
    lines = T.with_amounts(T.statement_lines(quarter_pages(spark, folder)))
    flows = T.quarterly_flows(T.long_facts(T.trend_scope(lines)), ["agency"])
    return flows.select("agency", "measure", "expense_class", "year", "quarter", F.col("flow").cast(MONEY).alias("flow"))


# ---------------------------------------------------------------- long pages, columns in any order


@query(
    "header_columns",
    f"""WITH {LONG_SQL}, places(layout, measure, expense_class, place) AS (VALUES {places_sql()}),
doc AS (SELECT DISTINCT file, year FROM printed)
SELECT file, measure, nullif(expense_class, '') AS expense_class, CAST(place AS INTEGER) AS place FROM doc JOIN places ON layout = year % {len(ORDERS)}""",
)
def header_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Where each measure and class, the appropriation and the rate stand, by the grid of the header."""
    places = T.header_places(long_pages(spark, folder).select("file", "html")).select("file", "places")
    name = lambda values: F.array(*[F.lit(v) for v in values])
    own = lambda m: F.struct(F.lit(m).alias("measure"), F.lit(None).cast("string").alias("expense_class"), F.col(f"places.{m}").alias("place"))
    amounts = F.transform("places.amounts", lambda at, i: F.struct(F.get(name(T.MEASURES), F.floor(i / 4).cast("int")).alias("measure"), F.get(name(T.CLASSES), i % 4).alias("expense_class"), at.alias("place")))
    return places.select("file", F.inline(F.concat(amounts, F.array(own("appropriation"), own("rate"))))).where("place IS NOT NULL")


@query(
    "long_statements",
    f"""WITH {LONG_SQL}, a AS (SELECT *, ps + mooe + co AS total, year % {len(ORDERS)} AS layout FROM printed)
SELECT file, row_no, label, level, parent_row, CAST(total AS DECIMAL(20, 0)) AS allotment, CAST(ob_mooe AS DECIMAL(20, 0)) AS spent_mooe,
  CAST(total - ob_ps - ob_mooe - ob_co AS DECIMAL(20, 0)) AS unobligated, CAST(CASE WHEN layout IN (1, 3) THEN ps END AS DECIMAL(20, 0)) AS appropriation,
  CAST(CASE WHEN layout > 0 THEN k % 100 + 0.5 END AS DECIMAL(9, 2)) AS published_rate FROM a""",
)
def long_statements(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of hundreds of lines, with columns in any order."""
    lines = T.with_amounts(T.statement_lines(long_pages(spark, folder).select("file", "html")))
    amount = lambda i: F.get("amounts", F.lit(i)).cast("decimal(20,0)")
    return lines.select(
        "file", "row_no", "label", "level", "parent_row", amount(3).alias("allotment"), amount(5).alias("spent_mooe"), amount(11).alias("unobligated"),
        F.col("appropriation").cast("decimal(20,0)").alias("appropriation"), F.col("published_rate").cast("decimal(9,2)").alias("published_rate"),
    )


@query(
    "solved_amounts",
    f"""WITH {LONG_SQL}, a AS (SELECT *, ps + mooe + co AS total, k % {KINDS} AS kind FROM printed)
SELECT file, row_no, CASE WHEN kind = 1 AND off = 1 THEN 'allotment.ps,allotment.mooe' WHEN kind = 2 AND off < 2 THEN 'allotment.total'
    WHEN kind = 4 AND off = 2 THEN 'allotment.co,obligations.co,unobligated.co' ELSE '' END AS solved,
  CASE WHEN kind = {WRONG} AND off = 2 THEN 'obligations.ps' ELSE '' END AS conflicts,
  CAST(ps AS DECIMAL(20, 0)) AS ps, CAST(mooe AS DECIMAL(20, 0)) AS mooe, CAST(co AS DECIMAL(20, 0)) AS co, CAST(total AS DECIMAL(20, 0)) AS total,
  CAST(CASE WHEN kind <> {WRONG} OR off < 2 THEN ob_ps END AS DECIMAL(20, 0)) AS spent_ps, CAST(ob_co AS DECIMAL(20, 0)) AS spent_co
FROM a WHERE kind IN (1, 2, 3, 4)""",
)
def solved_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Unreadable amounts, several in one equation among them, that the equations of a page determine twice."""
    lines = T.with_amounts(T.statement_lines(long_pages(spark, folder, spoilt=True).select("file", "html")))
    kind = F.regexp_extract("office", "([0-9]+)$", 1).cast("int") % KINDS
    parents = lines.where("level = 0").select("file", F.col("row_no").alias("parent"), F.col("label").alias("office"))
    wanted = T.solved_amounts(lines).join(parents, ["file"]).where(F.coalesce("parent_row", "row_no") == F.col("parent")).where(kind.between(1, 4))
    amount = lambda i: F.get("amounts", F.lit(i)).cast("decimal(20,0)")
    return wanted.select(
        "file", "row_no", F.array_join("solved", ",").alias("solved"), F.array_join("conflicts", ",").alias("conflicts"),
        amount(0).alias("ps"), amount(1).alias("mooe"), amount(2).alias("co"), amount(3).alias("total"), amount(4).alias("spent_ps"), amount(6).alias("spent_co"),
    )
