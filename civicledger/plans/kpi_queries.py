"""Queries over money: balances, merges, rates, subtotals, trends and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.functions.money import MONEY, exact
from civicledger.operators import balance as B
from civicledger.operators import crosswalk as C
from civicledger.operators import periods as P
from civicledger.operators import segments as G
from civicledger.plans import standins as S
from civicledger.plans.registry import query
from civicledger.session import scratch_dir
from civicledger.sources.processed import read_processed, write_changed, write_processed
from civicledger.sources.registry import SourceRegistry
from civicledger.sources.tables import table


def price() -> Column:
    return exact(F.col("l_extendedprice"))


def net() -> Column:
    return price() * (1 - exact(F.col("l_discount"), "decimal(4,2)"))


def tax() -> Column:
    return price() * exact(F.col("l_tax"), "decimal(4,2)")


def total() -> Column:
    return exact(F.col("o_totalprice"))


PRICE_SQL = "CAST(l_extendedprice AS DECIMAL(12, 2))"
NET_SQL = f"{PRICE_SQL} * (1 - CAST(l_discount AS DECIMAL(4, 2)))"
TAX_SQL = f"{PRICE_SQL} * CAST(l_tax AS DECIMAL(4, 2))"


def _regions(spark: SparkSession, folder: str) -> DataFrame:
    """(nationkey, nation, region): the crosswalk from district to region."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )


def _agencies(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return supplier.join(_regions(spark, folder), F.col("s_nationkey") == F.col("nationkey"))


def _taxpayers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return customer.join(_regions(spark, folder), F.col("c_nationkey") == F.col("nationkey"))


def _spent(spark: SparkSession, folder: str, by: list[Column], **amounts: Column) -> DataFrame:
    """Sums per agency and ``by``, then the agency's place; facts shrink before they meet the agencies."""
    sums = [F.sum(amount).alias(name) for name, amount in amounts.items()]
    per_agency = table(spark, folder, "lineitem").groupBy("l_suppkey", *by).agg(*sums)
    return per_agency.join(_agencies(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))


def _collected(spark: SparkSession, folder: str, *by: Column) -> DataFrame:
    """Tax per taxpayer and ``by``, with the taxpayer's place.

    Tax is summed per order before it meets the orders, and per taxpayer before it meets the taxpayers, so
    one very large order or taxpayer is a single row by the time it is joined.
    """
    per_order = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum(tax()).alias("amount"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    per_payer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", *by)
        .agg(F.sum("amount").alias("amount"))
    )
    return per_payer.join(_taxpayers(spark, folder), F.col("o_custkey") == F.col("c_custkey"))


COLLECTED_SQL = f"""
collected AS (
  SELECT r_name AS region, n_name AS nation, year(o_orderdate) AS year, {TAX_SQL} AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
SPENT_SQL = f"""
spent AS (
  SELECT r_name AS region, n_name AS nation, s_name AS agency, s_suppkey, year(l_shipdate) AS year,
    quarter(l_shipdate) AS quarter, l_returnflag, l_linestatus, {PRICE_SQL} AS price, {NET_SQL} AS net
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


@query(
    "region_balance",
    f"""
WITH {COLLECTED_SQL}, {SPENT_SQL},
c AS (SELECT region, sum(amount) AS collected FROM collected GROUP BY region),
s AS (SELECT region, sum(price) AS spent FROM spent GROUP BY region),
j AS (
  SELECT region, CAST(collected AS DECIMAL(38, 4)) AS collected, CAST(spent AS DECIMAL(38, 4)) AS spent,
    CAST(collected AS DOUBLE) / CAST(sum(collected) OVER () AS DOUBLE) AS cs,
    CAST(spent AS DOUBLE) / CAST(sum(spent) OVER () AS DOUBLE) AS ss
  FROM c FULL JOIN s USING (region)
)
SELECT region, collected, spent, round(cs, 6) AS collected_share, round(ss, 6) AS spent_share,
  round(ss / cs, 4) AS ratio, round(ss - cs, 6) AS gap
FROM j""",
)
def region_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Are taxes collected from a region spent there in proportion?"""
    spent = _spent(spark, folder, [], amount=price())
    return B.region_balance(_collected(spark, folder), spent)


@query(
    "phase_merge",
    f"""
WITH {COLLECTED_SQL}, {SPENT_SQL},
c AS (SELECT region, year, sum(amount) AS collected FROM collected GROUP BY ALL),
a AS (SELECT region, year, sum(price) AS authorised FROM spent GROUP BY ALL),
s AS (SELECT region, year, sum(net) AS spent FROM spent WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT region, CAST(year AS INTEGER) AS year, CAST(collected AS DECIMAL(20, 2)) AS collected,
  CAST(authorised AS DECIMAL(20, 2)) AS authorised, CAST(spent AS DECIMAL(20, 2)) AS spent
FROM c FULL JOIN a USING (region, year) FULL JOIN s USING (region, year)""",
)
def phase_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _phases(spark, folder, "region")


@query(
    "phase_merge_department",
    f"""
WITH {COLLECTED_SQL}, {SPENT_SQL},
c AS (SELECT nation, year, sum(amount) AS collected FROM collected GROUP BY ALL),
a AS (SELECT nation, year, sum(price) AS authorised FROM spent GROUP BY ALL),
s AS (SELECT nation, year, sum(net) AS spent FROM spent WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT nation, CAST(year AS INTEGER) AS year, CAST(collected AS DECIMAL(20, 2)) AS collected,
  CAST(authorised AS DECIMAL(20, 2)) AS authorised, CAST(spent AS DECIMAL(20, 2)) AS spent
FROM c FULL JOIN a USING (nation, year) FULL JOIN s USING (nation, year)""",
)
def phase_merge_department(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge on the finer key, nations in the role of departments."""
    return _phases(spark, folder, "nation")


def _phases(spark: SparkSession, folder: str, key: str) -> DataFrame:
    year = F.year("l_shipdate").alias("year")
    paid = F.when(F.col("l_linestatus") == "F", net())
    outlays = _spent(spark, folder, [year], authorised=price(), spent=paid)
    collected = _collected(spark, folder, F.year("o_orderdate").alias("year"))
    keys = [key, "year"]
    # Both columns of the same sums become rows, so line items are read once for them and once for collections.
    stacked = outlays.unpivot(keys, ["authorised", "spent"], "phase", "amount").unionByName(
        collected.select(*keys, F.lit("collected").alias("phase"), "amount")
    )
    return B.merge_stacked(stacked, keys, ["collected", "authorised", "spent"])


@query(
    "kpi_cards",
    f"""
WITH {COLLECTED_SQL}, {SPENT_SQL},
y AS (
  SELECT year, CAST(sum(amount) AS DECIMAL(38, 4)) AS collected, NULL::DECIMAL(38, 4) AS authorised, NULL::DECIMAL(38, 4) AS spent FROM (
    SELECT region, year, CAST(sum(amount) AS DECIMAL(20, 2)) AS amount FROM collected GROUP BY ALL) GROUP BY year
  UNION ALL SELECT year, NULL, CAST(sum(a) AS DECIMAL(38, 4)), NULL FROM (SELECT region, year, CAST(sum(price) AS DECIMAL(20, 2)) AS a FROM spent GROUP BY ALL) GROUP BY year
  UNION ALL SELECT year, NULL, NULL, CAST(sum(a) AS DECIMAL(38, 4)) FROM (SELECT region, year, CAST(sum(net) AS DECIMAL(20, 2)) AS a FROM spent WHERE l_linestatus = 'F' GROUP BY ALL) GROUP BY year
), t AS (SELECT CAST(year AS INTEGER) AS period, max(collected) AS collected, max(authorised) AS authorised, max(spent) AS spent FROM y GROUP BY year),
k AS (
  SELECT 'collected' AS kpi, period, collected AS value FROM t UNION ALL SELECT 'authorised', period, authorised FROM t
  UNION ALL SELECT 'spent', period, spent FROM t UNION ALL SELECT 'obligation_rate', period, CAST(round(100 * CAST(spent AS DOUBLE) / CAST(authorised AS DOUBLE), 4) AS DECIMAL(38, 4)) FROM t
  UNION ALL SELECT 'returned_share', period, CAST(round(100 * CAST(spent AS DOUBLE) / CAST(collected AS DOUBLE), 4) AS DECIMAL(38, 4)) FROM t)
SELECT kpi, period, value, round(100 * (CAST(value AS DOUBLE) / CAST(b.v AS DOUBLE) - 1), 4) AS change_pct
FROM k LEFT JOIN (SELECT kpi AS bk, period + 1 AS bp, value AS v FROM k) b ON bk = kpi AND bp = period
WHERE value IS NOT NULL""",
)
def kpi_cards(spark: SparkSession, folder: str) -> DataFrame:
    return B.kpi_cards(phase_merge(spark, folder), "year")


@query(
    "source_registry",
    f"""
WITH {COLLECTED_SQL}, {SPENT_SQL}, facts AS (
  SELECT 'agencies' AS source, 'authorised' AS phase, region, year, sum(price) AS amount FROM spent GROUP BY ALL
  UNION ALL SELECT 'taxes', 'collected', region, year, sum(amount) FROM collected GROUP BY ALL)
SELECT source, phase, region, CAST(year AS INTEGER) AS fiscal_year, CAST(amount AS DECIMAL(20, 2)) AS amount FROM facts""",
)
def source_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Two registered sources loaded through the common fact schema."""
    registry = SourceRegistry()

    @registry.register("taxes")
    def taxes(session: SparkSession, options: dict) -> DataFrame:
        rows = _collected(session, options["folder"], F.year("o_orderdate").alias("fiscal_year"))
        return rows.groupBy("region", "fiscal_year").agg(F.sum("amount").alias("amount")).withColumn("phase", F.lit("collected"))

    @registry.register("agencies")
    def agencies(session: SparkSession, options: dict) -> DataFrame:
        rows = _spent(session, options["folder"], [F.year("l_shipdate").alias("fiscal_year")], amount=price())
        return rows.groupBy("region", "fiscal_year").agg(F.sum("amount").alias("amount")).withColumn("phase", F.lit("authorised"))

    return registry.load(spark, {"folder": folder})


@query(
    "appropriation_scan",
    """
SELECT l_orderkey * 10 + l_linenumber AS id, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS department,
  lpad(CAST(l_suppkey % 1000 AS VARCHAR), 3, '0') AS agency, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS uacs_reg_id,
  CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '6' END AS uacs_exp_cd,
  CAST(l_extendedprice AS DECIMAL(20, 2)) AS amt, CAST(year(l_shipdate) AS BIGINT) AS year
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)
def appropriation_scan(spark: SparkSession, folder: str) -> DataFrame:
    facts = S.appropriations(spark, folder).withColumn("amt", F.col("amt").cast(MONEY))
    return facts.select("id", "department", "agency", "uacs_reg_id", "uacs_exp_cd", "amt", "year")


def _collections(spark: SparkSession, folder: str) -> DataFrame:
    """Long table of collections: month, district (the taxpayer's nation) and revenue type (the return flag)."""
    per_order = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.sum(tax()).alias("amount"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    per_payer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "l_returnflag", F.trunc("o_orderdate", "month").alias("first_day"))
        .agg(F.sum("amount").alias("amount"))
    )
    placed = per_payer.join(_taxpayers(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
    return (
        placed.groupBy(
            F.year("first_day").alias("year"),
            F.month("first_day").alias("month"),
            F.col("nation").alias("district"),
            F.col("l_returnflag").alias("revenue_type"),
        )
        .agg(F.sum("amount").alias("amount"))
        .select(F.lit("monthly").alias("period_type"), "year", "month", "district", "revenue_type", F.col("amount").cast("decimal(22,4)").alias("amount"))
    )


@query(
    "collections_scan",
    f"""
SELECT 'monthly' AS period_type, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  n_name AS district, l_returnflag AS revenue_type, CAST(sum({TAX_SQL}) AS DECIMAL(22, 4)) AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY ALL""",
)
def collections_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _collections(spark, folder)


TOTAL_SQL = "CAST(o_totalprice AS DECIMAL(12, 2))"


@query(
    "month_year_reconcile",
    f"""
WITH o AS (SELECT c_nationkey AS district, year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderstatus, {TOTAL_SQL} AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT district, year, CAST(sum(amount) AS DECIMAL(20, 2)) AS monthly_total, count(DISTINCT month) AS n_months
  FROM o WHERE o_orderstatus <> 'P' GROUP BY ALL),
a AS (SELECT district, year, CAST(sum(amount) AS DECIMAL(20, 2)) AS annual_total FROM o GROUP BY ALL)
SELECT district, CAST(year AS INTEGER) AS year, monthly_total, n_months, annual_total,
  CAST(coalesce(annual_total, 0) - coalesce(monthly_total, 0) AS DECIMAL(20, 2)) AS difference
FROM m FULL JOIN a USING (district, year)""",
)
def month_year_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Posted months against the annual figure, which also covers what is still pending."""
    orders = table(spark, folder, "orders")
    month = F.trunc("o_orderdate", "month").alias("first_day")
    per_payer = orders.groupBy("o_custkey", month).agg(
        F.sum(total()).alias("all_amount"), F.sum(F.when(F.col("o_orderstatus") != "P", total())).alias("posted")
    )
    customer = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("district"))
    placed = (
        per_payer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("district", F.year("first_day").alias("year"), F.month("first_day").alias("month"))
        .agg(F.sum("posted").alias("posted"), F.sum("all_amount").alias("all_amount"))
    )
    months = placed.where(F.col("posted").isNotNull()).withColumn("amount", F.col("posted"))
    years = placed.groupBy("district", "year").agg(F.sum("all_amount").alias("amount"))
    money = [F.col(c).cast(MONEY).alias(c) for c in ("monthly_total", "annual_total", "difference")]
    return P.reconcile(months, years, ["district"]).select("district", "year", "n_months", *money)


@query(
    "hierarchy_rollup",
    f"""
WITH {SPENT_SQL}
SELECT region, nation, agency, CAST(sum(price) AS DECIMAL(20, 2)) AS amount,
  CAST(3 - (grouping(region) + grouping(nation) + grouping(agency)) AS INTEGER) AS depth
FROM spent GROUP BY ROLLUP (region, nation, agency)""",
)
def hierarchy_rollup(spark: SparkSession, folder: str) -> DataFrame:
    spent = _spent(spark, folder, [], price=price()).withColumnRenamed("s_name", "agency")
    totals = G.hierarchy(spent, ["region", "nation", "agency"], "price")
    return totals.withColumn("amount", F.col("amount").cast(MONEY))


@query(
    "segment_cube",
    f"""
WITH {SPENT_SQL}
SELECT region, l_returnflag AS class, l_linestatus AS phase, CAST(sum(price) AS DECIMAL(20, 2)) AS amount,
  CAST(grouping(region) * 4 + grouping(l_returnflag) * 2 + grouping(l_linestatus) AS INTEGER) AS grouping
FROM spent GROUP BY CUBE (region, l_returnflag, l_linestatus)""",
)
def segment_cube(spark: SparkSession, folder: str) -> DataFrame:
    keys = [F.col("l_returnflag").alias("class"), F.col("l_linestatus").alias("phase")]
    totals = G.cube_totals(_spent(spark, folder, keys, price=price()), ["region", "class", "phase"], "price")
    return totals.withColumn("amount", F.col("amount").cast(MONEY))


@query(
    "subtotal_changes",
    f"""
WITH facts AS (
  SELECT r_name AS region, s_suppkey, l_returnflag AS class, l_linestatus AS phase, l_orderkey % 15 AS k, sum({PRICE_SQL}) AS price
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
), now AS (SELECT region, class, phase, CASE WHEN k % 5 = 1 THEN price + 1 ELSE price END AS price FROM facts WHERE k % 3 <> 2 OR k % 5 = 1)
SELECT region, class, phase, CAST(sum(price) AS DECIMAL(20, 2)) AS amount, count(*) AS n, CAST(grouping(region) * 4 + grouping(class) * 2 + grouping(phase) AS INTEGER) AS grouping
FROM now GROUP BY CUBE (region, class, phase)""",
)
def subtotal_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A cube kept up while facts are replaced and deleted, in two rounds, equals that of the facts that are left."""
    keys = [F.col("l_returnflag").alias("class"), F.col("l_linestatus").alias("phase"), (F.col("l_orderkey") % 15).alias("k")]
    facts = _spent(spark, folder, keys, price=price())
    replaced, dropped = F.col("k") % 5 == 1, (F.col("k") % 3 == 2) & (F.col("k") % 5 != 1)
    signed = lambda df, sign: df.withColumn("sign", F.lit(sign))
    dearer = facts.where(replaced).withColumn("price", (F.col("price") + 1).cast(facts.schema["price"].dataType))
    dimensions = ["region", "class", "phase"]
    cube = G.kept_subtotals(facts, dimensions, "price", cube=True)
    for changes in (signed(facts.where(replaced), -1).unionByName(signed(dearer, 1)), signed(facts.where(dropped), -1)):
        cube = G.changed_subtotals(cube, changes, dimensions, "price", cube=True)
    return cube.select(*dimensions, F.col("amount").cast(MONEY).alias("amount"), "n", "grouping")


@query(
    "class_pivot",
    f"""
WITH {SPENT_SQL}
SELECT nation, CAST(year AS INTEGER) AS year, CAST(sum(price) FILTER (l_returnflag = 'A') AS DECIMAL(20, 2)) AS ps,
  CAST(sum(price) FILTER (l_returnflag = 'N') AS DECIMAL(20, 2)) AS mooe,
  CAST(sum(price) FILTER (l_returnflag = 'R') AS DECIMAL(20, 2)) AS co, CAST(sum(price) AS DECIMAL(20, 2)) AS total
FROM spent GROUP BY ALL""",
)
def class_pivot(spark: SparkSession, folder: str) -> DataFrame:
    keys = [F.col("l_returnflag").alias("class"), F.year("l_shipdate").alias("year")]
    wide = G.pivot_classes(_spent(spark, folder, keys, price=price()), ["nation", "year"], "class", ["A", "N", "R"], "price")
    money = {"A": "ps", "N": "mooe", "R": "co", "total": "total"}
    return wide.select("nation", "year", *[F.col(c).cast(MONEY).alias(name) for c, name in money.items()])


@query(
    "obligation_rate",
    f"""
WITH {SPENT_SQL}, s AS (SELECT nation, CAST(sum(net) AS DECIMAL(22, 4)) AS obligations, CAST(sum(price) AS DECIMAL(20, 2)) AS allotment FROM spent GROUP BY nation)
SELECT nation, obligations, allotment, round(100 * CAST(obligations AS DOUBLE) / CAST(allotment AS DOUBLE), 2) AS obligation_rate FROM s""",
)
def obligation_rate(spark: SparkSession, folder: str) -> DataFrame:
    rates = B.obligation_rate(_spent(spark, folder, [], net=net(), price=price()), ["nation"], "net", "price")
    return rates.withColumn("obligations", F.col("obligations").cast("decimal(22,4)")).withColumn(
        "allotment", F.col("allotment").cast(MONEY)
    )


@query(
    "compliance_rate",
    """
SELECT source, count(*) AS n_agencies, count(l.doc_id) AS n_reported,
  round(100 * CAST(count(l.doc_id) AS DOUBLE) / CAST(count(*) AS DOUBLE), 2) AS compliance_pct
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY source""",
)
def compliance_rate(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source")
    return B.compliance(documents, table(spark, folder, "labels"), "doc_id", ["source"])


@query(
    "regional_estimate",
    f"""
WITH {SPENT_SQL}, w AS (SELECT year, region, CAST(sum(price) AS DOUBLE) AS weight FROM spent GROUP BY ALL),
t AS (SELECT year, CAST(CAST(sum(net) AS DECIMAL(38, 4)) AS DOUBLE) AS amount FROM spent GROUP BY year)
SELECT CAST(year AS INTEGER) AS year, region, round(amount * (weight / sum(weight) OVER (PARTITION BY year)), 0) AS amount, TRUE AS estimated
FROM w JOIN t USING (year)""",
)
def regional_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly spending split over regions by their share of the appropriations."""
    year = F.year("l_shipdate").alias("year")
    sums = _spent(spark, folder, [year], price=price(), net=net())
    by_region = sums.groupBy("year", "region").agg(F.sum("price").alias("weight"), F.sum("net").alias("net"))
    path = scratch_dir(spark, "weights")
    by_region.write.parquet(path)
    weights = spark.read.schema(by_region.schema).parquet(path)
    totals = weights.groupBy("year").agg(F.sum("net").alias("amount"))
    estimate = B.allocate_by_share(totals, weights, "year", "region")
    return estimate.withColumn("amount", F.round(F.col("amount").cast("double"), 0))


# ---------------------------------------------------------------- periods

ORDER_FLOWS_SQL = f"""
flows AS (
  SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
    CAST(sum({TOTAL_SQL}) AS DECIMAL(20, 2)) AS flow
  FROM orders GROUP BY ALL
), cumulative AS (
  SELECT *, CAST(sum(flow) OVER (PARTITION BY entity, year ORDER BY quarter) AS DECIMAL(20, 2)) AS ytd FROM flows
)"""


def _flows(spark: SparkSession, folder: str) -> DataFrame:
    keys = [F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")]
    return table(spark, folder, "orders").groupBy(*keys).agg(F.sum(total()).cast(MONEY).alias("flow"))


@query("flow_to_ytd", f"WITH {ORDER_FLOWS_SQL} SELECT entity, year, quarter, flow, ytd FROM cumulative")
def flow_to_ytd(spark: SparkSession, folder: str) -> DataFrame:
    return P.flow_to_ytd(_flows(spark, folder), ["entity"]).withColumn("ytd", F.col("ytd").cast(MONEY))


@query(
    "ytd_to_flow",
    f"""WITH {ORDER_FLOWS_SQL}
SELECT c.entity, c.year, c.quarter, c.ytd, CAST(CASE WHEN c.quarter = 1 THEN c.ytd ELSE c.ytd - p.ytd END AS DECIMAL(20, 2)) AS flow
FROM cumulative c LEFT JOIN cumulative p ON p.entity = c.entity AND p.year = c.year AND p.quarter = c.quarter - 1""",
)
def ytd_to_flow(spark: SparkSession, folder: str) -> DataFrame:
    cumulative = flow_to_ytd(spark, folder).drop("flow")
    return P.ytd_to_flow(cumulative, ["entity"]).withColumn("flow", F.col("flow").cast(MONEY))


@query(
    "trend_yoy",
    f"""
WITH t AS (SELECT o_custkey % 50 AS segment, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
  CAST(sum({TOTAL_SQL}) AS DECIMAL(20, 2)) AS amount FROM orders GROUP BY ALL)
SELECT t.segment, t.year, t.quarter, t.amount, q.amount AS previous_quarter, y.amount AS previous_year,
  round(100 * (CAST(t.amount AS DOUBLE) / CAST(q.amount AS DOUBLE) - 1), 4) AS qoq_pct,
  round(100 * (CAST(t.amount AS DOUBLE) / CAST(y.amount AS DOUBLE) - 1), 4) AS yoy_pct
FROM t LEFT JOIN t q ON q.segment = t.segment AND q.year * 4 + q.quarter = t.year * 4 + t.quarter - 1
LEFT JOIN t y ON y.segment = t.segment AND y.year = t.year - 1 AND y.quarter = t.quarter""",
)
def trend_yoy(spark: SparkSession, folder: str) -> DataFrame:
    keys = [(F.col("o_custkey") % 50).alias("segment"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")]
    amounts = table(spark, folder, "orders").groupBy(*keys).agg(F.sum(total()).cast(MONEY).alias("amount"))
    money = {c: F.col(c).cast(MONEY) for c in ("previous_quarter", "previous_year")}
    return P.trend(amounts, ["segment"], "amount").withColumns(money)


@query(
    "period_gaps",
    """
WITH p AS (SELECT DISTINCT o_custkey AS entity, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS period FROM orders),
s AS (SELECT entity, unnest(generate_series(min(period), max(period))) AS period FROM p GROUP BY entity)
SELECT entity, CAST(s.period // 4 AS INTEGER) AS year, CAST(s.period % 4 + 1 AS INTEGER) AS quarter
FROM s ANTI JOIN p USING (entity, period)""",
)
def period_gaps(spark: SparkSession, folder: str) -> DataFrame:
    keys = [F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")]
    return P.period_gaps(table(spark, folder, "orders").select(*keys), ["entity"])


@query(
    "common_periods",
    """
WITH a AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
b AS (SELECT DISTINCT CAST(year(l_shipdate) + 1 AS INTEGER) AS year FROM lineitem)
SELECT year, year IN (SELECT year FROM a) AS in_first, year IN (SELECT year FROM b) AS in_second
FROM (SELECT year FROM a UNION SELECT year FROM b)""",
)
def common_periods(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"))
    items = table(spark, folder, "lineitem").select((F.year("l_shipdate") + 1).alias("year"))
    return C.compare_periods(orders, items)


# ---------------------------------------------------------------- segments


@query(
    "segment_share",
    f"""
WITH {SPENT_SQL}, s AS (
  SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(CASE s_suppkey % 4 WHEN 0 THEN round(sum(price), -3) WHEN 1 THEN round(sum(price), -4) WHEN 2 THEN round(sum(price), -5) ELSE round(sum(price), -6) END AS DECIMAL(20, 2)) END AS amount FROM spent GROUP BY s_suppkey)
SELECT s_suppkey, amount, round(CAST(amount AS DOUBLE) / CAST(sum(amount) OVER () AS DOUBLE), 6) AS share,
  rank() OVER (ORDER BY amount DESC NULLS LAST) AS rank, dense_rank() OVER (ORDER BY amount DESC NULLS LAST) AS dense_rank,
  round(percent_rank() OVER (ORDER BY amount DESC NULLS LAST), 6) AS percent_rank
FROM s""",
)
def segment_share(spark: SparkSession, folder: str) -> DataFrame:
    """Agencies' spending, coarsely rounded so that values tie, and unknown for some."""
    amount = F.sum(price()).cast(MONEY)
    rounded = F.array(*[F.round(amount, -3 - k).cast(MONEY) for k in range(4)])
    spent = table(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(rounded.alias("rounded"))
    known = F.when(F.col("s_suppkey") % 11 != 0, F.get("rounded", (F.col("s_suppkey") % 4).cast("int")))
    path = scratch_dir(spark, "segments")
    spent.select("s_suppkey", known.alias("amount")).write.parquet(path)
    segments = spark.read.schema(f"s_suppkey bigint, amount {MONEY}").parquet(path)
    ranked = G.rank_segments(G.share_of_total(segments, "amount"), "amount")
    return ranked.select("s_suppkey", "amount", "share", "rank", "dense_rank", "percent_rank")


@query(
    "top_k",
    f"""
WITH {SPENT_SQL} SELECT s_suppkey, CAST(sum(price) AS DECIMAL(20, 2)) AS amount FROM spent
GROUP BY s_suppkey ORDER BY amount DESC, s_suppkey LIMIT 10""",
)
def top_k(spark: SparkSession, folder: str) -> DataFrame:
    spent = table(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum(price()).cast(MONEY).alias("amount"))
    return G.top_segments(spent, "amount", 10, "s_suppkey")


@query(
    "processed_sink",
    f"""
WITH {SPENT_SQL}, f AS (
  SELECT CAST(year AS INTEGER) AS fiscal_year, CAST(quarter AS INTEGER) AS quarter, region, l_returnflag AS expense_class, sum(price) AS amount FROM spent GROUP BY ALL)
SELECT fiscal_year, quarter, region, expense_class, CAST(CASE WHEN fiscal_year = 1998 THEN amount + 1 ELSE amount END AS DECIMAL(20, 2)) AS amount FROM f""",
)
def processed_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Facts written by period; one year is then corrected without touching the others."""
    keys = [F.year("l_shipdate").alias("fiscal_year"), F.quarter("l_shipdate").alias("quarter"), F.col("l_returnflag").alias("expense_class")]
    facts = (
        _spent(spark, folder, keys, amount=price())
        .groupBy("fiscal_year", "quarter", "region", "expense_class")
        .agg(F.sum("amount").cast(MONEY).alias("amount"))
    )
    path = scratch_dir(spark, "processed")
    write_processed(facts, path)
    corrected = read_processed(spark, path).where(F.col("fiscal_year") == 1998).withColumn("amount", (F.col("amount") + 1).cast(MONEY))
    fresh = scratch_dir(spark, "corrected")  # a partition can't be read and overwritten at once
    corrected.write.parquet(fresh)
    write_processed(spark.read.schema(corrected.schema).parquet(fresh), path)
    return read_processed(spark, path)


@query(
    "processed_changes",
    f"""
WITH {SPENT_SQL}, p AS (SELECT DISTINCT CAST(year AS INTEGER) AS fiscal_year, CAST(quarter AS INTEGER) AS quarter FROM spent)
SELECT 1 AS run, fiscal_year, quarter, 'written' AS action FROM p
UNION ALL SELECT 3, fiscal_year, quarter, CASE WHEN fiscal_year = 1998 THEN 'written' ELSE 'removed' END FROM p WHERE (fiscal_year = 1998 AND quarter = 1) OR (fiscal_year = 1993 AND quarter = 2)""",
)
def processed_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Facts written, written again unchanged, and again with one period changed and one gone: what each run did."""
    keys = [F.year("l_shipdate").alias("fiscal_year"), F.quarter("l_shipdate").alias("quarter"), F.col("l_returnflag").alias("expense_class")]
    facts = _spent(spark, folder, keys, amount=price()).groupBy("fiscal_year", "quarter", "region", "expense_class").agg(F.sum("amount").cast(MONEY).alias("amount"))
    changed = (F.col("fiscal_year") == 1998) & (F.col("quarter") == 1)
    gone = (F.col("fiscal_year") == 1993) & (F.col("quarter") == 2)
    later = facts.where(~gone).withColumn("amount", F.when(changed, F.col("amount") + 1).otherwise(F.col("amount")).cast(MONEY))
    path = scratch_dir(spark, "processed-changes")
    done = [(run, *action) for run, state in enumerate([facts, facts.repartition(3), later], 1) for action in write_changed(spark, state, path)]
    return spark.createDataFrame(done, "run int, fiscal_year int, quarter int, action string")


# ---------------------------------------------------------------- crosswalk and checks

NAMED_SQL = """
named AS (
  SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN ' nation-' || c_nationkey WHEN 1 THEN 'NATON ' || c_nationkey ELSE 'Nation_' || c_nationkey END AS label
  FROM customer
), tidy AS (SELECT c_custkey, label, trim(regexp_replace(lower(label), '[^a-z0-9]+', ' ', 'g')) AS name FROM named),
written AS (
  SELECT n_name AS alias, n_nationkey FROM nation UNION ALL SELECT upper(n_name) || '.', n_nationkey FROM nation
  UNION ALL SELECT n_name, n_nationkey + 1 FROM nation WHERE n_nationkey % 9 = 4
), claimed AS (SELECT DISTINCT trim(regexp_replace(lower(alias), '[^a-z0-9]+', ' ', 'g')) AS alias, 'R' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS canonical FROM written),
crosswalk AS (SELECT alias, CASE WHEN count(*) = 1 THEN min(canonical) END AS canonical FROM claimed GROUP BY alias)"""


def _named(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their nation written in several ways, one of them misspelt."""
    key = F.col("c_nationkey").cast("string")
    style = F.col("c_custkey") % 7
    label = (
        F.when(style == 0, F.concat(F.lit(" nation-"), key))
        .when(style == 1, F.concat(F.lit("NATON "), key))
        .otherwise(F.concat(F.lit("Nation_"), key))
    )
    return table(spark, folder, "customer").select("c_custkey", label.alias("label"))


def _crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """Every nation under two spellings, some claimed by two keys."""
    key = F.col("n_nationkey")
    code = lambda k: F.concat(F.lit("R"), F.lpad(k.cast("string"), 2, "0")).alias("canonical")
    nation = table(spark, folder, "nation")
    spelt = nation.select(F.explode(F.array("n_name", F.concat(F.upper("n_name"), F.lit(".")))).alias("alias"), code(key))
    return spelt.union(nation.where(key % 9 == 4).select("n_name", code(key + 1)))


@query(
    "crosswalk_join",
    f"WITH {NAMED_SQL} SELECT c_custkey, label, canonical FROM tidy LEFT JOIN crosswalk ON name = alias",
)
def crosswalk_join(spark: SparkSession, folder: str) -> DataFrame:
    return C.apply_crosswalk(_named(spark, folder), _crosswalk(spark, folder), "label")


@query(
    "crosswalk_ambiguous",
    f"WITH {NAMED_SQL} SELECT alias, string_agg(canonical, ',' ORDER BY canonical) AS canonical_keys FROM claimed GROUP BY alias HAVING count(*) > 1",
)
def crosswalk_ambiguous(spark: SparkSession, folder: str) -> DataFrame:
    return C.ambiguous_aliases(_crosswalk(spark, folder))


@query(
    "crosswalk_unmatched",
    f"WITH {NAMED_SQL} SELECT name, count(*) AS n_rows FROM tidy WHERE name NOT IN (SELECT alias FROM crosswalk) GROUP BY name",
)
def crosswalk_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return C.unmatched_names(_named(spark, folder), _crosswalk(spark, folder), "label")


@query(
    "crosswalk_candidates",
    f"""WITH {NAMED_SQL}, u AS (SELECT DISTINCT name FROM tidy WHERE name NOT IN (SELECT alias FROM crosswalk))
SELECT name, alias, canonical, CAST(levenshtein(name, alias) AS INTEGER) AS edits FROM u, claimed WHERE levenshtein(name, alias) <= 2""",
)
def crosswalk_candidates(spark: SparkSession, folder: str) -> DataFrame:
    crosswalk = _crosswalk(spark, folder)
    return C.suggest_matches(C.unmatched_names(_named(spark, folder), crosswalk, "label"), crosswalk)


# Example exchange rates into one currency.
RATES = [("PHP", "1.0000"), ("IDR", "0.0035"), ("IDR", "0.0035"), ("MYR", "12.5000"), ("MYR", "12.6000")]


@query(
    "currency_align",
    f"""
WITH r(currency, rate) AS (VALUES ('PHP', 1.0000::DECIMAL(10, 4)), ('IDR', 0.0035::DECIMAL(10, 4)), ('MYR', NULL::DECIMAL(10, 4))),
o AS (SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'IDR' WHEN '2' THEN 'MYR' WHEN '5' THEN 'SGD' ELSE 'PHP' END AS currency,
  {TOTAL_SQL} AS amount FROM orders)
SELECT o_orderkey, currency, amount, CAST(amount * rate AS DECIMAL(20, 2)) AS amount_common FROM o LEFT JOIN r USING (currency)""",
)
def currency_align(spark: SparkSession, folder: str) -> DataFrame:
    style = F.substring("o_orderpriority", 1, 1)
    currency = F.when(style == "1", "IDR").when(style == "2", "MYR").when(style == "5", "SGD").otherwise("PHP")
    facts = table(spark, folder, "orders").select("o_orderkey", currency.alias("currency"), total().alias("amount"))
    rates = spark.createDataFrame(RATES, "currency string, rate string").withColumn("rate", F.col("rate").cast("decimal(10,4)"))
    return C.align_currency(facts, rates).select("o_orderkey", "currency", "amount", "amount_common")


RATES_SQL = """
rates AS (
  SELECT currency, valid_since, CASE WHEN min(rate) = max(rate) THEN min(rate) END AS rate FROM (
    SELECT 'C' || o_custkey % 7 AS currency, date_trunc('day', o_orderdate) AS valid_since, CAST(1 + (o_orderkey % 1000) / 1000.0 AS DECIMAL(10, 4)) AS rate
    FROM orders WHERE o_orderkey % 37 = 0) GROUP BY ALL
), facts AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN 'C0' WHEN l_orderkey % 97 = 1 THEN NULL ELSE 'C' || l_suppkey % 9 END AS currency, l_shipdate AS day,
    CAST(round(l_extendedprice, 2) AS DECIMAL(20, 2)) AS amount
  FROM lineitem
)"""


@query(
    "currency_as_of",
    f"""WITH {RATES_SQL}
SELECT l_orderkey, l_linenumber, f.currency, CAST(valid_since AS DATE) AS valid_since, rate, CAST(amount * rate AS DECIMAL(20, 2)) AS amount_common
FROM facts f ASOF LEFT JOIN rates r ON f.currency = r.currency AND f.day >= r.valid_since""",
)
def currency_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Items at the rate of their day; half of them have one currency, some none or one without rates."""
    orders = table(spark, folder, "orders").where(F.col("o_orderkey") % 37 == 0)
    name = lambda key, n: F.concat(F.lit("C"), (F.col(key) % n).cast("string"))
    rate = (1 + (F.col("o_orderkey") % 1000).cast("decimal(10,4)") / 1000).cast("decimal(10,4)")
    rates = orders.select(name("o_custkey", 7).alias("currency"), F.date_trunc("day", "o_orderdate").cast("timestamp").alias("valid_since"), rate.alias("rate"))
    currency = F.when(F.col("l_orderkey") % 2 == 0, "C0").when(F.col("l_orderkey") % 97 == 1, F.lit(None)).otherwise(name("l_suppkey", 9))
    facts = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", currency.alias("currency"), F.col("l_shipdate").cast("timestamp").alias("day"), F.round("l_extendedprice", 2).cast("decimal(20,2)").alias("amount")
    )
    found = C.align_currency_as_of(facts, rates, "day")
    return found.select("l_orderkey", "l_linenumber", "currency", F.col("valid_since").cast("date").alias("valid_since"), "rate", "amount_common")


SPANS_SQL = """
entries AS (
  SELECT lower(p_brand) AS alias, 'K' || p_size % 3 AS canonical, CAST(1990 + p_partkey % 7 AS INTEGER) AS valid_from, CAST(1990 + p_partkey % 7 + p_size % 3 AS INTEGER) AS valid_to
  FROM part WHERE p_partkey % 5 = 0
), years AS (SELECT alias, canonical, unnest(range(valid_from, valid_to + 1)) AS year FROM entries),
held AS (SELECT regexp_replace(alias, '[^a-z0-9]+', ' ', 'g') AS alias, year, count(DISTINCT canonical) AS n, string_agg(DISTINCT canonical, ',' ORDER BY canonical) AS keys FROM years GROUP BY ALL),
runs AS (SELECT *, year - row_number() OVER (PARTITION BY alias, keys ORDER BY year) AS run FROM held)"""


def _validity(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").where(F.col("p_partkey") % 5 == 0)
    begin = (1990 + F.col("p_partkey") % 7).cast("int")
    key = F.concat(F.lit("K"), (F.col("p_size") % 3).cast("string"))
    return part.select(F.lower("p_brand").alias("alias"), key.alias("canonical"), begin.alias("valid_from"), (begin + F.col("p_size") % 3).cast("int").alias("valid_to"))


@query(
    "crosswalk_spans",
    f"""WITH {SPANS_SQL} SELECT alias, CAST(min(year) AS INTEGER) AS valid_from, CAST(max(year) AS INTEGER) AS valid_to, CASE WHEN n = 1 THEN keys END AS canonical, CAST(n AS INTEGER) AS n_keys
FROM runs GROUP BY alias, keys, n, run""",
)
def crosswalk_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping validities cut into disjoint spans."""
    return C.crosswalk_spans(_validity(spark, folder))


@query(
    "crosswalk_by_span",
    f"""WITH {SPANS_SQL}
SELECT l_orderkey, l_linenumber, CASE WHEN n = 1 THEN keys END AS canonical FROM lineitem JOIN part ON p_partkey = l_partkey
LEFT JOIN held ON held.alias = trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) AND held.year = year(l_shipdate)""",
)
def crosswalk_by_span(spark: SparkSession, folder: str) -> DataFrame:
    """Items find the span of their year."""
    items = table(spark, folder, "lineitem").join(table(spark, folder, "part").select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    facts = items.select("l_orderkey", "l_linenumber", F.upper("p_brand").alias("brand"), F.year("l_shipdate").alias("year"))
    return C.apply_spans(facts, C.crosswalk_spans(_validity(spark, folder)), "brand", "year").select("l_orderkey", "l_linenumber", "canonical")


@query(
    "clean_columns",
    """SELECT doc_id AS document_id, source AS source_name, lang AS lang_2, quality AS quality_label
FROM documents JOIN labels USING (doc_id)""",
)
def clean_columns(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "lang")
    messy = documents.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left").toDF(
        " Document ID", "Source (Name)", "lang--2", "QUALITY label"
    )
    return C.clean_columns(messy, required=["quality_label"])


@query(
    "key_checks",
    """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (l_partkey IS NULL) AS mp, count(*) FILTER (l_shipdate IS NULL) AS ms
  FROM lineitem GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (n > 1) AS n_duplicated_keys,
  CAST(sum(mp) AS BIGINT) AS missing_l_partkey, CAST(sum(ms) AS BIGINT) AS missing_l_shipdate FROM k""",
)
def key_checks(spark: SparkSession, folder: str) -> DataFrame:
    return C.key_checks(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_shipdate"])


@query(
    "duplicated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return C.duplicated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
