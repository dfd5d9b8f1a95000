"""Aggregation, top-k, de-duplication and union queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import HOME, LAST_HISTORY, lines, orders, table, trade, with_tables
from tradepanel.catalog.registry import query
from tradepanel.functions.fixed_values import ALL_PRODUCTS, ALL_PRODUCTS_CODE
from tradepanel.functions.scalars import add_strict, exact_sum
from tradepanel.operators import aggregates
from tradepanel.operators.ordering import group_median
from tradepanel.plans import domain
from tradepanel.session import materialise

_SUM = "CAST(sum(CAST({0} AS DECIMAL(18,4))) AS DOUBLE) AS {0}"


@query(
    "target_stats",
    """SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean, min(l_extendedprice) AS min,
              max(l_extendedprice) AS max, round(var_samp(l_extendedprice), 3) AS variance,
              round(median(l_extendedprice), 6) AS median FROM lineitem""",
)
def target_stats(spark, folder):
    stats = aggregates.describe(table(spark, folder, "lineitem"), "l_extendedprice")
    return stats.withColumns(
        {"mean": F.round("mean", 6), "variance": F.round("variance", 3), "median": F.round("median", 6)}
    )


@query(
    "group_median",
    """SELECT l_suppkey, l_returnflag, round(median(l_extendedprice), 6) AS l_extendedprice,
              round(median(l_quantity), 6) AS l_quantity FROM lineitem GROUP BY 1, 2""",
)
def median_per_group(spark, folder):
    middle = group_median(
        table(spark, folder, "lineitem"), ["l_suppkey", "l_returnflag"], ["l_extendedprice", "l_quantity"]
    )
    return middle.withColumns({c: F.round(c, 6) for c in ("l_extendedprice", "l_quantity")})


@query(
    "share_of_total",
    with_tables("trade", body=f"""
        SELECT chosen_total, all_total, chosen_total / all_total * 100 AS share_pct FROM (
            SELECT CAST(coalesce(sum(CASE WHEN partner IN ('NATION_1','NATION_2','NATION_3') THEN v END), 0) AS DOUBLE) AS chosen_total,
                   CAST(sum(v) AS DOUBLE) AS all_total
            FROM (SELECT partner, CAST(imports + exports AS DECIMAL(18,4)) AS v FROM trade
                  WHERE year >= 1997 AND partner NOT IN ('NATION_0', 'NATION_24')))"""),
)
def share_of_total(spark, folder):
    """Share of three partners in all trade since 1997, with two entries left out."""
    rows = trade(spark, folder).withColumnRenamed("partner", "country")
    return domain.partner_coverage(rows, ["NATION_1", "NATION_2", "NATION_3"], ["NATION_0", "NATION_24"], 1997)


@query(
    "rollup_all_products",
    with_tables("trade", body=f"""
        SELECT year, partner, product, hs_code, {_SUM.format('imports')}, {_SUM.format('exports')}
        FROM (SELECT year, partner, product, hs_code, imports, exports FROM trade
              UNION ALL
              SELECT year, partner, '{ALL_PRODUCTS}', {ALL_PRODUCTS_CODE}, imports, exports FROM trade)
        GROUP BY 1, 2, 3, 4"""),
)
def rollup_all_products(spark, folder):
    return domain.with_all_products(trade(spark, folder)).drop("trade_volume")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_tax FROM lineitem")
def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_tax").distinct()


@query(
    "dedupe_by_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
           SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
       WHERE rn = 1""",
)
def dedupe_by_key(spark, folder):
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return aggregates.first_by_key(rows, ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"])


@query("distinct_values", "SELECT DISTINCT p_type AS product, p_brand FROM part ORDER BY 1, 2")
def distinct_values(spark, folder):
    return aggregates.distinct_values(table(spark, folder, "part").withColumnRenamed("p_type", "product"), "product", "p_brand")


@query(
    "autocorr",
    """SELECT round(corr(y, a), 6) AS lag_1, round(corr(y, b), 6) AS lag_2, round(corr(y, c), 6) AS lag_3 FROM (
           SELECT o_totalprice AS y, lag(o_totalprice, 1) OVER w AS a, lag(o_totalprice, 2) OVER w AS b,
                  lag(o_totalprice, 3) OVER w AS c
           FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey))""",
)
def autocorr(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    out = aggregates.autocorrelation(rows, "o_totalprice", ["o_orderdate", "o_orderkey"], [1, 2, 3])
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


@query(
    "top_products",
    with_tables("lines", body="""
        SELECT hs_code, product, CAST(sum(value) AS DOUBLE) AS total_trade FROM lines
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"""),
)
def top_products(spark, folder):
    totals = lines(spark, folder).groupBy("hs_code", "product").agg(exact_sum("value").alias("total_trade"))
    return aggregates.top_k(totals, "total_trade", 10, ["hs_code", "product"])


@query(
    "top_partners",
    with_tables("trade", body="""
        SELECT partner, CAST(sum(CAST(imports + exports AS DECIMAL(18,4))) AS DOUBLE) AS trade_volume FROM trade
        WHERE year >= 1997 AND partner <> 'NATION_0' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""),
)
def top_partners(spark, folder):
    rows = trade(spark, folder).where((F.col("year") >= 1997) & (F.col("partner") != HOME))
    totals = rows.groupBy("partner").agg(exact_sum("trade_volume").alias("trade_volume"))
    return aggregates.top_k(totals, "trade_volume", 15, ["partner"])


@query(
    "latest_slice",
    with_tables("order_rows", body="""
        SELECT o_orderkey, buyer, CAST(total AS DOUBLE) AS total FROM order_rows
        WHERE year = (SELECT max(year) FROM order_rows)"""),
)
def latest_slice(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "buyer", F.col("total").cast("double").alias("total"), "year")
    return aggregates.latest_slice(rows).drop("year")


@query(
    "last_years",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders ORDER BY 1 DESC LIMIT 5",
)
def last_years(spark, folder):
    return aggregates.last_years(table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")), 5)


_PRODUCTS = {c: f"Section {c:02d}" for c in range(1, 26)} | {ALL_PRODUCTS_CODE: ALL_PRODUCTS}


@query(
    "union_history_forecast",
    with_tables(
        "trade",
        base=f"""
            SELECT year, partner, product, hs_code, imports, exports FROM trade
            WHERE year <= {LAST_HISTORY} AND partner <> '{HOME}'""",
        both_levels=f"""
            SELECT * FROM base UNION ALL
            SELECT year, partner, '{ALL_PRODUCTS}', {ALL_PRODUCTS_CODE}, imports, exports FROM base""",
        history=f"""
            SELECT year, partner, product, hs_code, {_SUM.format('imports')}, {_SUM.format('exports')}
            FROM both_levels GROUP BY 1, 2, 3, 4""",
        last=f"""
            SELECT partner, hs_code, {_SUM.format('imports')}, {_SUM.format('exports')} FROM both_levels
            WHERE year = {LAST_HISTORY} GROUP BY 1, 2""",
        body=f"""
            SELECT year, partner, product, hs_code, imports, exports, imports + exports AS trade_volume FROM history
            UNION ALL
            SELECT {LAST_HISTORY + 1}, partner,
                   CASE WHEN hs_code = {ALL_PRODUCTS_CODE} THEN '{ALL_PRODUCTS}'
                        ELSE 'Section ' || lpad(CAST(hs_code AS VARCHAR), 2, '0') END,
                   hs_code, imports * 1.5, exports * 1.25, imports * 1.5 + exports * 1.25 FROM last""",
    ),
)
def union_history_forecast(spark, folder):
    """History with subtotals, then a growth forecast per partner and code joined from both flows."""
    rows = trade(spark, folder).where((F.col("year") <= LAST_HISTORY) & (F.col("partner") != HOME))
    both = materialise(domain.with_all_products(rows), "history")
    history = both.withColumn("trade_volume", add_strict("imports", "exports"))
    last = aggregates.group_sums(
        both.where(F.col("year") == LAST_HISTORY), ["partner", "hs_code"], ["imports", "exports"]
    )
    ahead = last.withColumn("year", F.lit(LAST_HISTORY + 1))
    imports = ahead.select("partner", "hs_code", "year", (F.col("imports") * 1.5).alias("imports"))
    exports = ahead.select("partner", "hs_code", "year", (F.col("exports") * 1.25).alias("exports"))
    forecast = domain.combine_forecasts(imports, exports, ["partner", "hs_code", "year"])
    return domain.history_and_forecast(history, forecast, _PRODUCTS)


@query(
    "union_missing_columns",
    """SELECT s_name AS name, s_nationkey AS nation, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
       UNION ALL SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def union_missing_columns(spark, folder):
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"),
    )
    return aggregates.union_by_name(suppliers, customers)


@query(
    "sum_any_scale",
    """SELECT l_returnflag, round(fsum(l_discount / (l_orderkey + 1) / 1000), 12) AS small, round(fsum(l_tax * l_extendedprice / 7), 4) AS large
       FROM lineitem GROUP BY 1""",
)
def sum_any_scale(spark, folder):
    """Sums of terms without a stated number of decimals."""
    rows = table(spark, folder, "lineitem").select(
        "l_returnflag", (F.col("l_discount") / (F.col("l_orderkey") + 1) / 1000).alias("small"), (F.col("l_tax") * F.col("l_extendedprice") / 7).alias("large")
    )
    sums = aggregates.group_sums(rows, ["l_returnflag"], ["small", "large"], digits=None)
    return sums.select("l_returnflag", F.round("small", 12).alias("small"), F.round("large", 4).alias("large"))
