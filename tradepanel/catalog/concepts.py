"""Panel concepts on the order tables, in Spark and as SQL common table expressions.

partner: nation of the customer (exports) or of the supplier (imports); year: order year;
product and code: part type and brand number; value: extended price. The home country is
NATION_0. Each Spark function below has a common table expression of the same meaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepanel.functions.pairs import canonical_pair
from tradepanel.functions.scalars import exact_sum
from tradepanel.operators.skew import join_dimension
from tradepanel.operators.windows import entity_lag, yearly_lag
from tradepanel.plans import domain
from tradepanel.session import materialise

HOME = "NATION_0"
HOME_CODE = 0  # its nation key
LAST_HISTORY = 2000
CUT_YEAR = 1998
PANEL_KEY = ["year", "partner", "hs_code", "product"]


# Stated, not inferred: inference costs one job per table and query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def brand_code(brand: str = "p_brand"):
    return F.replace(F.col(brand), F.lit("Brand#"), F.lit("")).cast("int")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their year and the customer's nation and balance."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    rows = table(spark, folder, "orders")
    return (
        join_dimension(rows, customer, "o_custkey", "c_custkey", ["o_orderkey"])
        .select(
            "o_orderkey", F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("buyer"),
            F.col("c_acctbal").alias("buyer_balance"), F.col("o_totalprice").alias("total"), "o_orderdate", "o_orderpriority",
        )
    )


def year_span(spark: SparkSession, folder: str) -> list[int]:
    """All years from the first to the last order; one row reaches the driver."""
    year = F.year("o_orderdate")
    first, last = table(spark, folder, "orders").agg(F.min(year), F.max(year)).first()
    return [] if first is None else list(range(first, last + 1))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with both nations and the product."""
    supplier = table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("seller"), F.col("s_acctbal").alias("seller_balance")
    )
    part = table(spark, folder, "part").select(
        "p_partkey", brand_code().alias("hs_code"), F.col("p_type").alias("product")
    )
    rows = table(spark, folder, "lineitem")
    spread = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    joined = join_dimension(
        rows, orders(spark, folder), "l_orderkey", "o_orderkey", spread, dim_scan=table(spark, folder, "orders")
    )
    joined = join_dimension(joined, supplier, "l_suppkey", "s_suppkey", spread, fact_scan=rows)
    return (
        join_dimension(joined, part, "l_partkey", "p_partkey", spread, fact_scan=rows)
        .select(
            "year", "buyer", "seller", "hs_code", "product", "buyer_balance", "seller_balance",
            F.col("l_extendedprice").alias("value"), F.col("l_quantity").alias("quantity"),
            F.col("l_tax").alias("tax"), F.col("l_discount").alias("discount"),
            "l_linestatus", "l_returnflag",
        )
    )


def nations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))


def flows(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line and direction, in one scan of the lines."""
    sides = F.explode(
        F.array(
            F.struct(F.lit("Export").alias("flow"), F.col("buyer").alias("code")),
            F.struct(F.lit("Import").alias("flow"), F.col("seller").alias("code")),
        )
    )
    return lines(spark, folder).select("year", "hs_code", "product", "value", sides.alias("side")).select(
        "year", "hs_code", "product", "value", "side.*"
    )


def trade(spark: SparkSession, folder: str, mode: str = "strict") -> DataFrame:
    """Imports and exports per year, product and partner."""
    sums = domain.trade_balance(flows(spark, folder), ["year", "code", "hs_code", "product"], mode=mode)
    return _named(sums, spark, folder)


def _named(df: DataFrame, spark: SparkSession, folder: str, code: str = "code", name: str = "partner") -> DataFrame:
    """Country name for a code column, after aggregation so that few rows are joined."""
    names = nations(spark, folder).select(F.col("code").alias(code), F.col("name").alias(name))
    return df.join(names, code).drop(code)


def gdp_of(rows: DataFrame) -> DataFrame:
    """National output: order totals per customer nation and year."""
    return rows.groupBy("buyer", "year").agg(exact_sum("total").alias("gdp"))


def gdp(spark: SparkSession, folder: str) -> DataFrame:
    return _named(gdp_of(orders(spark, folder)), spark, folder, "buyer")


def home_gdp(all_gdp: DataFrame, home=HOME) -> DataFrame:
    """The home series with its lag, one row per year."""
    home = all_gdp.where(F.col("partner") == home).select("year", F.col("gdp").alias("home_gdp"))
    return yearly_lag(home, "home_gdp", "home_gdp_lag1")


def rate_of(rows: DataFrame) -> DataFrame:
    """Exchange rate: value per unit of quantity, per customer nation and year."""
    return rows.groupBy("buyer", "year").agg(
        (exact_sum("value") / exact_sum("quantity")).alias("rate")
    )


def rates(spark: SparkSession, folder: str) -> DataFrame:
    return _named(rate_of(lines(spark, folder)), spark, folder, "buyer")


def vote_columns() -> dict:
    """Vote measures of an order line: ideal points are balances (negative ones are missing)."""
    x = F.when(F.col("buyer_balance") >= 0, F.col("buyer_balance"))
    y = F.when(F.col("seller_balance") >= 0, F.col("seller_balance"))
    gap = F.abs(F.col("buyer_balance") - F.col("seller_balance"))
    return {
        "agree": (F.col("l_linestatus") == "F").cast("int"),
        "ideal_x": x,
        "ideal_y": y,
        "distance": F.when(F.col("l_returnflag") != "R", gap + F.col("discount")),
    }


def votes(spark: SparkSession, folder: str) -> DataFrame:
    """One vote per order line between two different nations."""
    return (
        lines(spark, folder)
        .where(F.col("buyer") != F.col("seller"))
        .select(
            F.col("buyer").alias("code1"), F.col("seller").alias("code2"), "year",
            *[c.alias(n) for n, c in vote_columns().items()],
        )
    )


def pair_means(spark: SparkSession, folder: str) -> DataFrame:
    return domain.pair_distance(votes(spark, folder), nations(spark, folder))


def weights_of(customers: DataFrame) -> DataFrame:
    """Weight per nation: share of its customers in one market segment, if any is."""
    shares = customers.groupBy(F.col("c_nationkey").alias("buyer")).agg(
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("chosen"), F.count(F.lit(1)).alias("n")
    )
    return shares.where("chosen > 0").select("buyer", (F.col("chosen") / F.col("n")).alias("tariff_weight"))


def tariff_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _named(weights_of(table(spark, folder, "customer")), spark, folder, "buyer", "country")


def agreements_of(sums: DataFrame) -> DataFrame:
    """Agreement rows by nation key, from line counts and sums per year and pair of nations.

    The home country is left blank, as in the source data.
    """
    low, high = F.least("buyer", "seller"), F.greatest("buyer", "seller")
    rows = (
        sums.where(F.col("buyer") != F.col("seller"))
        .groupBy("year", low.alias("low"), high.alias("high"))
        .agg(
            (exact_sum("tax") / F.sum("n") * 100).alias("tariff_pct"),
            (exact_sum("discount") / F.sum("n") * 100).alias("export_weight"),
        )
    )
    return rows.select(
        "year", F.when(F.col("low") != HOME_CODE, F.col("low")).alias("country"),
        F.col("high").alias("partner_country"),
        F.pmod(F.col("low") + F.col("high") + F.col("year"), F.lit(2)).cast("double").alias("fta_weight"),
        "tariff_pct", "export_weight",
    )


def agreements(spark: SparkSession, folder: str) -> DataFrame:
    counted = lines(spark, folder).groupBy("year", "buyer", "seller").agg(
        exact_sum("tax").alias("tax"), exact_sum("discount").alias("discount"), F.count(F.lit(1)).alias("n")
    )
    named = domain.name_both_sides(
        agreements_of(counted).withColumnsRenamed({"country": "low", "partner_country": "high"}),
        nations(spark, folder), "code", "name", {"low": "country", "high": "partner_country"},
    )
    return named.drop("low", "high")


def adjusted(spark: SparkSession, folder: str) -> DataFrame:
    return domain.agreement_adjust(
        agreements(spark, folder), tariff_weights(spark, folder), HOME, cut_year=CUT_YEAR
    )


def cube(spark: SparkSession, folder: str) -> DataFrame:
    """All sums the panel needs, from one pass over the order lines, written once.

    Its size is set by years x nations x nations x products, not by the lines.
    """
    vote = vote_columns()
    gap = F.abs(F.col("buyer_balance") - F.col("seller_balance"))
    valid = (F.col("buyer") != F.col("seller")) & vote["ideal_x"].isNotNull() & vote["ideal_y"].isNotNull()
    rows = (
        lines(spark, folder)
        .groupBy("year", "buyer", "seller", "hs_code", "product")
        .agg(
            *[exact_sum(c).alias(c) for c in ("value", "quantity", "tax", "discount")],
            F.count(F.lit(1)).alias("n"),
            F.count_if(valid).alias("votes"),
            F.sum(F.when(valid, vote["agree"])).alias("agree"),
            exact_sum(F.when(valid, F.coalesce(vote["distance"], gap)), 9).alias("distance"),
        )
    )
    return materialise(rows, "cube")


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """The joined panel: one pass over the lines, then joins of small tables by nation key."""
    sums = cube(spark, folder)
    sides = F.explode(
        F.array(
            F.struct(F.lit("Export").alias("flow"), F.col("buyer").alias("partner")),
            F.struct(F.lit("Import").alias("flow"), F.col("seller").alias("partner")),
        )
    )
    by_flow = sums.select("year", "hs_code", "product", "value", sides.alias("s")).select(
        "year", "hs_code", "product", "value", "s.*"
    )
    balance = domain.trade_balance(by_flow, ["year", "partner", "hs_code", "product"]).drop("trade_volume")
    pairs = (
        sums.where("votes > 0")
        .groupBy("year", canonical_pair("buyer", "seller").alias("pair"))
        .agg(
            (F.sum("agree") / F.sum("votes")).alias("agree"),
            (exact_sum("distance", 9) / F.sum("votes")).alias("distance"),
        )
    )
    outputs = materialise(gdp_of(orders(spark, folder)).withColumnRenamed("buyer", "partner"), "gdp")
    adjusted_rows = domain.agreement_adjust(
        agreements_of(sums),
        weights_of(table(spark, folder, "customer")).withColumnRenamed("buyer", "country"),
        HOME_CODE, cut_year=CUT_YEAR,
    )
    built = domain.panel_build(
        pairs, balance, entity_lag(outputs, "partner", "gdp", "gdp_lag1"),
        rate_of(sums).withColumnRenamed("buyer", "partner"), adjusted_rows,
        home_gdp(outputs, HOME_CODE), HOME_CODE,
    )
    return _named(built.withColumnRenamed("partner", "code"), spark, folder)


# --- the same concepts in SQL -------------------------------------------------------

_CTE: dict[str, tuple[list[str], str]] = {
    "order_rows": ([], """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, c_nationkey AS buyer,
               CAST(c_acctbal AS DECIMAL(18,4)) AS buyer_balance,
               CAST(o_totalprice AS DECIMAL(18,4)) AS total, o_orderdate
        FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "lines": (["order_rows"], """
        SELECT year, buyer, s_nationkey AS seller,
               CAST(replace(p_brand, 'Brand#', '') AS INT) AS hs_code, p_type AS product,
               buyer_balance, CAST(s_acctbal AS DECIMAL(18,4)) AS seller_balance,
               CAST(l_extendedprice AS DECIMAL(18,4)) AS value,
               CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
               CAST(l_tax AS DECIMAL(18,4)) AS tax, CAST(l_discount AS DECIMAL(18,4)) AS discount,
               l_linestatus, l_returnflag
        FROM lineitem JOIN order_rows ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"""),
    "flow_rows": (["lines"], """
        SELECT year, hs_code, product, value, 'Export' AS flow, buyer AS code FROM lines
        UNION ALL
        SELECT year, hs_code, product, value, 'Import', seller FROM lines"""),
    "trade": (["flow_rows"], """
        SELECT year, n_name AS partner, hs_code, product,
               CAST(sum(CASE WHEN flow = 'Import' THEN value END) AS DOUBLE) AS imports,
               CAST(sum(CASE WHEN flow = 'Export' THEN value END) AS DOUBLE) AS exports
        FROM flow_rows JOIN nation ON code = n_nationkey GROUP BY 1, 2, 3, 4"""),
    "gdp": (["order_rows"], """
        SELECT n_name AS partner, year, CAST(sum(total) AS DOUBLE) AS gdp
        FROM order_rows JOIN nation ON buyer = n_nationkey GROUP BY 1, 2"""),
    "home_gdp": (["gdp"], f"""
        SELECT year, gdp AS home_gdp, lag(gdp) OVER (ORDER BY year) AS home_gdp_lag1
        FROM gdp WHERE partner = '{HOME}'"""),
    "rates": (["lines"], """
        SELECT n_name AS partner, year,
               CAST(sum(value) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE) AS rate
        FROM lines JOIN nation ON buyer = n_nationkey GROUP BY 1, 2"""),
    "votes": (["lines"], """
        SELECT buyer AS code1, seller AS code2, year,
               CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS agree,
               CASE WHEN buyer_balance >= 0 THEN buyer_balance END AS ideal_x,
               CASE WHEN seller_balance >= 0 THEN seller_balance END AS ideal_y,
               CASE WHEN l_returnflag <> 'R'
                    THEN CAST(abs(buyer_balance - seller_balance) + discount AS DECIMAL(18,4)) END AS distance
        FROM lines WHERE buyer <> seller"""),
    "pairs": (["votes"], """
        SELECT year, least(a.n_name, b.n_name) AS country1, greatest(a.n_name, b.n_name) AS country2,
               CAST(sum(agree) AS DOUBLE) / count(*) AS agree,
               CAST(sum(ideal_x) AS DOUBLE) / count(*) AS ideal_x,
               CAST(sum(ideal_y) AS DOUBLE) / count(*) AS ideal_y,
               CAST(sum(CAST(coalesce(distance, abs(ideal_x - ideal_y)) AS DECIMAL(18,4))) AS DOUBLE)
                   / count(*) AS distance
        FROM votes JOIN nation a ON code1 = a.n_nationkey JOIN nation b ON code2 = b.n_nationkey
        WHERE ideal_x IS NOT NULL AND ideal_y IS NOT NULL
        GROUP BY 1, 2, 3"""),
    "tariff_weights": ([], """
        SELECT n_name AS country,
               CAST(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS DOUBLE) / count(*) AS tariff_weight
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
        HAVING count(*) FILTER (WHERE c_mktsegment = 'BUILDING') > 0"""),
    "agreements": (["lines"], f"""
        SELECT year, nullif(a.n_name, '{HOME}') AS country, b.n_name AS partner_country,
               CAST((low + high + year) % 2 AS DOUBLE) AS fta_weight, tariff_pct, export_weight
        FROM (SELECT year, least(buyer, seller) AS low, greatest(buyer, seller) AS high,
                     CAST(sum(tax) AS DOUBLE) / count(*) * 100 AS tariff_pct,
                     CAST(sum(discount) AS DOUBLE) / count(*) * 100 AS export_weight
              FROM lines WHERE buyer <> seller GROUP BY 1, 2, 3)
        JOIN nation a ON low = a.n_nationkey JOIN nation b ON high = b.n_nationkey"""),
    "adjusted_once": (["agreements", "tariff_weights"], f"""
        SELECT year, coalesce(g.country, '{HOME}') AS country, partner_country,
               greatest(CASE WHEN year < {CUT_YEAR} THEN
                   fta_weight - tariff_pct / 100 * export_weight / 100 * coalesce(c.tariff_weight, 0)
                              - tariff_pct / 100 * export_weight / 100 * coalesce(p.tariff_weight, 0)
                   ELSE fta_weight - tariff_pct / 100 * export_weight / 100 END, 0.0) AS adjusted_value
        FROM agreements g
        LEFT JOIN tariff_weights c ON coalesce(g.country, '{HOME}') = c.country
        LEFT JOIN tariff_weights p ON partner_country = p.country"""),
    "adjusted": (["adjusted_once"], """
        SELECT year, country, partner_country, adjusted_value,
               CAST(CASE WHEN adjusted_value > 0 THEN 1 ELSE 0 END AS INT) AS fta_binary
        FROM (SELECT * FROM adjusted_once UNION ALL
              SELECT year, partner_country, country, adjusted_value FROM adjusted_once)"""),
    "home_pairs": (["pairs"], f"""
        SELECT year, CASE WHEN country1 <> '{HOME}' THEN country1 ELSE country2 END AS partner, agree, distance
        FROM pairs WHERE country1 = '{HOME}' OR country2 = '{HOME}'"""),
    "gdp_lagged": (["gdp"], """
        SELECT *, lag(gdp) OVER (PARTITION BY partner ORDER BY year) AS gdp_lag1 FROM gdp"""),
    "panel": (["home_pairs", "trade", "gdp_lagged", "rates", "adjusted", "home_gdp"], f"""
        SELECT h.year, h.partner, h.agree, h.distance, t.hs_code, t.product, t.imports, t.exports,
               g.gdp, g.gdp_lag1, r.rate, a.adjusted_value, a.fta_binary, e.home_gdp, e.home_gdp_lag1
        FROM home_pairs h
        JOIN trade t ON t.year = h.year AND t.partner = h.partner
             AND t.imports IS NOT NULL AND t.exports IS NOT NULL
        LEFT JOIN gdp_lagged g ON g.year = h.year AND g.partner = h.partner
        LEFT JOIN rates r ON r.year = h.year AND r.partner = h.partner
        LEFT JOIN adjusted a ON a.year = h.year AND a.country = h.partner AND a.partner_country = '{HOME}'
        LEFT JOIN home_gdp e ON e.year = h.year"""),
}


def define(name: str, needs: list[str], body: str) -> None:
    """Add a common table expression for later queries."""
    _CTE[name] = (needs, body)


def with_tables(*needs: str, body: str, **also: str) -> str:
    """SQL text with the needed common table expressions, each after those it reads.

    ``also`` adds expressions that only this text uses, in the given order.
    """
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _CTE[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    # Written once, as Spark does, so that no expression is expanded per use.
    bodies = {n: _CTE[n][1] for n in ordered} | also
    parts = ",\n".join(f"{n} AS MATERIALIZED ({text})" for n, text in bodies.items())
    return f"WITH {parts}\n{body}" if parts else body
