"""Projection, filter and null-handling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import HOME, LAST_HISTORY, brand_code, pair_means, table, trade, with_tables
from tradepanel.catalog.registry import query
from tradepanel.functions.scalars import differs, mean_of
from tradepanel.operators import filters, project
from tradepanel.plans import domain


@query(
    "rename_project",
    """SELECT CAST(s_suppkey AS INT) AS code, CAST(s_nationkey AS BIGINT) AS country_code,
              CAST(s_acctbal AS DOUBLE) AS balance FROM supplier""",
)
def rename_project(spark, folder):
    padded = table(spark, folder, "supplier").toDF(" s_suppkey", "s_name ", "s_nationkey", " s_acctbal ")
    rows = project.trim_names(padded)
    rows = project.drop_positions(rows, [1])
    rows = project.rename(rows, {"s_suppkey": "code", "s_nationkey": "country_code", "s_acctbal": "balance"})
    rows = project.drop_present(rows, "not_there")
    return project.cast_columns(rows, {"code": "int", "country_code": "bigint"})


@query(
    "dedupe_columns",
    """SELECT c_custkey, c_name, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def dedupe_columns(spark, folder):
    left = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey").alias("l")
    right = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name").alias("r")
    joined = left.join(right, F.col("l.c_nationkey") == F.col("r.c_nationkey"))
    return project.first_of_each_name(joined)


@query(
    "panel_filter",
    with_tables("trade", body=f"""
        SELECT year, partner, hs_code, product, imports, exports FROM trade
        WHERE year BETWEEN 1996 AND {LAST_HISTORY} AND partner <> '{HOME}' AND exports > imports"""),
)
def panel_filter(spark, folder):
    return trade(spark, folder).where(
        F.col("year").between(1996, LAST_HISTORY) & differs("partner", HOME) & (F.col("exports") > F.col("imports"))
    ).drop("trade_volume")


@query(
    "partner_semi",
    """SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (
           SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))""",
)
def partner_semi(spark, folder):
    regions = table(spark, folder, "region").where(F.col("r_name").isin("ASIA", "EUROPE"))
    members = filters.keep_members(
        table(spark, folder, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), regions, ["r_regionkey"]
    ).select(F.col("n_nationkey").alias("c_nationkey"))
    return filters.keep_members(table(spark, folder, "customer"), members, ["c_nationkey"]).select("c_custkey", "c_name")


@query(
    "partner_anti",
    """SELECT c_custkey, segment FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
         AND (segment IS NULL OR segment NOT IN ('MACHINERY', 'FURNITURE'))""",
)
def partner_anti(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    open_orders = (
        table(spark, folder, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    )
    return filters.drop_members(customers, open_orders, ["c_custkey"]).where(
        filters.not_in("segment", ["MACHINERY", "FURNITURE"])
    )


@query(
    "reject_marker_rows",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part
       WHERE NOT (contains(CAST(p_partkey AS VARCHAR), '13') OR contains(p_name, '13') OR contains(p_brand, '13')
                  OR contains(p_type, '13') OR contains(CAST(p_size AS VARCHAR), '13'))""",
)
def reject_marker_rows(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return filters.reject_marked(rows, "13")


def _gappy(spark, folder):
    """Customers with negative balances and one segment turned into nulls."""
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )


_GAPPY = """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
                   nullif(c_mktsegment, 'BUILDING') AS segment FROM customer"""


@query(
    "drop_nulls",
    f"""SELECT c_custkey, balance, segment, 'all' AS mode FROM ({_GAPPY})
        WHERE balance IS NOT NULL AND segment IS NOT NULL
        UNION ALL
        SELECT c_custkey, balance, segment, 'subset' FROM ({_GAPPY}) WHERE balance IS NOT NULL""",
)
def drop_nulls(spark, folder):
    rows = _gappy(spark, folder)
    whole = filters.drop_null_rows(rows).withColumn("mode", F.lit("all"))
    return whole.unionByName(filters.drop_null_rows(rows, ["balance"]).withColumn("mode", F.lit("subset")))


@query(
    "quality_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
                   count(DISTINCT {c}) AS distinct_count FROM ({_GAPPY})"""
        for c in ("c_custkey", "balance", "segment")
    ),
)
def quality_profile(spark, folder):
    return filters.quality_profile(_gappy(spark, folder))


@query(
    "duplicate_rows",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
           SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_quantity, l_discount)""",
)
def duplicate_rows(spark, folder):
    return filters.duplicate_count(table(spark, folder, "lineitem").select("l_suppkey", "l_quantity", "l_discount"))


@query(
    "pair_home_filter",
    with_tables("home_pairs", body="SELECT year, partner, agree, distance FROM home_pairs WHERE year BETWEEN 1996 AND 2000"),
)
def pair_home_filter(spark, folder):
    return domain.home_pairs(pair_means(spark, folder), HOME, 1996, 2000).select("year", "partner", "agree", "distance")


@query(
    "key_alignment",
    """SELECT p_type AS product, CAST(replace(p_brand, 'Brand#', '') AS VARCHAR) AS hs_code, count(*) AS parts,
              CAST(sum(CAST(p_retailprice AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_price
       FROM part GROUP BY 1, 2""",
)
def key_alignment(spark, folder):
    """Two aggregates with differently typed keys, joined after both keys are text."""
    part = table(spark, folder, "part").withColumn("hs_code", brand_code())
    counts = part.groupBy(F.col("p_type").alias("product"), "hs_code").agg(F.count(F.lit(1)).alias("parts"))
    prices = part.groupBy(F.col("p_type").alias("product"), F.col("hs_code").cast("bigint").alias("hs_code")).agg(
        mean_of("p_retailprice").alias("mean_price")
    )
    left, right = project.align_keys(counts, prices, {"product": "string", "hs_code": "string"})
    return left.join(right, ["product", "hs_code"], "full")
