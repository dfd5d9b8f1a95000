"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import gdp, orders, table, trade, with_tables, year_span
from tradepanel.catalog.registry import query
from tradepanel.operators.filters import numeric_key_rows
from tradepanel.operators.ordering import drop_leading_rows
from tradepanel.operators.reshape import melt_years, widen
from tradepanel.session import fresh_path
from tradepanel.sources.csv_files import read_csv, read_preamble_csv, write_csv, write_table
from tradepanel.sources.json_files import flatten_records, read_json_list


@query("scan_project", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_project(spark, folder):
    path = fresh_path(spark, "customer-csv")
    write_csv(table(spark, folder, "customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_csv(spark, path, schema).select("c_custkey", "c_name", "c_acctbal")


@query("scan_preamble_csv", with_tables("gdp", body="SELECT partner, year, gdp FROM gdp"))
def scan_preamble_csv(spark, folder):
    """Wide yearly output under a preamble, with a trailing unnamed column, read back long."""
    years = [str(y) for y in year_span(spark, folder)]
    wide = widen(gdp(spark, folder), ["partner"], "year", years, "gdp")
    names = ",".join(["Country Name", *years])
    preamble = ["﻿\"Data Source\",\"Order totals\"", "", "\"Last Updated Date\"", f"{names},"]
    head = spark.createDataFrame([(line,) for line in preamble], "line string")
    body = wide.select(F.concat(F.to_csv(F.struct("partner", *years)), F.lit(",")).alias("line"))
    path = fresh_path(spark, "preamble-csv")
    head.unionByName(body).write.text(path)
    read = read_preamble_csv(spark, path, "Country Name", {"Country Name": "string"})
    return (
        melt_years(read.withColumnRenamed("Country Name", "partner"), ["partner"], "gdp").dropna()
    )


@query(
    "drop_bad_year",
    with_tables("order_rows", body="""
        SELECT o_orderkey, TRY_CAST(t AS INT) AS year, total_price FROM (
            SELECT o_orderkey, CAST(total AS DOUBLE) AS total_price,
                   CASE WHEN buyer_balance < 0 THEN 'Unnamed: ' || CAST(o_orderkey AS VARCHAR)
                        ELSE CAST(year AS VARCHAR) END AS t
            FROM order_rows)
        WHERE TRY_CAST(t AS INT) IS NOT NULL"""),
)
def drop_bad_year(spark, folder):
    rows = orders(spark, folder).select(
        "o_orderkey", F.col("total").cast("double").alias("total_price"),
        F.when(F.col("buyer_balance") < 0, F.concat(F.lit("Unnamed: "), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("year").cast("string")).alias("year"),
    )
    return numeric_key_rows(rows, "year")


@query(
    "skip_rows",
    """SELECT o_orderkey, o_custkey FROM (
           SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       WHERE rn > 3""",
)
def skip_rows(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return drop_leading_rows(rows, 3, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "json_flatten",
    """SELECT event_id, event_type, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS k
       FROM events WHERE regexp_matches(props, '"k": *[0-9]+')""",
)
def json_flatten(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "props")
    document = events.select(
        "event_id", "event_type", F.concat(F.lit('{"dataSet": ['), "props", F.lit("]}")).alias("document")
    )
    return flatten_records(document, "document", "k int", "dataSet", ["event_id", "event_type"])


@query(
    "json_list_scan",
    """SELECT n_name AS country, c_mktsegment AS city, count(*) AS customers,
              CAST(sum(CAST(c_acctbal AS DECIMAL(18,4))) AS DOUBLE) AS balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def json_list_scan(spark, folder):
    """One JSON list file per country, read back as rows."""
    ports = _ports(spark, folder)
    documents = ports.groupBy("country").agg(
        F.to_json(F.sort_array(F.collect_list(F.struct("city", "customers", "balance")))).alias("value")
    )
    path = fresh_path(spark, "json-lists")
    documents.write.partitionBy("country").text(path)
    return read_json_list(
        spark, path, "country string, city string, customers bigint, balance double"
    ).select("country", "city", "customers", "balance")


def _ports(spark, folder):
    """Segments per nation stand for ports per country: at most a handful of each."""
    from tradepanel.functions.scalars import exact_sum

    sums = table(spark, folder, "customer").groupBy("c_nationkey", F.col("c_mktsegment").alias("city")).agg(
        F.count(F.lit(1)).alias("customers"), exact_sum("c_acctbal").alias("balance")
    )
    names = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return sums.join(names, "c_nationkey").drop("c_nationkey")


@query(
    "sink_roundtrip",
    with_tables("trade", body="SELECT partner, hs_code, product, imports, exports, imports + exports AS trade_volume, year FROM trade"),
)
def sink_roundtrip(spark, folder):
    path = fresh_path(spark, "trade")
    rows = trade(spark, folder)
    write_table(rows, path, ["year"])
    return spark.read.schema(rows.schema).parquet(path)
