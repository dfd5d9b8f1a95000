"""Stored yearly scores, records set aside by a scan, existence joins over hot keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import gdp, table, with_tables, year_span
from tradepanel.catalog.domain import scores
from tradepanel.catalog.registry import query
from tradepanel.operators.existence import filter_by_members
from tradepanel.operators.reshape import widen
from tradepanel.session import fresh_path, materialise
from tradepanel.sources.csv_files import read_preamble_csv
from tradepanel.sources.quarantine import set_aside
from tradepanel.sources.year_store import read_years, save_years


@query(
    "stored_scores",
    with_tables("scores", body="""
        SELECT partner, year, round(geo_distance_score + CASE WHEN year = 1999 THEN 10 ELSE 0 END, 6) AS geo_distance_score
        FROM scores WHERE year IN (1998, 1999)"""),
)
def stored_scores(spark, folder):
    """All years are stored, one is replaced, two are read back."""
    made = materialise(scores(spark, folder), "scores")
    path = fresh_path(spark, "score-store")
    save_years(made, path)
    save_years(made.where("year = 1999").withColumn("geo_distance_score", F.round(F.col("geo_distance_score") + 10, 6)), path)
    return read_years(spark, path, made.schema, [1998, 1999])


@query(
    "scan_quarantine",
    with_tables("gdp", body="""
        SELECT DISTINCT partner, CASE WHEN CAST(replace(partner, 'NATION_', '') AS INT) % 5 = 0 THEN 'record' ELSE 'good' END AS kind
        FROM gdp"""),
)
def scan_quarantine(spark, folder):
    """Every record under a preamble is returned as good or set aside; each fifth country's is cut short."""
    years = [str(y) for y in year_span(spark, folder)]
    wide = widen(gdp(spark, folder), ["partner"], "year", years, "gdp")
    short = F.regexp_extract("partner", "([0-9]+)$", 1).cast("int") % 5 == 0
    body = wide.select(F.when(short, F.concat("partner", F.lit(",cut"))).otherwise(F.to_csv(F.struct("partner", *years))).alias("line"))
    head = spark.createDataFrame([("made by hand",), ("",), (",".join(["Country Name", *years]),)], "line string")
    path = fresh_path(spark, "short-records")
    head.unionByName(body).write.text(path)
    good = read_preamble_csv(spark, path, "Country Name", {"Country Name": "string"})
    bad = set_aside(spark, path, "Country Name").where("reason not in ('header', 'blank')")
    # The header stands in a file of its own, so a line before it is told by having one field only.
    bad = bad.where(F.col("line").contains(",")).select(F.substring_index("line", ",", 1).alias("partner"), F.col("reason").alias("kind"))
    return good.select(F.col("Country Name").alias("partner"), F.lit("good").alias("kind")).unionByName(bad)


@query(
    "existence_hot",
    """SELECT l_suppkey, count(*) FILTER (WHERE inside) AS inside, count(*) FILTER (WHERE NOT inside) AS outside
       FROM (SELECT l_suppkey, EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25) AS inside FROM lineitem)
       GROUP BY 1""",
)
def existence_hot(spark, folder):
    """Lines of large and of other parts per supplier, as a member set beyond broadcasting would be joined."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    members = table(spark, folder, "part").where(F.col("p_size") > 25).select("p_partkey")
    sides = [
        filter_by_members(lines, members, "l_partkey", "p_partkey", ["l_orderkey", "l_linenumber"], keep, lines, large=0)
        .select("l_suppkey", F.lit(keep).alias("inside"))
        for keep in (True, False)
    ]
    return sides[0].unionByName(sides[1]).groupBy("l_suppkey").agg(
        F.count_if("inside").alias("inside"), F.count_if(~F.col("inside")).alias("outside")
    )
