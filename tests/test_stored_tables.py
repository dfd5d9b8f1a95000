import os
import re

import pytest

from tradepanel.operators.existence import filter_by_members
from tradepanel.sources import csv_files, quarantine, year_store


def _scan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_years_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "store")
    first = spark.range(40).selectExpr("id as partner", "cast(2000 + id % 4 as int) as year", "double(id) as score")
    year_store.save_years(first, path)
    kept = sorted(os.listdir(os.path.join(path, "year=2001")))
    year_store.save_years(first.where("year = 2002").selectExpr("partner", "year", "score + 100 as score"), path)
    assert sorted(os.listdir(os.path.join(path, "year=2001"))) == kept
    back = year_store.read_years(spark, path, first.schema)
    assert back.columns == first.columns and back.count() == 40
    assert sorted(r.score for r in back.where("year = 2002").collect()) == [100.0 + i for i in range(2, 40, 4)]


def test_only_asked_years_are_read(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(40).selectExpr("id as partner", "cast(2000 + id % 4 as int) as year", "double(id) as score")
    year_store.save_years(rows, path)
    one = year_store.read_years(spark, path, rows.schema, [2003])
    assert re.search(r"PartitionFilters: \[[^\]]*= 2003", one._jdf.queryExecution().toString())
    assert {r.year for r in one.collect()} == {2003}
    assert year_store.read_years(spark, path, rows.schema, []).count() == 0


def test_rows_without_year_are_an_error(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2000), (2, None)], "partner int, year int")
    with pytest.raises(Exception, match="has no year"):
        year_store.save_years(rows, str(tmp_path / "store"))


def test_good_and_set_aside_are_all_lines(spark, tmp_path):
    text = "﻿made by hand\n\nCountry Name,2000,2001\nA,1,2\nB,1\n\"C, D\",3,4\nCountry Name,2000,2001\nE,1,2,3\n   \nF,,\n"
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    (tmp_path / "b.csv").write_text("other words here, and,more, of,them\nCountry Name,2000,2001\nG,5,6\n")
    good = csv_files.read_preamble_csv(spark, str(tmp_path), "Country Name", {"Country Name": "string"})
    aside = quarantine.set_aside(spark, str(tmp_path), "Country Name")
    got = sorted((r.file.rsplit("/", 1)[1], r.number, r.reason) for r in aside.collect())
    assert got == [
        ("a.csv", 1, "preamble"), ("a.csv", 2, "blank"), ("a.csv", 3, "header"), ("a.csv", 5, "record"), ("a.csv", 7, "header"),
        ("a.csv", 8, "record"), ("a.csv", 9, "blank"), ("b.csv", 1, "preamble"), ("b.csv", 2, "header"),
    ]
    assert sorted(r["Country Name"] for r in good.collect()) == ["A", "C, D", "F", "G"]
    assert good.count() + aside.count() == spark.read.text(str(tmp_path)).count()


def test_lines_are_numbered_over_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("".join(f"line {i}\n" for i in range(1, 20001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = quarantine.numbered_lines(spark, str(path))
        assert lines.where("line <> concat('line ', number)").count() == 0 and lines.count() == 20000
        assert lines.select("number").distinct().count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("large", [0, 1 << 40])
def test_members_of_hot_keys(spark, large):
    # Key 7 holds a third of the rows, null keys another part; members repeat.
    facts = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 200 end as k")
    members = spark.range(400).selectExpr("case when id % 9 = 0 then null else id % 100 end as m")
    inside = {i for i in range(100) if any(j % 100 == i and j % 9 for j in range(400))}
    rows = [(r.id, r.k) for r in facts.collect()]
    for keep in (True, False):
        got = filter_by_members(facts, members, "k", "m", ["id"], keep, large=large)
        assert got.columns == ["id", "k"]
        assert sorted(r.id for r in got.collect()) == sorted(i for i, k in rows if (k in inside) == keep)


def test_hot_key_is_dealt_over_tasks(spark):
    facts = spark.range(6000).selectExpr("id", "if(id % 3 = 0, 7, id) as k")
    members = spark.range(6000).selectExpr("id as m")
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _scan(filter_by_members(facts, members, "k", "m", ["id"]))
        assert "_salt" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_no_members_and_no_facts(spark):
    facts = spark.createDataFrame([(1, 5), (2, None)], "id long, k long")
    none = spark.createDataFrame([], "m long")
    assert filter_by_members(facts, none, "k", "m", ["id"], large=-1).count() == 0
    assert filter_by_members(facts, none, "k", "m", ["id"], False, large=-1).count() == 2
    assert filter_by_members(facts.limit(0), none, "k", "m", ["id"], large=-1).count() == 0
