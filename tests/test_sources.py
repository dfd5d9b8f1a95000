import json
import os

import pytest

from tradepanel import session
from tradepanel.operators import models
from tradepanel.operators.filters import numeric_key_rows
from tradepanel.operators.reshape import melt_years
from tradepanel.sources import csv_files, json_files, stores


def test_preamble_blank_lines_mark_padding_and_junk(spark, tmp_path):
    text = (
        '﻿"Data Source","Indicators",\n\n"Last Updated Date","2024-01-01",\n\n'
        '"Country Name","Country Code", 2000 ,2001,\n'
        '"China","CHN",1.5,2.5,\n"    Korea, Rep Of","KOR",3,n.a.,\n"Notes",,\n'
    )
    path = tmp_path / "wide.csv"
    path.write_text(text, encoding="utf-8")
    df = csv_files.read_preamble_csv(
        spark, str(path), "Country Name", {"Country Name": "string", "Country Code": "string"}
    )
    assert df.columns == ["Country Name", "Country Code", "2000", "2001"]
    got = [tuple(r) for r in df.orderBy("Country Code").collect()]
    assert got == [("China", "CHN", 1.5, 2.5), ("    Korea, Rep Of", "KOR", 3.0, None)]
    long = melt_years(df, ["Country Name", "Country Code"], "v")
    assert long.count() == 4


def test_preamble_over_several_files(spark, tmp_path):
    for i, name in enumerate(["Japan", "India"]):
        (tmp_path / f"part{i}.csv").write_text(f"made by hand\n\nData Series,2013 Jan\n  {name},{i}.5\n")
    df = csv_files.read_preamble_csv(spark, str(tmp_path), "Data Series", {"Data Series": "string"})
    assert sorted(tuple(r) for r in df.collect()) == [("  India", 1.5), ("  Japan", 0.5)]


def test_missing_header_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no header"):
        csv_files.read_preamble_csv(spark, str(tmp_path / "x.csv"), "Country Name")


def test_junk_last_row(spark, tmp_path):
    (tmp_path / "x.csv").write_text("year,v\n1961,7.5\n1962,8.5\nUnnamed: 68,\n")
    df = csv_files.read_csv(spark, str(tmp_path / "x.csv"), "year string, v double")
    assert [tuple(r) for r in numeric_key_rows(df, "year").orderBy("year").collect()] == [(1961, 7.5), (1962, 8.5)]


def test_partitioned_sink_keeps_all_rows(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "cast(if(id % 3 = 0, 2000, 2001 + id % 5) as int) as year")
    path = str(tmp_path / "out")
    csv_files.write_table(df, path, ["year"])
    assert any(d.startswith("year=") for d in os.listdir(path))
    back = spark.read.schema(df.schema).parquet(path)
    assert back.exceptAll(df).count() == 0 and back.count() == 1000
    assert "PartitionFilters: [isnotnull(year" in back.where("year = 2000")._jdf.queryExecution().toString()


def test_nested_json_records(spark):
    docs = [
        json.dumps({"dataSet": [{"a": 1, "n": {"x": "u", "y": 2.5}}, {"a": 2, "n": None}]}),
        json.dumps({"dataSet": []}), json.dumps({"other": 1}), "not json",
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, d string")
    out = json_files.flatten_records(df, "d", "a int, n struct<x:string,y:double>", "dataSet", ["id"])
    assert out.columns == ["id", "a", "n_x", "n_y"]
    assert sorted((r["id"], r["a"], r["n_x"], r["n_y"]) for r in out.collect()) == [(0, 1, "u", 2.5), (0, 2, None, None)]


def test_json_list_file(spark, tmp_path):
    (tmp_path / "ports.json").write_text(json.dumps([{"COUNTRY": "A", "LATITUDE": 1.5}, {"COUNTRY": "B", "LATITUDE": None}], indent=1))
    df = json_files.read_json_list(spark, str(tmp_path / "ports.json"), "COUNTRY string, LATITUDE double")
    assert sorted(tuple(r) for r in df.collect()) == [("A", 1.5), ("B", None)]


def test_model_store_checks_the_feature_order(spark, tmp_path):
    df = spark.range(60).selectExpr("cast(id as double) a", "cast(id * id % 17 as double) b", "cast(3 * id + 1 as double) y")
    model = models.fit(df, ["a", "b"], "y", "ols")
    path = str(tmp_path / "model")
    stores.save_model(model, path)
    loaded = stores.load_model(path, ["a", "b"])
    before = [r["prediction"] for r in models.predict(model, df).orderBy("a").collect()]
    assert [r["prediction"] for r in models.predict(loaded, df).orderBy("a").collect()] == pytest.approx(before)
    with pytest.raises(ValueError, match="stored model wants"):
        stores.load_model(path, ["b", "a"])


class Settings:
    """Just enough of a session to ask for the shared folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder or default)})


def test_shared_folder():
    assert session.shared_dir(Settings("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert os.path.isdir(session.shared_dir(Settings("local[2]")))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Settings("spark://host:7077"))


def test_materialised_table_has_no_lineage(spark):
    df = spark.range(100).selectExpr("id % 7 as k").groupBy("k").count()
    written = session.materialise(df)
    assert written.dtypes == df.dtypes and written.exceptAll(df).count() == 0
    plan = written._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "Aggregate" not in plan
