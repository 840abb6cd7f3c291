"""Checks from one scan, and checks counted while a table is written."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tidepanel.operators import quality
from tidepanel.operators.panel import missing_steps
from tidepanel.sources import files

SCHEMA = "entity int, ts timestamp, v double"


def hours(*at):
    return [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m) for m in at]


def test_checked_equals_the_single_checks(spark):
    data = [(0, t, 1.0) for t in hours(0, 60, 60, 240)]
    data += [(1, t, None) for t in hours(30, 150, 165)]  # the grid starts at the first time; 02:45 is beside it
    data += [(2, None, 2.0), (2, None, 2.0), (3, hours(600)[0], float("nan"))]
    df = spark.createDataFrame(data, SCHEMA)
    got = quality.checked(df, ["entity", "ts", "w"], ["entity"], "ts", "hour").first().asDict()
    gaps = missing_steps(df.where("ts IS NOT NULL").distinct(), ["entity"], "ts", "hour").count()
    assert got == {"rows": 10, "duplicates": 2, "missing_columns": 1, "nulls": 5, "missing_steps": gaps} and gaps == 3
    # a NULL key is a series like any other
    assert quality.checked(spark.createDataFrame([(None, t, 1.0) for t in hours(0, 180)], SCHEMA), [], ["entity"], "ts", "hour").first()["missing_steps"] == 2
    empty = quality.checked(df.limit(0), ["entity"], ["entity"], "ts", "hour").first().asDict()
    assert empty == {"rows": 0, "duplicates": 0, "missing_columns": 0, "nulls": 0, "missing_steps": 0}


def test_each_source_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(0, t, 1.0) for t in hours(0, 60)], SCHEMA).write.parquet(path)
    source = {"df": spark.read.parquet(path), "required": [], "keys": ["entity"], "time": "ts", "step": "hour"}
    report = quality.report({"a": source})
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {(r["source"], r["check"]): r["value"] for r in report.collect()}[("all", "issues")] == 0


def test_checks_are_counted_in_the_writing_pass(spark, tmp_path):
    df = spark.range(1000).repartition(7).select(
        (F.col("id") % 3).cast("string").alias("split"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("dt"),
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"),
    )
    path = str(tmp_path / "splits")
    got = quality.checked_load(df, lambda d: files.write_splits(d, path), "t", ["dt", "w"], "dt", {"small": F.col("v") < 500})
    assert {(r["check"], r["column"]): r["value"] for r in got.collect()} == {
        ("rows", ""): 1000, ("nulls", "split"): 0, ("nulls", "dt"): 0, ("nulls", "v"): 100, ("first", "dt"): 19723, ("last", "dt"): 19772,
        ("small", ""): 550, ("missing_column", "w"): 1,
    }
    assert spark.read.parquet(path).count() == 1000
    none = quality.checked_load(df.where("v < 0"), lambda d: files.write_splits(d, str(tmp_path / "none")), "t", [], "dt")
    assert {(r["check"], r["column"]): r["value"] for r in none.collect()}[("rows", "")] == 0
    assert rows(none.where("check = 'first'"), "column")[0]["value"] is None
