import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidepanel.operators import evaluate, profiles, quality, stats

# Published confusion counts (actual, predicted, n) and the metrics they give.
PUBLISHED = [
    ("Low", "Low", 68), ("Low", "Medium", 2), ("Medium", "Low", 12), ("Medium", "Medium", 220),
    ("Medium", "High", 12), ("High", "Medium", 23), ("High", "High", 161),
]


@pytest.fixture(scope="module")
def published(spark):
    data = [(0, a, p) for a, p, n in PUBLISHED for _ in range(n)]
    return spark.createDataFrame(data, "entity int, c string, c_hat string").repartition(4)


def test_published_counts_give_the_published_metrics(published):
    m = evaluate.classification_metrics(published, "c", "c_hat", ["entity"]).first()
    assert (m["n"], round(m["accuracy"], 4), round(m["f1_macro"], 4), round(m["balanced_accuracy"], 4)) == (
        498, 0.9016, 0.9028, 0.9160,
    )


def test_confusion_matrix_keeps_zero_cells(published):
    out = evaluate.confusion_matrix(published, "c", "c_hat", ["entity"]).collect()
    assert len(out) == 9 and sum(r["n"] for r in out) == 498
    cells = {(r["actual"], r["predicted"]): r["n"] for r in out}
    assert cells[("Low", "High")] == 0 and cells[("High", "High")] == 161
    assert math.isclose(sum(r["share"] for r in out if r["actual"] == "Low"), 1.0)


def test_labels_missing_on_one_side(spark):
    df = spark.createDataFrame([(0, "Low", "Low"), (0, "Low", "High"), (0, "Medium", "Low")], "entity int, c string, c_hat string")
    report = {r["label"]: r for r in evaluate.class_report_with_averages(df, "c", "c_hat", ["entity"]).collect()}
    assert report["High"]["support"] == 0 and report["High"]["precision"] == 0
    assert report["Medium"]["f1"] == 0 and report["Low"]["recall"] == 0.5
    m = evaluate.classification_metrics(df, "c", "c_hat", ["entity"]).first()
    # macro F1 over three labels, balanced accuracy over the two true ones
    assert math.isclose(m["f1_macro"], 0.5 / 3) and math.isclose(m["balanced_accuracy"], 0.25)


def test_regression_metrics_and_constant_truth(spark):
    y, p = np.array([1.0, 2, 3, 4]), np.array([1.5, 2, 2, 5])
    df = spark.createDataFrame([(0, float(a), float(b)) for a, b in zip(y, p)] + [(1, 3.0, 3.5), (1, 3.0, 2.5)], "entity int, y double, q double")
    out = {r["entity"]: r for r in evaluate.regression_metrics(df, "y", "q", ["entity"]).collect()}
    e = y - p
    assert math.isclose(out[0]["mae"], abs(e).mean()) and math.isclose(out[0]["rmse"], math.sqrt((e**2).mean()))
    assert math.isclose(out[0]["r2"], 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    assert out[1]["r2"] is None
    assert evaluate.regression_metrics(df.filter("entity > 5"), "y", "q", ["entity"]).count() == 0


def test_quantiles_are_linear(spark):
    v = np.random.default_rng(0).normal(size=101).round(3)
    df = spark.createDataFrame([(0, float(x)) for x in v], "entity int, v double").repartition(5)
    got = stats.quantiles(df, ["entity"], "v", {"a": 0.1, "b": 0.5, "c": 0.85}).first()
    np.testing.assert_allclose([got["a"], got["b"], got["c"]], np.quantile(v, [0.1, 0.5, 0.85]))


def test_histogram_closes_the_last_bin(spark):
    v = [0.0, 0.1, 0.5, 0.9, 1.0, 1.0]
    df = spark.createDataFrame([(0, x) for x in v], "entity int, v double")
    got = [r["n"] for r in profiles.histogram(df, "v", 4).orderBy("bin").collect()]
    assert got == np.histogram(v, bins=4)[0].tolist()
    flat = spark.createDataFrame([(0, 3.0)] * 4, "entity int, v double")
    assert [r["n"] for r in profiles.histogram(flat, "v", 4).orderBy("bin").collect()] == np.histogram([3.0] * 4, bins=4)[0].tolist()


def test_median_fill_and_describe(spark):
    data = [(0, 1.0), (0, None), (0, 4.0), (0, 10.0), (1, None)]
    df = spark.createDataFrame(data, "entity int, v double")
    got = sorted((r["entity"], -1.0 if r["v"] is None else r["v"]) for r in stats.median_fill(df, ["entity"], ["v"]).collect())
    assert got == [(0, 1.0), (0, 4.0), (0, 4.0), (0, 10.0), (1, -1.0)]
    d = stats.describe(df.filter("entity = 0"), ["entity"], ["v"], {"q50": 0.5}).first()
    assert (d["n"], d["mean"], d["q50"]) == (3, 5.0, 4.0)


def test_crosstab_has_margins(spark):
    df = spark.createDataFrame([(1, "Low"), (1, "High"), (2, "Low")], "k int, c string")
    out = {r["k"]: r for r in profiles.crosstab_margins(df, "k", "c", ("Low", "High")).collect()}
    pdf = pd.crosstab(pd.Series([1, 1, 2]), pd.Series(["Low", "High", "Low"]), margins=True)
    assert out["All"]["All"] == pdf.loc["All", "All"] and out["2"]["High"] == 0 and out["1"]["All"] == 2


def test_quality_report(spark):
    df = spark.createDataFrame([(0, 1, None), (0, 1, None), (0, 3, 5)], "entity int, d int, v int").select(
        "entity", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("dt"), "v"
    )
    source = {"df": df, "required": ["entity", "dt", "other"], "time": "dt", "keys": ["entity"], "step": "day"}
    got = {(r["source"], r["check"]): r["value"] for r in quality.report({"x": source}).collect()}
    assert got == {
        ("x", "rows"): 3, ("x", "duplicates"): 1, ("x", "missing_columns"): 1, ("x", "nulls"): 2,
        ("x", "missing_steps"): 1, ("all", "issues"): 4,
    }
    assert rows(quality.null_counts(df), "column") == [{"column": "v", "n_nulls": 2}]


def test_constant_columns_have_no_correlation(spark):
    rows = [(0, i, float(i), 0.1, None if i % 3 else float(-i), 5.0) for i in range(30)]
    rows += [(1, i, 0.7, float(i), None, 0.1 * (i % 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "entity int, pos long, y double, flat double, rare double, x double")
    got = {(r["entity"], r["feature"]): r["correlation"] for r in profiles.target_correlation(df, "y", ["flat", "rare", "x"]).collect()}
    assert got == {(0, "flat"): None, (0, "rare"): pytest.approx(-1.0), (0, "x"): None, (1, "flat"): None, (1, "rare"): None, (1, "x"): None}
    lags = {(r["entity"], r["lag"]): r["correlation"] for r in profiles.autocorrelation(df, "y", [1, 40]).collect()}
    assert lags == {(0, 1): pytest.approx(1.0), (0, 40): None, (1, 1): None, (1, 40): None}


def test_percentiles_by_selection(spark):
    """Of a million distinct values, of ties, of few rows and of a key that is NULL, against sorting."""
    big = spark.range(1_000_000).select(F.lit(1).alias("k"), F.exp(F.randn(3) * 8).alias("v"), F.when(F.rand(5) < 0.9, 7.0).otherwise(F.randn(1)).alias("x"))
    mid = spark.range(9000).select(F.lit(2).alias("k"), (F.col("id") * F.col("id")).cast("double").alias("v"), F.lit(None).cast("double").alias("x"))
    few = spark.createDataFrame([(None, 3.0, 1.0), (None, 1.0, None), (None, 2.0, 1.0), (3, -0.5, 2.0)], "k int, v double, x double")
    df = big.unionByName(mid).unionByName(few)
    points = {"lowest": 0.0, "p10": 0.1, "mid": 0.5, "p85": 0.85, "p999": 0.999, "highest": 1.0}
    got = {(r["k"], r["column"]): r for r in stats.percentiles(df, ["k"], ["v", "x"], points).collect()}
    rows = df.toPandas()
    assert len(got) == 8
    for (k, c), r in got.items():
        values = rows[rows.k.isna() if k is None else rows.k == k][c].dropna().to_numpy()
        assert r["n"] == len(values)
        have = [r[p] for p in points]
        assert have == [None] * 6 if not len(values) else np.allclose(have, np.quantile(values, list(points.values())), rtol=1e-12, atol=0)
    assert stats.percentiles(df.limit(0), ["k"], ["v"], points).count() == 0
    assert stats.quantiles(df.drop("k"), [], "v", {"mid": 0.5}).first()["mid"] == pytest.approx(rows.v.median())


def test_percentiles_hold_no_group(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = stats.describe(df, ["k"], ["v"], {"mid": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" in plan and "percentile(" not in plan and "collect_list" not in plan
