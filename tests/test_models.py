import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import arx, models, scoring


@pytest.fixture(scope="module")
def walk(spark):
    rng = np.random.default_rng(11)
    n, parts = 240, []
    for e in (0, 1):
        x = rng.normal(size=(n, 2))
        y = np.zeros(n)
        for t in range(n):
            base = 0.5 * y[t - 1] + 0.3 * y[t - 7] if t >= 7 else 0.0
            y[t] = 3 + base + 0.8 * x[t, 0] + rng.normal(scale=0.1)
        parts.append(pd.DataFrame({"entity": e, "pos": np.arange(n), "n_steps": n, "y": y, "a": x[:, 0], "b": x[:, 1]}))
    pdf = pd.concat(parts, ignore_index=True)
    return pdf, spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(4)


def design(v, p, seasonal, exog, start):
    cols = [np.ones(len(v)), *[np.roll(v, k) for k in range(1, p + 1)]]
    if seasonal:
        cols.append(np.roll(v, 7))
    return np.column_stack([*cols, exog])[start:]


def test_fit_from_product_sums_equals_least_squares(walk):
    pdf, df = walk
    got = {r["entity"]: r for r in arx.fit(df, "y", ["a", "b"]).collect()}
    for e in (0, 1):
        s = pdf[pdf.entity == e]
        x = design(s.y.to_numpy(), 1, True, s[["a", "b"]].to_numpy(), 8)
        beta, sse, *_ = np.linalg.lstsq(x, s.y.to_numpy()[8:], rcond=None)
        np.testing.assert_allclose(got[e]["coefficients"], beta, rtol=1e-6, atol=1e-8)
        assert abs(got[e]["sse"] - sse[0]) < 1e-6 and got[e]["n"] == 232 and got[e]["seasonal"]


def test_search_uses_one_sample_and_finds_the_seasonal_order(walk):
    _, df = walk
    fits, best = arx.search(df, "y", ["a", "b"])
    assert {r["n"] for r in fits.collect()} == {232} and fits.count() == 24
    assert all(r["seasonal"] and r["p"] >= 1 and r["d"] == 0 for r in best.collect())


@pytest.mark.parametrize("d", [0, 1])
def test_forecast_feeds_on_its_own_steps(walk, spark, d):
    pdf, df = walk
    fits = arx.fit(df, "y", ["a", "b"], (2, d))
    future = spark.createDataFrame([(e, s, 0.1 * s, 0.0) for e in (0, 1) for s in (1, 2, 3)], "entity int, step int, a double, b double")
    got = {(r["entity"], r["step"]): r["forecast"] for r in arx.forecast(fits, df, future, "y", ["a", "b"]).collect()}
    for r in fits.collect():
        level = pdf[pdf.entity == r["entity"]].y.tolist()
        for s in (1, 2, 3):
            z = np.diff(level) if d else np.array(level)
            v = np.dot(r["coefficients"], [1, z[-1], z[-2], z[-7], 0.1 * s, 0.0])
            level.append(level[-1] + v if d else v)
            assert abs(got[(r["entity"], s)] - level[-1]) < 1e-8


def test_short_series_is_fitted_without_the_seasonal_lag(spark):
    v = [float(x) for x in (1, 2, 1, 3, 2, 4, 3, 5, 4, 6, 5, 7)]
    df = spark.createDataFrame([(0, i, len(v), x) for i, x in enumerate(v)], "entity int, pos long, n_steps int, y double")
    r = arx.fit(df, "y", []).first()
    assert not r["seasonal"] and r["n"] == len(v) - 3 and len(r["coefficients"]) == 2


def test_permutation_importance_ranks_what_matters(spark):
    rng = np.random.default_rng(0)
    n = 600
    x = rng.normal(size=(n, 3))
    pdf = pd.DataFrame(x, columns=["strong", "weak", "none"])
    pdf["acps"] = 5 * pdf.strong + 1 * pdf.weak + rng.normal(scale=0.1, size=n)
    pdf["entity"] = np.arange(n) % 3
    pdf["dt"] = [dt.date(2020, 1, 1) + dt.timedelta(days=int(i)) for i in np.arange(n) // 3]
    df = spark.createDataFrame(pdf)
    features = ["strong", "weak", "none"]
    model = models.fit(df, features, [models.linear_regressor()])
    got = [(r["feature"], r["importance"]) for r in models.permutation_importance(model, df, features, "dt", 3).collect()]
    assert [f for f, _ in got] == features
    # shuffling a column of a linear model costs about twice its share of the variance
    assert abs(got[0][1] - 2 * 25 / 26) < 0.3 and abs(got[2][1]) < 0.01


def test_history_features_for_dates_inside_and_after_the_history(spark):
    n = 60
    rng = np.random.default_rng(4)
    start = pd.Timestamp("2021-01-01")
    pdf = pd.DataFrame({"entity": 0, "pos": range(n), "acps": rng.random(n).round(6), "total_movements": rng.integers(1, 9, n)})
    pdf["dt"] = [(start + pd.Timedelta(days=i)).date() for i in range(n)]
    asked_days = [40, n, n + 2, n + 100]
    asked = spark.createDataFrame([(0, (start + pd.Timedelta(days=i)).date()) for i in asked_days], "entity int, dt date")
    out = scoring.history_features(asked, spark.createDataFrame(pdf)).toPandas().sort_values("dt")
    for i, (_, row) in zip(asked_days, out.iterrows()):
        before = pdf[pdf.pos < i]
        for k in (1, 2, 3, 7, 14, 28):
            exact = before[before.pos == i - k].acps
            want = exact.iloc[0] if len(exact) else before.acps.iloc[-1]
            assert row[f"acps_lag_{k}d"] == want
        assert abs(row["acps_lag_365d"] - before.acps.tail(30).mean()) < 1e-12
        week = before[before.pos >= i - 7].total_movements
        np.testing.assert_allclose(row["movements_rmean_7d"], week.mean() if len(week) else np.nan)


def test_unknown_preset_counts_as_clear(spark):
    df = spark.createDataFrame([("storm",), ("fog",)], "preset string")
    got = {r["preset"]: r["wind_gusts_10m"] for r in scoring.with_preset(df).collect()}
    assert got == {"storm": 85.0, "fog": 18.0}
    assert scoring.preset_table(spark).filter(F.col("is_raining") == 1).count() == 2


def test_any_number_of_lags(spark):
    rng = np.random.default_rng(3)
    y = np.zeros(400)
    for t in range(3, 400):
        y[t] = 0.4 * y[t - 1] - 0.3 * y[t - 2] + 0.25 * y[t - 3] + rng.normal()
    df = spark.createDataFrame([(0, i, len(y), float(v)) for i, v in enumerate(y)], "entity int, pos long, n_steps int, y double")
    r = arx.fit(df, "y", [], (3, 0)).first()
    beta = np.linalg.lstsq(design(y, 3, True, np.empty((len(y), 0)), 8), y[8:], rcond=None)[0]
    np.testing.assert_allclose(r["coefficients"], beta, rtol=1e-6, atol=1e-8)
    with pytest.raises(ValueError):
        arx.fit_orders(arx.product_sums(df, "y", [], 7, 2), 0, [(3, 0, True)], True, 2)


def test_large_level_and_small_spread(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=300), np.zeros(300)
    for t in range(1, 300):
        y[t] = 0.5 * y[t - 1] + 0.7 * x[t] + rng.normal(scale=0.3)
    fits = []
    for level in (0.0, 1e6):
        rows = [(0, i, 300, float(v) + level, float(a)) for i, (v, a) in enumerate(zip(y, x))]
        df = spark.createDataFrame(rows, "entity int, pos long, n_steps int, y double, a double")
        fits.append(arx.fit(df, "y", ["a"]).first())
    np.testing.assert_allclose(fits[1]["coefficients"][1:], fits[0]["coefficients"][1:], rtol=1e-5, atol=1e-7)
    assert abs(fits[1]["sse"] / fits[0]["sse"] - 1) < 1e-5


@pytest.mark.parametrize("kind", ["boosted", "perceptron"])
def test_class_models_score_rows_without_a_class(spark, kind):
    rows = [(float(i % 9), float(i % 4), ("Low", "Medium", "High")[i % 9 // 3]) for i in range(180)]
    train = spark.createDataFrame([*rows, (1.0, 1.0, None)], "a double, b double, congestion_class string")
    stages = models.boosted_classifier(rounds=3, depth=2, leaf=1) if kind == "boosted" else models.perceptron(2, (4,), 100)
    model = models.fit(models.labelled(train), ["a", "b"], stages, kind == "perceptron")
    new = spark.createDataFrame([(0.0, 1.0, None), (8.0, 1.0, "Low"), (4.0, None, "other")], "a double, b double, congestion_class string")
    out = [r["congestion_pred"] for r in model.transform(new).collect()]
    assert len(out) == 3 and set(out) <= {"Low", "Medium", "High"} and out[0] == "Low"
