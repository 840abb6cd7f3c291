import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS
from tidepanel.operators import baselines, lookups, windows


def series(spark, n, entity=0, seed=0):
    v = np.random.default_rng(seed).integers(1, 40, n).astype(float)
    start = pd.Timestamp("2020-01-01")
    pdf = pd.DataFrame(
        {
            "entity": entity, "pos": np.arange(n), "n_steps": n, "acps": v,
            "total_movements": v.astype(int), "dt": [(start + pd.Timedelta(days=i)).date() for i in range(n)],
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(3)


@pytest.mark.parametrize("n", [1, 5, 30, 400])
def test_short_series_lose_only_their_feasible_warmup(spark, n):
    pdf, df = series(spark, n)
    full = windows.daily_window_features(df)
    lags = {f"{x}_lag_{k}d": k for k in (1, 2, 3, 7, 14, 28) for x in ("acps", "movements")}
    kept = windows.drop_infeasible(full, lags, ["acps_rmean_7d", "acps_rstd_28d"])
    lost = max([k for k in (1, 2, 3, 7, 14, 28) if k < n], default=1)
    assert sorted(r["pos"] for r in kept.select("pos").collect()) == list(range(max(lost, 1), n))


@pytest.mark.parametrize("n", [40, 400])
def test_split_without_ranking_equals_the_ranked_one(spark, n):
    _, df = series(spark, n)
    lags = (1, 2, 3, 7, 14, 28)
    kept = df.filter("pos >= 28")
    a = windows.split_after_warmup(kept, lags).select("pos", "split", "row_index", "n_rows")
    b = windows.chrono_split(kept, "dt").select("pos", "split", "row_index", "n_rows")
    assert sorted(a.collect()) == sorted(b.collect())
    m = n - 28
    counts = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    assert counts["train"] == int(m * 0.70) and counts["train"] + counts["valid"] == int(m * 0.85)


def test_rolling_with_one_row_is_the_row_itself(spark):
    pdf, df = series(spark, 20)
    out = windows.with_windows(df, windows.trailing_columns("acps", "x", (1,), (), "d", 6), 1).toPandas()
    assert (out["x_rmean_1d"] == out["acps"]).all()


def reference_decompose(x, period):
    half = period // 2
    w = np.r_[0.5, np.ones(period - 1), 0.5] / period if period % 2 == 0 else np.ones(period) / period
    trend = np.full(len(x), np.nan)
    trend[half : len(x) - half] = np.convolve(x, w, "valid")
    means = np.array([np.nanmean((x - trend)[i::period]) for i in range(period)])
    seasonal = np.resize(means - means.mean(), len(x))
    return trend, seasonal, x - trend - seasonal


@pytest.mark.parametrize("period", [7, 24])
def test_decomposition(spark, period):
    pdf, df = series(spark, 100, seed=5)
    out = windows.seasonal_decompose(df, "acps", period).toPandas().sort_values("pos")
    for name, want in zip(("trend", "seasonal", "remainder"), reference_decompose(pdf.acps.to_numpy(), period)):
        np.testing.assert_allclose(out[name].to_numpy(dtype=float), want, atol=1e-9)


def test_no_trend_below_two_periods(spark):
    _, df = series(spark, 40)
    assert windows.seasonal_decompose(df, "acps", 24).filter("trend IS NOT NULL").count() == 0


@pytest.mark.parametrize("n,width", [(3, 1), (5, 2), (9, 3)])
def test_centred_mean_of_a_short_series(spark, n, width):
    pdf, df = series(spark, n)
    got = windows.centered_mean(df, "acps", "m").toPandas().sort_values("pos")["m"].to_numpy(dtype=float)
    want = pdf.acps.rolling(width, center=True).mean() if width >= 2 else np.full(n, np.nan)
    np.testing.assert_allclose(got, want)


def test_lags_by_date_fall_back_over_gaps(spark):
    days = [0, 1, 5, 6, 30, 400, 430]
    pdf = pd.DataFrame({"day": days, "total_movements": [10.0, 20, 30, 40, 50, 60, 70]})
    start = pd.Timestamp("2019-01-01")
    df = spark.createDataFrame(
        [(0, (start + pd.Timedelta(days=d)).date(), v) for d, v in zip(pdf.day, pdf.total_movements)],
        "entity int, dt date, total_movements double",
    )
    got = lookups.lag_by_date(df, ["entity"], "dt", "total_movements", (1, 7)).toPandas().sort_values("dt")
    by_day = dict(zip(pdf.day, pdf.total_movements))
    for i, d in enumerate(days):
        row = got.iloc[i]
        prev = pdf.total_movements[i - 1] if i else np.nan
        np.testing.assert_equal(row["total_movements_lag_1d"], by_day.get(d - 1, prev))
        np.testing.assert_equal(row["total_movements_lag_7d"], by_day.get(d - 7, prev))
        mean30 = pdf.total_movements[:i].tail(30).mean()
        np.testing.assert_equal(row["total_movements_lag_365d"], by_day.get(d - 365, mean30))


def test_first_test_row_takes_the_last_training_value(spark):
    pdf, df = series(spark, 40)
    s = baselines.train_then_test(df)
    out = baselines.offset_baselines(s, "acps", {"prev": 1, "far": 35}).toPandas().sort_values("pos")
    train, test = pdf[:28], pdf[34:]
    joined = pd.concat([train, test]).acps.reset_index(drop=True)
    assert out["prev"].tolist() == joined.shift(1)[28:].tolist()
    assert out["far"].tolist() == [train.acps.mean()] * 6
    assert DEFAULTS.train_share == 0.70


def test_majority_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([(0, "Medium"), (0, "Low"), (0, "Low"), (0, "Medium"), (1, "High")], "entity int, c string")
    got = {r["entity"]: r["majority"] for r in baselines.majority(df, "c").collect()}
    assert got == {0: "Low", 1: "High"}


def test_asof_takes_rows_strictly_before(spark):
    h = spark.createDataFrame([(0, 10, 1), (0, 20, 2), (1, 5, 9)], "entity int, s long, v int").select(
        "entity", F.timestamp_seconds(F.col("s") * 100000).alias("t"), "v"
    )
    a = spark.createDataFrame([(0, 10, "x"), (0, 11, "y"), (0, 90000, "z"), (2, 10, "w")], "entity int, s long, id string").select(
        "entity", F.timestamp_seconds(F.col("s") * 100000).alias("t"), "id"
    )
    got = {r["id"]: r["asof_v"] for r in lookups.asof_before(a, h, ["entity"], "t", ["v"], 60).collect()}
    assert got == {"x": None, "y": 1, "z": 2, "w": None}
