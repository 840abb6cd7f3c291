"""Moving-average terms: known coefficients come back, and forecasts gain by them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import arma, arx


@pytest.fixture(scope="module")
def series(spark):
    """Two entities: y = 5 + 0.6 y1 + 0.4 x + e + 0.7 e1, and one whose errors count a week later."""
    rng = np.random.default_rng(3)
    rows = []
    for entity in (0, 1):
        y, e = [12.0] * 7, [0.0] * 7
        x = rng.normal(3, 1, 4000)
        for t in range(7, 4000):
            new = rng.normal()
            if entity == 0:
                y.append(5 + 0.6 * y[-1] + 0.4 * x[t] + new + 0.7 * e[-1])
            else:
                y.append(5 + 0.3 * y[-1] + 0.4 * x[t] + new + 0.8 * e[-7])
            e.append(new)
        rows += [(entity, t, 4000, float(y[t]), float(x[t])) for t in range(4000)]
    return spark.createDataFrame(rows, "entity int, pos long, n_steps long, y double, x double").repartition(5).cache()


def test_known_coefficients(series):
    fits, _ = arma.fit_orders(series, "y", ["x"], [arma.Order(1, 0, 1, False, False), arma.Order(1, 0, 0, False, True)], long=56)
    got = {(r["entity"], r["q"]): r["coefficients"] for r in fits.collect()}
    assert got[0, 1] == pytest.approx([5, 0.6, 0.7, 0.4], abs=0.25) and got[0, 1][1:] == pytest.approx([0.6, 0.7, 0.4], abs=0.06)
    assert got[1, 0][1:] == pytest.approx([0.3, 0.8, 0.4], abs=0.06)


def test_search_has_error_terms_and_beats_the_autoregression(series):
    train = series.where("pos < 3500").withColumn("n_steps", F.lit(3500))
    orders = [arma.Order(p, d, q, False, sq) for p in (0, 1) for d in (0, 1) for q in (0, 1) for sq in (False, True)]
    fits, best, residuals = arma.search(train, "y", ["x"], orders=orders)
    chosen = {r["entity"]: r for r in best.collect()}
    assert fits.count() == 32 and (chosen[0]["d"], chosen[0]["q"]) == (0, 1) and chosen[1]["seasonal_q"]
    plain, residual_rows = arma.fit_orders(train, "y", ["x"], [arma.Order(1, 0, 0, False, False)])
    errors = {r["entity"]: (r["sse"], r["n"]) for r in plain.collect()}
    for e, r in chosen.items():
        assert r["sse"] / r["n"] < 0.85 * errors[e][0] / errors[e][1]
    future = series.where("pos >= 3500 AND pos < 3507").withColumn("step", (F.col("pos") - 3499).cast("int"))
    first = {}
    for name, (f, res) in {"with": (best, residuals), "without": (plain, residual_rows)}.items():
        first[name] = {(r["entity"], r["step"]): r["forecast"] for r in arma.forecast(f, res, train, future, "y", ["x"]).collect()}
        assert len(first[name]) == 14
    # with the weekly errors known, a week ahead is closer
    truth = {r["step"]: r["y"] for r in future.where("entity = 1").collect()}
    gap = {n: np.mean([(v[1, s] - truth[s]) ** 2 for s in truth]) for n, v in first.items()}
    assert gap["with"] < gap["without"]


def test_without_error_terms_it_is_least_squares(series):
    fits, _ = arma.fit_orders(series, "y", ["x"], [arma.Order(1, 0, 0, True, False)], long=3)
    plain = {r["entity"]: r["coefficients"] for r in arx.fit(series, "y", ["x"]).collect()}
    for r in fits.collect():
        assert r["coefficients"] == pytest.approx(plain[r["entity"]], abs=0.02)


def test_short_series_lack_the_order(spark):
    df = spark.createDataFrame([(0, i, 12, float(i % 3)) for i in range(12)], "entity int, pos long, n_steps long, y double")
    assert arma.fit_orders(df, "y", [], [arma.Order()])[0].count() == 0
