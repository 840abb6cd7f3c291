"""Stored models, the end-to-end run, scenario classes, clusters: held against plain recalculation."""

from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.catalog import QUERIES, scoring
from tidepanel.catalog.series import stored_table
from tidepanel.config import CLASS_LABELS, CLUSTERED, LIGHT, WEATHER_PRESETS
from tidepanel.operators import models
from tidepanel.operators.target import fixed_class
from tidepanel.plans import forecast_run as fr

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return stored_table(spark, ROOT)


@pytest.fixture
def few_rounds(monkeypatch):
    monkeypatch.setitem(LIGHT, "rounds", 2)


def small():
    light = {"rounds": 2, "depth": 2, "leaf": 2}
    return {
        "boosted_trees": fr.Estimator([models.boosted_regressor(**light)]),
        "linear": fr.Estimator([models.linear_regressor()]),
        "boosted_classes": fr.Estimator(models.boosted_classifier(**light), classes=True),
    }


def test_fingerprint(spark):
    kinds = "a double, b double, c string"
    rows = [(1.0, None, "x"), (2.0, 3.0, None), (2.0, 3.0, None)]
    df = spark.createDataFrame(rows, kinds)
    base = fr.fingerprint(df)
    assert fr.fingerprint(df.orderBy(F.desc("a")).repartition(3)) == base == fr.fingerprint(df.select("c", "a", "b"))
    others = [rows[:2], [(None, 1.0, "x"), *rows[1:]], [*rows, rows[1]], [(1.0, None, "y"), *rows[1:]], []]
    assert len({base, *[fr.fingerprint(spark.createDataFrame(r, kinds)) for r in others]}) == 6


def test_run_fits_once_and_compares(spark, table, tmp_path, monkeypatch):
    first = fr.forecast_run(table, str(tmp_path), small())
    assert not first.store.reused
    said = {r["model"]: r for r in first.comparison.collect()}
    got = first.predictions.toPandas()
    n = table.filter("split = 'test'").count()
    assert set(got["model"]) == {"boosted_trees", "linear", "arx", "previous_day", "same_day_last_week"}
    assert not got.duplicated(["entity", "dt", "model"]).any()
    for name, g in got.groupby("model"):
        error = (g["acps"] - g["predicted"]).to_numpy(float)
        assert len(g) == n and abs(said[name]["mae"] - np.abs(error).mean()) < 1e-9 and said[name]["accuracy"] is None
        assert abs(said[name]["rmse"] - np.sqrt((error**2).mean())) < 1e-9
        assert abs(said[name]["r2"] - (1 - (error**2).sum() / (g["acps"].var(ddof=0) * n))) < 1e-6
    classed = first.classes.toPandas()
    hits = (classed["congestion_class"] == classed["congestion_pred"]).mean()
    assert abs(said["boosted_classes"]["accuracy"] - hits) < 1e-9 and said["boosted_classes"]["mae"] is None
    # baselines against the table itself, in the order of training then test days
    rows = table.filter("split <> 'valid'").select("entity", "dt", "split", "acps").toPandas().sort_values(["entity", "dt"])
    rows["want"] = rows.groupby("entity")["acps"].shift(7)
    both = got[got["model"] == "same_day_last_week"].merge(rows, on=["entity", "dt"])
    assert len(both) == n and np.allclose(both["predicted"], both["want"])

    def no_fit(*_, **__):
        raise AssertionError("fitted again")

    with monkeypatch.context() as m:
        m.setattr(models, "fit", no_fit)
        m.setattr(fr.arx, "fit", no_fit)
        again = fr.forecast_run(table.repartition(3), str(tmp_path), small())
        assert again.store.reused
        # errors are sums of doubles in another order
        before, after = (r.comparison.toPandas().set_index("model").sort_index() for r in (first, again))
        assert list(before.index) == list(after.index) and np.allclose(before, after, rtol=1e-9, equal_nan=True)
    changed = table.withColumn("acps", F.when(F.col("row_index") == 3, F.col("acps") + 1).otherwise(F.col("acps")))
    asked = {"linear": small()["linear"]}
    features = fr.feature_columns(table)
    fits = [
        fr.fit_or_load(t.filter("split = 'train'"), features, e, str(tmp_path)).reused
        for t, e in (
            (table, asked), (table, {"linear": fr.Estimator([models.linear_regressor()])}), (changed, asked),
            (table, {"linear": fr.Estimator([models.linear_regressor().setRegParam(0.1)])}),
        )
    ]
    assert fits == [False, True, False, False]


def test_broken_off_entry_is_fitted_again(spark, table, tmp_path, monkeypatch):
    train, features = table.filter("split = 'train'"), ["total_movements", "dow"]
    fr.fit_or_load(train, features, {"m": small()["linear"]}, str(tmp_path))
    [entry] = tmp_path.glob("entry-*")
    spark.createDataFrame([], fr.ENTRY).write.mode("overwrite").json(str(entry))
    assert not fr.fit_or_load(train, features, {"m": small()["linear"]}, str(tmp_path)).reused
    assert fr.fit_or_load(train, features, {"m": small()["linear"]}, str(tmp_path)).reused


def test_scenarios_get_score_and_both_classes(spark, few_rounds):
    out = QUERIES["scenario_score"](spark, ROOT).withColumn("cut", fixed_class(F.col("predicted"))).toPandas()
    asked = spark.read.parquet(f"{ROOT}/customer.parquet").count()
    assert len(out) == 2 * asked and not out.duplicated(["scenario_id", "horizon"]).any()
    assert set(out["classifier_class"]) <= set(CLASS_LABELS) and set(out["classification"]) <= set(CLASS_LABELS)
    assert (out["cut"] == out["classification"]).mean() > 0.999  # cut before rounding
    assert out.groupby("scenario_id")["dt"].apply(lambda d: (max(d) - min(d)).days).eq(2).all()
    last = out["predicted"] - out["delta_vs_last"]
    assert last.groupby(out["entity"]).agg(lambda x: x.max() - x.min()).lt(0.03).all()
    assert len(WEATHER_PRESETS) == 4


def test_scenarios_are_dealt_evenly_before_they_are_scored(spark, few_rounds, monkeypatch):
    monkeypatch.setattr(scoring, "SCORED_ROWS", 40, raising=False)
    asked = spark.read.parquet(f"{ROOT}/customer.parquet").count()
    plan = QUERIES["scenario_score"](spark, ROOT)._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index(f"Repartition {-(-2 * asked // 40)}, true")
    assert "UDF(" in plan[:at] and "UDF(" not in plan[at:]  # models read what was dealt


def test_next_days(spark, table, few_rounds):
    out = QUERIES["forecast_3d"](spark, ROOT).toPandas().sort_values(["entity", "dt"])
    days = table.groupBy("entity").agg(F.max("dt").alias("last")).toPandas().set_index("entity")["last"]
    assert set(out["entity"]) == set(days.index) and set(out["classifier_class"]) <= set(CLASS_LABELS)
    for e, g in out.groupby("entity"):
        assert [(d - days[e]).days for d in g["dt"]] == list(g["days_ahead"]) == [1, 2, 3]
    middle = (out["low"] + out["high"]) / 2
    assert (middle - out["predicted"]).abs().max() < 0.02 and (out["high"] > out["low"]).all()
    # the mean of the same weekday and month since 2000, or of the last 30 days, in whole movements
    rows = table.select("entity", "dt", "total_movements").toPandas().sort_values(["entity", "dt"])
    rows["day"] = [(d.weekday(), d.month, d.year >= 2000) for d in rows["dt"]]
    for r in out.itertuples():
        own = rows[rows["entity"] == r.entity]
        same = own[[d == (r.dt.weekday(), r.dt.month, True) for d in own["day"]]]
        assert r.movements_assumed == int((same if len(same) >= 3 else own.tail(30))["total_movements"].mean())


def test_clusters(spark, table, monkeypatch):
    monkeypatch.setattr(models, "best_kmeans", partial(models.best_kmeans, starts=2))
    assigned = QUERIES["kmeans_assign"](spark, ROOT).toPandas()
    rows = table.select("entity", "dt", "congestion_class", *CLUSTERED).toPandas().fillna({c: 0 for c in CLUSTERED})
    both = rows.merge(assigned, on=["entity", "dt"])
    assert len(both) == len(rows) == len(assigned) and set(assigned["cluster"]) == {0, 1, 2}
    x = both[list(CLUSTERED)].astype(float)
    z = ((x - x.groupby(both["entity"]).transform("mean")) / x.groupby(both["entity"]).transform("std").replace(0, 1)).fillna(0).to_numpy()
    centres = np.stack([z[both["cluster"] == k].mean(0) for k in range(3)])
    nearest = ((z[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert (nearest == both["cluster"]).mean() > 0.97
    profile = QUERIES["cluster_profile"](spark, ROOT).toPandas().set_index("cluster")
    for k, g in both.groupby("cluster"):
        for c in CLUSTERED:
            assert abs(profile.loc[str(k), c] - g[c].astype(float).mean()) < 1e-6
        for label in CLASS_LABELS:
            assert profile.loc[str(k), label] == (g["congestion_class"] == label).sum()
    inertia = QUERIES["kmeans_elbow"](spark, ROOT).toPandas().sort_values("k")["inertia"].to_numpy()
    assert len(inertia) == 6 and inertia[-1] < inertia[0] and (np.diff(inertia) < 0.02 * inertia[0]).all()


def test_roundtrip_and_regressors(spark, table, few_rounds):
    out = QUERIES["model_roundtrip"](spark, ROOT).toPandas().set_index("entity")
    want = table.filter("split <> 'train'").groupBy("entity").count().toPandas().set_index("entity")["count"]
    assert out["max_difference"].max() == 0 and out["n"].to_dict() == want.to_dict()
    sizes = table.groupBy("split").count().toPandas().set_index("split")["count"]
    for name in ("gbt_regress", "linear_regress"):
        scores = QUERIES[name](spark, ROOT).toPandas().set_index("split")
        assert scores["n"].to_dict() == {s: sizes[s] for s in ("valid", "test")}
        assert (scores["mae"] <= scores["rmse"] + 1e-12).all()
    # normal equations with medians for what is missing, a column at a time
    train, held = (table.filter(c).toPandas() for c in ("split = 'train'", "split = 'test'"))
    features = fr.feature_columns(table)
    middle = train[features].astype(float).quantile(0.5, interpolation="lower")
    a, b = (np.c_[np.ones(len(p)), p[features].astype(float).fillna(middle).to_numpy()] for p in (train, held))
    beta, *_ = np.linalg.lstsq(a, train["acps"].astype(float), rcond=None)
    mae = np.abs(b @ beta - held["acps"]).mean()
    assert abs(scores.loc["test", "mae"] - mae) < 0.1 * mae + 0.05
