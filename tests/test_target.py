import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepanel.operators import target


def expected(totals: np.ndarray, dow: np.ndarray) -> np.ndarray:
    s = pd.DataFrame({"t": totals.astype(float), "d": dow})
    ratio = s.t / np.maximum(1.0, s.groupby("d").t.transform("median"))

    def z(x):
        sd = x.std()
        return (x - x.mean()) / sd if sd > 0 else x * 0.0

    raw = 0.6 * z(s.t) + 0.4 * z(ratio)
    if raw.max() == raw.min():
        return np.full(len(s), 50.0)
    return ((raw - raw.min()) / (raw.max() - raw.min()) * 100).round(6).to_numpy()


def scored(spark, series: dict[int, list[int]], columns=("acps",), **kw):
    data = [(e, i, i % 7, v) for e, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "entity int, pos long, dow int, total_movements long").repartition(3)
    return target.attach_score(df, ("dow",), columns, **kw).toPandas().sort_values(["entity", "pos"])


def test_score_equals_the_plain_formula(spark):
    rng = np.random.default_rng(3)
    series = {e: rng.integers(0, 30, n).tolist() for e, n in ((0, 200), (1, 61))}
    got = scored(spark, series)
    for e, v in series.items():
        want = expected(np.array(v), np.arange(len(v)) % 7)
        np.testing.assert_allclose(got[got.entity == e].acps, want, atol=2e-6)


@pytest.mark.parametrize("series", [[4] * 20, [0] * 20, [7]])
def test_flat_or_single_row_series_score_50(spark, series):
    assert set(scored(spark, {0: series}).acps) == {50.0}


def test_phase_median_of_zero_is_guarded(spark):
    out = scored(spark, {0: [0] * 14 + [3]}, ("phase_median", "pressure_ratio"))
    last = out.iloc[-1]
    assert last.phase_median == 0 and last.pressure_ratio == 3


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 60), min_size=2, max_size=40))
def test_score_stays_in_range_and_classes_cover_all_rows(spark, values):
    out = scored(spark, {0: values}, ("acps", "congestion_class", "congestion_binary", "p60", "p85"))
    assert out.acps.between(0, 100).all()
    assert out.congestion_class.isin(["Low", "Medium", "High"]).all()
    assert ((out.acps >= out.p60).astype(int) == out.congestion_binary).all()


def test_a_score_on_a_cut_belongs_below_it(spark):
    df = spark.createDataFrame([(60.0,), (60.1,), (85.0,), (85.1,)], "v double")
    got = df.select(target.percentile_class(F.col("v"), F.lit(60.0), F.lit(85.0)).alias("c"))
    assert [r.c for r in got.collect()] == ["Low", "Medium", "Medium", "High"]
    fixed = df.selectExpr("v + 5 AS v").select(target.fixed_class(F.col("v")).alias("c"))
    assert [r.c for r in fixed.collect()] == ["Medium", "Medium", "High", "High"]


def test_statistics_can_be_learnt_on_training_rows_only(spark):
    values = [5, 9, 2, 7, 6, 8, 3] * 6 + [60] * 7
    got = scored(spark, {0: values}, fit=F.col("pos") < 42)
    alone = scored(spark, {0: values[:42]})
    np.testing.assert_allclose(got.acps[:42], alone.acps, atol=1e-6)
    assert (got.acps[42:] > 100).all()


def test_quantile_edges_drop_repeats_and_close_the_lowest_bin(spark):
    df = spark.createDataFrame([(0, float(v)) for v in [1] * 6 + [2, 3, 4, 5]], "entity int, v double")
    edges = target.quantile_edges(df, ["entity"], "v", 5).first()["edges"]
    np.testing.assert_allclose(edges, sorted(set(np.quantile([1] * 6 + [2, 3, 4, 5], np.linspace(0, 1, 6)))))
    probe = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (5.0,), (6.0,)], "v double")
    e = F.array(*[F.lit(x) for x in edges])
    got = [r.b for r in probe.select(target.bin_by_edges(F.col("v"), e).alias("b")).collect()]
    want = pd.cut([0.5, 1.0, 2.0, 5.0, 6.0], edges, labels=False, include_lowest=True)
    assert [None if np.isnan(w) else int(w) for w in want] == got
