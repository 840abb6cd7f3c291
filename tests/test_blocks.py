import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators.blocks import block_of, blocked_window, carry_forward, ordinal


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(1)
    pdf = pd.concat(
        pd.DataFrame({"entity": e, "pos": np.arange(n), "v": rng.integers(0, 50, n).astype(float)})
        for e, n in ((0, 37), (1, 1), (2, 12))
    )
    shuffled = pdf.sample(frac=1, random_state=2)
    return pdf.reset_index(drop=True), spark.createDataFrame(shuffled).repartition(5)


@pytest.mark.parametrize("span", [3, 5, 16, 4096])
def test_windows_are_the_same_for_every_block_length(series, span):
    pdf, df = series
    out = (
        blocked_window(
            df,
            ["entity"],
            "pos",
            {
                "back3": lambda w: F.lag("v", 3).over(w),
                "ahead2": lambda w: F.lead("v", 2).over(w),
                "mean4": lambda w: F.avg("v").over(w.rowsBetween(-3, 0)),
                "std4": lambda w: F.stddev_samp("v").over(w.rowsBetween(-3, 0)),
            },
            back=3,
            ahead=2,
            span=span,
        )
        .toPandas()
        .sort_values(["entity", "pos"], ignore_index=True)
    )
    g = pdf.groupby("entity")["v"]
    assert len(out) == len(pdf)
    pd.testing.assert_series_equal(out["back3"], g.shift(3), check_names=False)
    pd.testing.assert_series_equal(out["ahead2"], g.shift(-2), check_names=False)
    rolled = g.rolling(4, min_periods=1)
    np.testing.assert_allclose(out["mean4"], rolled.mean().to_numpy())
    np.testing.assert_allclose(out["std4"], rolled.std().to_numpy(), atol=1e-9)


def test_a_block_never_holds_more_than_span_and_halo(series):
    _, df = series
    seen = blocked_window(
        df, ["entity"], "pos",
        {"n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-(2**31), 2**31 - 1))}, back=3, ahead=2, span=6,
    )
    assert seen.agg(F.max("n")).first()[0] <= 6 + 3 + 2


@pytest.mark.parametrize("span", [4, 4096])
def test_ordinal_counts_rows_in_order(spark, span):
    days = [3, 9, 10, 11, 40, 41, 100]
    df = spark.createDataFrame([(e, d) for e in (0, 1) for d in days], "entity int, day long").repartition(4)
    out = ordinal(df, ["entity"], ["day"], block_of(F.col("day"), span)).toPandas()
    for e in (0, 1):
        mine = out[out.entity == e].sort_values("day")
        assert mine["ordinal"].tolist() == list(range(len(days)))
        assert set(mine["n_rows"]) == {len(days)}


@pytest.mark.parametrize("span", [2, 7, 4096])
def test_carry_forward_crosses_empty_blocks(spark, span):
    values = {0: None, 1: 5, 2: None, 9: None, 30: None, 31: 8, 60: None}
    df = spark.createDataFrame([(0, k, v) for k, v in values.items()], "entity int, pos long, v int")
    out = carry_forward(df, ["entity"], ["pos"], {"v": "last_v"}, block_of(F.col("pos"), span))
    got = {r["pos"]: r["last_v"] for r in out.collect()}
    assert got == {0: None, 1: 5, 2: 5, 9: 5, 30: 5, 31: 8, 60: 8}
