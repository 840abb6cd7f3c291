"""Seasonal autoregression with outside columns, one model per entity.

A fit needs only the sums of products of its columns. Spark adds these up (one pass,
partial sums before the shuffle), so no task ever holds a series; the small system of
each entity is solved in a Pandas batch of one row per entity. All orders of the search
come from the same sums, over the same rows, so their AIC can be compared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.blocks import blocked_window

ORDERS = tuple((p, d, seasonal) for p in (0, 1, 2) for d in (0, 1) for seasonal in (True, False))

FIT_SCHEMA = (
    "entity long, p int, d int, seasonal boolean, n long, sse double, aic double, coefficients array<double>"
)
FORECAST_SCHEMA = "entity long, step int, forecast double"


def columns_of(exog: Sequence[str], max_p: int) -> list[str]:
    return ["_one", *[f"_l{k}" for k in range(1, max_p + 1)], "_ls", *exog, "_y"]


def used(p: int, seasonal: bool, n_exog: int, max_p: int) -> list[int]:
    """Places of an order's regressors among ``columns_of``."""
    return [*range(0, 1 + p), *([max_p + 1] if seasonal else []), *range(max_p + 2, max_p + 2 + n_exog)]


def product_sums(df: DataFrame, target: str, exog: Sequence[str], period: int, max_p: int) -> DataFrame:
    """One row per entity: ``m<d><sample>``, the sums of products for each differencing and sample,
    and ``means`` of target and outside columns.

    Columns are centred by the entity's means first; sums of large values would lose the digits
    that tell rows apart. Sample 1 has the rows with a seasonal lag, sample 0 all rows with the
    short lags; the rows of a sample are the same for every order.
    """
    base = df.select(
        "entity", "pos", F.col(target).cast("double").alias("_v"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in exog],
    )
    means = base.groupBy("entity").agg(F.array(F.avg("_v"), *[F.avg(c) for c in exog]).alias("means"))
    centred = base.join(means, "entity").select(
        "entity", "pos", (F.col("_v") - F.col("means")[0]).alias("_v"),
        *[(F.col(c) - F.col("means")[i]).alias(c) for i, c in enumerate(exog, 1)],
    )
    back = sorted({*range(1, max_p + 2), period, period + 1})
    wide = blocked_window(
        centred, ["entity"], "pos", {f"_v{k}": (lambda w, k=k: F.lag("_v", k).over(w)) for k in back}, back=max(back)
    )
    level = {"_one": F.lit(1.0), "_y": F.col("_v"), "_ls": F.col(f"_v{period}"), **{c: F.col(c) for c in exog}}
    change = {**level, "_y": F.col("_v") - F.col("_v1"), "_ls": F.col(f"_v{period}") - F.col(f"_v{period + 1}")}
    for k in range(1, max_p + 1):
        level[f"_l{k}"], change[f"_l{k}"] = F.col(f"_v{k}"), F.col(f"_v{k}") - F.col(f"_v{k + 1}")
    # rows before the seasonal lag count in sample 0 only, where nothing reads its sums
    samples = (F.lit(True), F.col(f"_v{period + 1}").isNotNull())
    pairs = list(combinations_with_replacement(columns_of(exog, max_p), 2))
    sums = [
        F.array(*[F.sum(F.when(chosen, F.coalesce(form[a] * form[b], F.lit(0.0)))) for a, b in pairs]).alias(f"m{d}{sample}")
        for d, form in enumerate((level, change))
        for sample, chosen in enumerate(samples)
    ]
    return wide.filter(F.col(f"_v{max_p + 1}").isNotNull()).groupBy("entity").agg(*sums).join(means, "entity")


def _matrix(sums, width: int) -> np.ndarray:
    out = np.zeros((width, width))
    out[np.triu_indices(width)] = sums
    return out + np.triu(out, 1).T


def _solve(moments: np.ndarray, at: list[int]) -> tuple[np.ndarray, float]:
    """Least squares from sums of products: coefficients and squared error."""
    xx, xy = moments[np.ix_(at, at)], moments[at, -1]
    scale = np.sqrt(np.where(np.diag(xx) > 0, np.diag(xx), 1.0))
    beta = np.linalg.lstsq(xx / np.outer(scale, scale), xy / scale, rcond=1e-12)[0] / scale
    sse = moments[-1, -1] - 2 * beta @ xy + beta @ xx @ beta
    return beta, max(float(sse), 0.0)


def _uncentred(beta: np.ndarray, p: int, d: int, seasonal: bool, means: Sequence[float]) -> np.ndarray:
    """Coefficients for columns as they are: only the constant changes."""
    lags = p + bool(seasonal)
    outside = beta[1 + lags :] @ np.asarray(means[1:])
    beta[0] += (0.0 if d else means[0] * (1 - beta[1 : 1 + lags].sum())) - outside
    return beta


def fit_orders(
    sums: DataFrame, n_exog: int, orders: Sequence[tuple[int, int, bool]], fallback: bool, max_p: int
) -> DataFrame:
    """Fit every order of every entity. An order with a seasonal lag whose sample is too
    short is left out, or fitted without that lag when ``fallback`` is set. An order without a
    positive error has no likelihood to compare and is left out of a search."""
    if max(p for p, _, _ in orders) > max_p:
        raise ValueError(f"an order asks for more than {max_p} lags")
    width = max_p + 3 + n_exog

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                for p, d, seasonal in orders:
                    # one common sample per entity: the seasonal one where it is long enough
                    long = getattr(row, f"m{d}1")
                    if long[0] is not None and np.isfinite(long[0]) and long[0] > width + 1:
                        moments = _matrix(long, width)
                    elif seasonal and not fallback:
                        continue
                    else:
                        seasonal, moments = False, _matrix(getattr(row, f"m{d}0"), width)
                    at = used(p, seasonal, n_exog, max_p)
                    n = int(moments[0, 0])
                    if n <= len(at):
                        continue
                    beta, sse = _solve(moments, at)
                    if sse <= 0 and not fallback:
                        continue
                    aic = n * np.log(sse / n) + 2 * (len(at) + 1) if sse > 0 else -np.inf
                    beta = _uncentred(beta, p, d, seasonal, row.means)
                    out.append((row.entity, p, d, seasonal, n, sse, aic, beta.tolist()))
            yield pd.DataFrame(
                out, columns=["entity", "p", "d", "seasonal", "n", "sse", "aic", "coefficients"]
            )

    return sums.withColumn("entity", F.col("entity").cast("long")).mapInPandas(solve, FIT_SCHEMA)


def fit(
    df: DataFrame, target: str, exog: Sequence[str], order: tuple[int, int] = (1, 0), period: int = 7
) -> DataFrame:
    """One order with its seasonal lag; without it where the series is too short."""
    max_p = max(order[0], 2)
    sums = product_sums(df, target, exog, period, max_p)
    return fit_orders(sums, len(exog), [(order[0], order[1], True)], True, max_p)


def search(
    df: DataFrame, target: str, exog: Sequence[str], period: int = 7, orders: Sequence[tuple[int, int, bool]] = ORDERS
) -> tuple[DataFrame, DataFrame]:
    """All orders with their AIC, and the best order of each entity."""
    max_p = max(1, *(p for p, _, _ in orders))
    fits = fit_orders(product_sums(df, target, exog, period, max_p), len(exog), orders, False, max_p)
    columns = [c for c in fits.columns if c != "entity"]
    best = fits.groupBy("entity").agg(
        F.min_by(F.struct(*columns), F.struct("aic", "p", "d", F.col("seasonal"))).alias("b")
    ).select("entity", "b.*")
    return fits, best


def forecast(
    fits: DataFrame, history: DataFrame, future: DataFrame, target: str, exog: Sequence[str], period: int = 7,
    keep: int = 12,
) -> DataFrame:
    """Steps ahead, each fed by the ones before.

    ``history`` has ``pos`` and ``n_steps``; only its last ``period + keep`` rows are read, and no order may
    have more lags than those. The horizon is what ``future`` holds: one list per entity.
    ``future`` has ``entity, step`` from 1 and the outside columns.
    """
    keep += period
    tail = (
        history.filter(F.col("n_steps") - F.col("pos") <= keep)
        .groupBy("entity")
        .agg(F.array_sort(F.collect_list(F.struct("pos", F.col(target).cast("double").alias("v")))).alias("t"))
        .select("entity", F.transform("t", lambda r: r["v"]).alias("tail"))
    )
    ahead = future.groupBy("entity").agg(
        F.array_sort(
            F.collect_list(
                F.struct("step", F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in exog]).alias("x"))
            )
        ).alias("s")
    ).select("entity", F.transform("s", lambda r: r["x"]).alias("ahead"))
    rows = fits.join(tail, "entity").join(ahead, "entity")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                level = list(row.tail)
                beta = np.asarray(row.coefficients)
                for step, x in enumerate(row.ahead, start=1):
                    z = np.diff(level) if row.d else np.asarray(level)
                    v = [1.0, *[z[-k] for k in range(1, row.p + 1)]]
                    if row.seasonal:
                        v.append(z[-period])
                    value = float(beta @ np.asarray([*v, *x]))
                    level.append(level[-1] + value if row.d else value)
                    out.append((row.entity, step, level[-1]))
            yield pd.DataFrame(out, columns=["entity", "step", "forecast"])

    return rows.mapInPandas(run, FORECAST_SCHEMA)
