"""Seasonal autoregression with moving-average terms and outside columns, one model per entity.

Two stages of least squares. A long autoregression of each entity, with the outside columns, gives its
residuals, which stand for the unseen errors. The series is then regressed on its own lags, on lags of these residuals
and on the outside columns. Both stages need sums of products only, which Spark adds up in one pass each;
residuals and lags are columns made in blocks, so no task holds a series. The small systems are
solved in Pandas batches of one row per entity.

This estimates from sums; it does not maximise the likelihood of a state-space form.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement, product
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.arx import _matrix, _solve
from tidepanel.operators.blocks import blocked_window
from tidepanel.session import materialize


class Order(NamedTuple):
    """Lags of the series, differencing (0 or 1), lags of the errors, and whether each has a seasonal one too."""

    p: int = 1
    d: int = 0
    q: int = 1
    seasonal: bool = True
    seasonal_q: bool = True


ORDERS = tuple(Order(p, d, q, s, sq) for p, d, q, s, sq in product((0, 1, 2), (0, 1), (0, 1), (True, False), (True, False)) if s or not sq)

FIT_SCHEMA = (
    "entity long, p int, d int, q int, seasonal boolean, seasonal_q boolean, n long, sse double, aic double, "
    "coefficients array<double>"
)


def _product_sums(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """``entity, sums``: sums of products of all pairs of the columns, the upper triangle row by row."""
    cells = [F.col(c) if isinstance(c, str) else c for c in columns]
    return df.groupBy("entity").agg(F.array(*[F.sum(a * b) for a, b in combinations_with_replacement(cells, 2)]).alias("sums"))


def long_residuals(df: DataFrame, lags: int, exog: Sequence[str] = (), period: int = 7) -> DataFrame:
    """``df`` (``entity, pos, _v`` and outside columns) from position ``lags`` on, with ``_e``: what a least-squares
    regression of ``_v`` on ``lags`` of its own lags and on the outside columns now, one and two rows and one and two periods ago leaves."""
    source = {f"_a{k}": ("_v", k) for k in range(1, lags + 1)}
    source |= {f"_x{i}_{k}": (c, k) for i, c in enumerate(exog) for k in sorted({1, 2, period, 2 * period}) if k <= lags}
    made = {n: (lambda w, c=c, k=k: F.lag(c, k).over(w)) for n, (c, k) in source.items()}
    wide = blocked_window(df, ["entity"], "pos", made, back=lags).where(F.col(f"_a{lags}").isNotNull())
    names = [*source, *exog]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            betas = [_solve(_matrix(s, len(names) + 2), list(range(len(names) + 1)))[0].tolist() for s in batch["sums"]]
            yield pd.DataFrame({"entity": batch["entity"], "_beta": betas})

    sums = _product_sums(wide, [F.lit(1.0), *names, "_v"]).withColumn("entity", F.col("entity").cast("long"))
    betas = sums.mapInPandas(solve, "entity long, _beta array<double>")
    fitted = F.aggregate(F.zip_with(F.array(F.lit(1.0), *names), "_beta", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return wide.join(betas, "entity").withColumn("_e", F.col("_v") - fitted).drop("_beta", *source)


def _prepared(df: DataFrame, target: str, exog: Sequence[str], d: int, period: int, long: int) -> tuple[DataFrame, DataFrame]:
    """The series of one differencing with its residuals, and the means it was centred by."""
    base = df.select("entity", "pos", F.col(target).cast("double").alias("_v"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in exog])
    means = base.groupBy("entity").agg(F.array(F.avg("_v"), *[F.avg(c) for c in exog]).alias("means"))
    centred = base.join(means, "entity").select(
        "entity", "pos", (F.col("_v") - F.col("means")[0]).alias("_v"), *[(F.col(c) - F.col("means")[i]).alias(c) for i, c in enumerate(exog, 1)]
    )
    if d:
        moved = blocked_window(centred, ["entity"], "pos", {"_before": lambda w: F.lag("_v", 1).over(w)}, back=1)
        centred = moved.where("_before IS NOT NULL").withColumn("_v", F.col("_v") - F.col("_before")).drop("_before")
    return long_residuals(centred, long, exog, period), means


def _places(o: Order, max_p: int, max_q: int, n_exog: int) -> list[int]:
    """Places of an order's regressors among 1, lags, seasonal lag, error lags, seasonal error lag, outside columns."""
    return [
        *range(0, 1 + o.p), *([max_p + 1] if o.seasonal else []), *range(max_p + 2, max_p + 2 + o.q),
        *([max_p + max_q + 2] if o.seasonal_q else []), *range(max_p + max_q + 3, max_p + max_q + 3 + n_exog),
    ]


def fit_orders(
    df: DataFrame, target: str, exog: Sequence[str], orders: Sequence[Order], period: int = 7, long: int | None = None
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """Every order of every entity (``FIT_SCHEMA``), and the stored residuals (``entity, pos, _e``) for each differencing.

    ``df`` has ``entity, pos`` (gap-free) and the columns. The long autoregression has ``long`` lags, three periods
    unless given; strong seasonal error terms, whose weights die out slowly, need more to come out unbiased. All orders are fitted on the same rows of an entity, those that have every lag, so their AIC can
    be compared. Entities with too few rows for an order lack that order. Coefficients are for columns as they are:
    the constant, lags, seasonal lag, error lags, seasonal error lag, outside columns.
    """
    long = long or 3 * period
    max_p, max_q, n_exog = max(o.p for o in orders), max(o.q for o in orders), len(exog)
    width = max_p + max_q + 4 + n_exog
    first = long + period + max(max_p, max_q) + 1
    out, residuals = [], {}
    for d in sorted({o.d for o in orders}):
        rows, means = _prepared(df, target, exog, d, period, long)
        rows = residuals[d] = materialize(rows, "arma-residuals")
        lags = {f"_l{k}": ("_v", k) for k in range(1, max_p + 1)} | {"_ls": ("_v", period)}
        lags |= {f"_m{k}": ("_e", k) for k in range(1, max_q + 1)} | {"_ms": ("_e", period)}
        made = {n: (lambda w, c=c, k=k: F.lag(c, k).over(w)) for n, (c, k) in lags.items()}
        wide = blocked_window(rows, ["entity"], "pos", made, back=max(period, max_p, max_q)).where(F.col("pos") >= first)
        sums = _product_sums(wide, [F.lit(1.0), *lags, *exog, "_v"]).join(means, "entity")
        chosen = [o for o in orders if o.d == d]

        def solve(batches: Iterator[pd.DataFrame], chosen=chosen) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = []
                for row in batch.itertuples(index=False):
                    moments = _matrix(row.sums, width)
                    n = int(moments[0, 0])
                    for o in chosen:
                        at = _places(o, max_p, max_q, n_exog)
                        if n <= len(at) + 1:
                            continue
                        beta, sse = _solve(moments, at)
                        aic = n * np.log(sse / n) + 2 * (len(at) + 1) if sse > 0 else -np.inf
                        own = o.p + o.seasonal
                        if not o.d:
                            beta[0] += row.means[0] * (1 - beta[1 : 1 + own].sum())
                        beta[0] -= beta[len(at) - n_exog :] @ np.asarray(row.means[1:]) if n_exog else 0.0
                        found.append((row.entity, *o, n, sse, aic, beta.tolist()))
                yield pd.DataFrame(found, columns=["entity", *Order._fields, "n", "sse", "aic", "coefficients"])

        out.append(sums.withColumn("entity", F.col("entity").cast("long")).mapInPandas(solve, FIT_SCHEMA))
    fits = out[0]
    for more in out[1:]:
        fits = fits.unionByName(more)
    return fits, {d: r.select("entity", "pos", "_e") for d, r in residuals.items()}


def search(
    df: DataFrame, target: str, exog: Sequence[str], period: int = 7, orders: Sequence[Order] = ORDERS
) -> tuple[DataFrame, DataFrame, dict[int, DataFrame]]:
    """All orders with their AIC, the best order of each entity, and the residuals."""
    fits, residuals = fit_orders(df, target, exog, orders, period)
    fits = materialize(fits, "arma-fits")
    columns = [c for c in fits.columns if c != "entity"]
    best = fits.groupBy("entity").agg(F.min_by(F.struct(*columns), F.struct("aic", *Order._fields)).alias("b"))
    return fits, best.select("entity", "b.*"), residuals


def forecast(
    fits: DataFrame, residuals: dict[int, DataFrame], history: DataFrame, future: DataFrame, target: str, exog: Sequence[str], period: int = 7, keep: int = 12
) -> DataFrame:
    """``entity, step, forecast``: steps ahead, each fed by the ones before; errors to come are 0.

    ``fits`` has one order for each entity. Of ``history`` (``pos, n_steps``) and the residuals the last ``period + keep`` rows
    are read; no order may have more lags. The horizon is what ``future`` (``entity, step`` from 1, outside columns) holds.
    """
    keep += period
    last = history.where(F.col("n_steps") - F.col("pos") <= keep)
    errors = None
    for d, rows in residuals.items():
        part = rows.withColumn("d", F.lit(d))
        errors = part if errors is None else errors.unionByName(part)
    errors = fits.select(F.col("entity").alias("e"), F.col("d").alias("own_d")).join(errors, (F.col("e") == F.col("entity")) & (F.col("own_d") == F.col("d"))).select("entity", "pos", "_e")
    tail = (
        last.select("entity", "pos", F.col(target).cast("double").alias("v"))
        .join(errors, ["entity", "pos"], "left")
        .groupBy("entity")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "v", F.coalesce("_e", F.lit(0.0)).alias("e")))).alias("t"))
        .select("entity", F.transform("t", lambda r: r["v"]).alias("tail"), F.transform("t", lambda r: r["e"]).alias("errors"))
    )
    outside = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in exog]) if exog else F.array().cast("array<double>")
    ahead = future.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("step", outside.alias("x")))).alias("s"))
    rows = fits.join(tail, "entity").join(ahead.select("entity", F.transform("s", lambda r: r["x"]).alias("ahead")), "entity")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                level, e, beta = list(row.tail), list(row.errors), np.asarray(row.coefficients)
                for step, x in enumerate(row.ahead, start=1):
                    z = np.diff(level) if row.d else np.asarray(level)
                    v = [1.0, *[z[-k] for k in range(1, row.p + 1)], *([z[-period]] if row.seasonal else [])]
                    v += [*[e[-k] for k in range(1, row.q + 1)], *([e[-period]] if row.seasonal_q else [])]
                    value = float(beta @ np.asarray([*v, *x]))
                    level.append(level[-1] + value if row.d else value)
                    e.append(0.0)
                    out.append((row.entity, step, level[-1]))
            yield pd.DataFrame(out, columns=["entity", "step", "forecast"])

    return rows.mapInPandas(run, "entity long, step int, forecast double")
