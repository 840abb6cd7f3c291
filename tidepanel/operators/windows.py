"""Lags, rolling windows, splits and decomposition over a gap-free panel.

``pos`` is the step index of a row in its series, so row shifts are time shifts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS, Settings
from tidepanel.operators.blocks import WindowColumn, block_of, blocked_window, carry_forward, ordinal
from tidepanel.session import materialize

KEYS = ("entity",)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """First row of each key in ``order``, whose first column has no NULLs.

    The least first column of each key is a hash aggregate over two columns; stored, its size
    is known, so while it is small the rows are filtered by a broadcast lookup and never
    shuffled. Only what is left, a few rows of each key, is compared in full."""
    least = df.groupBy(*keys).agg(F.min(order[0]).alias("_least"))
    lead = materialize(least.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_least"), "first")
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys] + [F.col(order[0]) == F.col("_least")]
    near = df.join(lead, reduce(lambda a, b: a & b, same))
    row = F.min_by(F.struct(*columns), F.struct(*order)).alias("_row")
    return near.groupBy(*keys).agg(row).select(*keys, "_row.*")


def lag_columns(column: str, label: str, lags: Sequence[int], unit: str) -> dict[str, WindowColumn]:
    return {
        f"{label}_lag_{k}{unit}": (lambda w, k=k: F.lag(column, k).over(w)) for k in lags
    }


def in_units(column: str, digits: int) -> Column:
    """A column of fixed digits as whole units. Sums of them do not depend on row order,
    so results stay equal when tasks are rerun or data is laid out differently."""
    return F.round(F.col(column) * 10**digits).cast("bigint")


def trailing_columns(
    column: str, label: str, means: Sequence[int], stds: Sequence[int], unit: str, digits: int = 0
) -> dict[str, WindowColumn]:
    """Trailing mean and sample deviation with the current row, from one row on.

    ``digits`` is the number of decimals the column is stored with."""
    out: dict[str, WindowColumn] = {}
    for n in means:

        def mean(w, n=n):
            frame = w.rowsBetween(1 - n, 0)
            total = F.sum(in_units(column, digits)).over(frame) / F.count(column).over(frame)
            return total / F.lit(float(10**digits))

        out[f"{label}_rmean_{n}{unit}"] = mean
    for n in stds:
        out[f"{label}_rstd_{n}{unit}"] = lambda w, n=n: F.stddev_samp(column).over(
            w.rowsBetween(1 - n, 0)
        )
    return out


def with_windows(df: DataFrame, columns: dict[str, WindowColumn], back: int, ahead: int = 0) -> DataFrame:
    return blocked_window(df, KEYS, "pos", columns, back, ahead)


def daily_window_columns(s: Settings = DEFAULTS) -> tuple[dict[str, WindowColumn], int]:
    """All daily lags, rolling columns and the yearly difference, and how many rows back they read."""
    columns = {
        **lag_columns("acps", "acps", s.daily_lags, "d"),
        **lag_columns("total_movements", "movements", s.daily_lags, "d"),
        **trailing_columns(
            "acps", "acps", s.daily_mean_windows, s.daily_std_windows, "d", s.score_digits
        ),
        **trailing_columns("total_movements", "movements", s.daily_mean_windows, (), "d"),
        "movements_yoy_change": lambda w: F.col("total_movements")
        - F.lag("total_movements", s.year_lag).over(w),
    }
    return columns, max(*s.daily_lags, *s.daily_mean_windows, *s.daily_std_windows, s.year_lag)


def daily_window_features(df: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """All daily window columns in one exchange."""
    columns, back = daily_window_columns(s)
    return with_windows(df, columns, back)


def hourly_window_features(df: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    columns = {
        **lag_columns("acps", "acps", s.hourly_lags, "h"),
        **trailing_columns(
            "acps", "acps", s.hourly_mean_windows, s.hourly_std_windows, "h", s.score_digits
        ),
    }
    back = max(*s.hourly_lags, *s.hourly_mean_windows, *s.hourly_std_windows)
    return with_windows(df, columns, back)


def horizon_columns(column: str, horizons: Sequence[int], unit: str) -> dict[str, WindowColumn]:
    return {
        f"{column}_in_{h}{unit}": (lambda w, h=h: F.lead(column, h).over(w)) for h in horizons
    }


def drop_infeasible(df: DataFrame, lags: dict[str, int], always: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in a rolling column, or in a lag shorter than the series."""
    keep = F.lit(True)
    for column, steps in lags.items():
        keep &= F.col(column).isNotNull() | (F.col("n_steps") <= steps)
    for column in always:
        keep &= F.col(column).isNotNull()
    return df.filter(keep)


def split_label(index: Column, n: Column, s: Settings = DEFAULTS) -> Column:
    """Chronological split of ``n`` rows by index, cut at whole rows."""
    train_end = F.floor(n * F.lit(s.train_share))
    valid_end = F.floor(n * F.lit(s.train_share + s.valid_share))
    return F.when(index < train_end, "train").when(index < valid_end, "valid").otherwise("test")


def split_after_warmup(df: DataFrame, lags: Sequence[int], s: Settings = DEFAULTS) -> DataFrame:
    """``split`` of a gap-free table after ``drop_infeasible``, without ranking.

    A gap-free score has no NULL of its own, so the rows dropped are the first ones of
    each series: as many as its longest feasible lag, and at least one for the rolling
    deviation. Row number and row count follow from ``pos`` and ``n_steps``.
    """
    n = F.col("n_steps")
    lost = F.greatest(F.lit(1), *[F.when(n > k, F.lit(k)).otherwise(F.lit(0)) for k in lags])
    return (
        df.withColumns({"row_index": F.col("pos") - lost, "n_rows": n - lost})
        .withColumn("split", split_label(F.col("row_index"), F.col("n_rows"), s))
    )


def chrono_split(df: DataFrame, time: str, s: Settings = DEFAULTS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Adds ``split`` by rank in time within each entity; for tables with gaps."""
    ranked = ordinal(df, keys, [time], block_of(F.col("pos")), "row_index", "n_rows")
    return ranked.withColumn("split", split_label(F.col("row_index"), F.col("n_rows"), s))


def cutoff_split(df: DataFrame, time: str, cutoff: Column) -> DataFrame:
    return df.withColumn("split", F.when(F.col(time) < cutoff, "train").otherwise("test"))


def forward_fill(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Last known value, then 0."""
    carried = carry_forward(
        df, keys, ["pos"], {c: f"{c}_filled" for c in columns}, block_of(F.col("pos"))
    )
    return carried.withColumns({f"{c}_filled": F.coalesce(f"{c}_filled", F.lit(0)) for c in columns})


def seasonal_decompose(
    df: DataFrame, column: str, period: int, multiplicative: bool = False, digits: int = DEFAULTS.score_digits
) -> DataFrame:
    """Trend by a centred moving average, seasonal part by phase means, remainder.

    An even period takes half weights at both ends of its frame. The ends of a series,
    and series shorter than two periods, have NULL.
    """
    half = period // 2

    def trend(w):
        units = F.col("_units")
        if period % 2:
            doubled = F.sum(units).over(w.rowsBetween(-half, half)) * 2
        else:
            ends = F.lag(units, half).over(w) + F.lead(units, half).over(w)
            doubled = F.sum(units).over(w.rowsBetween(1 - half, half - 1)) * 2 + ends
        whole = (F.col("pos") >= half) & (F.col("pos") < F.col("n_steps") - half)
        enough = whole & (F.col("n_steps") >= 2 * period)
        return F.when(enough, doubled / (2 * period) / F.lit(float(10**digits)))

    base = (
        with_windows(df.withColumn("_units", in_units(column, digits)), {"trend": trend}, half, half)
        .drop("_units")
        .withColumn("phase", F.col("pos") % period)
    )
    x, t = F.col(column), F.col("trend")
    flat = F.when(t != 0, x / t) if multiplicative else x - t
    means = base.groupBy("entity", "phase").agg(F.avg(flat).alias("_phase_mean"))
    level = F.avg("_phase_mean").over(Window.partitionBy("entity"))
    centred = F.col("_phase_mean") / level if multiplicative else F.col("_phase_mean") - level
    seasonal = means.select("entity", "phase", centred.alias("seasonal"))
    out = base.join(seasonal, ["entity", "phase"], "left")
    rest = (
        F.when(t * F.col("seasonal") != 0, x / (t * F.col("seasonal")))
        if multiplicative
        else x - t - F.col("seasonal")
    )
    return out.withColumn("remainder", rest)


def centered_mean(df: DataFrame, column: str, name: str) -> DataFrame:
    """Short-series view: centred mean over min(3, n/2) rows, NULL unless the frame is full."""
    width = F.least(F.lit(3), F.greatest(F.lit(1), F.floor(F.col("n_steps") / 2)))

    def of_width(w):
        three = F.when(
            F.count(column).over(w.rowsBetween(-1, 1)) == 3, F.avg(column).over(w.rowsBetween(-1, 1))
        )
        two = F.when(
            F.count(column).over(w.rowsBetween(-1, 0)) == 2, F.avg(column).over(w.rowsBetween(-1, 0))
        )
        return F.when(width == 3, three).when(width == 2, two)

    return with_windows(df, {name: of_width}, 1, 1)


def tail_mean(df: DataFrame, column: str, sizes: Sequence[int]) -> DataFrame:
    """Mean of the last rows of each series by position, as one conditional aggregate."""
    from_end = F.col("n_steps") - F.col("pos")
    return df.groupBy(*KEYS).agg(
        *[F.avg(F.when(from_end <= n, F.col(column))).alias(f"{column}_last_{n}") for n in sizes]
    )
