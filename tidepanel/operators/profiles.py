"""Profiles of a panel: seasonal means, correlation, crosstab, histogram, comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators.blocks import WindowColumn, blocked_window
from tidepanel.operators.stats import describe, pearson, quantiles, with_group_stats


def seasonal_profiles(df: DataFrame, date: str, column: str, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Mean per year, day of week and month, long form. One scan, three grouping sets."""
    grids = {
        "year": F.year(F.col(date)),
        "dow": F.weekday(F.col(date)),
        "month": F.month(F.col(date)),
    }
    cells = F.array(
        *[F.struct(F.lit(n).alias("profile"), c.alias("bucket")) for n, c in grids.items()]
    )
    return (
        df.select(*keys, column, F.inline(cells))
        .groupBy(*keys, "profile", "bucket")
        .agg(F.avg(column).alias(f"mean_{column}"))
    )


def hour_dow_profile(df: DataFrame, time: str, column: str, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Hours as rows, days of the week as columns; the value list is known, so no pivot job."""
    by_day = [
        F.avg(F.when(F.weekday(F.col(time)) == d, F.col(column))).alias(f"dow_{d}") for d in range(7)
    ]
    return df.groupBy(*keys, F.hour(F.col(time)).alias("hour")).agg(*by_day)


def weekly_bins(df: DataFrame, date: str, column: str, keys: Sequence[str] = ("entity",)) -> DataFrame:
    week = F.floor(F.dayofyear(F.col(date)) / 7).cast("int")
    return df.groupBy(*keys, F.year(F.col(date)).alias("year"), week.alias("week_bin")).agg(
        F.avg(column).alias(f"mean_{column}")
    )


def target_correlation(
    df: DataFrame, target: str, columns: Sequence[str], keys: Sequence[str] = ("entity",)
) -> DataFrame:
    """Pearson correlation of every column with the target: all in one aggregate. A constant column
    has none."""
    wide = df.groupBy(*keys).agg(*[pearson(c, target).alias(c) for c in columns])
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in columns]
    )
    return wide.select(*keys, F.inline(cells)).withColumn(
        "abs_correlation", F.abs("correlation")
    )


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each key. For tables already reduced to a few rows per key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def autocorrelation(df: DataFrame, column: str, lags: Sequence[int]) -> DataFrame:
    """Correlation of a series with itself ``k`` rows earlier, all lags in one exchange. A flat
    series has none."""
    made: dict[str, WindowColumn] = {
        f"_lag_{k}": (lambda w, k=k: F.lag(column, k).over(w)) for k in lags
    }
    lagged = blocked_window(df, ["entity"], "pos", made, max(lags))
    wide = lagged.groupBy("entity").agg(*[pearson(column, f"_lag_{k}").alias(str(k)) for k in lags])
    cells = F.array(
        *[F.struct(F.lit(k).alias("lag"), F.col(f"`{k}`").alias("correlation")) for k in lags]
    )
    return wide.select("entity", F.inline(cells))


def crosstab_margins(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``row`` x ``column`` with an ``All`` row and column."""
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("_n"))
    cells = [
        F.coalesce(F.sum(F.when(F.col(column) == v, F.col("_n"))), F.lit(0)).alias(v) for v in values
    ]
    return (
        counts.withColumn(row, F.col(row).cast("string"))
        .rollup(row)
        .agg(*cells, F.sum("_n").alias("All"), F.grouping(row).alias("_all"))
        .withColumn(row, F.when(F.col("_all") == 1, "All").otherwise(F.col(row)))
        .drop("_all")
    )


def value_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    """Most frequent values; equal counts by value."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(n)
    )


def histogram(df: DataFrame, column: str, bins: int, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Equal-width counts with empty bins kept and the last bin closed.

    A row looks its range up, is binned and counted; bins without rows come from the
    range table."""
    ranges = df.groupBy(*keys).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    # a flat column gets a range of one around its value
    ranges = ranges.select(
        *keys,
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.least(F.floor((F.col(column) - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    counts = (
        df.filter(F.col(column).isNotNull())
        .join(ranges, list(keys))
        .groupBy(*keys, at.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = ranges.select(
        *keys, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def congestion_split(df: DataFrame, score: str, value: str, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Low and high half by the median score, compared."""
    cut = quantiles(df, keys, score, {"_median": 0.5})
    level = F.when(F.col(score) >= F.col("_median"), "High").otherwise("Low")
    return (
        df.join(cut, list(keys))
        .groupBy(*keys, level.alias("level"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(score).alias(f"mean_{score}"),
            F.min(score).alias(f"min_{score}"),
            F.max(score).alias(f"max_{score}"),
            F.avg(value).alias(f"mean_{value}"),
        )
    )


def group_mean(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return with_group_stats(df, keys, **{name: F.avg(column)})


def feature_stats(
    train: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("entity",)
) -> DataFrame:
    """Training distribution of each feature, from a stored table."""
    return describe(train, keys, columns, {"p10": 0.1, "p50": 0.5, "p90": 0.9}, stored=True).select(
        *keys, F.col("column").alias("feature"), "mean", "std", "min", "max", "p10", "p50", "p90"
    )
