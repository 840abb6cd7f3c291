"""Model tables: panel, weather, calendar, score, classes, lags, rolling, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS, Settings
from tidepanel.functions.calendar import calendar_parts, cyclic_parts, holiday_flags
from tidepanel.functions.weather import weather_features
from tidepanel.operators import target, windows
from tidepanel.operators.panel import imbalance

# Columns that are never features.
NOT_FEATURES = {
    "entity", "dt", "ts_hour", "acps", "congestion_class", "congestion_binary", "rain_total",
    "weather_code_max", "day_of_year", "split", "pos", "n_steps", "row_index", "n_rows",
    "p60", "p85",
}


def daily_model_table(
    panel: DataFrame, weather: DataFrame, holidays: DataFrame, s: Settings = DEFAULTS
) -> DataFrame:
    """Daily form. ``weather`` has one row per ``dt``; all else is per entity."""
    # the score refers to its input twice: only the bare panel goes through it
    scored = target.attach_score(
        calendar_parts(panel, "dt"),
        target.DAILY_PHASE,
        ("acps", "congestion_class", "congestion_binary"),
        settings=s,
    )
    joined = holiday_flags(cyclic_parts(scored), holidays, "dt").join(weather, "dt", "left")
    featured = windows.daily_window_features(
        joined.withColumn("arr_dep_imbalance", imbalance(F.col("arrivals"), F.col("departures"))), s
    )
    labels = ("acps", "movements")
    lags = {
        f"{label}_lag_{k}d": k
        for k in s.daily_lags
        if k not in s.daily_exempt_lags
        for label in labels
    }
    always = [f"{label}_rmean_{n}d" for n in s.daily_mean_windows for label in labels]
    always += [f"acps_rstd_{n}d" for n in s.daily_std_windows]
    kept = windows.drop_infeasible(featured, lags, always)
    return windows.split_after_warmup(kept, sorted(set(lags.values())), s)


def hourly_model_table(
    panel: DataFrame, weather: DataFrame, holidays: DataFrame, s: Settings = DEFAULTS
) -> DataFrame:
    """Hourly form. ``weather`` has one row per ``ts``."""
    scored = target.attach_score(calendar_parts(panel, "ts_hour"), target.HOURLY_PHASE, ("acps",), settings=s)
    hourly = weather_features(weather).withColumnRenamed("ts", "ts_hour")
    joined = holiday_flags(cyclic_parts(scored), holidays, "ts_hour").join(hourly, "ts_hour", "left")
    featured = windows.hourly_window_features(joined, s)
    lags = {f"acps_lag_{k}h": k for k in s.hourly_lags}
    always = [f"acps_rmean_{n}h" for n in s.hourly_mean_windows]
    always += [f"acps_rstd_{n}h" for n in s.hourly_std_windows]
    kept = windows.drop_infeasible(featured, lags, always)
    return windows.split_after_warmup(kept, s.hourly_lags, s)


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are not excluded, in table order."""
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [c for c, t in df.dtypes if c not in NOT_FEATURES and t in numeric]
