"""Feature rows for a table of scenarios, from the history of each entity.

Definitions are those of the training table (calendar cycles, pre- and post-holiday flags,
yearly change as a difference), so a model sees the same columns in both places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.config import (
    DEFAULT_PRESET, DEFAULTS, PRESET_WIND_DIRECTION, WEATHER_FIELDS, WEATHER_PRESETS, Settings,
)
from tidepanel.functions.calendar import calendar_parts, cyclic_parts, holiday_flags
from tidepanel.operators.blocks import block_of, blocked_window, carry_forward
from tidepanel.operators.lookups import day_number
from tidepanel.operators.panel import imbalance

KEYS = ("entity",)


def preset_table(spark: SparkSession) -> DataFrame:
    """The fixed weather presets, one row per name."""
    rows = [(name, *values) for name, values in WEATHER_PRESETS.items()]
    kinds = ", ".join(
        f"{f} {'int' if f.startswith('is_') else 'double'}" for f in WEATHER_FIELDS
    )
    return spark.createDataFrame(rows, f"preset string, {kinds}")


def with_preset(scenarios: DataFrame, column: str = "preset") -> DataFrame:
    """Weather by preset name; an unknown name counts as the default. The preset table
    has four rows, so it is broadcast."""
    known = F.col(column).isin(*WEATHER_PRESETS)
    named = scenarios.withColumn("_preset", F.when(known, F.col(column)).otherwise(DEFAULT_PRESET))
    table = preset_table(scenarios.sparkSession).withColumnRenamed("preset", "_preset")
    degrees = F.radians(F.lit(PRESET_WIND_DIRECTION))
    return (
        named.join(F.broadcast(table), "_preset", "left")
        .drop("_preset")
        .withColumns(
            {
                "wind_direction_10m": F.lit(PRESET_WIND_DIRECTION),
                "wind_dir_sin": F.sin(degrees),
                "wind_dir_cos": F.cos(degrees),
            }
        )
    )


def history_features(
    asked: DataFrame, history: DataFrame, s: Settings = DEFAULTS, windows: Sequence[int] = (7, 14, 28), tail: int = 30,
    week: int = 7,
) -> DataFrame:
    """Lags and trailing statistics before each ``(entity, dt)`` asked for.

    Asked dates are set between the history rows as rows without values, so one ordered
    pass serves all of them. ``history`` is gap-free with ``pos``, ``acps`` and
    ``total_movements``; an exact lag that is not there falls back to the last row before
    the date, the yearly one to the mean of the last rows.
    """
    year = s.year_lag
    short = [k for k in s.daily_lags if k != year]
    series = {"acps": "acps", "movements": "total_movements"}
    recent = blocked_window(
        history.select(*KEYS, "pos", "dt", "acps", F.col("total_movements").cast("double")),
        KEYS,
        "pos",
        {
            **{
                f"_tail_{label}": (lambda w, c=c: F.avg(c).over(w.rowsBetween(1 - tail, 0)))
                for label, c in series.items()
            },
            "_week": lambda w: F.avg("acps").over(w.rowsBetween(1 - week, 0)),
        },
        back=max(tail, week),
    ).withColumn("_at", F.col("dt"))
    values = ["acps", "total_movements", "_tail_acps", "_tail_movements", "_week", "_at"]
    rows = recent.select(*KEYS, "dt", F.lit(1).alias("_side"), *values).unionByName(
        asked.select(*KEYS, "dt", F.lit(0).alias("_side")).distinct(), allowMissingColumns=True
    ).withColumn("_day", day_number("dt"))
    carried = carry_forward(
        rows,
        KEYS,
        ["_day", "_side"],
        {c: f"_last_{c}" for c in values},
        block_of(F.col("_day")),
    )

    columns = {}
    for label, c in series.items():
        for k in (*short, year):
            columns[f"_at_{label}_{k}"] = lambda w, c=c, k=k: F.max(c).over(w.rangeBetween(-k, -k))
        for n in windows:
            columns[f"{label}_rmean_{n}d"] = lambda w, c=c, n=n: F.avg(c).over(w.rangeBetween(-n, -1))
    for n in s.daily_std_windows:
        columns[f"acps_rstd_{n}d"] = lambda w, n=n: F.coalesce(
            F.stddev_samp("acps").over(w.rangeBetween(-n, -1)), F.lit(0.0)
        )
    found = blocked_window(carried, KEYS, "_day", columns, back=year).filter("_side = 0")
    filled = {}
    for label, c in series.items():
        for k in short:
            filled[f"{label}_lag_{k}d"] = F.coalesce(f"_at_{label}_{k}", f"_last_{c}")
        filled[f"{label}_lag_{year}d"] = F.coalesce(f"_at_{label}_{year}", f"_last__tail_{label}")
    # past the history the score's weekly mean is that of the last known days
    filled[f"acps_rmean_{week}d"] = F.when(F.datediff("dt", "_last__at") > 1, F.col("_last__week")).otherwise(
        F.col(f"acps_rmean_{week}d")
    )
    kept = [f"{label}_rmean_{n}d" for label in series for n in windows if (label, n) != ("acps", week)]
    kept += [f"acps_rstd_{n}d" for n in s.daily_std_windows]
    return found.select(*KEYS, "dt", *[v.alias(n) for n, v in filled.items()], *kept)


def scenario_features(
    scenarios: DataFrame, history: DataFrame, holidays: DataFrame, s: Settings = DEFAULTS
) -> DataFrame:
    """Model input for scenarios ``(…, entity, dt, total_movements, preset)``."""
    total = F.col("total_movements")
    counted = scenarios.withColumn("arrivals", F.floor(total / 2)).withColumn(
        "departures", total - F.col("arrivals")
    )
    dated = cyclic_parts(calendar_parts(with_preset(counted), "dt"))
    flagged = holiday_flags(dated, holidays, "dt").withColumn(
        "arr_dep_imbalance", imbalance(F.col("arrivals"), F.col("departures"))
    )
    joined = flagged.join(history_features(scenarios, history, s), [*KEYS, "dt"], "left")
    return joined.withColumn(
        "movements_yoy_change", total - F.col(f"movements_lag_{s.year_lag}d")
    )


def last_actual(history: DataFrame) -> DataFrame:
    """Last date and score of each entity."""
    return history.groupBy(*KEYS).agg(
        F.max("dt").alias("last_dt"), F.max_by("acps", "dt").alias("last_acps")
    )


def next_days(history: DataFrame, days: int) -> DataFrame:
    """The dates after the last one of each entity."""
    return last_actual(history).select(
        *KEYS, "last_dt", "last_acps", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("days_ahead")
    ).withColumn("dt", F.date_add("last_dt", F.col("days_ahead")))
