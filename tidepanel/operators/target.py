"""The pressure score and its classes.

The score of a row depends on three things only: the entity, the phase (day of week, or
hour and day of week) and the total. So the panel is counted by these first, all
statistics are taken on that small table, and rows look their score up. A hot entity is
spread over many groups before anything is ranked or averaged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS, Settings

DAILY_PHASE = ("dow",)
HOURLY_PHASE = ("hour", "dow")


def with_phase(panel: DataFrame, time: str) -> DataFrame:
    """Monday = 0; the hour only where the time has one."""
    out = panel.withColumn("dow", F.weekday(F.col(time)))
    if dict(panel.dtypes)[time] != "date":
        out = out.withColumn("hour", F.hour(F.col(time)))
    return out



def score_table(
    panel: DataFrame,
    phase: Sequence[str],
    keys: Sequence[str] = ("entity",),
    settings: Settings = DEFAULTS,
    fit: Column | None = None,
) -> DataFrame:
    """Score, thresholds and classes per ``(keys, phase, total_movements)``.

    ``fit`` marks the rows the statistics are learnt from (default: all of them).
    """
    chosen = F.lit(True) if fit is None else fit
    freq = panel.groupBy(*keys, *phase, "total_movements").agg(
        F.sum(F.when(chosen, 1).otherwise(0)).alias("n_fit"),
        F.count(F.lit(1)).alias("n_panel"),
    )
    whole = Window.partitionBy(*keys)
    weight = F.col("n_fit")
    rated = freq.withColumn(
        "phase_median",
        F.percentile("total_movements", F.lit(0.5), weight).over(Window.partitionBy(*keys, *phase)),
    ).withColumn(
        "pressure_ratio",
        F.col("total_movements") / F.greatest(F.lit(1.0), F.col("phase_median")),
    )
    n = F.sum(weight).over(whole)
    centred = rated.select(
        "*",
        n.alias("_n"),
        (F.col("total_movements") - F.sum(F.col("total_movements") * weight).over(whole) / n).alias("_dt"),
        (F.col("pressure_ratio") - F.sum(F.col("pressure_ratio") * weight).over(whole) / n).alias("_dr"),
    )

    def deviation(d: str) -> Column:
        return F.sqrt(
            F.sum(F.col(d) * F.col(d) * weight).over(whole) / F.nullif(F.col("_n") - 1, F.lit(0))
        )

    scaled = centred.select("*", deviation("_dt").alias("_st"), deviation("_dr").alias("_sr"))

    def z(d: str, s: str) -> Column:
        return F.when(F.col(s) > 0, F.col(d) / F.col(s)).otherwise(0.0)

    mixed = scaled.withColumns(
        {"z_movements": z("_dt", "_st"), "z_pressure": z("_dr", "_sr")}
    ).withColumn(
        "_raw",
        settings.movement_weight * F.col("z_movements")
        + settings.pressure_weight * F.col("z_pressure"),
    )
    seen = F.when(weight > 0, F.col("_raw"))
    lo, hi = F.min(seen).over(whole), F.max(seen).over(whole)
    scored = mixed.withColumn(
        "acps",
        F.round(
            F.when(hi == lo, 50.0).otherwise((F.col("_raw") - lo) / (hi - lo) * 100.0),
            settings.score_digits,
        ),
    )
    cut = scored.withColumn(
        "_cut",
        F.percentile(
            "acps",
            F.array(F.lit(settings.low_percentile), F.lit(settings.high_percentile)),
            weight,
        ).over(whole),
    ).withColumns({"p60": F.col("_cut")[0], "p85": F.col("_cut")[1]})
    return cut.withColumns(
        {
            "congestion_class": percentile_class(F.col("acps"), F.col("p60"), F.col("p85")),
            "congestion_binary": (F.col("acps") >= F.col("p60")).cast("int"),
        }
    ).select(
        *keys, *phase, "total_movements", "n_panel", "n_fit", "phase_median", "pressure_ratio",
        "acps", "p60", "p85", "congestion_class", "congestion_binary",
    )


def attach_score(
    panel: DataFrame,
    phase: Sequence[str],
    columns: Sequence[str] = ("acps",),
    keys: Sequence[str] = ("entity",),
    settings: Settings = DEFAULTS,
    fit: Column | None = None,
) -> DataFrame:
    """The panel with score columns looked up from its score table."""
    by = [*keys, *phase, "total_movements"]
    table = score_table(panel, phase, keys, settings, fit).select(*by, *columns)
    return panel.join(table, by, "left")


def score_model(table: DataFrame, phase: Sequence[str], keys: Sequence[str] = ("entity",), settings: Settings = DEFAULTS) -> DataFrame:
    """What a stored ``score_table`` was learnt to be, one row per ``(keys, phase)``: enough to score any total later.

    Rows of one key differ in their median only. A key without rows to learn from is left out.
    """
    by, weight = list(keys), F.col("n_fit")
    n = F.nullif(F.sum(weight), F.lit(0))
    means = table.groupBy(*by).agg(
        n.alias("_n"), (F.sum(F.col("total_movements") * weight) / n).alias("_mt"), (F.sum(F.col("pressure_ratio") * weight) / n).alias("_mr")
    )
    off = table.join(means, by).withColumns({"_dt": F.col("total_movements") - F.col("_mt"), "_dr": F.col("pressure_ratio") - F.col("_mr")})

    def deviation(d: str) -> Column:
        return F.sqrt(F.sum(F.col(d) * F.col(d) * weight) / F.nullif(F.first("_n") - 1, F.lit(0)))

    spread = off.groupBy(*by).agg(deviation("_dt").alias("_st"), deviation("_dr").alias("_sr"), F.first("p60").alias("p60"), F.first("p85").alias("p85"))
    raw = off.join(spread, by).withColumn("_raw", _mixed(F.col("_dt"), F.col("_st"), F.col("_dr"), F.col("_sr"), settings))
    ends = raw.where("n_fit > 0").groupBy(*by).agg(F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi"))
    medians = table.groupBy(*by, *phase).agg(F.first("phase_median").alias("_median"))
    return medians.join(means.drop("_n").join(spread, by).join(ends, by), by)


def _mixed(dt: Column, st: Column, dr: Column, sr: Column, settings: Settings) -> Column:
    def z(d: Column, s: Column) -> Column:
        return F.when(s > 0, d / s).otherwise(0.0)

    return settings.movement_weight * z(dt, st) + settings.pressure_weight * z(dr, sr)


def score_by(panel: DataFrame, model: DataFrame, phase: Sequence[str], keys: Sequence[str] = ("entity",), settings: Settings = DEFAULTS) -> DataFrame:
    """``panel`` with ``acps`` from a stored ``score_model``. It doesn't depend on the other rows of ``panel``; totals beyond those
    learnt from go beyond 0 and 100. NULL for a key or phase the model hasn't seen."""
    learnt = ("_median", "_mt", "_mr", "_st", "_sr", "_lo", "_hi")
    ratio = F.col("total_movements") / F.greatest(F.lit(1.0), F.col("_median"))
    raw = _mixed(F.col("total_movements") - F.col("_mt"), F.col("_st"), ratio - F.col("_mr"), F.col("_sr"), settings)
    lo, hi = F.col("_lo"), F.col("_hi")
    score = F.when(F.col("_median").isNull(), None).when(hi == lo, 50.0).otherwise(F.try_divide(raw - lo, hi - lo) * 100.0)
    joined = panel.join(model.select(*keys, *phase, *learnt), [*keys, *phase], "left")
    return joined.withColumn("acps", F.round(score, settings.score_digits)).drop(*learnt)


def thresholds(
    panel: DataFrame, phase: Sequence[str], keys: Sequence[str] = ("entity",), settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per entity with the two percentile cuts."""
    table = score_table(panel, phase, keys, settings)
    return table.groupBy(*keys).agg(F.first("p60").alias("p60"), F.first("p85").alias("p85"))


def percentile_class(score: Column, low: Column, high: Column) -> Column:
    """Low up to and with the lower cut, Medium up to and with the upper cut."""
    return F.when(score <= low, "Low").when(score <= high, "Medium").when(score > high, "High")


def fixed_class(score: Column, settings: Settings = DEFAULTS) -> Column:
    """Classes by fixed cuts, each cut belonging to the class above it."""
    return (
        F.when(score < settings.fixed_low, "Low")
        .when(score < settings.fixed_high, "Medium")
        .when(score.isNotNull(), "High")
    )


def quantile_edges(train: DataFrame, keys: Sequence[str], column: str, bins: int) -> DataFrame:
    """Distinct bin edges of equal rank distance, learnt on the training rows."""
    from tidepanel.operators.stats import quantiles

    points = {f"_e{i}": i / bins for i in range(bins + 1)}
    edges = quantiles(train, keys, column, points)
    return edges.select(*keys, F.array_distinct(F.array(*points)).alias("edges"))


def bin_by_edges(value: Column, edges: Column) -> Column:
    """Right-closed bins, the lowest edge included; NULL outside the edges."""
    inside = (value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, -1))
    below = F.size(F.filter(edges, lambda e: e < value))
    return F.when(inside, F.greatest(below - 1, F.lit(0)))
