"""Score, thresholds and classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.registry import query
from tidepanel.operators import stats, target, windows
from tidepanel.operators.target import DAILY_PHASE, HOURLY_PHASE
from tidepanel.sources import bindings


def daily_scored(spark, root, columns=("acps",)):
    panel = target.with_phase(bindings.daily_panel(spark, root), "dt")
    return target.attach_score(panel, DAILY_PHASE, columns)


def hourly_scored(spark, root, columns=("acps",)):
    panel = target.with_phase(bindings.hourly_panel(spark, root), "ts_hour")
    return target.attach_score(panel, HOURLY_PHASE, columns)


CLASS_COLUMNS = ("acps", "p60", "p85", "congestion_class", "congestion_binary")


@query(
    "acps_daily",
    "SELECT entity, dt, total_movements, round(pressure_ratio, 9) AS pressure_ratio, acps FROM ad",
    "ad",
)
def acps_daily(spark, root):
    return daily_scored(spark, root, ("pressure_ratio", "acps")).select(
        "entity", "dt", "total_movements", F.round("pressure_ratio", 9).alias("pressure_ratio"), "acps"
    )


@query(
    "acps_hourly",
    "SELECT entity, ts_hour, total_movements, round(pressure_ratio, 9) AS pressure_ratio, acps FROM ah",
    "ah",
)
def acps_hourly(spark, root):
    return hourly_scored(spark, root, ("pressure_ratio", "acps")).select(
        "entity", "ts_hour", "total_movements", F.round("pressure_ratio", 9).alias("pressure_ratio"), "acps"
    )


@query(
    "group_median",
    """SELECT entity, dt, dow, total_movements, phase_median FROM dratio""",
    "dratio",
)
def group_median(spark, root):
    return daily_scored(spark, root, ("phase_median",)).select(
        "entity", "dt", "dow", "total_movements", "phase_median"
    )


@query(
    "zscore",
    """SELECT d.entity, dt, round(CASE WHEN s > 0 THEN (total_movements - m) / s ELSE 0 END, 9) AS z_total
    FROM dp d JOIN (SELECT entity, avg(total_movements) AS m, stddev_samp(total_movements) AS s
                    FROM dp GROUP BY 1) t ON t.entity = d.entity""",
    "dp",
)
def zscore(spark, root):
    panel = bindings.daily_panel(spark, root)
    return stats.zscore(panel, ["entity"], "total_movements", "z").select(
        "entity", "dt", F.round("z", 9).alias("z_total")
    )


@query(
    "minmax",
    """SELECT d.entity, dt, round(CASE WHEN hi = lo THEN 50
            ELSE (total_movements - lo) / (hi - lo)::DOUBLE * 100 END, 9) AS rescaled
    FROM dp d JOIN (SELECT entity, min(total_movements) AS lo, max(total_movements) AS hi
                    FROM dp GROUP BY 1) t ON t.entity = d.entity""",
    "dp",
)
def minmax(spark, root):
    panel = bindings.daily_panel(spark, root)
    return stats.minmax(panel, ["entity"], "total_movements", "v").select(
        "entity", "dt", F.round("v", 9).alias("rescaled")
    )


@query("acps_thresholds", "SELECT entity, round(p60, 9) AS p60, round(p85, 9) AS p85 FROM thr", "thr")
def acps_thresholds(spark, root):
    panel = target.with_phase(bindings.daily_panel(spark, root), "dt")
    return target.thresholds(panel, DAILY_PHASE).select(
        "entity", F.round("p60", 9).alias("p60"), F.round("p85", 9).alias("p85")
    )


@query("congestion_class", "SELECT entity, dt, acps, congestion_class, congestion_binary FROM cd", "cd")
def congestion_class(spark, root):
    return daily_scored(spark, root, CLASS_COLUMNS).select(
        "entity", "dt", "acps", "congestion_class", "congestion_binary"
    )


@query(
    "fixed_class",
    """SELECT entity, dt, acps, CASE WHEN acps < 65 THEN 'Low' WHEN acps < 75 THEN 'Medium'
       ELSE 'High' END AS fixed_class FROM ad""",
    "ad",
)
def fixed_class(spark, root):
    return daily_scored(spark, root).select(
        "entity", "dt", "acps", target.fixed_class(F.col("acps")).alias("fixed_class")
    )


@query(
    "quantile_bins",
    """WITH e AS (SELECT entity, list_sort(list_distinct(quantile_cont(acps, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges
              FROM psplit WHERE split = 'train' GROUP BY 1)
    SELECT p.entity, dt, split, acps,
      CASE WHEN acps >= edges[1] AND acps <= edges[-1]
           THEN CAST(greatest(len(list_filter(edges, lambda x: x < acps)) - 1, 0) AS INTEGER) END AS bin
    FROM psplit p JOIN e ON e.entity = p.entity""",
    "psplit",
)
def quantile_bins(spark, root):
    """Edges learnt on the training rows, applied to all splits."""
    scored = daily_scored(spark, root).withColumn(
        "split", windows.split_label(F.col("pos"), F.col("n_steps"))
    )
    edges = target.quantile_edges(scored.filter("split = 'train'"), ["entity"], "acps", 5)
    return scored.join(edges, "entity").select(
        "entity", "dt", "split", "acps",
        target.bin_by_edges(F.col("acps"), F.col("edges")).alias("bin"),
    )


@query(
    "imbalance",
    """SELECT entity, dt, arrivals, departures,
       round((arrivals - departures) / greatest(1, total_movements)::DOUBLE, 9) AS arr_dep_imbalance FROM dp""",
    "dp",
)
def imbalance(spark, root):
    from tidepanel.operators.panel import imbalance as share

    return bindings.daily_panel(spark, root).select(
        "entity", "dt", "arrivals", "departures",
        F.round(share(F.col("arrivals"), F.col("departures")), 9).alias("arr_dep_imbalance"),
    )
