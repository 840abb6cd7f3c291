"""Baselines, metrics and error diagnostics.

The pair under test is the score and its value one step earlier, class and class likewise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.registry import FEATURES, query
from tidepanel.catalog.series import r9, stored_table
from tidepanel.catalog.target import CLASS_COLUMNS, daily_scored, hourly_scored
from tidepanel.operators import baselines, evaluate, profiles, windows
from tidepanel.plans.model_table import feature_columns


def pairs(spark, root):
    scored = daily_scored(spark, root, CLASS_COLUMNS)
    made = {
        "y_hat": lambda w: F.lag("acps", 1).over(w),
        "c_hat": lambda w: F.lag("congestion_class", 1).over(w),
    }
    return windows.with_windows(scored, made, 1).filter("y_hat IS NOT NULL").select(
        "entity", "dt", "dow", "total_movements", F.col("acps").alias("y"), "y_hat",
        F.col("congestion_class").alias("c"), "c_hat",
    )


def residuals(spark, root):
    return evaluate.residual_table(pairs(spark, root), "dt")


RESIDUALS = "SELECT entity, dt, y AS actual, y_hat AS predicted, y - y_hat AS residual, c AS actual_class, c_hat AS predicted_class FROM yp"

# ---------------------------------------------------------------- baselines

OFFSETS = {"prev_day_same_hour": 24, "prev_week_same_hour": 168}
SERIES = "SELECT *, row_number() OVER (PARTITION BY entity ORDER BY pos) AS seq FROM hsplit WHERE split <> 'valid'"


def _offset_sql() -> str:
    return (
        f"WITH s AS ({SERIES}), m AS (SELECT entity, avg(acps) AS m FROM hsplit WHERE split = 'train' GROUP BY 1), "
        "o AS (SELECT *, "
        + ", ".join(f"lag(acps, {k}) OVER (PARTITION BY entity ORDER BY seq) AS {n}" for n, k in (("prev_hour", 1), *OFFSETS.items()))
        + " FROM s) SELECT o.entity, ts_hour, acps, "
        + ", ".join(f"round(coalesce({n}, m), 9) AS {n}" for n in ("prev_hour", *OFFSETS))
        + " FROM o JOIN m ON m.entity = o.entity WHERE split = 'test'"
    )


@query(
    "baseline_prev",
    f"SELECT entity, ts_hour, acps, prev_hour FROM ({_offset_sql()})",
    "hsplit",
)
def baseline_prev(spark, root):
    """The value one row earlier; the first test row takes the last training value."""
    series = baselines.train_then_test(hourly_scored(spark, root))
    return baselines.shifted(series, "acps", {"prev_hour": 1}).filter("split = 'test'").select(
        "entity", "ts_hour", "acps", "prev_hour"
    )


@query(
    "baseline_offset",
    f"SELECT entity, ts_hour, acps, prev_day_same_hour, prev_week_same_hour FROM ({_offset_sql()})",
    "hsplit",
)
def baseline_offset(spark, root):
    series = baselines.train_then_test(hourly_scored(spark, root))
    out = baselines.offset_baselines(series, "acps", OFFSETS)
    return out.select("entity", "ts_hour", "acps", *r9(*OFFSETS))


@query(
    "baseline_majority",
    """SELECT entity, majority, n_majority FROM (SELECT entity, congestion_class AS majority, count(*) AS n_majority,
         row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, congestion_class) AS rn
       FROM psplit WHERE split = 'train' GROUP BY 1, 2) WHERE rn = 1""",
    "psplit",
)
def baseline_majority(spark, root):
    series = baselines.train_then_test(daily_scored(spark, root, CLASS_COLUMNS))
    return baselines.majority(series.filter("split = 'train'"), "congestion_class")


@query(
    "baseline_dow",
    """SELECT p.entity, p.dt, p.acps, round(m, 9) AS predicted FROM psplit p
       JOIN (SELECT entity, dow, avg(acps) AS m FROM psplit WHERE split = 'train' GROUP BY 1, 2) t
         ON t.entity = p.entity AND t.dow = p.dow WHERE p.split = 'test'""",
    "psplit",
)
def baseline_dow(spark, root):
    from tidepanel.operators.lookups import lookup_or_global

    series = baselines.train_then_test(daily_scored(spark, root))
    out = lookup_or_global(
        series.filter("split = 'test'"), series.filter("split = 'train'"), ["entity"], ["dow"], "acps", "m"
    )
    return out.select("entity", "dt", "acps", F.round("m", 9).alias("predicted"))


@query(
    "baseline_means",
    """SELECT p.entity, p.ts_hour, p.acps, round(g.m, 9) AS train_mean, round(coalesce(h.m, g.m), 9) AS hour_mean
       FROM hsplit p JOIN (SELECT entity, avg(acps) AS m FROM hsplit WHERE split = 'train' GROUP BY 1) g ON g.entity = p.entity
       LEFT JOIN (SELECT entity, hour, avg(acps) AS m FROM hsplit WHERE split = 'train' GROUP BY 1, 2) h
         ON h.entity = p.entity AND h.hour = p.hour WHERE p.split = 'test'""",
    "hsplit",
)
def baseline_means(spark, root):
    from tidepanel.operators.lookups import lookup_or_global

    series = baselines.train_then_test(hourly_scored(spark, root))
    train, test = series.filter("split = 'train'"), series.filter("split = 'test'")
    means = train.groupBy("entity").agg(F.avg("acps").alias("train_mean"))
    out = lookup_or_global(test, train, ["entity"], ["hour"], "acps", "hour_mean").join(means, "entity")
    return out.select("entity", "ts_hour", "acps", *r9("train_mean", "hour_mean"))


@query(
    "baseline_table",
    f"""WITH b AS ({_offset_sql()}),
     mode AS (SELECT entity, acps AS majority_class FROM (SELECT entity, acps, row_number() OVER (
          PARTITION BY entity ORDER BY count(*) DESC, acps) AS rn FROM hsplit WHERE split = 'train' GROUP BY 1, 2) WHERE rn = 1),
     j AS (SELECT b.*, majority_class FROM b JOIN mode ON mode.entity = b.entity) """
    + " UNION ALL ".join(
        f"""SELECT entity, '{m}' AS model, round(avg(abs(acps - {m})), 6) AS mae, round(sqrt(avg((acps - {m}) ** 2)), 6) AS rmse
        FROM j GROUP BY 1"""
        for m in ("prev_hour", *OFFSETS, "majority_class")
    ),
    "hsplit",
)
def baseline_table(spark, root):
    out = baselines.baseline_table(hourly_scored(spark, root), "acps")
    return out.select("entity", "model", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


# ---------------------------------------------------------------- metrics

REGRESSION = """SELECT entity, count(*) AS n, round(avg(abs(y - y_hat)), 9) AS mae, round(sqrt(avg((y - y_hat) ** 2)), 9) AS rmse,
   round(1 - sum((y - y_hat) ** 2) / (var_pop(y) * count(*)), 9) AS r2 FROM yp GROUP BY 1"""


@query("regression_metrics", REGRESSION, "yp")
def regression_metrics(spark, root):
    out = evaluate.regression_metrics(pairs(spark, root), "y", "y_hat", ["entity"])
    return out.select("entity", "n", *r9("mae", "rmse", "r2"))


REPORT = """rep AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM (
    SELECT entity, label, support, CASE WHEN called > 0 THEN hits / called::DOUBLE ELSE 0 END AS p,
           CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS r, hits
    FROM (SELECT e.entity, l.label, count(*) FILTER (c = l.label) AS support, count(*) FILTER (c_hat = l.label) AS called,
             count(*) FILTER (c = l.label AND c_hat = l.label) AS hits
          FROM yp e, (VALUES ('Low'), ('Medium'), ('High')) l(label) GROUP BY 1, 2) WHERE support + called > 0))"""


@query(
    "class_report",
    f"""WITH {REPORT}
    SELECT entity, label, round(p, 9) AS precision, round(r, 9) AS recall, round(f1, 9) AS f1, support FROM rep
    UNION ALL SELECT entity, 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM rep GROUP BY 1
    UNION ALL SELECT entity, 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
        round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM rep GROUP BY 1""",
    "yp",
)
def class_report(spark, root):
    out = evaluate.class_report_with_averages(pairs(spark, root), "c", "c_hat", ["entity"])
    return out.select("entity", "label", *r9("precision", "recall", "f1"), "support")


@query(
    "classification_metrics",
    f"""WITH {REPORT} SELECT entity, CAST(sum(support) AS BIGINT) AS n, round(sum(hits) / sum(support)::DOUBLE, 9) AS accuracy,
        round(avg(f1), 9) AS f1_macro, round(avg(r) FILTER (support > 0), 9) AS balanced_accuracy FROM rep GROUP BY 1""",
    "yp",
)
def classification_metrics(spark, root):
    out = evaluate.classification_metrics(pairs(spark, root), "c", "c_hat", ["entity"])
    return out.select("entity", "n", *r9("accuracy", "f1_macro", "balanced_accuracy"))


@query(
    "confusion_matrix",
    """SELECT e.entity, a.label AS actual, p.label AS predicted, count(*) FILTER (c = a.label AND c_hat = p.label) AS n,
        round(coalesce(count(*) FILTER (c = a.label AND c_hat = p.label) / nullif(count(*) FILTER (c = a.label), 0)::DOUBLE, 0), 9) AS share
       FROM yp e, (VALUES ('Low'), ('Medium'), ('High')) a(label), (VALUES ('Low'), ('Medium'), ('High')) p(label)
       GROUP BY 1, 2, 3""",
    "yp",
)
def confusion_matrix(spark, root):
    out = evaluate.confusion_matrix(pairs(spark, root), "c", "c_hat", ["entity"])
    return out.select("entity", "actual", "predicted", "n", *r9("share"))


@query(
    "compare_models",
    """WITH t AS (SELECT * FROM (SELECT p.entity, p.dt, p.acps, lag(p.acps) OVER (PARTITION BY p.entity ORDER BY p.pos) AS prev,
            d.m AS dow_mean, g.m AS train_mean, split
          FROM psplit p JOIN (SELECT entity, dow, avg(acps) AS m FROM psplit WHERE split = 'train' GROUP BY 1, 2) d
              ON d.entity = p.entity AND d.dow = p.dow
          JOIN (SELECT entity, avg(acps) AS m FROM psplit WHERE split = 'train' GROUP BY 1) g ON g.entity = p.entity)
        WHERE split = 'test') """
    + " UNION ALL ".join(
        f"""SELECT entity, '{label}' AS model, round(avg(abs(acps - {c})), 6) AS mae, round(sqrt(avg((acps - {c}) ** 2)), 6) AS rmse,
        round(1 - sum((acps - {c}) ** 2) / (var_pop(acps) * count(*)), 6) AS r2 FROM t GROUP BY 1"""
        for label, c in (("previous_day", "prev"), ("dow_mean", "dow_mean"), ("train_mean", "train_mean"))
    ),
    "psplit",
)
def compare_models(spark, root):
    long = evaluate.showdown(
        showdown_rows(spark, root), "actual",
        {"previous_day": "previous_day", "dow_mean": "dow_mean", "train_mean": "train_mean"},
        ["entity", "dt"],
    )
    scored = evaluate.regression_metrics(long, "actual", "predicted", ["entity", "model"])
    cells = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("mae", "rmse", "r2")]
    )
    out = evaluate.compare_models(
        scored.select("entity", "model", F.inline(cells)), ["entity"], ("mae", "rmse", "r2")
    )
    return out.select("entity", "model", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


def showdown_rows(spark, root):
    """Test days with the three baseline values."""
    from tidepanel.operators.lookups import lookup_or_global

    scored = daily_scored(spark, root).withColumn(
        "split", windows.split_label(F.col("pos"), F.col("n_steps"))
    )
    lagged = windows.with_windows(scored, {"previous_day": lambda w: F.lag("acps", 1).over(w)}, 1)
    train = scored.filter("split = 'train'")
    rows = lookup_or_global(
        lagged.filter("split = 'test'"), train, ["entity"], ["dow"], "acps", "dow_mean"
    )
    means = train.groupBy("entity").agg(F.avg("acps").alias("train_mean"))
    return rows.join(means, "entity").select(
        "entity", "dt", F.col("acps").alias("actual"),
        F.coalesce("previous_day", "acps").alias("previous_day"), "dow_mean", "train_mean",
    )


@query(
    "showdown",
    """WITH t AS (SELECT p.entity, p.dt, p.acps AS actual, coalesce(prev, acps) AS prev, d.m AS dow_mean, g.m AS train_mean
          FROM (SELECT *, lag(acps) OVER (PARTITION BY entity ORDER BY pos) AS prev FROM psplit) p
          JOIN (SELECT entity, dow, avg(acps) AS m FROM psplit WHERE split = 'train' GROUP BY 1, 2) d ON d.entity = p.entity AND d.dow = p.dow
          JOIN (SELECT entity, avg(acps) AS m FROM psplit WHERE split = 'train' GROUP BY 1) g ON g.entity = p.entity
          WHERE split = 'test') """
    + " UNION ALL ".join(
        f"SELECT entity, dt, actual, '{label}' AS model, round({c}, 9) AS predicted, round(actual - {c}, 9) AS residual FROM t"
        for label, c in (("persistence", "prev"), ("previous_day", "prev"), ("dow_mean", "dow_mean"), ("train_mean", "train_mean"))
    ),
    "psplit",
)
def showdown(spark, root):
    out = evaluate.showdown(
        showdown_rows(spark, root), "actual",
        {
            "persistence": "previous_day", "previous_day": "previous_day",
            "dow_mean": "dow_mean", "train_mean": "train_mean",
        },
        ["entity", "dt"],
    )
    return out.select("entity", "dt", "actual", "model", *r9("predicted", "residual"))


# ---------------------------------------------------------------- residuals


@query(
    "residual_table",
    f"SELECT entity, dt, actual, predicted, round(residual, 9) AS residual, actual_class, predicted_class FROM ({RESIDUALS})",
    "yp",
)
def residual_table(spark, root):
    return residuals(spark, root).withColumn("residual", F.round("residual", 9))


BOX = ("mean", "std", "min", "max", "q25", "median", "q75")


def _box_sql(by: str, source: str) -> str:
    return f"""SELECT {by}, count(*) AS n, round(avg(residual), 9) AS mean, round(coalesce(stddev_samp(residual), 0), 9) AS std,
      round(min(residual), 9) AS min, round(max(residual), 9) AS max, round(quantile_cont(residual, 0.25), 9) AS q25,
      round(quantile_cont(residual, 0.5), 9) AS median, round(quantile_cont(residual, 0.75), 9) AS q75
      FROM ({source}) GROUP BY ALL"""


@query("residual_by_class", _box_sql("entity, actual_class", RESIDUALS), "yp")
def residual_by_class(spark, root):
    out = evaluate.residual_boxes(residuals(spark, root), ["entity", "actual_class"])
    return out.select("entity", "actual_class", "n", *r9(*BOX))


@query(
    "residual_by_hour",
    _box_sql(
        "entity, hour",
        "SELECT * FROM (SELECT entity, hour, acps - lag(acps) OVER (PARTITION BY entity ORDER BY pos) AS residual FROM ah) WHERE residual IS NOT NULL",
    ),
    "ah",
)
def residual_by_hour(spark, root):
    made = {"residual": lambda w: F.col("acps") - F.lag("acps", 1).over(w)}
    rows = windows.with_windows(hourly_scored(spark, root), made, 1).filter("residual IS NOT NULL")
    return evaluate.residual_boxes(rows, ["entity", "hour"]).select("entity", "hour", "n", *r9(*BOX))


STEPS = evaluate.DEFAULTS.error_steps


@query(
    "error_cdf",
    " UNION ALL ".join(
        f"SELECT entity, {t}::DOUBLE AS threshold, round(avg(CASE WHEN abs(y - y_hat) <= {t} THEN 1.0::DOUBLE ELSE 0 END) * 100, 9) AS pct_within FROM yp GROUP BY 1"
        for t in STEPS
    ),
    "yp",
)
def error_cdf(spark, root):
    out = evaluate.error_cdf(residuals(spark, root), ["entity"], STEPS)
    return out.withColumn("pct_within", F.round("pct_within", 9))


@query(
    "residual_summary",
    """SELECT entity, count(*) AS n, round(avg(e), 9) AS mean, round(stddev_samp(e), 9) AS std, round(median(e), 9) AS median,
       round(min(e), 9) AS min, round(max(e), 9) AS max, round(avg(abs(e)), 9) AS mae,
       round(avg(CASE WHEN abs(e) <= 1 THEN 1.0::DOUBLE ELSE 0 END) * 100, 9) AS pct_within_1,
       round(avg(CASE WHEN abs(e) <= 0.5 THEN 1.0::DOUBLE ELSE 0 END) * 100, 9) AS pct_within_05
       FROM (SELECT entity, y - y_hat AS e FROM yp) GROUP BY 1""",
    "yp",
)
def residual_summary(spark, root):
    out = evaluate.residual_summary(residuals(spark, root), ["entity"])
    return out.select(
        "entity", "n", *r9("mean", "std", "median", "min", "max", "mae", "pct_within_1", "pct_within_05")
    )


@query(
    "forecast_interval",
    """SELECT y.entity, dt, predicted, round(predicted - 1.96::DOUBLE * s, 9) AS low, round(predicted + 1.96::DOUBLE * s, 9) AS high
       FROM (SELECT entity, dt, y_hat AS predicted FROM yp) y
       JOIN (SELECT entity, stddev_samp(y - y_hat) AS s FROM yp GROUP BY 1) t ON t.entity = y.entity""",
    "yp",
)
def forecast_interval(spark, root):
    out = evaluate.forecast_interval(residuals(spark, root), ["entity"], "predicted")
    return out.select("entity", "dt", "predicted", *r9("low", "high"))


#: a feature that the ranking is not told about, so that the rule for unknown ones shows
UNRANKED = "quarter"


@query(
    "feature_deviation",
    """SELECT d.entity, dt, feature, round(value, 9) AS value, round((value - m) / CASE WHEN s > 1e-9 THEN s ELSE 1 END, 6) AS z_score,
        round(100 * greatest(0, least(1, (value - lo) / greatest(hi - lo, 1e-9::DOUBLE))), 6) AS position
        FROM dlong d JOIN (SELECT entity, feature, avg(value) AS m, stddev_samp(value) AS s, min(value) AS lo, max(value) AS hi
             FROM dlong WHERE split = 'train' GROUP BY 1, 2) t USING (entity, feature) WHERE split = 'test'""",
    "dlong",
)
def feature_deviation(spark, root):
    table = stored_table(spark, root)
    features = feature_columns(table)
    stats = profiles.feature_stats(table.filter("split = 'train'"), features)
    out = evaluate.feature_deviation(table.filter("split = 'test'"), stats, features, ["entity", "dt"])
    return out.select(
        "entity", "dt", "feature", *r9("value"), F.round("z_score", 6).alias("z_score"), F.round("position", 6).alias("position")
    )


@query(
    "rank_lookup",
    f"""WITH c AS (SELECT feature, abs(corr(value, acps)) AS r FROM dlong WHERE split = 'train' AND feature <> '{UNRANKED}' GROUP BY 1),
       s AS (SELECT feature, count(*) AS n FROM dlong WHERE split = 'test' GROUP BY 1),
       f(feature) AS (SELECT unnest([{", ".join(f"'{c}'" for c in FEATURES)}]))
       SELECT f.feature, coalesce(n, 0) AS n, round(CASE WHEN isfinite(r) THEN r ELSE 0 END, 9) AS importance
       FROM f LEFT JOIN s USING (feature) LEFT JOIN c USING (feature)""",
    "dlong",
)
def rank_lookup(spark, root):
    """Features of the test rows ranked by training correlation; 0 for those without one."""
    table = stored_table(spark, root)
    train = table.filter("split = 'train'")
    features = feature_columns(table)
    importance = profiles.target_correlation(train, "acps", [c for c in features if c != UNRANKED], ()).select(
        "feature", F.col("abs_correlation").alias("importance")
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.count(c).alias("n")) for c in features]
    )
    items = table.filter("split = 'test'").agg(cells.alias("_c")).select(F.inline("_c"))
    return evaluate.importance_rank(items, importance).select("feature", "n", *r9("importance"))
