"""Scenario tables and next-day forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.models import splits
from tidepanel.catalog.registry import WEATHER, query
from tidepanel.catalog.series import r9, stored_table
from tidepanel.catalog.target import daily_scored
from tidepanel.config import LIGHT, WEATHER_FIELDS, WEATHER_PRESETS
from tidepanel.operators import evaluate, lookups, models, scoring
from tidepanel.operators.target import DAILY_PHASE, attach_score, fixed_class, with_phase
from tidepanel.plans.forecast_run import Estimator, fit_or_load
from tidepanel.plans.model_table import feature_columns
from tidepanel.session import materialize, shared_folder
from tidepanel.sources import bindings


def scenarios(spark, root):
    """One scenario per customer: a date, a volume and a weather preset by arithmetic."""
    key = F.col("c_custkey")
    nation = bindings.table(spark, root, "nation").select("n_nationkey", F.col("n_regionkey").alias("entity"))
    names = F.array(*[F.lit(p) for p in (*WEATHER_PRESETS, "fog")])
    return (
        bindings.table(spark, root, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("scenario_id"),
            "entity",
            F.date_add(F.lit("1996-06-01").cast("date"), (key * 13 % 2100).cast("int")).alias("dt"),
            (5 + key % 20).alias("total_movements"),
            F.get(names, (key % 5).cast("int")).alias("preset"),
        )
    )


SCENARIOS = """SELECT c_custkey AS scenario_id, n_regionkey AS entity, DATE '1996-06-01' + CAST(c_custkey * 13 % 2100 AS INTEGER) AS dt,
    5 + c_custkey % 20 AS total_movements, ['clear', 'windy', 'rain', 'storm', 'fog'][c_custkey % 5 + 1] AS preset
    FROM customer JOIN nation ON n_nationkey = c_nationkey"""

PRESET_SQL = ", ".join(
    "(" + ", ".join([f"'{n}'", *[f"{float(x)}::DOUBLE" if not f.startswith("is_") else str(x) for f, x in zip(WEATHER_FIELDS, v)]]) + ")"
    for n, v in WEATHER_PRESETS.items()
)


@query(
    "preset_join",
    f"""WITH s AS ({SCENARIOS}), p(preset, {', '.join(WEATHER_FIELDS)}) AS (VALUES {PRESET_SQL})
    SELECT scenario_id, s.preset, {', '.join(WEATHER_FIELDS)} FROM s
    JOIN p ON p.preset = CASE WHEN s.preset IN ('clear', 'windy', 'rain', 'storm') THEN s.preset ELSE 'clear' END""",
)
def preset_join(spark, root):
    return scoring.with_preset(scenarios(spark, root)).select("scenario_id", "preset", *WEATHER_FIELDS)


LAGS = (1, 2, 3, 7, 14, 28)


def _features_sql() -> str:
    exact = ", ".join(
        f"""max(acps) FILTER (h.dt = a.dt - {k}) AS xa_{k}, max(total_movements) FILTER (h.dt = a.dt - {k}) AS xm_{k}"""
        for k in (*LAGS, 365)
    )
    means = ", ".join(
        f"""avg(acps) FILTER (h.dt >= a.dt - {n} AND h.dt < a.dt) AS acps_rmean_{n}d,
        avg(total_movements) FILTER (h.dt >= a.dt - {n} AND h.dt < a.dt) AS movements_rmean_{n}d"""
        for n in (7, 14, 28)
    )
    short = ", ".join(
        f"coalesce(xa_{k}, l.acps) AS acps_lag_{k}d, CAST(coalesce(xm_{k}, l.total_movements) AS DOUBLE) AS movements_lag_{k}d"
        for k in LAGS
    )
    rounded = ", ".join(
        f"round({c}_rmean_{n}d, 9) AS {c}_rmean_{n}d" for n in (7, 14, 28) for c in ("acps", "movements") if (c, n) != ("acps", 7)
    )
    rounded += ", round(CASE WHEN s.dt - last_dt > 1 THEN week ELSE acps_rmean_7d END, 9) AS acps_rmean_7d"
    return f"""WITH s AS ({SCENARIOS}),
     a AS (SELECT DISTINCT entity, dt FROM s),
     t30 AS (SELECT entity, dt, acps, total_movements, avg(acps) OVER w AS ta, avg(total_movements) OVER w AS tm,
               avg(acps) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS week FROM ad
             WINDOW w AS (PARTITION BY entity ORDER BY pos ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
     l AS (SELECT a.entity, a.dt, t.acps, t.total_movements, ta, tm, week, t.dt AS last_dt FROM a ASOF LEFT JOIN t30 t ON t.entity = a.entity AND a.dt > t.dt),
     x AS (SELECT a.entity, a.dt, {exact}, {means},
             coalesce(stddev_samp(acps) FILTER (h.dt >= a.dt - 28 AND h.dt < a.dt), 0) AS acps_rstd_28d
           FROM a LEFT JOIN ad h ON h.entity = a.entity AND h.dt >= a.dt - 365 AND h.dt < a.dt GROUP BY 1, 2)
    SELECT s.scenario_id, s.entity, s.dt, s.total_movements, s.total_movements // 2 AS arrivals, s.total_movements - s.total_movements // 2 AS departures,
      CAST(isodow(s.dt) - 1 AS INTEGER) AS dow, CAST(s.dt IN (SELECT date FROM hd) AS INTEGER) AS is_holiday,
      CAST(s.dt + 1 IN (SELECT date FROM hd) AS INTEGER) AS is_pre_holiday,
      {short}, round(coalesce(xa_365, ta), 9) AS acps_lag_365d, round(coalesce(xm_365, tm), 9) AS movements_lag_365d,
      {rounded}, round(acps_rstd_28d, 6) AS acps_rstd_28d,
      round(s.total_movements - coalesce(xm_365, tm), 9) AS movements_yoy_change
    FROM s JOIN l ON l.entity = s.entity AND l.dt = s.dt JOIN x ON x.entity = s.entity AND x.dt = s.dt"""


@query("scenario_features", _features_sql(), "ad hd")
def scenario_features(spark, root):
    history = materialize(daily_scored(spark, root), "history")
    out = scoring.scenario_features(scenarios(spark, root), history, bindings.holidays(spark, root))
    pairs = [f"{c}_lag_{k}d" for k in LAGS for c in ("acps", "movements")]
    means = [f"{c}_rmean_{n}d" for n in (7, 14, 28) for c in ("acps", "movements")]
    return out.select(
        "scenario_id", "entity", "dt", "total_movements", "arrivals", "departures", "dow", "is_holiday", "is_pre_holiday",
        *pairs, *r9("acps_lag_365d", "movements_lag_365d", *means),
        F.round("acps_rstd_28d", 6).alias("acps_rstd_28d"), *r9("movements_yoy_change"),
    )


def _fitted(spark, root):
    """A score model and a class model on the columns a scenario can have, with the rows they were learnt from and the
    scored history; all from one stored panel. Models of the same training rows are loaded, not fitted again."""
    panel = materialize(bindings.daily_panel(spark, root), "panel")
    table = stored_table(spark, root, panel)
    known = {*WEATHER_FIELDS, "wind_direction_10m", "wind_dir_sin", "wind_dir_cos"}
    features = [c for c in feature_columns(table) if c not in WEATHER or c in known]
    train, _ = splits(table)
    wanted = {
        "score": Estimator([models.boosted_regressor(**LIGHT)]),
        "class": Estimator(models.boosted_classifier(**LIGHT), classes=True),
    }
    store = fit_or_load(train, features, wanted, f"{shared_folder(spark)}/scenario-models")
    history = materialize(attach_score(with_phase(panel, "dt"), DAILY_PHASE, ("acps",)), "history")
    return table, store, history


#: scenarios that one task scores
SCORED_ROWS = 8192


def _dealt(rows, count):
    """``count`` rows dealt evenly over tasks. A scenario is a few bytes and takes hundreds of trees, so tasks that follow the
    bytes of a file or an exchange would be few and long."""
    return rows.repartition(max(1, -(-count // SCORED_ROWS)))


def _predict(store, rows):
    """Score and class of each row. Model columns only as doubles; keys and dates stay as they are."""
    scored = store.models["score"].transform(models.as_doubles(rows, store.features))
    inner = ["features", *[f"{c}_in" for c in store.features]]
    return store.models["class"].transform(scored.drop(*inner)).withColumnRenamed("congestion_pred", "classifier_class")


@query("scenario_score")
def scenario_score(spark, root):
    """Scores one and three days out with the change against the last actual score."""
    _, store, history = _fitted(spark, root)
    asked = scenarios(spark, root)
    ahead = asked.select(
        "scenario_id", "entity", F.col("dt").alias("asked_dt"), "total_movements", "preset",
        F.explode(F.array(F.lit(1), F.lit(3))).alias("horizon"),
    ).withColumn("dt", F.date_add("asked_dt", F.col("horizon") - 1))
    rows = scoring.scenario_features(ahead, history, bindings.holidays(spark, root))
    needed = dict.fromkeys(["scenario_id", "entity", "horizon", "dt", *store.features])
    scored = _predict(store, _dealt(rows.select(*needed), ahead.count())).join(
        scoring.last_actual(history).select("entity", "last_acps"), "entity"
    )
    return scored.select(
        "scenario_id", "entity", "horizon", "dt", F.round("acps_pred", 2).alias("predicted"),
        fixed_class(F.col("acps_pred")).alias("classification"), "classifier_class",
        F.round(F.col("acps_pred") - F.col("last_acps"), 2).alias("delta_vs_last"),
    )


@query("forecast_3d")
def forecast_3d(spark, root):
    """The next three days of every entity: assumed volume, score, class and interval."""
    table, store, history = _fitted(spark, root)
    assumed = lookups.movement_assumption(history, "dt", F.lit("2000-01-01").cast("date"))
    days = scoring.next_days(history, 3).withColumns(
        {"dow": F.weekday("dt"), "month": F.month("dt"), "preset": F.lit("clear")}
    )
    asked = days.join(assumed, ["entity", "dow", "month"], "left").select(
        "entity", "dt", "days_ahead", "preset",
        F.col("movements_assumed").cast("long").alias("total_movements"),
    )
    rows = scoring.scenario_features(asked, history, bindings.holidays(spark, root))
    test = _predict(store, table.filter("split = 'test'"))
    spread = test.groupBy("entity").agg(F.stddev_samp(F.col("acps") - F.col("acps_pred")).alias("residual_std"))
    out = _predict(store, rows).join(spread, "entity")
    reach = F.col("residual_std") * evaluate.DEFAULTS.interval_factor
    return out.select(
        "entity", "dt", "days_ahead", F.col("total_movements").cast("long").alias("movements_assumed"),
        F.round("acps_pred", 2).alias("predicted"), fixed_class(F.col("acps_pred")).alias("classification"), "classifier_class",
        F.round(F.col("acps_pred") - reach, 2).alias("low"), F.round(F.col("acps_pred") + reach, 2).alias("high"),
    )
