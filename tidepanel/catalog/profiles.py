"""Profiles, quality checks, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.registry import FEATURES, LAGGED, ROLLED, WEATHER, query
from tidepanel.catalog.series import daily_table, r9, stored_table
from tidepanel.catalog.target import daily_scored
from tidepanel.operators import profiles, quality, stats, windows
from tidepanel.plans.model_table import feature_columns
from tidepanel.session import new_path
from tidepanel.sources import bindings, files


@query(
    "seasonal_profiles",
    """SELECT entity, 'year' AS profile, CAST(year(dt) AS INTEGER) AS bucket, round(avg(acps), 9) AS mean_acps FROM ad GROUP BY 1, 2, 3
    UNION ALL SELECT entity, 'dow', CAST(isodow(dt) - 1 AS INTEGER), round(avg(acps), 9) FROM ad GROUP BY 1, 2, 3
    UNION ALL SELECT entity, 'month', CAST(month(dt) AS INTEGER), round(avg(acps), 9) FROM ad GROUP BY 1, 2, 3""",
    "ad",
)
def seasonal_profiles(spark, root):
    return profiles.seasonal_profiles(daily_scored(spark, root), "dt", "acps").withColumn(
        "mean_acps", F.round("mean_acps", 9)
    )


DOWS = [f"dow_{d}" for d in range(7)]


@query(
    "hour_dow_profile",
    "SELECT entity, CAST(hour(ts_hour) AS INTEGER) AS hour, "
    + ", ".join(
        f"round(avg(total_movements) FILTER (isodow(ts_hour) - 1 = {d}), 9) AS dow_{d}" for d in range(7)
    )
    + " FROM hp GROUP BY 1, 2",
    "hp",
)
def hour_dow_profile(spark, root):
    out = profiles.hour_dow_profile(bindings.hourly_panel(spark, root), "ts_hour", "total_movements")
    return out.select("entity", "hour", *r9(*DOWS))


@query(
    "weekly_bins",
    """SELECT entity, CAST(year(dt) AS INTEGER) AS year, CAST(dayofyear(dt) // 7 AS INTEGER) AS week_bin,
       round(avg(acps), 9) AS mean_acps FROM ad GROUP BY 1, 2, 3""",
    "ad",
)
def weekly_bins(spark, root):
    return profiles.weekly_bins(daily_scored(spark, root), "dt", "acps").withColumn(
        "mean_acps", F.round("mean_acps", 9)
    )


CORRELATED = """WITH long AS (SELECT entity, feature, corr(value, acps) AS r FROM dlong GROUP BY 1, 2),
    known AS (SELECT entity, feature, round(CASE WHEN isfinite(r) THEN r END, 9) AS correlation FROM long)"""


@query(
    "target_correlation",
    f"""{CORRELATED} SELECT entity, feature, correlation, abs(correlation) AS abs_correlation
    FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY abs(correlation) DESC NULLS LAST, feature) AS rank FROM known)
    WHERE rank <= 20""",
    "dlong",
)
def target_correlation(spark, root):
    """Top 20 features per entity by absolute correlation with the score."""
    table = stored_table(spark, root)
    out = profiles.target_correlation(table, "acps", feature_columns(table))
    best = profiles.top_per_key(
        out, ["entity"], [F.round("abs_correlation", 9).desc(), F.asc("feature")], 20
    )
    return best.select("entity", "feature", *r9("correlation", "abs_correlation"))


@query(
    "weather_correlation",
    f"""{CORRELATED} SELECT entity, feature, correlation FROM known WHERE feature IN ({", ".join(f"'{c}'" for c in WEATHER)})""",
    "dlong",
)
def weather_correlation(spark, root):
    """Signed correlation of every weather feature with the score."""
    out = profiles.target_correlation(stored_table(spark, root), "acps", WEATHER)
    return out.select("entity", "feature", *r9("correlation"))


@query(
    "autocorrelation",
    " UNION ALL ".join(
        f"""SELECT entity, CAST({k} AS INTEGER) AS lag, round(corr(acps, x), 9) AS correlation
        FROM (SELECT entity, acps, lag(acps, {k}) OVER (PARTITION BY entity ORDER BY pos) AS x FROM ad) GROUP BY 1, 2"""
        for k in (1, 7, 28, 365)
    ),
    "ad",
)
def autocorrelation(spark, root):
    out = profiles.autocorrelation(daily_scored(spark, root), "acps", (1, 7, 28, 365))
    return out.withColumn("correlation", F.round("correlation", 9))


@query(
    "crosstab_margins",
    """SELECT coalesce(CAST(entity AS VARCHAR), 'All') AS entity,
       count(*) FILTER (congestion_class = 'Low') AS "Low", count(*) FILTER (congestion_class = 'Medium') AS "Medium",
       count(*) FILTER (congestion_class = 'High') AS "High", count(*) AS "All"
       FROM cd GROUP BY ROLLUP (entity)""",
    "cd",
)
def crosstab_margins(spark, root):
    """Entity by class with margins."""
    scored = daily_scored(spark, root, ("congestion_class",))
    return profiles.crosstab_margins(scored, "entity", "congestion_class", ("Low", "Medium", "High"))


@query(
    "top_origins",
    """SELECT c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
       GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 15""",
)
def top_origins(spark, root):
    """Most frequent origins: nations by orders placed."""
    orders = bindings.table(spark, root, "orders").select("o_custkey")
    customer = bindings.table(spark, root, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return profiles.value_counts(placed, "c_nationkey", 15)


DESCRIBED = ("arrivals", "departures", "total_movements", "acps")
QUARTERS = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
DESCRIBE = ("mean", "std", "min", "max", "q25", "q50", "q75")


@query(
    "describe",
    " UNION ALL ".join(
        f"""SELECT entity, '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 9) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 9) AS q50,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 9) AS q75 FROM ad GROUP BY 1"""
        for c in DESCRIBED
    ),
    "ad",
)
def describe(spark, root):
    out = stats.describe(daily_scored(spark, root), ["entity"], DESCRIBED, QUARTERS)
    moments = [F.round(c, 6).alias(c) for c in ("mean", "std")]
    return out.select("entity", "column", "n", *moments, *r9(*DESCRIBE[2:]))


@query(
    "feature_stats",
    """SELECT entity, feature, round(avg(value), 9) AS mean, round(stddev_samp(value), 9) AS std,
        round(min(value), 9) AS min, round(max(value), 9) AS max, round(quantile_cont(value, 0.1), 9) AS p10,
        round(quantile_cont(value, 0.5), 9) AS p50, round(quantile_cont(value, 0.9), 9) AS p90
        FROM dlong WHERE split = 'train' GROUP BY 1, 2""",
    "dlong",
)
def feature_stats(spark, root):
    train = stored_table(spark, root).filter("split = 'train'")
    return profiles.feature_stats(train, feature_columns(train)).select(
        "entity", "feature", *r9("mean", "std", "min", "max", "p10", "p50", "p90")
    )


@query(
    "histogram",
    """WITH r AS (SELECT entity, min(acps) AS lo, max(acps) AS hi FROM ad GROUP BY 1),
       g AS (SELECT entity, lo, hi, CAST(unnest(range(40)) AS INTEGER) AS bin FROM r),
       c AS (SELECT a.entity, CAST(least(floor((acps - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin, count(*) AS n
             FROM ad a JOIN r ON r.entity = a.entity GROUP BY 1, 2)
       SELECT g.entity, g.bin, round(lo + g.bin * ((hi - lo) / 40), 9) AS bin_start,
              round(lo + (g.bin + 1) * ((hi - lo) / 40), 9) AS bin_end, coalesce(n, 0) AS n
       FROM g LEFT JOIN c ON c.entity = g.entity AND c.bin = g.bin""",
    "ad",
)
def histogram(spark, root):
    return profiles.histogram(daily_scored(spark, root), "acps", 40).select(
        "entity", "bin", *r9("bin_start", "bin_end"), "n"
    )


@query(
    "congestion_split",
    """SELECT a.entity, CASE WHEN acps >= m THEN 'High' ELSE 'Low' END AS level, count(*) AS n,
         round(avg(acps), 9) AS mean_acps, min(acps) AS min_acps, max(acps) AS max_acps,
         round(avg(total_movements), 9) AS mean_total_movements
       FROM ad a JOIN (SELECT entity, median(acps) AS m FROM ad GROUP BY 1) t ON t.entity = a.entity
       GROUP BY 1, 2""",
    "ad",
)
def congestion_split(spark, root):
    out = profiles.congestion_split(daily_scored(spark, root), "acps", "total_movements")
    return out.select(
        "entity", "level", "n", *r9("mean_acps"), "min_acps", "max_acps", *r9("mean_total_movements")
    )


@query(
    "dow_mean_transform",
    "SELECT entity, dt, round(avg(acps) OVER (PARTITION BY entity, dow), 9) AS dow_mean FROM ad",
    "ad",
)
def dow_mean_transform(spark, root):
    out = profiles.group_mean(daily_scored(spark, root), ["entity", "dow"], "acps", "m")
    return out.select("entity", "dt", F.round("m", 9).alias("dow_mean"))


SCALED = ("arrivals", "departures", "total_movements")


@query(
    "standard_scale",
    "SELECT d.entity, dt, "
    + ", ".join(
        f"""round(CASE WHEN s_{c} > 0 THEN (d.{c} - m_{c}) / s_{c} ELSE 0 END, 9) AS {c}_scaled,
        round(CAST(d.{c} AS DOUBLE), 9) AS {c}_restored"""
        for c in SCALED
    )
    + " FROM dp d JOIN (SELECT entity, "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)
    + " FROM dp GROUP BY 1) t ON t.entity = d.entity",
    "dp",
)
def standard_scale(spark, root):
    out = stats.standardize(bindings.daily_panel(spark, root), ["entity"], SCALED)
    return out.select("entity", "dt", *r9(*[f"{c}_{k}" for c in SCALED for k in ("scaled", "restored")]))


@query(
    "topk",
    "SELECT entity, dt, total_movements, acps FROM ad ORDER BY acps DESC, entity, dt LIMIT 20",
    "ad",
)
def topk(spark, root):
    """The 20 days of highest pressure."""
    return (
        daily_scored(spark, root)
        .select("entity", "dt", "total_movements", "acps")
        .orderBy(F.desc("acps"), "entity", "dt")
        .limit(20)
    )


@query(
    "distinct_keys",
    """SELECT entity, count(DISTINCT year(ts_hour)) AS n_years, count(DISTINCT CAST(ts_hour AS DATE)) AS n_days,
       count(DISTINCT hour(ts_hour)) AS n_hours FROM hp0 GROUP BY 1""",
    "hp0",
)
def distinct_keys(spark, root):
    """Distinct years, days and hours seen per entity, over counted hours only."""
    return bindings.hourly_raw(spark, root).groupBy("entity").agg(
        F.countDistinct(F.year("ts_hour")).alias("n_years"),
        F.countDistinct(F.to_date("ts_hour")).alias("n_days"),
        F.countDistinct(F.hour("ts_hour")).alias("n_hours"),
    )


# ---------------------------------------------------------------- quality


@query(
    "dq_duplicates",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM
       (SELECT user_id % 5 AS entity, date_trunc('hour', ts) AS ts_hour, event_type FROM events) GROUP BY entity, ts_hour, event_type)""",
)
def dq_duplicates(spark, root):
    """Equal rows once events are cut down to entity, hour and kind."""
    ev = bindings.events(spark, root)
    return quality.duplicate_rows(
        ev.select(
            (F.col("user_id") % 5).alias("entity"), F.date_trunc("hour", "ts").alias("ts_hour"), "event_type"
        )
    )


@query(
    "dq_coverage",
    """SELECT entity, count(*) AS n_rows, min(ts_hour) AS first, max(ts_hour) AS last FROM hp0 GROUP BY 1""",
    "hp0",
)
def dq_coverage(spark, root):
    return quality.coverage(bindings.hourly_raw(spark, root), "ts_hour", ["entity"])


NULLABLE = (*LAGGED, *ROLLED, "movements_yoy_change")


@query(
    "dq_nulls",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_nulls FROM dfeat" for c in NULLABLE
    )
    + ") WHERE n_nulls > 0",
    "dfeat",
)
def dq_nulls(spark, root):
    featured = windows.daily_window_features(daily_scored(spark, root))
    return quality.null_counts(featured)


@query(
    "dq_reference",
    """SELECT l_partkey, count(*) AS n_rows FROM lineitem
       WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 25) GROUP BY 1""",
)
def dq_reference(spark, root):
    """Shipped parts that are missing from the reference list of small parts."""
    reference = bindings.table(spark, root, "part").filter("p_size <= 25").select("p_partkey")
    return quality.unknown_keys(
        bindings.table(spark, root, "lineitem").select("l_partkey"), "l_partkey", reference, "p_partkey"
    )


WEATHER_CHECKED = ", ".join(bindings.WEATHER_COLUMNS)


@query(
    "dq_report",
    f"""WITH w AS (SELECT CAST(ts AS TIMESTAMP) AS ts_hour, {WEATHER_CHECKED} FROM wxh),
    r AS (
      SELECT 'movements' AS source, 'rows' AS "check", count(*) AS value FROM hp0
      UNION ALL SELECT 'movements', 'duplicates', (SELECT count(*) FROM hp0) - (SELECT count(*) FROM (SELECT DISTINCT * FROM hp0))
      UNION ALL SELECT 'movements', 'missing_columns', 1
      UNION ALL SELECT 'movements', 'nulls', CAST(coalesce(sum({" + ".join(f"({c} IS NULL)::INT" for c in ("entity", "ts_hour", "arrivals", "departures"))}), 0) AS BIGINT) FROM hp0
      UNION ALL SELECT 'movements', 'missing_steps', (SELECT count(*) FROM hp) - (SELECT count(*) FROM hp0)
      UNION ALL SELECT 'weather', 'rows', count(*) FROM w
      UNION ALL SELECT 'weather', 'duplicates', (SELECT count(*) FROM w) - (SELECT count(*) FROM (SELECT DISTINCT * FROM w))
      UNION ALL SELECT 'weather', 'missing_columns', 0
      UNION ALL SELECT 'weather', 'nulls', CAST(coalesce(sum({" + ".join(f"({c} IS NULL)::INT" for c in ("ts_hour", *bindings.WEATHER_COLUMNS))}), 0) AS BIGINT) FROM w
      UNION ALL SELECT 'weather', 'missing_steps',
          (SELECT CAST((epoch(max(ts_hour)) - epoch(min(ts_hour))) / 3600 AS BIGINT) + 1 - count(*) FROM w))
    SELECT * FROM r
    UNION ALL SELECT 'all', 'issues', count(*) FROM r WHERE "check" <> 'rows' AND value > 0""",
    "hp hp0 wxh",
)
def dq_report(spark, root):
    """Counts and all weather columns, each source scanned once."""
    return quality.report(
        {
            "movements": {
                "df": bindings.hourly_raw(spark, root),
                "required": ["entity", "ts_hour", "arrivals", "departures", "total_movements"],
                "time": "ts_hour", "keys": ["entity"], "step": "hour",
            },
            "weather": {
                "df": bindings.hourly_weather(spark, root).withColumnRenamed("ts", "ts_hour"),
                "required": ["ts_hour", *bindings.WEATHER_COLUMNS], "time": "ts_hour", "step": "hour",
            },
        }
    )


CHECKED = ("entity", "dt", "split", "acps", *FEATURES)


@query(
    "checked_load",
    """SELECT 'model_table' AS source, 'rows' AS "check", '' AS "column", count(*) AS value FROM dfull
       UNION ALL SELECT 'model_table', 'first', 'dt', CAST(min(dt) - DATE '1970-01-01' AS BIGINT) FROM dfull
       UNION ALL SELECT 'model_table', 'last', 'dt', CAST(max(dt) - DATE '1970-01-01' AS BIGINT) FROM dfull
       UNION ALL SELECT 'model_table', 'score_in_range', '', count(*) FILTER ((acps BETWEEN 0 AND 100) IS NOT TRUE) FROM dfull
       UNION ALL SELECT 'model_table', 'warm', '', count(*) FILTER ((acps_lag_365d >= 0) IS NOT TRUE) FROM dfull
       UNION ALL SELECT 'model_table', 'missing_column', 'visibility', 1
       """
    + " ".join(f"""UNION ALL SELECT 'model_table', 'nulls', '{c}', count(*) FILTER ({c} IS NULL) FROM dfull""" for c in CHECKED),
    "dfull",
)
def checked_load(spark, root):
    """The model table written by split, and checked in the pass that writes it."""
    path = new_path(spark, "checked")
    return quality.checked_load(
        daily_table(spark, root).select(*CHECKED),
        lambda df: files.write_splits(df, path),
        "model_table",
        [*CHECKED, "visibility"],
        time="dt",
        rules={"score_in_range": F.col("acps").between(0, 100), "warm": F.col("acps_lag_365d") >= 0},
    )
