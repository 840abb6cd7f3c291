"""Panel building, calendar, weather, windows, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.registry import FEATURES, LAGGED, query
from tidepanel.catalog.target import CLASS_COLUMNS, daily_scored, hourly_scored
from tidepanel.functions import calendar as cal
from tidepanel.functions import weather as wx
from tidepanel.operators import lookups, panel, stats, target, windows
from tidepanel.plans import model_table
from tidepanel.plans.incremental import FeatureTable
from tidepanel.session import materialize, new_path
from tidepanel.sources import bindings


def r9(*names):
    return [F.round(n, 9).alias(n) for n in names]


def sql_r9(*names):
    return ", ".join(f"round({n}, 9) AS {n}" for n in names)


# ---------------------------------------------------------------- panel


@query(
    "hourly_counts",
    """SELECT user_id % 5 AS entity, date_trunc('hour', ts) AS ts_hour, count(*) AS n_rows
       FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
def hourly_counts(spark, root):
    ev = bindings.events(spark, root).withColumn("entity", F.col("user_id") % 5)
    return panel.hourly_counts(ev, ["entity"], F.col("ts"), "n_rows")


def _sides(spark, root):
    ev = bindings.events(spark, root).withColumn("entity", F.col("user_id") % 5)
    arr = ev.filter(F.col("event_type").isin("view", "click"))
    dep = ev.filter(F.col("event_type").isin("purchase", "signup"))
    return (
        panel.hourly_counts(arr, ["entity"], F.col("ts"), "arrivals"),
        panel.hourly_counts(dep, ["entity"], F.col("ts"), "departures"),
    )


@query(
    "hourly_movements",
    """WITH a AS (SELECT user_id % 5 AS entity, date_trunc('hour', ts) AS ts_hour, count(*) AS arrivals
             FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2),
         d AS (SELECT user_id % 5 AS entity, date_trunc('hour', ts) AS ts_hour, count(*) AS departures
             FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2)
    SELECT coalesce(a.entity, d.entity) AS entity, coalesce(a.ts_hour, d.ts_hour) AS ts_hour,
        coalesce(arrivals, 0) AS arrivals, coalesce(departures, 0) AS departures,
        coalesce(arrivals, 0) + coalesce(departures, 0) AS total_movements
    FROM a FULL JOIN d ON a.entity = d.entity AND a.ts_hour = d.ts_hour""",
)
def hourly_movements(spark, root):
    return panel.combine_counts(*_sides(spark, root), ["entity", "ts_hour"])


@query(
    "gap_fill",
    "SELECT entity, ts_hour, pos, n_steps, arrivals, departures, total_movements FROM hp",
    "hp",
)
def gap_fill(spark, root):
    return bindings.hourly_panel(spark, root)


@query(
    "missing_hours",
    """SELECT entity, ts_hour FROM hp EXCEPT SELECT entity, ts_hour FROM hp0""",
    "hp",
)
def missing_hours(spark, root):
    return panel.missing_steps(bindings.hourly_counted(spark, root), ["entity"], "ts_hour", "hour")


# ---------------------------------------------------------------- calendar


@query(
    "epoch_roundtrip",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS unix_seconds,
       make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS ts_back FROM events""",
)
def epoch_roundtrip(spark, root):
    seconds = cal.to_unix(F.col("ts"))
    return bindings.events(spark, root).select(
        "event_id", seconds.alias("unix_seconds"), cal.from_unix(seconds).alias("ts_back")
    )


CALENDAR_SQL = """CAST(hour(ts_hour) AS INTEGER) AS hour, CAST(isodow(ts_hour) - 1 AS INTEGER) AS dow,
    CAST(isodow(ts_hour) >= 6 AS INTEGER) AS is_weekend, CAST(month(ts_hour) AS INTEGER) AS month,
    CAST(quarter(ts_hour) AS INTEGER) AS quarter, CAST(dayofyear(ts_hour) AS INTEGER) AS day_of_year"""


@query("calendar_parts", f"SELECT entity, ts_hour, {CALENDAR_SQL} FROM hp", "hp")
def calendar_parts(spark, root):
    return cal.calendar_parts(bindings.hourly_panel(spark, root), "ts_hour").select(
        "entity", "ts_hour", "hour", "dow", "is_weekend", "month", "quarter", "day_of_year"
    )


CYCLIC = ("hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "doy_sin", "doy_cos")
CYCLIC_SQL = ", ".join(
    f"round({fn}({value} * 2 * pi() / {period}::DOUBLE), 9) + 0.0 AS {label}_{fn}"
    for label, value, period in (
        ("hour", "hour", "24"), ("dow", "dow", "7"), ("month", "(month - 1)", "12"),
        ("doy", "day_of_year", "365.25"),
    )
    for fn in ("sin", "cos")
)


@query(
    "cyclic_encode",
    f"SELECT entity, ts_hour, {CYCLIC_SQL} FROM (SELECT entity, ts_hour, {CALENDAR_SQL} FROM hp)",
    "hp",
)
def cyclic_encode(spark, root):
    parts = cal.cyclic_parts(cal.calendar_parts(bindings.hourly_panel(spark, root), "ts_hour"))
    return parts.select(
        "entity", "ts_hour", *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in CYCLIC]
    )


@query(
    "date_labels",
    """SELECT entity, dt, dayname(dt) AS day_name, monthname(dt) AS month_name,
       upper(strftime(dt, '%a %b %d')) AS short_label FROM dp""",
    "dp",
)
def date_labels(spark, root):
    labels = cal.date_labels(F.col("dt"))
    return bindings.daily_panel(spark, root).select(
        "entity", "dt", *[c.alias(n) for n, c in labels.items()]
    )


@query(
    "date_range_filter",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1999-06-30'
         AND year(o_orderdate) IN (1997, 1999) AND isodow(o_orderdate) BETWEEN 1 AND 5""",
)
def date_range_filter(spark, root):
    """Range on the stored column (pushed to the scan), then year and weekday membership."""
    return (
        bindings.table(spark, root, "orders")
        .filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        .filter(F.col("o_orderdate") < F.lit("1999-07-01").cast("timestamp_ntz"))
        .filter(F.year("o_orderdate").isin(1997, 1999) & F.weekday("o_orderdate").isin(0, 1, 2, 3, 4))
        .select("o_orderkey", F.to_date("o_orderdate").alias("dt"))
    )


FLAGS = ("is_holiday", "is_pre_holiday", "is_post_holiday", "is_bridge_day")


def flagged(spark, root):
    return cal.holiday_flags(
        bindings.daily_panel(spark, root), bindings.holidays(spark, root), "dt"
    )


@query(
    "holiday_flags",
    "SELECT entity, dt, is_holiday, is_pre_holiday, is_post_holiday FROM flags",
    "flags",
)
def holiday_flags(spark, root):
    return flagged(spark, root).select("entity", "dt", *FLAGS[:3])


@query("bridge_days", "SELECT entity, dt, is_bridge_day FROM flags", "flags")
def bridge_days(spark, root):
    return flagged(spark, root).select("entity", "dt", "is_bridge_day")


@query(
    "holiday_effect",
    """SELECT entity, is_holiday, is_bridge_day, count(*) AS n_days,
       round(avg(total_movements), 9) AS mean_movements FROM flags GROUP BY 1, 2, 3""",
    "flags",
)
def holiday_effect(spark, root):
    return (
        flagged(spark, root)
        .groupBy("entity", "is_holiday", "is_bridge_day")
        .agg(
            F.count(F.lit(1)).alias("n_days"),
            F.round(F.avg("total_movements"), 9).alias("mean_movements"),
        )
    )


@query(
    "join_calendar",
    f"""SELECT d.entity, d.dt, d.total_movements, CAST(isodow(d.dt) - 1 AS INTEGER) AS dow,
        CAST(isodow(d.dt) >= 6 AS INTEGER) AS is_weekend, CAST(month(d.dt) AS INTEGER) AS month,
        CAST(quarter(d.dt) AS INTEGER) AS quarter, CAST(dayofyear(d.dt) AS INTEGER) AS day_of_year,
        is_holiday, is_pre_holiday, is_post_holiday, is_bridge_day
        FROM dp d JOIN flags f ON f.entity = d.entity AND f.dt = d.dt""",
    "dp flags",
)
def join_calendar(spark, root):
    """Calendar columns computed in place, holidays by key."""
    return cal.calendar_parts(flagged(spark, root), "dt").select(
        "entity", "dt", "total_movements", "dow", "is_weekend", "month", "quarter", "day_of_year", *FLAGS
    )


# ---------------------------------------------------------------- weather


WX_FEATURES = ("wind_dir_sin", "wind_dir_cos")


@query(
    "weather_features",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ts,
        round(sin(radians(wind_direction_10m)), 9) + 0.0 AS wind_dir_sin,
        round(cos(radians(wind_direction_10m)), 9) + 0.0 AS wind_dir_cos,
        weather_code >= 65 AS is_severe_weather, rain > 0 AS is_raining,
        CASE WHEN wind_speed_10m < 10 THEN 'calm' WHEN wind_speed_10m < 30 THEN 'moderate'
             WHEN wind_speed_10m < 50 THEN 'strong' ELSE 'severe' END AS wind_bucket
        FROM wx""",
    "wx",
)
def weather_features(spark, root):
    return wx.weather_features(bindings.weather_readings(spark, root)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ts",
        *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in WX_FEATURES],
        "is_severe_weather", "is_raining", "wind_bucket",
    )


@query(
    "dedupe_first",
    f"SELECT ts, {', '.join(bindings.WEATHER_COLUMNS)} FROM wxh",
    "wxh",
)
def dedupe_first(spark, root):
    return bindings.hourly_weather(spark, root)


DAY_MEANS = (
    "temperature_2m", "relative_humidity_2m", "precipitation", "rain_total", "surface_pressure",
    "wind_speed_10m", "wind_speed_max", "wind_direction_10m", "wind_gusts_10m", "cloud_cover",
)


@query(
    "weather_daily",
    f"""SELECT dt, {sql_r9(*DAY_MEANS)}, weather_code_max,
        round(sin(radians(wind_direction_10m)), 9) AS wind_dir_sin,
        round(cos(radians(wind_direction_10m)), 9) AS wind_dir_cos,
        CAST(weather_code_max >= 65 AS INTEGER) AS is_severe_weather,
        CAST(rain_total > 0 AS INTEGER) AS is_raining FROM wxd""",
    "wxd",
)
def weather_daily(spark, root):
    return wx.daily_weather(bindings.hourly_weather(spark, root)).select(
        "dt", *r9(*DAY_MEANS), "weather_code_max", *r9("wind_dir_sin", "wind_dir_cos"),
        "is_severe_weather", "is_raining",
    )


@query(
    "join_weather",
    f"""SELECT d.entity, d.dt, d.total_movements, {sql_r9('temperature_2m', 'precipitation', 'wind_speed_10m')},
        CAST(weather_code_max >= 65 AS INTEGER) AS is_severe_weather
        FROM dp d LEFT JOIN wxd w ON w.dt = d.dt""",
    "dp wxd",
)
def join_weather(spark, root):
    daily = wx.daily_weather(bindings.hourly_weather(spark, root))
    return bindings.daily_panel(spark, root).join(daily, "dt", "left").select(
        "entity", "dt", "total_movements", *r9("temperature_2m", "precipitation", "wind_speed_10m"),
        "is_severe_weather",
    )


# ---------------------------------------------------------------- windows


H_LAGS = [f"acps_lag_{k}h" for k in (1, 2, 3, 6, 12, 24, 48, 168)]
D_LAGS = [f"{label}_lag_{k}d" for k in (1, 2, 3, 7, 14, 28, 365) for label in ("acps", "movements")]
D_MEANS = [f"{label}_rmean_{n}d" for n in (7, 14, 28) for label in ("acps", "movements")]
H_MEANS = [f"acps_rmean_{n}h" for n in (3, 6, 24)]


@query("lags_hourly", f"SELECT entity, ts_hour, acps, {', '.join(H_LAGS)} FROM hfeat", "hfeat")
def lags_hourly(spark, root):
    made = windows.lag_columns("acps", "acps", windows.DEFAULTS.hourly_lags, "h")
    return windows.with_windows(hourly_scored(spark, root), made, 168).select(
        "entity", "ts_hour", "acps", *H_LAGS
    )


@query(
    "lags_daily",
    f"SELECT entity, dt, acps, total_movements, {', '.join(D_LAGS)} FROM dfeat",
    "dfeat",
)
def lags_daily(spark, root):
    lags = windows.DEFAULTS.daily_lags
    made = {
        **windows.lag_columns("acps", "acps", lags, "d"),
        **windows.lag_columns("total_movements", "movements", lags, "d"),
    }
    return windows.with_windows(daily_scored(spark, root), made, 365).select(
        "entity", "dt", "acps", "total_movements", *D_LAGS
    )


@query("rolling_mean", f"SELECT entity, dt, {', '.join(D_MEANS)} FROM dfeat", "dfeat")
def rolling_mean(spark, root):
    made = {
        **windows.trailing_columns("acps", "acps", (7, 14, 28), (), "d", 6),
        **windows.trailing_columns("total_movements", "movements", (7, 14, 28), (), "d"),
    }
    return windows.with_windows(daily_scored(spark, root), made, 28).select(
        "entity", "dt", *D_MEANS
    )


@query("rolling_std", f"SELECT entity, ts_hour, {', '.join(H_MEANS)}, round(acps_rstd_24h, 6) AS acps_rstd_24h FROM hfeat", "hfeat")
def rolling_std(spark, root):
    """The hourly means and the 24-hour deviation, one exchange."""
    made = windows.trailing_columns("acps", "acps", (3, 6, 24), (24,), "h", 6)
    return windows.with_windows(hourly_scored(spark, root), made, 24).select(
        "entity", "ts_hour", *H_MEANS, F.round("acps_rstd_24h", 6).alias("acps_rstd_24h")
    )


@query("yoy_change", "SELECT entity, dt, movements_yoy_change FROM dfeat", "dfeat")
def yoy_change(spark, root):
    made = {
        "movements_yoy_change": lambda w: F.col("total_movements")
        - F.lag("total_movements", 365).over(w)
    }
    return windows.with_windows(bindings.daily_panel(spark, root), made, 365).select(
        "entity", "dt", "movements_yoy_change"
    )


@query(
    "ratio_last_week",
    """SELECT entity, ts_hour, round(total_movements / nullif(
         lag(total_movements, 168) OVER (PARTITION BY entity ORDER BY pos), 0)::DOUBLE, 9) AS ratio_last_week
       FROM hp""",
    "hp",
)
def ratio_last_week(spark, root):
    made = {
        "ratio": lambda w: F.col("total_movements")
        / F.nullif(F.lag("total_movements", 168).over(w), F.lit(0))
    }
    return windows.with_windows(bindings.hourly_panel(spark, root), made, 168).select(
        "entity", "ts_hour", F.round("ratio", 9).alias("ratio_last_week")
    )


@query(
    "horizon_target",
    """SELECT entity, ts_hour, acps, lead(acps, 1) OVER (PARTITION BY entity ORDER BY pos) AS acps_in_1h,
       lead(acps, 3) OVER (PARTITION BY entity ORDER BY pos) AS acps_in_3h FROM ah""",
    "ah",
)
def horizon_target(spark, root):
    made = windows.horizon_columns("acps", windows.DEFAULTS.horizons, "h")
    return windows.with_windows(hourly_scored(spark, root), made, 0, 3).select(
        "entity", "ts_hour", "acps", "acps_in_1h", "acps_in_3h"
    )


@query(
    "drop_infeasible",
    f"SELECT entity, dt, acps, {sql_r9('acps_lag_28d', 'acps_lag_365d', 'acps_rstd_28d')} FROM dkept",
    "dkept",
)
def drop_infeasible(spark, root):
    featured = windows.daily_window_features(daily_scored(spark, root))
    lags = {f"{x}_lag_{k}d": k for k in (1, 2, 3, 7, 14, 28) for x in ("acps", "movements")}
    return windows.drop_infeasible(featured, lags, [*D_MEANS, "acps_rstd_28d"]).select(
        "entity", "dt", "acps", *r9("acps_lag_28d", "acps_lag_365d", "acps_rstd_28d")
    )


def daily_table(spark, root, panel=None):
    """Weather is one row per day; stored, its size is known to the planner, which then
    broadcasts it instead of shuffling the panel by date."""
    return model_table.daily_model_table(
        bindings.daily_panel(spark, root) if panel is None else panel,
        materialize(wx.daily_weather(bindings.hourly_weather(spark, root)), "weather-daily"),
        bindings.holidays(spark, root),
    )


def stored_table(spark, root, panel=None):
    """The daily model table written once, for queries that read it more than once."""
    return materialize(daily_table(spark, root, panel), "model-table")


@query("chrono_split", "SELECT entity, dt, acps, split FROM dsplit", "dsplit")
def chrono_split(spark, root):
    """The whole daily model table with its chronological split."""
    return daily_table(spark, root).select("entity", "dt", "acps", "split")


@query(
    "chrono_split_ranked",
    """SELECT entity, dt, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train'
         WHEN i < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
       FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY dt) - 1 AS i,
                    count(*) OVER (PARTITION BY entity) AS n FROM dp0)""",
    "dp0",
)
def chrono_split_ranked(spark, root):
    """The split of a table with gaps, by rank in time."""
    rows = bindings.daily_counted(spark, root).withColumn("pos", lookups.day_number("dt"))
    return windows.chrono_split(rows, "dt").select("entity", "dt", "split")


@query(
    "hourly_model_table",
    """WITH k AS (SELECT * FROM hfeat WHERE """
    + " AND ".join(f"(acps_lag_{k}h IS NOT NULL OR n_steps <= {k})" for k in (1, 2, 3, 6, 12, 24, 48, 168))
    + """ AND acps_rstd_24h IS NOT NULL),
       i AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY entity) AS n FROM k)
       SELECT i.entity, i.ts_hour, acps, acps_lag_168h, round(acps_rstd_24h, 6) AS acps_rstd_24h, wind_speed_10m,
         CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
       FROM i LEFT JOIN (SELECT ts + INTERVAL 9861 DAY AS ts, wind_speed_10m FROM wxh) w ON w.ts = i.ts_hour""",
    "hfeat wxh",
)
def hourly_model_table(spark, root):
    """The hourly table end to end; weather is moved by 27 years to the time of the events."""
    moved = bindings.hourly_weather(spark, root).withColumn("ts", F.col("ts") + F.expr("interval 9861 days"))
    table = model_table.hourly_model_table(
        bindings.hourly_panel(spark, root), materialize(moved, "weather-hourly"), bindings.holidays(spark, root)
    )
    return table.select(
        "entity", "ts_hour", "acps", "acps_lag_168h", F.round("acps_rstd_24h", 6).alias("acps_rstd_24h"),
        "wind_speed_10m", "split",
    )


@query(
    "cutoff_split",
    """SELECT entity, dt, acps, CASE WHEN dt < DATE '2000-06-01' THEN 'train' ELSE 'test' END AS split
       FROM ad""",
    "ad",
)
def cutoff_split(spark, root):
    return windows.cutoff_split(
        daily_scored(spark, root), "dt", F.lit("2000-06-01").cast("date")
    ).select("entity", "dt", "acps", "split")


def _decompose_sql(kind: str) -> str:
    flat = "CASE WHEN trend <> 0 THEN acps / trend END" if kind == "m" else "acps - trend"
    centred = "m / avg(m) OVER (PARTITION BY entity)" if kind == "m" else "m - avg(m) OVER (PARTITION BY entity)"
    rest = (
        "CASE WHEN trend * seasonal <> 0 THEN acps / (trend * seasonal) END"
        if kind == "m"
        else "acps - trend - seasonal"
    )
    return f"""SELECT b.entity, b.ts_hour, b.acps, trend, round(seasonal, 6) AS seasonal,
          round({rest}, 6) AS remainder
        FROM tr b JOIN (SELECT entity, phase, {centred} AS seasonal
              FROM (SELECT entity, phase, avg({flat}) AS m FROM tr GROUP BY 1, 2)) s
          ON s.entity = b.entity AND s.phase = b.phase"""


DECOMPOSE_SQL = f"""WITH tr AS (SELECT entity, ts_hour, acps, pos % 24 AS phase,
        CASE WHEN pos >= 12 AND pos < n_steps - 12 AND n_steps >= 48 THEN
          CAST(2 * sum(u) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN 11 PRECEDING AND 11 FOLLOWING)
           + lag(u, 12) OVER (PARTITION BY entity ORDER BY pos)
           + lead(u, 12) OVER (PARTITION BY entity ORDER BY pos) AS DOUBLE) / 48 / 1000000::DOUBLE END AS trend
      FROM (SELECT *, CAST(round(acps * 1000000) AS BIGINT) AS u FROM ah))
    SELECT 'additive' AS model, * FROM ({_decompose_sql('a')})
    UNION ALL SELECT 'multiplicative', * FROM ({_decompose_sql('m')})"""


@query("seasonal_decompose", DECOMPOSE_SQL, "ah")
def seasonal_decompose(spark, root):
    scored = hourly_scored(spark, root)
    parts = [
        windows.seasonal_decompose(scored, "acps", 24, kind == "multiplicative").select(
            F.lit(kind).alias("model"), "entity", "ts_hour", "acps",
            "trend", *[F.round(c, 6).alias(c) for c in ("seasonal", "remainder")],
        )
        for kind in ("additive", "multiplicative")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "centered_mean",
    """SELECT entity, dt, round(CASE WHEN count(*) OVER w = 3 THEN avg(acps) OVER w END, 9) AS centered_mean
       FROM ad WINDOW w AS (PARTITION BY entity ORDER BY pos ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""",
    "ad",
)
def centered_mean(spark, root):
    return windows.centered_mean(daily_scored(spark, root), "acps", "m").select(
        "entity", "dt", F.round("m", 9).alias("centered_mean")
    )


@query(
    "tail_mean",
    """SELECT entity, round(avg(acps) FILTER (pos >= n_steps - 7), 9) AS acps_last_7,
       round(avg(acps) FILTER (pos >= n_steps - 30), 9) AS acps_last_30 FROM ad GROUP BY 1""",
    "ad",
)
def tail_mean(spark, root):
    return windows.tail_mean(daily_scored(spark, root), "acps", (7, 30)).select(
        "entity", *r9("acps_last_7", "acps_last_30")
    )


@query(
    "annotated_series",
    """SELECT c.entity, c.dt, acps, congestion_class, round(p60, 9) AS p60, round(p85, 9) AS p85,
       coalesce(weather_code_max >= 65, false) AS is_severe_weather
       FROM cd c LEFT JOIN wxd w ON w.dt = c.dt""",
    "cd wxd",
)
def annotated_series(spark, root):
    daily = wx.daily_weather(bindings.hourly_weather(spark, root)).select("dt", "is_severe_weather")
    return daily_scored(spark, root, CLASS_COLUMNS).join(daily, "dt", "left").select(
        "entity", "dt", "acps", "congestion_class", *r9("p60", "p85"),
        F.coalesce(F.col("is_severe_weather") == 1, F.lit(False)).alias("is_severe_weather"),
    )


# ---------------------------------------------------------------- NULLs and lookups


def _open_panel(spark, root):
    """The daily spine with NULL where a day has no rows."""
    raw = bindings.daily_counted(spark, root)
    return panel.time_spine(raw, ["entity"], "dt", "day").join(
        raw.select("entity", "dt", (F.col("arrivals") + F.col("departures")).alias("total_movements")),
        ["entity", "dt"],
        "left",
    )


@query(
    "forward_fill",
    """SELECT d.entity, d.dt, CAST(coalesce(last_value(r.arrivals + r.departures IGNORE NULLS) OVER (
         PARTITION BY d.entity ORDER BY d.dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT)
         AS total_movements_filled
       FROM dp d LEFT JOIN dp0 r ON r.entity = d.entity AND r.dt = d.dt""",
    "dp dp0",
)
def forward_fill(spark, root):
    return windows.forward_fill(_open_panel(spark, root), ["total_movements"]).select(
        "entity", "dt", "total_movements_filled"
    )


@query(
    "median_impute",
    f"""SELECT s.entity, s.dt, s.split, {", ".join(f"round(coalesce(CAST(s.{c} AS DOUBLE), m.{c}), 9) AS {c}" for c in FEATURES)}
       FROM dfull s JOIN (SELECT entity, split, {", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in FEATURES)}
                          FROM dfull GROUP BY 1, 2) m ON m.entity = s.entity AND m.split = s.split""",
    "dfull",
)
def median_impute(spark, root):
    """All features; medians per entity and split, as learnt on that split."""
    table = stored_table(spark, root)
    features = model_table.feature_columns(table)
    return stats.median_fill(table, ["entity", "split"], features).select("entity", "dt", "split", *r9(*features))


@query(
    "asof_history",
    """SELECT event_id, e.entity, e.ts_hour, h.ts_hour AS history_hour,
         h.arrivals + h.departures AS history_movements
       FROM (SELECT event_id, user_id % 5 AS entity, date_trunc('hour', ts) AS ts_hour FROM events) e
       ASOF LEFT JOIN hp0 h ON h.entity = e.entity AND e.ts_hour > h.ts_hour""",
    "hp0",
)
def asof_history(spark, root):
    """For each event the last counted hour before its own hour."""
    targets = bindings.events(spark, root).select(
        "event_id", (F.col("user_id") % 5).alias("entity"), F.date_trunc("hour", "ts").alias("ts_hour")
    )
    history = bindings.hourly_counted(spark, root).withColumn(
        "total_movements", F.col("arrivals") + F.col("departures")
    )
    found = lookups.asof_before(targets, history, ["entity"], "ts_hour", ["total_movements"], 3600)
    return found.select(
        "event_id", "entity", "ts_hour", F.col("asof_ts_hour").alias("history_hour"),
        F.col("asof_total_movements").alias("history_movements"),
    )


@query(
    "lag_lookup",
    "WITH r AS (SELECT *, arrivals + departures AS total_movements FROM dp0) SELECT entity, dt, "
    + ", ".join(
        f"""CAST(coalesce((SELECT x.total_movements FROM r x WHERE x.entity = r.entity AND x.dt = r.dt - {k}),
        lag(total_movements) OVER w) AS DOUBLE) AS total_movements_lag_{k}d"""
        for k in (1, 2, 3, 7, 14, 28)
    )
    + """, round(coalesce(CAST((SELECT x.total_movements FROM r x WHERE x.entity = r.entity AND x.dt = r.dt - 365) AS DOUBLE),
        avg(total_movements) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)), 9) AS total_movements_lag_365d
      FROM r WINDOW w AS (PARTITION BY entity ORDER BY dt)""",
    "dp0",
)
def lag_lookup(spark, root):
    raw = bindings.daily_counted(spark, root).select(
        "entity", "dt", (F.col("arrivals") + F.col("departures")).alias("total_movements")
    )
    out = lookups.lag_by_date(raw, ["entity"], "dt", "total_movements", (1, 2, 3, 7, 14, 28))
    return out.drop("total_movements").withColumn(
        "total_movements_lag_365d", F.round("total_movements_lag_365d", 9)
    )


@query(
    "trailing_range",
    "SELECT entity, dt, "
    + ", ".join(
        f"""round(avg(arrivals + departures) OVER (PARTITION BY entity ORDER BY dt
        RANGE BETWEEN INTERVAL {w} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 9) AS total_movements_prev_{w}d"""
        for w in (7, 14, 28)
    )
    + " FROM dp0",
    "dp0",
)
def trailing_range(spark, root):
    raw = bindings.daily_raw(spark, root).select(
        "entity", "dt", (F.col("arrivals") + F.col("departures")).alias("total_movements")
    )
    out = lookups.trailing_by_date(raw, ["entity"], "dt", ["total_movements"], (7, 14, 28))
    return out.select("entity", "dt", *r9(*[f"total_movements_prev_{w}d" for w in (7, 14, 28)]))


@query(
    "context_window",
    """SELECT t.entity, t.dt AS target_date, d.dt, d.total_movements, d.dt = t.dt AS is_target
       FROM flags t JOIN dp d ON d.entity = t.entity AND d.dt BETWEEN t.dt - 7 AND t.dt + 3
       WHERE t.is_holiday = 1""",
    "flags dp",
)
def context_window(spark, root):
    """Ten days around every holiday of every entity."""
    days = flagged(spark, root)
    return lookups.context_window(
        days.select("entity", "dt", "total_movements"), days.filter("is_holiday = 1"), "dt"
    )


@query(
    "lookup_fallback",
    """WITH tr AS (SELECT * FROM psplit WHERE split = 'train'),
       l AS (SELECT entity, dayofyear(dt) AS doy, dow, avg(acps) AS m FROM tr GROUP BY 1, 2, 3),
       g AS (SELECT entity, avg(acps) AS m FROM tr GROUP BY 1)
       SELECT p.entity, p.dt, round(coalesce(l.m, g.m), 9) AS expected
       FROM psplit p JOIN g ON g.entity = p.entity
       LEFT JOIN l ON l.entity = p.entity AND l.doy = dayofyear(p.dt) AND l.dow = p.dow""",
    "psplit",
)
def lookup_fallback(spark, root):
    """Mean of the same day of year and weekday in training, else the entity's mean."""
    rows = daily_scored(spark, root).withColumns(
        {
            "split": windows.split_label(F.col("pos"), F.col("n_steps")),
            "doy": F.dayofyear("dt"),
        }
    )
    out = lookups.lookup_or_global(
        rows, rows.filter("split = 'train'"), ["entity"], ["doy", "dow"], "acps", "expected"
    )
    return out.select("entity", "dt", F.round("expected", 9).alias("expected"))


@query(
    "movement_assumption",
    """WITH g AS (SELECT entity, isodow(dt) - 1 AS dow, month(dt) AS month,
              count(*) FILTER (dt >= DATE '2001-06-01') AS n_hits,
              avg(total_movements) FILTER (dt >= DATE '2001-06-01') AS m FROM dp GROUP BY 1, 2, 3),
       t AS (SELECT entity, avg(total_movements) AS m FROM dp WHERE pos >= n_steps - 30 GROUP BY 1)
       SELECT t.entity, CAST(d AS INTEGER) AS dow, CAST(k AS INTEGER) AS month, coalesce(n_hits, 0) AS n_hits,
              CAST(trunc(CASE WHEN n_hits >= 3 THEN g.m ELSE t.m END) AS INTEGER) AS movements_assumed
       FROM t CROSS JOIN range(7) AS days(d) CROSS JOIN range(1, 13) AS months(k)
       LEFT JOIN g ON g.entity = t.entity AND g.dow = d AND g.month = k""",
    "dp",
)
def movement_assumption(spark, root):
    return lookups.movement_assumption(
        bindings.daily_panel(spark, root), "dt", F.lit("2001-06-01").cast("date")
    )


# ---------------------------------------------------------------- kept up to date


KEPT = ("arrivals", "departures", "total_movements", "acps", *LAGGED, *D_MEANS, "movements_yoy_change")


@query("incremental_table", f"SELECT entity, dt, {', '.join(KEPT)}, round(acps_rstd_28d, 9) AS acps_rstd_28d FROM dfeat", "dfeat")
def incremental_table(spark, root):
    """The feature table after three landings: old days with some missing and some wrong, newer days, then the corrections."""
    counted = bindings.daily_counted(spark, root)
    whole = target.with_phase(panel.fill_gaps(counted, ["entity"], "dt", "day"), "dt")
    scores = materialize(target.score_table(whole, target.DAILY_PHASE), "scores")
    table = FeatureTable(spark, new_path(spark, "feature-table"))
    table.create(target.score_model(scores, target.DAILY_PHASE))
    lot = F.pmod(F.xxhash64("entity", "dt"), F.lit(10))
    old = F.col("dt") < F.lit("1997-01-01").cast("date")
    wrong = F.when(lot == 1, F.col("arrivals") + 1).otherwise(F.col("arrivals"))
    table.land(counted.where(old & (lot > 0)).withColumn("arrivals", wrong), 1)
    table.land(counted.where(~old), 2)
    table.land(counted.where(old & (lot < 2)), 3)
    return table.features().select("entity", "dt", *KEPT, F.round("acps_rstd_28d", 9).alias("acps_rstd_28d"))
