"""Registration of queries and the shared SQL parts they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepanel.config import HOLIDAYS
from tidepanel.functions.weather import SEVERE_CODE
from tidepanel.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register a query; ``uses`` names the shared SQL parts its statement reads."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, root: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, root)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = statement(sql, uses.split())
        return fn

    return register


def statement(sql: str, uses: list[str]) -> str:
    """The statement with the shared parts it needs, each after what it needs itself."""
    done: list[str] = []

    def add(part: str) -> None:
        needs, _ = PARTS[part]
        for n in needs.split():
            add(n)
        if part not in done:
            done.append(part)

    for u in uses:
        add(u)
    if not done:
        return sql
    body = ",\n".join(f"{p} AS ({PARTS[p][1]})" for p in done)
    own = sql.strip()
    if own.upper().startswith("WITH "):
        return f"WITH {body},\n{own[5:]}"
    return f"WITH {body}\n{own}"


def rolling(label: str, column: str, n: int, unit: str, fn: str = "avg", kind: str = "rmean") -> str:
    frame = f"OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    value = f"{fn}({column}) {frame}"
    if fn == "avg" and column == "acps":  # whole micro-units: exact in any order
        units = "CAST(round(acps * 1000000) AS BIGINT)"
        value = f"CAST(sum({units}) {frame} AS DOUBLE) / count(*) {frame} / 1000000::DOUBLE"
    return f"{value} AS {label}_{kind}_{n}{unit}"


def lagged(label: str, column: str, n: int, unit: str) -> str:
    return f"lag({column}, {n}) OVER (PARTITION BY entity ORDER BY pos) AS {label}_lag_{n}{unit}"


HOLIDAY_VALUES = ", ".join(f"('{d}', '{n.replace(chr(39), chr(39) * 2)}')" for d, n in HOLIDAYS)

DAILY_LAG_SQL = ", ".join(
    lagged(label, column, n, "d")
    for n in (1, 2, 3, 7, 14, 28, 365)
    for label, column in (("acps", "acps"), ("movements", "total_movements"))
)
DAILY_ROLL_SQL = ", ".join(
    [
        rolling(label, column, n, "d")
        for n in (7, 14, 28)
        for label, column in (("acps", "acps"), ("movements", "total_movements"))
    ]
    + [rolling("acps", "acps", 28, "d", "stddev_samp", "rstd")]
)
HOURLY_LAG_SQL = ", ".join(lagged("acps", "acps", n, "h") for n in (1, 2, 3, 6, 12, 24, 48, 168))
HOURLY_ROLL_SQL = ", ".join(
    [rolling("acps", "acps", n, "h") for n in (3, 6, 24)]
    + [rolling("acps", "acps", 24, "h", "stddev_samp", "rstd")]
)

LAGGED = tuple(f"{label}_lag_{n}d" for n in (1, 2, 3, 7, 14, 28, 365) for label in ("acps", "movements"))
ROLLED = tuple(f"{label}_rmean_{n}d" for n in (7, 14, 28) for label in ("acps", "movements")) + ("acps_rstd_28d",)
WEATHER = (
    "temperature_2m", "relative_humidity_2m", "precipitation", "surface_pressure", "wind_speed_10m", "wind_speed_max",
    "wind_direction_10m", "wind_gusts_10m", "cloud_cover", "wind_dir_sin", "wind_dir_cos", "is_severe_weather", "is_raining",
)
# every feature of the daily model table
FEATURES = (
    "dow", "total_movements", "arrivals", "departures", "is_weekend", "month", "quarter", "dow_sin", "dow_cos", "month_sin",
    "month_cos", "doy_sin", "doy_cos", "is_holiday", "is_pre_holiday", "is_post_holiday", "is_bridge_day", *WEATHER,
    "arr_dep_imbalance", *LAGGED, *ROLLED, "movements_yoy_change",
)

# name -> (parts needed, body)
PARTS: dict[str, tuple[str, str]] = {
    "placed": (
        "",
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt, n_regionkey AS entity
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "dp0": (
        "placed",
        """SELECT entity, dt, CAST(sum(a) AS BIGINT) AS arrivals, CAST(sum(d) AS BIGINT) AS departures
        FROM (SELECT entity, dt, 0 AS a, 1 AS d FROM placed
              UNION ALL
              SELECT p.entity, CAST(l_shipdate AS DATE), 1, 0
              FROM lineitem JOIN placed p ON l_orderkey = p.o_orderkey) GROUP BY 1, 2""",
    ),
    "dp": (
        "dp0",
        """SELECT s.entity, s.dt,
            CAST(row_number() OVER (PARTITION BY s.entity ORDER BY s.dt) - 1 AS BIGINT) AS pos,
            CAST(count(*) OVER (PARTITION BY s.entity) AS BIGINT) AS n_steps,
            coalesce(c.arrivals, 0) AS arrivals, coalesce(c.departures, 0) AS departures,
            coalesce(c.arrivals, 0) + coalesce(c.departures, 0) AS total_movements
        FROM (SELECT entity, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dt
              FROM (SELECT entity, CAST(min(dt) AS TIMESTAMP) AS lo, CAST(max(dt) AS TIMESTAMP) AS hi
                    FROM dp0 GROUP BY 1)) s
        LEFT JOIN dp0 c ON c.entity = s.entity AND c.dt = s.dt""",
    ),
    "hp0": (
        "",
        """SELECT user_id % 5 AS entity, date_trunc('hour', ts) AS ts_hour,
            CAST(sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS BIGINT) AS arrivals,
            CAST(sum(CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END) AS BIGINT) AS departures
        FROM events GROUP BY 1, 2""",
    ),
    "hp": (
        "hp0",
        """SELECT s.entity, s.ts_hour,
            CAST(row_number() OVER (PARTITION BY s.entity ORDER BY s.ts_hour) - 1 AS BIGINT) AS pos,
            CAST(count(*) OVER (PARTITION BY s.entity) AS BIGINT) AS n_steps,
            coalesce(c.arrivals, 0) AS arrivals, coalesce(c.departures, 0) AS departures,
            coalesce(c.arrivals, 0) + coalesce(c.departures, 0) AS total_movements
        FROM (SELECT entity, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour
              FROM (SELECT entity, min(ts_hour) AS lo, max(ts_hour) AS hi FROM hp0 GROUP BY 1)) s
        LEFT JOIN hp0 c ON c.entity = s.entity AND c.ts_hour = s.ts_hour""",
    ),
    "dratio": (
        "dp",
        """SELECT *, total_movements / greatest(1.0::DOUBLE, phase_median) AS pressure_ratio
        FROM (SELECT *, CAST(isodow(dt) - 1 AS INTEGER) AS dow,
                CAST(median(total_movements) OVER (PARTITION BY entity, isodow(dt)) AS DOUBLE) AS phase_median
              FROM dp)""",
    ),
    "draw": (
        "dratio",
        """SELECT d.*,
            0.6::DOUBLE * CASE WHEN st > 0 THEN (total_movements - mt) / st ELSE 0 END
          + 0.4::DOUBLE * CASE WHEN sr > 0 THEN (pressure_ratio - mr) / sr ELSE 0 END AS raw
        FROM dratio d JOIN (SELECT entity, avg(total_movements) AS mt, stddev_samp(total_movements) AS st,
                avg(pressure_ratio) AS mr, stddev_samp(pressure_ratio) AS sr FROM dratio GROUP BY 1) s
          ON s.entity = d.entity""",
    ),
    "ad": (
        "draw",
        """SELECT d.*, round(CASE WHEN hi = lo THEN 50 ELSE (raw - lo) / (hi - lo) * 100 END, 6) AS acps
        FROM draw d JOIN (SELECT entity, min(raw) AS lo, max(raw) AS hi FROM draw GROUP BY 1) s
          ON s.entity = d.entity""",
    ),
    "hratio": (
        "hp",
        """SELECT *, total_movements / greatest(1.0::DOUBLE, phase_median) AS pressure_ratio
        FROM (SELECT *, CAST(hour(ts_hour) AS INTEGER) AS hour, CAST(isodow(ts_hour) - 1 AS INTEGER) AS dow,
                CAST(median(total_movements) OVER (PARTITION BY entity, hour(ts_hour), isodow(ts_hour)) AS DOUBLE) AS phase_median
              FROM hp)""",
    ),
    "hraw": (
        "hratio",
        """SELECT d.*,
            0.6::DOUBLE * CASE WHEN st > 0 THEN (total_movements - mt) / st ELSE 0 END
          + 0.4::DOUBLE * CASE WHEN sr > 0 THEN (pressure_ratio - mr) / sr ELSE 0 END AS raw
        FROM hratio d JOIN (SELECT entity, avg(total_movements) AS mt, stddev_samp(total_movements) AS st,
                avg(pressure_ratio) AS mr, stddev_samp(pressure_ratio) AS sr FROM hratio GROUP BY 1) s
          ON s.entity = d.entity""",
    ),
    "ah": (
        "hraw",
        """SELECT d.*, round(CASE WHEN hi = lo THEN 50 ELSE (raw - lo) / (hi - lo) * 100 END, 6) AS acps
        FROM hraw d JOIN (SELECT entity, min(raw) AS lo, max(raw) AS hi FROM hraw GROUP BY 1) s
          ON s.entity = d.entity""",
    ),
    "thr": (
        "ad",
        """SELECT entity, quantile_cont(acps, 0.6) AS p60, quantile_cont(acps, 0.85) AS p85
        FROM ad GROUP BY 1""",
    ),
    "cd": (
        "ad thr",
        """SELECT a.*, p60, p85,
            CASE WHEN acps <= p60 THEN 'Low' WHEN acps <= p85 THEN 'Medium' ELSE 'High' END AS congestion_class,
            CAST(acps >= p60 AS INTEGER) AS congestion_binary
        FROM ad a JOIN thr t ON t.entity = a.entity""",
    ),
    "hd": (
        "",
        f"""SELECT CAST(y || '-' || md AS DATE) AS date, name
        FROM (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 2)) AS y FROM orders),
             (VALUES {HOLIDAY_VALUES}) AS h(md, name)""",
    ),
    "wx": (
        "",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity,
            l_shipdate + to_hours(CAST((l_orderkey * 7 + l_linenumber) % 24 AS INTEGER)) AS ts,
            l_discount * 300 AS temperature_2m, 40 + l_tax * 500 AS relative_humidity_2m,
            l_tax * 100 AS precipitation,
            CASE WHEN l_tax > 0.04::DOUBLE THEN (l_tax - 0.04::DOUBLE) * 100 ELSE 0.0 END AS rain,
            CAST(l_quantity * 2 AS INTEGER) AS weather_code, 990 + l_discount * 300 AS surface_pressure,
            l_quantity AS wind_speed_10m, l_extendedprice % 360 AS wind_direction_10m,
            l_quantity * 1.5::DOUBLE AS wind_gusts_10m, CAST(l_linenumber * 14.0 AS DOUBLE) AS cloud_cover
        FROM lineitem""",
    ),
    "wxh": (
        "wx",
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY l_orderkey, l_linenumber,
                l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS rn FROM wx) WHERE rn = 1""",
    ),
    "wxd": (
        "wxh",
        """SELECT CAST(ts AS DATE) AS dt, avg(temperature_2m) AS temperature_2m,
            avg(relative_humidity_2m) AS relative_humidity_2m, sum(precipitation) AS precipitation,
            sum(rain) AS rain_total, max(weather_code) AS weather_code_max,
            avg(surface_pressure) AS surface_pressure, avg(wind_speed_10m) AS wind_speed_10m,
            max(wind_speed_10m) AS wind_speed_max, avg(wind_direction_10m) AS wind_direction_10m,
            max(wind_gusts_10m) AS wind_gusts_10m, avg(cloud_cover) AS cloud_cover
        FROM wxh GROUP BY 1""",
    ),
    "flags": (
        "dp hd",
        """SELECT d.entity, d.dt, d.total_movements, CAST(isodow(d.dt) - 1 AS INTEGER) AS dow,
            CAST(d.dt IN (SELECT date FROM hd) AS INTEGER) AS is_holiday,
            CAST(d.dt + 1 IN (SELECT date FROM hd) AS INTEGER) AS is_pre_holiday,
            CAST(d.dt - 1 IN (SELECT date FROM hd) AS INTEGER) AS is_post_holiday,
            CAST(isodow(d.dt) < 6 AND d.dt NOT IN (SELECT date FROM hd)
                 AND (d.dt - 1 IN (SELECT date FROM hd) OR isodow(d.dt - 1) >= 6)
                 AND (d.dt + 1 IN (SELECT date FROM hd) OR isodow(d.dt + 1) >= 6) AS INTEGER) AS is_bridge_day
        FROM dp d""",
    ),
    "sn": (
        "",
        """SELECT event_id, date_trunc('hour', ts) AS snapshot_ts,
            39.78::DOUBLE + (event_id * 7919) % 10000 / 10000.0::DOUBLE * 1.43::DOUBLE AS latitude,
            -4.50::DOUBLE + (event_id * 104729) % 10000 / 10000.0::DOUBLE * 1.87::DOUBLE AS longitude,
            (event_id * 31) % 40000 AS altitude, 100 + (event_id * 17) % 400 AS ground_speed FROM events""",
    ),
    "snd": (
        "sn",
        """SELECT *, 2 * 3440.065::DOUBLE * asin(sqrt(least(1.0::DOUBLE,
              pow(sin((radians(latitude) - radians(40.4936::DOUBLE)) / 2), 2)
              + cos(radians(40.4936::DOUBLE)) * cos(radians(latitude))
              * pow(sin((radians(longitude) - radians(-3.5668::DOUBLE)) / 2), 2)))) AS distance_nm FROM sn""",
    ),
    "snb": (
        "snd",
        """SELECT *, CASE WHEN distance_nm * 1.852::DOUBLE < 15 THEN 'inner'
              WHEN distance_nm * 1.852::DOUBLE < 40 THEN 'middle'
              WHEN distance_nm * 1.852::DOUBLE < 80 THEN 'outer' ELSE 'outside' END AS band FROM snd""",
    ),
    "yp": (
        "cd",
        """SELECT * FROM (SELECT entity, dt, dow, total_movements, acps AS y,
                lag(acps) OVER (PARTITION BY entity ORDER BY pos) AS y_hat, congestion_class AS c,
                lag(congestion_class) OVER (PARTITION BY entity ORDER BY pos) AS c_hat FROM cd)
           WHERE y_hat IS NOT NULL""",
    ),
    "dfeat": (
        "cd",
        f"""SELECT *, {DAILY_LAG_SQL}, {DAILY_ROLL_SQL},
            total_movements - lag(total_movements, 365) OVER (PARTITION BY entity ORDER BY pos) AS movements_yoy_change
        FROM cd""",
    ),
    "hfeat": ("ah", f"SELECT *, {HOURLY_LAG_SQL}, {HOURLY_ROLL_SQL} FROM ah"),
    "dkept": (
        "dfeat",
        "SELECT * FROM dfeat WHERE "
        + " AND ".join(
            f"({label}_lag_{n}d IS NOT NULL OR n_steps <= {n})"
            for n in (1, 2, 3, 7, 14, 28)
            for label in ("acps", "movements")
        )
        + " AND acps_rstd_28d IS NOT NULL",
    ),
    "dsplit": (
        "dkept",
        """SELECT *, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train'
              WHEN i < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'valid' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY dt) - 1 AS i,
                     count(*) OVER (PARTITION BY entity) AS n FROM dkept)""",
    ),
    # the daily model table with all its feature columns
    "dfull": (
        "dsplit flags wxd",
        """SELECT s.*, CAST(isodow(s.dt) >= 6 AS INTEGER) AS is_weekend, CAST(month(s.dt) AS INTEGER) AS month,
            CAST(quarter(s.dt) AS INTEGER) AS quarter,
            sin(s.dow * 2 * pi() / 7) AS dow_sin, cos(s.dow * 2 * pi() / 7) AS dow_cos,
            sin((month(s.dt) - 1) * 2 * pi() / 12) AS month_sin, cos((month(s.dt) - 1) * 2 * pi() / 12) AS month_cos,
            sin(dayofyear(s.dt) * 2 * pi() / 365.25::DOUBLE) AS doy_sin, cos(dayofyear(s.dt) * 2 * pi() / 365.25::DOUBLE) AS doy_cos,
            f.is_holiday, f.is_pre_holiday, f.is_post_holiday, f.is_bridge_day,
            w.temperature_2m, w.relative_humidity_2m, w.precipitation, w.surface_pressure, w.wind_speed_10m, w.wind_speed_max,
            w.wind_direction_10m, w.wind_gusts_10m, w.cloud_cover,
            sin(radians(w.wind_direction_10m)) AS wind_dir_sin, cos(radians(w.wind_direction_10m)) AS wind_dir_cos,
            CASE WHEN w.dt IS NOT NULL THEN CAST(coalesce(w.weather_code_max >= SEVERE, false) AS INTEGER) END AS is_severe_weather,
            CASE WHEN w.dt IS NOT NULL THEN CAST(coalesce(w.rain_total > 0, false) AS INTEGER) END AS is_raining,
            (s.arrivals - s.departures) / greatest(1, s.arrivals + s.departures) AS arr_dep_imbalance
        FROM dsplit s JOIN flags f ON f.entity = s.entity AND f.dt = s.dt LEFT JOIN wxd w ON w.dt = s.dt""".replace(
            "SEVERE", str(SEVERE_CODE)
        ),
    ),
    "dlong": (
        "dfull",
        f"""SELECT entity, dt, split, acps, feature, value FROM (
            UNPIVOT (SELECT entity, dt, split, acps, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)} FROM dfull)
            ON {", ".join(FEATURES)} INTO NAME feature VALUE value)""",
    ),
    # panel rows with their split taken on the whole panel, hourly and daily
    "hsplit": (
        "ah",
        """SELECT *, CASE WHEN pos < floor(n_steps * 0.7::DOUBLE) THEN 'train'
              WHEN pos < floor(n_steps * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'valid' ELSE 'test' END AS split FROM ah""",
    ),
    "psplit": (
        "cd",
        """SELECT *, CASE WHEN pos < floor(n_steps * 0.7::DOUBLE) THEN 'train'
              WHEN pos < floor(n_steps * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'valid' ELSE 'test' END AS split FROM cd""",
    ),
}
