"""Sources, sinks and raw shapes.

Raw JSON is packed from rows of the given tables, one small document per row, and
unpacked again; the flat rows are the expected result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.diagnostics import RESIDUALS, residuals
from tidepanel.catalog.registry import query
from tidepanel.catalog.series import daily_table, r9
from tidepanel.session import new_path
from tidepanel.sources import bindings, files, raw


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def scan_parquet(spark, root):
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz"
    return files.read_parquet(spark, f"{root}/lineitem.parquet", schema)


def _times(**parts):
    return F.struct(*[v.cast("bigint").alias(k) for k, v in parts.items()])


def _boards(spark, root):
    """A board per order: ``o_orderkey % 3`` arrivals and one departure."""
    key, at = F.col("o_orderkey"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    none = F.lit(None).cast("bigint")

    def flight(i, stop):
        place = F.struct(
            F.col("o_orderpriority").alias("name"),
            F.struct(
                F.when(key % 7 != 0, F.substring("o_orderpriority", 1, 1)).alias("iata"),
                F.col("o_orderstatus").alias("icao"),
            ).alias("code"),
        ).alias(stop)
        return F.struct(
            F.struct(
                F.struct(
                    F.struct(F.concat_ws("-", key, i).alias("default")).alias("number"),
                    F.when(key % 5 != 0, F.concat(F.lit("C"), key)).alias("callsign"),
                ).alias("identification"),
                F.struct(
                    _times(arrival=at + i * 3600, departure=at).alias("scheduled"),
                    _times(
                        arrival=F.when(key % 2 == 0, at + i * 3600 + 60).otherwise(none),
                        departure=F.when(key % 2 == 0, at + 60).otherwise(none),
                    ).alias("estimated"),
                    _times(arrival=F.when(key % 3 == 0, at).otherwise(none), departure=none).alias("real"),
                ).alias("time"),
                F.struct(place).alias("airport"),
                F.struct(F.struct(F.lit("A320").alias("text")).alias("model")).alias("aircraft"),
                F.struct(F.col("o_orderstatus").alias("text")).alias("status"),
            ).alias("flight")
        )

    arrivals = F.when(
        key % 3 > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), key % 3), lambda i: flight(i, "origin"))
    ).otherwise(F.filter(F.array(flight(key, "origin")), lambda x: F.lit(False)))
    document = F.struct(
        F.struct(
            F.struct(
                F.struct(
                    F.struct(arrivals.alias("data")).alias("arrivals"),
                    F.struct(F.array(flight(F.lit(0).cast("bigint"), "destination")).alias("data")).alias("departures"),
                ).alias("schedule")
            ).alias("pluginData")
        ).alias("airport")
    )
    packed = bindings.table(spark, root, "orders").select(F.to_json(document).alias("body"))
    return files.parse_json(packed, "body", raw.BOARD_SCHEMA)


def _board_sql(direction: str, source: str, i: str) -> str:
    estimated = f"t0 + {i} * 3600 + 60" if direction == "arrival" else "t0 + 60"
    return f"""SELECT '{direction}' AS direction, o_orderkey || '-' || {i} AS flight_number,
      CASE WHEN o_orderkey % 5 <> 0 THEN 'C' || o_orderkey ELSE '' END AS callsign,
      CASE WHEN o_orderkey % 7 <> 0 THEN substr(o_orderpriority, 1, 1) ELSE '' END AS place_iata,
      o_orderstatus AS place_icao, o_orderpriority AS place_name, t0 + {i} * 3600 AS scheduled_arrival,
      t0 AS scheduled_departure, CASE WHEN o_orderkey % 2 = 0 THEN {estimated} END AS estimated,
      CASE WHEN o_orderkey % 3 = 0 THEN t0 END AS real_arrival, CAST(NULL AS BIGINT) AS real_departure,
      o_orderstatus AS status_text, 'A320' AS aircraft_model, '' AS aircraft_reg FROM {source}"""


@query(
    "flatten_board",
    """WITH b AS (SELECT *, CAST(epoch(o_orderdate) AS BIGINT) AS t0 FROM orders),
       x AS (SELECT *, unnest(range(1, o_orderkey % 3 + 1)) AS i FROM b) """
    + _board_sql("arrival", "x", "i")
    + " UNION ALL "
    + _board_sql("departure", "b", "0"),
)
def flatten_board(spark, root):
    return raw.board_movements(_boards(spark, root))


@query(
    "explode_snapshots",
    """SELECT date_trunc('second', ts) AS snapshot_ts, flight_count, event_id || '-' || i AS id,
         CASE WHEN event_id % 4 <> 0 THEN 'CS' || user_id END AS callsign,
         round(39.78::DOUBLE + (event_id * 7919) % 10000 / 10000.0::DOUBLE * 1.43::DOUBLE, 9) AS latitude,
         round(-4.50::DOUBLE + (event_id * 104729) % 10000 / 10000.0::DOUBLE * 1.87::DOUBLE, 9) AS longitude,
         (event_id * 31 + i) % 40000 AS altitude, 100 + (event_id * 17) % 400 AS ground_speed
       FROM (SELECT *, event_id % 3 + 1 AS flight_count, unnest(range(1, event_id % 3 + 2)) AS i FROM events)""",
)
def explode_snapshots(spark, root):
    """A snapshot document per event with one to three aircraft."""
    key = F.col("event_id")
    base = bindings.events(spark, root).withColumns(
        {
            "latitude": F.lit(39.78) + (key * 7919) % 10000 / F.lit(10000.0) * 1.43,
            "longitude": F.lit(-4.50) + (key * 104729) % 10000 / F.lit(10000.0) * 1.87,
        }
    )
    flights = F.transform(
        F.sequence(F.lit(1).cast("bigint"), key % 3 + 1),
        lambda i: F.struct(
            F.concat_ws("-", key, i).alias("id"),
            F.when(key % 4 != 0, F.concat(F.lit("CS"), "user_id")).alias("callsign"),
            F.col("latitude").alias("latitude"),
            F.col("longitude").alias("longitude"),
            ((key * 31 + i) % 40000).alias("altitude"),
            (100 + (key * 17) % 400).alias("ground_speed"),
        ),
    )
    document = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp_utc"),
        (key % 3 + 1).alias("flight_count"),
        flights.alias("flights"),
    )
    packed = base.select(F.to_json(document).alias("body"))
    rows = raw.snapshot_rows(files.parse_json(packed, "body", raw.SNAPSHOT_SCHEMA))
    return rows.select(
        "snapshot_ts", "flight_count", "id", "callsign", *r9("latitude", "longitude"), "altitude", "ground_speed"
    )


@query(
    "json_field_extract",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_field_extract(spark, root):
    return bindings.table(spark, root, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )


@query(
    "weather_unpack",
    """SELECT l_shipdate + to_hours(CAST(i AS INTEGER)) AS ts, l_discount * 300 + i AS temperature_2m,
         CASE WHEN l_linenumber <> 3 THEN l_tax * 100 END AS rain, l_quantity AS wind_speed_10m,
         CAST(l_quantity * 2 AS INTEGER) AS weather_code
       FROM (SELECT *, unnest(range(0, l_linenumber)) AS i FROM lineitem)""",
)
def weather_unpack(spark, root):
    """A column-array document per line item with ``l_linenumber`` hours."""
    number = F.col("l_linenumber") - 1
    hours, n = F.sequence(F.lit(0), number), F.abs(number) + 1
    start = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    hourly = F.struct(
        F.transform(
            hours,
            lambda i: F.date_format(F.timestamp_micros(start + i.cast("long") * 3_600_000_000), "yyyy-MM-dd'T'HH:mm"),
        ).alias("time"),
        F.transform(hours, lambda i: F.col("l_discount") * 300 + i).alias("temperature_2m"),
        # what is the same in all hours is repeated, not computed for each
        F.when(F.col("l_linenumber") != 3, F.array_repeat(F.col("l_tax") * 100, n)).alias("rain"),
        F.array_repeat("l_quantity", n).alias("wind_speed_10m"),
        F.array_repeat((F.col("l_quantity") * 2).cast("int"), n).alias("weather_code"),
    )
    packed = bindings.table(spark, root, "lineitem").select(
        F.to_json(F.struct(hourly.alias("hourly"))).alias("body")
    )
    rows = raw.weather_rows(files.parse_json(packed, "body", raw.WEATHER_SCHEMA))
    return rows.select("ts", "temperature_2m", "rain", "wind_speed_10m", "weather_code")


@query(
    "state_vectors",
    """SELECT 'a' || event_id AS icao24, CASE WHEN event_id % 3 <> 0 THEN 'CS' || user_id END AS callsign,
         event_type AS origin_country, CAST(floor(epoch(ts)) AS BIGINT) AS time_position, value AS longitude,
         event_id % 2 = 0 AS on_ground, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS DOUBLE) END AS geo_altitude,
         CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 4 AS INTEGER) END AS position_source FROM events""",
)
def state_vectors(spark, root):
    """A document per event; every second one is cut after 13 positions."""
    key = F.col("event_id")
    none = F.lit(None).cast("string")
    values = [
        F.concat(F.lit("a"), key), F.when(key % 3 != 0, F.concat(F.lit("CS"), "user_id")),
        F.col("event_type"), F.unix_timestamp("ts").cast("string"), none,
        F.col("value").cast("string"), none, none, (key % 2 == 0).cast("string"),
        none, none, none, none, F.col("user_id").cast("string"), none, none, (key % 4).cast("string"),
    ]
    width = F.when(key % 2 == 0, 17).otherwise(13)
    packed = bindings.events(spark, root).select(
        F.to_json(F.struct(F.array(F.slice(F.array(*values), F.lit(1), width)).alias("states"))).alias("body")
    )
    rows = raw.state_rows(files.parse_json(packed, "body", raw.STATES_SCHEMA))
    return rows.select(
        "icao24", "callsign", "origin_country", "time_position", "longitude", "on_ground", "geo_altitude",
        "position_source",
    )


@query(
    "holiday_filter",
    """SELECT h.date, h.name, count(o_orderkey) AS n_orders FROM hd h
       LEFT JOIN orders ON CAST(o_orderdate AS DATE) = h.date
       WHERE month(h.date) <> 8 AND h.date BETWEEN DATE '1996-03-01' AND DATE '2001-10-31' GROUP BY 1, 2""",
    "hd",
)
def holiday_filter(spark, root):
    """National holidays within a range with the orders placed on them."""
    month = F.month("date")
    marked = F.when(month == 8, False).when(month != 5, True)
    document = F.struct(F.col("date").cast("string").alias("date"), "name", marked.alias("global"))
    packed = bindings.holidays(spark, root).select(F.to_json(document).alias("body"))
    records = files.parse_json(packed, "body", raw.HOLIDAY_SCHEMA)
    days = raw.national_holidays(records, "1996-03-01", "2001-10-31")
    placed = (
        bindings.table(spark, root, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return days.join(placed, "date", "left").select(
        "date", "name", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@query("reference_lookup", "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_name = 'NATION_7'")
def reference_lookup(spark, root):
    return files.reference_row(
        bindings.table(spark, root, "nation"), "n_name", "NATION_7",
        ("n_nationkey", "n_name", "n_regionkey", "n_comment"),
    )


@query(
    "daily_traffic_scan",
    "SELECT entity, dt AS date, departures, arrivals, arrivals + departures AS total_movements FROM dp0",
    "dp0",
)
def daily_traffic_scan(spark, root):
    rows = bindings.daily_raw(spark, root).select(
        F.col("entity").alias("ENTITY"), F.col("dt").alias("FLT_DATE"), F.col("departures").alias("FLT_DEP"),
        F.col("arrivals").alias("FLT_ARR"), (F.col("arrivals") + F.col("departures")).alias("FLT_TOT"),
    )
    renames = {
        "ENTITY": "entity", "FLT_DATE": "date", "FLT_DEP": "departures", "FLT_ARR": "arrivals",
        "FLT_TOT": "total_movements",
    }
    return files.traffic_scan(rows, renames, "date", list(renames.values()))


@query(
    "union_chunks",
    """SELECT o_orderkey, o_orderdate, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_orderdate, NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""",
)
def union_chunks(spark, root):
    orders = bindings.table(spark, root, "orders")
    first = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate", "o_totalprice")
    second = orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return files.union_chunks([first, second])


@query(
    "incremental_anti",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def incremental_anti(spark, root):
    """Orders none of whose lines have landed."""
    landed = bindings.table(spark, root, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    incoming = bindings.table(spark, root, "orders").select("o_orderkey", "o_custkey")
    return files.not_landed(incoming, landed, ["o_orderkey"])


@query(
    "normalize_columns",
    "SELECT entity, ts_hour AS timestamp_hour, arrivals + departures AS total_movements FROM hp0",
    "hp0",
)
def normalize_columns(spark, root):
    rows = bindings.hourly_raw(spark, root).select(
        "entity", F.col("ts_hour").alias("timestamp"), (F.col("arrivals") + F.col("departures")).alias("movements")
    )
    return files.normalize_columns(rows)


@query(
    "write_splits",
    "SELECT entity, split, count(*) AS n_rows, min(dt) AS first, max(dt) AS last FROM dsplit GROUP BY 1, 2",
    "dsplit",
)
def write_splits(spark, root):
    """The model table written by split and read back."""
    path = new_path(spark, "splits")
    files.write_splits(daily_table(spark, root), path)
    back = files.read_parquet(spark, path)
    return back.groupBy("entity", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("dt").alias("first"), F.max("dt").alias("last")
    )


@query(
    "write_csv",
    f"SELECT entity, dt, actual, predicted, actual_class, predicted_class FROM ({RESIDUALS})",
    "yp",
)
def write_csv(spark, root):
    """The prediction table written as CSV and read back."""
    path = new_path(spark, "predictions")
    columns = ("entity", "dt", "actual", "predicted", "actual_class", "predicted_class")
    files.write_csv(residuals(spark, root).select(*columns), path)
    schema = "entity int, dt date, actual double, predicted double, actual_class string, predicted_class string"
    return files.read_csv(spark, path, schema)


@query(
    "rejected_records",
    """WITH d AS (SELECT event_type, event_id % 7 AS k, event_id % 3 AS flights,
         '{"timestamp_utc":"' || event_id || '","flight_count":' || event_id % 3 || '}' AS whole FROM events),
       b AS (SELECT event_type, k, flights, CASE k WHEN 1 THEN left(whole, length(whole) - 5) WHEN 2 THEN '<html>' || whole WHEN 3 THEN '  '
         WHEN 4 THEN NULL WHEN 5 THEN '{"flight_count":1}' WHEN 6 THEN '{"timestamp_utc":"x","flight_count":"many"}' ELSE whole END AS body FROM d)
       SELECT event_type, CASE WHEN k IN (1, 2, 6) THEN 'broken' WHEN k IN (3, 4) THEN 'empty' WHEN k = 5 THEN 'incomplete' ELSE 'valid' END AS reason,
         count(*) AS n, CAST(sum(CASE WHEN k = 0 THEN flights END) AS BIGINT) AS flights,
         CAST(sum(CASE WHEN k > 0 THEN length(body) END) AS BIGINT) AS kept_characters
       FROM b GROUP BY ALL""",
)
def rejected_records(spark, root):
    """A document per event, six of seven spoilt in one way or another: what passed, and what was put aside with its text."""
    key = F.col("event_id")
    whole = F.concat(F.lit('{"timestamp_utc":"'), key, F.lit('","flight_count":'), key % 3, F.lit("}"))
    body = (
        F.when(key % 7 == 1, F.expr("left(whole, length(whole) - 5)"))
        .when(key % 7 == 2, F.concat(F.lit("<html>"), "whole"))
        .when(key % 7 == 3, F.lit("  "))
        .when(key % 7 == 4, F.lit(None))
        .when(key % 7 == 5, F.lit('{"flight_count":1}'))
        .when(key % 7 == 6, F.lit('{"timestamp_utc":"x","flight_count":"many"}'))
        .otherwise(F.col("whole"))
    )
    documents = bindings.events(spark, root).withColumn("whole", whole).select("event_type", body.alias("body"))
    out = raw.records(documents, "body", raw.SNAPSHOT_SCHEMA, ["timestamp_utc"])
    passed = out.valid.select("event_type", F.lit("valid").alias("reason"), "flight_count", F.lit(None).cast("string").alias("body"))
    aside = out.rejected.select("event_type", "reason", F.lit(None).cast("bigint").alias("flight_count"), "body")
    return passed.unionByName(aside).groupBy("event_type", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("flight_count").alias("flights"), F.sum(F.length("body")).cast("bigint").alias("kept_characters")
    )
