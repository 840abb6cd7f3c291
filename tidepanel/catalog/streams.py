"""Streaming queries, run over all available input and checked against batch SQL.

A window is sent when it ends no later than the latest event time less the delay.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.catalog.registry import query
from tidepanel.catalog.spatial import _density_sql, rounded_density
from tidepanel.operators.stats import quantiles
from tidepanel.session import materialize, new_path
from tidepanel.sources import bindings
from tidepanel.streaming import keyed, live

CLOSED = "ts_hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


def _landed(spark, stream, label):
    out = new_path(spark, label)
    live.run_available(stream, out, new_path(spark, f"{label}-progress"))
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "stream_hourly",
    f"SELECT entity, ts_hour, arrivals, departures, arrivals + departures AS total_movements FROM hp0 WHERE {CLOSED}",
    "hp0",
)
def stream_hourly(spark, root):
    events = live.event_stream(spark, f"{root}/events.parquet")
    return _landed(spark, live.hourly_movements(events), "live-hourly")


@query(
    "stream_density",
    _density_sql().replace("FROM snb", f"FROM snb WHERE {CLOSED.replace('ts_hour', 'snapshot_ts')}"),
    "snb",
)
def stream_density(spark, root):
    i = F.col("event_id")
    reports = live.event_stream(spark, f"{root}/events.parquet").select(
        "ts",
        (F.lit(39.78) + (i * 7919) % 10000 / F.lit(10000.0) * 1.43).alias("latitude"),
        (F.lit(-4.50) + (i * 104729) % 10000 / F.lit(10000.0) * 1.87).alias("longitude"),
        ((i * 31) % 40000).alias("altitude"),
        (100 + (i * 17) % 400).alias("ground_speed"),
    )
    return rounded_density(_landed(spark, live.density(reports), "live-density"), "snapshot_ts")


@query("stream_dedupe", "SELECT event_id, ts, user_id, event_type FROM events")
def stream_dedupe(spark, root):
    """Every event sent twice, kept once."""
    events = live.event_stream(spark, f"{root}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    again = live.event_stream(spark, f"{root}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    return _landed(spark, live.first_seen(events.union(again), "event_id"), "live-dedupe")


@query("stream_incremental", "SELECT event_id, event_type, value FROM events")
def stream_incremental(spark, root):
    """Half of the events land, a run takes them, the rest lands, and a second run on the same
    checkpoint takes only that."""
    landing, out, progress = (new_path(spark, f"live-new{x}") for x in ("-landing", "", "-progress"))
    source = spark.read.parquet(f"{root}/events.parquet")
    for half in (0, 1):
        source.where(F.col("event_id") % 2 == half).write.mode("append").parquet(landing)
        events = live.event_stream(spark, landing, source.schema).select("event_id", "event_type", "value")
        live.run_available(events, out, progress)
    return spark.read.schema(events.schema).parquet(out)


@query(
    "stream_classify",
    f"""WITH t AS (SELECT entity, quantile_cont(total_movements, 0.6) AS p60, quantile_cont(total_movements, 0.85) AS p85 FROM hp GROUP BY 1),
       c AS (SELECT *, arrivals + departures AS total_movements FROM hp0 WHERE {CLOSED})
       SELECT c.entity, ts_hour, c.total_movements, CASE WHEN c.total_movements <= p60 THEN 'Low'
         WHEN c.total_movements <= p85 THEN 'Medium' ELSE 'High' END AS live_class FROM c JOIN t ON t.entity = c.entity""",
    "hp hp0",
)
def stream_classify(spark, root):
    cuts = quantiles(
        bindings.hourly_panel(spark, root), ["entity"], "total_movements", {"p60": 0.6, "p85": 0.85}
    )
    cuts = materialize(cuts, "cuts")  # stored: a micro-batch reads them and computes nothing again
    hourly = live.hourly_movements(live.event_stream(spark, f"{root}/events.parquet"))
    out = live.classify(hourly, cuts).select("entity", "ts_hour", "total_movements", "live_class")
    return _landed(spark, out, "live-class")


@query(
    "stream_revised_hours",
    "SELECT entity, ts_hour, arrivals, departures, arrivals + departures AS total_movements FROM hp0",
    "hp0",
)
def stream_revised_hours(spark, root):
    """Half of the events come first, the others, of the same hours, in a second run: the stored hours are corrected, none is closed."""
    landing, out, progress = (new_path(spark, f"revised{x}") for x in ("-landing", "", "-progress"))
    source = spark.read.parquet(f"{root}/events.parquet")
    for half in (0, 1):
        source.where(F.col("event_id") % 2 == half).write.mode("append").parquet(landing)
        keyed.revise_hours(live.event_stream(spark, landing, source.schema), out, progress)
    return keyed.revised_hours(spark, out)


@query(
    "stream_flight_states",
    """SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
       arg_max(value, (ts, event_id)) AS value, count(*) AS n_polls FROM events GROUP BY user_id""",
)
def stream_flight_states(spark, root):
    """The latest state of every key over its polls, half of which come late."""
    landing, out, progress = (new_path(spark, f"states{x}") for x in ("-landing", "", "-progress"))
    source = spark.read.parquet(f"{root}/events.parquet")
    for half in (1, 0):
        source.where(F.col("event_id") % 2 == half).write.mode("append").parquet(landing)
        polls = live.event_stream(spark, landing, source.schema).select("user_id", "ts", "event_id", "event_type", "value")
        states = keyed.latest_states(polls, "user_id", "ts", "event_id", ["event_type", "value"], "3650 days", 86_400_000)
        keyed.run_batches(states, out, progress, "update")
    found = keyed.current(keyed.batches(spark, out, states.schema), "user_id")
    return found.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event_type", "value", "n_polls")
