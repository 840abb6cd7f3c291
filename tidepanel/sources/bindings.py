"""The given tables read as panels, weather, holidays and position reports.

Counts are the only pass over the raw tables. They are written once and read by all that
follows: gap filling and the score refer to the panel several times, and Catalyst prunes
each reference differently, so no exchange over the raw tables would be shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.config import HOLIDAYS
from tidepanel.operators.panel import fill_gaps
from tidepanel.session import materialize

READING_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
    "l_extendedprice", "l_quantity",
)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def events(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def hourly_raw(spark: SparkSession, root: str) -> DataFrame:
    """Counts per entity and hour as they occur, gaps left open."""
    def among(*kinds: str):
        return F.sum(F.when(F.col("event_type").isin(*kinds), 1).otherwise(0))

    return (
        events(spark, root)
        .groupBy((F.col("user_id") % 5).alias("entity"), F.date_trunc("hour", "ts").alias("ts_hour"))
        .agg(among("view", "click").alias("arrivals"), among("purchase", "signup").alias("departures"))
    )


def hourly_counted(spark: SparkSession, root: str) -> DataFrame:
    return materialize(hourly_raw(spark, root), "hourly-counts")


def hourly_panel(spark: SparkSession, root: str) -> DataFrame:
    return fill_gaps(hourly_counted(spark, root), ["entity"], "ts_hour", "hour")


def placed_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders with the region of their customer."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dt"))
    customer = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, root, "nation").select("n_nationkey", F.col("n_regionkey").alias("entity"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "dt", "entity")
    )


def daily_raw(spark: SparkSession, root: str) -> DataFrame:
    """Orders placed (departures) and lines shipped (arrivals) per region and day."""
    placed = placed_orders(spark, root)
    shipped = (
        table(spark, root, "lineitem")
        .select("l_orderkey", F.to_date("l_shipdate").alias("dt"))
        .join(placed.select("o_orderkey", "entity"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("entity", "dt", F.lit(1).alias("arrivals"), F.lit(0).alias("departures"))
    )
    left = placed.select("entity", "dt", F.lit(0).alias("arrivals"), F.lit(1).alias("departures"))
    return (
        shipped.unionByName(left)
        .groupBy("entity", "dt")
        .agg(F.sum("arrivals").alias("arrivals"), F.sum("departures").alias("departures"))
    )


def daily_counted(spark: SparkSession, root: str) -> DataFrame:
    return materialize(daily_raw(spark, root), "daily-counts")


def daily_panel(spark: SparkSession, root: str) -> DataFrame:
    return fill_gaps(daily_counted(spark, root), ["entity"], "dt", "day")


def weather_readings(spark: SparkSession, root: str) -> DataFrame:
    """One reading per line item. Keeps the columns that order equal hours."""
    l = table(spark, root, "lineitem")
    hours = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24).cast("int")
    ts = F.col("l_shipdate").cast("timestamp") + F.make_interval(hours=hours)
    return l.select(
        *READING_ORDER,
        ts.alias("ts"),
        (F.col("l_discount") * 300).alias("temperature_2m"),
        (40 + F.col("l_tax") * 500).alias("relative_humidity_2m"),
        (F.col("l_tax") * 100).alias("precipitation"),
        F.when(F.col("l_tax") > 0.04, (F.col("l_tax") - 0.04) * 100).otherwise(0.0).alias("rain"),
        (F.col("l_quantity") * 2).cast("int").alias("weather_code"),
        (990 + F.col("l_discount") * 300).alias("surface_pressure"),
        F.col("l_quantity").alias("wind_speed_10m"),
        (F.col("l_extendedprice") % 360).alias("wind_direction_10m"),
        (F.col("l_quantity") * 1.5).alias("wind_gusts_10m"),
        (F.col("l_linenumber") * F.lit(14.0)).alias("cloud_cover"),
    )


WEATHER_COLUMNS = (
    "temperature_2m", "relative_humidity_2m", "precipitation", "rain", "weather_code",
    "surface_pressure", "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m", "cloud_cover",
)


def hourly_weather(spark: SparkSession, root: str) -> DataFrame:
    """One reading per hour: the first in reading order."""
    from tidepanel.operators.windows import first_per_key

    return first_per_key(
        weather_readings(spark, root), ["ts"], READING_ORDER, WEATHER_COLUMNS
    )


def holidays(spark: SparkSession, root: str) -> DataFrame:
    """Fixed month-days for every year from the first order on, one year past the last."""
    years = table(spark, root, "orders").agg(
        F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi")
    )
    days = F.array(*[F.struct(F.lit(d).alias("md"), F.lit(n).alias("name")) for d, n in HOLIDAYS])
    return (
        years.select(F.explode(F.sequence("lo", F.col("hi") + 1)).alias("year"))
        .select("year", F.explode(days).alias("h"))
        .select(F.to_date(F.concat_ws("-", "year", "h.md")).alias("date"), F.col("h.name").alias("name"))
    )


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Position reports by arithmetic on the event id."""
    i = F.col("event_id")
    return events(spark, root).select(
        "event_id",
        F.date_trunc("hour", "ts").alias("snapshot_ts"),
        (F.lit(39.78) + (i * 7919) % 10000 / F.lit(10000.0) * 1.43).alias("latitude"),
        (F.lit(-4.50) + (i * 104729) % 10000 / F.lit(10000.0) * 1.87).alias("longitude"),
        ((i * 31) % 40000).alias("altitude"),
        (100 + (i * 17) % 400).alias("ground_speed"),
    )
