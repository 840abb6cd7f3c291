"""Raw JSON shapes: explicit schemas and their flat rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import STATE_VECTOR_FIELDS
from tidepanel.session import materialize

_STOP = "struct<name:string, code:struct<iata:string, icao:string>>"
_TIMES = "struct<arrival:bigint, departure:bigint>"
FLIGHT_TYPE = (
    "struct<flight:struct<"
    "identification:struct<number:struct<`default`:string>, callsign:string>, "
    f"time:struct<scheduled:{_TIMES}, estimated:{_TIMES}, real:{_TIMES}>, "
    f"airport:struct<origin:{_STOP}, destination:{_STOP}>, "
    "aircraft:struct<model:struct<text:string>, registration:string>, "
    "status:struct<text:string>>>"
)
_LIST = f"struct<data:array<{FLIGHT_TYPE}>>"
BOARD_SCHEMA = (
    "airport struct<pluginData:struct<schedule:struct<"
    f"arrivals:{_LIST}, departures:{_LIST}>>>"
)

SNAPSHOT_SCHEMA = (
    "timestamp_utc string, airport_lat double, airport_lon double, "
    "bounding_box struct<north:double, south:double, east:double, west:double>, flight_count bigint, "
    "flights array<struct<id:string, callsign:string, latitude:double, longitude:double, altitude:bigint, "
    "ground_speed:bigint, heading:bigint, origin_airport_iata:string, destination_airport_iata:string, "
    "airline_icao:string>>"
)

HOURLY_MEASURES = (
    "temperature_2m", "relative_humidity_2m", "precipitation", "rain", "surface_pressure",
    "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m", "cloud_cover",
)
WEATHER_SCHEMA = (
    "hourly struct<time:array<string>, "
    + ", ".join(f"{c}:array<double>" for c in HOURLY_MEASURES)
    + ", weather_code:array<int>>"
)

STATES_SCHEMA = "states array<array<string>>"

HOLIDAY_SCHEMA = (
    "date string, localName string, name string, countryCode string, `global` boolean, types array<string>"
)


class Records(NamedTuple):
    """What became of raw documents; every one is in ``valid`` or in ``rejected``."""

    valid: DataFrame  #: the other columns and the fields of the document
    rejected: DataFrame  #: all columns with the text as it came, and the ``reason``
    counts: DataFrame  #: ``reason`` (``valid`` for what passed), ``n``


def records(df: DataFrame, body: str, schema: str, required: Sequence[str] = ()) -> Records:
    """Documents of text column ``body`` by a schema, the bad ones apart with their text.

    Reasons are ``empty`` (NULL or white space), ``broken`` (cut, not JSON, or a value of another kind than the schema's) and
    ``incomplete`` (one of the ``required`` fields, named by their paths, is NULL). Documents are parsed once and stored, so both sides and the
    counts see the same result. Other columns of ``df`` are kept; none may be called ``_record`` or ``reason``.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken_text"}
    record = F.from_json(F.col(f"`{body}`"), f"{schema}, _broken_text string", options)
    lacking = F.lit(False)
    for field in required:
        lacking = lacking | F.col(f"_record.{field}").isNull()
    text = F.col(f"`{body}`")
    reason = (
        F.when(text.isNull() | text.rlike(r"^\s*$"), "empty")
        .when(F.col("_record").isNull() | F.col("_record._broken_text").isNotNull(), "broken")
        .when(lacking, "incomplete")
    )
    kept = materialize(df.withColumn("_record", record).withColumn("reason", reason), "records")
    others = [c for c in df.columns if c != body]
    fields = [f for f in kept.schema["_record"].dataType.names if f != "_broken_text"]
    return Records(
        kept.filter("reason IS NULL").select(*[f"`{c}`" for c in others], *[f"_record.`{f}`" for f in fields]),
        kept.filter("reason IS NOT NULL").drop("_record"),
        kept.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("n")),
    )


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def board_rows(boards: DataFrame, side: str) -> DataFrame:
    """One row per flight of one side of a board; missing text is '', missing times NULL."""
    label = "origin" if side == "arrivals" else "dest"
    estimated = "estimated_arrival" if side == "arrivals" else "estimated_departure"
    names = {f"place_{c}": f"{label}_{c}" for c in ("iata", "icao", "name")}
    rows = board_movements(boards, (side,)).drop("direction")
    return rows.withColumnsRenamed({**names, "estimated": estimated})


def board_movements(boards: DataFrame, sides: Sequence[str] = ("arrivals", "departures")) -> DataFrame:
    """Flights of both sides in one pass over the boards, with their ``direction``.

    The outer form of the generators keeps Spark from testing the list in a filter of its
    own, which would parse every document twice.
    """
    lists = F.array(
        *[
            F.struct(
                F.lit(side.removesuffix("s")).alias("direction"),
                F.col(f"airport.pluginData.schedule.{side}.data").alias("data"),
            )
            for side in sides
        ]
    )
    flights = (
        boards.select(F.inline_outer(lists))
        .select("direction", F.explode_outer("data").alias("f"))
        .filter("f IS NOT NULL")
        .select("direction", "f.flight.*")
    )
    arriving = F.col("direction") == "arrival"

    def place(field: str) -> Column:
        return _text(
            F.when(arriving, F.col(f"airport.origin.{field}")).otherwise(F.col(f"airport.destination.{field}"))
        )

    return flights.select(
        "direction",
        _text(F.col("identification.number.default")).alias("flight_number"),
        _text(F.col("identification.callsign")).alias("callsign"),
        place("code.iata").alias("place_iata"),
        place("code.icao").alias("place_icao"),
        place("name").alias("place_name"),
        F.col("time.scheduled.arrival").alias("scheduled_arrival"),
        F.col("time.scheduled.departure").alias("scheduled_departure"),
        F.when(arriving, F.col("time.estimated.arrival"))
        .otherwise(F.col("time.estimated.departure"))
        .alias("estimated"),
        F.col("time.real.arrival").alias("real_arrival"),
        F.col("time.real.departure").alias("real_departure"),
        _text(F.col("status.text")).alias("status_text"),
        _text(F.col("aircraft.model.text")).alias("aircraft_model"),
        _text(F.col("aircraft.registration")).alias("aircraft_reg"),
    )


def snapshot_rows(snapshots: DataFrame) -> DataFrame:
    """One row per aircraft of a snapshot."""
    return snapshots.select(
        F.to_timestamp("timestamp_utc").alias("snapshot_ts"),
        "airport_lat",
        "airport_lon",
        "flight_count",
        F.explode_outer("flights").alias("flight"),
    ).filter("flight IS NOT NULL").select(
        "snapshot_ts", "airport_lat", "airport_lon", "flight_count", "flight.*"
    )


def weather_rows(documents: DataFrame) -> DataFrame:
    """Column arrays to one row per hour."""
    kinds = {"time": "string", **dict.fromkeys(HOURLY_MEASURES, "double"), "weather_code": "int"}
    # a measure that did not arrive is an empty list, which zipping fills with NULL
    zipped = F.arrays_zip(
        *[
            F.coalesce(F.col(f"hourly.{n}"), F.array().cast(f"array<{kind}>")).alias(n)
            for n, kind in kinds.items()
        ]
    )
    rows = documents.select(F.explode_outer(zipped).alias("h")).filter("h IS NOT NULL").select("h.*")
    return rows.withColumn("ts", F.to_timestamp("time")).drop("time")


def state_rows(documents: DataFrame) -> DataFrame:
    """Positional values to named, typed columns; positions that did not arrive are NULL."""
    vector = documents.select(F.explode_outer("states").alias("v")).filter("v IS NOT NULL")
    return vector.select(
        *[
            F.get("v", F.lit(i)).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(STATE_VECTOR_FIELDS)
        ]
    )


def national_holidays(records: DataFrame, first: str, last: str) -> DataFrame:
    """Holiday records of the whole country within a range of dates. A record without
    the ``global`` mark counts as national. Only columns present are kept."""
    national = F.coalesce(F.col("global"), F.lit(True)) if "global" in records.columns else F.lit(True)
    day = F.to_date("date")
    kept = [c for c in ("name", "localName", "countryCode", "types") if c in records.columns]
    return records.filter(national & day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))).select(
        day.alias("date"), *kept
    )
