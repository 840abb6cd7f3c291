"""Weather features and the daily roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERE_CODE = 65


def wind_parts(degrees: Column) -> tuple[Column, Column]:
    return F.sin(F.radians(degrees)), F.cos(F.radians(degrees))


def at_least(value: Column, limit: float) -> Column:
    """NULL compares as false."""
    return F.coalesce(value >= limit, F.lit(False))


def wind_bucket(speed: Column) -> Column:
    """Left-closed steps at 10, 30 and 50."""
    return (
        F.when(speed < 10, "calm")
        .when(speed < 30, "moderate")
        .when(speed < 50, "strong")
        .when(speed >= 50, "severe")
    )


def weather_features(df: DataFrame) -> DataFrame:
    sine, cosine = wind_parts(F.col("wind_direction_10m"))
    return df.withColumns(
        {
            "wind_dir_sin": sine,
            "wind_dir_cos": cosine,
            "is_severe_weather": at_least(F.col("weather_code"), SEVERE_CODE),
            "is_raining": F.coalesce(F.col("rain") > 0, F.lit(False)),
            "wind_bucket": wind_bucket(F.col("wind_speed_10m")),
        }
    )


def daily_weather(hourly: DataFrame, time: str = "ts") -> DataFrame:
    """Hourly readings to one row per day; the direction is the plain mean of degrees."""
    daily = hourly.groupBy(F.to_date(time).alias("dt")).agg(
        F.avg("temperature_2m").alias("temperature_2m"),
        F.avg("relative_humidity_2m").alias("relative_humidity_2m"),
        F.sum("precipitation").alias("precipitation"),
        F.sum("rain").alias("rain_total"),
        F.max("weather_code").alias("weather_code_max"),
        F.avg("surface_pressure").alias("surface_pressure"),
        F.avg("wind_speed_10m").alias("wind_speed_10m"),
        F.max("wind_speed_10m").alias("wind_speed_max"),
        F.avg("wind_direction_10m").alias("wind_direction_10m"),
        F.max("wind_gusts_10m").alias("wind_gusts_10m"),
        F.avg("cloud_cover").alias("cloud_cover"),
    )
    sine, cosine = wind_parts(F.col("wind_direction_10m"))
    return daily.withColumns(
        {
            "wind_dir_sin": sine,
            "wind_dir_cos": cosine,
            "is_severe_weather": at_least(F.col("weather_code_max"), SEVERE_CODE).cast("int"),
            "is_raining": F.coalesce(F.col("rain_total") > 0, F.lit(False)).cast("int"),
        }
    )
