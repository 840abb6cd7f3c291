"""Calendar expressions and the holiday join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_unix(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def from_unix(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * (2.0 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def calendar_parts(df: DataFrame, time: str) -> DataFrame:
    """Day of week (Monday = 0), weekend, month, quarter, day of year; hour if there is one."""
    t = F.col(time)
    parts = {}
    if dict(df.dtypes)[time] != "date":
        parts["hour"] = F.hour(t)
    parts |= {
        "dow": F.weekday(t),
        "is_weekend": F.weekday(t).isin(5, 6).cast("int"),
        "month": F.month(t),
        "quarter": F.quarter(t),
        "day_of_year": F.dayofyear(t),
    }
    return df.withColumns(parts)


def cyclic_parts(df: DataFrame) -> DataFrame:
    """Sine and cosine of every calendar cycle present."""
    periods = {
        "hour": ("hour", F.col("hour") if "hour" in df.columns else None, 24.0),
        "dow": ("dow", F.col("dow"), 7.0),
        "month": ("month", F.col("month") - 1, 12.0),
        "day_of_year": ("doy", F.col("day_of_year"), 365.25),
    }
    added = {}
    for source, (label, value, period) in periods.items():
        if source in df.columns:
            added[f"{label}_sin"], added[f"{label}_cos"] = cyclic(value, period)
    return df.withColumns(added)


def date_labels(date: Column) -> dict[str, Column]:
    return {
        "day_name": F.date_format(date, "EEEE"),
        "month_name": F.date_format(date, "MMMM"),
        "short_label": F.upper(F.date_format(date, "EEE MMM dd")),
    }


def holiday_marks(holidays: DataFrame) -> DataFrame:
    """One row per marked date: the holiday itself, the day before, the day after."""
    near = F.inline(
        F.array(
            *[
                F.struct(
                    F.date_add("date", shift).alias("date"),
                    F.lit(int(shift == 0)).alias("is_holiday"),
                    F.lit(int(shift == -1)).alias("is_pre_holiday"),
                    F.lit(int(shift == 1)).alias("is_post_holiday"),
                )
                for shift in (0, -1, 1)
            ]
        )
    )
    flags = ("is_holiday", "is_pre_holiday", "is_post_holiday")
    return holidays.select(near).groupBy("date").agg(*[F.max(f).alias(f) for f in flags])


def holiday_flags(df: DataFrame, holidays: DataFrame, date: str) -> DataFrame:
    """Holiday, day before, day after and bridge day, from one join on the date.

    ``date`` may be a timestamp; the day counts. The holiday table has a few rows per
    year, so Spark broadcasts it by its size.
    """
    marks = holiday_marks(holidays).withColumnRenamed("date", "_date")
    day = F.to_date(F.col(date))
    flags = ("is_holiday", "is_pre_holiday", "is_post_holiday")
    joined = df.join(marks, day == F.col("_date"), "left").drop("_date").fillna(0, list(flags))
    return joined.withColumn("is_bridge_day", bridge_day(day).cast("int"))


def bridge_day(day: Column) -> Column:
    """A working day between two days off; needs the three holiday flags."""
    before_off = (F.col("is_post_holiday") == 1) | (F.weekday(F.date_add(day, -1)) >= 5)
    after_off = (F.col("is_pre_holiday") == 1) | (F.weekday(F.date_add(day, 1)) >= 5)
    working = (F.weekday(day) < 5) & (F.col("is_holiday") == 0)
    return working & before_off & after_off
