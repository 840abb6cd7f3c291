"""As-of, trailing-range and lag lookups of target dates in a history.

Targets are reduced to distinct keys first, so many targets on one date cost one lookup;
the history may have gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.blocks import block_of, blocked_window, carry_forward, ordinal

def day_number(date: str) -> Column:
    return F.datediff(F.col(date), F.to_date(F.lit("1970-01-01"))).cast("long")


def asof_before(
    targets: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    time: str,
    columns: Sequence[str],
    step_seconds: int,
) -> DataFrame:
    """For every target the last history row strictly before its time.

    Both sides carry ``time``; the found values get the prefix ``asof_``. History times
    are unique per key.
    """
    fields = [time, *columns]
    asked = targets.select(*keys, time).distinct()
    stacked = asked.select(*keys, time, F.lit(0).alias("_side"), F.lit(None).alias("_row")).unionByName(
        history.select(*keys, time, F.lit(1).alias("_side"), F.struct(*fields).alias("_row"))
    )
    seconds = F.unix_timestamp(F.col(time).cast("timestamp"))
    found = carry_forward(
        stacked, keys, [time, "_side"], {"_row": "_found"}, block_of(seconds, 4096 * step_seconds)
    ).filter("_side = 0")
    answer = found.select(
        *keys, time, *[F.col(f"_found.{c}").alias(f"asof_{c}") for c in fields]
    )
    return targets.join(answer, [*keys, time], "left")


def trailing_by_date(
    df: DataFrame, keys: Sequence[str], date: str, columns: Sequence[str], windows: Sequence[int]
) -> DataFrame:
    """Means over the calendar window ``[d - w, d)`` for every row, gaps allowed."""
    made = {
        f"{c}_prev_{w}d": (lambda s, c=c, w=w: F.avg(c).over(s.rangeBetween(-w, -1)))
        for c in columns
        for w in windows
    }
    numbered = df.withColumn("_day", day_number(date))
    return blocked_window(numbered, keys, "_day", made, back=max(windows)).drop("_day")


def lag_by_date(
    df: DataFrame, keys: Sequence[str], date: str, column: str, lags: Sequence[int], year_lag: int = 365
) -> DataFrame:
    """Value exactly ``lag`` days earlier; else the last earlier row. The yearly lag
    falls back to the mean of the last 30 earlier rows instead."""
    ranked = ordinal(df, keys, [date], block_of(day_number(date)), "_at", "_n")
    rows = blocked_window(
        ranked,
        keys,
        "_at",
        {
            "_prev": lambda s: F.lag(column, 1).over(s),
            "_mean30": lambda s: F.avg(column).over(s.rowsBetween(-30, -1)),
        },
        back=30,
    )
    exact = {
        f"_exact_{k}": (lambda s, k=k: F.first(column).over(s.rangeBetween(-k, -k)))
        for k in (*lags, year_lag)
    }
    found = blocked_window(
        rows.withColumn("_day", day_number(date)), keys, "_day", exact, back=max(*lags, year_lag)
    )
    filled = {
        f"{column}_lag_{k}d": F.coalesce(F.col(f"_exact_{k}"), F.col("_prev")).cast("double")
        for k in lags
    }
    filled[f"{column}_lag_{year_lag}d"] = F.coalesce(
        F.col(f"_exact_{year_lag}").cast("double"), F.col("_mean30")
    )
    return found.select(*df.columns, *[c.alias(n) for n, c in filled.items()])


def context_window(
    panel: DataFrame, targets: DataFrame, date: str, before: int = 7, after: int = 3
) -> DataFrame:
    """Panel rows around each target date. The range becomes an equi-join: a target lists
    the dates of its window."""
    wanted = targets.select(
        "entity",
        F.col(date).alias("target_date"),
        F.explode(F.sequence(F.date_add(date, -before), F.date_add(date, after))).alias(date),
    )
    return wanted.join(panel, ["entity", date]).withColumn(
        "is_target", F.col(date) == F.col("target_date")
    )


def lookup_or_global(
    rows: DataFrame, train: DataFrame, keys: Sequence[str], by: Sequence[str], column: str, name: str
) -> DataFrame:
    """Training mean of the group, else the training mean of the entity.

    Sums per group serve both levels: the entity level adds up the group level."""
    groups = train.groupBy(*keys, *by).agg(F.sum(column).alias("_s"), F.count(column).alias("_c"))
    whole = groups.groupBy(*keys).agg((F.sum("_s") / F.sum("_c")).alias("_global"))
    local = groups.select(*keys, *by, (F.col("_s") / F.col("_c")).alias("_local"))
    return (
        rows.join(local, [*keys, *by], "left")
        .join(whole, list(keys), "left")
        .withColumn(name, F.coalesce("_local", "_global"))
        .drop("_local", "_global")
    )


def movement_assumption(
    panel: DataFrame, date: str, cutoff: Column, at_least: int = 3, tail: int = 30
) -> DataFrame:
    """Assumed movements per entity, day of week and month: the truncated mean since
    ``cutoff`` when there are enough rows, else that of the last rows of the series. All 84 pairs
    of an entity get a row, those that never occurred the fallback."""
    recent = F.col(date) >= cutoff
    value = F.col("total_movements")
    last_rows = F.col("n_steps") - F.col("pos") <= tail
    groups = panel.groupBy(
        "entity", F.weekday(F.col(date)).alias("dow"), F.month(F.col(date)).alias("month")
    ).agg(
        F.count(F.when(recent, 1)).alias("n_hits"),
        F.avg(F.when(recent, value)).alias("_mean"),
        F.sum(F.when(last_rows, value)).alias("_s"),
        F.count(F.when(last_rows, 1)).alias("_c"),
    )
    fallback = groups.groupBy("entity").agg((F.sum("_s") / F.sum("_c")).alias("_tail"))
    assumed = F.when(F.col("n_hits") >= at_least, F.col("_mean")).otherwise(F.col("_tail"))
    every = fallback.select("entity", "_tail", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("dow")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    )
    return every.join(groups, ["entity", "dow", "month"], "left").select(
        "entity", "dow", "month", F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
        assumed.cast("int").alias("movements_assumed"),
    )
