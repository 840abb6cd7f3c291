"""Simple forecasts learnt on the training rows of each entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS, Settings
from tidepanel.operators.blocks import blocked_window
from tidepanel.operators.stats import with_group_stats
from tidepanel.operators.windows import split_label


def train_then_test(panel: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Training rows followed by test rows, validation left out, as one gap-free series
    ``seq``. The panel is gap-free, so positions follow from ``pos`` without ranking."""
    n = F.col("n_steps")
    train_end = F.floor(n * F.lit(s.train_share))
    valid_end = F.floor(n * F.lit(s.train_share + s.valid_share))
    return (
        panel.withColumn("split", split_label(F.col("pos"), n, s))
        .filter("split <> 'valid'")
        .withColumn(
            "seq",
            F.when(F.col("split") == "train", F.col("pos")).otherwise(
                F.col("pos") - valid_end + train_end
            ),
        )
    )


def shifted(series: DataFrame, column: str, offsets: dict[str, int]) -> DataFrame:
    """Value ``offset`` rows earlier in the train-then-test series."""
    made = {
        name: (lambda w, k=k: F.lag(column, k).over(w)) for name, k in offsets.items()
    }
    return blocked_window(series, ["entity"], "seq", made, max(offsets.values()))


def train_mean(column: str) -> Column:
    return F.avg(F.when(F.col("split") == "train", F.col(column)))


def offset_baselines(series: DataFrame, column: str, offsets: dict[str, int]) -> DataFrame:
    """Test rows with shifted values; where the offset reaches before the data, the
    training mean."""
    moved = with_group_stats(
        shifted(series, column, offsets), ["entity"], _train_mean=train_mean(column)
    )
    filled = {n: F.coalesce(n, "_train_mean") for n in offsets}
    return moved.filter("split = 'test'").withColumns(filled).drop("_train_mean")


def majority(train: DataFrame, column: str, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Most frequent training value; the smallest of equals. Counted before ranked."""
    counts = train.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(
        F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias("majority"),
        F.max("_n").alias("n_majority"),
    )


def baseline_table(panel: DataFrame, column: str, s: Settings = DEFAULTS) -> DataFrame:
    """Errors of all baselines on the test rows, one row per entity and model."""
    series = train_then_test(panel, s)
    offsets = {"prev_hour": 1, "prev_day_same_hour": 24, "prev_week_same_hour": 168}
    rows = offset_baselines(series, column, offsets)
    most = majority(series.filter("split = 'train'"), column).select(
        "entity", F.col("majority").alias("majority_class")
    )
    models = [*offsets, "majority_class"]
    cells = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in models]
    )
    error = F.col(column) - F.col("predicted")
    return (
        rows.join(most, "entity", "left")
        .select("entity", column, F.inline(cells))
        .groupBy("entity", "model")
        .agg(F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"))
    )
