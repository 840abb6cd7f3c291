"""Metrics and error diagnostics. Every table is one or two aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import CLASS_LABELS, DEFAULTS, Settings
from tidepanel.operators.stats import quantiles, with_group_stats


def regression_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str]) -> DataFrame:
    """MAE, RMSE and R2; a constant truth has no R2."""
    error = F.col(actual) - F.col(predicted)
    pair = F.when(F.col(predicted).isNotNull(), F.col(actual))
    sse, sst = F.sum(error * error), F.var_pop(pair) * F.count(pair)
    return df.groupBy(*keys).agg(
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.when(sst > 0, 1 - sse / sst).alias("r2"),
    )


def confusion_counts(df: DataFrame, actual: str, predicted: str, keys: Sequence[str]) -> DataFrame:
    return (
        df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*keys, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, keys: Sequence[str], labels: Sequence[str] = CLASS_LABELS
) -> DataFrame:
    """All label pairs, zeros kept, with the share of the actual class. One aggregate."""
    pairs = [(a, p) for a in labels for p in labels]

    def hit(a: str, p: str | None = None) -> Column:
        cond = F.col(actual) == a
        if p is not None:
            cond &= F.col(predicted) == p
        else:
            cond &= F.col(predicted).isin(*labels)
        return F.count(F.when(cond, 1))

    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                hit(a, p).alias("n"), hit(a).alias("_row"),
            )
            for a, p in pairs
        ]
    )
    wide = df.groupBy(*keys).agg(cells.alias("_cells"))
    return wide.select(*keys, F.inline("_cells")).select(
        *keys, "actual", "predicted", "n",
        F.when(F.col("_row") > 0, F.col("n") / F.col("_row")).otherwise(0.0).alias("share"),
    )


def class_report(df: DataFrame, actual: str, predicted: str, keys: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support per label seen on either side. 0/0 is 0."""
    counts = confusion_counts(df, actual, predicted, keys)
    sides = F.array(
        F.struct(
            F.col("actual").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called")
        ),
        F.struct(
            F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called")
        ),
    )
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    marked = counts.select(*keys, hit.alias("_hit"), F.inline(sides))
    per = marked.groupBy(*keys, "label").agg(
        # the diagonal cell is listed on both sides
        F.sum(F.when(F.col("support") > 0, F.col("_hit")).otherwise(0)).alias("hits"),
        F.sum("support").alias("support"),
        F.sum("called").alias("called"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    p, r = F.col("precision"), F.col("recall")
    return (
        per.withColumn("precision", ratio(F.col("hits"), F.col("called")))
        .withColumn("recall", ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", ratio(2 * p * r, p + r))
    )


def class_report_with_averages(df: DataFrame, actual: str, predicted: str, keys: Sequence[str]) -> DataFrame:
    """The report with macro and support-weighted rows."""
    report = class_report(df, actual, predicted, keys)
    metrics = ("precision", "recall", "f1")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / F.sum("support")

    def line(label: str, of) -> Column:
        return F.struct(
            F.lit(label).alias("label"), *[of(c).alias(c) for c in metrics], F.sum("support").alias("support")
        )

    averages = report.groupBy(*keys).agg(
        F.array(line("macro avg", F.avg), line("weighted avg", weighted)).alias("_lines")
    )
    return report.select(*keys, "label", *metrics, "support").unionByName(
        averages.select(*keys, F.inline("_lines"))
    )


def classification_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str]) -> DataFrame:
    """Accuracy, macro F1 over all labels seen, balanced accuracy over true labels."""
    report = class_report(df, actual, predicted, keys)
    return report.groupBy(*keys).agg(
        F.sum("support").alias("n"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
    )


def compare_models(results: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long ``(keys, model, metric, value)`` rows to one row per model, best MAE first."""
    wide = results.groupBy(*keys, "model").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    )
    return wide.orderBy(*keys, F.asc_nulls_last("mae"), "model")


def residual_table(df: DataFrame, time: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(
        "entity", time, F.col("y").alias("actual"), F.col("y_hat").alias("predicted"),
        (F.col("y") - F.col("y_hat")).alias("residual"),
        F.col("c").alias("actual_class"), F.col("c_hat").alias("predicted_class"), *keep,
    )


def residual_boxes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Count, mean, deviation (0 for one row) and box values of the residual per group."""
    moments = df.groupBy(*by).agg(
        F.count("residual").alias("n"),
        F.avg("residual").alias("mean"),
        F.coalesce(F.stddev_samp("residual"), F.lit(0.0)).alias("std"),
        F.min("residual").alias("min"),
        F.max("residual").alias("max"),
    )
    boxes = quantiles(df, by, "residual", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return moments.join(boxes, list(by))


def error_cdf(df: DataFrame, keys: Sequence[str], steps: Sequence[float]) -> DataFrame:
    """Percent of rows within each absolute error, all steps in one aggregate."""
    within = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            (F.avg(F.when(F.abs("residual") <= t, 1.0).otherwise(0.0)) * 100).alias("pct_within"),
        )
        for t in steps
    ]
    wide = df.groupBy(*keys).agg(F.array(*within).alias("_w"))
    return wide.select(*keys, F.inline("_w"))


def residual_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    def share(t: float) -> Column:
        return F.avg(F.when(F.abs("residual") <= t, 1.0).otherwise(0.0)) * 100

    moments = df.groupBy(*keys).agg(
        F.count("residual").alias("n"),
        F.avg("residual").alias("mean"),
        F.stddev_samp("residual").alias("std"),
        F.min("residual").alias("min"),
        F.max("residual").alias("max"),
        F.avg(F.abs("residual")).alias("mae"),
        share(1.0).alias("pct_within_1"),
        share(0.5).alias("pct_within_05"),
    )
    return moments.join(quantiles(df, keys, "residual", {"median": 0.5}), list(keys))


def forecast_interval(df: DataFrame, keys: Sequence[str], predicted: str, s: Settings = DEFAULTS) -> DataFrame:
    """Symmetric interval from the sample deviation of the entity's residuals."""
    out = with_group_stats(df, keys, residual_std=F.stddev_samp("residual"))
    reach = F.col("residual_std") * s.interval_factor
    return out.withColumns(
        {"low": F.col(predicted) - reach, "high": F.col(predicted) + reach}
    )


def showdown(df: DataFrame, actual: str, models: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """Every model's value and residual per day, long form."""
    cells = F.array(
        *[
            F.struct(F.lit(label).alias("model"), F.col(c).cast("double").alias("predicted"))
            for label, c in models.items()
        ]
    )
    return df.select(*keep, actual, F.inline(cells)).withColumn(
        "residual", F.col(actual) - F.col("predicted")
    )


def feature_deviation(
    rows: DataFrame, stats: DataFrame, features: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Each value against its training distribution: z-score and position in the range."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
            for c in features
        ]
    )
    long = rows.select(*keep, F.inline(cells)).filter(F.col("value").isNotNull())
    joined = long.join(stats, ["entity", "feature"])
    spread = F.when(F.col("std") > 1e-9, F.col("std")).otherwise(1.0)
    reach = F.greatest(F.col("max") - F.col("min"), F.lit(1e-9))
    place = (F.col("value") - F.col("min")) / reach
    return joined.withColumns(
        {
            "z_score": (F.col("value") - F.col("mean")) / spread,
            "position": 100.0 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), place)),
        }
    )


def importance_rank(items: DataFrame, importance: DataFrame) -> DataFrame:
    """Features with their importance, 0 where none is known, best first."""
    return (
        items.join(importance, "feature", "left")
        .withColumn("importance", F.coalesce("importance", F.lit(0.0)))
        .orderBy(F.desc("importance"), "feature")
    )
