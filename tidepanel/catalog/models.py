"""MLlib models, clustering, autoregression."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidepanel.catalog.registry import query
from tidepanel.catalog.series import stored_table
from tidepanel.operators import arma, arx, evaluate, models, stats
from tidepanel.operators.profiles import crosstab_margins
from tidepanel.config import CLUSTERED, EXOG, LIGHT
from tidepanel.plans.forecast_run import days_after_training, forecast_run, train_series
from tidepanel.plans.model_table import feature_columns
from tidepanel.session import materialize, new_path, shared_folder


def splits(table):
    return table.filter("split = 'train'"), table.filter("split <> 'train'")


def split_scores(predicted, label="acps_pred"):
    out = evaluate.regression_metrics(predicted, "acps", label, ["split"])
    return out.select("split", "n", "mae", "rmse", "r2")


def _regress(spark, root, estimator):
    table = stored_table(spark, root)
    train, held_out = splits(table)
    features = feature_columns(table)
    model = models.fit(train, features, [estimator])
    return split_scores(model.transform(models.as_doubles(held_out, features)))


def _classify(spark, root, stages_of, scale=False):
    table = stored_table(spark, root)
    train, held_out = splits(table)
    features = feature_columns(table)
    model = models.fit(models.labelled(train), features, stages_of(len(features)), scale)
    predicted = model.transform(models.as_doubles(held_out, features))
    return evaluate.classification_metrics(
        predicted, "congestion_class", "congestion_pred", ["split"]
    )


@query("gbt_regress")
def gbt_regress(spark, root):
    return _regress(spark, root, models.boosted_regressor(**LIGHT))


@query("rf_regress")
def rf_regress(spark, root):
    return _regress(spark, root, models.forest_regressor())


@query("linear_regress")
def linear_regress(spark, root):
    return _regress(spark, root, models.linear_regressor())


@query("gbt_classify")
def gbt_classify(spark, root):
    return _classify(spark, root, lambda n: models.boosted_classifier(**LIGHT))


@query("mlp_classify")
def mlp_classify(spark, root):
    return _classify(spark, root, models.perceptron, scale=True)


@query("permutation_importance")
def permutation_importance(spark, root):
    """Mean drop in R2 of every feature on the test rows, ten repeats."""
    table = stored_table(spark, root)
    features = feature_columns(table)
    model = models.fit(table.filter("split = 'train'"), features, [models.boosted_regressor(**LIGHT)])
    return models.permutation_importance(model, table.filter("split = 'test'"), features, "dt")


@query("model_roundtrip")
def model_roundtrip(spark, root):
    """Predictions of a stored and reloaded model against those of the fitted one."""
    table = stored_table(spark, root)
    train, held_out = splits(table)
    features = feature_columns(table)
    model = models.fit(train, features, [models.linear_regressor()])
    again = models.save_and_load(model, new_path(spark, "model"))
    rows = models.as_doubles(held_out, features)
    base = model.transform(rows).select("entity", "dt", F.col("acps_pred").alias("before"))
    back = again.transform(rows).select("entity", "dt", F.col("acps_pred").alias("after"))
    both = base.join(back, ["entity", "dt"])
    return both.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("before") - F.col("after"))).alias("max_difference")
    )


# ---------------------------------------------------------------- clusters

def _vectors(spark, root):
    table = stored_table(spark, root)
    scaled = stats.standardize(table.fillna(0, list(CLUSTERED)), ["entity"], CLUSTERED)
    vectors = scaled.select(
        "entity", "dt", "acps", "congestion_class", *CLUSTERED,
        array_to_vector(F.array(*[F.col(f"{c}_scaled") for c in CLUSTERED])).alias("features"),
    )
    return materialize(vectors, "vectors")


def _clustered(spark, root):
    vectors = _vectors(spark, root)
    model, _ = models.best_kmeans(vectors, 3)
    return model.transform(vectors)


@query("kmeans_assign")
def kmeans_assign(spark, root):
    return _clustered(spark, root).select("entity", "dt", "cluster")


@query("kmeans_elbow")
def kmeans_elbow(spark, root):
    vectors = _vectors(spark, root)
    rows = [(k, models.best_kmeans(vectors, k)[1]) for k in range(2, 8)]
    return spark.createDataFrame(rows, "k int, inertia double")


@query("cluster_profile")
def cluster_profile(spark, root):
    """Cluster centres in original units with their class counts."""
    out = _clustered(spark, root)
    centres = out.groupBy(F.col("cluster").cast("string").alias("cluster")).agg(
        *[F.avg(c).alias(c) for c in CLUSTERED]
    )
    table = crosstab_margins(out, "cluster", "congestion_class", ("Low", "Medium", "High"))
    return table.join(centres, "cluster", "left")


# ---------------------------------------------------------------- autoregression

@query("arx_fit")
def arx_fit(spark, root):
    return arx.fit(train_series(stored_table(spark, root)), "acps", EXOG)


@query("arx_forecast")
def arx_forecast(spark, root):
    """Every day of each entity after the training rows, forecast from those."""
    table = stored_table(spark, root)
    train = train_series(table)
    future = days_after_training(table)
    out = arx.forecast(arx.fit(train, "acps", EXOG), train, future, "acps", EXOG)
    return out.join(future.select("entity", "step", "dt", "acps"), ["entity", "step"]).select(
        "entity", "step", "dt", "acps", "forecast"
    )


@query("arx_grid")
def arx_grid(spark, root):
    """All orders with their AIC; the best of each entity is marked."""
    fits, best = arx.search(train_series(stored_table(spark, root)), "acps", EXOG)
    chosen = best.select("entity", "p", "d", "seasonal", F.lit(True).alias("is_best"))
    return fits.join(chosen, ["entity", "p", "d", "seasonal"], "left").select(
        "entity", "p", "d", "seasonal", "n", "sse", "aic", F.coalesce("is_best", F.lit(False)).alias("is_best")
    )


@query("arma_grid")
def arma_grid(spark, root):
    """All orders with and without error terms; the best of each entity is marked."""
    fits, best, _ = arma.search(train_series(stored_table(spark, root)), "acps", EXOG)
    chosen = best.select("entity", *arma.Order._fields, F.lit(True).alias("is_best"))
    return fits.join(chosen, ["entity", *arma.Order._fields], "left").select(
        "entity", *arma.Order._fields, "n", "sse", "aic", F.coalesce("is_best", F.lit(False)).alias("is_best")
    )


@query("arma_forecast")
def arma_forecast(spark, root):
    """Every day of each entity after the training rows, order (1,0,1) with its weekly twin."""
    table = stored_table(spark, root)
    train = train_series(table)
    future = days_after_training(table)
    fits, residuals = arma.fit_orders(train, "acps", EXOG, [arma.Order()])
    out = arma.forecast(fits, residuals, train, future, "acps", EXOG)
    return out.join(future.select("entity", "step", "dt", "acps"), ["entity", "step"]).select("entity", "step", "dt", "acps", "forecast")


# ---------------------------------------------------------------- end to end


@query("forecast_end_to_end")
def forecast_end_to_end(spark, root):
    """Table, baselines, autoregression, models, classifier, all stored; errors on the test rows, comparison by MAE."""
    return forecast_run(stored_table(spark, root), f"{shared_folder(spark)}/forecast-runs").comparison
