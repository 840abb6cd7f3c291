"""Fitted models kept with what they were learnt from, and the forecasting run that uses them.

A store is keyed by a hash of the training rows and of the estimators. Where that hash is known the models are loaded,
otherwise they are fitted and saved. The entry of a store is written last, so a run that broke off leaves nothing to load.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.param import Params
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.config import CLASS_LABELS, DEFAULTS, EXOG, LIGHT
from tidepanel.operators import arx, baselines, evaluate, models
from tidepanel.plans.model_table import feature_columns
from tidepanel.session import materialize, new_path

ERRORS = ("mae", "rmse", "r2")
ENTRY = "path string, asked string, labels string"
HITS = ("accuracy", "f1_macro", "balanced_accuracy")


class Estimator(NamedTuple):
    """Last stages of a pipeline. With ``classes`` it learns from the rows whose class is known."""

    stages: list
    classes: bool = False


class Store(NamedTuple):
    models: dict[str, PipelineModel]
    tables: dict[str, DataFrame]
    features: list[str]
    reused: bool  #: loaded, nothing was fitted


class Run(NamedTuple):
    comparison: DataFrame  #: one row a model, best MAE first, the classifier last
    predictions: DataFrame  #: entity, dt, model, acps, predicted of the test rows
    classes: DataFrame  #: entity, dt, congestion_class, congestion_pred of the test rows
    store: Store


def fingerprint(rows: DataFrame) -> str:
    """Hash of a table's columns and rows, whatever the order of either; repeated rows count.

    Two sums and an exclusive or over hashes of the rows, so it is one pass with partial aggregates. Doubles
    count to nine places. NULL differs from every value, in each column by itself.
    """
    kinds = sorted(rows.dtypes)
    cells = [F.round(f"`{c}`", 9) if t in ("double", "float") else F.col(f"`{c}`") for c, t in kinds]
    known = [F.col(f"`{c}`").isNull() for c, _ in kinds]
    hashed = rows.select(F.xxhash64(*cells, *known).alias("a"), F.xxhash64(F.lit("b"), *cells, *known).alias("b"))
    sums = [F.sum(F.col(c).cast("decimal(20,0)")).cast("string") for c in ("a", "b")]
    total = hashed.agg(F.count(F.lit(1)), *sums, F.bit_xor("a")).first()
    return hashlib.sha256(json.dumps([kinds, list(total)], default=str).encode()).hexdigest()


def described(stage: Params) -> list:
    """Kind and parameters of an estimator, without the name that it gets anew in each session."""
    values = {}
    for p, v in stage.extractParamMap().items():
        values[p.name] = described(v) if isinstance(v, Params) else repr(v)
    return [type(stage).__name__, sorted(values.items(), key=lambda x: x[0])]


def _known_path(spark: SparkSession, entry: str) -> str | None:
    """Where an entry's models are; None without an entry, or with one that was not written to its end."""
    try:
        row = spark.read.schema(ENTRY).json(entry).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row and row["path"]


def fit_or_load(
    train: DataFrame,
    features: Sequence[str],
    wanted: Mapping[str, Estimator],
    folder: str,
    tables: Mapping[str, Callable[[], DataFrame]] | None = None,
    setting: object = None,
) -> Store:
    """Models (and tables that are learnt too) of these training rows from ``folder``, fitted only where it has none.

    What is looked for is the fingerprint of ``train``, the features in their order, the estimators with all their parameters
    and ``setting``. A change of any of these fits anew and keeps the older entry. Two runs at once both fit; the entry of the later one stays.
    """
    spark, tables = train.sparkSession, dict(tables or {})
    asked = [list(features), {n: [[described(s) for s in e.stages], e.classes] for n, e in wanted.items()}, sorted(tables), repr(setting)]
    key = hashlib.sha256(json.dumps([fingerprint(train), asked]).encode()).hexdigest()
    entry = f"{folder}/entry-{key}"
    path = _known_path(spark, entry)
    reused = path is not None
    if not reused:
        path = f"{folder}/{new_path(spark, 'models').rsplit('/', 1)[1]}"
        for name, e in wanted.items():
            models.fit(models.labelled(train) if e.classes else train, features, e.stages).save(f"{path}/model-{name}")
        for name, make in tables.items():
            make().write.parquet(f"{path}/table-{name}")
        row = (path, json.dumps(asked), json.dumps(sorted(CLASS_LABELS)))
        spark.createDataFrame([row], ENTRY).coalesce(1).write.mode("overwrite").json(entry)
    return Store(
        {name: PipelineModel.load(f"{path}/model-{name}") for name in wanted},
        {name: spark.read.parquet(f"{path}/table-{name}") for name in tables},
        list(features),
        reused,
    )


def train_series(table: DataFrame) -> DataFrame:
    """Training rows as a gap-free series from 0."""
    return table.filter("split = 'train'").withColumns({"pos": F.col("row_index"), "n_steps": train_steps()})


def train_steps():
    return F.floor(F.col("n_rows") * F.lit(DEFAULTS.train_share))


def days_after_training(table: DataFrame) -> DataFrame:
    """The other rows with their ``step`` after the last training row, from 1."""
    return table.withColumn("step", (F.col("row_index") - train_steps() + 1).cast("int")).filter("step >= 1")


def default_estimators() -> dict[str, Estimator]:
    return {
        "boosted_trees": Estimator([models.boosted_regressor(**LIGHT)]),
        "linear": Estimator([models.linear_regressor()]),
        "boosted_classes": Estimator(models.boosted_classifier(**LIGHT), classes=True),
    }


def forecast_run(table: DataFrame, folder: str, estimators: Mapping[str, Estimator] | None = None) -> Run:
    """Baselines, autoregression, regressors and classifiers of a stored model table, compared on its test rows.

    Everything learnt comes from the training rows and is kept in ``folder`` (see ``fit_or_load``); the test rows are
    always scored with the models as loaded from there. Predictions, classes and the comparison are written.
    """
    estimators = estimators or default_estimators()
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    features = feature_columns(table)
    series = train_series(table)
    store = fit_or_load(train, features, estimators, folder, {"arx": lambda: arx.fit(series, "acps", EXOG)}, setting=EXOG)
    rows = models.as_doubles(test, features)

    def regressed(name: str) -> DataFrame:
        return store.models[name].transform(rows).select("entity", "dt", F.lit(name).alias("model"), "acps", F.col("acps_pred").alias("predicted"))

    parts = [regressed(n) for n, e in estimators.items() if not e.classes]
    future = days_after_training(table)
    ahead = arx.forecast(store.tables["arx"], series, future, "acps", EXOG)
    parts.append(
        ahead.join(future.filter("split = 'test'").select("entity", "step", "dt", "acps"), ["entity", "step"]).select(
            "entity", "dt", F.lit("arx").alias("model"), "acps", F.col("forecast").alias("predicted")
        )
    )
    whole = table.withColumns({"pos": F.col("row_index"), "n_steps": F.col("n_rows")}).drop("split")
    offsets = {"previous_day": 1, "same_day_last_week": 7}
    shifted = baselines.offset_baselines(baselines.train_then_test(whole), "acps", offsets)
    parts.append(
        evaluate.showdown(shifted, "acps", {n: n for n in offsets}, ["entity", "dt"]).select("entity", "dt", "model", "acps", "predicted")
    )
    predictions = materialize(reduce(DataFrame.unionByName, parts), "predictions")
    classed = [
        store.models[n].transform(rows).select("entity", "dt", F.lit(n).alias("model"), "congestion_class", "congestion_pred")
        for n, e in estimators.items()
        if e.classes
    ]
    classes = materialize(reduce(DataFrame.unionByName, classed), "classes")

    def long(scores: DataFrame, metrics: Sequence[str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
        return scores.select("model", F.inline(cells))

    results = long(evaluate.regression_metrics(predictions, "acps", "predicted", ["model"]), ERRORS).unionByName(
        long(evaluate.classification_metrics(classes, "congestion_class", "congestion_pred", ["model"]), HITS)
    )
    comparison = materialize(evaluate.compare_models(results, [], (*ERRORS, *HITS)).coalesce(1), "comparison")
    return Run(comparison, predictions, classes, store)
