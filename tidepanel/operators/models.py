"""MLlib models on the model table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier, OneVsRest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, IndexToString, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.config import CLASS_LABELS
from tidepanel.operators.blocks import ordinal
from tidepanel.session import materialize

TARGET = "acps"
SEED = 42


def feature_stages(features: Sequence[str], scale: bool = False) -> list:
    """Median imputation and assembly, scaled on request."""
    filled = [f"{c}_in" for c in features]
    stages = [
        Imputer(strategy="median", inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="raw_features" if scale else "features"),
    ]
    if scale:
        stages.append(
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
        )
    return stages


def as_doubles(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def fit(df: DataFrame, features: Sequence[str], stages: list, scale: bool = False) -> PipelineModel:
    return Pipeline(stages=[*feature_stages(features, scale), *stages]).fit(as_doubles(df, features))


def boosted_regressor(rounds: int = 200, depth: int = 6, step: float = 0.1, leaf: int = 20) -> GBTRegressor:
    return GBTRegressor(
        labelCol=TARGET, featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=step,
        minInstancesPerNode=leaf, seed=SEED, predictionCol="acps_pred",
    )


def forest_regressor(trees: int = 200, depth: int = 12) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=TARGET, featuresCol="features", numTrees=trees, maxDepth=depth, seed=SEED,
        predictionCol="acps_pred",
    )


def linear_regressor() -> LinearRegression:
    return LinearRegression(labelCol=TARGET, featuresCol="features", predictionCol="acps_pred")


def labelled(train: DataFrame) -> DataFrame:
    """Training rows with a known class, and its number. Labels are needed to learn only: a fitted
    pipeline has no part that reads them, so it scores every row."""
    names = F.array(*[F.lit(c) for c in sorted(CLASS_LABELS)])
    number = F.array_position(names, F.col("congestion_class"))
    return train.withColumn("label", (F.nullif(number, F.lit(0)) - 1).cast("double")).filter("label IS NOT NULL")


def class_names() -> IndexToString:
    return IndexToString(inputCol="prediction", outputCol="congestion_pred", labels=sorted(CLASS_LABELS))


def boosted_classifier(rounds: int = 200, depth: int = 6, step: float = 0.1, leaf: int = 20) -> list:
    """Three classes from one boosted binary model per class."""
    binary = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=step,
        minInstancesPerNode=leaf, seed=SEED,
    )
    return [OneVsRest(classifier=binary, labelCol="label", featuresCol="features"), class_names()]


def perceptron(n_features: int, hidden: Sequence[int] = (64, 64), rounds: int = 500) -> list:
    net = MultilayerPerceptronClassifier(
        layers=[n_features, *hidden, len(CLASS_LABELS)], labelCol="label", featuresCol="features",
        maxIter=rounds, seed=SEED,
    )
    return [net, class_names()]


def permutation_importance(
    model: PipelineModel, test: DataFrame, features: Sequence[str], time: str, repeats: int = 10,
    buckets: int = 4096,
) -> DataFrame:
    """Mean drop in R2 when one feature is shuffled, per feature.

    Every repeat pairs a row with another one by a bijection of row numbers
    (``a * i + b mod n`` with ``a`` prime and no divisor of ``n``); the pair lends one
    value at a time. Rows meet by an equi-join on the number; no task holds the table.
    """
    vectors = model_inputs(model, test, features).withColumn("_all", F.lit(1))
    # any dense numbering will do: by hash bucket, then by key inside a bucket
    bucket = F.pmod(F.xxhash64("entity", time), F.lit(buckets))
    numbered = materialize(
        ordinal(vectors, ["_all"], ["entity", time], bucket, "_i", "_n").select("_i", "_n", "_x", TARGET), "numbered"
    )
    primes = (1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121, 1000133, 1000151)
    steps = F.array(*[F.lit(primes[r % len(primes)]) for r in range(repeats)])
    shifts = F.array(*[F.lit(7919 * (r + 1)) for r in range(repeats)])
    paired = numbered.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_r")
    ).withColumn(
        "_partner",
        # a step that shares a factor with n (n a multiple of the prime) moves on by one
        F.pmod(
            F.col("_i") * F.when(F.col("_n") % F.get(steps, "_r") == 0, 1).otherwise(F.get(steps, "_r"))
            + F.get(shifts, "_r"),
            F.col("_n"),
        ),
    )
    lender = numbered.select(F.col("_i").alias("_partner"), F.col("_x").alias("_lent"))
    index = F.array(*[F.lit(i) for i in range(-1, len(features))])
    copies = paired.join(lender, "_partner").select("_r", TARGET, "_x", "_lent", F.explode(index).alias("_f"))
    mixed = copies.withColumn(
        "features",
        array_to_vector(
            F.transform(
                F.arrays_zip(F.col("_x").alias("own"), F.col("_lent").alias("lent")),
                lambda v, i: F.when(i == F.col("_f"), v["lent"]).otherwise(v["own"]),
            )
        ),
    ).select("_r", "_f", TARGET, "features")
    predicted = model.stages[-1].transform(mixed)
    error = F.col(TARGET) - F.col("acps_pred")
    scores = predicted.groupBy("_r", "_f").agg(
        # a constant truth has no R2
        (1 - F.try_divide(F.sum(error * error), F.var_pop(TARGET) * F.count(F.lit(1)))).alias("r2")
    )
    # feature -1 is the untouched table
    by_repeat = scores.groupBy("_r").agg(
        F.max(F.when(F.col("_f") == -1, F.col("r2"))).alias("_base"),
        F.collect_list(F.when(F.col("_f") >= 0, F.struct("_f", "r2"))).alias("_drops"),
    )
    names = F.array(*[F.lit(c) for c in features])
    return (
        by_repeat.select("_base", F.inline("_drops"))
        .groupBy(F.get(names, "_f").alias("feature"))
        .agg(F.avg(F.col("_base") - F.col("r2")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def model_inputs(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The assembled inputs of the last stage as an array ``_x``."""
    from pyspark.ml.functions import vector_to_array

    out = as_doubles(df, features)
    for stage in model.stages[:-1]:
        out = stage.transform(out)
    return out.withColumn("_x", vector_to_array("features"))


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def best_kmeans(vectors: DataFrame, k: int, starts: int = 10):
    """Lowest-cost model over several seeds; returns the model and its cost."""
    best = None
    for seed in range(SEED, SEED + starts):
        model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vectors)
        cost = model.summary.trainingCost
        if best is None or cost < best[1]:
            best = (model, cost)
    return best
