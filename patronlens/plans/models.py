"""Tree models on prepared tables: split, fit, search, evaluate, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BUCKETS = 10_000
#: Bytes of feature vectors in a partition of the training rows, about.
FIT_BYTES = 64 << 20


def holdout(df: DataFrame, key: str, share: float, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: the same row always falls on the same side."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(_BUCKETS))
    side = bucket < int(share * _BUCKETS)
    return df.where(~side), df.where(side)


def feature_names(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def evenly(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` in partitions of about ``FIT_BYTES`` of feature vectors at most, for a fit that keeps and reads them again and again.

    Columns of few values take far less room in a file than in vectors, so partitions by file size would grow too large.
    """
    wanted = -(-df.count() * 8 * len(features) // FIT_BYTES)
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


def _with_vector(estimator, features: Sequence[str]) -> Pipeline:
    safe = [c for c in features]
    return Pipeline(stages=[VectorAssembler(inputCols=safe, outputCol="features", handleInvalid="keep"), estimator])


def decision_tree(label: str, features: Sequence[str], max_depth: int = 30, seed: int = 17, **params) -> Pipeline:
    return _with_vector(DecisionTreeClassifier(labelCol=label, maxDepth=max_depth, seed=seed, **params), features)


def random_forest(label: str, features: Sequence[str], trees: int = 100, max_depth: int = 10, seed: int = 21, **params) -> Pipeline:
    return _with_vector(RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=max_depth, seed=seed, **params), features)


def boosted_trees(
    label: str, features: Sequence[str], rounds: int = 100, rate: float = 0.1, max_depth: int = 5, seed: int = 32, **params
) -> Pipeline:
    return _with_vector(GBTRegressor(labelCol=label, maxIter=rounds, stepSize=rate, maxDepth=max_depth, seed=seed, **params), features)


def grid_search(
    pipeline: Pipeline, grid: dict[str, Sequence], train: DataFrame, label: str, metric: str, folds: int = 5, parallelism: int = 4
):
    """Cross-validated search over named parameters of the last stage; returns the fitted search."""
    estimator = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    if metric in ("r2", "rmse", "mae"):
        evaluator = RegressionEvaluator(labelCol=label, metricName=metric)
    else:
        evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    search = CrossValidator(
        estimator=pipeline, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds, parallelism=parallelism, seed=17
    )
    return search.fit(train)


def search_table(spark: SparkSession, fitted) -> DataFrame:
    """(rank, params, score), best first; one row per setting."""
    rows = []
    larger = fitted.getEvaluator().isLargerBetter()
    for params, score in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name))
        rows.append((text, float(score)))
    rows.sort(key=lambda r: -r[1] if larger else r[1])
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], "rank int, params string, score double")


def classification_report(predicted: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support, accuracy) from the table of counts."""
    counts = predicted.where(F.col(label).isNotNull()).groupBy(
        F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("called"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("called"), F.lit(0).cast("long").alias("hit")),
    )).alias("s")).select("s.*")
    per_class = sides.groupBy("class").agg(F.sum("actual").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
    whole = per_class.agg(F.try_divide(F.sum("hit"), F.sum("support")).alias("accuracy"))
    precision = F.coalesce(F.try_divide("hit", "called"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    scored = per_class.select("class", "support", precision.alias("precision"), recall.alias("recall"))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return scored.withColumn("f1", f1).crossJoin(F.broadcast(whole))


def roc_auc(predicted: DataFrame, label: str, score: str = "rawPrediction") -> float:
    """Exact area: the curve has a point for every distinct score."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=0).evaluate(predicted)


def rmse(predicted: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return predicted.agg(F.count(error).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"))


def importance(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance), most important first; one row per feature."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(((f, float(w)) for f, w in zip(features, weights)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def score_log_target(model: PipelineModel, rows: DataFrame, key: str, name: str) -> DataFrame:
    """Submission table of a model that was trained on log1p of the target."""
    return model.transform(rows).select(key, F.expm1("prediction").alias(name))
