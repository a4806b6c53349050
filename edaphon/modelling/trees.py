"""Boosted trees on principal components, with MLlib."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edaphon.session import shared_dir

# Smallest leaf of the two families and their number of bins per feature.
MIN_LEAF = {"XGBoost": 1, "LightGBM": 20}
BINS = 256
#: Component scores in a partition of the training rows; a tree is a Spark job or more per level, so
#: a small target should not be many tasks.
PART_VALUES = 4_000_000


def tree_depth(model: str, params: dict[str, float]) -> int:
    """MLlib grows level by level; a leaf budget becomes the depth that can hold it."""
    depth = int(params["max_depth"])
    if model == "LightGBM":
        depth = min(depth, math.ceil(math.log2(max(params["num_leaves"], 2))))
    return depth


def regressor(model: str, params: dict[str, float], n: int, seed: int = 42) -> GBTRegressor:
    """The estimator for one draw of the search space.

    MLlib has no penalties on leaf values. The L1 penalty bounds the gain a split must bring
    instead, the L2 penalty the rows a leaf must have.
    """
    return GBTRegressor(
        featuresCol="vector",
        labelCol="y",
        predictionCol="yhat",
        maxIter=int(params["n_estimators"]),
        stepSize=float(params["learning_rate"]),
        maxDepth=tree_depth(model, params),
        subsamplingRate=float(params["subsample"]),
        featureSubsetStrategy=str(min(float(params["colsample_bytree"]), 1.0)),
        maxBins=BINS,
        minInfoGain=float(params["reg_alpha"]) / n,
        minInstancesPerNode=MIN_LEAF[model] + int(params["reg_lambda"]),
        checkpointInterval=10,
        seed=seed,
    )


def with_vector(rows: DataFrame, count: int) -> DataFrame:
    """The first ``count`` components as a vector."""
    return rows.withColumn("vector", array_to_vector(F.slice("features", 1, count)))


def held_rows(rows: DataFrame, n: int, width: int) -> DataFrame:
    """``rows`` for many fits: dealt by sample to partitions of an even size, in a fixed order, so that fits on
    the same samples agree, and kept in memory or on disk. A lost part is read from the table again."""
    parts = max(1, -(-n * max(width, 1) // PART_VALUES))
    return rows.repartition(parts, "ssn").sortWithinPartitions("ssn").persist(StorageLevel.MEMORY_AND_DISK)


def fit_boosting(rows: DataFrame, n: int, model: str, params: dict[str, float], seed: int = 42) -> GBTRegressionModel:
    """``rows`` is ``(y, features)`` of the ``n`` training samples."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(rows.sparkSession))
    chosen = with_vector(rows, int(params["pca_n_components"])).select("y", "vector")
    return regressor(model, params, n, seed).fit(chosen)


def predict_boosting(fitted: GBTRegressionModel, rows: DataFrame, params: dict[str, float]) -> DataFrame:
    return fitted.transform(with_vector(rows, int(params["pca_n_components"]))).drop("vector")


def staged_r2(fitted: GBTRegressionModel, rows: DataFrame, params: dict[str, float], lengths: list[int]) -> list[float | None]:
    """R² on ``rows`` with the first 1, 2, ... trees, at the given numbers of trees, from two scans. None where
    the values do not vary."""
    vectors = with_vector(rows, int(params["pca_n_components"])).select("y", "vector")
    spread = vectors.agg(F.var_pop("y")).first()[0]
    if not spread:
        return [None] * len(lengths)
    errors = fitted.evaluateEachIteration(vectors, "squared")
    return [1 - errors[min(n, len(errors)) - 1] / spread for n in lengths]
