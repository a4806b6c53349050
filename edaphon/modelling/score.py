"""Scores of predictions, the result table and the data behind the observed-predicted plots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bounds of the RPD bands.
RPD_GOOD, RPD_ACCEPTABLE = 2.0, 1.5


def log_target(samples: DataFrame, targets: list[str] | None = None, y: str = "y") -> DataFrame:
    """Natural logarithm of y for the named targets, or for all. Scores stay in log space, the
    inverse is exp. A value the logarithm does not exist for stops the job."""
    value = F.col(y)
    message = F.lit("log_transform needs positive target values")
    logged = F.when(value <= 0, F.raise_error(message).cast("double")).otherwise(F.ln(value))
    if targets is not None:
        logged = F.when(F.col("target").isin(targets), logged).otherwise(value)
    return samples.withColumn(y, logged)


def log_guard(samples: DataFrame, by: list[str], y: str = "y") -> DataFrame:
    """Rows the logarithm does not exist for, per group."""
    return samples.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(y) <= 0).alias("not_positive"),
        (F.count_if(F.col(y) <= 0) == 0).alias("log_allowed"),
    )


def regression_metrics(predictions: DataFrame, by: list[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """R², RMSE, MAE, RPD and the common axis limits per group, in one aggregation."""
    error = F.col(y) - F.col(yhat)
    sums = predictions.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(error * error).alias("_mse"),
        F.avg(F.abs(error)).alias("test_mae"),
        F.var_pop(y).alias("_var"),
        F.least(F.min(y), F.min(yhat)).alias("axis_min"),
        F.greatest(F.max(y), F.max(yhat)).alias("axis_max"),
    )
    rmse = F.sqrt("_mse")
    return sums.select(
        *by,
        "n",
        (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("test_r2"),
        rmse.alias("test_rmse"),
        "test_mae",
        F.try_divide(F.sqrt("_var"), rmse).alias("test_rpd"),
        "axis_min",
        "axis_max",
    )


def rpd_band(rpd: Column) -> Column:
    return F.when(rpd > RPD_GOOD, "good").when(rpd >= RPD_ACCEPTABLE, "acceptable").when(rpd.isNotNull(), "poor")


def ranked(results: DataFrame) -> DataFrame:
    """Result rows per target, best test R² first, ties by model name."""
    window = Window.partitionBy("target").orderBy(F.desc_nulls_last("test_r2"), "modelo")
    return results.withColumn("position", F.row_number().over(window)).orderBy("target", "position")


def observed_vs_predicted(predictions: DataFrame, kept: list[str]) -> DataFrame:
    """The points of the plot."""
    return predictions.select(*kept, "y", "yhat", (F.col("y") - F.col("yhat")).alias("residual"))


def residual_bins(predictions: DataFrame, by: list[str], width: float) -> DataFrame:
    """Histogram of the residuals in bins of a fixed width."""
    residual = F.col("y") - F.col("yhat")
    lower = F.floor(residual / width) * F.lit(float(width))
    return predictions.groupBy(*by, lower.alias("bin_start")).agg(F.count("*").alias("n"))
