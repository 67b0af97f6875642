"""Error measures, confusion tables and histograms, one aggregate each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpfit.checks import require_choice, require_positive_int
from kelpfit.functions import loss

ERRORS = ("mse", "mae", "rmse")
# Accepted names of the measures of a fit.
FIT_METRICS = {
    "MSE": "mse", "mean_squared_error": "mse", "R2": "r2", "R_squared": "r2",
}


def mse(y: Column, p: Column) -> Column:
    return F.avg(loss.squared_error(y, p))


def mae(y: Column, p: Column) -> Column:
    return F.avg(loss.absolute_error(y, p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def r_squared(y: Column, p: Column) -> Column:
    spread = F.var_pop(y) * F.count(y)
    return F.lit(1.0) - F.try_divide(F.sum(loss.squared_error(y, p)), spread)


def accuracy(y: Column, p: Column) -> Column:
    return F.avg((p == y).cast("double"))


def error(df: DataFrame, y: str, p: str, error_type: str = "mse") -> DataFrame:
    """One-row table with the chosen error of predictions ``p`` against ``y``."""
    require_choice("error_type", error_type, ERRORS)
    aggregate = {"mse": mse, "mae": mae, "rmse": rmse}[error_type]
    return df.agg(aggregate(F.col(y), F.col(p)).alias(error_type))


def fit_metric(df: DataFrame, y: str, p: str, metric: str) -> DataFrame:
    """MSE or R squared by any of their accepted names."""
    require_choice("metric", metric, FIT_METRICS)
    kind = FIT_METRICS[metric]
    aggregate = {"mse": mse, "r2": r_squared}[kind]
    return df.agg(aggregate(F.col(y), F.col(p)).alias(kind))


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    """Row counts for every pair of true and predicted label."""
    return df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str, bins: int = 15) -> DataFrame:
    """Equal-width bins between the observed extremes, one row each; empty ones count 0."""
    require_positive_int("bins", bins)
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        raise ValueError("no rows to draw a histogram from")
    x = F.col(column).cast("double")
    width = (float(high) - float(low)) / bins
    number = F.lit(1) if width == 0 else F.least(
        F.floor((x - F.lit(float(low))) / F.lit(width)) + 1, F.lit(bins))
    counted = df.where(x.isNotNull()).groupBy(number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    # both sides have one row per bin at most
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin", (F.lit(float(low)) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))
