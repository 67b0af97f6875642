"""Least squares with one feature, by mergeable aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.checks import require_numeric, usable_rows
from kelpfit.operators import metrics


@dataclass(frozen=True)
class LineModel:
    """``y = intercept + slope * x``; applies to batch and streaming tables."""

    x: str
    intercept: float
    slope: float

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        require_numeric(df, [self.x])
        x = F.col(self.x).cast("double")
        return df.withColumn(name, F.lit(self.intercept) + F.lit(self.slope) * x)

    predict = transform

    def residuals(self, df: DataFrame, y: str) -> DataFrame:
        """Table of x, y, prediction and residual ``y - prediction``.

        On training rows its ``x``/``prediction`` pair is the fitted line; on test
        rows it pairs each actual value with its prediction and error.
        """
        require_numeric(df, [self.x, y])
        scored = self.transform(usable_rows(df, [self.x, y]), "_p")
        return scored.select(
            F.col(self.x).cast("double").alias("x"),
            F.col(y).cast("double").alias("y"),
            F.col("_p").alias("prediction"),
            (F.col(y) - F.col("_p")).alias("residual"),
        )

    def residual_histogram(self, df: DataFrame, y: str, bins: int = 15) -> DataFrame:
        return metrics.histogram(self.residuals(df, y), "residual", bins)

    def get_metric(self, df: DataFrame, y: str, metric: str) -> float:
        scored = self.residuals(df, y)
        return metrics.fit_metric(scored, "y", "prediction", metric).first()[0]


def coefficients(
    df: DataFrame,
    x: str,
    y: str,
    weight: str | None = None,
    fit_intercept: bool = True,
    weighted_means: bool = False,
) -> DataFrame:
    """One-row table ``(intercept, slope)``.

    A weighted fit with intercept centres on the unweighted means unless
    ``weighted_means`` asks for textbook weighted least squares. It takes a
    second pass, since centring first keeps the sums accurate.
    """
    used = [x, y] + ([weight] if weight else [])
    require_numeric(df, used)
    rows = usable_rows(df.select(*dict.fromkeys(used)), list(dict.fromkeys(used)))
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")

    if weight is None and fit_intercept:
        return rows.agg(
            F.regr_intercept(ys, xs).alias("intercept"), F.regr_slope(ys, xs).alias("slope"))
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    if not fit_intercept:
        return rows.agg(
            F.lit(0.0).alias("intercept"),
            F.try_divide(F.sum(w * xs * ys), F.sum(w * xs * xs)).alias("slope"))
    means = rows.agg(
        *(
            [F.sum(w * xs) / F.sum(w), F.sum(w * ys) / F.sum(w)]
            if weighted_means
            else [F.avg(xs), F.avg(ys)]
        )
    ).first()
    mx, my = F.lit(means[0]), F.lit(means[1])
    slope = F.try_divide(F.sum(w * (xs - mx) * (ys - my)), F.sum(w * (xs - mx) * (xs - mx)))
    return rows.agg(slope.alias("slope")).select((my - F.col("slope") * mx).alias("intercept"), "slope")


def coefficients_by(df: DataFrame, groups: list[str], x: str, y: str) -> DataFrame:
    """A line with intercept per group: the groups, ``n``, ``intercept`` and ``slope``."""
    require_numeric(df, [x, y])
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    return usable_rows(df.select(*groups, x, y), [x, y]).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.regr_intercept(ys, xs).alias("intercept"),
        F.regr_slope(ys, xs).alias("slope"))


def fit(
    df: DataFrame,
    x: str,
    y: str,
    weight: str | None = None,
    fit_intercept: bool = True,
    weighted_means: bool = False,
) -> LineModel:
    row = coefficients(df, x, y, weight, fit_intercept, weighted_means).first()
    if row["slope"] is None:
        raise ValueError("the feature has no spread, so no line fits it")
    return LineModel(x, row["intercept"], row["slope"])
