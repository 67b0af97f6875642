"""Min-max, standard, mean and robust scaling of feature columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpfit.checks import is_array, require_choice, require_numeric
from kelpfit.operators.quantiles import exact_quantiles

METHODS = ("min_max", "standardization", "mean_normalization")
SCOPES = ("matrix", "column")


@dataclass(frozen=True)
class ColumnStats:
    n: int
    mean: float
    m2: float
    low: float
    high: float


def pool(stats: list[ColumnStats]) -> ColumnStats:
    """Statistics of all columns read as one long vector, by merging moments."""
    n = sum(s.n for s in stats)
    mean = sum(s.n * s.mean for s in stats) / n
    m2 = sum(s.m2 + s.n * (s.mean - mean) ** 2 for s in stats)
    return ColumnStats(n, mean, m2, min(s.low for s in stats), max(s.high for s in stats))


@dataclass(frozen=True)
class Scaler:
    """Fit-time shift and divisor per feature; constant data scales to 0.0."""

    columns: tuple[str, ...]
    array: bool
    shift: tuple[float, ...]
    divisor: tuple[float, ...]

    def scaled(self, x: Column, i: int) -> Column:
        if self.divisor[i] == 0.0:
            return F.lit(0.0)
        return (x.cast("double") - F.lit(self.shift[i])) / F.lit(self.divisor[i])

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace the feature columns by scaled doubles, here or on new rows."""
        if not self.array:
            return df.withColumns(
                {c: self.scaled(F.col(c), i) for i, c in enumerate(self.columns)}
            )
        name = self.columns[0]
        x = F.col(name).cast("array<double>")
        if len(set(zip(self.shift, self.divisor))) == 1:
            return df.withColumn(name, F.transform(x, lambda v: self.scaled(v, 0)))
        shift = F.array(*[F.lit(s) for s in self.shift])
        divisor = F.array(*[F.lit(d) for d in self.divisor])
        centred = F.zip_with(x, shift, lambda v, s: v - s)
        return df.withColumn(
            name,
            F.zip_with(centred, divisor, lambda v, d: F.when(d == 0.0, 0.0).otherwise(
                F.try_divide(v, d))),
        )


def column_stats(df: DataFrame, columns: list[str]) -> list[ColumnStats]:
    """Moments of every feature in one aggregate job."""
    require_numeric(df, columns)
    if len(columns) == 1 and is_array(df, columns[0]):
        vector = array_to_vector(F.col(columns[0]).cast("array<double>"))
        s = (
            df.select(
                Summarizer.metrics("count", "mean", "variance", "min", "max")
                .summary(vector).alias("s")
            ).select("s.*").first()
        )
        n = s["count"]
        return [
            ColumnStats(n, float(m), float(v) * (n - 1), float(lo), float(hi))
            for m, v, lo, hi in zip(s["mean"], s["variance"], s["min"], s["max"])
        ]
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"),
            F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
        ]
    r = df.agg(*aggs).first()
    if any(r[f"n{i}"] == 0 for i in range(len(columns))):
        raise ValueError("no rows to take scaling statistics from")
    return [
        ColumnStats(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"] * r[f"n{i}"], r[f"l{i}"], r[f"h{i}"])
        for i in range(len(columns))
    ]


def fit_scaler(df: DataFrame, columns: str | list[str], method: str,
               scope: str = "matrix") -> Scaler:
    """Take scaling statistics over the whole matrix, or column by column."""
    require_choice("scaling_method", method, METHODS)
    require_choice("scope", scope, SCOPES)
    columns = [columns] if isinstance(columns, str) else list(columns)
    per_column = column_stats(df, columns)
    array = len(columns) == 1 and is_array(df, columns[0])
    used = [pool(per_column)] * len(per_column) if scope == "matrix" else per_column
    shift, divisor = [], []
    for s in used:
        shift.append(s.low if method == "min_max" else s.mean)
        divisor.append((s.m2 / s.n) ** 0.5 if method == "standardization" else s.high - s.low)
    return Scaler(tuple(columns), array, tuple(shift), tuple(divisor))


def fit_robust_scaler(df: DataFrame, columns: list[str], accuracy: int | None = None) -> Scaler:
    """Median and interquartile range per column, linearly interpolated.

    Exact by default; ``accuracy`` switches to Spark's one-pass quantile sketch.
    """
    require_numeric(df, columns)
    quartiles = [0.25, 0.5, 0.75]
    if accuracy is None:
        found = exact_quantiles(df, columns, quartiles)
        q = [found[c] for c in columns]
    else:
        q = df.agg(*[F.percentile_approx(F.col(c).cast("double"), quartiles, accuracy)
                     for c in columns]).first()
    # a zero interquartile range leaves the column centred but unscaled
    return Scaler(tuple(columns), False, tuple(m for _, m, _ in q),
                  tuple((hi - lo) or 1.0 for lo, _, hi in q))


def principal_components(df: DataFrame, columns: list[str], k: int = 2, name: str = "components"):
    """Centre the columns and project them on ``k`` principal components.

    Returns the projected table and the fitted model. Component signs are arbitrary.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

    require_numeric(df, columns)
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False),
        PCA(k=k, inputCol="_centred", outputCol=name),
    ])
    model = pipeline.fit(df)
    return model.transform(df).drop("_raw", "_centred"), model.stages[-1]
