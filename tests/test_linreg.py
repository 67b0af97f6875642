import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from kelpfit.operators import linreg

ROWS = [(1.0, 2.0, 1.0), (2.0, 3.0, 5.0), (3.0, 7.0, 1.0), (6.0, 8.0, 2.0)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "x double, y double, w double")


def test_plain_fit_matches_mllib(df):
    model = linreg.fit(df, "x", "y")
    assembled = VectorAssembler(inputCols=["x"], outputCol="v").transform(df)
    other = LinearRegression(featuresCol="v", labelCol="y").fit(assembled)
    assert np.allclose([model.intercept, model.slope], [other.intercept, other.coefficients[0]])


def test_line_through_origin(df):
    x, y, w = np.array(ROWS).T
    assert np.isclose(linreg.fit(df, "x", "y", fit_intercept=False).slope, (x * y).sum() / (x * x).sum())
    weighted = linreg.fit(df, "x", "y", weight="w", fit_intercept=False)
    assert np.isclose(weighted.slope, (w * x * y).sum() / (w * x * x).sum())
    assert weighted.intercept == 0.0


@pytest.mark.parametrize("weighted_means", [False, True])
def test_weighted_fit_centres_on_the_chosen_means(df, weighted_means):
    x, y, w = np.array(ROWS).T
    mx, my = (np.average(x, weights=w), np.average(y, weights=w)) if weighted_means else (x.mean(), y.mean())
    slope = (w * (x - mx) * (y - my)).sum() / (w * (x - mx) ** 2).sum()
    model = linreg.fit(df, "x", "y", weight="w", weighted_means=weighted_means)
    assert np.allclose([model.slope, model.intercept], [slope, my - slope * mx])


def test_residuals_and_metrics(df):
    model = linreg.fit(df, "x", "y")
    rows = model.residuals(df, "y").collect()
    assert np.isclose(sum(r["residual"] for r in rows), 0.0)
    assert np.isclose(model.get_metric(df, "y", "MSE"), np.mean([r["residual"] ** 2 for r in rows]))
    assert np.isclose(model.get_metric(df, "y", "R2"), np.corrcoef(np.array(ROWS)[:, :2].T)[0, 1] ** 2)
    assert sum(r["n"] for r in model.residual_histogram(df, "y").collect()) == 4


def test_missing_rows_do_not_count(spark, df):
    more = df.unionByName(spark.createDataFrame([(None, 1.0, 1.0), (9.0, float("nan"), 1.0)], df.schema))
    assert np.isclose(linreg.fit(more, "x", "y").slope, linreg.fit(df, "x", "y").slope)


def test_bad_input_is_rejected(spark, df):
    with pytest.raises(ValueError):
        linreg.fit(df, "x", "nope")
    with pytest.raises(TypeError):
        linreg.fit(spark.createDataFrame([("a", 1.0)], "x string, y double"), "x", "y")
    with pytest.raises(ValueError):
        linreg.fit(spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "x double, y double"), "x", "y")
    with pytest.raises(ValueError):
        linreg.fit(df, "x", "y").get_metric(df, "y", "MAPE")
