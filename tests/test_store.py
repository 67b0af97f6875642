import datetime

import pytest
from pyspark.sql import functions as F

from kelpfit.operators import linreg
from kelpfit.operators.kmeans import KMeans
from kelpfit.operators.knn import KNNClassifier, KNNRegressor
from kelpfit.operators.neuron import Neuron
from kelpfit.operators.store import load_model, store_model, versions
from kelpfit.operators.tree import DecisionTree, RegressionTree


@pytest.fixture(scope="module")
def rows(spark):
    day = datetime.date(2024, 1, 1)
    return spark.createDataFrame(
        [(i, float(i % 17), float(i % 5), "ab"[i % 2], day + datetime.timedelta(i % 3), float(i % 17 + i % 5)) for i in range(120)],
        "id int, x double, z double, c string, d date, y double").cache()


def test_every_model_answers_as_before(spark, rows, tmp_path):
    answers = lambda df: sorted(map(str, df.collect()))
    models = {
        "line": linreg.fit(rows, "x", "y"), "kmeans": KMeans(k=3, max_iter=4, random_state=2).fit(rows, ["x", "z"], "id", "min_max"),
        "classes": DecisionTree(max_depth=2).fit(rows, ["x", "c"], "d"), "values": RegressionTree(max_depth=2).fit(rows, ["x", "z"], "y"),
        "neuron": Neuron(batches=0, epochs=2, random_state=1).fit(rows.withColumn("y", (F.col("y") > 9).cast("int")), ["x"], "y"),
        "vote": KNNClassifier(3).fit(rows, ["x", "z"], "c", "id", "standardization"),
        "mean": KNNRegressor(3, "manhattan", weighting=True).fit(rows, ["x", "z"], "y", "id")}
    for name, model in models.items():
        folder = str(tmp_path / name)
        assert store_model(spark, model, folder) == 1
        again = load_model(spark, folder)
        assert type(again) is type(model)
        assert answers(again.predict(rows)) == answers(model.predict(rows))
    again = load_model(spark, str(tmp_path / "classes"))
    assert answers(again.node_table(spark)) == answers(models["classes"].node_table(spark))


def test_versions_are_kept_and_drafts_are_not_seen(spark, rows, tmp_path):
    folder = str(tmp_path / "m")
    assert versions(spark, folder) == []
    with pytest.raises(ValueError):
        load_model(spark, folder)
    first, second = linreg.fit(rows, "x", "y"), linreg.fit(rows, "z", "y")
    assert [store_model(spark, m, folder) for m in (first, second)] == [1, 2]
    (tmp_path / "m" / "_draft-left-over").mkdir()
    assert versions(spark, folder) == [1, 2]
    assert load_model(spark, folder) == second and load_model(spark, folder, 1) == first
    with pytest.raises(ValueError):
        load_model(spark, folder, 3)
    with pytest.raises(TypeError):
        store_model(spark, {"a": object()}, folder)
