import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpfit.functions import activation
from kelpfit.operators.neuron import Neuron, choose_functions, grid_search, initial_weights, problem_type
from kelpfit.operators.split import with_batches


def table(spark, x, y):
    return spark.createDataFrame(
        [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
        "id int, " + ", ".join(f"x{j} double" for j in range(x.shape[1])) + ", y double")


def sigmoid(z):
    return 1 / (1 + np.exp(-z))


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(12)
    x = rng.normal(size=(60, 2))
    return x, (x @ [1.0, -2.0] > 0).astype(float), np.tanh(x @ [0.3, 0.2] + 0.1)


def descend(x, y, w, b, steps, rate, act, loss, error):
    history = []
    for _ in range(steps):
        p = act(x @ w + b)
        history.append(loss(y, p))
        e = error(y, p)
        w, b = w - rate * x.T @ e, b - rate * e.sum()
    return w, b, history


CASES = [
    (1, {}, sigmoid, lambda y, p: -(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)).mean(),
     lambda y, p: p - y),
    (2, {}, np.tanh, lambda y, p: ((y - p) ** 2).mean(), lambda y, p: p - y),
    (2, dict(gradient="exact"), np.tanh, lambda y, p: ((y - p) ** 2).mean(), lambda y, p: (p - y) * (1 - p * p)),
    (2, dict(gradient="exact", loss_function="mae"), np.tanh, lambda y, p: abs(y - p).mean(),
     lambda y, p: np.sign(p - y) * (1 - p * p)),
]


@pytest.mark.parametrize("target, options, act, loss, error", CASES)
def test_full_batch_training(spark, data, target, options, act, loss, error):
    x, y = data[0], data[target]
    settings = Neuron(epochs=4, learning_rate=0.01, batches=0, random_state=1, **options)
    model = settings.fit(table(spark, x, y).repartition(3), ["x0", "x1"], "y")
    w, b, history = descend(x, y, np.array(initial_weights(2, seed=1)), 1.0, 4, 0.01, act, loss, error)
    assert np.allclose(model.weights, w) and np.isclose(model.bias, b)
    assert np.allclose([v for _, v in model.history], history)
    assert [r["epoch"] for r in model.loss_history(spark).collect()] == [1, 2, 3, 4]


@pytest.mark.parametrize("n", [7, 25])
def test_mini_batches_train_in_turn(spark, data, n):
    x, y = data[0][:n], data[1][:n]
    df = table(spark, x, y)
    model = Neuron(epochs=2, learning_rate=0.05, random_state=3).fit(df, ["x0", "x1"], "y", key="id")
    w, b = np.array(initial_weights(2, seed=3)), 1.0
    for epoch in (1, 2):
        batches = {}
        for r in with_batches(df, "id", 3, epoch).collect():
            batches.setdefault(r["batch"], []).append(r["id"])
        losses = []
        for _, rows in sorted(batches.items()):
            p = sigmoid(x[rows] @ w + b)
            losses.append(-(y[rows] * np.log(p + 1e-7) + (1 - y[rows]) * np.log(1 - p + 1e-7)).mean())
            e = p - y[rows]
            w, b = w - 0.05 * x[rows].T @ e, b - 0.05 * e.sum()
        assert np.isclose(model.history[epoch - 1][1], np.mean(losses))
    assert np.allclose(model.weights, w)


def test_learning_separates_the_classes(spark, data):
    df = table(spark, data[0], data[1]).select("y", F.array("x0", "x1").alias("v"))
    model = Neuron(epochs=15, learning_rate=0.5, batches=0, random_state=2).fit(df, "v", "y")
    assert model.accuracy(df).first()[0] > 0.9
    assert model.score(df).first()[0] < model.history[0][1]


def test_problem_types_and_defaults(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 2)], "two int, three int")
    assert problem_type(df, "two") == "classification"
    assert problem_type(df, "three") == "regression"
    assert choose_functions("classification", None, None) == ("sigmoid", "binary_cross_entropy")
    assert choose_functions("regression", None, None) == ("tanh", "mse")
    for bad in (("classification", "tanh", None), ("regression", None, "binary_cross_entropy"),
                ("regression", "sigmoid", None)):
        with pytest.raises(ValueError):
            choose_functions(*bad)


def test_accuracy_is_for_classes_only(spark, data):
    model = Neuron(random_state=1).start(table(spark, data[0], data[2]), ["x0", "x1"], "y")
    with pytest.raises(ValueError):
        model.accuracy(table(spark, data[0], data[2]))


def test_prediction_scores_its_argument(spark, data):
    model = Neuron(random_state=1).start(table(spark, data[0], data[1]), ["x0", "x1"], "y", [0.5, -0.5])
    new = spark.createDataFrame([(1.0, 2.0)], "x0 double, x1 double")
    assert np.isclose(model.predict(new).first()["prediction"], sigmoid(0.5 - 1.0 + 1.0))
    with pytest.raises(ValueError):
        model.predict(new.drop("x1"))


def test_extreme_inputs_do_not_overflow(spark):
    df = spark.createDataFrame([(1e6,), (-1e6,)], "z double")
    row = [tuple(r) for r in df.select(activation.sigmoid(F.col("z")), activation.tanh(F.col("z"))).collect()]
    assert row[0] == (1.0, 1.0) and row[1][0] < 1e-200 and row[1][1] == -1.0


def test_decision_curve(spark):
    df = spark.createDataFrame([(-1.0, 0.0), (3.0, 1.0)], "x double, y double")
    rows = Neuron(random_state=1).start(df, ["x"], "y", [2.0]).decision_curve(df, 5).orderBy("point").collect()
    assert [r["x"] for r in rows] == [-1.0, 0.0, 1.0, 2.0, 3.0]
    assert np.allclose([r["prediction"] for r in rows], [sigmoid(2 * v + 1) for v in range(-1, 4)])


def test_grid_gives_one_row_per_setting(spark, data):
    df = table(spark, data[0], data[1])
    rows = grid_search(df, ["x0", "x1"], "y", [1, 3], [0.01, 0.1], Neuron(batches=0, random_state=4)).collect()
    assert {(r["epochs"], r["learning_rate"]) for r in rows} == {(1, 0.01), (3, 0.01), (1, 0.1), (3, 0.1)}


@pytest.mark.parametrize("bad", [dict(epochs=0), dict(learning_rate=0), dict(gradient="none"),
                                 dict(initial="ones"), dict(batches=-1)])
def test_bad_settings(bad):
    with pytest.raises(ValueError):
        Neuron(**bad)


def test_mini_batches_need_a_key(spark, data):
    with pytest.raises(ValueError):
        Neuron().fit(table(spark, data[0], data[1]), ["x0", "x1"], "y")


def test_an_epoch_reads_its_table_once_and_each_batch_its_own_folder(spark, data):
    from kelpfit.operators.split import epoch_batches, epoch_cutoffs, batch_cutoffs

    df = table(spark, data[0], data[1])
    assert epoch_cutoffs(df, "id", 5, [3, 4], 7) == {e: batch_cutoffs(df, "id", 5, e, 7) for e in (3, 4)}
    for epoch, batches in epoch_batches(df, "id", 5, 3, 7):
        seen, want = [], {}
        for r in with_batches(df, "id", 5, epoch, 7).collect():
            want.setdefault(r["batch"], set()).add(r["id"])
        for i, batch in enumerate(batches):
            plan = batch._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(_batch" in plan
            seen.append({r["id"] for r in batch.collect()})
            assert seen[-1] == want[i]
        assert len(seen) == len(want)
