import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpfit.operators import network as nn
from kelpfit.operators.network import Layer, Network

LAYERS = (Layer(2, 3, "relu"), Layer(3, 1, "sigmoid"))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(80, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                               "id int, a double, b double, y double").repartition(4)
    return x, y, df


def forward(parameters, x):
    (w0, b0), (w1, b1) = parameters
    return 1 / (1 + np.exp(-(np.maximum(x @ w0 + b0, 0) @ w1 + b1)))[:, 0]


def mean_loss(parameters, x, y):
    return ((y - forward(parameters, x)) ** 2).mean()


def test_forward_and_evaluate(spark, data):
    x, y, df = data
    net = Network.random(LAYERS, 1)
    got = [r["prediction"] for r in net.transform(df, ["a", "b"]).orderBy("id").collect()]
    assert np.allclose(got, forward(net.parameters, x))
    row = net.evaluate(df, ["a", "b"], "y").first()
    assert np.isclose(row["loss"], mean_loss(net.parameters, x, y))
    assert np.isclose(row["accuracy"], ((forward(net.parameters, x) > 0.5) == y).mean())
    vectors = df.select("id", "y", F.array("a", "b").alias("v"))
    assert np.isclose(net.evaluate(vectors, "v", "y").first()["loss"], row["loss"])


def test_several_outputs_and_own_activation(spark, data):
    x, _, df = data
    net = Network.random((Layer(2, 3, np.cos),), 2)
    got = [r["prediction"] for r in net.transform(df, ["a", "b"]).orderBy("id").collect()]
    w, b = net.parameters[0]
    assert np.allclose(got, np.cos(x @ w + b))


def test_random_search_keeps_the_best_and_logs_every_candidate(spark, data):
    x, y, df = data
    start = Network.random(LAYERS, 3)
    result = nn.search_random(df, ["a", "b"], "y", start, 25, seed=5)
    tried = [nn.random_parameters(LAYERS, 5, e) for e in range(1, 26)]
    losses = [mean_loss(p, x, y) for p in tried]
    assert np.allclose([row[1] for row in result.log], losses)
    best = min([mean_loss(start.parameters, x, y), *losses])
    assert np.isclose(mean_loss(result.network.parameters, x, y), best)
    assert result.log_table(spark).columns == ["epoch", "loss", "accuracy"]


def test_starting_weights_are_kept_when_nothing_beats_them(spark, data):
    x, y, df = data
    good = nn.search_random(df, ["a", "b"], "y", Network.random(LAYERS, 3), 60, seed=6).network
    again = nn.search_random(df, ["a", "b"], "y", good, 1, seed=99).network
    worse = mean_loss(nn.random_parameters(LAYERS, 99, 1), x, y) > mean_loss(good.parameters, x, y)
    assert worse and all((a[0] == b[0]).all() for a, b in zip(again.parameters, good.parameters))


def test_descent_never_gets_worse(spark, data):
    x, y, df = data
    start = Network.random(LAYERS, 3)
    result = nn.search_descent(df, ["a", "b"], "y", start, 6, branch_factor=4, learning_rate=0.2, seed=7)
    losses = [mean_loss(start.parameters, x, y), *[row[1] for row in result.log]]
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]
    assert np.isclose(mean_loss(result.network.parameters, x, y), losses[-1])
    current, held = start.parameters, losses[0]
    for epoch in range(1, 7):
        tried = []
        for branch in range(4):
            noise = nn.random_parameters(LAYERS, 7, epoch, branch)
            tried.append([(w + 0.2 * nw, b + 0.2 * nb) for (w, b), (nw, nb) in zip(current, noise)])
        branch = min(range(4), key=lambda i: mean_loss(tried[i], x, y))
        if mean_loss(tried[branch], x, y) < held:
            current, held = tried[branch], mean_loss(tried[branch], x, y)
        assert np.isclose(result.log[epoch - 1][1], held)


def test_shapes_are_checked():
    with pytest.raises(ValueError):
        Network.random((Layer(2, 3), Layer(4, 1)), 1)
    with pytest.raises(ValueError):
        Network(LAYERS, nn.random_parameters((Layer(2, 2), Layer(2, 1)), 1))
    with pytest.raises(ValueError):
        Layer(2, 0)
    with pytest.raises(ValueError):
        Layer(2, 1, "step")


def test_parameters_are_copied():
    net = Network.random(LAYERS, 1)
    copy = net.with_parameters(net.parameters)
    copy.parameters[0][0][0, 0] += 1
    assert copy.parameters[0][0][0, 0] != net.parameters[0][0][0, 0]


def test_large_searches_take_several_rounds(spark, data, monkeypatch):
    once = nn.search_random(data[2], ["a", "b"], "y", Network.random(LAYERS, 1), 5, seed=3)
    monkeypatch.setattr(nn, "ROUND_VALUES", 10)
    again = nn.search_random(data[2], ["a", "b"], "y", Network.random(LAYERS, 1), 5, seed=3)
    assert np.allclose([r[1] for r in again.log], [r[1] for r in once.log])
    assert all(np.array_equal(a[0], b[0]) for a, b in zip(once.network.parameters, again.network.parameters))


def test_gradient_trained_comparison(spark, data):
    df = data[2].withColumn("y", (F.col("a") > 0).cast("double"))
    model = nn.fit_perceptron(df, ["a", "b"], "y", (3, 4), max_iter=60, seed=1)
    hits = model.transform(df).where(F.col("prediction") == F.col("y")).count()
    assert hits > 70


@pytest.mark.parametrize(("loss", "last", "outputs"), [
    (nn.squared_error, "sigmoid", 1), (nn.cross_entropy, "sigmoid", 1), (nn.class_cross_entropy, "softmax", 3)])
def test_gradients_match_differences(loss, last, outputs):
    layers = (Layer(2, 3, "tanh"), Layer(3, 2, "relu"), Layer(2, outputs, last))
    net = Network.random(layers, 5)
    r = np.random.default_rng(1)
    x, y = r.normal(size=(20, 2)), r.integers(0, max(2, outputs), 20).astype(float)
    got, total = nn._gradients(layers, net.parameters, loss, x, y)

    def summed(parameters):
        return loss(y, nn._forward(layers, parameters, x)).sum()

    want = []
    for i, pair in enumerate(net.parameters):
        for j, values in enumerate(pair):
            for at in np.ndindex(values.shape):
                sides = []
                for step in (1e-6, -1e-6):
                    moved = net.with_parameters(net.parameters).parameters
                    moved[i][j][at] += step
                    sides.append(summed(moved))
                want.append((sides[0] - sides[1]) / 2e-6)
    assert np.allclose(got, want, atol=1e-5) and total == pytest.approx(summed(net.parameters))


def test_plain_steps_lower_the_loss(data):
    log = nn.fit_gradient(data[2], ["a", "b"], "y", Network.random(LAYERS, 1), 6, 0.05).log
    assert log[-1][1] <= log[0][1]


def test_adaptive_mini_batches_learn_classes(spark, data):
    x, _, df = data
    df = df.withColumn("y", F.when(F.col("a") > 0.4, 2.0).when(F.col("a") < -0.4, 0.0).otherwise(1.0))
    start = Network.random((Layer(2, 6, "tanh"), Layer(6, 3, "softmax")), 2,
                           loss_function=nn.class_cross_entropy, metrics=(nn.class_accuracy,))
    settings = dict(epochs=12, steps=nn.AdaptiveSteps(0.1), batches=4, key="id", seed=3)
    result = nn.fit_gradient(df, ["a", "b"], "y", start, **settings)
    assert result.network.evaluate(df, ["a", "b"], "y").first()["class_accuracy"] > 0.85
    assert [e for e, _ in result.log] == list(range(1, 13)) and result.log[-1][1] < result.log[0][1]
    again = nn.fit_gradient(df, ["a", "b"], "y", start, **settings)
    assert np.allclose([v for _, v in again.log], [v for _, v in result.log])


@pytest.mark.parametrize("bad", [
    dict(network=Network.random((Layer(2, 1, "identity"),), 1, loss_function=nn.cross_entropy)),
    dict(network=Network.random((Layer(2, 2, "sigmoid"),), 1)),
    dict(network=Network.random((Layer(2, 1, np.cos),), 1)),
    dict(network=Network.random(LAYERS, 1), batches=3)])
def test_untrainable_settings(data, bad):
    with pytest.raises(ValueError):
        nn.fit_gradient(data[2], ["a", "b"], "y", epochs=1, **bad)
