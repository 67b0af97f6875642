"""Dense networks: forward pass, evaluation and parallel weight search.

Candidate networks are independent, so one pass over the rows scores all of
them: every task adds up each candidate's losses over its own Arrow batches and
returns one row per candidate.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpfit.checks import (
    is_array, require_choice, require_columns, require_numeric, require_positive_int, usable_rows,
)
from kelpfit.functions.hashing import key_text, normal_draw
from kelpfit.operators.aggregates import more_than_two_values
from kelpfit.operators.split import epoch_batches
from kelpfit.session import held

# weights that a task holds at once; more candidates take more passes
ROUND_VALUES = 4_000_000

ArrayFunction = Callable[[np.ndarray], np.ndarray]
PairFunction = Callable[[np.ndarray, np.ndarray], np.ndarray]
Parameters = list[tuple[np.ndarray, np.ndarray]]


def _relu(x):
    return np.maximum(x, 0.0)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _softmax(x):
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


ACTIVATIONS: dict[str, ArrayFunction] = {
    "relu": _relu, "sigmoid": _sigmoid, "tanh": np.tanh, "identity": lambda x: x, "softmax": _softmax,
}


def squared_error(y, p):
    return (y - p) ** 2


def cross_entropy(y, p, epsilon=0.0):
    return -(y * np.log(p + epsilon) + (1 - y) * np.log(1 - p + epsilon))


def class_cross_entropy(y, p):
    """For one output per class; ``y`` holds class numbers from 0."""
    return -np.log(np.take_along_axis(p, y.astype(int)[:, None], axis=1)[:, 0])


def class_accuracy(y, p):
    return (y == p.argmax(axis=1)).astype(float)


def accuracy(y, p):
    return (y == (p > 0.5)).astype(float)


@dataclass(frozen=True)
class Layer:
    """One dense layer: its sizes and activation, named or any array function."""

    input_size: int
    output_size: int
    activation_function: str | ArrayFunction = "relu"

    def __post_init__(self):
        require_positive_int("input_size", self.input_size)
        require_positive_int("output_size", self.output_size)
        if isinstance(self.activation_function, str):
            require_choice("activation_function", self.activation_function, ACTIVATIONS)

    def apply(self, x: np.ndarray) -> np.ndarray:
        f = self.activation_function
        return (ACTIVATIONS[f] if isinstance(f, str) else f)(x)


def random_parameters(layers: Sequence[Layer], *seed: object, weight_scale: float = 1.0,
                      bias_scale: float = 1.0) -> Parameters:
    """Normal weights and biases drawn from the seed."""
    out = []
    for i, layer in enumerate(layers):
        w = [[weight_scale * normal_draw(*seed, i, "w", r, c) for c in range(layer.output_size)]
             for r in range(layer.input_size)]
        b = [bias_scale * normal_draw(*seed, i, "b", c) for c in range(layer.output_size)]
        out.append((np.array(w), np.array(b)))
    return out


def _forward(layers: Sequence[Layer], parameters: Parameters, x: np.ndarray) -> np.ndarray:
    for layer, (w, b) in zip(layers, parameters):
        x = layer.apply(x @ w + b)
    return x[:, 0] if x.shape[1] == 1 else x


@dataclass(frozen=True)
class Network:
    """A feed-forward network with its parameters, loss and metrics."""

    layers: tuple[Layer, ...]
    parameters: Parameters
    loss_function: PairFunction = squared_error
    metrics: tuple[PairFunction, ...] = (accuracy,)

    def __post_init__(self):
        for a, b in zip(self.layers, self.layers[1:]):
            if a.output_size != b.input_size:
                raise ValueError("each layer's input size must equal the size before it")
        shapes = [(l.input_size, l.output_size) for l in self.layers]
        if [w.shape for w, _ in self.parameters] != shapes:
            raise ValueError("parameters do not fit the layers")

    @classmethod
    def random(cls, layers: Sequence[Layer], seed: object = 0, weight_scale: float = 1.0,
               bias_scale: float = 1.0, **functions) -> "Network":
        parameters = random_parameters(
            layers, seed, "start", weight_scale=weight_scale, bias_scale=bias_scale)
        return cls(tuple(layers), parameters, **functions)

    def with_parameters(self, parameters: Parameters) -> "Network":
        return Network(self.layers, [(w.copy(), b.copy()) for w, b in parameters],
                       self.loss_function, self.metrics)

    def transform(self, df: DataFrame, features: str | Sequence[str],
                  name: str = "prediction") -> DataFrame:
        """Network output of every row, as one double or an array of them."""
        layers, parameters = self.layers, self.parameters
        several = layers[-1].output_size > 1

        @F.pandas_udf("array<double>" if several else "double")
        def forward(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                if len(x) == 0:
                    yield pd.Series([], dtype=object if several else float)
                    continue
                out = _forward(layers, parameters, np.stack(x.to_numpy()))
                yield pd.Series(list(out) if several else out)

        return df.withColumn(name, forward(_input(df, features)))

    def evaluate(self, df: DataFrame, features: str | Sequence[str], label: str) -> DataFrame:
        """One-row table with the mean loss and the mean of every metric."""
        return score_candidates(df, features, label, self, [self.parameters]).drop("candidate")


@dataclass(frozen=True)
class SearchResult:
    network: Network
    log: list
    metric_names: tuple[str, ...]

    def log_table(self, spark: SparkSession) -> DataFrame:
        """Loss and metrics per epoch."""
        columns = "".join(f", {m} double" for m in self.metric_names)
        return spark.createDataFrame(self.log, f"epoch int, loss double{columns}")


def _metric_names(network: Network) -> tuple[str, ...]:
    return tuple(m.__name__ for m in network.metrics)


def _input(df: DataFrame, features: str | Sequence[str]) -> Column:
    features = [features] if isinstance(features, str) else list(features)
    require_numeric(df, features)
    if len(features) == 1 and is_array(df, features[0]):
        return F.col(features[0]).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in features])


def _examples(df: DataFrame, features: str | Sequence[str], label: str, keys: Sequence[str] = ()) -> DataFrame:
    require_numeric(df, [label])
    names = [features] if isinstance(features, str) else list(features)
    return usable_rows(df, [*names, label]).select(
        _input(df, features).alias("x"), F.col(label).cast("double").alias("y"),
        *[key_text(list(keys)).alias("_key")] * bool(keys))


@dataclass(frozen=True)
class Drawn:
    """Parameters told by their seed, so that tasks draw them and nothing large is sent.

    With a ``step`` the draw is a move away from the network's own parameters.
    """

    seed: tuple
    weight_scale: float = 1.0
    bias_scale: float = 1.0
    step: float | None = None

    def parameters(self, layers: Sequence[Layer], base: Parameters) -> Parameters:
        drawn = random_parameters(layers, *self.seed, weight_scale=self.weight_scale, bias_scale=self.bias_scale)
        if self.step is None:
            return drawn
        return [(w + self.step * nw, b + self.step * nb) for (w, b), (nw, nb) in zip(base, drawn)]


def score_candidates(df: DataFrame, features: str | Sequence[str], label: str, network: Network,
                     candidates: Sequence[Parameters | Drawn]) -> DataFrame:
    """Mean loss and metrics of every candidate's parameters: candidate, loss, one column per metric."""
    return _score(_examples(df, features, label), network, candidates)


def _score(examples: DataFrame, network: Network, candidates: Sequence[Parameters | Drawn]) -> DataFrame:
    """One pass over the rows for as many candidates as a task may hold."""
    per_round = max(1, ROUND_VALUES // sum(w.size + b.size for w, b in network.parameters))
    rounds = [_score_round(examples, network, candidates[i:i + per_round], i)
              for i in range(0, len(candidates), per_round)]
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out


def _score_round(examples: DataFrame, network: Network, candidates: Sequence[Parameters | Drawn],
                 first: int) -> DataFrame:
    layers, functions = network.layers, (network.loss_function, *network.metrics)
    names = ["loss", *_metric_names(network)]
    # the network's own parameters, and seeds or parameters of the round's candidates
    sent = examples.sparkSession.sparkContext.broadcast((network.parameters, list(candidates)))

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, wanted = sent.value
        tried = [c.parameters(layers, base) if isinstance(c, Drawn) else c for c in wanted]
        sums = np.zeros((len(tried), len(functions)))
        n = 0
        for batch in batches:
            if len(batch) == 0:
                continue
            x, y = np.stack(batch["x"].to_numpy()), batch["y"].to_numpy()
            n += len(y)
            for c, parameters in enumerate(tried):
                p = _forward(layers, parameters, x)
                for m, f in enumerate(functions):
                    sums[c, m] += f(y, p).sum()
        if n:
            yield pd.DataFrame({"candidate": np.arange(first, first + len(sums)), "n": n,
                                **{f"s{m}": sums[:, m] for m in range(len(functions))}})

    columns = "".join(f", s{m} double" for m in range(len(functions)))
    partial = examples.mapInPandas(add_up, f"candidate int, n long{columns}")
    return partial.groupBy("candidate").agg(
        *[(F.sum(f"s{m}") / F.sum("n")).alias(name) for m, name in enumerate(names)])


def search_random(df: DataFrame, features: str | Sequence[str], label: str, network: Network,
                  epochs: int, seed: object = 0, weight_scale: float = 1.0,
                  bias_scale: float = 1.0) -> SearchResult:
    """Fresh random weights per epoch; the lowest loss wins, the start included.

    Epochs are scored side by side; the log holds every candidate's own values.
    """
    require_positive_int("epochs", epochs)
    candidates = [network.parameters, *[Drawn((seed, e), weight_scale, bias_scale) for e in range(1, epochs + 1)]]
    scored = score_candidates(df, features, label, network, candidates).collect()
    rows = sorted(scored, key=lambda r: r["candidate"])
    best = min(rows, key=lambda r: (r["loss"], r["candidate"]))
    winner = candidates[best["candidate"]]
    if isinstance(winner, Drawn):
        winner = winner.parameters(network.layers, network.parameters)
    return SearchResult(network.with_parameters(winner), [tuple(r) for r in rows[1:]], _metric_names(network))


def search_descent(df: DataFrame, features: str | Sequence[str], label: str, network: Network,
                   epochs: int, branch_factor: int = 10, learning_rate: float = 0.01,
                   seed: object = 0) -> SearchResult:
    """Random descent: per epoch try perturbed weights, keep the best if it improves.

    One job per epoch scores all branches; the log repeats the kept network's values.
    """
    require_positive_int("epochs", epochs)
    require_positive_int("branch_factor", branch_factor)
    current, best_row, log = network, None, []
    with held(_examples(df, features, label)) as examples:
        for epoch in range(1, epochs + 1):
            tried = [Drawn((seed, epoch, branch), step=learning_rate) for branch in range(branch_factor)]
            if best_row is None:
                tried = [current.parameters, *tried]
            rows = sorted(_score(examples, current, tried).collect(), key=lambda r: r["candidate"])
            if best_row is None:
                best_row, rows, tried = rows[0], rows[1:], tried[1:]
            best = min(range(len(rows)), key=lambda i: (rows[i]["loss"], i))
            if rows[best]["loss"] < best_row["loss"]:
                best_row = rows[best]
                current = current.with_parameters(tried[best].parameters(current.layers, current.parameters))
            log.append((epoch, *best_row[1:]))
    return SearchResult(current, log, _metric_names(network))


# derivatives in terms of the activation's own output
SLOPES: dict[str, ArrayFunction] = {
    "relu": lambda a: (a > 0).astype(float), "sigmoid": lambda a: a * (1 - a), "tanh": lambda a: 1 - a * a,
    "identity": np.ones_like,
}


def _last_delta(layer: Layer, loss: PairFunction, out: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope of the loss by the last layer's sums before activation."""
    if loss is class_cross_entropy:
        target = np.zeros_like(out)
        target[np.arange(len(y)), y.astype(int)] = 1.0
        return out - target
    if loss is cross_entropy:
        return out - y[:, None]
    return 2 * (out - y[:, None]) * SLOPES[layer.activation_function](out)


def _gradients(layers: Sequence[Layer], parameters: Parameters, loss: PairFunction, x: np.ndarray,
               y: np.ndarray) -> tuple[np.ndarray, float]:
    """Summed gradients of the loss, flattened in the order of the parameters, and the summed loss."""
    outputs = [x]
    for layer, (w, b) in zip(layers, parameters):
        outputs.append(layer.apply(outputs[-1] @ w + b))
    out = outputs[-1][:, 0] if outputs[-1].shape[1] == 1 else outputs[-1]
    delta, parts = _last_delta(layers[-1], loss, outputs[-1], y), []
    for i in reversed(range(len(layers))):
        parts[:0] = [(outputs[i].T @ delta).ravel(), delta.sum(axis=0)]
        if i:
            delta = (delta @ parameters[i][0].T) * SLOPES[layers[i - 1].activation_function](outputs[i])
    return np.concatenate(parts), float(loss(y, out).sum())


def _mean_gradient(examples: DataFrame, network: Network) -> tuple[np.ndarray, float]:
    """Mean gradient and mean loss: one row of sums per task, added up in a tree of two levels."""
    layers, loss = network.layers, network.loss_function
    sent = examples.sparkSession.sparkContext.broadcast(network.parameters)
    schema = "n long, loss double, gradient array<double>"

    def row(n: int, loss: float, gradient: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([n]), pa.array([loss]), pa.array([gradient], pa.list_(pa.float64()))],
                               names=["n", "loss", "gradient"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, lost, n = 0.0, 0.0, 0
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                part, part_loss = _gradients(layers, sent.value, loss, x, batch.column("y").to_numpy())
                total, lost, n = total + part, lost + part_loss, n + batch.num_rows
        if n:
            yield row(n, lost, total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, lost, n = 0.0, 0.0, 0
        for batch in batches:
            for r in batch.to_pylist():
                total, lost, n = total + np.array(r["gradient"]), lost + r["loss"], n + r["n"]
        if n:
            yield row(n, lost, total)

    sums = examples.mapInArrow(scored, schema)
    tasks = math.isqrt(examples.sparkSession.sparkContext.defaultParallelism)
    if tasks > 1:
        sums = sums.repartition(tasks).mapInArrow(added, schema)
    rows = sums.collect()
    if not rows:
        raise ValueError("there are no rows to train on")
    n = sum(r["n"] for r in rows)
    return sum(np.array(r["gradient"]) for r in rows) / n, sum(r["loss"] for r in rows) / n


@dataclass
class AdaptiveSteps:
    """Steps scaled by running first and second moments of the gradient, both corrected for their start."""

    learning_rate: float = 0.001
    first_decay: float = 0.9
    second_decay: float = 0.999
    epsilon: float = 1e-8

    def start(self):
        self._m, self._v, self._t = 0.0, 0.0, 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self._t += 1
        self._m = self.first_decay * self._m + (1 - self.first_decay) * gradient
        self._v = self.second_decay * self._v + (1 - self.second_decay) * gradient ** 2
        m, v = self._m / (1 - self.first_decay ** self._t), self._v / (1 - self.second_decay ** self._t)
        return self.learning_rate * m / (np.sqrt(v) + self.epsilon)


@dataclass
class PlainSteps:
    """Steps in proportion to the gradient."""

    learning_rate: float = 0.1

    def start(self):
        pass

    def step(self, gradient: np.ndarray) -> np.ndarray:
        return self.learning_rate * gradient


def fit_gradient(df: DataFrame, features: str | Sequence[str], label: str, network: Network,
                 epochs: int, learning_rate: float = 0.1, steps: PlainSteps | AdaptiveSteps | None = None,
                 batches: int = 0, key: str | Sequence[str] | None = None, seed: int = 0) -> SearchResult:
    """Gradient training from the network's own parameters.

    The loss is the network's: squared error, cross-entropy after one sigmoid, or
    ``class_cross_entropy`` after a softmax. ``steps`` are plain ones with
    ``learning_rate`` unless given. Every step is one job. With ``batches`` an epoch
    takes one step per mini-batch, drawn by the unique ``key``. The log has the mean loss
    before each epoch's steps.
    """
    require_positive_int("epochs", epochs)
    last, hidden = network.layers[-1], network.layers[:-1]
    ends = {squared_error: [a for a in SLOPES], cross_entropy: ["sigmoid"], class_cross_entropy: ["softmax"]}
    if network.loss_function not in ends or last.activation_function not in ends[network.loss_function] or any(
            layer.activation_function not in SLOPES for layer in hidden) or (
                network.loss_function is not class_cross_entropy and last.output_size != 1):
        raise ValueError("no gradients are known for this loss, last layer and these activations together")
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    if batches and not keys:
        raise ValueError("mini-batches need a key column")
    require_columns(df, keys)
    steps = replace(steps) if steps else PlainSteps(learning_rate)
    steps.start()
    current, log = network, []
    with held(_examples(df, features, label, keys)) as examples:
        passes = epoch_batches(examples, "_key", seed, epochs, batches) if batches else (
            (epoch, [examples]) for epoch in range(1, epochs + 1))
        for epoch, tables in passes:
            losses = []
            for table in tables:
                gradient, loss = _mean_gradient(table, current)
                losses.append(loss)
                step, moved, at = steps.step(gradient), [], 0
                for w, b in current.parameters:
                    moved.append((w - step[at:at + w.size].reshape(w.shape), b - step[at + w.size:at + w.size + b.size]))
                    at += w.size + b.size
                current = current.with_parameters(moved)
            log.append((epoch, sum(losses) / len(losses)))
    return SearchResult(current, log, ())


def fit_perceptron(df: DataFrame, features: Sequence[str], label: str,
                   hidden_layer_sizes: Sequence[int] = (3, 4), max_iter: int = 1000, seed: int = 0):
    """Gradient-trained network for comparison, by Spark's own multilayer perceptron."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import VectorAssembler

    require_numeric(df, [*features, label])
    if more_than_two_values(df, label):
        raise ValueError("the label must be binary")
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_vector"),
        MultilayerPerceptronClassifier(
            layers=[len(features), *hidden_layer_sizes, 2], featuresCol="_vector", labelCol=label,
            maxIter=max_iter, seed=seed),
    ]).fit(usable_rows(df, [*features, label]))
