"""A single neuron trained by gradient steps, one aggregate job per step."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpfit.checks import (
    is_array, require_choice, require_columns, require_numeric, require_positive_int, usable_rows,
)
from kelpfit.functions.activation import activate, derivative, linear
from kelpfit.functions.hashing import normal_draw, uniform_draw
from kelpfit.functions.loss import hit, row_loss
from kelpfit.operators.aggregates import more_than_two_values
from kelpfit.operators.split import epoch_batches
from kelpfit.session import held

PROBLEMS = ("classification", "regression")
INITIAL = ("uniform", "scaled_normal", "zeros")
GRADIENTS = ("residual", "exact")
BATCHES = 10
# What each kind of problem uses unless told otherwise, and may use.
DEFAULTS = {"classification": ("sigmoid", "binary_cross_entropy"), "regression": ("tanh", "mse")}
ALLOWED = {
    "classification": (("sigmoid",), ("binary_cross_entropy",)),
    "regression": (("tanh",), ("mse", "mae")),
}


def problem_type(df: DataFrame, label: str) -> str:
    """More than two distinct targets make it a regression."""
    return "regression" if more_than_two_values(df, label) else "classification"


def initial_weights(d: int, how: str = "uniform", seed: object = 0) -> list[float]:
    require_choice("initial weights", how, INITIAL)
    if how == "zeros":
        return [0.0] * d
    if how == "uniform":
        return [2.0 * uniform_draw(seed, "w", j) - 1.0 for j in range(d)]
    return [normal_draw(seed, "w", j) / d ** 0.5 for j in range(d)]


def choose_functions(problem: str, activation: str | None, loss: str | None) -> tuple[str, str]:
    """Fill in the defaults and reject pairs that do not belong to the problem."""
    require_choice("problem type", problem, PROBLEMS)
    activation = {"tan_h": "tanh"}.get(activation, activation) or DEFAULTS[problem][0]
    loss = loss or DEFAULTS[problem][1]
    require_choice(f"activation_function for {problem}", activation, ALLOWED[problem][0])
    require_choice(f"loss_function for {problem}", loss, ALLOWED[problem][1])
    return activation, loss


@dataclass(frozen=True)
class Neuron:
    """Training settings.

    ``batches`` cuts every epoch into that many seeded mini-batches; 0 trains on
    the full table at once. The residual gradient is ``sum((p - y) * x)``; the
    exact one includes the activation's derivative and the sign of absolute errors.
    """

    epochs: int = 100
    learning_rate: float = 0.01
    activation_function: str | None = None
    loss_function: str | None = None
    gradient: str = "residual"
    batches: int = BATCHES
    bias: float = 1.0
    initial: str = "uniform"
    random_state: int | None = None

    def __post_init__(self):
        require_positive_int("epochs", self.epochs)
        if not isinstance(self.learning_rate, (int, float)) or self.learning_rate <= 0:
            raise ValueError("learning_rate must be positive")
        require_choice("gradient", self.gradient, GRADIENTS)
        require_choice("initial weights", self.initial, INITIAL)
        if self.batches < 0:
            raise ValueError("batches must not be negative")
        if self.random_state is None:
            object.__setattr__(self, "random_state", random.randint(1, 2**31))

    def start(self, df: DataFrame, features: str | Sequence[str], label: str,
              weights: Sequence[float] | None = None) -> "NeuronModel":
        """Untrained model with its problem type and initial weights."""
        features = [features] if isinstance(features, str) else list(features)
        require_numeric(df, [*features, label])
        problem = problem_type(df, label)
        activation, loss = choose_functions(problem, self.activation_function, self.loss_function)
        array = len(features) == 1 and is_array(df, features[0])
        d = df.select(F.max(F.size(features[0]))).first()[0] if array else len(features)
        if weights is None:
            weights = initial_weights(d, self.initial, self.random_state)
        return NeuronModel(tuple(features), array, label, problem, activation, loss,
                           tuple(float(w) for w in weights), float(self.bias))

    def fit(self, df: DataFrame, features: str | Sequence[str], label: str,
            key: str | Sequence[str] | None = None,
            weights: Sequence[float] | None = None) -> "NeuronModel":
        """Train on ``df``. Mini-batches need a unique ``key`` to be drawn by."""
        keys = [] if key is None else [key] if isinstance(key, str) else list(key)
        if self.batches and not keys:
            raise ValueError("mini-batches need a key column")
        require_columns(df, keys)
        names = [features] if isinstance(features, str) else list(features)
        rows = usable_rows(df.select(*dict.fromkeys([*keys, *names, label])), [*names, label])
        with held(rows) as rows:
            model = self.start(rows, names, label, weights)
            return self._train(rows, keys, model, [self.learning_rate])[0]

    def _train(self, rows: DataFrame, keys: list[str], start: "NeuronModel",
               rates: Sequence[float]) -> list["NeuronModel"]:
        """One model per learning rate, trained side by side: every step is one job for all of them."""
        models, histories = [start] * len(rates), [[] for _ in rates]
        epochs = epoch_batches(rows, keys, self.random_state, self.epochs, self.batches) if self.batches else (
            (epoch, [rows]) for epoch in range(1, self.epochs + 1))
        for epoch, batches in epochs:
            losses = [[] for _ in rates]
            for batch in batches:
                models, values = _step(models, batch, rates, self.gradient)
                for own, value in zip(losses, values):
                    own.append(value)
            for history, own in zip(histories, losses):
                history.append((epoch, sum(own) / len(own)))
        return [replace(m, history=h) for m, h in zip(models, histories)]


@dataclass(frozen=True)
class NeuronModel:
    features: tuple[str, ...]
    array: bool
    label: str
    problem: str
    activation: str
    loss: str
    weights: tuple[float, ...]
    bias: float
    history: list = field(default_factory=list, repr=False)

    def slots(self) -> list[Column]:
        if self.array:
            return [F.col(self.features[0])[j].cast("double") for j in range(len(self.weights))]
        return [F.col(c).cast("double") for c in self.features]

    def activated(self) -> Column:
        return activate(self.activation, linear(self.slots(), self.weights, self.bias))

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Activation of every row; valid on streaming tables too."""
        require_numeric(df, self.features)
        return df.withColumn(name, self.activated())

    predict = transform

    def score(self, df: DataFrame) -> DataFrame:
        """One-row table with the mean loss on ``df``."""
        y = F.col(self.label).cast("double")
        return self.transform(df, "_p").agg(F.avg(row_loss(self.loss, y, F.col("_p"))).alias("loss"))

    def accuracy(self, df: DataFrame) -> DataFrame:
        if self.problem != "classification":
            raise ValueError("accuracy is only available for classification problems")
        y = F.col(self.label).cast("double")
        return self.transform(df, "_p").agg(F.avg(hit(y, F.col("_p"))).alias("accuracy"))

    def loss_history(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "epoch int, loss double")

    def decision_curve(self, df: DataFrame, points: int = 100) -> DataFrame:
        """Predictions on an even grid between the extremes of a one-feature table."""
        if len(self.weights) != 1 or self.array:
            raise ValueError("a decision curve needs exactly one feature")
        require_positive_int("points", points)
        c = self.features[0]
        low, high = df.agg(F.min(c).cast("double"), F.max(c).cast("double")).first()
        step = (high - low) / max(1, points - 1)
        grid = df.sparkSession.range(points).select(
            F.col("id").cast("int").alias("point"), (F.lit(low) + F.col("id") * F.lit(step)).alias(c))
        return self.transform(grid)


def _step(models: list[NeuronModel], batch: DataFrame, rates: Sequence[float],
          gradient: str) -> tuple[list[NeuronModel], list[float]]:
    """Loss and gradient sums of one batch for all models in one job, then their weight updates."""
    first = models[0]
    d, y = len(first.weights), F.col("_y")
    scored = batch.select(
        F.col(first.label).cast("double").alias("_y"),
        *[m.activated().alias(f"_p{i}") for i, m in enumerate(models)],
        *[x.alias(f"_x{j}") for j, x in enumerate(first.slots())])
    sums = []
    for i, model in enumerate(models):
        p = F.col(f"_p{i}")
        error = p - y
        if gradient == "exact" and model.problem == "regression":
            error = F.signum(error) if model.loss == "mae" else error
            error = error * derivative(model.activation, p)
        sums += [F.avg(row_loss(model.loss, y, p)), F.sum(error), *[F.sum(error * F.col(f"_x{j}")) for j in range(d)]]
    row, out, losses = scored.agg(*sums).first(), [], []
    for i, (model, rate) in enumerate(zip(models, rates)):
        loss, bias, *gradients = row[i * (d + 2):(i + 1) * (d + 2)]
        weights = tuple(w - rate * g for w, g in zip(model.weights, gradients))
        out.append(replace(model, weights=weights, bias=model.bias - rate * bias))
        losses.append(loss)
    return out, losses


def grid_search(df: DataFrame, features: str | Sequence[str], label: str,
                epochs: Sequence[int], learning_rates: Sequence[float],
                settings: Neuron = Neuron(), key: str | Sequence[str] | None = None) -> DataFrame:
    """Final loss for every setting; a run serves all its shorter epoch counts, and all rates share its jobs."""
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    if settings.batches and not keys:
        raise ValueError("mini-batches need a key column")
    names = [features] if isinstance(features, str) else list(features)
    rates = [replace(settings, learning_rate=r).learning_rate for r in learning_rates]  # each is checked
    settings = replace(settings, epochs=max(epochs))
    used = usable_rows(df.select(*dict.fromkeys([*keys, *names, label])), [*names, label])
    with held(used) as used:
        models = settings._train(used, keys, settings.start(used, names, label), rates)
    rows = [(e, float(rate), m.history[e - 1][1]) for rate, m in zip(rates, models) for e in sorted(epochs)]
    return df.sparkSession.createDataFrame(rows, "epochs int, learning_rate double, loss double")
