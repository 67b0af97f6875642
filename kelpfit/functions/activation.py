"""Activation functions and their derivatives as columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kelpfit.checks import require_choice

ACTIVATIONS = ("sigmoid", "tanh", "relu", "identity")


def linear(features: Sequence[Column], weights: Sequence[float], bias: float) -> Column:
    """``x . w + b`` as one unrolled sum."""
    if len(features) != len(weights):
        raise ValueError("one weight per feature is needed")
    return reduce(
        lambda acc, term: acc + term,
        [x * F.lit(float(w)) for x, w in zip(features, weights)],
    ) + F.lit(float(bias))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(x, F.lit(500.0)), F.lit(-500.0))))


def tanh(x: Column) -> Column:
    return F.tanh(x)


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def activate(name: str, x: Column) -> Column:
    require_choice("activation_function", name, ACTIVATIONS)
    return {"sigmoid": sigmoid, "tanh": tanh, "relu": relu, "identity": lambda v: v}[name](x)


def derivative(name: str, activated: Column) -> Column:
    """Derivative written in terms of the activation's own output."""
    require_choice("activation_function", name, ACTIVATIONS)
    one = F.lit(1.0)
    return {
        "sigmoid": activated * (one - activated),
        "tanh": one - activated * activated,
        "relu": (activated > 0).cast("double"),
        "identity": one,
    }[name]
