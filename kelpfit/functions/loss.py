"""Row losses as columns; averaging them is the aggregate's job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kelpfit.checks import require_choice

LOSSES = ("binary_cross_entropy", "mse", "mae")
EPSILON = 1e-7


def cross_entropy(y: Column, p: Column, epsilon: float = EPSILON) -> Column:
    one = F.lit(1.0)
    return -(y * F.log(p + epsilon) + (one - y) * F.log(one - p + epsilon))


def squared_error(y: Column, p: Column) -> Column:
    return (y - p) * (y - p)


def absolute_error(y: Column, p: Column) -> Column:
    return F.abs(y - p)


def hit(y: Column, p: Column, threshold: float = 0.5) -> Column:
    """1.0 where the thresholded prediction equals the label."""
    return (y == (p > threshold).cast("double")).cast("double")


def row_loss(name: str, y: Column, p: Column, epsilon: float = EPSILON) -> Column:
    require_choice("loss_function", name, LOSSES)
    if name == "binary_cross_entropy":
        return cross_entropy(y, p, epsilon)
    return squared_error(y, p) if name == "mse" else absolute_error(y, p)
