"""Distances between feature vectors.

Vectors are lists of scalar columns (unrolled, so they stay in generated code),
array columns, or NumPy matrices inside an Arrow task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from kelpfit.checks import require_choice

METRICS = ("euclidean", "manhattan", "squared_euclidean", "canberra")


def check_metric(metric: str) -> None:
    require_choice("distance_metric", metric, METRICS)


def _term(metric: str, a: Column, b: Column) -> Column:
    if metric == "manhattan":
        return F.abs(a - b)
    if metric == "canberra":
        # 0/0 counts as no difference; ANSI division would raise on it
        return F.coalesce(F.try_divide(F.abs(a - b), F.abs(a) + F.abs(b)), F.lit(0.0))
    return (a - b) * (a - b)


def distance(metric: str, left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Distance between two rows given as equally long lists of columns."""
    check_metric(metric)
    if len(left) != len(right):
        raise ValueError("vectors differ in length")
    total = reduce(lambda x, y: x + y, [_term(metric, a, b) for a, b in zip(left, right)])
    return F.sqrt(total) if metric == "euclidean" else total


def array_distance(metric: str, left: Column, right: Column) -> Column:
    """Distance between two array columns of equal length."""
    check_metric(metric)
    terms = F.zip_with(
        left.cast("array<double>"), right.cast("array<double>"), lambda a, b: _term(metric, a, b)
    )
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(total) if metric == "euclidean" else total


def pairwise(metric: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between the rows of two matrices inside one bounded block."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        if metric == "manhattan":
            out += np.abs(diff)
        elif metric == "canberra":
            weight = np.abs(a[:, j, None]) + np.abs(b[None, :, j])
            out += np.divide(np.abs(diff), weight, out=np.zeros_like(diff), where=weight > 0)
        else:
            out += diff * diff
    return np.sqrt(out) if metric == "euclidean" else out
