"""Tables to feature vectors and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpfit.checks import require_columns, require_numeric


def to_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Gather numeric columns into one array column, keeping the others."""
    require_numeric(df, columns)
    packed = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*[c for c in df.columns if c not in columns], packed.alias(name))


def from_vector(df: DataFrame, column: str, names: Sequence[str] | int) -> DataFrame:
    """Spread an array column over named columns (``Column 0``, ... for a bare count)."""
    require_columns(df, [column])
    if isinstance(names, int):
        names = [f"Column {i}" for i in range(names)]
    return df.select(
        *[c for c in df.columns if c != column],
        *[F.col(column)[i].alias(n) for i, n in enumerate(names)],
    )


def columns_between(df: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Columns by position, with slice bounds."""
    return df.select(*df.columns[first:last])


def attach_target(X: DataFrame, y: DataFrame, key: str, target: str, name: str = "target") -> DataFrame:
    """Join features and target held in two tables by their shared key."""
    return X.join(y.select(key, F.col(target).alias(name)), key)


def feature_kinds(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """``categorical`` for strings, ``continuous`` for numbers; others are rejected."""
    require_columns(df, columns)
    kinds = {}
    for c in columns:
        t = df.schema[c].dataType
        if isinstance(t, T.StringType):
            kinds[c] = "categorical"
        elif isinstance(t, T.NumericType):
            kinds[c] = "continuous"
        else:
            raise TypeError(f"feature {c!r} is {t.simpleString()}")
    return kinds

