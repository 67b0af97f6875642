"""Driver-side parameter and schema checks, and the missing-value policy."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_choice(name: str, value: object, allowed: Iterable[object]) -> None:
    allowed = list(allowed)
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")


def is_array(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.ArrayType)


def require_numeric(df: DataFrame, columns: Iterable[str]) -> None:
    columns = list(columns)
    require_columns(df, columns)
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if not isinstance(kind, T.NumericType):
            raise TypeError(f"column {c!r} is {kind.simpleString()}, not numeric")


def require_positive_int(name: str, value: object) -> None:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{name} must be a positive integer, not {value!r}")


def _missing(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    col = F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.DoubleType, T.FloatType)):
            return col.isNull() | F.exists(col, lambda v: v.isNull() | F.isnan(v))
        return col.isNull() | F.exists(col, lambda v: v.isNull())
    return col.isNull()


def usable_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with neither NULL nor NaN in any of ``columns``."""
    for c in columns:
        df = df.where(~_missing(df, c))
    return df


def unusable_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The other rows: NULL or NaN in one of ``columns`` at least."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | _missing(df, c)
    return df.where(bad)


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows there are and how many the policy drops."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | _missing(df, c)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(bad, 1)).alias("n_dropped"),
    )
