"""Seeded synthetic columns and rows, derived from row keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpfit.checks import require_numeric
from kelpfit.functions.hashing import hash_int, hash_normal, hash_uniform

# Share of "Yes" in each column of the heart-disease demo.
HEART_SHARES = {
    "chest_pain": 2 / 3,
    "good_blood_circulation": 1 / 3,
    "blocked_arteries": 1 / 3,
    "overweight": 2 / 3,
    "high_blood_pressure": 3 / 4,
    "heart_disease": 1 / 2,
}


def key_table(spark: SparkSession, n: int, key: str = "id") -> DataFrame:
    return spark.range(n).withColumnRenamed("id", key)


def with_yes_no(df: DataFrame, key: str, shares: Mapping[str, float] = HEART_SHARES,
                seed: int = 42) -> DataFrame:
    """Independent Yes/No columns with the given shares of Yes."""
    return df.withColumns({
        name: F.when(hash_uniform(f"{seed}:{name}", key) < F.lit(share), "Yes").otherwise("No")
        for name, share in shares.items()
    })


def with_integers(df: DataFrame, key: str, name: str, low: int, high: int, seed: int = 0) -> DataFrame:
    """Uniform integers in ``[low, high)``."""
    return df.withColumn(name, hash_int(f"{seed}:{name}", key, low, high))


def with_uniform(df: DataFrame, key: str, name: str, low: float, high: float, seed: int = 0,
                 places: int | None = None) -> DataFrame:
    """Uniform doubles in ``(low, high)``, optionally rounded."""
    value = hash_uniform(f"{seed}:{name}", key) * (high - low) + low
    return df.withColumn(name, value if places is None else F.round(value, places))


def with_two_gaussians(df: DataFrame, key: str, centre: float = 1.25, sd: float = 0.75,
                       seed: int = 0) -> DataFrame:
    """``y`` in {0, 1} at even odds; ``X`` normal about ``-centre`` or ``+centre``."""
    y = (hash_uniform(f"{seed}:y", key) >= F.lit(0.5)).cast("int")
    x = hash_normal(f"{seed}:X", key, F.when(y == 1, centre).otherwise(-centre), sd)
    return df.withColumns({"X": x, "y": y})


def synthetic_rows(df: DataFrame, columns: Sequence[str], keys: DataFrame, key: str,
                   seed: int = 0) -> DataFrame:
    """One new row per key, every value inside its column's observed range.

    Whole-number columns draw from ``[min, max)``, others from ``(min, max)``.
    """
    require_numeric(df, columns)
    extremes = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns)
                        for n, f in (("l", F.min), ("h", F.max))]).first()
    drawn = []
    for i, c in enumerate(columns):
        low, high = extremes[f"l{i}"], extremes[f"h{i}"]
        kind = df.schema[c].dataType
        if isinstance(kind, T.IntegralType):
            value = hash_int(f"{seed}:{c}", key, low, max(high, low + 1))
        else:
            value = hash_uniform(f"{seed}:{c}", key) * F.lit(float(high - low)) + F.lit(float(low))
        drawn.append(value.cast(kind).alias(c))
    return keys.select(key, *drawn)


def with_synthetic_rows(df: DataFrame, columns: Sequence[str], keys: DataFrame, key: str,
                        seed: int = 0) -> DataFrame:
    """The observed rows followed by synthetic ones."""
    return df.select(key, *columns).unionByName(synthetic_rows(df, columns, keys, key, seed))
