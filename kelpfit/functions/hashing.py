"""Seeded pseudo-random columns derived from row keys.

The same seed and key give the same number on any cluster, whatever the
partitioning, and any engine with MD5 can recompute it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = 4294967296.0


def key_text(keys: str | Column | Sequence[str]) -> Column:
    if isinstance(keys, Column):
        return keys.cast("string")
    names = [keys] if isinstance(keys, str) else list(keys)
    return F.concat_ws(":", *[F.col(k).cast("string") for k in names])


def key_hash(seed: object, keys: str | Column | Sequence[str]) -> Column:
    """``md5(seed:key)`` as 32 hex digits; its order is the seeded shuffle order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key_text(keys)))


def _word(digest: Column, first: int) -> Column:
    return F.conv(F.substring(digest, first, 8), 16, 10).cast("double")


def hash_uniform(seed: object, keys: str | Column | Sequence[str]) -> Column:
    """Uniform number strictly between 0 and 1."""
    return (_word(key_hash(seed, keys), 1) + 0.5) / F.lit(_SPAN)


def hash_int(seed: object, keys: str | Column | Sequence[str], low: object, high: object) -> Column:
    """Uniform integer in ``[low, high)``."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return (F.floor(hash_uniform(seed, keys) * (high - low)) + low).cast("long")


def hash_normal(
    seed: object, keys: str | Column | Sequence[str], mean: object = 0.0, sd: object = 1.0
) -> Column:
    """Normal number by the Box-Muller transform of two uniforms."""
    digest = key_hash(seed, keys)
    u = (_word(digest, 1) + 0.5) / F.lit(_SPAN)
    v = (_word(digest, 9) + 0.5) / F.lit(_SPAN)
    z = F.sqrt(F.log(u) * -2.0) * F.cos(v * (2 * math.pi))
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    return z * sd + mean


def normal_draw(*parts: object) -> float:
    """Driver-side counterpart of :func:`hash_normal`, for model weights."""
    digest = hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()
    u = (int(digest[:8], 16) + 0.5) / _SPAN
    v = (int(digest[8:16], 16) + 0.5) / _SPAN
    return math.sqrt(-2.0 * math.log(u)) * math.cos(2 * math.pi * v)


def uniform_draw(*parts: object) -> float:
    """Driver-side counterpart of :func:`hash_uniform`."""
    digest = hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()
    return (int(digest[:8], 16) + 0.5) / _SPAN
