"""Exact order statistics of columns and groups of any size, sixteen bits at a time.

Doubles are read as integers that sort like them. A pass counts the values that share
the bits known so far by their next sixteen bits, which places every wanted rank in
one of these counts. Four passes know all 64 bits, whatever the spread of the values;
nothing but counts leaves a task, and no column's values meet anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpfit.checks import require_columns, require_numeric
from kelpfit.session import held, written

STEP = 16
BITS = 64


def sortable(x: np.ndarray) -> np.ndarray:
    """Integers in the order of some doubles; both zeros are one."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def unsortable(bits: np.ndarray) -> np.ndarray:
    return (bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles per column.

    After a first look at counts and extremes there are four passes at most. A pass
    returns at most 65,536 counts per rank. NULL and NaN count as missing; infinite
    values have no place between others and are refused.
    """
    require_numeric(df, columns)
    x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count(x[c]).alias(f"n{i}"), F.min(x[c]).alias(f"l{i}"), F.max(x[c]).alias(f"h{i}")]
    row = df.agg(*aggs).first()
    ranks = {}
    for i, c in enumerate(columns):
        if row[f"n{i}"] == 0:
            raise ValueError(f"column {c!r} has no values")
        if math.isinf(row[f"l{i}"]) or math.isinf(row[f"h{i}"]):
            raise ValueError(f"column {c!r} has infinite values")
        for p in probabilities:
            at = p * (row[f"n{i}"] - 1)
            ranks |= {(i, math.floor(at)): math.floor(at), (i, math.ceil(at)): math.ceil(at)}
    values = df.select(*[x[c].alias(f"x{i}") for i, c in enumerate(columns)])
    # (column, rank) -> bits known so far, rank among the values with these bits
    place = {key: (None, rank) for key, rank in ranks.items()}
    for shift in range(BITS - STEP, -1, -STEP):
        counts = _count_bits(values, sorted({(i, known) for (i, _), (known, _) in place.items()}, key=str), shift)
        for key, (known, inside) in place.items():
            for bits, n in counts[(key[0], known)]:
                if inside < n:
                    place[key] = (bits, inside)
                    break
                inside -= n
    done = {key: float(unsortable(np.array([bits], np.int64))[0]) for key, (bits, _) in place.items()}
    out = {}
    for i, c in enumerate(columns):
        out[c] = []
        for p in probabilities:
            at = p * (row[f"n{i}"] - 1)
            low, high = done[(i, math.floor(at))], done[(i, math.ceil(at))]
            out[c].append(low + (high - low) * (at - math.floor(at)))
    return out


def _count_bits(values: DataFrame, spans: list, shift: int) -> dict:
    """Per (column, known bits) the counts of values by their bits down to ``shift``, in order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [sortable(c.drop_null().to_numpy()) for c in batch.columns]
            for at, (i, known) in enumerate(spans):
                bits = columns[i] >> shift
                if known is not None:
                    bits = bits[bits >> STEP == known]
                found, n = np.unique(bits, return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(found), at, np.int32)), pa.array(found), pa.array(n)],
                                      names=["span", "bits", "n"])

    rows = values.mapInArrow(count, "span int, bits long, n long").groupBy("span", "bits").agg(F.sum("n").alias("n"))
    out = {span: [] for span in spans}
    for r in sorted(rows.collect()):
        out[spans[r["span"]]].append((r["bits"], r["n"]))
    return out


@F.pandas_udf(T.LongType())
def _sortable(x: pd.Series) -> pd.Series:
    return pd.Series(sortable(x.to_numpy(float)))


@F.pandas_udf(T.DoubleType())
def _unsortable(bits: pd.Series) -> pd.Series:
    return pd.Series(unsortable(bits.to_numpy(np.int64)))


def group_median(df: DataFrame, group: str | Sequence[str], value: str) -> DataFrame:
    """Median of every group: the group columns and ``median``.

    Groups may be of any number and size: a group's values never meet, only their counts
    do. NULL and NaN values are left out; a group without others is not there; an even
    number of values gives the mean of the middle two. NULL is a group of its own.
    """
    names = [group] if isinstance(group, str) else list(group)
    require_columns(df, names)
    require_numeric(df, [value])
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(F.struct(*names).alias("_g"), x.alias("_x")).where(F.col("_x").isNotNull())
    with held(rows.select("_g", _sortable("_x").alias("_b"))) as rows:
        sizes = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
        middle = F.array_distinct(F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)))
        # per wanted rank: the bits known so far, and the rank among the values that have them
        place = written(sizes.select("_g", F.explode(middle).alias("_rank")).select(
            "_g", "_rank", F.lit(0).cast("long").alias("_known"), F.col("_rank").alias("_inside")))
        for shift in range(BITS - STEP, -1, -STEP):
            first = shift == BITS - STEP
            known = F.lit(0).cast("long") if first else F.shiftright("_b", shift + STEP)
            some = rows.select("_g", known.alias("_known"), F.shiftright("_b", shift).alias("_bits"))
            if not first:
                some = some.join(place.select("_g", "_known").distinct(), ["_g", "_known"], "left_semi")
            counts = some.groupBy("_g", "_known", "_bits").agg(F.count(F.lit(1)).alias("_n"))
            w = Window.partitionBy("_g", "_known").orderBy("_bits").rowsBetween(Window.unboundedPreceding, -1)
            counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
            place = written(place.join(counts, ["_g", "_known"]).where(
                (F.col("_before") <= F.col("_inside")) & (F.col("_inside") < F.col("_before") + F.col("_n"))).select(
                "_g", "_rank", F.col("_bits").alias("_known"), (F.col("_inside") - F.col("_before")).alias("_inside")))
        return place.select("_g", _unsortable("_known").alias("_v")).groupBy("_g").agg(
            F.avg("_v").alias("median")).select("_g.*", "median")
