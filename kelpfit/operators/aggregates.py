"""Aggregates with explicit tie rules, over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpfit.session import written


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def mode(df: DataFrame, groups: Sequence[str], value: str, first_met: str,
         name: str = "mode") -> DataFrame:
    """Most frequent value per group; ties go to the value met first.

    "First" is the lowest ``first_met``. Counting runs per (group, value) before
    the groups are compared, so a hot group is never gathered in one place.
    """
    counted = df.groupBy(*groups, value).agg(
        F.count(F.lit(1)).alias("_n"), F.min(first_met).alias("_first"))
    best = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col("_first")))
    return counted.groupBy(*groups).agg(best.alias(name))


def heaviest(df: DataFrame, groups: Sequence[str], value: str, weight: str, first_met: str,
             name: str = "mode") -> DataFrame:
    """Value with the largest total weight per group; ties as in :func:`mode`."""
    summed = df.groupBy(*groups, value).agg(
        F.sum(weight).alias("_w"), F.min(first_met).alias("_first"))
    best = F.min_by(F.col(value), F.struct((-F.col("_w")).alias("w"), F.col("_first")))
    return summed.groupBy(*groups).agg(best.alias(name))


def weighted_mean(value: Column, weight: Column) -> Column:
    """``sum(v*w)/sum(w)``, 0.0 where the weights sum to zero."""
    return F.coalesce(F.try_divide(F.sum(value * weight), F.sum(weight)), F.lit(0.0))


def weighted_median(df: DataFrame, groups: Sequence[str], value: str, weight: str,
                    order: Sequence[str], name: str = "median") -> DataFrame:
    """First value, walking in ``order``, where the running weight reaches half.

    Rows are range-partitioned by group and order, so even a group holding most
    rows is spread out: each slice sorts its own rows and adds the weight of the
    group's slices before it.
    """
    row = df.select(*groups, F.struct(*order).alias("_o"), F.col(value).alias("_v"),
                    F.col(weight).alias("_w"))
    # slice numbers must not change between passes, so they are written down once
    placed = written(
        row.repartitionByRange(*groups, "_o").withColumn("_slice", F.spark_partition_id()))
    by_slice = Window.partitionBy(*groups).orderBy("_slice")
    slices = (
        placed.groupBy(*groups, "_slice").agg(F.sum("_w").alias("_part"))
        .withColumns({
            "_before": F.coalesce(
                F.sum("_part").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_all": F.sum("_part").over(Window.partitionBy(*groups)),
        })
        # only the slice in which half the weight is reached matters, and the one after
        # it, for running sums of rows add up in another order than sums of slices
        .where((F.col("_before") + F.col("_part") >= F.col("_all") / 2))
        .withColumn("_nth", F.row_number().over(by_slice)).where("_nth <= 2")
    )
    inside = Window.partitionBy(*groups, "_slice").orderBy("_o").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    reached = (
        placed.join(slices, [*groups, "_slice"])
        .withColumn("_run", F.col("_before") + F.sum("_w").over(inside))
        .where(F.col("_run") >= F.col("_all") / 2)
    )
    return reached.groupBy(*groups).agg(F.min_by("_v", "_o").alias(name))


def weighted_median_of_few(df: DataFrame, groups: Sequence[str], value: str, weight: str,
                           order: str, name: str = "median") -> DataFrame:
    """:func:`weighted_median` for groups of bounded size, such as one query's neighbours."""
    running = Window.partitionBy(*groups).orderBy(order)
    whole = Window.partitionBy(*groups)
    reached = (
        df.withColumn("_run", F.sum(weight).over(
            running.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_all", F.sum(weight).over(whole))
        .where(F.col("_run") >= F.col("_all") / 2)
    )
    return reached.groupBy(*groups).agg(F.min_by(value, order).alias(name))


def distinct_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each string column, as rows ``(feature, value)``."""
    pairs = [part for c in columns for part in (F.lit(c), F.col(c))]
    return df.select(F.stack(F.lit(len(columns)), *pairs).alias("feature", "value")).distinct()


def more_than_two_values(df: DataFrame, column: str) -> bool:
    """Whether a column has three or more distinct values, reading no more than needed."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().limit(3).count() > 2


def gini(counts: Sequence[Column]) -> Column:
    """Gini impurity ``1 - sum(p^2)`` of class counts; 0 for an empty node."""
    n = sum(counts[1:], counts[0])
    squares = sum([c.cast("double") * c for c in counts[1:]], counts[0].cast("double") * counts[0])
    return F.coalesce(F.lit(1.0) - F.try_divide(squares, n.cast("double") * n), F.lit(0.0))


def weighted_gini(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Size-weighted impurity of the two sides of a split."""
    n_left, n_right = sum(left[1:], left[0]), sum(right[1:], right[0])
    n = (n_left + n_right).cast("double")
    return F.try_divide(n_left * gini(left) + n_right * gini(right), n)


def squared_residuals(n: Column, total: Column, squares: Column) -> Column:
    """Sum of squared residuals about the mean, from centred sums."""
    return squares - F.coalesce(F.try_divide(total * total, n.cast("double")), F.lit(0.0))
