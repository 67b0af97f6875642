"""K-means with several metrics, one pass over the rows per iteration.

Most rows skip their distances. Now and then every row is given its cluster, its
distance to that centroid and to the second nearest one, for the centroids of that
moment. However far these have moved since, the triangle inequality bounds both
distances from the movements alone; where the bounds leave no doubt, the cluster stands.
Nothing is written between passes, as the bounds start from the kept distances.
Squared Euclidean distances are no metric: their roots are bounded instead.

Between passes points lie in an RDD of small packs, bytes of some rows each. Spark hands
these on one by one, so a task holds a few of them, however long its partition is; an Arrow
batch of larger packs would hold all that a task reads, in the JVM and once more in Python.
They lie on disk, from where they are read as a stream: Spark's memory store takes a block that
did not fit back in one piece, which a full heap has no room for.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpfit.checks import (
    is_array, require_choice, require_columns, require_numeric, require_positive_int, usable_rows,
)
from kelpfit.functions.distance import check_metric, pairwise
from kelpfit.functions.hashing import hash_uniform, key_hash
from kelpfit.operators.scaling import METHODS, Scaler, fit_scaler
from kelpfit.session import held

INIT_METHODS = ("kmeans++", "random")
# beyond this many literals generated methods grow too large to be compiled well
MAX_LITERALS = 256
ARROW_ROWS = 2048
# bytes of the points of a pack at most
PACK_BYTES = 1 << 18
# where tables lie between passes: blocks of a full memory store come back from disk in one piece each
KEPT = StorageLevel.DISK_ONLY
# starting rows chosen before the least distances so far are kept as a column
KEPT_EVERY = 8
MAX_UNROLLED = 64
# share of all distances that may be measured before rows get new distances to bound from, and
# passes between two such moments at least
STALE = 0.25
LEAST_PASSES = 3
# relative room for rounding in the bounds
SLACK = 1e-9
# cores from which on partial sums meet in tasks before they reach the driver
MANY_CORES = 64

Centroids = list[list[float]]


@dataclass(frozen=True)
class KMeans:
    """Settings. ``kmeans++`` starts from one random row and then takes the row
    farthest from its nearest chosen centroid; ``random`` takes k random rows.
    ``patience`` is accepted and has no effect: the first assignment that repeats
    ends the fit, as every further one would repeat too."""

    k: int = 2
    max_iter: int = 100
    patience: int = 10
    cluster_method: str = "kmeans++"
    distance_metric: str = "euclidean"
    random_state: int | None = None

    def __post_init__(self):
        for name in ("k", "max_iter", "patience"):
            require_positive_int(name, getattr(self, name))
        require_choice("cluster_method", self.cluster_method, INIT_METHODS)
        check_metric(self.distance_metric)
        if self.random_state is None:
            object.__setattr__(self, "random_state", random.randint(1, 100))

    def fit(
        self,
        df: DataFrame,
        features: str | Sequence[str],
        key: str,
        scaling_method: str | None = None,
        scope: str = "matrix",
        trace: bool = False,
    ) -> "KMeansModel":
        """Cluster the rows of ``df`` by named columns or one array column.

        Runs one job for scaling, k for farthest-first starts (one for random
        ones) and one per iteration. It stops when two consecutive assignments
        agree, which is where any further pass would repeat itself: when every
        cluster has as many rows as before and the same checksum of them. With
        ``trace`` rows that moved are counted, which measures distances to the former
        centroids as well.
        """
        columns = [features] if isinstance(features, str) else list(features)
        require_columns(df, [key])
        require_numeric(df, columns)
        if scaling_method is not None:
            require_choice("scaling_method", scaling_method, METHODS)
        rows = usable_rows(df.select(key, *columns), columns)
        with held(rows, KEPT) as rows:
            n = rows.count()
            scaler = fit_scaler(rows, columns, scaling_method, scope) if scaling_method else None
            base = (scaler.transform(rows) if scaler else rows).select(
                F.col(key).alias("_key"), _as_vector(rows, columns).alias("_x"))
            start = starting_centroids(base, self)
            points = _packed(base.select(*_coordinates(len(start[0])), F.xxhash64("_x").alias("_h"))).persist(KEPT)
            points.count()
        # passes need the points only: the keyed rows are let go, and so is every table once the next one is full
        steps, history, measured = [], [], []
        before, previous, centroids = None, None, start
        bounded, since, kept = None, 0, [points]
        try:
            for iteration in range(1, self.max_iter + 1):
                used = centroids
                stale = not measured or measured[-1] > STALE * n * self.k
                if iteration > 1 and stale and since >= LEAST_PASSES:
                    since = 0
                    bounded = (_with_bounds(kept[-1], self.distance_metric, used).persist(KEPT), used)
                    kept.append(bounded[0])
                centroids, seen, changed, number = _iterate(
                    kept[0], self.distance_metric, used, previous if trace else None, trace, bounded)
                while len(kept) > 1:
                    kept.pop(0).unpersist()
                measured.append(number)
                since += 1
                history.append(used)
                steps += [(iteration, c, used[c], seen[c][0], changed[c]) for c in range(self.k)]
                if seen == before:
                    break
                before, previous = seen, used
        finally:
            for table in kept:
                table.unpersist()
        return KMeansModel(tuple(columns), self.distance_metric, centroids, used, start, scaler,
                           steps if trace else None, history, measured)


@dataclass(frozen=True)
class KMeansModel:
    columns: tuple[str, ...]
    metric: str
    centroids: Centroids
    assigning_centroids: Centroids
    start: Centroids
    scaler: Scaler | None
    trace: list | None = field(repr=False)
    #: centroids that each iteration assigned by, and how many distances it measured
    history: list = field(default_factory=list, repr=False)
    measured: list = field(default_factory=list, repr=False)

    def _scaled(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """``df`` with the vector ``_x`` as it was clustered, and helper columns to drop again."""
        columns = list(self.columns)
        require_numeric(df, columns)
        names = [f"_s{i}" for i in range(len(columns))]
        scaled = df.withColumns({name: F.col(c) for name, c in zip(names, columns)})
        if self.scaler:
            scaled = Scaler(tuple(names), self.scaler.array, self.scaler.shift, self.scaler.divisor).transform(scaled)
        return scaled.withColumn("_x", _as_vector(scaled, names)), ["_x", *names]

    def _assign(self, df: DataFrame, centroids: Centroids, name: str) -> DataFrame:
        scaled, helpers = self._scaled(df)
        return scaled.withColumn(name, nearest("_x", centroids, self.metric)).drop(*helpers)

    def iteration_members(self, df: DataFrame, key: str, sample: float | None = None, seed: int = 0) -> DataFrame:
        """iteration, cluster and key of every row in every iteration, or of a share of rows picked by hash.

        One pass assigns a row under the centroids of all iterations.
        """
        require_columns(df, [key])
        if sample is not None:
            df = df.where(hash_uniform(seed, key) < sample)
        scaled, _ = self._scaled(usable_rows(df, list(self.columns)))
        k, metric = len(self.start), self.metric
        sent = df.sparkSession.sparkContext.broadcast(np.array(self.history).reshape(len(self.history) * k, -1))

        @F.pandas_udf("array<int>")
        def assign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                out = []
                for i in range(0, len(x), ARROW_ROWS):
                    d = pairwise(metric, np.stack(x.iloc[i:i + ARROW_ROWS].to_numpy()), sent.value)
                    out += list(d.reshape(len(d), -1, k).argmin(axis=2).astype("int32"))
                yield pd.Series(out, dtype=object)

        return scaled.select(F.col(key), F.posexplode(assign("_x")).alias("_at", "cluster")).select(
            (F.col("_at") + 1).alias("iteration"), "cluster", key)

    def transform(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        """Nearest final centroid for any rows, scaled with the fit-time statistics."""
        return self._assign(df, self.centroids, name)

    predict = transform

    def assignments(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        """Training assignment, as made just before the last centroid update."""
        return self._assign(df, self.assigning_centroids, name)

    def centroid_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            list(enumerate(self.centroids)), "cluster int, features array<double>")

    def cluster_sizes(self, df: DataFrame) -> DataFrame:
        return self.assignments(df).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))

    def iteration_trace(self, spark: SparkSession) -> DataFrame:
        """Per iteration and cluster: the centroid used, its size, and rows that moved in."""
        if self.trace is None:
            raise ValueError("fit with trace=True to count moves")
        return spark.createDataFrame(
            self.trace, "iteration int, cluster int, features array<double>, n long, changed long")

    def start_trace(self, spark: SparkSession) -> DataFrame:
        """Chosen starting centroids after each selection step."""
        rows = [
            (step, number, self.start[number], number == step - 1)
            for step in range(1, len(self.start) + 1)
            for number in range(step)
        ]
        return spark.createDataFrame(
            rows, "step int, centroid_no int, features array<double>, is_new boolean")

    def members(self, df: DataFrame, sample: float | None = None, seed: int = 0) -> DataFrame:
        """Rows with their cluster, optionally thinned for display."""
        rows = self.assignments(df)
        return rows if sample is None else rows.sample(fraction=sample, seed=seed)


def _as_vector(df: DataFrame, columns: Sequence[str]) -> Column:
    if len(columns) == 1 and is_array(df, columns[0]):
        return F.col(columns[0]).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in columns])


def _gaps(vector: str, centroids: Centroids, metric: str) -> list[str]:
    """SQL text of the distance to each centroid; parsed at once, unlike built columns."""
    check_metric(metric)
    out = []
    for centroid in centroids:
        terms = []
        for i, value in enumerate(centroid):
            x, c = f"{vector}[{i}]", f"({float(value)!r}D)"
            if metric == "manhattan":
                terms.append(f"abs({x} - {c})")
            elif metric == "canberra":
                terms.append(f"coalesce(try_divide(abs({x} - {c}), abs({x}) + abs({c})), 0D)")
            else:
                terms.append(f"({x} - {c}) * ({x} - {c})")
        total = " + ".join(terms)
        out.append(f"sqrt({total})" if metric == "euclidean" else f"({total})")
    return out


def _least_gap(vector: str, centroids: Centroids, metric: str) -> Column:
    """Distance to the nearest of some centroids; many travel as a broadcast matrix."""
    if len(centroids) * len(centroids[0]) <= MAX_LITERALS:
        gaps = _gaps(vector, centroids, metric)
        return F.expr(f"least({', '.join(gaps)})" if len(gaps) > 1 else gaps[0])
    matrix = SparkSession.getActiveSession().sparkContext.broadcast(np.array(centroids))

    @F.pandas_udf("double")
    def least(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            out = [
                pairwise(metric, np.stack(x.iloc[i:i + ARROW_ROWS].to_numpy()), matrix.value).min(axis=1)
                for i in range(0, len(x), ARROW_ROWS)
            ]
            yield pd.Series(np.concatenate(out) if out else np.array([], dtype=float))

    return least(F.col(vector))


def nearest(vector: str, centroids: Centroids, metric: str) -> Column:
    """Number of the nearest centroid; ties go to the lowest.

    Centroids are inlined as literals while they are few; larger models travel
    as a broadcast matrix and are compared in Arrow batches.
    """
    if len(centroids) * len(centroids[0]) <= MAX_LITERALS:
        gaps = f"array({', '.join(_gaps(vector, centroids, metric))})"
        return F.expr(f"cast(array_position({gaps}, array_min({gaps})) - 1 as int)")
    spark = SparkSession.getActiveSession()
    matrix = spark.sparkContext.broadcast(np.array(centroids))

    @F.pandas_udf("int")
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            out = [
                pairwise(metric, np.stack(x.iloc[i:i + ARROW_ROWS].to_numpy()), matrix.value).argmin(axis=1)
                for i in range(0, len(x), ARROW_ROWS)
            ]
            yield pd.Series(np.concatenate(out) if out else np.array([], dtype=int), dtype="int32")

    return assign(F.col(vector))


def starting_centroids(base: DataFrame, settings: KMeans) -> Centroids:
    order = key_hash(settings.random_state, "_key")
    if settings.cluster_method == "random":
        rows = base.orderBy(order).limit(settings.k).select("_x").collect()
        if len(rows) < settings.k:
            raise ValueError("k exceeds the number of rows")
        return [list(r["_x"]) for r in rows]
    first = base.agg(F.min_by("_x", order).alias("x")).first()["x"]
    if first is None:
        raise ValueError("there are no rows to cluster")
    chosen, kept = [list(first)], []
    near, rows, recent = F.lit(float("inf")), base, chosen[:]
    try:
        while len(chosen) < settings.k:
            if len(recent) > KEPT_EVERY:
                # distances to all but the newest row stay as a column from here on
                rows = rows.select("_key", "_x", F.least(near, _least_gap(
                    "_x", recent[:-1], settings.distance_metric)).alias("_near")).persist()
                kept.append(rows)
                near, recent = F.col("_near"), recent[-1:]
            gap = F.least(near, _least_gap("_x", recent, settings.distance_metric))
            farthest = rows.select((-gap).alias("d"), "_key", "_x").agg(
                F.min(F.struct("d", "_key", "_x")).alias("s")).first()["s"]
            # a column of distances is made from the one before it, which may go once it is full
            for old in kept[:-1]:
                old.unpersist()
            chosen.append(list(farthest["_x"]))
            recent.append(chosen[-1])
    finally:
        for old in kept:
            old.unpersist()
    return chosen


def _coordinates(d: int) -> list[Column]:
    """Scalar columns turn into a matrix much faster than arrays do, while they are not too many."""
    return [F.col("_x")[j].alias(f"x{j}") for j in range(d)] if d <= MAX_UNROLLED else [F.col("_x")]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    columns = [batch.column(i) for i in range(batch.num_columns - 1)]
    if len(columns) == 1 and pa.types.is_list(columns[0].type):
        return columns[0].flatten().to_numpy().reshape(batch.num_rows, -1)
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])


PACK = "x binary, h binary"


def _packed(points: DataFrame) -> RDD:
    """Bytes of the matrix of some points, with those of their hashes.

    Every pass reads all points, and rows of numbers cost far more to hand over than bytes.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.ascontiguousarray(_matrix(batch), float)
            h = batch.column(batch.num_columns - 1).to_numpy()
            rows = max(1, min(ARROW_ROWS, PACK_BYTES // max(1, x[:1].nbytes)))
            for i in range(0, len(x), rows):
                yield pa.record_batch([pa.array([a[i:i + rows].tobytes()], pa.binary()) for a in (x, h)], names=["x", "h"])

    return points.mapInArrow(pack, PACK).rdd.map(tuple)


def _unpacked(pack: tuple, d: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Points, hashes, and cluster, nearest and second nearest distance where they are kept."""
    x, h, *state = [np.frombuffer(v, kind) for v, kind in zip(pack, (float, np.uint64, np.int32, float, float))]
    return x.reshape(-1, d), h, state


def _root(metric: str, d: np.ndarray) -> np.ndarray:
    return np.sqrt(d) if metric == "squared_euclidean" else d


def _with_bounds(points: RDD, metric: str, centroids: Centroids) -> RDD:
    """Add every row's cluster and its distances to the nearest and the second nearest of some centroids."""
    sent, d = points.context.broadcast(np.array(centroids)), len(centroids[0])

    def measure(pack: tuple) -> tuple:
        x, _, _ = _unpacked(pack, d)
        gaps = _root(metric, pairwise(metric, x, sent.value))
        cluster = gaps.argmin(axis=1)
        own = gaps[np.arange(len(gaps)), cluster]
        gaps[np.arange(len(gaps)), cluster] = np.inf
        return (*pack[:2], *[v.tobytes() for v in (cluster.astype(np.int32), own, gaps.min(axis=1))])

    return points.map(measure)


def _iterate(points: RDD, metric: str, centroids: Centroids, previous: Centroids | None, trace: bool,
             bounded: tuple[RDD, Centroids] | None = None):
    """Assign rows and average clusters as partial sums: one tuple per task.

    ``bounded`` are the rows with distances to earlier centroids, and these centroids.
    Returns the new centroids, (size, checksum) of every cluster, how many rows moved
    into it with ``trace``, and the number of distances measured.
    """
    k, d = len(centroids), len(centroids[0])
    now, moved = np.array(centroids), None
    if bounded:
        points, then = bounded
        moved = np.array([_root(metric, pairwise(metric, now[c:c + 1], np.array(then[c:c + 1])))[0, 0] for c in range(k)])
    sent = points.context.broadcast((now, None if previous is None else np.array(previous), moved))

    def clusters(x: np.ndarray, state, now: np.ndarray, moved) -> tuple[np.ndarray, int]:
        if moved is None:
            return pairwise(metric, x, now).argmin(axis=1), x.shape[0] * k
        cluster, near, second = state
        # the largest movement of any other centroid
        order = np.argsort(moved)
        others = np.full(k, moved[order[-1]])
        others[order[-1]] = moved[order[-2]] if k > 1 else 0.0
        doubt = np.flatnonzero((near + moved[cluster]) * (1 + SLACK) >= (second - others[cluster]) * (1 - SLACK))
        cluster = cluster.astype(np.int64)
        if len(doubt):
            cluster[doubt] = pairwise(metric, x[doubt], now).argmin(axis=1)
        return cluster, len(doubt) * k

    def add_up(packs: Iterator[tuple]) -> Iterator[tuple]:
        now, before, moved = sent.value
        n, changed, sums = np.zeros(k, dtype=int), np.zeros(k, dtype=int), np.zeros((k, d))
        checksums, measured = np.zeros(k, dtype=np.uint64), 0
        for pack in packs:
            x, hashes, state = _unpacked(pack, d)
            cluster, number = clusters(x, state, now, moved)
            measured += number
            if trace:
                new = cluster if before is None else cluster[
                    pairwise(metric, x, before).argmin(axis=1) != cluster]
                changed += np.bincount(new, minlength=k)
            n += np.bincount(cluster, minlength=k)
            np.add.at(checksums, cluster, hashes)
            for j in range(d):
                sums[:, j] += np.bincount(cluster, weights=x[:, j], minlength=k)
        # 40 bits of every task's checksum, so that sums of a million tasks stay whole
        checksums = (checksums & np.uint64((1 << 40) - 1)).astype(np.int64)
        yield n, changed, checksums, sums.ravel(), measured

    partial = points.mapPartitions(add_up)
    cores = points.context.defaultParallelism
    if cores > MANY_CORES:
        partial = partial.repartition(math.isqrt(cores)).mapPartitions(_sums_added)
    n, changed, checksums, sums, measured = _add_sums(partial.collect())
    means = [[float(v / n[c]) for v in sums[c * d:(c + 1) * d]] if n[c] else list(centroids[c])  # an empty cluster stays
             for c in range(k)]
    return means, [(int(n[c]), int(checksums[c]) % (1 << 40)) for c in range(k)], [int(c) for c in changed], measured


def _add_sums(rows) -> list | None:
    out = None
    for one in rows:
        out = list(one) if out is None else [a + b for a, b in zip(out, one)]
    return out


def _sums_added(rows: Iterator[tuple]) -> Iterator[tuple]:
    found = _add_sums(rows)
    if found:
        yield tuple(found)


def cost(df: DataFrame, vector: str, centroids: Centroids, metric: str) -> float:
    """Total distance of all rows to their nearest centroid."""
    return df.agg(F.sum(_least_gap(vector, centroids, metric))).first()[0]


def without_points(df: DataFrame, columns: Sequence[str], points: Centroids) -> DataFrame:
    """Rows that equal none of the given points in all feature columns."""
    require_numeric(df, columns)
    hit = F.lit(False)
    for p in points:
        same = F.lit(True)
        for c, v in zip(columns, p):
            same = same & (F.col(c).cast("double") == F.lit(float(v)))
        hit = hit | same
    return df.where(~hit)
