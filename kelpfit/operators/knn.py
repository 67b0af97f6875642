"""Exact k-nearest-neighbour joins, voting and averaging.

Training rows are dealt into the cells of seeded pivot rows once, when a model is
fitted. A query first meets the training rows of its own cell, which bounds how far its
k-th neighbour can be. By the triangle inequality (and the bisecting plane) no row of another
cell is nearer than a lower bound; cells are visited in the order of these bounds, in
rounds that grow, and between rounds the k-th distance so far closes all cells whose
bound is above it. A query is sent to open cells only. Crowded cells are cut further
into blocks of bounded size on both sides, so no task grows with the data or with a hot
cell. Where bounds leave most rows open, as in many dimensions, the rest of the search
joins large blocks of queries and training rows instead of cells.

Inside a block, cheap lower bounds of all distances come first, and only rows that may
be nearer than the k-th one known so far are measured.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpfit.checks import (
    is_array, require_choice, require_columns, require_numeric, require_positive_int, unusable_rows, usable_rows,
)
from kelpfit.functions.distance import check_metric, pairwise
from kelpfit.functions.hashing import key_hash
from kelpfit.operators.aggregates import heaviest, mode, weighted_mean, weighted_median_of_few
from kelpfit.operators.scaling import METHODS, Scaler, fit_scaler
from kelpfit.session import written

AGGREGATIONS = ("mean", "median", "mode")
# training rows per block; query blocks hold a quarter of that, to keep more tasks busy
BLOCK_ROWS = 32768
# cells aim at a sixteenth of a block, so that ruling one out is likely
CELLS_PER_BLOCK = 16
# beyond this many pivots their number follows the square root of the rows
MANY_PIVOTS = 1024
# cells of few rows follow their square root, as a visit has a cost of its own
ROOT_SHARE = 4
# cells that a query visits in the first round after its own; each further round takes more
FIRST_ROUND = 4
ROUND_GROWTH = 4
# share of all (query, row) pairs that may be left open before cells give way to large blocks
DENSE_SHARE = 0.25
CHUNK = 1024
# queries and training rows whose bounds a task looks at together: they fit its cache
TILE_QUERIES, TILE_ROWS = 64, 1024
# dimensions whose 16-bit differences are added before they go into wider numbers
CODE_DIMENSIONS = 64
# Canberra terms of one sign are tanh(gap of logarithms / 2), which lies above the chord to this gap
CHORD_GAP = 2.0
MOST_CODE = 14_000
WEIGHT_FLOOR = 1e-6
# rows measured exactly beyond k before near-ties are looked at one by one
SHORTLIST = 8
# relative room for rounding in the bounds that rule cells out
SLACK = 1e-9


def _vector(df: DataFrame, columns: Sequence[str]) -> Column:
    if len(columns) == 1 and is_array(df, columns[0]):
        return F.col(columns[0]).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in columns])


def _stack(x: pd.Series) -> np.ndarray:
    return np.stack(x.to_numpy()).astype(float)


def _metric_for_bounds(metric: str) -> str:
    # squared distances break the triangle inequality; their roots keep it
    return "euclidean" if metric == "squared_euclidean" else metric


def top_block(metric: str, queries: np.ndarray, train: np.ndarray, keys: np.ndarray, k: int):
    """Row numbers and distances of each query's k nearest in one block; ties by key.

    Euclidean distances are first estimated by a matrix product; the shortlist
    that can still be among the k nearest is then measured exactly.
    """
    by_key = _first_copies(train, np.argsort(keys, kind="stable"), k)
    train = train[by_key]
    queries, place = np.unique(queries, axis=0, return_inverse=True)
    k, width = min(k, len(train)), min(k + SHORTLIST, len(train))
    squared = metric in ("euclidean", "squared_euclidean")
    norms = (train * train).sum(axis=1)
    rows_out, dist_out = [], []
    step = max(1, 4_000_000 // len(train))
    for first in range(0, len(queries), step):
        q = queries[first:first + step]
        if squared:
            q_norms = (q * q).sum(axis=1)
            rough = q_norms[:, None] + norms[None, :] - 2.0 * (q @ train.T)
            room = 1e-10 * (q_norms + norms.max() + 1.0)
        else:
            rough = pairwise(metric, q, train)
            room = np.zeros(len(q))
        near = np.argpartition(rough, width - 1, axis=1)[:, :width]
        kth = np.partition(np.take_along_axis(rough, near, axis=1), k - 1, axis=1)[:, k - 1]
        limit = kth + 2 * room
        d = _paired(metric, q, train, near) if squared else np.take_along_axis(rough, near, axis=1)
        best = np.lexsort((near, d), axis=1)[:, :k]
        rows, dist = np.take_along_axis(near, best, axis=1), np.take_along_axis(d, best, axis=1)
        # many rows at almost the same distance: measure all of them
        for i in np.flatnonzero((rough <= limit[:, None]).sum(axis=1) > width):
            all_near = np.flatnonzero(rough[i] <= limit[i])
            exact = pairwise(metric, q[i:i + 1], train[all_near])[0]
            order = np.argsort(exact, kind="stable")[:k]
            rows[i], dist[i] = all_near[order], exact[order]
        rows_out.append(by_key[rows])
        dist_out.append(dist)
    place = place.ravel()
    return np.concatenate(rows_out)[place], np.concatenate(dist_out)[place]


class _Codes:
    """Lower bounds of Manhattan and Canberra distances by 16-bit codes of the coordinates.

    Code differences, cut at ``cap``, never exceed the terms by more than one unit for
    rounding; bounds are in these units. Canberra terms are bounded by gaps of logarithms; opposite signs count as 1.
    """

    def __init__(self, metric: str, queries: np.ndarray, train: np.ndarray):
        self.canberra, self.dimensions = metric == "canberra", train.shape[1]
        self.cap = 32_767 // min(self.dimensions, CODE_DIMENSIONS)
        both = (queries, train)
        if self.canberra:
            self.unit = math.tanh(CHORD_GAP / 2) / self.cap
            logs = [np.log(np.abs(x), out=np.full(x.shape, -np.inf), where=x != 0) for x in both]
            top = max(max(v.max(initial=-np.inf) for v in logs), -1e300)
            step = self.unit * CHORD_GAP / math.tanh(CHORD_GAP / 2)
            codes = [self.cap // 2 + 1 + MOST_CODE - np.rint(np.minimum((top - v) / step, MOST_CODE)) for v in logs]
            codes = [np.where(x < 0, -c, c) for x, c in zip(both, codes)]
            self.signs = [np.where(x < 0, -1, 1).astype(np.float32) for x in both]
        else:
            low, high = np.quantile(train, [0.001, 0.999], axis=0)
            middle = (low + high) / 2
            self.unit = max((high - low).max() * 1.25, 1e-300) / self.cap
            codes = [np.clip(np.rint((x - middle) / self.unit), -MOST_CODE, MOST_CODE) for x in both]
        self.queries, self.train = [np.ascontiguousarray(c.astype(np.int16).T) for c in codes]
        spread = max(c.max(initial=0) for c in codes) - min(c.min(initial=0) for c in codes)
        self.cut = self.canberra or spread > self.cap

    def lows(self, q: slice, t: slice) -> np.ndarray:
        shape = (q.stop - q.start, t.stop - t.start)
        total, sums, gap = np.zeros(shape, np.float32), np.empty(shape, np.int16), np.empty(shape, np.int16)
        cap = np.full(shape, self.cap, np.int16)  # several times faster than one number
        for first in range(0, self.dimensions, CODE_DIMENSIONS):
            sums[:] = 0
            for j in range(first, min(first + CODE_DIMENSIONS, self.dimensions)):
                np.subtract(self.queries[j, q, None], self.train[j, None, t], out=gap)
                np.abs(gap, out=gap)
                if self.cut:
                    np.minimum(gap, cap, out=gap)
                np.add(sums, gap, out=sums)
            total += sums
        if self.canberra:
            opposite = (self.dimensions - self.signs[0][q] @ self.signs[1][t].T) / 2
            total += np.float32((1 - math.tanh(CHORD_GAP / 2)) / self.unit) * opposite
        # room for the rounded codes and single precision
        return total * np.float32(1 - 1e-4) - np.float32(self.dimensions)

    def comparable(self, limit: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.nextafter((limit / self.unit).astype(np.float32), np.float32(np.inf))


class _Products:
    """Lower bounds of squared Euclidean distances by a matrix product."""

    def __init__(self, queries: np.ndarray, train: np.ndarray):
        self.queries, self.train = queries, train
        self.q_norms, self.t_norms = (queries * queries).sum(axis=1), (train * train).sum(axis=1)
        self.room = 2e-10 * (self.q_norms + self.t_norms.max(initial=0.0) + 1.0)

    def lows(self, q: slice, t: slice) -> np.ndarray:
        rough = (self.q_norms[q] - self.room[q])[:, None] + self.t_norms[None, t]
        return rough - 2.0 * (self.queries[q] @ self.train[t].T)

    def comparable(self, limit: np.ndarray) -> np.ndarray:
        return limit


def near_in_block(metric: str, queries: np.ndarray, train: np.ndarray, keys: np.ndarray, k: int, reach: np.ndarray):
    """Numbers of queries and rows and their distances, for each query's k nearest rows in one block; ties by key.

    Rows farther than the query's ``reach`` are left out.
    """
    by_key = _first_copies(train, np.argsort(keys, kind="stable"), k)
    train = train[by_key]
    squared = metric in ("euclidean", "squared_euclidean")
    bounds = _Products(queries, train) if squared else _Codes(metric, queries, train)
    out = []
    for first in range(0, len(queries), TILE_QUERIES):
        q = slice(first, min(first + TILE_QUERIES, len(queries)))
        far = reach[q].astype(float)
        # some rows at once, for a first bound
        d = pairwise(metric, queries[q], train[:k])
        if d.shape[1] == k:
            far = np.minimum(far, d.max(axis=1))
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for start in range(0, len(train), TILE_ROWS):
            t = slice(start, min(start + TILE_ROWS, len(train)))
            limit = (far * far if metric == "euclidean" else far) * (1 + SLACK) + SLACK
            at, row = np.nonzero(bounds.lows(q, t) <= bounds.comparable(limit)[:, None])
            if not len(at):
                continue
            row += start
            d = np.concatenate([_apart(metric, queries[first + at[i:i + CHUNK * 64]], train[row[i:i + CHUNK * 64]])
                                for i in range(0, len(at), CHUNK * 64)])
            at, row, d = at[near := d <= far[at]], row[near], d[near]
            if not len(at):
                continue
            best = _k_least(*[np.concatenate(v) for v in zip(best, (at, row, d))], k)
            counts = np.bincount(best[0], minlength=len(far))
            full = counts >= k
            far[full] = np.minimum(far[full], best[2][np.cumsum(counts)[full] - 1])
        out.append((best[0] + first, by_key[best[1]], best[2]))
    return [np.concatenate(v) for v in zip(*out)]


def _apart(metric: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between rows with the same number, summed as :func:`pairwise` does."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        x, y = a[:, j], b[:, j]
        diff = x - y
        if metric == "manhattan":
            total += np.abs(diff)
        elif metric == "canberra":
            weight = np.abs(x) + np.abs(y)
            total += np.divide(np.abs(diff), weight, out=np.zeros_like(diff), where=weight > 0)
        else:
            total += diff * diff
    return np.sqrt(total) if metric == "euclidean" else total


def _k_least(at: np.ndarray, row: np.ndarray, d: np.ndarray, k: int):
    """Per query the k lowest distances, in order; of equal ones the first rows."""
    order = np.lexsort((row, d, at))
    at = at[order]
    new = np.append(True, at[1:] != at[:-1])[:len(at)]
    nth = np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    order = order[nth < k]
    return at[nth < k], row[order], d[order]


def _first_copies(train: np.ndarray, by_key: np.ndarray, k: int) -> np.ndarray:
    """Leave out copies of a point beyond its k lowest keys.

    Copies are equally far from any query and ties go by key, so later ones can
    never be among its k nearest.
    """
    _, group = np.unique(train[by_key], axis=0, return_inverse=True)
    group = group.ravel()
    order = np.argsort(group, kind="stable")
    counts = np.bincount(group)
    nth = np.empty(len(group), dtype=int)
    nth[order] = np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)
    return by_key[nth < k]


def _paired(metric: str, q: np.ndarray, train: np.ndarray, near: np.ndarray) -> np.ndarray:
    total = np.zeros(near.shape)
    for j in range(q.shape[1]):
        diff = q[:, j, None] - train[near, j]
        total += diff * diff
    return np.sqrt(total) if metric == "euclidean" else total


@dataclass(frozen=True)
class Cells:
    """Pivots and, per cell, the training row count and distance ring."""

    metric: str
    pivots: np.ndarray
    rows: np.ndarray
    inner: np.ndarray
    outer: np.ndarray


def _assign_cells(df: DataFrame, metric: str, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot's number and its distance."""
    measure = _metric_for_bounds(metric)

    @F.pandas_udf("cell int, gap double")
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for x in batches:
            cells, gaps = [np.empty(0, dtype="int32")], [np.empty(0)]
            for i in range(0, len(x), CHUNK):
                d = pairwise(measure, _stack(x.iloc[i:i + CHUNK]), pivots)
                cells.append(d.argmin(axis=1).astype("int32"))
                gaps.append(d.min(axis=1))
            yield pd.DataFrame({"cell": np.concatenate(cells), "gap": np.concatenate(gaps)})

    return df.withColumn("_a", assign("_x")).select("*", "_a.cell", "_a.gap").drop("_a")


def _pivots(train: DataFrame, n: int, block_rows: int) -> np.ndarray:
    """Seeded rows to build cells around: few enough to measure every row against all of them."""
    wanted = max(1, math.isqrt(n) // ROOT_SHARE, min(n // max(1, block_rows // CELLS_PER_BLOCK), max(MANY_PIVOTS, math.isqrt(n))))
    rows = train.orderBy(key_hash("pivot", "_t")).limit(wanted).select("_x").collect()
    return np.array([r["_x"] for r in rows], dtype=float)


def _spread(side: DataFrame, own: str, other: str, own_blocks: Column, other_blocks: Column,
            row: str) -> DataFrame:
    """Put a row in one of its side's blocks and copy it to every block of the other side."""
    return side.withColumn(own, F.pmod(F.hash(F.col(row), F.lit(17)), own_blocks)).withColumn(
        other, F.explode(F.sequence(F.lit(0), other_blocks - 1)))


def _block_counts(counts: dict[int, int], block_rows: int) -> Column:
    pairs = [v for c, n in sorted(counts.items())
             for v in (F.lit(c), F.lit(max(1, math.ceil(n / block_rows))))]
    if not pairs:
        return F.lit(1)
    return F.coalesce(F.create_map(*pairs)[F.col("cell")], F.lit(1))


def _join_cells(visits: DataFrame, train: DataFrame, metric: str, k: int,
                train_rows: dict[int, int], query_rows: dict[int, int], block_rows: int,
                label_type: str, query_type: str, key_type: str) -> DataFrame:
    """Top k of every (query, visited cell block) within the query's reach; at most k rows per query and block."""
    return _join_blocks(visits, train, metric, k, _block_counts(train_rows, block_rows),
                        _block_counts(query_rows, max(1, block_rows // 4)), label_type, query_type, key_type)


def _join_blocks(visits: DataFrame, train: DataFrame, metric: str, k: int, t_blocks: Column, q_blocks: Column,
                 label_type: str, query_type: str, key_type: str) -> DataFrame:
    left = _spread(visits, "qb", "tb", q_blocks, t_blocks, "_q")
    right = _spread(train, "tb", "qb", t_blocks, q_blocks, "_t")

    def meet(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(t) == 0:
            return pd.DataFrame({"_q": q["_q"][:0], "neighbour": t["_t"][:0],
                                 "distance": np.array([], dtype=float), "label": t["_y"][:0]})
        asked, rows, dist = near_in_block(
            metric, _stack(q["_x"]), _stack(t["_x"]), t["_t"].to_numpy(), k, q["_far"].to_numpy(float))
        return pd.DataFrame({"_q": q["_q"].to_numpy()[asked], "neighbour": t["_t"].to_numpy()[rows],
                             "distance": dist, "label": t["_y"].to_numpy()[rows]})

    keys = ["cell", "tb", "qb"]
    return (
        left.select("_q", "_x", "_far", *keys).groupBy(*keys)
        .cogroup(right.select("_t", "_y", "_x", *keys).groupBy(*keys))
        .applyInPandas(
            meet, f"_q {query_type}, neighbour {key_type}, distance double, label {label_type}")
    )


def _count_by_cell(df: DataFrame) -> dict[int, int]:
    return {r["cell"]: r["count"] for r in df.groupBy("cell").count().collect()}


def _other_cells(metric: str, cells: Cells, features: Column, home: Column, reach: Column) -> Column:
    """Cells other than home that may hold a row within ``reach``, with lower bounds, nearest bound first."""
    measure = _metric_for_bounds(metric)
    euclid = measure == "euclidean"
    between = pairwise(measure, cells.pivots, cells.pivots)

    def bounds(q: np.ndarray, h: np.ndarray, r: np.ndarray) -> tuple[list, list]:
        d = pairwise(measure, q, cells.pivots)
        low = np.maximum(d - cells.outer[None, :], cells.inner[None, :] - d)
        if euclid:
            own = d[np.arange(len(q)), h]
            gap = between[h]
            plane = np.divide(d * d - (own * own)[:, None], 2 * gap,
                              out=np.zeros_like(d), where=gap > 0)
            low = np.maximum(low, plane)
        # a little lower, for rounding
        low = low - SLACK * (1.0 + d + np.where(np.isfinite(r), r, 0.0)[:, None])
        open_cells = (low <= r[:, None]) & (cells.rows > 0)[None, :]
        open_cells[np.arange(len(q)), h] = False
        found = [np.flatnonzero(row) for row in open_cells]
        found = [f[np.argsort(low[i, f], kind="stable")].astype("int32") for i, f in enumerate(found)]
        return found, [low[i, f] for i, f in enumerate(found)]

    @F.pandas_udf("cells array<int>, lows array<double>")
    def visit(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for x, h, r in batches:
            found, lows = [], []
            for i in range(0, len(x), CHUNK):
                some = bounds(_stack(x.iloc[i:i + CHUNK]), h.to_numpy()[i:i + CHUNK], r.to_numpy()[i:i + CHUNK])
                found += some[0]
                lows += some[1]
            yield pd.DataFrame({"cells": pd.Series(found, dtype=object), "lows": pd.Series(lows, dtype=object)})

    return visit(features, home, reach)


@dataclass(frozen=True)
class Index:
    """Training rows in cells, written once and read by every search."""

    rows: DataFrame
    cells: Cells
    n: int
    features: tuple[str, ...]
    key_type: str
    label_type: str
    block_rows: int

    @property
    def in_cell(self) -> dict[int, int]:
        return {c: int(v) for c, v in enumerate(self.cells.rows) if v}


def build_index(train: DataFrame, key: str, features: Sequence[str], label: str,
                metric: str = "euclidean", block_rows: int = BLOCK_ROWS) -> Index:
    """Deal the usable training rows into cells."""
    check_metric(metric)
    features = [features] if isinstance(features, str) else list(features)
    require_columns(train, [key])
    require_numeric(train, features)
    t = usable_rows(train, [*features, label]).select(
        F.col(key).alias("_t"), F.col(label).alias("_y"), _vector(train, features).alias("_x"))
    n = t.count()
    pivots = _pivots(t, n, block_rows) if n else np.zeros((1, 1))
    t = written(_assign_cells(t, metric, pivots) if n else t.withColumns({"cell": F.lit(0), "gap": F.lit(0.0)}))
    rows, inner, outer = np.zeros(len(pivots)), np.zeros(len(pivots)), np.zeros(len(pivots))
    for r in t.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("gap").alias("lo"), F.max("gap").alias("hi")).collect():
        rows[r["cell"]], inner[r["cell"]], outer[r["cell"]] = r["n"], r["lo"], r["hi"]
    return Index(t, Cells(metric, pivots, rows, inner, outer), n, tuple(features),
                 train.schema[key].dataType.simpleString(), train.schema[label].dataType.simpleString(),
                 block_rows)


def search(queries: DataFrame, query_key: str, index: Index, k: int, log: list | None = None) -> DataFrame:
    """The k nearest indexed rows of every usable query, ranked by distance, then key.

    Columns: the query key, ``rank`` (1-based), ``neighbour``, ``distance``, ``label``.
    ``log`` takes the number of (query, cell) visits of every round, the own cells first.
    """
    require_positive_int("k", k)
    features = list(index.features)
    require_columns(queries, [query_key])
    require_numeric(queries, features)
    if k > index.n:
        raise ValueError("n_neighbors cannot exceed the number of training rows")
    metric, in_cell = index.cells.metric, index.in_cell
    settings = dict(block_rows=index.block_rows, label_type=index.label_type, key_type=index.key_type,
                    query_type=queries.schema[query_key].dataType.simpleString())
    q = usable_rows(queries, features).select(
        F.col(query_key).alias("_q"), _vector(queries, features).alias("_x"))
    q = written(_assign_cells(q, metric, index.cells.pivots))
    at_home = _count_by_cell(q)
    if log is not None:
        log.append(sum(at_home.values()))
    found = _join_cells(q.withColumn("_far", F.lit(float("inf"))), index.rows, metric, k, in_cell, at_home, **settings)
    if len(in_cell) > 1:
        found = _search_further(q, index, k, written(_best(found, k)), settings, log)
    return _best(found, k).select(
        F.col("_q").alias(query_key), "rank", "neighbour", "distance", "label")


def _search_further(q: DataFrame, index: Index, k: int, found: DataFrame, settings: dict, log: list | None) -> DataFrame:
    """Candidates of every query, after the cells that its k-th distance so far cannot rule out."""
    metric, in_cell, width = index.cells.metric, index.in_cell, FIRST_ROUND

    def reach(found: DataFrame) -> DataFrame:
        return found.groupBy("_q").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).alias("_far"))

    unknown = float("inf")
    # bounds are roots of squared distances
    bound = F.sqrt("_far") if metric == "squared_euclidean" else F.col("_far")
    seen = _other_cells(metric, index.cells, F.col("_x"), F.col("cell"), bound)
    lists = written(q.join(reach(found), "_q", "left").fillna(unknown, "_far").withColumn("_o", seen).select(
        "_q", "_x", "_far", "_o.cells", "_o.lows"))
    while True:
        visits = lists.select("_q", "_x", "_far", F.explode(F.slice("cells", 1, width)).alias("cell"))
        visited = _count_by_cell(visits)
        if not visited:
            return found
        if log is not None:
            log.append(sum(visited.values()))
        away = _join_cells(visits, index.rows.where(F.col("cell").isin(list(visited))), metric, k, in_cell, visited,
                           **settings)
        found = found.drop("rank").unionByName(away)
        later = lists.where(F.size("cells") > width)
        if not later.limit(1).count():
            return found
        found = written(_best(found, k))
        # bounds rise along a list, so what is still open is its beginning
        rest = later.drop("_far").join(reach(found), "_q", "left").fillna(unknown, "_far").select(
            "_q", "_x", F.slice("cells", width + 1, F.size("cells")).alias("cells"),
            F.slice("lows", width + 1, F.size("lows")).alias("lows"), "_far", bound.alias("_bound"))
        n_open = F.size(F.filter("lows", lambda v: v <= F.col("_bound")))
        rest = rest.withColumn("_n", n_open).where("_n > 0")
        lists = written(rest.select("_q", "_x", "_far", F.expr("slice(cells, 1, _n)").alias("cells"),
                                    F.expr("slice(lows, 1, _n)").alias("lows")))
        asked, still_open = lists.agg(F.count(F.lit(1)), F.sum(F.size("cells"))).first()
        if asked and still_open > DENSE_SHARE * asked * len(in_cell):
            if log is not None:
                log.append(still_open)
            return found.drop("rank").join(lists.select("_q"), "_q", "left_anti").unionByName(
                _in_blocks(lists, index, k, asked, settings))
        width *= ROUND_GROWTH


def _in_blocks(lists: DataFrame, index: Index, k: int, asked: int, settings: dict) -> DataFrame:
    """The k nearest rows of some queries among all training rows, in large blocks of both sides."""
    block, cores = index.block_rows, lists.sparkSession.sparkContext.defaultParallelism
    t_blocks = math.ceil(index.n / block)
    # small tables are cut further, to keep all cores busy
    wanted = min(4 * cores, asked * index.n >> 22)
    q_blocks = max(math.ceil(asked / block), math.ceil(wanted / t_blocks))
    types = {name: value for name, value in settings.items() if name != "block_rows"}
    return _join_blocks(lists.select("_q", "_x", "_far", F.lit(0).alias("cell")), index.rows.withColumn("cell", F.lit(0)),
                        index.cells.metric, k, F.lit(t_blocks), F.lit(q_blocks), **types)


def nearest(
    queries: DataFrame,
    train: DataFrame,
    query_key: str,
    train_key: str,
    features: Sequence[str],
    label: str,
    k: int,
    metric: str = "euclidean",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """:func:`search` in an index made for this one call."""
    return search(queries, query_key, build_index(train, train_key, features, label, metric, block_rows), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("_q").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def with_weights(neighbours: DataFrame) -> DataFrame:
    """Inverse-distance weights; an exact match keeps a finite one."""
    return neighbours.withColumn("weight", F.lit(1.0) / (F.col("distance") + WEIGHT_FLOOR))


@dataclass(frozen=True)
class _Neighbours:
    n_neighbors: int = 3
    distance_metric: str = "euclidean"
    weighting: bool = False
    block_rows: int = BLOCK_ROWS

    def __post_init__(self):
        require_positive_int("n_neighbors", self.n_neighbors)
        check_metric(self.distance_metric)
        if not isinstance(self.weighting, bool):
            raise TypeError("weighting must be true or false")


@dataclass(frozen=True)
class KNNModel:
    """Indexed training rows with their fit-time scaling, which queries share."""

    settings: _Neighbours
    index: Index
    key: str
    features: tuple[str, ...]
    label: str
    scaler: Scaler | None

    def neighbours(self, queries: DataFrame, query_key: str | None = None) -> DataFrame:
        query_key = query_key or self.key
        if self.scaler:
            queries = self.scaler.transform(queries)
        return search(queries, query_key, self.index, self.settings.n_neighbors)

    def _with_unusable(self, answers: DataFrame, queries: DataFrame, query_key: str) -> DataFrame:
        """Queries with a missing feature have no neighbours; their answer is NULL."""
        left_out = unusable_rows(queries, list(self.features)).select(
            query_key, F.lit(None).cast(answers.schema["prediction"].dataType).alias("prediction"))
        return answers.select(query_key, "prediction").unionByName(left_out)


def _fit(settings, df, features, label, key, scaling_method, scope):
    features = [features] if isinstance(features, str) else list(features)
    require_columns(df, [key, label])
    require_numeric(df, features)
    scaler = None
    train = df.select(key, label, *features)
    if scaling_method is not None:
        require_choice("scaling_method", scaling_method, METHODS)
        scaler = fit_scaler(usable_rows(train, features), features, scaling_method, scope)
        train = scaler.transform(train)
    index = build_index(train, key, features, label, settings.distance_metric, settings.block_rows)
    return index, key, tuple(features), label, scaler


@dataclass(frozen=True)
class KNNClassifier(_Neighbours):
    """Majority vote, or votes weighted by inverse distance; ties to the nearest."""

    def fit(self, df: DataFrame, features, label: str, key: str,
            scaling_method: str | None = None, scope: str = "matrix") -> "KNNClassifierModel":
        return KNNClassifierModel(self, *_fit(self, df, features, label, key, scaling_method, scope))


@dataclass(frozen=True)
class KNNClassifierModel(KNNModel):
    def predict(self, queries: DataFrame, query_key: str | None = None) -> DataFrame:
        """Query key and ``prediction``; ranking and voting share one shuffle."""
        query_key = query_key or self.key
        near = self.neighbours(queries, query_key)
        if self.settings.weighting:
            votes = heaviest(with_weights(near), [query_key], "label", "weight", "rank", "prediction")
        else:
            votes = mode(near, [query_key], "label", "rank", "prediction")
        return self._with_unusable(votes, queries, query_key)


@dataclass(frozen=True)
class KNNRegressor(_Neighbours):
    """Mean, median or mode of the neighbours' values, weighted on request."""

    def fit(self, df: DataFrame, features, label: str, key: str,
            scaling_method: str | None = None, scope: str = "matrix") -> "KNNRegressorModel":
        return KNNRegressorModel(self, *_fit(self, df, features, label, key, scaling_method, scope))


@dataclass(frozen=True)
class KNNRegressorModel(KNNModel):
    def predict(self, queries: DataFrame, query_key: str | None = None,
                aggregation_function: str = "mean", by_value: bool = False) -> DataFrame:
        """Query key and ``prediction``.

        The weighted median walks the neighbours nearest first; ``by_value``
        walks them in value order instead.
        """
        require_choice("aggregation_function", aggregation_function, AGGREGATIONS)
        query_key = query_key or self.key
        near = self.neighbours(queries, query_key)
        answers = self._combined(near, query_key, aggregation_function, by_value)
        return self._with_unusable(answers, queries, query_key)

    def _combined(self, near: DataFrame, query_key: str, aggregation_function: str, by_value: bool) -> DataFrame:
        if not self.settings.weighting:
            if aggregation_function == "mode":
                return mode(near, [query_key], "label", "rank", "prediction")
            value = F.avg("label") if aggregation_function == "mean" else F.median("label")
            return near.groupBy(query_key).agg(value.alias("prediction"))
        near = with_weights(near)
        if aggregation_function == "mean":
            return near.groupBy(query_key).agg(
                weighted_mean(F.col("label"), F.col("weight")).alias("prediction"))
        if aggregation_function == "mode":
            return heaviest(near, [query_key], "label", "weight", "rank", "prediction")
        order = "rank"
        if by_value:
            near = near.withColumn("_o", F.struct("label", "rank"))
            order = "_o"
        return weighted_median_of_few(near, [query_key], "label", "weight", order, "prediction")
