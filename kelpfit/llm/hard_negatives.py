"""Hard negatives of anchors: near rows of another label, by exact inner products.

Anchors are clustered by direction, and the members of a cluster share sorted lists of
candidates. For a cluster with centre c whose members lie within an angle b of c, no
member u has an inner product above |u| |x| cos(max(0, angle(c, x) - b)) with a
candidate x. The candidates of a block are sorted by this bound once per cluster, and
every member walks the list until the bound falls below what it still needs: the last
of its best rows, or the lower end of its score window. What it has not seen then
cannot matter, so results are exact.

Candidates stay in blocks of bounded size and are shuffled once per walk; the
anchors, a stated query set, are sent to the blocks. Only the best rows of an anchor leave a
block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpfit.llm.common import numbered, stored

CLUSTERS = 16
BLOCK_ROWS = 8192
#: Members that walk a list together, and the first stretch of a walk; stretches double.
MEMBERS = 256
STRETCH = 1024
LONGEST = (1 << 63) - 1


def usable_vectors(vectors: DataFrame, is_anchor: Column, scale: int) -> DataFrame:
    """Rows that take part, with components as integers."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return vectors.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"))


def _matrix(column: pa.ListArray, width: int, kind) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), kind)
    out[np.repeat(np.arange(len(column)), sizes),
        np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class _Clusters:
    """Unit centres and the greatest angle of a member to its centre; a few rows, sent with the code."""

    def __init__(self, centres: np.ndarray, angles: np.ndarray | None = None):
        self.centres, self.angles = centres, angles

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster of every row and its angle to the centre."""
        cosines = _directions(x) @ self.centres.T
        best = cosines.argmax(1)
        return best, np.arccos(np.clip(cosines[np.arange(len(x)), best], -1, 1))

    def bounds(self, x: np.ndarray, cluster: int) -> np.ndarray:
        """The most that a member of length one can reach with each row; a little above, for rounding."""
        x = x.astype(float)
        angle = np.arccos(np.clip(_directions(x) @ self.centres[cluster], -1, 1))
        near = np.maximum(0.0, angle - self.angles[cluster] - 1e-6)
        return np.linalg.norm(x, axis=1) * (np.cos(near) + 1e-9)


def _directions(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def anchor_clusters(anchors: DataFrame, width: int, clusters: int, rounds: int = 2) -> _Clusters:
    """Spherical k-means of the anchors from ``clusters`` of them picked by hash."""
    picked = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(clusters).select("v").collect()
    centres = _directions(np.array([list(r["v"]) + [0] * (width - len(r["v"])) for r in picked], float).reshape(-1, width))

    def sums(model: _Clusters):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, widest = np.zeros((len(centres), width)), np.zeros(len(centres))
            for batch in batches:
                x = _matrix(batch.column("v"), width, float)
                at, angle = model.nearest(x)
                np.add.at(total, at, _directions(x))
                np.maximum.at(widest, at, angle)
            yield pa.record_batch(
                [pa.array(np.arange(len(centres)), pa.int32()), pa.array(list(total), pa.list_(pa.float64())),
                 pa.array(widest)], names=["cluster", "total", "widest"])
        return run

    angles = np.zeros(len(centres))
    for last in [False] * rounds + [True]:
        rows = anchors.select("v").mapInArrow(sums(_Clusters(centres)), "cluster int, total array<double>, widest double")
        found = rows.groupBy("cluster").agg(
            F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(width)]).alias("total"),
            F.max("widest").alias("widest")).collect()
        for r in found:
            if last:
                angles[r["cluster"]] = r["widest"]
            elif any(r["total"]):
                centres[r["cluster"]] = _directions(np.array([r["total"]]))[0]
    return _Clusters(centres, angles)


class _Block:
    """Candidates of one block, and their order for the cluster at hand."""

    def __init__(self, ids, labels, x, model: _Clusters):
        self.ids, self.labels, self.x, self.model, self.cluster = ids, labels, x, model, None

    def listed(self, cluster: int) -> None:
        if cluster != self.cluster:
            bound = self.model.bounds(self.x, cluster)
            self.order = np.argsort(-bound, kind="stable")
            self.bound, self.cluster = bound[self.order], cluster

    def walk(self, members: list[dict], u: np.ndarray, k: int, same: bool) -> Iterator[tuple[int, int, int, int]]:
        """Best rows (anchor, window, row, score) of members of one cluster."""
        open_, size = np.arange(len(members)), np.linalg.norm(u.astype(float), axis=1)
        scores, at, step = np.empty((len(members), 0), u.dtype), 0, STRETCH
        while len(open_):
            part = self.order[at:at + step]
            scores = np.concatenate([scores, u[open_] @ self.x[part].T], axis=1)
            at, step = at + len(part), at + len(part)
            seen = self.order[:at]
            labels, ids = self.labels[seen], self.ids[seen]
            stay = []
            for i, m in enumerate(open_):
                one = members[m]
                rest = size[m] * self.bound[at] if at < len(self.order) else -np.inf
                fits = ((labels == one["label"]) == same) & (ids != one["vec_id"])
                found, closed = _best(one, scores[i][fits], ids[fits], k, rest)
                if closed:
                    for window, rows in enumerate(found):
                        for other, score in rows:
                            yield one["vec_id"], window, other, score
                else:
                    stay.append(i)
            scores, open_ = scores[stay], open_[stay]


def _best(one: dict, scores: np.ndarray, ids: np.ndarray, k: int, rest: float):
    """Best rows of each window so far, and whether rows of at most ``rest`` can change none."""
    wide = (scores >= min(one["lows"])) & (scores <= max(one["highs"]))
    scores, ids = scores[wide], ids[wide]
    order = np.lexsort((ids, -scores))
    scores, ids = scores[order], ids[order]
    found, closed = [], True
    for low, high in zip(one["lows"], one["highs"]):
        first = np.searchsorted(-scores, -high, "left")
        last = min(first + k, np.searchsorted(-scores, -low, "right"))
        rows = [(int(i), int(s)) for i, s in zip(ids[first:last], scores[first:last])]
        closed &= low > high or rest < low or len(rows) == k and rest < rows[-1][1]
        found.append(rows)
    return found, closed


def best_in_windows(rows: DataFrame, anchors: DataFrame, model: _Clusters, blocks: int, width: int, exact: bool,
                    k: int, same: bool) -> DataFrame:
    """The ``k`` best rows of every anchor in each of its score windows.

    ``anchors`` has vec_id, label, v, cluster, lows and highs; ``same`` asks for rows of
    the anchor's label, else for those of other labels. Returns anchor_id, window,
    other_id, score and rank.
    """
    kind = float if exact else object
    empty = F.lit(None).cast("array<bigint>")
    side = rows.select(
        F.pmod(F.xxhash64("_rid"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"),
        F.lit(0).alias("cluster"), "vec_id", "label", "v", empty.alias("lows"), empty.alias("highs"))
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "cluster", "vec_id",
        "label", "v", "lows", "highs")
    dealt = side.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind", "cluster", "vec_id")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, here, block = [], None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "kind", "cluster")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for low, high in zip(edges[:-1], edges[1:]):
                if low == high:
                    continue
                at, sort, cluster = keys[low].tolist()
                if at != here:
                    parts, here, block = [], at, None
                some = batch.slice(low, high - low)
                if sort == 0:
                    parts.append((some.column("vec_id").to_numpy(), np.array(some.column("label").to_pylist(), object),
                                  _matrix(some.column("v"), width, kind)))
                    continue
                if not parts:
                    continue
                if block is None:
                    block = _Block(*[np.concatenate(p) for p in zip(*parts)], model)
                block.listed(cluster)
                for first in range(0, some.num_rows, MEMBERS):
                    group = some.slice(first, MEMBERS)
                    members = group.select(["vec_id", "label", "lows", "highs"]).to_pylist()
                    out = list(block.walk(members, _matrix(group.column("v"), width, kind), k, same))
                    if out:
                        yield pa.record_batch(
                            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                            names=["anchor_id", "window", "other_id", "score"])

    found = dealt.mapInArrow(walk, "anchor_id long, window int, other_id long, score long")
    w = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _floor_div(a: Column, b: int) -> Column:
    return ((a - F.pmod(a, F.lit(b).cast("long"))) / b).cast("long")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
                   low_percent: int = 30, high_percent: int = 90, scale: int = 256, clusters: int = CLUSTERS,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Hard negatives of every anchor and each of its positives.

    Takes ``vec_id`` (a whole number), ``label`` and ``embedding``; other columns are
    ignored, whatever their names, except by ``is_anchor``. Components x become
    floor(scale * x), scores are integer inner products, ties go by smaller vec_id. An
    anchor's positives are its first other rows of its label; the negatives of a
    positive with score p are the first rows of another label with low_percent * p <=
    100 * score <= high_percent * p. Returns anchor_id, positive_id, rank (from 1), negative_id,
    positive_score and negative_score; a positive without such rows gives none.

    Rows without id or label, with a null vector or a null or non-finite component
    take no part. Shorter vectors are filled with zeros. "Other" rows have another
    vec_id: of anchors that repeat an id the smallest (label, vector) counts, while
    repeated candidates keep their places. Empty tables give an empty result. Scores
    must fit a long.
    """
    rows = stored(numbered(usable_vectors(vectors, is_anchor, scale)), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(F.abs(F.array_max(F.transform(
        "v", lambda c: F.abs(c))))).alias("largest")).first()
    n, width, largest = size["n"], max(1, size["width"] or 0), size["largest"] or 0
    blocks = max(1, math.ceil(n / block_rows))
    # sums of products below 2^53 are exact in doubles; larger ones take Python integers
    exact = width * largest * largest < 1 << 53
    anchors = rows.where("anchor").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.*")
    model = anchor_clusters(anchors, width, clusters)
    if not len(model.centres):
        return rows.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    @F.pandas_udf("int")
    def cluster(v: pd.Series) -> pd.Series:
        x = np.array([np.pad(np.asarray(one, float), (0, width - len(one))) for one in v]).reshape(-1, width)
        return pd.Series(model.nearest(x)[0])

    anchors = stored(anchors.withColumn("cluster", cluster("v")), "anchors")
    whole = anchors.withColumns({"lows": F.array(F.lit(-LONGEST)), "highs": F.array(F.lit(LONGEST))})
    near = best_in_windows(rows, whole, model, blocks, width, exact, positives, True).select(
        F.col("anchor_id").alias("vec_id"), F.struct(
            "rank", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")).alias("p"))
    near = stored(near.groupBy("vec_id").agg(F.sort_array(F.collect_list("p")).alias("ps")), "positives")
    windows = anchors.join(near, "vec_id").select("*", F.transform("ps", lambda p: -_floor_div(
        -low_percent * p["positive_score"], 100)).alias("lows"), F.transform("ps", lambda p: _floor_div(
            high_percent * p["positive_score"], 100)).alias("highs"))
    found = best_in_windows(rows, windows, model, blocks, width, exact, negatives, False)
    return found.join(near.withColumnRenamed("vec_id", "anchor_id"), "anchor_id").select(
        "anchor_id", F.get("ps", F.col("window"))["positive_id"].alias("positive_id"), "rank",
        F.col("other_id").alias("negative_id"), F.get("ps", F.col("window"))["positive_score"].alias("positive_score"),
        F.col("score").alias("negative_score"))
