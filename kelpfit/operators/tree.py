"""Decision and regression trees grown level by level.

A level costs two passes over the rows, whatever their number and that of the
nodes. The first counts every node's rows per category and per coarse value
range; the second looks at single values, but only inside ranges that can still
hold a better threshold than the best one already known. Tasks route rows through a
flat tree and count them in Arrow batches (``tree_batches``); counts are combined
before the shuffle, and no window holds more than one slice of a node's values.

Classes are rows, not columns: a split needs the two sides' sums of squared class
counts, and both follow from sums over the classes that occur (n for the left side, its
products with the node's own counts for the right one). So their number is not bounded.
Many classes, none of them large, are dealt to tasks whole: what a row adds to both sums
is known there, and only sums by range and value are shuffled. For up to four classes rows are
sorted by every number once, and ranges are so fine that few of them are looked into; a node
whose rows one task can hold is sent there, and all below it is grown in one job (``tree_subtrees``).

Regression sums are centred on the mean of the node they belong to, and candidates
of a node are ranked by their share of that node's own squares, so a split far up
that removes most of the variance does not blur the ones below.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from kelpfit.checks import require_columns, require_positive_int, usable_rows
from kelpfit.operators.aggregates import squared_residuals
from kelpfit.operators.tree_batches import (
    ClassSums, Counter, CountSums, FlatTree, SliceScorer, Wanted, order_statistics, packed, packed_by_class)
from kelpfit.operators.tree_subtrees import Subtrees
from kelpfit.session import held, written
from kelpfit.sources.reshape import feature_kinds

RANGES = 128
DIGITS = 10
#: Rows whose single values a task looks at together.
SLICE_ROWS = 100_000
#: More classes than this are dealt by class, if none has more than so many rows.
FEW_CLASSES = 64
WHOLE_ROWS = 1 << 20
#: Up to so many classes are counted in a column each; a bound costs two to that power of scores.
COLUMN_CLASSES = 4
#: Ranges of all nodes of a level, by feature, where rows are dealt by class; values from which their edges are taken.
CELLS = 1 << 17
EDGE_POINTS = 1 << 19
#: Rows by columns of a node that one task holds.
WHOLE_CELLS = 1 << 23


@dataclass(frozen=True)
class Node:
    """One node. ``path`` spells the way from the root in L and R steps.

    ``stats`` are rows and the sum of squared class counts, the counts of a few classes, or rows, sum and squares.
    """

    path: str
    n: int
    stats: tuple
    prediction: object
    impurity: float
    feature: str | None = None
    kind: str | None = None
    threshold: float | None = None
    value: str | None = None
    score: float | None = None
    stop: str | None = None
    # whether rows at the threshold itself go left
    inclusive: bool = True
    n_classes: int | None = None

    @property
    def depth(self) -> int:
        return len(self.path)


@dataclass(frozen=True)
class _Grower:
    """Settings shared by both trees.

    ``max_depth`` defaults to the number of features, since a used feature is not
    offered again below its split unless ``reuse_features`` is set. Thresholds are exact
    unless ``candidates`` is given: then a feature's values are dealt into so many
    (approximate) quantile ranges of the whole table, a node is split between two of
    them only, and a level takes one pass.
    """

    max_depth: int | None = None
    num_min_samples: int = 20
    positive: str = "Yes"
    negative: str = "No"
    stop_when_pure: bool = False
    reuse_features: bool = False
    ranges: int = RANGES
    candidates: int | None = None

    def __post_init__(self):
        if self.max_depth is not None:
            require_positive_int("max_depth", self.max_depth)
        elif self.reuse_features:
            raise ValueError("max_depth is needed when features may be used again")
        require_positive_int("num_min_samples", self.num_min_samples)
        require_positive_int("ranges", self.ranges)
        if self.candidates is not None:
            require_positive_int("candidates", self.candidates)
            object.__setattr__(self, "ranges", self.candidates)

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> "TreeModel":
        features = list(features)
        require_columns(df, [label])
        kinds = feature_kinds(df, features)
        rows = usable_rows(df.select(*features, label), [*features, label]).select(
            *[F.col(c).cast("double").alias(c) if kinds[c] == "continuous" else c for c in features],
            self._target(df, label).alias("_y"))
        with held(rows) as rows:
            measure, stats = self._measures(rows, "continuous" in kinds.values())
            if measure.whole and _fits(measure.rows(stats), features):
                kinds, _ = self._profile(rows, kinds, cut=False)
                job = _Fit(self, measure.coded(rows), features, kinds, {}, measure, stats)
                nodes = job.grow()
            elif measure.blocks is not None:
                kinds, _ = self._profile(rows, kinds, cut=False)
                with held(measure.blocks(rows, features, kinds)) as blocks:
                    count = blocks.count()
                    rows.unpersist()
                    cuts = _edges(blocks, count, features, kinds)
                    job = _Fit(self, blocks, features, kinds, cuts, measure, stats)
                    nodes = job.grow()
            else:
                kinds, cuts = self._profile(rows, kinds)
                job = _Fit(self, rows, features, kinds, cuts, measure, stats)
                nodes = job.grow()
        return TreeModel(tuple(features), label, nodes, kinds, self.positive, self.negative,
                         self._prediction_type(df, label), job.class_counts)

    def candidate_splits(self, df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
        """Every split of the whole table with its score, one row each.

        Columns: feature, threshold or value, score, own (the impurity or the squared
        residuals without a split), n_left and n_right.
        """
        features = list(features)
        require_columns(df, [label])
        kinds = feature_kinds(df, features)
        rows = usable_rows(df.select(*features, label), [*features, label]).select(
            *[F.col(c).cast("double").alias(c) if kinds[c] == "continuous" else c for c in features],
            self._target(df, label).alias("_y"))
        measure, stats = self._measures(rows, blocks=False)
        kinds, cuts = self._profile(rows, kinds)
        return _Fit(self, rows, features, kinds, cuts, measure, stats).candidates()

    def _profile(self, rows: DataFrame, kinds: dict[str, str], cut: bool = True):
        """Which strings only say positive or negative, and where numbers are cut into ranges."""
        pair = [self.positive, self.negative]
        shares = [i / self.ranges for i in range(1, self.ranges)] if cut else []
        aggs = [
            F.max((~F.col(c).isin(pair)).cast("int")).alias(c) if kind == "categorical"
            else F.percentile_approx(c, shares, 10_000).alias(c)
            for c, kind in kinds.items() if kind == "categorical" or shares
        ]
        found = rows.agg(*aggs).first().asDict() if aggs else {}
        binary = {c: "binary" for c, kind in kinds.items() if kind == "categorical" and found[c] == 0}
        cuts = {c: sorted(set(found.get(c) or [])) for c, kind in kinds.items() if kind == "continuous"}
        return {**kinds, **binary}, cuts


@dataclass(frozen=True)
class DecisionTree(_Grower):
    """Gini tree for any number of classes."""

    def _target(self, df, label):
        return F.col(label)

    def _prediction_type(self, df, label):
        return df.schema[label].dataType

    def _measures(self, rows: DataFrame, numbers: bool = True, blocks: bool = True):
        n, squares, classes, most = rows.groupBy("_y").count().agg(
            F.sum("count"), F.sum(F.col("count").cast("double") * F.col("count")), F.count("count"), F.max("count")).first()
        if not n:
            raise ValueError("there are no rows to grow a tree from")
        kind, blocks = rows.schema["_y"].dataType, blocks and self.candidates is None
        if blocks and numbers and classes <= COLUMN_CLASSES:
            counts = rows.groupBy("_y").count().orderBy("_y").collect()
            return CountedGini(kind, [r["_y"] for r in counts]), tuple(r["count"] for r in counts)
        summed = blocks and classes > FEW_CLASSES and most <= WHOLE_ROWS
        return (SummedGini if summed else GiniMeasure)(kind), (n, squares)


@dataclass(frozen=True)
class RegressionTree(_Grower):
    """Tree that lowers the sum of squared residuals about the side means."""

    num_min_samples: int = 2

    def _target(self, df, label):
        return F.col(label).cast("double")

    def _prediction_type(self, df, label):
        return T.DoubleType()

    def _measures(self, rows: DataFrame, numbers: bool = True, blocks: bool = True):
        r = rows.agg(F.count("_y"), F.avg("_y"), F.var_pop("_y")).first()
        if r[0] == 0:
            raise ValueError("there are no rows to grow a tree from")
        return SquaresMeasure(r[1]), (r[0], 0.0, r[2] * r[0])


def _fits(rows: int, features: Sequence[str]) -> bool:
    """Whether one task holds so many rows."""
    return rows * (len(features) + 1) <= WHOLE_CELLS


def _edges(blocks: DataFrame, count: int, features: Sequence[str], kinds: dict[str, str]) -> dict[str, list[float]]:
    """Edges of about equally filled ranges, from values that every block names."""
    numbers = [(f, c) for f, c in enumerate(features) if kinds[c] == "continuous"]
    points = max(64, EDGE_POINTS // max(1, count))
    named = blocks.mapInArrow(order_statistics(numbers, points), "f int, x double").distinct().toArrow()
    f, x = named.column("f").to_numpy(), named.column("x").to_numpy()
    return {c: np.unique(x[f == i]) for i, c in numbers}


def _share(squares: Column, n: Column) -> Column:
    return F.when(n > 0, squares / n).otherwise(0.0)


class GiniMeasure:
    """Rows, squared class counts, and products of class counts with those of the whole node.

    Thresholds are midpoints and belong to the left.
    """

    inclusive = True
    by_class = True
    gini = True
    #: how rows are packed for the passes, if they are
    blocks = None
    #: whether nodes that fit into a task are grown there
    whole = False
    names = ("n", "s", "t")

    def __init__(self, class_type: T.DataType):
        self.class_type = class_type

    def added(self, df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
        """Statistics by ``keys`` from counts by class, which come on top of ``before`` where it is there."""
        square = "n * n + 2 * before * n" if "before" in df.columns else "n * n"
        return df.withColumn("n", F.col("n").cast("double")).groupBy(*keys).agg(
            F.expr("cast(sum(n) as bigint)").alias("n"), F.expr(f"sum({square})").alias("s"),
            F.expr("sum(n * of_node)").alias("t"), *more)

    def rows(self, stats: Sequence):
        return stats[0]

    def right(self, left: Sequence[Column], total: Sequence[Column]) -> list[Column]:
        (n, s, t), (all_n, all_s, _) = left, total
        return [all_n - n, all_s - 2 * t + s, all_s - t]

    def score(self, left: Sequence[Column], right: Sequence[Column], total: Sequence[Column]) -> Column:
        return 1 - (_share(left[1], left[0]) + _share(right[1], right[0])) / total[0]

    def outside(self, left: Sequence[Column], right: Sequence[Column], total: Sequence[Column]) -> Column:
        """What two parts of a node alone add to the score."""
        return (left[0] - _share(left[1], left[0]) + right[0] - _share(right[1], right[0])) / total[0]

    def least(self, before: Sequence[Column], inside: Sequence[Column], total: Sequence[Column]) -> Column:
        """What no threshold inside a part of a node scores below.

        A row adds 1 at least to the sum of squares on the side it joins, and takes 1 at least
        from that of the side it leaves; so both sums are bounded after any number of its rows.
        """
        left = [b + i for b, i in zip(before, inside)]
        rest, rows = self.right(before, total), inside[0]
        ends = (F.lit(1.0), rows - 1.0)
        most = [F.greatest(*[sums(i) for i in ends]) for sums in (
            lambda i: (left[1] - rows + i) / F.greatest(before[0] + i, F.lit(1.0)),
            lambda i: (rest[1] - i) / F.greatest(rest[0] - i, F.lit(1.0)))]
        apart = self.outside(before, self.right(left, total), total)
        return F.greatest(apart, 1 - (most[0] + most[1]) / total[0])

    def own(self, total: Sequence[Column]) -> Column:
        return 1 - _share(total[1], total[0]) / total[0]

    def rank(self, score: Column, own: Column) -> Column:
        return F.round(score, DIGITS)

    def node(self, path: str, stats: tuple, parent: Node | None) -> Node:
        """A node whose most frequent class is found at the end."""
        n, squares = stats[:2]
        return Node(path, int(n), (int(n), squares), None, 1.0 - squares / n / n)

    def centre(self, node: Node) -> float:
        return 0.0


class SummedGini(GiniMeasure):
    """The same sums, which tasks that hold classes whole have taken over the classes."""

    by_class = False

    def blocks(self, rows: DataFrame, features: Sequence[str], kinds: dict[str, str]) -> DataFrame:
        """Blocks of rows that hold classes whole."""
        if isinstance(self.class_type, (T.DoubleType, T.FloatType)):
            rows = rows.withColumn("_y", F.col("_y") + F.lit(0).cast(self.class_type))  # one zero only
        return rows.repartition("_y").sortWithinPartitions("_y").mapInArrow(packed_by_class, "rows long, data binary")

    def added(self, df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in self.names], *more)


class CountedGini(SummedGini):
    """Counts of a few classes as they are."""

    whole = True

    def __init__(self, class_type: T.DataType, classes: Sequence):
        super().__init__(class_type)
        self.classes = list(classes)
        self.names = tuple(f"c{i}" for i in range(len(self.classes)))

    def coded(self, rows: DataFrame) -> DataFrame:
        """The rows with the number of their class."""
        code = F.lit(0)
        for i, c in enumerate(self.classes[1:], 1):
            code = F.when(F.col("_y") == F.lit(c).cast(self.class_type), i).otherwise(code)
        return rows.withColumn("_y", code.cast("int"))

    def blocks(self, rows: DataFrame, features: Sequence[str], kinds: dict[str, str]) -> DataFrame:
        """The rows once for every number, in its order, with the number of their class."""
        rows = self.coded(rows)
        # the other features spread a value that many rows share
        copies = [rows.sort(c, *[o for o in features if o != c]).mapInArrow(packed(f), "f int, rows long, data binary")
                  for f, c in enumerate(features) if kinds[c] == "continuous"]
        out = copies[0]
        for one in copies[1:]:
            out = out.unionByName(one)
        return out

    def rows(self, stats: Sequence):
        return sum(stats[1:], stats[0])

    def right(self, left: Sequence[Column], total: Sequence[Column]) -> list[Column]:
        return [t - x for t, x in zip(total, left)]

    def _part(self, counts: Sequence[Column]) -> Column:
        counts = [c.cast("double") for c in counts]
        return _share(self.rows([c * c for c in counts]), self.rows(counts))

    def score(self, left: Sequence[Column], right: Sequence[Column], total: Sequence[Column]) -> Column:
        return 1 - (self._part(left) + self._part(right)) / self.rows(total)

    def least(self, before: Sequence[Column], inside: Sequence[Column], total: Sequence[Column]) -> Column:
        """The score is concave in the counts of one side, so over a box it is least at a corner."""
        classes = len(self.classes)

        @F.pandas_udf("double")
        def lowest(*series: pd.Series) -> pd.Series:
            before, inside, total = np.stack([s.to_numpy(float) for s in series], axis=1).reshape(-1, 3, classes).transpose(1, 0, 2)
            size, out = total.sum(axis=1), np.full(len(total), np.inf)
            for corner in range(2 ** classes):
                left = before + inside * [corner >> k & 1 for k in range(classes)]
                shares = 0.0
                for side in (left, total - left):
                    n = side.sum(axis=1)
                    shares = shares + np.divide((side * side).sum(axis=1), n, out=np.zeros(len(n)), where=n > 0)
                out = np.minimum(out, 1 - shares / size)
            return pd.Series(out)

        return lowest(*[c.cast("double") for part in (before, inside, total) for c in part])

    def outside(self, left: Sequence[Column], right: Sequence[Column], total: Sequence[Column]) -> Column:
        n = self.rows(left) + self.rows(right)
        return (n - self._part(left) - self._part(right)) / self.rows(total)

    def own(self, total: Sequence[Column]) -> Column:
        return 1 - self._part(total) / self.rows(total)

    def node(self, path: str, stats: tuple, parent: Node | None) -> Node:
        counts = tuple(map(int, stats))
        n, most = sum(counts), max(counts)
        squares = float(sum(c * c for c in counts))
        return Node(path, n, counts, self.classes[counts.index(most)], 1.0 - squares / n / n,
                    n_classes=sum(c > 0 for c in counts))


class SquaresMeasure:
    """Count, sum and sum of squares of the target, centred on the node's mean.

    Thresholds are observed values and belong to the right.
    """

    inclusive = False
    by_class = False
    gini = False
    blocks = None
    whole = False
    class_type = None
    names = ("n", "s1", "s2")

    def __init__(self, mean: float):
        self.mean = mean

    def added(self, df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in self.names], *more)

    def rows(self, stats: Sequence):
        return stats[0]

    def right(self, left: Sequence[Column], total: Sequence[Column]) -> list[Column]:
        return [t - x for t, x in zip(total, left)]

    def score(self, left: Sequence[Column], right: Sequence[Column], total: Sequence[Column]) -> Column:
        return squared_residuals(*left) + squared_residuals(*right)

    outside = score

    def own(self, total: Sequence[Column]) -> Column:
        return squared_residuals(*total)

    def rank(self, score: Column, own: Column) -> Column:
        return F.when(own > 0, F.round(score / own, DIGITS)).otherwise(0.0)

    def node(self, path: str, stats: tuple, parent: Node | None) -> Node:
        """A node from sums about its parent's mean; its own squares are measured again later."""
        n, total, squares = stats
        mean = (parent.prediction if parent else self.mean) + total / n
        left = max(0.0, squares - total * total / n)
        return Node(path, int(n), (n, 0.0, left), mean, left)

    def centre(self, node: Node) -> float:
        return node.prediction


class _Fit:
    """One growing run: counts the rows of the frontier and asks for its best splits."""

    def __init__(self, settings, rows, features, kinds, cuts, measure, root_stats):
        self.settings, self.rows, self.features, self.kinds = settings, rows, features, kinds
        self.measure, self.class_counts = measure, None
        self.edges = {c: np.array(v, float) for c, v in cuts.items()}
        self.max_depth = settings.max_depth or len(features)
        self.nodes = {}
        self.nodes[""] = self._node("", root_stats)

    def _node(self, path: str, stats: tuple) -> Node:
        return self.measure.node(path, tuple(stats), self.nodes[path[:-1]] if path else None)

    def grow(self) -> list[Node]:
        frontier, small = [""], []
        while frontier:
            ready = [p for p in frontier if self._may_split(p)]
            if self.measure.whole:
                small += [p for p in ready if _fits(self.nodes[p].n, self.features)]
                ready = [p for p in ready if not _fits(self.nodes[p].n, self.features)]
            if not ready:
                break
            best = self._best_splits(ready)
            frontier = []
            for path in ready:
                frontier += self._split(path, best.get(path))
        if small:
            self._grow_subtrees(small)
        if isinstance(self.measure, CountedGini):
            self._name_classes()
        elif isinstance(self.measure, SummedGini):
            self._count_dealt_classes()
        elif self.measure.gini:
            self._count_classes()
        else:
            self._measure_leaves()
        return sorted(self.nodes.values(), key=lambda node: node.path)

    def _grow_subtrees(self, roots: list[str]) -> None:
        """All that lies below nodes whose rows one task holds, in one job."""
        s, open_ = self.settings, {p: self._open_features(p) for p in roots}
        grower = Subtrees(
            self.features, [self.kinds[c] for c in self.features],
            [(p, self.nodes[p].stats, [c in open_[p] for c in self.features]) for p in roots], self.max_depth,
            s.num_min_samples, s.stop_when_pure, s.reuse_features, s.positive, s.negative, DIGITS)
        if roots == [""]:
            rows = self.rows.withColumn("_node", F.lit(0))
        else:
            # every row is in the blocks once for each number
            number = [self.kinds[c] for c in self.features].index("continuous")
            kind = T.StructType([T.StructField("_node", T.IntegerType()), *[
                T.StructField(c, T.DoubleType() if self.kinds[c] == "continuous" else T.StringType()) for c in self.features],
                T.StructField("_y", T.IntegerType())])
            rows = self.rows.where(F.col("f") == number).mapInArrow(self._counter(roots).routed, kind)
        found = rows.groupBy("_node").applyInArrow(lambda table: grower(table), Subtrees.SCHEMA).collect()
        best, frontier = {r["path"]: r.asDict() for r in found}, roots
        while frontier:
            ready = [p for p in frontier if self._may_split(p)]
            frontier = [child for p in ready for child in self._split(p, best.get(p))]

    def candidates(self) -> DataFrame:
        """All splits of the root."""
        counter = self._counter([""])
        coarse = written(self._coarse(counter))
        totals = self._totals([""], coarse)
        found = self._without_values(coarse, totals, self.features)
        numbers = [c for c in self.features if self.kinds[c] == "continuous"]
        if numbers:
            starts, cuts = self._range_sums(coarse, totals)
            wanted = Wanted({self.features.index(c): [(0, range(len(self.edges[c]) + 1))] for c in numbers})
            found.append(self._between_ranges(cuts))
            if self.settings.candidates is None:
                found.append(self._between_values(
                    counter, wanted, self.nodes[""].n * len(numbers), starts, cuts, every=True))
        out = found[0]
        for one in found[1:]:
            out = out.unionByName(one)
        name = F.element_at(F.array(*[F.lit(c) for c in self.features]), F.col("best.f") + 1)
        return out.select(
            name.alias("feature"), "best.threshold", "best.value", "best.score", "best.own",
            F.col("best.left")[0].cast("long").alias("n_left"), F.col("best.right")[0].cast("long").alias("n_right"))

    def _may_split(self, path: str) -> bool:
        node = self.nodes[path]
        stop = None
        if node.depth >= self.max_depth:
            stop = "max depth"
        elif node.n < self.settings.num_min_samples:
            stop = "too few rows"
        elif self.settings.stop_when_pure and node.impurity <= 0:
            stop = "pure"
        self.nodes[path] = replace(node, stop=stop)
        return stop is None

    def _split(self, path: str, found) -> list[str]:
        node = self.nodes[path]
        if found is None or found["own_rank"] < found["rank"]:
            self.nodes[path] = replace(node, stop="no better split")
            return []
        name = self.features[found["f"]]
        self.nodes[path] = replace(
            node, feature=name, kind=self.kinds[name], threshold=found["threshold"],
            value=found["value"], score=found["score"], impurity=found["own"],
            inclusive=self.measure.inclusive)
        children = []
        for step, side in (("L", "left"), ("R", "right")):
            stats = tuple(found[side])
            if self.measure.rows(stats) > 0:
                self.nodes[path + step] = self._node(path + step, stats)
                children.append(path + step)
        return children

    def _open_features(self, path: str) -> list[str]:
        if self.settings.reuse_features:
            return self.features
        used = {self.nodes[path[:i]].feature for i in range(len(path))}
        return [c for c in self.features if c not in used]

    # ---- passes over the rows ---------------------------------------------------

    def _counter(self, wanted: list[str]) -> Counter:
        """Counts the rows whose walk ends in one of some nodes, numbered by their place in the list."""
        nodes = list(self.nodes.values())
        tree = FlatTree.of(nodes, self.features, self.kinds, self.settings.positive, self.settings.negative)
        number = {path: i for i, path in enumerate(wanted)}
        place = np.array([number.get(node.path, -1) for node in nodes], np.int32)
        offered = np.zeros((len(wanted), len(self.features)), bool)
        for i, path in enumerate(wanted):
            offered[i, [self.features.index(c) for c in self._open_features(path)]] = True
        if isinstance(self.measure, CountedGini):
            return CountSums(tree, place, offered, self._edges_met(wanted), len(self.measure.classes))
        if self.measure.blocks is not None:
            return ClassSums(tree, place, offered, self._edges_for(len(wanted)))
        centre = np.array([self.measure.centre(self.nodes[p]) for p in wanted], float)
        kind = to_arrow_type(self.measure.class_type) if self.measure.by_class else None
        return Counter(tree, place, centre, offered, self.edges, self.measure.by_class, kind)

    def _edges_for(self, nodes: int) -> dict[str, np.ndarray]:
        """Fewer edges where there are more nodes, and at least a few dozen rows between two."""
        most = max(self.settings.ranges, min(CELLS // nodes, self.nodes[""].n // 32))
        return {c: v[::-(-len(v) // most)] if len(v) else v for c, v in self.edges.items()}

    def _edges_met(self, wanted: list[str]) -> dict[str, np.ndarray]:
        """Edges so far apart that nodes meet about one range for some dozens of rows."""
        most, out = max(CELLS, self.nodes[""].n // 32), {}
        for c, edges in self.edges.items():
            met = 0
            for path in wanted:
                low, high = -np.inf, np.inf
                for k, step in enumerate(path):
                    above = self.nodes[path[:k]]
                    if above.feature == c:
                        low, high = (low, min(high, above.threshold)) if step == "L" else (max(low, above.threshold), high)
                met += 1 + np.searchsorted(edges, high) - np.searchsorted(edges, low)
            out[c] = edges[::max(1, -(-met // most), len(edges) >> 19)]
        return out

    def _counted(self, counter: Counter | ClassSums | CountSums, run) -> DataFrame:
        mine = f"cls {self.measure.class_type.simpleString()}, n long" if self.measure.by_class else ", ".join(
            f"{c} {'double' if c in ('s', 't', 's1', 's2') else 'long'}" for c in self.measure.names)
        return self.rows.mapInArrow(
            run, f"node int, f int, range int, category string, x double, {mine}, low double, high double")

    def _raw(self) -> list[str]:
        """Columns that add up."""
        return ["n"] if self.measure.by_class else list(self.measure.names)

    def _cls(self) -> list[str]:
        return ["cls"] if self.measure.by_class else []

    def _coarse(self, counter: Counter) -> DataFrame:
        """Counts by range or category; with the node's own count of the class, if there are classes."""
        rows = self._counted(counter, counter.coarse).groupBy("node", "f", "range", "category", *self._cls()).agg(
            *[F.sum(c).alias(c) for c in self._raw()], F.min("low").alias("low"), F.max("high").alias("high"))
        if not self.measure.by_class:
            return rows
        return rows.withColumn("of_node", F.expr("cast(max(if(f = -1, n, 0)) over (partition by node, cls) as double)"))

    def _totals(self, frontier: list[str], coarse: DataFrame) -> DataFrame:
        """Statistics of whole nodes: one row per frontier node."""
        if isinstance(self.measure, CountedGini):
            rows = [(i, *map(float, self.nodes[p].stats)) for i, p in enumerate(frontier)]
            return F.broadcast(coarse.sparkSession.createDataFrame(
                rows, "node int, " + ", ".join(f"t_{c} double" for c in self.measure.names)))
        if self.measure.gini:
            rows = [(i, float(n), s, s) for i, p in enumerate(frontier) for n, s in [self.nodes[p].stats]]
            return F.broadcast(coarse.sparkSession.createDataFrame(rows, "node int, t_n double, t_s double, t_t double"))
        rows = coarse.where("f = -1")
        return F.broadcast(rows.select("node", *[F.col(c).alias(f"t_{c}") for c in self.measure.names]))

    def _measure_leaves(self) -> None:
        """Squares of the leaves about their own means, in one pass."""
        leaves = [p for p, node in self.nodes.items() if node.feature is None]
        counter = replace(self._counter(leaves), offered=np.zeros((len(leaves), len(self.features)), bool))
        for r in self._coarse(counter).collect():
            squares = max(0.0, r["s2"] - r["s1"] * r["s1"] / r["n"])
            self.nodes[leaves[r["node"]]] = replace(self.nodes[leaves[r["node"]]], impurity=squares)

    def _count_classes(self) -> None:
        """Class counts of all nodes in one pass; the most frequent class is the answer, the first of equals."""
        paths = list(self.nodes)
        counter = replace(self._counter(paths), offered=np.zeros((len(paths), len(self.features)), bool))
        above = [(i, paths[i][:k]) for i in range(len(paths)) for k in range(len(paths[i]) + 1)]
        spark = self.rows.sparkSession
        above = spark.createDataFrame(above, "node int, path string")  # each node and those above it
        self.class_counts = written(self._coarse(counter).join(F.broadcast(above), "node").groupBy("path", "cls").agg(
            F.sum("n").alias("n")))
        found = self.class_counts.groupBy("path").agg(
            F.min(F.struct(-F.col("n"), F.col("cls"))).alias("m"), F.count("cls").alias("classes"))
        for r in found.select("path", "m.cls", "classes").collect():
            self.nodes[r["path"]] = replace(self.nodes[r["path"]], prediction=r["cls"], n_classes=r["classes"])

    def _name_classes(self) -> None:
        """The counts that nodes hold, as a table."""
        rows = [(p, c, n) for p, node in self.nodes.items() for c, n in zip(self.measure.classes, node.stats) if n]
        kind = T.StructType([T.StructField("path", T.StringType()), T.StructField("cls", self.measure.class_type),
                             T.StructField("n", T.LongType())])
        self.class_counts = self.rows.sparkSession.createDataFrame(rows, kind)

    def _count_dealt_classes(self) -> None:
        """The same where tasks hold classes whole: only answers are shuffled, and counts are kept by leaf."""
        paths = list(self.nodes)
        counter, kind = self._counter(paths), to_arrow_type(self.measure.class_type)
        number = {path: i for i, path in enumerate(paths)}
        above = np.full((len(paths), max(map(len, paths)) + 1), -1, np.int32)
        for i, path in enumerate(paths):
            above[i, :len(path) + 1] = [number[path[:k]] for k in range(len(path) + 1)]
        cls = f"cls {self.measure.class_type.simpleString()}"
        found = self.rows.mapInArrow(counter.answers(above, kind), f"node int, classes long, n long, {cls}").groupBy("node").agg(
            F.sum("classes").alias("classes"), F.min(F.struct(-F.col("n"), F.col("cls"))).alias("m"))
        for r in found.select("node", "classes", "m.cls").collect():
            path = paths[r["node"]]
            self.nodes[path] = replace(self.nodes[path], prediction=r["cls"], n_classes=r["classes"])
        leaves = written(self.rows.mapInArrow(counter.leaves(kind), f"node int, {cls}, n long"))
        ways = [(i, paths[i][:k]) for i in range(len(paths)) for k in range(len(paths[i]) + 1)]
        ways = self.rows.sparkSession.createDataFrame(ways, "node int, path string")
        self.class_counts = leaves.join(F.broadcast(ways), "node").groupBy("path", "cls").agg(F.sum("n").alias("n"))

    # ---- statistics of one level ------------------------------------------------

    def _stats(self, prefix: str = "") -> list[Column]:
        return [F.col(prefix + n) for n in self.measure.names]

    def _candidates(self, df: DataFrame, left: list[Column], threshold: Column, value: Column,
                    right: list[Column] | None = None) -> DataFrame:
        total = self._stats("t_")
        right = right or self.measure.right(left, total)
        score, own = self.measure.score(left, right, total), self.measure.own(total)
        numbers = lambda side: F.array(*[c.cast("double") for c in side])
        # ties are judged on rounded scores, as sums in another order differ in the last digits
        return df.select(
            "node",
            F.struct(self.measure.rank(score, own).alias("rank"), F.col("f"),
                     threshold.cast("double").alias("threshold"), value.cast("string").alias("value"),
                     score.alias("score"), numbers(left).alias("left"), numbers(right).alias("right"),
                     own.alias("own"), self.measure.rank(own, own).alias("own_rank")).alias("best"))

    def _best_splits(self, frontier: list[str]) -> dict:
        offered = [c for c in self.features if any(c in self._open_features(p) for p in frontier)]
        if not offered:
            return {}
        counter = self._counter(frontier)
        coarse, cuts = self._coarse(counter).persist(StorageLevel.MEMORY_AND_DISK), None
        try:
            totals = self._totals(frontier, coarse)
            known = self._without_values(coarse, totals, offered)
            numbers = any(self.kinds[c] == "continuous" for c in offered)
            if numbers:
                starts, cuts = self._range_sums(coarse, totals)
                cuts = cuts.persist(StorageLevel.MEMORY_AND_DISK)
                known.append(self._between_ranges(cuts))
            best = _lowest(known)
            if numbers and self.settings.candidates is None:
                best = _merge(best, self._inside_ranges(frontier, counter, starts, cuts, best))
            return {frontier[i]: row for i, row in best.items()}
        finally:
            coarse.unpersist()
            if cuts is not None:
                cuts.unpersist()

    def _without_values(self, coarse, totals, offered) -> list[DataFrame]:
        """Candidates of the features that are not numbers."""
        of_kind = lambda kind: [self.features.index(c) for c in offered if self.kinds[c] == kind]
        out = []
        for kind, build in (("categorical", self._one_against_rest), ("binary", self._positive_against_negative)):
            if of_kind(kind):
                rows = self.measure.added(coarse.where(F.col("f").isin(of_kind(kind))), ["node", "f", "category"])
                out.append(build(rows.join(totals, "node")))
        return out

    def _one_against_rest(self, df: DataFrame) -> DataFrame:
        rest = df.where(self.measure.rows(self._stats("t_")) > self.measure.rows(self._stats()))
        return self._candidates(rest, self._stats(), F.lit(None), F.col("category"))

    def _positive_against_negative(self, df: DataFrame) -> DataFrame:
        s = self.settings
        sides = df.groupBy("node", "f").agg(*[
            F.coalesce(F.sum(F.when(F.col("category") == v, F.col(n))), F.lit(0)).alias(f"{side}_{n}")
            for side, v in (("l", s.positive), ("r", s.negative)) for n in self.measure.names
        ], *[F.first(f"t_{n}").alias(f"t_{n}") for n in self.measure.names])
        return self._candidates(sides, self._stats("l_"), F.lit(None), F.lit(s.positive), self._stats("r_"))

    def _range_sums(self, coarse, totals) -> tuple[DataFrame, DataFrame]:
        """Class counts before each range, and statistics of what lies before it."""
        rows = coarse.where(F.col("low").isNotNull())
        if self.measure.by_class:
            rows = rows.withColumn("before", F.expr(
                "cast(coalesce(sum(n) over (partition by node, f, cls order by range "
                "rows between unbounded preceding and 1 preceding), 0) as double)"))
        sums = self.measure.added(rows, ["node", "f", "range"], F.min("low").alias("low"), F.max("high").alias("high"))
        w = "(partition by node, f order by range"
        before = w + " rows between unbounded preceding and 1 preceding)"
        return rows, sums.select("*", *[F.expr(f"coalesce(sum({n}) over {before}, 0)").alias(f"b_{n}") for n in self.measure.names],
                                 F.expr(f"lead(low) over {w})").alias("next_low")).join(totals, "node")

    def _between_ranges(self, cuts: DataFrame) -> DataFrame:
        left = [b + s for b, s in zip(self._stats("b_"), self._stats())]
        return self._candidates(
            cuts.where(F.col("next_low").isNotNull()), left, self._cut(F.col("high"), F.col("next_low")), F.lit(None))

    def _cut(self, low: Column, high: Column) -> Column:
        """Midpoint for class trees; regression trees cut at the upper value."""
        return (low + high) / 2 if self.measure.inclusive else high

    def _inside_ranges(self, frontier, counter, starts, cuts: DataFrame, best: dict) -> dict:
        """Thresholds between values of one range, where they may beat the known best.

        Splitting a range's rows off entirely can only lower the score, so the
        rows before and after the range give a bound for every threshold in it.
        """
        before, total = self._stats("b_"), self._stats("t_")
        after = self.measure.right([b + s for b, s in zip(before, self._stats())], total)
        limits = [(i, float(row["score"]), float(row["rank"]), row["f"], row["threshold"]) for i, row in best.items()]
        limit = cuts.sparkSession.createDataFrame(
            limits, "node int, limit double, limit_rank double, limit_f int, limit_threshold double")
        # scores closer than this are ties
        room = 10.0 ** -DIGITS * F.greatest(self.measure.own(total), F.lit(1e-300))
        if self.measure.gini:
            # of equal ranks the earlier feature and then the lower threshold wins; sums are whole numbers,
            # so a score is off by no more than a few last digits
            bound = self.measure.least(before, self._stats(), total) - 1e-14
            half = 10.0 ** -DIGITS / 2
            tied = (F.col("f") < F.col("limit_f")) | (
                (F.col("f") == F.col("limit_f")) & (F.col("low") < F.col("limit_threshold")))
            may = F.col("limit").isNull() | (bound <= F.col("limit_rank") + F.when(tied, half).otherwise(-half) + 1e-14)
        else:
            may = self.measure.outside(before, after, total) <= F.coalesce("limit", F.lit(float("inf"))) + room
        open_ = cuts.join(F.broadcast(limit), "node", "left").where((F.col("low") < F.col("high")) & may)
        # one row per node and feature, with at most as many numbers as there are ranges
        wanted, rows, size = {}, 0, self.measure.rows(self._stats())
        for r in open_.groupBy("node", "f").agg(F.collect_list("range").alias("ranges"), F.sum(size).alias("n")).collect():
            wanted.setdefault(r["f"], []).append((r["node"], r["ranges"]))
            rows += r["n"]
        if not rows:
            return {}
        return _lowest([self._between_values(counter, Wanted(wanted), int(rows), starts, cuts)])

    def _between_values(self, counter, wanted: Wanted, rows: int, starts: DataFrame, cuts: DataFrame,
                        every: bool = False) -> DataFrame:
        """Candidates between neighbouring values of one range, for the wanted ranges and their number of rows.

        Without ``every`` only those that may be a node's best one.
        """
        keys, names, by_class = ["node", "f", "range"], self.measure.names, self.measure.by_class
        values = self._counted(counter, counter.values(wanted)).groupBy(*keys, "x", *self._cls()).agg(
            *[F.sum(c).alias(c) for c in self._raw()])
        begun = cuts.select(*keys, *[F.col(f"b_{n}").cast("double").alias(f"b{i}") for i, n in enumerate(names)],
                            *[F.col(f"t_{n}").cast("double").alias(f"t{i}") for i, n in enumerate(names)])
        slices = max(1, -(-rows // SLICE_ROWS))
        if slices == 1:  # ranges are whole, and what lies before them is known
            values, side = values.withColumn("part", F.lit(0)), begun.selectExpr("*", "0 as part", "cast(null as double) as next")
            classes = starts.select(*keys, "cls", "before", "of_node") if by_class else None
        else:
            values, side, classes = self._sliced(values, slices, starts, begun)
        if by_class:
            side = classes.join(side, [c for c in classes.columns if c in side.columns])
        # columns of its own: it descends from the values it meets again
        side = side.select(*[F.col(c).alias(c) for c in side.columns])
        score = SliceScorer(by_class, self.measure.inclusive, 2 * 10.0 ** -DIGITS, every, self.measure.gini, names)
        found = values.groupBy("part").cogroup(side.groupBy("part")).applyInArrow(
            lambda left, right: score(left, right), SliceScorer.SCHEMA)
        return found.select("node", F.struct(
            self.measure.rank(F.col("score"), F.col("own")).alias("rank"), "f", "threshold",
            F.lit(None).cast("string").alias("value"), "score", "left", "right", "own",
            self.measure.rank(F.col("own"), F.col("own")).alias("own_rank")).alias("best"))

    def _sliced(self, values: DataFrame, slices: int, starts: DataFrame, begun: DataFrame):
        """Values in slices of about equal size, what lies before each slice, and by class."""
        keys, cls = ["node", "f", "range"], self._cls()
        # numbers of slices must not change between reads, so they are written down
        values = written(values.repartitionByRange(slices, *keys, "x").withColumn("part", F.spark_partition_id()))
        parts = values.groupBy(*keys, "part", *cls).agg(
            *[F.sum(c).alias(c) for c in self._raw()], F.min("x").alias("_first"))
        classes = None
        if self.measure.by_class:
            w = Window.partitionBy(*keys, "cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
            parts = parts.withColumn("_so_far", F.coalesce(F.sum("n").over(w), F.lit(0))).join(
                starts.select(*keys, "cls", F.col("before").alias("_start"), "of_node"), [*keys, "cls"]).withColumn(
                "before", F.col("_so_far") + F.col("_start"))
            classes = parts.select(*keys, "part", "cls", "before", "of_node")
        w = Window.partitionBy(*keys).orderBy("part")
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        side = self.measure.added(parts, [*keys, "part"], F.min("_first").alias("_first")).select(
            *keys, "part", F.lead("_first").over(w).alias("next"),
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_o{i}") for i, n in enumerate(self.measure.names)])
        side = side.join(begun, keys).select(
            *keys, "part", "next", *[(F.col(f"_o{i}") + F.col(f"b{i}")).alias(f"b{i}") for i in range(len(self.measure.names))],
            *[f"t{i}" for i in range(len(self.measure.names))])
        return values, side, classes


def _lowest(tables: list[DataFrame]) -> dict[int, dict]:
    """Best candidate per node: lowest rounded score, then earlier feature, threshold, value."""
    if not tables:
        return {}
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    rows = union.groupBy("node").agg(F.min("best").alias("best")).collect()
    return {r["node"]: r["best"].asDict() for r in rows}


def _merge(a: dict[int, dict], b: dict[int, dict]) -> dict[int, dict]:
    def rank(row):
        threshold = row["threshold"]
        return (row["rank"], row["f"], float("-inf") if threshold is None else threshold)

    out = dict(a)
    for node, row in b.items():
        if node not in out or rank(row) < rank(out[node]):
            out[node] = row
    return out


@dataclass(frozen=True)
class TreeModel:
    """A grown tree: a small node list that rows walk in Arrow batches."""

    features: tuple[str, ...]
    label: str
    nodes: list[Node] = field(repr=False)
    kinds: dict[str, str] = field(default_factory=dict)
    positive: str = "Yes"
    negative: str = "No"
    prediction_type: object = None
    #: path, cls and n of class trees, as a table: there may be many classes
    class_counts: DataFrame | None = field(default=None, repr=False)

    def _answer(self, answers: list, kind: T.DataType) -> Column:
        tree = FlatTree.of(self.nodes, self.features, self.kinds, self.positive, self.negative)
        used = [c for c in self.features if c in {n.feature for n in self.nodes}] or list(self.features[:1])
        # text made of numbers and Booleans compares as text, as the node table shows it
        columns = [F.col(c).cast("double" if self.kinds[c] == "continuous" else "string") for c in used]
        table = np.empty(len(answers), object)
        table[:] = answers

        @F.pandas_udf(kind)
        def walk(*series: pd.Series) -> pd.Series:
            arrays = {c: pa.array(one, pa.float64() if tree.kinds[tree.features.index(c)] == "continuous" else pa.string(),
                                  from_pandas=True) for c, one in zip(used, series)}
            return pd.Series(table[tree.walk(arrays, len(series[0]))])

        return walk(*columns)

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Predict every row; a missing child or unknown value keeps the node's own answer."""
        require_columns(df, self.features)
        return df.withColumn(name, self._answer([n.prediction for n in self.nodes], self.prediction_type))

    predict = transform

    def node_paths(self, df: DataFrame, name: str = "path") -> DataFrame:
        """Path of the last node each row reaches."""
        return df.withColumn(name, self._answer([n.path for n in self.nodes], T.StringType()))

    def node_table(self, spark: SparkSession) -> DataFrame:
        """All nodes, one row each; ordering by ``path`` is preorder."""
        parents = {n.path[:-1] for n in self.nodes if n.path}
        rows = [
            (
                n.path, n.depth, n.feature, n.kind, n.threshold, n.value, n.score, n.impurity, n.n,
                str(n.prediction), n.path not in parents, n.stop, n.n_classes,
            )
            for n in self.nodes
        ]
        table = spark.createDataFrame(
            rows,
            "path string, depth int, feature string, kind string, threshold double, value string, "
            "score double, impurity double, n long, prediction string, is_leaf boolean, stop string, n_classes long",
        )
        counts = F.create_map().cast("map<string,bigint>")
        if self.class_counts is not None:
            by_node = self.class_counts.groupBy("path").agg(F.map_from_entries(F.sort_array(F.collect_list(
                F.struct(F.col("cls").cast("string"), "n")))).alias("class_counts"))
            table, counts = table.join(by_node, "path", "left"), F.col("class_counts")
        return table.select(
            "path", "depth", "feature", "kind", "threshold", "value", "score", "impurity", "n",
            counts.alias("class_counts"), "prediction", "is_leaf", "stop", "n_classes").orderBy("path")
