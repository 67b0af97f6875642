"""What trees do with Arrow batches: walk rows down a flat tree, and count them by node.

A flat tree holds its nodes as parallel arrays, so a row is routed by a few array
look-ups per level, whatever the number of nodes. Counts of a stretch of rows leave a
task as one row per node, feature, range or value, and class that occurs in it; Spark
adds them up.

Where there are many classes, none of them large, rows are dealt by class and packed into
blocks (:func:`packed_by_class`). A block knows the place of a row among those of its node and
class, so what the row adds to sums over classes is known there, and no row by class
leaves a task (:class:`ClassSums`).

Where there are few classes, rows are sorted once by every number and packed (:func:`packed`),
so that a block meets few ranges, and counts by class are columns (:class:`CountSums`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows counted together before they are handed on.
STRETCH = 1 << 17
#: Rows of a block, about, and ranges of nodes that a task adds up before it hands them on.
BLOCK = 1 << 17
#: Rows of a batch that tasks hand on as they are.
ROUTED = 10_000
DENSE = 1 << 20


@dataclass
class FlatTree:
    """Nodes as arrays; -1 stands for no feature, no child and no value."""

    features: list[str]
    kinds: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    words: list[list[str]]
    inclusive: bool

    @classmethod
    def of(cls, nodes: Sequence, features: Sequence[str], kinds: dict[str, str], positive: str, negative: str) -> FlatTree:
        """From nodes with ``path``, ``feature``, ``threshold`` and ``value``; their order numbers them."""
        features = list(features)
        at = {node.path: i for i, node in enumerate(nodes)}
        words = [[positive, negative] if kinds.get(c) == "binary" else [] for c in features]
        number = [{w: i for i, w in enumerate(one)} for one in words]
        feature, value = np.full(len(nodes), -1, np.int32), np.full(len(nodes), -1, np.int32)
        threshold, left, right = np.full(len(nodes), np.nan), feature.copy(), feature.copy()
        for i, node in enumerate(nodes):
            if node.feature is None:
                continue
            f = feature[i] = features.index(node.feature)
            left[i], right[i] = at.get(node.path + "L", -1), at.get(node.path + "R", -1)
            if node.kind == "continuous":
                threshold[i] = node.threshold
            else:
                value[i] = number[f].setdefault(node.value, len(number[f]))
        words = [sorted(one, key=one.get) for one in number]
        inclusive = all(node.inclusive for node in nodes)
        return cls(features, [kinds.get(c, "") for c in features], feature, threshold, value, left, right, words, inclusive)

    def walk(self, columns: dict[str, pa.Array], rows: int) -> np.ndarray:
        """Number of the last node each row reaches."""
        node = np.zeros(rows, np.int32)
        used = {int(f) for f in np.unique(self.feature) if f >= 0}
        known = {f: self._readable(f, columns[self.features[f]]) for f in used}
        moving = np.arange(rows)
        while len(moving):
            at = node[moving]
            wanted = self.feature[at]
            step = np.full(len(moving), -1, np.int32)
            for f in used:
                here = np.flatnonzero(wanted == f)
                if not len(here):
                    continue
                x, mine = known[f][moving[here]], at[here]
                if self.kinds[f] == "continuous":
                    with np.errstate(invalid="ignore"):
                        low = x <= self.threshold[mine] if self.inclusive else x < self.threshold[mine]
                    side = np.where(np.isnan(x), -1, np.where(low, self.left[mine], self.right[mine]))
                elif self.kinds[f] == "binary":
                    side = np.where(x == 0, self.left[mine], np.where(x == 1, self.right[mine], -1))
                else:
                    side = np.where(x == -2, -1, np.where(x == self.value[mine], self.left[mine], self.right[mine]))
                step[here] = side
            on = step >= 0
            moving = moving[on]
            node[moving] = step[on]
        return node

    def _readable(self, f: int, column: pa.Array) -> np.ndarray:
        """Numbers with NaN for missing ones, or places in the word list: -1 for others, -2 for missing ones."""
        if self.kinds[f] == "continuous":
            return np.asarray(column.cast(pa.float64()).to_numpy(zero_copy_only=False), float)
        found = pc.index_in(column, value_set=pa.array(self.words[f], column.type))
        codes = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        return np.where(column.is_null().to_numpy(zero_copy_only=False), -2, codes)


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Array]]:
    """Batches put together until they are worth counting."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= STRETCH:
            yield _columns(held)
            held, rows = [], 0
    if rows:
        yield _columns(held)


def _columns(held: list[pa.RecordBatch]) -> dict[str, pa.Array]:
    table = pa.Table.from_batches(held).combine_chunks()
    return {n: table.column(n).combine_chunks() if table.column(n).num_chunks != 1 else table.column(n).chunk(0)
            for n in table.column_names}


def _encoded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes and the distinct values they stand for."""
    found = column.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _grouped(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal keys together, and where each group starts."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    return order, np.flatnonzero(new)


class Wanted:
    """Places of open nodes and ranges by feature."""

    def __init__(self, asked: dict[int, list[tuple[int, Sequence[int]]]]):
        self.keys = {f: np.sort(np.concatenate([(at << 32) + np.asarray(ranges, np.int64) for at, ranges in one]))
                     for f, one in asked.items()}

    def has(self, f: int, at: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        if f not in self.keys:
            return np.zeros(len(at), bool)
        known, mine = self.keys[f], (at.astype(np.int64) << 32) + ranges
        return known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine


@dataclass
class Counter:
    """Counts the rows of open nodes by feature and range, category or value."""

    tree: FlatTree
    #: place of a node among the open ones, or -1; the target's centre and the open features by that place
    place: np.ndarray
    centre: np.ndarray
    offered: np.ndarray
    #: edges of value ranges by feature
    edges: dict[str, np.ndarray]
    by_class: bool
    class_type: pa.DataType | None

    def schema(self) -> list[tuple[str, pa.DataType]]:
        mine = [("cls", self.class_type), ("n", pa.int64())] if self.by_class else [
            ("n", pa.int64()), ("s1", pa.float64()), ("s2", pa.float64())]
        return [("node", pa.int32()), ("f", pa.int32()), ("range", pa.int32()), ("category", pa.string()),
                ("x", pa.float64()), *mine, ("low", pa.float64()), ("high", pa.float64())]

    def coarse(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By range or category; feature -1 stands for all rows of a node."""
        for columns in stretches(batches):
            at, rows, y = self._open(columns)
            if not len(rows):
                continue
            yield self._counted(at, -1, y, {})
            for f, name in enumerate(self.tree.features):
                on = self.offered[at, f]
                if not on.any():
                    continue
                kept, some, ys = at[on], rows[on], y.take(on)
                if self.tree.kinds[f] == "continuous":
                    x = columns[name].to_numpy(zero_copy_only=False)[some]
                    yield self._counted(kept, f, ys, {"range": self._range(name, x)}, x)
                else:
                    codes, words = _encoded(columns[name].take(pa.array(some)))
                    yield self._counted(kept, f, ys, {"category": (codes, words)})

    def values(self, wanted: Wanted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """By single value, in the ranges that ``wanted`` asks for."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for columns in stretches(batches):
                at, rows, y = self._open(columns)
                for f, name in enumerate(self.tree.features):
                    if self.tree.kinds[f] != "continuous" or not len(rows):
                        continue
                    x = columns[name].to_numpy(zero_copy_only=False)[rows]
                    ranges = self._range(name, x)
                    on = wanted.has(f, at, ranges)
                    if on.any():
                        yield self._counted(at[on], f, y.take(on), {"range": ranges[on], "x": x[on] + 0.0})
        return run

    def _range(self, name: str, x: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges[name], x, side="right").astype(np.int32)

    def _open(self, columns: dict[str, pa.Array]):
        rows = len(columns["_y"])
        node = self.tree.walk(columns, rows)
        at = self.place[node]
        rows = np.flatnonzero(at >= 0)
        at = at[rows]
        y = columns["_y"].take(pa.array(rows))
        if self.by_class:
            codes, classes = _encoded(y)
            return at, rows, _Classes(codes, classes)
        return at, rows, _Values(y.to_numpy(zero_copy_only=False) - self.centre[at])

    def _counted(self, at: np.ndarray, f: int, y, by: dict, x: np.ndarray | None = None) -> pa.RecordBatch:
        keys = [at] + [v[0] if isinstance(v, tuple) else v for v in by.values()] + y.keys()
        order, starts = _grouped(keys)
        first = order[starts]
        groups = len(starts)
        filled = {"node": at[first].astype(np.int32), "f": np.full(groups, f, np.int32)}
        for name, v in by.items():
            filled[name] = v[1].take(pa.array(v[0][first])).cast(pa.string()) if isinstance(v, tuple) else v[first]
        filled |= y.sums(order, starts, first)
        if x is not None:
            ordered = x[order]
            filled["low"] = np.minimum.reduceat(ordered, starts)
            filled["high"] = np.maximum.reduceat(ordered, starts)
        schema = self.schema()
        return pa.record_batch([
            v if isinstance(v := filled.get(n), pa.Array) else pa.nulls(groups, t) if v is None else pa.array(v, t)
            for n, t in schema], names=[n for n, _ in schema])


@dataclass
class _Classes:
    """Class labels of some rows, as codes."""

    codes: np.ndarray
    classes: pa.Array

    def take(self, on: np.ndarray) -> _Classes:
        return _Classes(self.codes[on], self.classes)

    def keys(self) -> list[np.ndarray]:
        return [self.codes]

    def sums(self, order, starts, first) -> dict:
        return {"cls": self.classes.take(pa.array(self.codes[first])), "n": np.diff(np.append(starts, len(order)))}


@dataclass
class _Values:
    """Centred targets of some rows."""

    y: np.ndarray

    def take(self, on: np.ndarray) -> _Values:
        return _Values(self.y[on])

    def keys(self) -> list[np.ndarray]:
        return []

    def sums(self, order, starts, first) -> dict:
        y = self.y[order]
        return {"n": np.diff(np.append(starts, len(order))), "s1": np.add.reduceat(y, starts),
                "s2": np.add.reduceat(y * y, starts)}


@dataclass
class CountSums:
    """Counts of a few classes, one column each, from blocks sorted by a feature."""

    tree: FlatTree
    place: np.ndarray
    offered: np.ndarray
    edges: dict[str, np.ndarray]
    classes: int

    def coarse(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By range in the blocks sorted by the feature, by category in those of the first number."""
        numbers = [f for f, kind in enumerate(self.tree.kinds) if kind == "continuous"]
        for sorted_by, columns in _by_feature(batches):
            at, rows, cls = self._open(columns)
            for f, name in enumerate(self.tree.features):
                number = f in numbers
                if f != sorted_by and (number or sorted_by != numbers[0]):
                    continue
                on = np.flatnonzero(self.offered[at, f])
                if not len(on):
                    continue
                if number:
                    x = columns[name].to_numpy(zero_copy_only=False)[rows[on]]
                    ranges = np.searchsorted(self.edges[name], x, side="right")
                    order, starts = _grouped([at[on], ranges])
                    first, ordered = order[starts], x[order]
                    by = {"range": ranges[first], "low": np.minimum.reduceat(ordered, starts),
                          "high": np.maximum.reduceat(ordered, starts)}
                else:
                    codes, words = _encoded(columns[name].take(pa.array(rows[on])))
                    order, starts = _grouped([at[on], codes])
                    first = order[starts]
                    by = {"category": words.take(pa.array(codes[first])).cast(pa.string())}
                yield self._batch(at[on], f, cls[on], order, starts, by)

    def values(self, wanted: Wanted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """By single value, in the ranges that ``wanted`` asks for."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for f, columns in _by_feature(batches):
                if f not in wanted.keys:
                    continue
                at, rows, cls = self._open(columns)
                name = self.tree.features[f]
                x = columns[name].to_numpy(zero_copy_only=False)[rows]
                ranges = np.searchsorted(self.edges[name], x, side="right")
                on = np.flatnonzero(wanted.has(f, at, ranges))
                if not len(on):
                    continue
                at, ranges, x = at[on], ranges[on], x[on] + 0.0
                order, starts = _grouped([at, ranges, x])
                first = order[starts]
                yield self._batch(at, f, cls[on], order, starts, {"range": ranges[first], "x": x[first]})
        return run

    def routed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of open nodes with the place of their node."""
        for columns in unpacked(batches):
            at = self.place[self.tree.walk(columns, len(columns["_y"]))]
            rows = np.flatnonzero(at >= 0)
            on = pa.array(rows)
            for i in range(0, len(rows), ROUTED):
                some = on.slice(i, ROUTED)
                yield pa.record_batch(
                    [pa.array(at[rows[i:i + ROUTED]], pa.int32()), *[columns[c].take(some) for c in self.tree.features],
                     columns["_y"].take(some)], names=["_node", *self.tree.features, "_y"])

    def _open(self, columns: dict[str, pa.Array]):
        cls = columns["_y"].to_numpy(zero_copy_only=False)
        at = self.place[self.tree.walk(columns, len(cls))]
        rows = np.flatnonzero(at >= 0)
        return at[rows], rows, cls[rows]

    def _batch(self, at, f: int, cls, order, starts, by: dict) -> pa.RecordBatch:
        groups = len(starts)
        group = np.repeat(np.arange(groups), np.diff(np.append(starts, len(order))))
        counts = np.bincount(group * self.classes + cls[order], minlength=groups * self.classes).reshape(groups, -1)
        filled = {"node": at[order[starts]], "f": np.full(groups, f)} | {f"c{i}": counts[:, i] for i in range(self.classes)} | by
        schema = [("node", pa.int32()), ("f", pa.int32()), ("range", pa.int32()), ("category", pa.string()), ("x", pa.float64()),
                  *[(f"c{i}", pa.int64()) for i in range(self.classes)], ("low", pa.float64()), ("high", pa.float64())]
        return pa.record_batch([
            v if isinstance(v := filled.get(n), pa.Array) else pa.nulls(groups, t) if v is None else pa.array(v.astype(t.to_pandas_dtype()), t)
            for n, t in schema], names=[n for n, _ in schema])


@dataclass
class SliceScorer:
    """Scores the thresholds between neighbouring values of one slice.

    Values of a slice come with what lies before them in their node, feature and range: in
    the first table rows by value (and class), in the second one the sums at the start
    of the slice, those of the node, the first value after the slice and, by class, the
    counts before the slice and in the node.
    """

    by_class: bool
    inclusive: bool
    #: scores so close may be ties and are all handed on, unless every threshold is wanted
    tie: float
    every: bool = False
    #: whether sums are those of a Gini tree, and their names
    gini: bool = False
    names: tuple[str, ...] = ("n", "s1", "s2")

    SCHEMA = ("node int, f int, threshold double, score double, own double, left array<double>, right array<double>")

    def __call__(self, values: pa.Table, side: pa.Table) -> pa.Table:
        read = lambda table, name: table.column(name).to_numpy()
        place = lambda table: (read(table, "node").astype(np.int64) << 40) + (
            read(table, "f").astype(np.int64) << 20) + read(table, "range")
        if not len(values):
            return pa.table({n: pa.nulls(0, t) for n, t in zip(
                ("node", "f", "threshold", "score", "own", "left", "right"),
                (pa.int32(), pa.int32(), *[pa.float64()] * 3, *[pa.list_(pa.float64())] * 2))})
        known, first = np.unique(place(side), return_index=True)
        group, x = np.searchsorted(known, place(values)), read(values, "x")
        if self.by_class:
            n = read(values, "n").astype(float)
            before, of_node, key = self._class_counts(values, side, known, group)
            order = np.lexsort((x, key))
            earlier = _before_in_groups(n[order], key[order])
            before[order] += earlier
            stats = np.stack([n, n * n + 2 * before * n, n * of_node], axis=1)
        else:
            stats = np.stack([read(values, c).astype(float) for c in self.names], axis=1)
        order, starts = _grouped([group, x])
        stats, group, x = np.add.reduceat(stats[order], starts, axis=0), group[order[starts]], x[order[starts]]
        begun = np.stack([read(side, f"b{i}") for i in range(len(self.names))], axis=1)[first].astype(float)
        total = np.stack([read(side, f"t{i}") for i in range(len(self.names))], axis=1)[first].astype(float)[group]
        after = np.append(x[1:], np.nan)
        edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        for low, high in zip(edges[:-1], edges[1:]):
            stats[low:high] = np.cumsum(stats[low:high], axis=0) + begun[group[low]]
            after[high - 1] = np.asarray(side.column("next").to_numpy(), float)[first[group[low]]]
        fits = ~np.isnan(after)
        left, total, group, x, after = stats[fits], total[fits], group[fits], x[fits], after[fits]
        score, own, right = self._scored(left, total)
        node, f = (known[group] >> 40).astype(np.int32), ((known[group] >> 20) & 0xFFFFF).astype(np.int32)
        threshold = (x + after) / 2 if self.inclusive else after
        if not self.every:
            keep = self._nearly_best(node, f, threshold, score, own)
            node, f, threshold, score, own, left, right = [
                v[keep] for v in (node, f, threshold, score, own, left, right)]
        numbers = pa.list_(pa.float64())
        return pa.table({"node": node, "f": f, "threshold": threshold, "score": score, "own": own,
                         "left": pa.array(list(left), numbers), "right": pa.array(list(right), numbers)})

    def _class_counts(self, values: pa.Table, side: pa.Table, known: np.ndarray, group: np.ndarray):
        both = pa.chunked_array([*values.column("cls").chunks, *side.column("cls").chunks]).combine_chunks()
        codes, classes = _encoded(both)
        mine, theirs = codes[:len(values)], codes[len(values):]
        place = (side.column("node").to_numpy().astype(np.int64) << 40) + (
            side.column("f").to_numpy().astype(np.int64) << 20) + side.column("range").to_numpy()
        keys = np.searchsorted(known, place) * len(classes) + theirs
        order = np.argsort(keys)
        key = group * len(classes) + mine
        at = order[np.searchsorted(keys[order], key)]
        return (side.column("before").to_numpy()[at].astype(float), side.column("of_node").to_numpy()[at].astype(float), key)

    def _scored(self, left: np.ndarray, total: np.ndarray):
        if not self.gini:
            right = total - left
            apart = lambda s: s[:, 2] - np.divide(s[:, 1] * s[:, 1], s[:, 0], out=np.zeros(len(s)), where=s[:, 0] > 0)
            return apart(left) + apart(right), apart(total), right
        if self.names[0] != "n":  # counts by class
            right, size = total - left, total.sum(axis=1)
            share = lambda s: np.divide((s * s).sum(axis=1), s.sum(axis=1), out=np.zeros(len(s)), where=s.sum(axis=1) > 0)
            return 1 - (share(left) + share(right)) / size, 1 - share(total) / size, right
        (n, s, t), (all_n, all_s) = left.T, total.T[:2]
        right = np.stack([all_n - n, all_s - 2 * t + s, all_s - t], axis=1)
        share = lambda s: np.divide(s[:, 1], s[:, 0], out=np.zeros(len(s)), where=s[:, 0] > 0)
        return 1 - (share(left) + share(right)) / all_n, 1 - share(total) / all_n, right

    def _nearly_best(self, node, f, threshold, score, own) -> np.ndarray:
        """Per node the rows that may have the lowest rounded score, and of equal scores the first."""
        measure = score if self.gini else np.divide(score, own, out=np.zeros(len(score)), where=own > 0)
        order = np.lexsort((threshold, f, measure, node))
        node, measure = node[order], measure[order]
        new = np.append(True, node[1:] != node[:-1])[:len(node)]
        least = measure[np.flatnonzero(new)][np.cumsum(new) - 1]
        first = new | np.append(True, measure[1:] != measure[:-1])[:len(node)]
        return order[(measure <= least + self.tie) & first]


def _before_in_groups(n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Sum of the earlier ``n`` with the same key; equal keys lie together. Whole numbers stay exact."""
    total = np.cumsum(n) - n
    new = np.append(True, key[1:] != key[:-1])[:len(key)]
    return total - total[np.flatnonzero(new)][np.cumsum(new) - 1]


# ---- rows in blocks -------------------------------------------------------------


def _packed(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    batch = pa.record_batch(list(columns.values()), names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return pa.record_batch([pa.array([batch.num_rows], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                           names=["rows", "data"])


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Array]]:
    for batch in batches:
        for data in batch.column("data"):
            table = pa.ipc.open_stream(data.as_buffer()).read_all()
            yield {n: table.column(n).chunk(0) for n in table.column_names}


def packed_by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that come in order of class; a class is never cut."""
    held, rows, goal = [], 0, BLOCK
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < goal:
            continue
        columns = _columns(held)
        codes, _ = _encoded(columns["_y"])
        cut = int(np.argmax(codes == codes[-1]))
        if cut:
            yield _packed({n: c.slice(0, cut) for n, c in columns.items()})
        rest = pa.record_batch([c.slice(cut) for c in columns.values()], names=list(columns))
        held, rows = [rest], rest.num_rows
        goal = rows + BLOCK
    if rows:
        yield _packed(_columns(held))


def packed(f: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of rows that come in order of feature ``f``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in stretches(batches):
            block = _packed(columns)
            yield pa.record_batch([pa.array([f], pa.int32()), *block.columns], names=["f", *block.schema.names])
    return run


def _by_feature(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, dict[str, pa.Array]]]:
    """Blocks with the feature they are sorted by, if any."""
    for batch in batches:
        sorted_by = batch.column("f").to_pylist() if "f" in batch.schema.names else [None] * batch.num_rows
        yield from zip(sorted_by, unpacked([batch]))


def order_statistics(features: Sequence[tuple[int, str]], points: int) -> Callable:
    """Up to ``points`` values of every block and feature, evenly spaced in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sorted_by, columns in _by_feature(batches):
            for f, name in features:
                if sorted_by not in (None, f):
                    continue
                x = np.sort(columns[name].to_numpy(zero_copy_only=False))
                x = x[np.unique(np.linspace(0, len(x) - 1, min(points, len(x))).astype(np.int64))]
                yield pa.record_batch([pa.array(np.full(len(x), f, np.int32)), pa.array(x)], names=["f", "x"])
    return run


def _places(*keys: np.ndarray) -> np.ndarray:
    """Place of each row, from 0, among those with the same first key, in order of the others."""
    order = np.lexsort(keys[::-1])
    first = keys[0][order]
    new = np.append(True, first[1:] != first[:-1])[:len(first)]
    at = np.arange(len(first))
    out = np.empty(len(first))
    out[order] = at - at[new][np.cumsum(new) - 1]
    return out


@dataclass
class ClassSums:
    """Sums over classes, from blocks that hold classes whole.

    Rows of a node and class are numbered in order of a feature: the k-th one adds 2k - 1 to the sum
    of squared class counts, and the node's count of the class to the sum of products.
    """

    tree: FlatTree
    place: np.ndarray
    offered: np.ndarray
    edges: dict[str, np.ndarray]

    SCHEMA = (("node", pa.int32()), ("f", pa.int32()), ("range", pa.int32()), ("category", pa.string()), ("x", pa.float64()),
              ("n", pa.int64()), ("s", pa.float64()), ("t", pa.float64()), ("low", pa.float64()), ("high", pa.float64()))

    def coarse(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By range or category; ranges are added up over all blocks of a task, unless there are too many."""
        held = {}
        for columns in unpacked(batches):
            at, rows, group, of_node = self._open(columns)
            for f, name in enumerate(self.tree.features):
                on = np.flatnonzero(self.offered[at, f])
                if not len(on):
                    continue
                mine, known = at[on], of_node[on]
                if self.tree.kinds[f] != "continuous":
                    codes, words = _encoded(columns[name].take(pa.array(rows[on])))
                    s = 2 * _places(group[on] * len(words) + codes) + 1
                    order, starts = _grouped([mine, codes])
                    first = order[starts]
                    yield self._batch(len(starts), node=mine[first], f=np.full(len(starts), f),
                                      category=words.take(pa.array(codes[first])).cast(pa.string()),
                                      **self._added(order, starts, s, known))
                    continue
                x = columns[name].to_numpy(zero_copy_only=False)[rows[on]]
                width = len(self.edges[name]) + 1
                cells = mine * width + np.searchsorted(self.edges[name], x, side="right")
                order, starts = _grouped([cells])
                sums = self._added(order, starts, 2 * _places(group[on], x) + 1, known)
                ordered = x[order]
                sums |= {"low": np.minimum.reduceat(ordered, starts), "high": np.maximum.reduceat(ordered, starts)}
                cells, size = cells[order[starts]], len(self.offered) * width
                if size > DENSE:
                    yield self._ranges(f, width, cells, sums)
                    continue
                if f not in held:
                    held[f] = {n: np.full(size, {"low": np.inf, "high": -np.inf}.get(n, 0), v.dtype) for n, v in sums.items()}
                for n, v in sums.items():
                    old = held[f][n][cells]
                    held[f][n][cells] = np.minimum(old, v) if n == "low" else np.maximum(old, v) if n == "high" else old + v
        for f, sums in held.items():
            cells = np.flatnonzero(sums["n"])
            yield self._ranges(f, len(self.edges[self.tree.features[f]]) + 1, cells, {n: v[cells] for n, v in sums.items()})

    def values(self, wanted: Wanted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """By single value, in the ranges that ``wanted`` asks for."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for columns in unpacked(batches):
                at, rows, group, of_node = self._open(columns)
                for f, name in enumerate(self.tree.features):
                    if self.tree.kinds[f] != "continuous" or f not in wanted.keys:
                        continue
                    x = columns[name].to_numpy(zero_copy_only=False)[rows]
                    ranges = np.searchsorted(self.edges[name], x, side="right")
                    on = np.flatnonzero(wanted.has(f, at, ranges))
                    if not len(on):
                        continue
                    # places count the rows of ranges that are not wanted too
                    whole = np.flatnonzero(np.isin(group, group[on]))
                    s = np.zeros(len(x))
                    s[whole] = 2 * _places(group[whole], x[whole]) + 1
                    mine, ranges, x = at[on], ranges[on], x[on] + 0.0
                    order, starts = _grouped([mine, ranges, x])
                    first = order[starts]
                    yield self._batch(len(starts), node=mine[first], f=np.full(len(starts), f), range=ranges[first],
                                      x=x[first], **self._added(order, starts, s[on], of_node[on]))
        return run

    def answers(self, above: np.ndarray, class_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """By block and node the number of classes and the most frequent one, the first of equals.

        ``above`` [node, k] is the k-th node on the way to a node, itself the last, or -1.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for columns in unpacked(batches):
                codes, classes = _encoded(columns["_y"])  # numbered in their order
                node = self.tree.walk(columns, len(codes))
                for way in above.T:
                    mine = way[node]
                    on = np.flatnonzero(mine >= 0)
                    if not len(on):
                        continue
                    order, starts = _grouped([mine[on], codes[on]])
                    first = on[order[starts]]
                    n = np.diff(np.append(starts, len(order)))
                    order, starts = _grouped([mine[first], -n, codes[first]])
                    node_of = mine[first][order]
                    starts = np.flatnonzero(np.append(True, node_of[1:] != node_of[:-1]))
                    best = order[starts]
                    yield pa.record_batch([
                        pa.array(node_of[starts].astype(np.int32)), pa.array(np.diff(np.append(starts, len(order)))),
                        pa.array(n[best]), classes.take(pa.array(codes[first][best])).cast(class_type)],
                        names=["node", "classes", "n", "cls"])
        return run

    def leaves(self, class_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Rows by last node and class."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for columns in unpacked(batches):
                codes, classes = _encoded(columns["_y"])
                node = self.tree.walk(columns, len(codes))
                order, starts = _grouped([node, codes])
                first = order[starts]
                yield pa.record_batch([
                    pa.array(node[first]), classes.take(pa.array(codes[first])).cast(class_type),
                    pa.array(np.diff(np.append(starts, len(order))))], names=["node", "cls", "n"])
        return run

    def _open(self, columns: dict[str, pa.Array]):
        """Places of nodes, rows, numbers of their node and class together, and the count of these."""
        codes, classes = _encoded(columns["_y"])
        at = self.place[self.tree.walk(columns, len(codes))]
        rows = np.flatnonzero(at >= 0)
        at = at[rows].astype(np.int64)
        _, group, count = np.unique(codes[rows] * len(self.offered) + at, return_inverse=True, return_counts=True)
        return at, rows, group, count[group].astype(float)

    def _added(self, order, starts, s, t) -> dict:
        return {"n": np.diff(np.append(starts, len(order))), "s": np.add.reduceat(s[order], starts),
                "t": np.add.reduceat(t[order], starts)}

    def _ranges(self, f: int, width: int, cells: np.ndarray, sums: dict) -> pa.RecordBatch:
        return self._batch(len(cells), node=cells // width, f=np.full(len(cells), f), range=cells % width, **sums)

    def _batch(self, rows: int, **filled) -> pa.RecordBatch:
        return pa.record_batch([
            v if isinstance(v := filled.get(n), pa.Array) else pa.nulls(rows, t) if v is None else pa.array(v.astype(t.to_pandas_dtype()), t)
            for n, t in self.SCHEMA], names=[n for n, _ in self.SCHEMA])
