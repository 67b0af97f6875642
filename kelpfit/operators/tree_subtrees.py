"""Subtrees grown inside one task, once the rows of a node fit into it.

A level of a tree costs several Spark jobs, however few rows its nodes have left. A node
whose rows one task can hold is therefore sent there whole, and all levels below it are
grown from arrays: rows are sorted once by every feature, and a level only deals each of
these orders out to the new nodes. Scores, ties and stops are those of the levels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NUMBERS = pa.list_(pa.float64())


@dataclass
class Subtrees:
    """Grows what lies below some nodes: a table of rows each, with the node's number in ``_node`` and class codes in ``_y``."""

    features: list[str]
    kinds: list[str]
    #: path, class counts and open features of every node
    roots: list[tuple[str, tuple, list[bool]]]
    max_depth: int
    num_min_samples: int
    stop_when_pure: bool
    reuse_features: bool
    positive: str
    negative: str
    digits: int

    SCHEMA = ("path string, rank double, f int, threshold double, value string, score double, left array<double>, "
              "right array<double>, own double, own_rank double")

    def __call__(self, table: pa.Table) -> pa.Table:
        path, counts, offered = self.roots[table.column("_node")[0].as_py()]
        y = table.column("_y").to_numpy()
        read = [self._read(f, table.column(name)) for f, name in enumerate(self.features)]
        values, words = [x for x, _ in read], [w for _, w in read]
        orders = [np.argsort(x, kind="stable") for x in values]
        at, found = np.zeros(len(y), np.int32), []
        paths, totals, offered = [path], np.array([counts], float), np.array([offered], bool)
        while paths:
            best = self._best(values, words, orders, at, y, totals, offered)
            found += [{"path": paths[i], **split} for i, split in best.items()]
            paths, totals, offered = self._descend(best, paths, offered, values, words, at)
            orders = [_dealt(order, at, len(paths)) for order in orders]
        return pa.Table.from_pylist(found, pa.schema([
            ("path", pa.string()), ("rank", pa.float64()), ("f", pa.int32()), ("threshold", pa.float64()), ("value", pa.string()),
            ("score", pa.float64()), ("left", NUMBERS), ("right", NUMBERS), ("own", pa.float64()), ("own_rank", pa.float64())]))

    def _read(self, f: int, column: pa.ChunkedArray) -> tuple[np.ndarray, list[str]]:
        """Numbers, or places in a list of words: the positive and the negative one, or all in their order."""
        if self.kinds[f] == "continuous":
            return column.to_numpy() + 0.0, []
        words = pa.array([self.positive, self.negative])
        if self.kinds[f] != "binary":
            words = column.unique()
            words = words.take(pc.array_sort_indices(words))
        return pc.index_in(column, value_set=words).to_numpy().astype(np.int32), words.to_pylist()

    def _best(self, values, words, orders, at, y, totals, offered) -> dict[int, dict]:
        """The best split of every node that has one."""
        tables = [self._nearly_best(f, values[f], orders[f], at, y, totals, offered[:, f]) for f in range(len(values))]
        node, f, place, score, left, right = [np.concatenate(v) for v in zip(*tables)]
        keep = self._first_of_ties(node, f, place, score)
        own = (1 - _share(totals.T) / totals.sum(axis=1)).tolist()
        best = {}
        for row in zip(*[v[keep].tolist() for v in (node, f, place, score, left, right)]):
            rank = (self._rounded(row[3]), *row[1:3])
            if row[0] not in best or rank < best[row[0]][0]:
                best[row[0]] = rank, row
        out = {}
        for (rank, f, place), (node, _, _, score, left, right) in best.values():
            number = self.kinds[f] == "continuous"
            out[node] = {"rank": rank, "f": f, "threshold": place if number else None, "value": None if number else words[f][int(place)],
                         "score": score, "left": left, "right": right, "own": own[node], "own_rank": self._rounded(own[node])}
        return out

    def _nearly_best(self, f: int, values, order, at, y, totals, offered):
        """Node, feature, threshold or place of the word, score and both sides' counts of splits that may be their node's best."""
        node, x, cls = at[order], values[order], y[order]
        ends = np.flatnonzero(np.append((node[1:] != node[:-1]) | (x[1:] != x[:-1]), True)[:len(node)])
        node, x = node[ends], x[ends]
        sums = [np.cumsum(cls == c)[ends] for c in range(totals.shape[1])]
        new = np.append(True, node[1:] != node[:-1])[:len(node)]
        if self.kinds[f] == "continuous":
            pick = np.flatnonzero(np.append(~new[1:], False)[:len(node)] & offered[node])
            before = np.flatnonzero(new)[np.cumsum(new) - 1][pick] - 1
            left = [np.where(before < 0, s[pick], s[pick] - s[before]).astype(float) for s in sums]
            node, place = node[pick], x[pick]
            with np.errstate(invalid="ignore"):
                place = (place + x[pick + 1]) / 2
            right = [t[node] - n for t, n in zip(totals.T, left)]
        elif self.kinds[f] == "binary":
            counts = np.zeros((2, totals.shape[1], len(totals)))
            counts[x, :, node] = np.stack([np.diff(s, prepend=0) for s in sums], axis=1)
            node = node[new]
            node = node[offered[node]]
            left, right, place = list(counts[0][:, node]), list(counts[1][:, node]), np.zeros(len(node))
        else:
            left = [np.diff(s, prepend=0).astype(float) for s in sums]
            pick = np.flatnonzero(offered[node] & (sum(left) < totals.sum(axis=1)[node]))
            node, place, left = node[pick], x[pick].astype(float), [n[pick] for n in left]
            right = [t[node] - n for t, n in zip(totals.T, left)]
        score = 1 - (_share(left) + _share(right)) / totals.sum(axis=1)[node]
        keep = np.arange(0)
        if len(node):
            new = np.append(True, node[1:] != node[:-1])
            least = np.minimum.reduceat(score, np.flatnonzero(new))[np.cumsum(new) - 1]
            keep = np.flatnonzero(score <= least + self._tie)
        return (node[keep], np.full(len(keep), f), place[keep], score[keep],
                np.stack([n[keep] for n in left], axis=1), np.stack([n[keep] for n in right], axis=1))

    @property
    def _tie(self) -> float:
        """Scores so close may be equal once they are rounded."""
        return 2 * 10.0 ** -self.digits

    def _first_of_ties(self, node, f, place, score) -> np.ndarray:
        order = np.lexsort((place, f, score, node))
        node, score = node[order], score[order]
        new = np.append(True, node[1:] != node[:-1])[:len(node)]
        least = score[np.flatnonzero(new)][np.cumsum(new) - 1]
        first = new | np.append(True, score[1:] != score[:-1])[:len(node)]
        return order[(score <= least + self._tie) & first]

    def _rounded(self, score: float) -> float:
        """As Spark rounds: by the digits that are shown, halves up."""
        return float(Decimal(repr(score)).quantize(Decimal(1).scaleb(-self.digits), ROUND_HALF_UP))

    def _descend(self, best: dict, paths: list, offered: np.ndarray, values, words, at: np.ndarray):
        """Moves rows in ``at`` to the children that split on, -1 for all others; returns these children."""
        feature, place = np.full(len(paths), -1), np.zeros(len(paths))
        child = np.full((2, len(paths)), -1, np.int32)
        below, totals, open_ = [], [], []
        for i, split in best.items():
            if split["own_rank"] < split["rank"]:
                continue
            feature[i] = f = split["f"]
            place[i] = split["threshold"] if split["value"] is None else words[f].index(split["value"])
            rest = offered[i] if self.reuse_features else offered[i] & (np.arange(len(self.features)) != f)
            for side, step in enumerate("LR"):
                counts = split["right" if side else "left"]
                if self._may_split(paths[i] + step, counts):
                    child[side, i] = len(below)
                    below.append(paths[i] + step)
                    totals.append(counts)
                    open_.append(rest)
        rows = np.flatnonzero(at >= 0)
        mine = at[rows]
        at[rows] = -1
        for f, kind in enumerate(self.kinds):
            here = np.flatnonzero(feature[mine] == f)
            on, node = rows[here], mine[here]
            x = values[f][on]
            if kind == "binary":
                at[on] = np.where(x == 0, child[0, node], np.where(x == 1, child[1, node], -1))
            else:
                at[on] = np.where(x <= place[node] if kind == "continuous" else x == place[node], child[0, node], child[1, node])
        return below, np.array(totals, float), np.array(open_, bool)

    def _may_split(self, path: str, counts: Sequence[float]) -> bool:
        n = int(sum(counts))
        if n <= 0 or n < self.num_min_samples or len(path) >= self.max_depth:
            return False
        return not (self.stop_when_pure and 1.0 - sum(c * c for c in counts) / n / n <= 0)


def _share(counts: Sequence[np.ndarray]) -> np.ndarray:
    """Squared class counts by rows; whole numbers, so their order does not matter."""
    n, squares = sum(counts), sum(c * c for c in counts)
    return np.divide(squares, n, out=np.zeros(len(n)), where=n > 0)


def _dealt(order: np.ndarray, at: np.ndarray, nodes: int) -> np.ndarray:
    """The rows that are still at a node, by node and then in the order they had."""
    node = at[order]
    order, node = order[node >= 0], node[node >= 0]
    return order[np.argsort(node.astype(np.uint16) if nodes <= 1 << 16 else node, kind="stable")]
