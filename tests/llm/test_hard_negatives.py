"""Hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpfit.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, is_anchor, positives, negatives, low, high, scale):
    rows = [(i, c, [math.floor(scale * x) for x in v]) for i, c, v in rows
            if i is not None and c is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, c, v in rows:
        if is_anchor(i) and (i not in anchors or (str(c), v) < anchors[i]):
            anchors[i] = (str(c), v)
    out = []
    for a, (label, u) in anchors.items():
        near = sorted(((-sum(x * y for x, y in zip(u, v)), i, str(c)) for i, c, v in rows if i != a))
        for s, p, _ in [r for r in near if r[2] == label][:positives]:
            fits = [r for r in near if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fits)]
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect())


def clustered(n, d, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d))
    rows = []
    for i in range(n):
        c = int(rng.integers(labels))
        v = centres[int(rng.integers(labels))] + rng.normal(size=d) * rng.choice([0.05, 1.0])
        rows.append((i, c, [float(np.float32(x)) for x in v / np.linalg.norm(v) * rng.choice([0.5, 1, 3])]))
    return rows


@pytest.mark.parametrize("options", [{}, {"block_rows": 100, "clusters": 3}, {"positives": 2, "negatives": 3, "scale": 8}])
def test_against_all_pairs(spark, options):
    rows = clustered(700, 8, 5)
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(60)]  # ties
    want = brute(rows, lambda i: i % 10 == 0, options.get("positives", 5), options.get("negatives", 10), 30, 90,
                 options.get("scale", 256))
    assert found(spark.createDataFrame(rows, SCHEMA), **options) == want and want


def test_walks_end_early():
    """Members of a tight cluster read a part of their list only."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20_000, 8))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    u = x[:1] + rng.integers(-3, 4, size=(20, 8))
    centre = hn._directions(u.mean(0, keepdims=True))
    angle = np.arccos(np.clip(hn._directions(u) @ centre.T, -1, 1)).max()
    block = hn._Block(np.arange(20_000), np.array(["a"] * 20_000, object), x, hn._Clusters(centre, np.array([angle])))
    block.listed(0)
    reads = []

    order = block.order
    members = [{"vec_id": -1 - i, "label": "a", "lows": [-hn.LONGEST], "highs": [hn.LONGEST]} for i in range(20)]

    class Order:
        def __len__(self):
            return len(order)

        def __getitem__(self, part):
            reads.append(part.stop)
            return order[part]

    block.order = Order()
    got = sorted(block.walk(members, u, 5, True))
    want = []
    for i in range(20):
        s = x @ u[i]
        want += [(-1 - i, 0, int(j), int(s[j])) for j in np.lexsort((np.arange(len(s)), -s))[:5]]
    assert got == sorted(want) and max(reads) < 10_000


def test_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(80, 4, 2, labels=2)
    rows += [(None, 1, [1.0, 0.0, 0.0, 0.0]), (90, None, [1.0, 0.0, 0.0, 0.0]), (100, 1, None),
             (110, 1, [1.0, None, 0.0, 0.0]), (120, 0, [nan, 0.0, 0.0, 0.0]), (130, 0, [inf, 0.0, 0.0, 0.0]), (140, 0, []), (150, 1, [0.5]), (160, 1, [0.0] * 4),
             (30, 0, [0.25, 0.5, 0.0, 0.0]), (31, 1, [0.25, 0.5, 0.0, 0.0]), (31, 1, [0.25, 0.5, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", block string, score int")
    assert found(df) == brute(rows, lambda i: i % 10 == 0, 5, 10, 30, 90, 256)


def test_large_components_are_exact(spark):
    random.seed(4)
    rows = [(i, i % 2, [random.uniform(-1, 1) * 2 ** 19, random.random() * 2 ** 18]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert found(df) == brute(rows, lambda i: i % 10 == 0, 5, 10, 30, 90, 256)


def test_empty_tables(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, 1, [1.0])], SCHEMA)) == []
    assert found(spark.createDataFrame([(10, 1, [1.0])], SCHEMA)) == []
