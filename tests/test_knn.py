from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpfit.functions.distance import METRICS, pairwise
from kelpfit.operators import knn
from kelpfit.operators.knn import KNNClassifier, KNNRegressor, nearest


def table(spark, x, y=None, first=0):
    rows = [(first + i, [float(v) for v in r], int(y[i]) if y is not None else 0) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id int, v array<double>, y int")


def brute(metric, q, t, k):
    d = pairwise(metric, q, t)
    order = np.lexsort((np.broadcast_to(np.arange(len(t)), d.shape), d), axis=1)[:, :k]
    return order, np.take_along_axis(d, order, axis=1)


def found(df, k):
    rows = defaultdict(list)
    for r in df.collect():
        rows[r["id"]].append((r["rank"], r["neighbour"], r["distance"]))
    ids = sorted(rows)
    ordered = [sorted(rows[i]) for i in ids]
    assert all([r[0] for r in o] == list(range(1, k + 1)) for o in ordered)
    return np.array([[r[1] for r in o] for o in ordered]), np.array([[r[2] for r in o] for o in ordered])


def skewed(rng, n, d):
    """A third of all rows are copies of one point."""
    x = np.concatenate([rng.normal(0, 1, (n // 3, d)), rng.normal(8, 2, (n // 3, d))])
    return np.concatenate([x, np.tile(x[:1], (n - len(x), 1))])


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("block_rows, first", [(8192, 4), (48, 4), (48, 1)])
def test_neighbours_match_brute_force(spark, monkeypatch, metric, block_rows, first):
    monkeypatch.setattr(knn, "FIRST_ROUND", first)
    rng = np.random.default_rng(2)
    t, q = skewed(rng, 240, 3), skewed(rng, 60, 3)
    q[0] = t[0]
    near = nearest(table(spark, q), table(spark, t), "id", "id", ["v"], "y", 4, metric, block_rows)
    rows, gaps = found(near, 4)
    want_rows, want_gaps = brute(metric, q, t, 4)
    assert (rows == want_rows).all()
    assert np.allclose(gaps, want_gaps)


@pytest.mark.parametrize("k", [1, 50, 130])
def test_many_neighbours_across_cells(spark, k):
    rng = np.random.default_rng(4)
    t, q = rng.normal(size=(130, 2)), rng.normal(size=(20, 2)) * 3
    rows, _ = found(nearest(table(spark, q), table(spark, t), "id", "id", ["v"], "y", k, "euclidean", 10), k)
    assert (rows == brute("euclidean", q, t, k)[0]).all()


def test_partitioning_does_not_matter(spark):
    rng = np.random.default_rng(7)
    t, q = rng.normal(size=(90, 2)), rng.normal(size=(15, 2))
    results = [
        found(nearest(table(spark, q).repartition(p), table(spark, t).repartition(p), "id", "id", ["v"], "y",
                      3, "manhattan", 16), 3)[0].tolist()
        for p in (1, 7)]
    assert results[0] == results[1]


def test_cells_are_skipped(spark):
    """Far apart groups: no query should visit the other group's cells."""
    pivots = np.array([[0.0, 0.0], [100.0, 0.0]])
    cells = knn.Cells("euclidean", pivots, np.array([5.0, 5.0]), np.zeros(2), np.ones(2))
    df = spark.createDataFrame([([0.5, 0.0], 0, 1.0), ([0.5, 0.0], 0, float("inf"))],
                               "x array<double>, c int, r double")
    got = [r[0]["cells"] for r in df.select(
        knn._other_cells("euclidean", cells, F.col("x"), F.col("c"), F.col("r"))).collect()]
    assert got == [[], [1]]


@pytest.mark.parametrize("dimensions, metric", [(3, "euclidean"), (3, "canberra"), (64, "squared_euclidean")])
def test_rounds_close_cells_and_change_nothing(spark, dimensions, metric, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, dimensions)) * 3
    t = centres[rng.integers(0, 30, 900)] + rng.normal(size=(900, dimensions))
    q = centres[rng.integers(0, 30, 80)] + rng.normal(size=(80, dimensions))
    train, asked = table(spark, t), table(spark, q)
    monkeypatch.setattr(knn, "FIRST_ROUND", 2)
    monkeypatch.setattr(knn, "ROUND_GROWTH", 2)
    index, log = knn.build_index(train, "id", ["v"], "y", metric, 400), []
    got = found(knn.search(asked, "id", index, 4, log), 4)
    want, gaps = brute(metric, q, t, 4)
    assert (got[0] == want).all() and np.allclose(got[1], gaps)
    cells = len(index.in_cell)
    assert cells > 10 and log[0] == 80 and sum(log) <= 80 * cells
    if dimensions == 3:
        assert len(log) > 2 and sum(log) < 0.9 * 80 * cells


@pytest.mark.parametrize("metric", METRICS)
def test_large_blocks_replace_cells_that_bounds_leave_open(spark, metric, monkeypatch):
    """In 64 dimensions without clusters nothing is ruled out; visits of cells would be shuffled one by one."""
    rng = np.random.default_rng(5)
    t, q = rng.normal(size=(900, 64)), rng.normal(size=(60, 64))
    monkeypatch.setattr(knn, "FIRST_ROUND", 2)
    index, log, joined = knn.build_index(table(spark, t), "id", ["v"], "y", metric, 200), [], []
    join = knn._join_cells
    monkeypatch.setattr(knn, "_join_cells", lambda visits, *args, **kwargs: joined.append(visits.count()) or join(
        visits, *args, **kwargs))
    rows, gaps = found(knn.search(table(spark, q), "id", index, 4, log), 4)
    want, want_gaps = brute(metric, q, t, 4)
    assert (rows == want).all() and np.allclose(gaps, want_gaps)
    assert len(index.in_cell) > 20 and joined == [60, 120]


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("kind", ["normal", "heavy", "whole", "tiny"])
def test_bounds_in_a_block_lose_no_neighbour(metric, kind):
    rng = np.random.default_rng(8)
    q, t = [{"normal": lambda n: rng.normal(size=(n, 70)), "heavy": lambda n: rng.standard_cauchy(size=(n, 3)),
             "whole": lambda n: rng.integers(-2, 3, (n, 5)) * 1.0,
             "tiny": lambda n: rng.normal(size=(n, 9)) * 1e-140}[kind](n) for n in (70, 2500)]
    keys, full = rng.permutation(len(t)), pairwise(metric, q, t)
    for reach in (np.full(len(q), np.inf), np.sort(full, axis=1)[:, 2]):
        at, rows, gaps = knn.near_in_block(metric, q, t, keys, 5, reach)
        for i in range(len(q)):
            want = np.lexsort((keys, full[i]))[:5]
            want = want[full[i][want] <= reach[i]]
            assert (rows[at == i] == want).all() and (gaps[at == i] == full[i][want]).all()


def test_near_ties_in_one_block():
    rng = np.random.default_rng(0)
    t = 1e6 + rng.integers(0, 3, size=(400, 4)).astype(float)
    q = t[:25]
    rows, gaps = knn.top_block("euclidean", q, t, np.arange(400), 6)
    want, want_gaps = brute("euclidean", q, t, 6)
    assert (rows == want).all() and np.allclose(gaps, want_gaps)


def test_majority_vote_ties_go_to_the_nearest(spark):
    train = table(spark, [[1.0], [2.0], [-3.0], [4.0]], [7, 8, 8, 7])
    model = KNNClassifier(4).fit(train, "v", "y", "id")
    assert model.predict(table(spark, [[0.0]])).first()["prediction"] == 7


def test_weights_can_overrule_the_majority(spark):
    train = table(spark, [[0.1], [5.0], [6.0]], [1, 2, 2])
    query = table(spark, [[0.0]])
    assert KNNClassifier(3).fit(train, "v", "y", "id").predict(query).first()["prediction"] == 2
    assert KNNClassifier(3, weighting=True).fit(train, "v", "y", "id").predict(query).first()["prediction"] == 1


def test_exact_match_has_a_finite_weight(spark):
    near = nearest(table(spark, [[1.0]]), table(spark, [[1.0], [2.0]]), "id", "id", ["v"], "y", 2)
    weights = [r["weight"] for r in knn.with_weights(near).orderBy("rank").collect()]
    assert weights == [1.0 / 1e-6, 1.0 / (1.0 + 1e-6)]


@pytest.mark.parametrize("weighting", [False, True])
def test_regression_aggregations(spark, weighting):
    rng = np.random.default_rng(9)
    t, q = rng.normal(size=(50, 2)), rng.normal(size=(10, 2))
    y = rng.integers(0, 4, size=50)
    model = KNNRegressor(5, weighting=weighting).fit(table(spark, t, y), "v", "y", "id")
    order, gaps = brute("euclidean", q, t, 5)
    for function in knn.AGGREGATIONS:
        got = [r["prediction"] for r in model.predict(
            table(spark, q), aggregation_function=function).orderBy("id").collect()]
        want = []
        for near, d in zip(order, gaps):
            v = y[near]
            w = 1 / (d + 1e-6) if weighting else np.ones(5)
            if function == "mean":
                want.append((v * w).sum() / w.sum())
            elif function == "median":
                want.append(v[(w.cumsum() >= w.sum() / 2).argmax()] if weighting else np.median(v))
            else:
                total = Counter()
                for value, weight in zip(v, w):
                    total[value] += weight
                want.append(max(total, key=lambda value: (round(total[value], 9), -list(v).index(value))))
        assert np.allclose(got, want)


def test_fit_time_scaling_is_shared(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0, 1), (1, 10.0, 0.0, 2)], "id int, a double, b double, y int")
    model = KNNClassifier(1).fit(df, ["a", "b"], "y", "id", "min_max")
    query = spark.createDataFrame([(9, 9.0, 0.0)], "id int, a double, b double")
    near = model.neighbours(query).first()
    assert near["label"] == 2 and np.isclose(near["distance"], 0.1)


def test_string_labels_and_keys(spark):
    train = spark.createDataFrame([("a", 1.0, "red"), ("b", 2.0, "blue")], "id string, x double, y string")
    got = KNNClassifier(1).fit(train, ["x"], "y", "id").predict(train).orderBy("id").collect()
    assert [(r["id"], r["prediction"]) for r in got] == [("a", "red"), ("b", "blue")]


def test_no_queries(spark):
    train = table(spark, np.arange(60.0).reshape(-1, 1))
    for block_rows in (8192, 16):
        near = nearest(train.limit(0), train, "id", "id", ["v"], "y", 2, "euclidean", block_rows)
        assert near.count() == 0


def test_bad_settings_and_input(spark):
    for bad in (dict(n_neighbors=0), dict(n_neighbors=1.5), dict(distance_metric="cosine")):
        with pytest.raises(ValueError):
            KNNClassifier(**bad)
    with pytest.raises(TypeError):
        KNNRegressor(weighting="yes")
    df = table(spark, [[1.0], [2.0]])
    with pytest.raises(ValueError, match="cannot exceed"):
        KNNClassifier(3).fit(df, "v", "y", "id").predict(df)
    with pytest.raises(ValueError):
        KNNClassifier(1).fit(df, "v", "y", "id", "log")
    with pytest.raises(ValueError):
        KNNRegressor(1).fit(df, "v", "y", "id").predict(df, aggregation_function="max")
    with pytest.raises(ValueError):
        KNNRegressor(1).fit(df, "v", "y", "id").predict(df.drop("v"))


def test_queries_with_missing_features_get_no_answer(spark):
    train = spark.createDataFrame([(i, float(i), i % 2) for i in range(8)], "id int, a double, y int")
    asked = spark.createDataFrame([(1, 3.0), (2, None), (3, float("nan"))], "id int, a double")
    got = {r["id"]: r["prediction"] for r in KNNClassifier(1).fit(train, ["a"], "y", "id").predict(asked).collect()}
    assert got == {1: 1, 2: None, 3: None}


def test_training_rows_are_dealt_into_cells_once(spark, monkeypatch):
    train = spark.createDataFrame([(i, float(i), i % 2) for i in range(200)], "id int, a double, y int")
    model = KNNClassifier(3, block_rows=64).fit(train, ["a"], "y", "id")
    assert len(model.index.cells.pivots) > 1
    monkeypatch.setattr(knn, "build_index", None)
    monkeypatch.setattr(knn, "_pivots", None)
    assert model.predict(train).count() == model.predict(train).count() == 200
