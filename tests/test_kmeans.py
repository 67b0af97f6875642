import numpy as np
import pytest
from pyspark.ml.clustering import KMeans as MLKMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kelpfit.functions.distance import METRICS, pairwise
from kelpfit.operators import kmeans as km
from kelpfit.operators.kmeans import KMeans


def table(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                                 "id int, " + ", ".join(f"x{j} double" for j in range(x.shape[1])))


def names(x):
    return [f"x{j}" for j in range(x.shape[1])]


def run_numpy(x, start, metric, steps):
    """Plain loop: assign, average, stop when an assignment repeats."""
    c, before = np.array(start), None
    for _ in range(steps):
        a = pairwise(metric, x, c).argmin(axis=1)
        c = np.array([x[a == j].mean(axis=0) if (a == j).any() else c[j] for j in range(len(c))])
        if before is not None and (a == before).all():
            break
        before = a
    return a, c


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("method", ["kmeans++", "random"])
def test_runs_match_a_plain_loop(spark, metric, method):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(loc, 1.0, size=(40, 2)) for loc in (0.0, 3.0, 9.0)])
    df = table(spark, x).repartition(3)
    model = KMeans(k=3, max_iter=15, cluster_method=method, distance_metric=metric,
                   random_state=2).fit(df, names(x), "id")
    a, c = run_numpy(x, model.start, metric, 15)
    got = [r["cluster"] for r in model.assignments(df).orderBy("id").collect()]
    assert got == list(a)
    assert np.allclose(model.centroids, c)


def test_farthest_first_start(spark):
    x = np.array([[0.0], [1.0], [10.0], [10.0], [4.0]])
    model = KMeans(k=3, max_iter=1, random_state=1).fit(table(spark, x), ["x0"], "id")
    first = model.start[0][0]
    expected = [first]
    for _ in range(2):
        gaps = np.min([np.abs(x[:, 0] - c) for c in expected], axis=0)
        expected.append(x[gaps.argmax(), 0])
    assert [c[0] for c in model.start] == expected


@pytest.mark.parametrize("literals", [256, 4])
def test_a_long_farthest_first_start(spark, monkeypatch, literals):
    monkeypatch.setattr(km, "MAX_LITERALS", literals)
    x = np.random.default_rng(4).normal(size=(300, 3))
    model = KMeans(k=21, max_iter=1, random_state=1).fit(table(spark, x), names(x), "id")
    expected = [np.array(model.start[0])]
    for _ in range(20):
        gaps = np.min([((x - c) ** 2).sum(axis=1) for c in expected], axis=0)
        expected.append(x[gaps.argmax()])
    assert np.allclose(model.start, expected)


def test_equidistant_rows_join_the_lowest_cluster(spark):
    df = spark.createDataFrame([(0, [1.0])], "id int, _x array<double>")
    for metric in ("euclidean", "manhattan"):
        assert df.select(km.nearest("_x", [[0.0], [2.0]], metric)).first()[0] == 0
        assert df.select(km.nearest("_x", [[2.0], [0.0]], metric)).first()[0] == 0


def test_empty_cluster_keeps_its_centroid(spark):
    x = np.array([[1.0, 1.0]] * 4)
    model = KMeans(k=2, max_iter=5, random_state=3).fit(table(spark, x), names(x), "id")
    assert model.centroids == [[1.0, 1.0], [1.0, 1.0]]
    assert {r["cluster"]: r["n"] for r in model.cluster_sizes(table(spark, x)).collect()} == {0: 4}


def test_large_models_travel_as_a_matrix(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(50, 3))
    df = table(spark, x).select("id", F.array(*names(x)).alias("v"))
    small = KMeans(k=4, max_iter=6, random_state=4).fit(df, "v", "id")
    monkeypatch.setattr(km, "MAX_LITERALS", 0)
    wide = KMeans(k=4, max_iter=6, random_state=4).fit(df, "v", "id")
    assert np.allclose(small.centroids, wide.centroids)
    assert [r["cluster"] for r in small.transform(df).orderBy("id").collect()] == [
        r["cluster"] for r in wide.transform(df).orderBy("id").collect()]


def test_cost_never_rises_and_mllib_agrees(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(loc, 0.3, size=(30, 2)) for loc in (0.0, 5.0, 10.0)])
    df = table(spark, x)
    vectors = df.select(F.array(*names(x)).alias("_x"))
    model = KMeans(k=3, distance_metric="squared_euclidean", random_state=1).fit(df, names(x), "id", trace=True)
    steps = {}
    for i, c, features, _, _ in model.trace:
        steps.setdefault(i, []).append(features)
    costs = [km.cost(vectors, "_x", c, "squared_euclidean") for _, c in sorted(steps.items())]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    other = MLKMeans(k=3, seed=1).fit(VectorAssembler(inputCols=names(x), outputCol="features").transform(df))
    assert np.isclose(costs[-1], other.summary.trainingCost, rtol=1e-6)


def test_scaled_prediction_uses_fit_time_statistics(spark):
    x = np.array([[0.0], [1.0], [9.0], [10.0]])
    model = KMeans(k=2, random_state=1).fit(table(spark, x), ["x0"], "id", "min_max")
    got = [r["cluster"] for r in model.predict(table(spark, np.array([[0.4], [9.6]]))).orderBy("id").collect()]
    near = [min(range(2), key=lambda c: abs(v / 10 - model.centroids[c][0])) for v in (0.4, 9.6)]
    assert got == near and got[0] != got[1]


def test_traces(spark):
    x = np.arange(12.0).reshape(-1, 1)
    model = KMeans(k=2, max_iter=20, random_state=1).fit(table(spark, x), ["x0"], "id", trace=True)
    plain = KMeans(k=2, max_iter=20, random_state=1).fit(table(spark, x), ["x0"], "id")
    assert plain.centroids == model.centroids
    with pytest.raises(ValueError):
        plain.iteration_trace(spark)
    trace = model.iteration_trace(spark).groupBy("iteration").agg(
        F.sum("n").alias("n"), F.sum("changed").alias("changed")).orderBy("iteration").collect()
    assert {r["n"] for r in trace} == {12}
    assert trace[0]["changed"] == 12 and trace[-1]["changed"] == 0
    assert model.start_trace(spark).count() == 3
    assert model.members(table(spark, x)).count() == 12
    assert model.centroid_table(spark).count() == 2


def test_points_equal_to_centroids_are_left_out(spark):
    x = np.array([[1.0, 2.0], [1.0, 3.0], [1.0, 2.0]])
    left = km.without_points(table(spark, x), names(x), [[1.0, 2.0]]).collect()
    assert [r["id"] for r in left] == [1]


@pytest.mark.parametrize("bad", [
    dict(k=0), dict(max_iter=0), dict(patience=0), dict(cluster_method="forgy"), dict(distance_metric="cosine")])
def test_bad_settings(bad):
    with pytest.raises(ValueError):
        KMeans(**bad)


def test_bad_input(spark):
    df = table(spark, np.array([[1.0], [2.0]]))
    with pytest.raises(ValueError):
        KMeans(k=3, cluster_method="random").fit(df, ["x0"], "id")
    with pytest.raises(ValueError):
        KMeans().fit(df, ["x0"], "id", "log")
    with pytest.raises(ValueError):
        KMeans(max_iter=1, random_state=1).fit(df, ["x0"], "id").predict(df.drop("x0"))


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "canberra", "squared_euclidean"])
def test_bounds_save_distances_and_change_nothing(spark, metric, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 1.0, (150, 2)) for c in ((0, 0), (4, 1), (1, 5), (6, 6))])
    df = table(spark, x)
    settings = KMeans(k=4, max_iter=60, distance_metric=metric, cluster_method="random", random_state=5)
    monkeypatch.setattr(km, "LEAST_PASSES", 1000)
    plain = settings.fit(df, ["x0", "x1"], "id")
    monkeypatch.setattr(km, "LEAST_PASSES", 2)
    bounded = settings.fit(df, ["x0", "x1"], "id")
    assert np.allclose(plain.centroids, bounded.centroids) and len(plain.history) == len(bounded.history)
    assert plain.measured == [600 * 4] * len(plain.history)
    if len(plain.history) > 4:
        assert sum(bounded.measured) < 0.8 * sum(plain.measured)


def test_passes_read_packed_points_and_other_tables_are_let_go(spark, monkeypatch):
    """A pass reads a few rows of bytes; the keyed rows and earlier tables take no memory meanwhile."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 1.0, (150, 2)) for c in ((0, 0), (4, 1), (1, 5), (6, 6))])
    df = table(spark, x).repartition(3)
    context, packs, tables, iterate = spark.sparkContext._jsc, [], [], km._iterate
    earlier = len(context.getPersistentRDDs())

    def spy(points, *args):
        packs.append(points.count())
        tables.append(len(context.getPersistentRDDs()) - earlier)
        return iterate(points, *args)

    monkeypatch.setattr(km, "_iterate", spy)
    model = KMeans(k=4, max_iter=60, random_state=5).fit(df, ["x0", "x1"], "id")
    a, c = run_numpy(x, model.start, "euclidean", 60)
    assert [r["cluster"] for r in model.assignments(df).orderBy("id").collect()] == list(a)
    assert np.allclose(model.centroids, c)
    assert len(packs) > 3 and set(packs) == {3} and tables[0] <= 1 and max(tables) <= 2
    assert len(context.getPersistentRDDs()) <= earlier


def test_members_of_every_iteration(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(60, 2))
    df = table(spark, x)
    model = KMeans(k=3, max_iter=5, random_state=4).fit(df, ["x0", "x1"], "id", "standardization", scope="column", trace=True)
    got = model.iteration_members(df, "id").collect()
    assert len(got) == 60 * len(model.history)
    sizes = {}
    for r in got:
        sizes[r["iteration"], r["cluster"]] = sizes.get((r["iteration"], r["cluster"]), 0) + 1
    assert sizes == {(i, c): n for i, c, _, n, _ in model.trace if n}
    some = model.iteration_members(df, "id", sample=0.4, seed=2).collect()
    assert 0 < len(some) < len(got) and len(some) % len(model.history) == 0


@pytest.mark.parametrize("trace", [False, True])
def test_a_task_holds_small_packs_of_a_long_partition(spark, monkeypatch, trace):
    """Packs come one by one, with distances kept and without; they do not grow with the partition or the vectors."""
    x = np.random.default_rng(11).normal(size=(3000, 64)) + np.arange(3000).reshape(-1, 1) % 5
    df = table(spark, x).select("id", F.array(*names(x)).alias("v")).coalesce(1).cache()
    sizes, iterate = [], km._iterate

    def spy(points, metric, used, previous, trace, bounded):
        read = bounded[0] if bounded else points
        sizes.append(read.mapPartitions(lambda packs: [[sum(map(len, pack)) for pack in packs]]).collect())
        return iterate(points, metric, used, previous, trace, bounded)

    monkeypatch.setattr(km, "_iterate", spy)
    monkeypatch.setattr(km, "LEAST_PASSES", 2)
    model = KMeans(k=5, max_iter=6, random_state=5).fit(df, "v", "id", trace=trace)
    a, c = run_numpy(x, model.start, "euclidean", 6)
    assert [r["cluster"] for r in model.assignments(df).orderBy("id").collect()] == list(a)
    assert np.allclose(model.centroids, c)
    assert all(len(parts) == 1 and len(parts[0]) >= 6 and max(parts[0]) <= 1.1 * km.PACK_BYTES for parts in sizes)
    assert sum(sizes[-1][0]) == 3000 * (64 * 8 + 8 + (20 if len(sizes) > 2 else 0))


def test_partial_sums_of_many_cores_meet_in_tasks(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(400, 2)).round(2)
    df = table(spark, x).repartition(5)
    settings = KMeans(k=3, max_iter=8, random_state=2)
    plain = settings.fit(df, names(x), "id", trace=True)
    monkeypatch.setattr(km, "MANY_CORES", 1)
    met = settings.fit(df, names(x), "id", trace=True)
    assert np.allclose(plain.centroids, met.centroids) and plain.measured == met.measured
    assert [(*t[:2], *t[3:]) for t in plain.trace] == [(*t[:2], *t[3:]) for t in met.trace]
