import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpfit import checks
from kelpfit.functions import distance as dist
from kelpfit.functions.hashing import hash_normal, hash_uniform, normal_draw, uniform_draw
from kelpfit.operators import aggregates, metrics, quantiles, scaling

DATA = [(1, 1.0, 10.0), (2, 2.0, 30.0), (3, 4.0, 20.0), (4, 5.0, 40.0)]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(DATA, "id int, a double, b double")


def matrix(df, *columns):
    return np.array([[r[c] for c in columns] for r in df.orderBy("id").collect()])


@pytest.mark.parametrize("scope", scaling.SCOPES)
@pytest.mark.parametrize("method", scaling.METHODS)
def test_scaling_matches_numpy(points, method, scope):
    x = np.array(DATA)[:, 1:]
    axis = None if scope == "matrix" else 0
    shift = x.min(axis) if method == "min_max" else x.mean(axis)
    divisor = x.std(axis) if method == "standardization" else x.max(axis) - x.min(axis)
    scaler = scaling.fit_scaler(points, ["a", "b"], method, scope)
    assert np.allclose(matrix(scaler.transform(points), "a", "b"), (x - shift) / divisor)
    vectors = points.select("id", F.array("a", "b").alias("v"))
    scaled = scaling.fit_scaler(vectors, "v", method, scope).transform(vectors)
    assert np.allclose([r["v"] for r in scaled.orderBy("id").collect()], (x - shift) / divisor)


def test_constant_data_scales_to_zero(spark):
    df = spark.createDataFrame([(i, 3.0, float(i)) for i in range(5)], "id int, a double, b double")
    scaled = scaling.fit_scaler(df, ["a", "b"], "min_max", "column").transform(df)
    assert set(matrix(scaled, "a")[:, 0]) == {0.0}
    for method in scaling.METHODS:
        assert set(matrix(scaling.fit_scaler(df, ["a"], method).transform(df), "a")[:, 0]) == {0.0}
    vectors = df.select("id", F.array("a", "b").alias("v"))
    scaled = scaling.fit_scaler(vectors, "v", "standardization", "column").transform(vectors)
    assert {r["v"][0] for r in scaled.collect()} == {0.0}


def test_new_rows_use_fit_time_statistics(spark, points):
    scaler = scaling.fit_scaler(points, ["a"], "min_max")
    new = spark.createDataFrame([(1, 9.0, 0.0)], "id int, a double, b double")
    assert scaler.transform(new).first()["a"] == 2.0


def test_unknown_names_are_rejected(points):
    with pytest.raises(ValueError):
        scaling.fit_scaler(points, ["a"], "log")
    with pytest.raises(ValueError):
        dist.check_metric("cosine")
    with pytest.raises(ValueError):
        scaling.fit_scaler(points, ["missing"], "min_max")


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([np.exp(rng.normal(size=2000) * 6), np.full(1000, 3.0)])
    df = spark.createDataFrame([(float(v), float(-v)) for v in values], "a double, b double")
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = quantiles.exact_quantiles(df, ["a", "b"], shares)
    assert np.allclose(found["a"], np.quantile(values, shares), rtol=1e-12)
    assert np.allclose(found["b"], np.quantile(-values, shares), rtol=1e-12)


def test_robust_scaling(spark, points):
    x = np.array(DATA)[:, 1]
    q = np.quantile(x, [0.25, 0.5, 0.75])
    scaled = scaling.fit_robust_scaler(points, ["a"]).transform(points)
    assert np.allclose(matrix(scaled, "a")[:, 0], (x - q[1]) / (q[2] - q[0]))
    sketch = scaling.fit_robust_scaler(points, ["a"], accuracy=1000)
    assert sketch.shift[0] in x


@pytest.mark.parametrize("metric", dist.METRICS)
def test_distances_agree(spark, metric):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(20, 3)), rng.normal(size=(20, 3))
    a[0, 0] = b[0, 0] = 0.0
    rows = [(*map(float, p), *map(float, q)) for p, q in zip(a, b)]
    df = spark.createDataFrame(rows, ", ".join(f"{n}{i} double" for n in "ab" for i in range(3)))
    left, right = [[F.col(f"{n}{i}") for i in range(3)] for n in "ab"]
    got = df.select(dist.distance(metric, left, right).alias("u"),
                    dist.array_distance(metric, F.array(*left), F.array(*right)).alias("v")).collect()
    block = np.diag(dist.pairwise(metric, a, b))
    assert np.allclose([r["u"] for r in got], block) and np.allclose([r["v"] for r in got], block)


def test_canberra_counts_two_zeros_as_equal(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 3.0)], "a double, b double, c double, d double")
    value = df.select(dist.distance(
        "canberra", [F.col("a"), F.col("c")], [F.col("b"), F.col("d")])).first()[0]
    assert value == 0.5


def test_float_arrays_are_subtracted_in_double(spark):
    df = spark.sql("select array(cast(0.1 as float)) as a, array(cast(0.3 as float)) as b")
    value = df.select(dist.array_distance("manhattan", F.col("a"), F.col("b"))).first()[0]
    assert value == abs(float(np.float32(0.1)) - float(np.float32(0.3)))


def test_seeded_draws_agree_between_driver_and_columns(spark):
    rows = spark.range(50).select("id", hash_uniform("s", "id").alias("u"), hash_normal("s", "id").alias("z"))
    for r in rows.collect():
        assert math.isclose(r["u"], uniform_draw("s", r["id"]), rel_tol=1e-12)
        assert math.isclose(r["z"], normal_draw("s", r["id"]), rel_tol=1e-9, abs_tol=1e-12)


def test_mode_ties_go_to_the_first_met(spark):
    df = spark.createDataFrame([("g", "b", 1), ("g", "a", 2), ("g", "a", 3), ("g", "b", 4)], "g string, v string, o int")
    assert aggregates.mode(df, ["g"], "v", "o").first()["mode"] == "b"


def test_weighted_aggregates(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 1.0, 1), (1, 1.0, 2.0, 2), (1, 9.0, 1.5, 3), (2, 4.0, 0.0, 1)],
        "g int, v double, w double, o int")
    means = {r["g"]: r["m"] for r in df.groupBy("g").agg(
        aggregates.weighted_mean(F.col("v"), F.col("w")).alias("m")).collect()}
    assert math.isclose(means[1], 20.5 / 4.5) and means[2] == 0.0
    # walking in the given order, half of 4.5 is reached at the second value
    for few in (True, False):
        walk = aggregates.weighted_median_of_few if few else aggregates.weighted_median
        walked = walk(df, ["g"], "v", "w", "o" if few else ["o"])
        assert {r["g"]: r["median"] for r in walked.collect()} == {1: 1.0, 2: 4.0}
        by_value = df.withColumn("s", F.struct("v", "o"))
        sorted_ = walk(by_value, ["g"], "v", "w", "s" if few else ["v", "o"])
        assert {r["g"]: r["median"] for r in sorted_.collect()}[1] == 5.0
    heavy = {r["g"]: r["mode"] for r in aggregates.heaviest(df, ["g"], "v", "w", "o").collect()}
    assert heavy == {1: 1.0, 2: 4.0}


def test_weighted_median_of_one_hot_group(spark):
    rng = np.random.default_rng(5)
    v, w = rng.normal(size=3000), rng.integers(1, 9, 3000)
    rows = [("hot" if i < 2900 else f"g{i % 7}", float(a), float(b), i) for i, (a, b) in enumerate(zip(v, w))]
    df = spark.createDataFrame(rows, "g string, v double, w double, o int").repartition(6)
    got = {r["g"]: r["median"] for r in aggregates.weighted_median(df, ["g"], "v", "w", ["o"]).collect()}
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g]
        run = np.cumsum([r[2] for r in mine])
        assert got[g] == mine[int((run >= run[-1] / 2).argmax())][1]


def test_gini(spark):
    df = spark.createDataFrame([(0, 0), (5, 5), (4, 0)], "a long, b long")
    got = [r[0] for r in df.select(aggregates.gini([F.col("a"), F.col("b")])).collect()]
    assert got == [0.0, 0.5, 0.0]
    row = df.limit(1).select(aggregates.weighted_gini(
        [F.lit(3), F.lit(1)], [F.lit(0), F.lit(4)])).first()
    assert math.isclose(row[0], 4 / 8 * (1 - (9 + 1) / 16))


def test_missing_values_are_dropped_and_counted(spark):
    df = spark.createDataFrame(
        [(1.0, [1.0]), (None, [1.0]), (float("nan"), [1.0]), (2.0, [float("nan")]), (3.0, None)],
        "a double, v array<double>")
    assert checks.usable_rows(df, ["a", "v"]).count() == 1
    assert tuple(checks.missing_report(df, ["a", "v"]).first()) == (5, 4)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    y, p = np.array([1, 2, 4.0]), np.array([1.5, 2, 3.0])
    assert math.isclose(metrics.error(df, "y", "p", "mse").first()[0], ((y - p) ** 2).mean())
    assert math.isclose(metrics.error(df, "y", "p", "mae").first()[0], abs(y - p).mean())
    assert math.isclose(metrics.error(df, "y", "p", "rmse").first()[0], ((y - p) ** 2).mean() ** 0.5)
    for name in ("R2", "R_squared"):
        assert math.isclose(metrics.fit_metric(df, "y", "p", name).first()[0],
                            1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    with pytest.raises(ValueError):
        metrics.error(df, "y", "p", "mape")
    with pytest.raises(ValueError):
        metrics.fit_metric(df, "y", "p", "MAE")


def test_histogram_keeps_every_row(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 2, 9, 10]], "x double")
    assert {r["bin"]: r["n"] for r in metrics.histogram(df, "x", 5).collect()} == {1: 2, 2: 2, 3: 0, 4: 0, 5: 2}
    flat = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert sorted(tuple(r) for r in metrics.histogram(flat, "x", 5).collect()) == [
        (1, 3.0, 4), *[(b, 3.0, 0) for b in range(2, 6)]]


def test_weighted_median_with_weights_that_do_not_add_up_evenly(spark):
    # sums of tenths depend on their order; no group may be lost at exactly half
    rows = [(g, i, 0.1 * (1 + (g * i) % 7)) for g in range(40) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, o int, w double").withColumn("v", F.col("o")).repartition(7)
    assert aggregates.weighted_median(df, ["g"], "v", "w", ["o"]).count() == 40


def test_quantiles_skip_nan_and_refuse_infinity(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,), (2.0,), (3.0,)], "a double")
    assert quantiles.exact_quantiles(df, ["a"], [0.5, 1.0])["a"] == [2.0, 3.0]
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(df.unionByName(spark.createDataFrame([(float("-inf"),)], "a double")), ["a"], [0.5])


def test_more_than_two_values(spark):
    assert not aggregates.more_than_two_values(spark.createDataFrame([(0,), (1,), (None,)], "y int"), "y")
    assert aggregates.more_than_two_values(spark.range(3), "id")


def test_principal_components(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3)) @ np.diag([5.0, 1.0, 0.1]) + 100
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    projected, model = scaling.principal_components(df, ["a", "b", "c"], 2)
    got = np.array([r["components"].toArray() for r in projected.collect()])
    centred = x - x.mean(0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(centred @ vt[:2].T), atol=1e-8)
    assert model.explainedVariance[0] > 0.9


def test_quantiles_take_few_passes_whatever_the_spread(spark, monkeypatch):
    values = [1e300, -1e300, 5e-324, -0.0, 0.0, 1.0, 1.0000000000000002, -3.5, 2.0, 7.25, 1e-300]
    df = spark.createDataFrame([(v,) for v in values * 3], "a double").repartition(3)
    passes, count = [], quantiles._count_bits
    monkeypatch.setattr(quantiles, "_count_bits", lambda *a: passes.append(1) or count(*a))
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    assert quantiles.exact_quantiles(df, ["a"], shares)["a"] == pytest.approx(list(np.quantile(values * 3, shares)))
    assert len(passes) <= 4


def test_group_medians(spark):
    rng = np.random.default_rng(3)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 999), (None, 40)) for v in rng.normal(size=n) * 10.0 ** rng.integers(-9, 9)]
    rows += [("d", None), ("d", float("nan")), ("e", -0.0), ("e", 0.0), ("e", 1e300), ("e", -1e300)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r["median"] for r in quantiles.group_median(df, "g", "v").collect()}
    want = {g: np.median([v for h, v in rows if h == g]) for g in ("a", "b", "c", "e", None)}
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g]) for g in want)
    assert quantiles.group_median(df.limit(0), "g", "v").collect() == []
