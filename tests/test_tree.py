import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kelpfit.operators import tree
from kelpfit.operators.tree import DecisionTree, RegressionTree


def gini(y):
    return 1 - sum((y == c).mean() ** 2 for c in np.unique(y)) if len(y) else 0.0


def ssr(y):
    return ((y - y.mean()) ** 2).sum() if len(y) else 0.0


def grow(columns, y, depth, least, regression=False, reuse=False):
    """Try every split of every node, in plain loops. Returns path -> (n, split)."""
    out = {}

    def score(mask, y):
        if regression:
            return ssr(y[mask]) + ssr(y[~mask])
        return (mask.sum() * gini(y[mask]) + (~mask).sum() * gini(y[~mask])) / len(y)

    def node(path, rows, used):
        target, best = y[rows], None
        if len(path) < depth and len(rows) >= least:
            for name, x in columns.items():
                if name in used and not reuse:
                    continue
                v = x[rows]
                values = np.unique(v)
                if v.dtype.kind in "OU":
                    options = [("text", c, v == c) for c in values] if len(values) > 1 else []
                    if set(values) <= {"Yes", "No"}:
                        options = [("text", "Yes", v == "Yes")]
                elif regression:
                    options = [("number", c, v < c) for c in values[1:]]
                else:
                    options = [("number", (a + b) / 2, v <= (a + b) / 2) for a, b in zip(values, values[1:])]
                for kind, cut, mask in options:
                    s = round(score(mask, target), 9)
                    if best is None or s < best[0]:
                        best = (s, name, cut, mask)
            limit = ssr(target) if regression else gini(target)
            if best is not None and round(limit, 9) < best[0]:
                best = None
        out[path] = (len(rows), None if best is None else (best[1], best[2]))
        if best:
            for step, mask in (("L", best[3]), ("R", ~best[3])):
                if mask.any():
                    node(path + step, rows[mask], used | {best[1]})

    node("", np.arange(len(y)), frozenset())
    return out


def shape(model):
    return {n.path: (n.n, None if n.feature is None else (
        n.feature, n.threshold if n.kind == "continuous" else n.value)) for n in model.nodes}


def same(a, b):
    assert a.keys() == b.keys()
    for path in a:
        assert a[path][0] == b[path][0]
        if a[path][1] is None or isinstance(a[path][1][1], str):
            assert a[path][1] == b[path][1]
        else:
            assert a[path][1][0] == b[path][1][0]
            assert np.isclose(a[path][1][1], b[path][1][1])


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(11)
    n = 400
    columns = {
        "age": np.concatenate([np.full(n // 3, 40.0), rng.integers(15, 75, n - n // 3).astype(float)]),
        "ratio": rng.normal(15, 6, n).round(3),
        "pressure": rng.choice(["HIGH", "LOW", "NORMAL"], n),
        "flag": rng.choice(["Yes", "No"], n),
    }
    score = columns["ratio"] + 8 * (columns["pressure"] == "HIGH") - 0.1 * columns["age"]
    drug = np.where(score > 14, "Y", np.where(columns["flag"] == "Yes", "A", "X"))
    df = spark.createDataFrame(
        [(float(a), float(r), str(p), str(f), str(d), float(s)) for a, r, p, f, d, s in zip(
            *columns.values(), drug, score)],
        "age double, ratio double, pressure string, flag string, drug string, score double")
    return columns, drug, score, df.repartition(5).cache()


@pytest.mark.parametrize("ranges", [128, 4, 1])
def test_classes_match_exhaustive_growth(mixed, ranges):
    columns, drug, _, df = mixed
    model = DecisionTree(max_depth=4, num_min_samples=10, ranges=ranges).fit(df, list(columns), "drug")
    same(shape(model), grow(columns, drug, 4, 10))


@pytest.mark.parametrize("ranges", [128, 3])
def test_values_match_exhaustive_growth(mixed, ranges):
    columns, _, score, df = mixed
    model = RegressionTree(max_depth=3, ranges=ranges).fit(df, list(columns), "score")
    same(shape(model), grow(columns, score, 3, 2, regression=True))


def test_features_may_be_used_again_on_request(mixed):
    columns, drug, _, df = mixed
    model = DecisionTree(max_depth=3, num_min_samples=10, reuse_features=True).fit(df, ["ratio", "age"], "drug")
    same(shape(model), grow({k: columns[k] for k in ("ratio", "age")}, drug, 3, 10, reuse=True))
    with pytest.raises(ValueError):
        DecisionTree(reuse_features=True)


def test_first_split_agrees_with_mllib(mixed):
    _, _, _, df = mixed
    binary = df.withColumn("y", (F.col("drug") == "Y").cast("int")).repartition(1)
    ours = DecisionTree(max_depth=1).fit(binary, ["ratio"], "y")
    assembled = VectorAssembler(inputCols=["ratio"], outputCol="v").transform(binary)
    other = DecisionTreeClassifier(maxDepth=1, maxBins=512, featuresCol="v", labelCol="y").fit(assembled)
    hits = [m.transform(d).where(F.col("prediction") == F.col("y")).count()
            for m, d in ((ours, binary), (other, assembled))]
    assert hits[0] == hits[1]


def test_predictions_walk_the_tree(mixed):
    columns, drug, score, df = mixed
    model = DecisionTree(max_depth=3, num_min_samples=10).fit(df, list(columns), "drug")
    by_path = {n.path: n for n in model.nodes}
    for r in model.node_paths(model.transform(df)).limit(50).collect():
        assert by_path[r["path"]].prediction == r["prediction"]
    counts = {r["path"]: r["count"] for r in model.node_paths(df).groupBy("path").count().collect()}
    table = {r["path"]: r for r in model.node_table(df.sparkSession).collect()}
    assert counts == {p: r["n"] for p, r in table.items() if r["is_leaf"]}
    assert table[""]["class_counts"] == {c: int((drug == c).sum()) for c in np.unique(drug)}
    assert all(r["stop"] for p, r in table.items() if r["is_leaf"])
    regression = RegressionTree(max_depth=2).fit(df, ["ratio", "pressure"], "score")
    means = regression.transform(df).groupBy("prediction").agg(F.avg("score").alias("m")).collect()
    assert all(np.isclose(r["prediction"], r["m"]) for r in means)


ROWS = "a string, b string, y string"


def test_unknown_value_keeps_the_node_majority(spark):
    df = spark.createDataFrame([("Yes", "No", "p")] * 3 + [("No", "Yes", "q")] * 2, ROWS)
    model = DecisionTree(max_depth=1, num_min_samples=1).fit(df, ["a", "b"], "y")
    new = spark.createDataFrame([("Yes",), ("No",), ("maybe",), (None,)], "a string").withColumn("b", F.lit("No"))
    assert [r["prediction"] for r in model.transform(new).collect()] == ["p", "q", "p", "p"]


def test_missing_child_keeps_the_node_majority(spark):
    df = spark.createDataFrame([("Yes", "No", "p")] * 3 + [("Yes", "No", "q")] * 2, ROWS)
    model = DecisionTree(max_depth=1, num_min_samples=1).fit(df, ["a"], "y")
    assert [n.path for n in model.nodes] == ["", "L"]
    new = spark.createDataFrame([("No",)], "a string")
    assert model.transform(new).first()["prediction"] == "p"


def test_pure_nodes_split_on_unless_told_to_stop(spark):
    df = spark.createDataFrame([("Yes", "No", "p"), ("No", "Yes", "p")] * 2, ROWS)
    assert len(DecisionTree(max_depth=2, num_min_samples=1).fit(df, ["a", "b"], "y").nodes) == 5
    stopped = DecisionTree(max_depth=2, num_min_samples=1, stop_when_pure=True).fit(df, ["a", "b"], "y")
    assert [n.stop for n in stopped.nodes] == ["pure"]


def test_constant_feature_makes_a_leaf(spark):
    df = spark.createDataFrame([(1.0, "u", 0), (1.0, "u", 1)] * 10, "x double, c string, y int")
    model = DecisionTree(max_depth=2, num_min_samples=1).fit(df, ["x", "c"], "y")
    assert [(n.path, n.stop, n.prediction) for n in model.nodes] == [("", "no better split", 0)]
    assert model.transform(df).schema["prediction"].dataType.simpleString() == "int"


def test_small_nodes_are_leaves(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(10)], "x double, y int")
    model = DecisionTree(max_depth=3, num_min_samples=11).fit(df, ["x"], "y")
    assert [n.stop for n in model.nodes] == ["too few rows"]


def test_rows_with_missing_values_are_left_out(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (None, 1), (float("nan"), 1), (3.0, None)], "x double, y int")
    model = DecisionTree(max_depth=1, num_min_samples=1).fit(df, ["x"], "y")
    assert shape(model)[""] == (2, ("x", 1.5))
    assert model.transform(df.where("x is null")).first()["prediction"] == 0


def test_bad_settings(spark):
    for bad in (dict(max_depth=0), dict(num_min_samples=0), dict(ranges=0)):
        with pytest.raises(ValueError):
            DecisionTree(**bad)
    df = spark.createDataFrame([(1.0, 0)], "x double, y int")
    with pytest.raises(ValueError):
        DecisionTree().fit(df, ["z"], "y")
    with pytest.raises(ValueError):
        DecisionTree().fit(df.limit(0), ["x"], "y")
    with pytest.raises(TypeError):
        DecisionTree().fit(df.withColumn("t", F.current_timestamp()), ["t"], "y")


def test_splits_below_a_heavy_tail_are_the_best_ones(spark):
    rows = [(float(i < 20), float(i % 40), float(i % 10), 1e7 if i < 20 else float(i % 10 >= 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "g double, x1 double, x2 double, y double")
    nodes = {n.path: n for n in RegressionTree(max_depth=2).fit(df, ["g", "x1", "x2"], "y").nodes}
    assert (nodes[""].feature, nodes["L"].feature, nodes["L"].threshold) == ("g", "x2", 5.0)
    assert nodes["L"].score == pytest.approx(0.0, abs=1e-6)
    assert nodes["L"].impurity == pytest.approx(95.0)
    assert nodes["LL"].impurity == nodes["LR"].impurity == pytest.approx(0.0, abs=1e-6)


def test_a_heavy_tailed_feature(spark):
    x = np.concatenate([np.arange(2000) / 1e6, 10.0 ** np.arange(0, 40, 2)])
    y = (x > 0.0015).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(4)
    root = RegressionTree(max_depth=1, ranges=4).fit(df, ["x"], "y").nodes[0]
    assert root.threshold == 0.001501 and root.score == pytest.approx(0.0, abs=1e-9)


def test_more_classes_than_columns_could_hold(spark):
    rng = np.random.default_rng(8)
    n = 6000
    columns = {"x": rng.integers(0, 300, n).astype(float), "z": rng.normal(size=n).round(2),
               "c": rng.choice(["u", "v", "w"], n)}
    y = (columns["x"] // 10 * 50 + rng.integers(0, 1500, n)).astype(int)
    rows = [(float(a), float(b), str(c), int(d)) for a, b, c, d in zip(*columns.values(), y)]
    df = spark.createDataFrame(rows, "x double, z double, c string, y int").repartition(6).cache()
    model = DecisionTree(max_depth=2, num_min_samples=20, ranges=8).fit(df, list(columns), "y")
    assert len(np.unique(y)) > 1400

    def counted(mask):
        values, counts = np.unique(y[mask], return_counts=True)
        return dict(zip(values.tolist(), counts.tolist()))

    def impurity(mask):
        counts = np.array(list(counted(mask).values()), float)
        return 1 - (counts ** 2).sum() / counts.sum() ** 2

    table = {r["path"]: r for r in model.node_table(spark).collect()}
    root, every = table[""], np.ones(n, bool)
    best = min(
        [(round((m.sum() * impurity(m) + (~m).sum() * impurity(~m)) / n, 10), f, t) for f, t, m in
         [(0, t, columns["x"] <= t) for t in np.unique(columns["x"])[:-1] + 0.5]
         + [(1, (a + b) / 2, columns["z"] <= (a + b) / 2) for a, b in zip(np.unique(columns["z"]), np.unique(columns["z"])[1:])]
         + [(2, v, columns["c"] == v) for v in ("u", "v", "w")]], key=lambda b: b[:2])
    assert root["feature"] == list(columns)[best[1]] and root["score"] == pytest.approx(best[0], abs=1e-9)
    assert (root["threshold"] if root["value"] is None else root["value"]) == pytest.approx(best[2])
    assert root["impurity"] == pytest.approx(impurity(every))
    assert {int(k): v for k, v in root["class_counts"].items()} == counted(every)
    for path, r in table.items():
        most = max(r["class_counts"].values())
        assert int(r["prediction"]) == min(int(k) for k, v in r["class_counts"].items() if v == most)


def test_a_deep_tree_is_walked_without_nested_expressions(spark):
    """Sixteen levels of halving: the path of a number is its binary digits."""
    from kelpfit.operators.tree import Node, TreeModel
    from pyspark.sql import types as T

    nodes, depth = [], 16
    for level in range(depth + 1):
        width = 1 << (depth - level)
        for i in range(1 << level) if level < 9 else {0, (1 << level) - 1, 5 << (level - 3)}:
            path = format(i, f"0{level}b").replace("0", "L").replace("1", "R") if level else ""
            split = level < depth
            nodes.append(Node(path, width, (), i, 0.0, "x" if split else None, "continuous" if split else None,
                              (i * width + width / 2 - 0.5) if split else None))
    model = TreeModel(("x",), "y", sorted(nodes, key=lambda n: n.path), {"x": "continuous"}, prediction_type=T.LongType())
    df = spark.range(1 << depth).withColumn("x", F.col("id").cast("double"))
    plan = model.transform(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in plan and len(plan) < 5000
    known = {n.path for n in nodes}
    for r in model.node_paths(model.transform(df)).where("id % 997 = 0 or id > 65530 or id < 5").collect():
        bits = format(r["id"], f"0{depth}b").replace("0", "L").replace("1", "R")
        want = next(bits[:k] for k in range(depth, -1, -1) if all(bits[:j] in known for j in range(k + 1)))
        assert r["path"] == want


def test_labels_of_other_types(spark):
    rows = [(float(i), i % 7 < 3, f"2020-01-{1 + i // 20:02d}") for i in range(100)]
    df = spark.createDataFrame(rows, "x double, b boolean, d string").withColumn("d", F.col("d").cast("date"))
    for label in ("b", "d"):
        model = DecisionTree(max_depth=2, num_min_samples=5, reuse_features=True).fit(df, ["x"], label)
        assert model.transform(df).schema["prediction"].dataType == df.schema[label].dataType
    assert model.transform(df).where("prediction = d").count() >= 60


@pytest.fixture(scope="module")
def noise(spark):
    rng = np.random.default_rng(5)
    n = 3000
    columns = {"x": np.where(rng.random(n) < 0.3, 5.0, rng.normal(size=n).round(3)), "z": rng.integers(0, 40, n).astype(float),
               "c": rng.choice(["u", "v", "w"], n)}
    y = rng.integers(0, 700, n)
    rows = [(float(a), float(b), str(c), f"k{d:04d}") for a, b, c, d in zip(*columns.values(), y)]
    return columns, y, spark.createDataFrame(rows, "x double, z double, c string, y string").repartition(5).cache()


@pytest.mark.parametrize("cells", [8, 1 << 17])
def test_dealt_classes_match_exhaustive_growth(noise, monkeypatch, cells):
    columns, y, df = noise
    monkeypatch.setattr(tree, "CELLS", cells)
    model = DecisionTree(max_depth=3, num_min_samples=20, ranges=4).fit(df, list(columns), "y")
    same(shape(model), grow(columns, y, 3, 20))
    monkeypatch.setattr(tree, "WHOLE_ROWS", 2)  # classes as rows, as for a class too large for one task
    assert DecisionTree(max_depth=3, num_min_samples=20, ranges=4).fit(df, list(columns), "y").nodes == model.nodes


def test_sums_by_range_not_by_class_are_shuffled(noise):
    columns, y, df = noise
    measure, _ = DecisionTree()._measures(df.withColumnRenamed("y", "_y"))
    assert not measure.by_class
    with_counts = DecisionTree(max_depth=1).fit(df, ["x"], "y").node_table(df.sparkSession)
    table = with_counts.select("path", "n_classes")
    assert "collect_list" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert {r["path"]: r["n_classes"] for r in table.collect()} == {
        r["path"]: len(r["class_counts"]) for r in with_counts.collect()}


@pytest.mark.parametrize("cells", [6, 1 << 17])
def test_few_classes_match_exhaustive_growth(noise, monkeypatch, cells):
    columns, y, df = noise
    monkeypatch.setattr(tree, "CELLS", cells)
    model = DecisionTree(max_depth=3, num_min_samples=20, reuse_features=True).fit(
        df.withColumn("y", F.substring("y", 3, 1)).where("y < '4'"), list(columns), "y")
    on = y // 100 % 10 < 4
    kept = {c: v[on] for c, v in columns.items()}
    same(shape(model), grow(kept, y[on] // 100 % 10, 3, 20, reuse=True))
    assert all(sum(n.stats) == n.n for n in model.nodes)


def test_noise_is_not_looked_into_value_by_value(spark, monkeypatch):
    rows = spark.range(200_000).selectExpr(
        "xxhash64(id) / 1e18D AS x", "xxhash64(id, 1) / 1e18D AS z", "cast(pmod(xxhash64(id, 2), 3) AS int) AS y")
    asked, look = [], tree._Fit._between_values

    def spy(self, counter, wanted, rows, *more, **named):
        asked.append(rows)
        return look(self, counter, wanted, rows, *more, **named)

    monkeypatch.setattr(tree._Fit, "_between_values", spy)
    DecisionTree(max_depth=2, num_min_samples=20).fit(rows, ["x", "z"], "y")
    assert sum(asked) < 40_000  # of 200,000 rows by two features and levels


@pytest.mark.parametrize("cells", [0, 1500])
def test_subtrees_grown_in_one_task_are_those_of_the_levels(noise, monkeypatch, cells):
    """All levels as passes, and small nodes in tasks; above the whole tree grows in one task."""
    columns, y, df = noise
    monkeypatch.setattr(tree, "WHOLE_CELLS", cells)
    y = y // 100 % 10
    on = y < 4
    kept = {c: v[on] for c, v in columns.items()}
    df = df.withColumn("y", F.substring("y", 3, 1)).where("y < '4'")
    model = DecisionTree(max_depth=4, num_min_samples=20, reuse_features=True).fit(df, list(columns), "y")
    same(shape(model), grow(kept, y[on], 4, 20, reuse=True))
    assert all(sum(n.stats) == n.n for n in model.nodes)


def test_nodes_do_not_depend_on_where_they_grow(spark, monkeypatch):
    """Ties, pure nodes, yes/no features, other words, zeros of both signs and infinite values."""
    rng = np.random.default_rng(12)
    n = 900
    rows = list(zip(rng.choice([0.0, -0.0, 1.0, 2.5, 1e300], n).tolist(), rng.integers(0, 60, n).tolist(),
                    rng.choice(["Yes", "No"], n).tolist(), rng.choice(["ä", "b", "", "Z"], n).tolist()))
    rows = [(*r, "p" if r[1] > 50 or r[2] == "Yes" and r[0] > 1 and rng.random() < 0.9 else "q") for r in rows] * 2
    rows += [(None, 1, "Yes", "b", "p"), (1.0, 2, None, "b", "q"), (float("inf"), 5, "No", "b", "p")]
    df = spark.createDataFrame(rows, "x double, i int, w string, c string, y string").repartition(3).cache()
    for settings in (dict(reuse_features=True, max_depth=4), dict(stop_when_pure=True)):
        grower = DecisionTree(num_min_samples=15, **settings)
        model = grower.fit(df, ["x", "i", "w", "c"], "y")
        with monkeypatch.context() as patch:
            patch.setattr(tree, "WHOLE_CELLS", 0)
            levels = grower.fit(df, ["x", "i", "w", "c"], "y")
        assert model.nodes == levels.nodes and len(model.nodes) > 5
        assert model.node_table(spark).collect() == levels.node_table(spark).collect()


def test_a_deep_tree_of_a_small_table_takes_few_jobs(noise):
    columns, _, df = noise
    df = df.withColumn("y", F.substring("y", 3, 1)).where("y < '4'")
    context = df.sparkSession.sparkContext
    df.count()
    try:
        context.setJobGroup("deep", "deep tree")
        model = DecisionTree(max_depth=10, num_min_samples=20, reuse_features=True).fit(df, list(columns), "y")
        jobs = len(context.statusTracker().getJobIdsForGroup("deep"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert max(len(n.path) for n in model.nodes) == 10
    assert jobs < 20  # six a level before


def test_large_nodes_are_not_looked_into_value_by_value(spark, monkeypatch):
    """As above where no task holds a node."""
    monkeypatch.setattr(tree, "WHOLE_CELLS", 0)
    test_noise_is_not_looked_into_value_by_value(spark, monkeypatch)
