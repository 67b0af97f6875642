"""K-means on customers: account balance and nation, standardised column by column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.functions.distance import METRICS
from kelpfit.operators.kmeans import KMeans, KMeansModel, without_points
from kelpfit.plans.registry import Tables, query, rounded

FEATURES = ["c_acctbal", "c_nationkey"]
K = 4
SEED = 17

POINTS_SQL = """
WITH s AS (
  SELECT avg(c_acctbal) AS m0, stddev_pop(c_acctbal) AS d0,
         avg(c_nationkey) AS m1, stddev_pop(c_nationkey) AS d1 FROM customer
), p AS (
  SELECT c_custkey, (c_acctbal - m0) / d0 AS x0, (c_nationkey - m1) / d1 AS x1 FROM customer, s
)"""
GAP_SQL = {
    "euclidean": "sqrt((p.x0 - c.x0) * (p.x0 - c.x0) + (p.x1 - c.x1) * (p.x1 - c.x1))",
    "manhattan": "abs(p.x0 - c.x0) + abs(p.x1 - c.x1)",
    "squared_euclidean": "(p.x0 - c.x0) * (p.x0 - c.x0) + (p.x1 - c.x1) * (p.x1 - c.x1)",
    "canberra": "coalesce(abs(p.x0 - c.x0) / nullif(abs(p.x0) + abs(c.x0), 0), 0)"
                " + coalesce(abs(p.x1 - c.x1) / nullif(abs(p.x1) + abs(c.x1), 0), 0)",
}


def farthest_sql(metric: str = "euclidean") -> str:
    """Chained start: a seeded row, then three times the row farthest from all before."""
    sql = POINTS_SQL + f""", f0 AS MATERIALIZED (
  SELECT 0 AS c, x0, x1 FROM p ORDER BY md5('{SEED}:' || c_custkey) LIMIT 1)"""
    for i in range(1, K):
        before = " UNION ALL ".join(f"SELECT * FROM f{j}" for j in range(i))
        sql += f""", f{i} AS MATERIALIZED (
  SELECT {i} AS c, x0, x1 FROM (
    SELECT p.c_custkey, p.x0, p.x1, min({GAP_SQL[metric]}) AS gap
    FROM p, ({before}) c GROUP BY ALL) ORDER BY gap DESC, c_custkey LIMIT 1)"""
    every = " UNION ALL ".join(f"SELECT * FROM f{j}" for j in range(K))
    return sql + f", c0 AS MATERIALIZED ({every})"


def random_sql() -> str:
    return POINTS_SQL + f""", c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY md5('{SEED}:' || c_custkey)) - 1 AS c, x0, x1 FROM p
  QUALIFY row_number() OVER (ORDER BY md5('{SEED}:' || c_custkey)) <= {K})"""


def iterations_sql(steps: int, metric: str = "euclidean") -> str:
    """Assignments a1.. and centroids c1.., each from the ones before."""
    sql = ""
    for i in range(1, steps + 1):
        sql += f""", a{i} AS MATERIALIZED (
  SELECT p.c_custkey, p.x0, p.x1, c.c FROM p, c{i - 1} c
  QUALIFY row_number() OVER (PARTITION BY p.c_custkey ORDER BY {GAP_SQL[metric]}, c.c) = 1)
, c{i} AS MATERIALIZED (
  SELECT c.c, coalesce(avg(a.x0), any_value(c.x0)) AS x0, coalesce(avg(a.x1), any_value(c.x1)) AS x1
  FROM c{i - 1} c LEFT JOIN a{i} a ON a.c = c.c GROUP BY c.c)"""
    return sql


def fitted(t: Tables, steps: int, metric: str = "euclidean", method: str = "kmeans++",
           trace: bool = False) -> KMeansModel:
    settings = KMeans(k=K, max_iter=steps, cluster_method=method, distance_metric=metric, random_state=SEED)
    return settings.fit(t.customer, FEATURES, "c_custkey", "standardization", scope="column", trace=trace)


def _flat(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, rounded(F.col("features")[0], 6, "x0"), rounded(F.col("features")[1], 6, "x1"))


@query("kmeans_init_farthest", farthest_sql() + """
SELECT CAST(s.step AS INTEGER) AS step, CAST(c AS INTEGER) AS centroid_no, c = s.step - 1 AS is_new,
       round(x0, 6) AS x0, round(x1, 6) AS x1
FROM c0, range(1, 5) AS s(step) WHERE c < s.step""")
def init_farthest(t: Tables) -> DataFrame:
    return _flat(fitted(t, 1).start_trace(t.spark), "step", "centroid_no", "is_new")


@query("kmeans_init_random", random_sql() + """
SELECT CAST(s.step AS INTEGER) AS step, CAST(c AS INTEGER) AS centroid_no, c = s.step - 1 AS is_new,
       round(x0, 6) AS x0, round(x1, 6) AS x1
FROM c0, range(1, 5) AS s(step) WHERE c < s.step""")
def init_random(t: Tables) -> DataFrame:
    return _flat(fitted(t, 1, method="random").start_trace(t.spark), "step", "centroid_no", "is_new")


def _assign_query(metric: str):
    def run(t: Tables) -> DataFrame:
        return fitted(t, 2, metric, "random").assignments(t.customer).select("c_custkey", "cluster")

    return run


for _metric in METRICS:
    query(f"kmeans_assign_{_metric}", random_sql() + iterations_sql(2, _metric) + """
SELECT c_custkey, CAST(c AS INTEGER) AS cluster FROM a2""")(_assign_query(_metric))


@query("kmeans_iter3", farthest_sql() + iterations_sql(3) + """
SELECT CAST(c AS INTEGER) AS cluster, round(x0, 6) AS x0, round(x1, 6) AS x1 FROM c3""")
def iterate(t: Tables) -> DataFrame:
    return _flat(fitted(t, 3).centroid_table(t.spark), "cluster")


@query("kmeans_sizes", farthest_sql() + iterations_sql(3) + """
SELECT CAST(c AS INTEGER) AS cluster, count(*) AS n FROM a3 GROUP BY c""")
def sizes(t: Tables) -> DataFrame:
    return fitted(t, 3).cluster_sizes(t.customer)


def _trace_part(i: int) -> str:
    moved = "count(a.c)" if i == 1 else "coalesce(sum((a.c <> b.c)::INT), 0)"
    before = "" if i == 1 else f"LEFT JOIN a{i - 1} b ON b.c_custkey = a.c_custkey"
    return f"""
SELECT {i}::INTEGER AS iteration, CAST(c.c AS INTEGER) AS cluster, round(any_value(c.x0), 6) AS x0,
       round(any_value(c.x1), 6) AS x1, count(a.c) AS n, CAST({moved} AS BIGINT) AS changed
FROM c{i - 1} c LEFT JOIN a{i} a ON a.c = c.c {before} GROUP BY c.c"""


@query("kmeans_trace", farthest_sql() + iterations_sql(4) + " UNION ALL ".join(
    _trace_part(i) for i in range(1, 5)))
def trace(t: Tables) -> DataFrame:
    return _flat(fitted(t, 4, trace=True).iteration_trace(t.spark), "iteration", "cluster", "n", "changed")


@query("kmeans_predict", farthest_sql() + iterations_sql(2) + """
, q AS (SELECT s_suppkey AS c_custkey, (s_acctbal - m0) / d0 AS x0, (s_nationkey - m1) / d1 AS x1
        FROM supplier, s)
SELECT p.c_custkey AS s_suppkey, CAST(c.c AS INTEGER) AS cluster FROM q p, c2 c
QUALIFY row_number() OVER (PARTITION BY p.c_custkey ORDER BY """ + GAP_SQL["euclidean"] + ", c.c) = 1")
def predict(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(
        "s_suppkey", F.col("s_acctbal").alias("c_acctbal"), F.col("s_nationkey").alias("c_nationkey"))
    return fitted(t, 2).transform(suppliers).select("s_suppkey", "cluster")


@query("kmeans_other_points", random_sql() + """
SELECT p.c_custkey FROM p LEFT JOIN c0 ON abs(p.x0 - c0.x0) < 1e-9 AND abs(p.x1 - c0.x1) < 1e-9
WHERE c0.c IS NULL""")
def other_points(t: Tables) -> DataFrame:
    model = fitted(t, 1, method="random")
    scaled = model.scaler.transform(t.customer)
    return without_points(scaled, FEATURES, model.start).select("c_custkey")


ITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ITEM_K, ITEM_STEPS = 8, 25


def _item_gap(c: str) -> str:
    return "sqrt(" + " + ".join(f"(x{j} - {c}_{j}) * (x{j} - {c}_{j})" for j in range(4)) + ")"


def _item_sql() -> str:
    """Centroids travel as one wide row per step; every step reads the one before."""
    lows = ", ".join(f"min({c}) AS lo{j}, max({c}) AS hi{j}" for j, c in enumerate(ITEM_FEATURES))
    scaled = ", ".join(f"({c} - lo{j}) / (hi{j} - lo{j}) AS x{j}" for j, c in enumerate(ITEM_FEATURES))
    sql = f"""
WITH s AS (SELECT {lows} FROM lineitem), p AS MATERIALIZED (
  SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS item, {scaled} FROM lineitem, s)
, f0 AS MATERIALIZED (
  SELECT x0 AS c0_0, x1 AS c0_1, x2 AS c0_2, x3 AS c0_3 FROM p ORDER BY md5('{SEED}:' || item) LIMIT 1)"""
    for i in range(1, ITEM_K):
        gaps = ", ".join(_item_gap(f"c{c}") for c in range(i))
        gap = f"least({gaps})" if i > 1 else gaps
        sql += f""", f{i} AS MATERIALIZED (
  SELECT f{i - 1}.*, x0 AS c{i}_0, x1 AS c{i}_1, x2 AS c{i}_2, x3 AS c{i}_3
  FROM p, f{i - 1} ORDER BY {gap} DESC, item LIMIT 1)"""
    sql += f", m0 AS (SELECT * FROM f{ITEM_K - 1})"
    gaps = ", ".join(f"{_item_gap(f'c{c}')} AS g{c}" for c in range(ITEM_K))
    least = "least(" + ", ".join(f"g{c}" for c in range(ITEM_K)) + ")"
    pick = "CASE " + " ".join(f"WHEN g{c} = {least} THEN {c}" for c in range(ITEM_K)) + " END"
    for i in range(1, ITEM_STEPS + 1):
        sql += f""", a{i} AS MATERIALIZED (
  SELECT *, {pick} AS cluster FROM (SELECT item, x0, x1, x2, x3, {gaps} FROM p, m{i - 1}))"""
        if i < ITEM_STEPS:
            means = ", ".join(
                f"coalesce(avg(a.x{j}) FILTER (cluster = {c}), any_value(m.c{c}_{j})) AS c{c}_{j}"
                for c in range(ITEM_K) for j in range(4))
            sql += f", m{i} AS MATERIALIZED (SELECT {means} FROM a{i} a, m{i - 1} m)"
    return sql + f" SELECT item, CAST(cluster AS INTEGER) AS cluster FROM a{ITEM_STEPS}"


@query("kmeans_converged", _item_sql())
def converged(t: Tables) -> DataFrame:
    """Line items to their final clusters, run until no row moves or 25 passes."""
    items = t.spread("lineitem").withColumn(
        "item", F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    model = KMeans(k=ITEM_K, max_iter=ITEM_STEPS, random_state=SEED).fit(
        items, ITEM_FEATURES, "item", "min_max", scope="column")
    return model.assignments(items).select("item", "cluster")


@query("kmeans_members", farthest_sql() + iterations_sql(3) + " UNION ALL ".join(
    f"\nSELECT {i} AS iteration, CAST(c AS INTEGER) AS cluster, c_custkey FROM a{i}" for i in (1, 2, 3)))
def members(t: Tables) -> DataFrame:
    """Members of every cluster in each of three iterations."""
    return fitted(t, 3).iteration_members(t.customer, "c_custkey")
