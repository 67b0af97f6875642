"""Nearest neighbours: embeddings by class, parts by brand number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.operators import metrics
from kelpfit.operators.knn import KNNClassifier, KNNRegressor, nearest
from kelpfit.operators.split import train_test_split
from kelpfit.plans.registry import Tables, query, rounded

K = 5
VECTOR_SQL = """
WITH r AS (
  SELECT vec_id, label, embedding,
         row_number() OVER (ORDER BY md5('19:' || vec_id)) <= floor(0.8::DOUBLE * count(*) OVER ()) AS train
  FROM embeddings
), v AS (
  SELECT vec_id, label, train, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM r
), d AS (
  SELECT q.vec_id, t.vec_id AS neighbour, t.label, {gap} AS distance
  FROM v q JOIN v t ON q.i = t.i AND NOT q.train AND t.train GROUP BY ALL
), near AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS rank FROM d
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) <= 5
)"""
EUCLID = VECTOR_SQL.format(gap="sqrt(sum((q.x - t.x) * (q.x - t.x)))")
MANHATTAN = VECTOR_SQL.format(gap="sum(abs(q.x - t.x))")
CANBERRA = VECTOR_SQL.format(
    gap="sum(coalesce(abs(q.x - t.x) / nullif(abs(q.x) + abs(t.x), 0), 0))")
VOTE = """
, vote AS (
  SELECT vec_id, label AS prediction FROM (
    SELECT vec_id, label, {weight} AS w, min(rank) AS f FROM near GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY w DESC, f) = 1
), judged AS (SELECT vec_id, prediction, label FROM vote JOIN embeddings USING (vec_id))"""
MAJORITY = EUCLID + VOTE.format(weight="count(*)")
WEIGHTED = EUCLID + VOTE.format(weight="sum(1.0::DOUBLE / (distance + 1e-6::DOUBLE))")


def vectors(t: Tables) -> tuple[DataFrame, DataFrame]:
    return train_test_split(t.embeddings, "vec_id", training_size=0.8, random_state=19)


def classified(t: Tables, weighting: bool = False) -> DataFrame:
    train, test = vectors(t)
    return KNNClassifier(K, weighting=weighting).fit(train, "embedding", "label", "vec_id").predict(test)


def judged(t: Tables) -> DataFrame:
    return classified(t).join(t.embeddings.select("vec_id", "label"), "vec_id")


def _topk(metric: str):
    def run(t: Tables) -> DataFrame:
        train, test = vectors(t)
        near = nearest(test, train, "vec_id", "vec_id", ["embedding"], "label", K, metric)
        return near.select("vec_id", "rank", "neighbour", "label", rounded("distance"))

    return run


for _name, _metric, _sql in (("knn_topk", "euclidean", EUCLID), ("knn_topk_manhattan", "manhattan", MANHATTAN),
                             ("knn_topk_canberra", "canberra", CANBERRA)):
    query(_name, _sql + """
SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbour, label, round(distance, 6) AS distance FROM near
""")(_topk(_metric))


@query("knn_vote", MAJORITY + "SELECT vec_id, prediction FROM vote")
def vote(t: Tables) -> DataFrame:
    return classified(t)


@query("knn_weighted_vote", WEIGHTED + "SELECT vec_id, prediction FROM vote")
def weighted_vote(t: Tables) -> DataFrame:
    return classified(t, weighting=True)


@query("knn_accuracy", MAJORITY + """
SELECT round(avg((prediction = label)::INT), 9) AS accuracy, count(*) AS n FROM judged""")
def accuracy(t: Tables) -> DataFrame:
    return judged(t).agg(
        rounded(metrics.accuracy(F.col("label"), F.col("prediction")), 9, "accuracy"),
        F.count(F.lit(1)).alias("n"))


@query("knn_confusion", MAJORITY + """
SELECT label AS actual, prediction AS predicted, count(*) AS n FROM judged GROUP BY ALL""")
def confusion(t: Tables) -> DataFrame:
    return metrics.confusion(judged(t), "label", "prediction")


PART_SQL = """
WITH r AS (
  SELECT p_partkey, p_size::DOUBLE AS a, p_retailprice AS b, substr(p_brand, 7)::BIGINT AS label,
         row_number() OVER (ORDER BY md5('23:' || p_partkey)) <= floor(0.8::DOUBLE * count(*) OVER ()) AS train
  FROM part
), s AS (
  SELECT min(a) AS a0, max(a) AS a1, min(b) AS b0, max(b) AS b1 FROM r WHERE train
), v AS (
  SELECT p_partkey, label, train, (a - a0) / (a1 - a0) AS a, (b - b0) / (b1 - b0) AS b FROM r, s
), near AS (
  SELECT q.p_partkey, t.label, sqrt((q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b)) AS distance,
         row_number() OVER (PARTITION BY q.p_partkey ORDER BY
           sqrt((q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b)), t.p_partkey) AS rank
  FROM v q JOIN v t ON NOT q.train AND t.train
  QUALIFY row_number() OVER (PARTITION BY q.p_partkey ORDER BY
           sqrt((q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b)), t.p_partkey) <= 5
), w AS (SELECT *, 1.0::DOUBLE / (distance + 1e-6::DOUBLE) AS weight FROM near)"""
TOP_LABEL = """
, c AS (SELECT p_partkey, label, {weight} AS n, min(rank) AS f FROM w GROUP BY ALL)
SELECT p_partkey, label AS prediction FROM c
QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY n DESC, f) = 1"""
WALK = """
, run AS (
  SELECT p_partkey, label, rank, sum(weight) OVER (PARTITION BY p_partkey ORDER BY {order}
           ROWS UNBOUNDED PRECEDING) AS part, sum(weight) OVER (PARTITION BY p_partkey) AS whole FROM w)
SELECT p_partkey, label AS prediction FROM run WHERE part >= whole / 2
QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY {order}) = 1"""


def parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    df = t.part.select("p_partkey", "p_size", "p_retailprice",
                       F.expr("cast(substr(p_brand, 7) as long)").alias("brand"))
    return train_test_split(df, "p_partkey", training_size=0.8, random_state=23)


def estimated(t: Tables, function: str, weighting: bool = False, **options) -> DataFrame:
    train, test = parts(t)
    model = KNNRegressor(K, weighting=weighting).fit(
        train, ["p_size", "p_retailprice"], "brand", "p_partkey", "min_max", scope="column")
    return model.predict(test, aggregation_function=function, **options)


@query("knn_mean", PART_SQL + "SELECT p_partkey, round(avg(label), 6) AS prediction FROM w GROUP BY 1")
def mean(t: Tables) -> DataFrame:
    return estimated(t, "mean").select("p_partkey", rounded("prediction"))


@query("knn_median", PART_SQL + "SELECT p_partkey, median(label)::DOUBLE AS prediction FROM w GROUP BY 1")
def median(t: Tables) -> DataFrame:
    return estimated(t, "median")


@query("knn_mode", PART_SQL + TOP_LABEL.format(weight="count(*)"))
def mode(t: Tables) -> DataFrame:
    return estimated(t, "mode")


@query("knn_wmean", PART_SQL + """
SELECT p_partkey, round(sum(label * weight) / sum(weight), 6) AS prediction FROM w GROUP BY 1""")
def weighted_mean(t: Tables) -> DataFrame:
    return estimated(t, "mean", True).select("p_partkey", rounded("prediction"))


@query("knn_wmedian", PART_SQL + WALK.format(order="rank"))
def weighted_median(t: Tables) -> DataFrame:
    return estimated(t, "median", True)


@query("knn_wmedian_by_value", PART_SQL + WALK.format(order="label, rank"))
def weighted_median_by_value(t: Tables) -> DataFrame:
    return estimated(t, "median", True, by_value=True)


@query("knn_wmode", PART_SQL + TOP_LABEL.format(weight="sum(weight)"))
def weighted_mode(t: Tables) -> DataFrame:
    return estimated(t, "mode", True)


@query("knn_error", PART_SQL + """
, p AS (SELECT p_partkey, avg(label) AS p FROM w GROUP BY 1),
e AS (SELECT r.label - p.p AS e FROM p JOIN r USING (p_partkey))
SELECT round(avg(e * e), 6) AS mse, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse FROM e""")
def error(t: Tables) -> DataFrame:
    scored = estimated(t, "mean").join(parts(t)[1].select("p_partkey", "brand"), "p_partkey")
    y, p = F.col("brand"), F.col("prediction")
    return scored.agg(rounded(metrics.mse(y, p), 6, "mse"), rounded(metrics.mae(y, p), 6, "mae"),
                      rounded(metrics.rmse(y, p), 6, "rmse"))


@query("knn_many_cells", """
WITH d AS (
  SELECT c_custkey, o_orderkey, o_totalprice, abs(c_acctbal - o_totalprice / 40) AS gap FROM customer, orders
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY abs(c_acctbal - o_totalprice / 40), o_orderkey) <= 3)
SELECT c_custkey, round(avg(o_totalprice), 4) AS prediction FROM d GROUP BY c_custkey""")
def many_cells(t: Tables) -> DataFrame:
    """Mean total of the three orders whose fortieth is nearest to each customer's balance."""
    train = t.orders.select("o_orderkey", "o_totalprice", (F.col("o_totalprice") / 40).alias("amount"))
    model = KNNRegressor(3, "manhattan").fit(train, ["amount"], "o_totalprice", "o_orderkey")
    asked = t.customer.select("c_custkey", F.col("c_acctbal").alias("amount"))
    return model.predict(asked, "c_custkey").select("c_custkey", rounded("prediction", 4))
