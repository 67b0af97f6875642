"""Scaling, distances, aggregates, reshaping and generated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.functions.distance import METRICS, array_distance
from kelpfit.operators import aggregates, metrics, quantiles, scaling
from kelpfit.plans.registry import Tables, broadcast_if_few, query, rounded, sql_normal, sql_uniform
from kelpfit.sources import generators, reshape

PART_COLUMNS = ["p_size", "p_retailprice"]
SCALE_SQL = {
    "min_max": ("{c} - min_{s}", "(max_{s} - min_{s})"),
    "standardization": ("{c} - mean_{s}", "std_{s}"),
    "mean_normalization": ("{c} - mean_{s}", "(max_{s} - min_{s})"),
}


def _scale_sql(method: str, scope: str) -> str:
    over, under = SCALE_SQL[method]
    if scope == "matrix":
        stats = """SELECT min(v) AS min_m, max(v) AS max_m, avg(v) AS mean_m, stddev_pop(v) AS std_m
          FROM (SELECT p_size::DOUBLE AS v FROM part UNION ALL SELECT p_retailprice FROM part)"""
    else:
        stats = "SELECT " + ", ".join(
            f"min({c}) AS min_{c}, max({c}) AS max_{c}, avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}"
            for c in PART_COLUMNS) + " FROM part"
    cols = ", ".join(
        f"round(({over}) / {under}, 6) AS {{c}}".format(c=c, s="m" if scope == "matrix" else c)
        for c in PART_COLUMNS)
    return f"WITH s AS ({stats}) SELECT p_partkey, {cols} FROM part, s"


def _scaled(method: str, scope: str):
    def run(t: Tables) -> DataFrame:
        scaler = scaling.fit_scaler(t.part, PART_COLUMNS, method, scope)
        return scaler.transform(t.part).select("p_partkey", *[rounded(c) for c in PART_COLUMNS])

    return run


for _method, _short in (("min_max", "minmax"), ("standardization", "standard"),
                        ("mean_normalization", "meannorm")):
    for _scope in scaling.SCOPES:
        query(f"scale_{_short}_{_scope}", _scale_sql(_method, _scope))(_scaled(_method, _scope))


@query("scale_robust", """
WITH s AS (SELECT quantile_cont(p_size::DOUBLE, 0.25) AS a1, quantile_cont(p_size::DOUBLE, 0.5) AS a2,
                  quantile_cont(p_size::DOUBLE, 0.75) AS a3, quantile_cont(p_retailprice, 0.25) AS b1,
                  quantile_cont(p_retailprice, 0.5) AS b2, quantile_cont(p_retailprice, 0.75) AS b3
           FROM part)
SELECT p_partkey, round((p_size - a2) / (a3 - a1), 6) AS p_size,
       round((p_retailprice - b2) / (b3 - b1), 6) AS p_retailprice FROM part, s""")
def scale_robust(t: Tables) -> DataFrame:
    scaler = scaling.fit_robust_scaler(t.part, PART_COLUMNS)
    return scaler.transform(t.part).select("p_partkey", *[rounded(c) for c in PART_COLUMNS])


@query("scale_vectors", """
WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings),
s AS (SELECT avg(x) AS m, stddev_pop(x) AS d FROM v)
SELECT vec_id, round(sum((x - m) / d), 6) AS total, round(sum(abs((x - m) / d)), 6) AS spread
FROM v, s GROUP BY vec_id""")
def scale_vectors(t: Tables) -> DataFrame:
    scaled = scaling.fit_scaler(t.embeddings, "embedding", "standardization").transform(t.embeddings)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    spread = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.abs(x))
    return scaled.select("vec_id", rounded(total, 6, "total"), rounded(spread, 6, "spread"))


DISTANCE_SQL = {
    "euclidean": "sqrt(sum((x - c) * (x - c)))",
    "manhattan": "sum(abs(x - c))",
    "squared_euclidean": "sum((x - c) * (x - c))",
    "canberra": "sum(CASE WHEN abs(x) + abs(c) = 0 THEN 0 ELSE abs(x - c) / (abs(x) + abs(c)) END)",
}


def _distance_query(metric: str):
    def run(t: Tables) -> DataFrame:
        """Distance of every vector to the mean vector of its class."""
        width = t.embeddings.select(F.max(F.size("embedding"))).first()[0]
        vectors = t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
        means = vectors.groupBy("label").agg(
            F.array(*[F.avg(F.col("x")[i]) for i in range(width)]).alias("c"))
        return vectors.join(broadcast_if_few(means), "label").select(
            "vec_id", rounded(array_distance(metric, F.col("x"), F.col("c")), 6, "distance"))

    return run


for _metric in METRICS:
    query(f"dist_{_metric}", f"""
WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
           FROM embeddings),
m AS (SELECT label, i, avg(x) AS c FROM v GROUP BY label, i)
SELECT vec_id, round({DISTANCE_SQL[_metric]}, 6) AS distance FROM v JOIN m USING (label, i) GROUP BY vec_id
""")(_distance_query(_metric))


@query("mode_first_met", """
WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_orderkey) AS f
           FROM orders GROUP BY ALL)
SELECT o_orderstatus, o_orderpriority AS mode FROM c
QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY n DESC, f) = 1""")
def mode_first_met(t: Tables) -> DataFrame:
    return aggregates.mode(t.orders, ["o_orderstatus"], "o_orderpriority", "o_orderkey")


@query("weighted_mode", """
WITH c AS (SELECT l_returnflag, l_linenumber, sum(l_quantity) AS w, min(l_orderkey) AS f
           FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linenumber AS mode FROM c
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY w DESC, f) = 1""")
def weighted_mode(t: Tables) -> DataFrame:
    return aggregates.heaviest(
        t.lineitem, ["l_returnflag"], "l_linenumber", "l_quantity", "l_orderkey")


@query("weighted_mean", """
SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS price
FROM lineitem GROUP BY l_returnflag""")
def weighted_mean(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(rounded(
        aggregates.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")), 4, "price"))


@query("weighted_median", """
WITH r AS (
  SELECT l_orderkey, l_extendedprice, l_linenumber, l_partkey, l_suppkey,
         sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
                               ROWS UNBOUNDED PRECEDING) AS run,
         sum(l_quantity) OVER (PARTITION BY l_orderkey) AS total
  FROM lineitem
)
SELECT l_orderkey, l_extendedprice AS median FROM r WHERE run >= total / 2
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""")
def weighted_median(t: Tables) -> DataFrame:
    return aggregates.weighted_median(
        t.lineitem, ["l_orderkey"], "l_extendedprice", "l_quantity",
        ["l_linenumber", "l_partkey", "l_suppkey"])


@query("weighted_median_by_flag", """
WITH r AS (
  SELECT l_returnflag, l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         sum(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_orderkey, l_linenumber,
                               l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS run,
         sum(l_quantity) OVER (PARTITION BY l_returnflag) AS total
  FROM lineitem
)
SELECT l_returnflag, min(l_extendedprice) AS median FROM r WHERE run >= total / 2 GROUP BY l_returnflag""")
def weighted_median_by_flag(t: Tables) -> DataFrame:
    """Three groups over the whole table, each far larger than one task should sort."""
    return aggregates.weighted_median(
        t.lineitem, ["l_returnflag"], "l_extendedprice", "l_quantity",
        ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("value_counts", "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL")
def value_counts(t: Tables) -> DataFrame:
    return aggregates.value_counts(t.part, "p_brand", "p_type")


@query("label_lists", """
SELECT DISTINCT 'lang' AS feature, lang AS value FROM documents
UNION ALL SELECT DISTINCT 'source', source FROM documents""")
def label_lists(t: Tables) -> DataFrame:
    return aggregates.distinct_labels(t.documents, ["lang", "source"])


@query("gini_by_group", """
WITH c AS (SELECT source, sum((quality = 0)::INT) AS a, sum((quality = 1)::INT) AS b
           FROM documents JOIN labels USING (doc_id) GROUP BY source)
SELECT source, round(1 - (a * a + b * b)::DOUBLE / ((a + b) * (a + b)), 9) AS gini FROM c""")
def gini_by_group(t: Tables) -> DataFrame:
    counts = t.documents.join(t.labels, "doc_id").groupBy("source").agg(
        F.count(F.when(F.col("quality") == 0, 1)).alias("a"),
        F.count(F.when(F.col("quality") == 1, 1)).alias("b"))
    return counts.select("source", rounded(aggregates.gini([F.col("a"), F.col("b")]), 9, "gini"))


@query("event_histogram", """
WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS width FROM events),
c AS (SELECT CAST(least(floor((value - lo) / width) + 1, 20) AS INTEGER) AS bin, count(*) AS n
      FROM events, e WHERE value IS NOT NULL GROUP BY ALL)
SELECT b.bin, round(lo + (b.bin - 1) * width, 6) AS bin_start, coalesce(n, 0) AS n
FROM (SELECT unnest(range(1, 21))::INTEGER AS bin) b LEFT JOIN c USING (bin), e""")
def event_histogram(t: Tables) -> DataFrame:
    return metrics.histogram(t.events, "value", 20).select("bin", rounded("bin_start"), "n")


@query("vector_round_trip", """
SELECT p_partkey, p_size::DOUBLE AS "size", p_retailprice AS price FROM part""")
def vector_round_trip(t: Tables) -> DataFrame:
    packed = reshape.to_vector(t.part.select("p_partkey", *PART_COLUMNS), PART_COLUMNS)
    return reshape.from_vector(packed, "features", ["size", "price"])


@query("attach_target", """
SELECT doc_id, n_chars, quality AS target FROM documents JOIN labels USING (doc_id)""")
def attach_target(t: Tables) -> DataFrame:
    return reshape.attach_target(t.documents.select("doc_id", "n_chars"), t.labels, "doc_id", "quality")


@query("columns_by_position", "SELECT c_name, c_nationkey FROM customer")
def columns_by_position(t: Tables) -> DataFrame:
    return reshape.columns_between(t.customer, 1, 3)


@query("binary_label", "SELECT vec_id, CAST(label > 1 AS INTEGER) AS y FROM embeddings")
def binary_label(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", (F.col("label") > 1).cast("int").alias("y"))


@query("generate_yes_no", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN {sql_uniform(f'42:{name}', 'c_custkey')} < {share!r}::DOUBLE THEN 'Yes' ELSE 'No' END AS {name}"
    for name, share in generators.HEART_SHARES.items()) + " FROM customer")
def generate_yes_no(t: Tables) -> DataFrame:
    return generators.with_yes_no(t.customer.select("c_custkey"), "c_custkey")


@query("generate_columns", f"""
SELECT c_custkey, CAST(floor({sql_uniform('6:purchases', 'c_custkey')} * 19) + 1 AS BIGINT) AS purchases,
       round({sql_uniform('6:amount', 'c_custkey')} * 990 + 10, 2) AS amount FROM customer""")
def generate_columns(t: Tables) -> DataFrame:
    df = generators.with_integers(t.customer.select("c_custkey"), "c_custkey", "purchases", 1, 20, 6)
    return generators.with_uniform(df, "c_custkey", "amount", 10, 1000, 6, places=2)


_X_TEXT = "'8:X:' || c_custkey"


@query("generate_gaussians", f"""
WITH g AS (SELECT c_custkey, CAST({sql_uniform('8:y', 'c_custkey')} >= 0.5 AS INTEGER) AS y,
                  {sql_normal(_X_TEXT)} AS z FROM customer)
SELECT c_custkey, y, round(z * 0.75 + CASE WHEN y = 1 THEN 1.25 ELSE -1.25 END, 6) AS x FROM g""")
def generate_gaussians(t: Tables) -> DataFrame:
    df = generators.with_two_gaussians(t.customer.select("c_custkey"), "c_custkey", seed=8)
    return df.select("c_custkey", "y", rounded("X", 6, "x"))


@query("union_synthetic_rows", f"""
WITH s AS (SELECT min(c_nationkey) AS n0, max(c_nationkey) AS n1, min(c_acctbal) AS a0, max(c_acctbal) AS a1
           FROM customer)
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
UNION ALL
SELECT k, CAST(floor({sql_uniform('3:c_nationkey', 'k')} * (n1 - n0)) + n0 AS INTEGER),
       round({sql_uniform('3:c_acctbal', 'k')} * (a1 - a0) + a0, 6)
FROM (SELECT c_custkey + (SELECT count(*) FROM customer) AS k FROM customer), s""")
def union_synthetic_rows(t: Tables) -> DataFrame:
    n = t.customer.count()
    keys = t.customer.select((F.col("c_custkey") + n).alias("c_custkey"))
    rows = generators.with_synthetic_rows(
        t.customer, ["c_nationkey", "c_acctbal"], keys, "c_custkey", seed=3)
    return rows.withColumn("c_acctbal", F.round("c_acctbal", 6))


@query("group_median", """
SELECT l_suppkey, round(median(l_extendedprice), 6) AS median FROM lineitem WHERE l_extendedprice IS NOT NULL
GROUP BY l_suppkey""")
def group_median(t: Tables) -> DataFrame:
    return quantiles.group_median(t.lineitem, "l_suppkey", "l_extendedprice").select("l_suppkey", rounded("median"))
