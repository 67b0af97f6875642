"""Dense networks on the embeddings, label above 4 or not."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.operators.network import (
    AdaptiveSteps, Layer, Network, accuracy, cross_entropy, fit_gradient, search_descent, search_random, squared_error,
)
from kelpfit.operators.scaling import fit_robust_scaler, principal_components
from kelpfit.plans.registry import Tables, query, rounded, sql_normal

WIDTH = 64  # coordinates of an embedding
INPUTS = [f"x{i}" for i in range(WIDTH)]
SHAPE = ((WIDTH, 3), (3, 4), (4, 1))
LAYERS = tuple(Layer(a, b, f) for (a, b), f in zip(SHAPE, ("relu", "relu", "sigmoid")))
SLOTS = [(i, "w", (r, c)) for i, (a, b) in enumerate(SHAPE) for r in range(a) for c in range(b)] + [
    (i, "b", (c,)) for i, (_, b) in enumerate(SHAPE) for c in range(b)]
SRC_SQL = f"""
WITH src AS MATERIALIZED (
  SELECT vec_id, {', '.join(f'embedding[{i + 1}]::DOUBLE AS {x}' for i, x in enumerate(INPUTS))},
         (label > 4)::INT::DOUBLE AS y
  FROM embeddings)"""


def slot_name(slot) -> str:
    layer, kind, place = slot
    return f"{kind}{layer}_" + "_".join(map(str, place))


def weights_sql(prefix: str) -> str:
    """All weights as columns, drawn from the seed text and an optional candidate column."""
    cols = []
    for slot in SLOTS:
        layer, kind, place = slot
        text = f"{prefix} || ':{layer}:{kind}:" + ":".join(map(str, place)) + "'"
        cols.append(f"{sql_normal(text)} AS {slot_name(slot)}")
    return ", ".join(cols)


def forward_sql(source: str) -> str:
    """Layer by layer arithmetic over rows that carry inputs and weights."""
    names = INPUTS
    out = source
    for layer, (a, b) in enumerate(SHAPE):
        cols = []
        for c in range(b):
            z = " + ".join(f"{names[r]} * w{layer}_{r}_{c}" for r in range(a)) + f" + b{layer}_{c}"
            if layer < len(SHAPE) - 1:
                cols.append(f"greatest({z}, 0::DOUBLE) AS h{layer}_{c}")
            else:
                cols.append(f"1 / (1 + exp(-greatest(least({z}, 500), -500))) AS p")
        names = [f"h{layer}_{c}" for c in range(b)]
        out = f"SELECT *, {', '.join(cols)} FROM ({out})"
    return out


START = SRC_SQL + f", start AS MATERIALIZED (SELECT {weights_sql(repr('41:start'))})"
HIT = "avg((y = (p > 0.5)::INT)::INT)"


def vectors(t: Tables) -> DataFrame:
    x = F.col("embedding")
    return t.embeddings.select(
        "vec_id", *[x[i].cast("double").alias(name) for i, name in enumerate(INPUTS)],
        (F.col("label") > 4).cast("int").alias("y"))


def network(**functions) -> Network:
    return Network.random(LAYERS, 41, **functions)


@query("mlp_forward", START + f"""
SELECT vec_id, round(p, 6) AS prediction FROM ({forward_sql('SELECT * FROM src, start')})""")
def forward(t: Tables) -> DataFrame:
    return network().transform(vectors(t), INPUTS).select("vec_id", rounded("prediction"))


@query("mlp_evaluate", START + f"""
SELECT round(avg((y - p) * (y - p)), 6) AS loss, round({HIT}, 9) AS accuracy
FROM ({forward_sql('SELECT * FROM src, start')})""")
def evaluate(t: Tables) -> DataFrame:
    return network().evaluate(vectors(t), INPUTS, "y").select(
        rounded("loss"), rounded("accuracy", 9))


@query("mlp_cross_entropy", SRC_SQL + f"""
, raw AS MATERIALIZED (SELECT {weights_sql(repr('42:start'))}),
start AS MATERIALIZED (SELECT {', '.join(
    f"{slot_name(s)} * {'0.01' if s[1] == 'w' else '0.00001'}::DOUBLE AS {slot_name(s)}" for s in SLOTS)} FROM raw)
SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS loss, round({HIT}, 9) AS accuracy
FROM ({forward_sql('SELECT * FROM src, start')})""")
def cross_entropy_cost(t: Tables) -> DataFrame:
    small = Network.random(LAYERS, 42, weight_scale=0.01, bias_scale=0.00001, loss_function=cross_entropy)
    return small.evaluate(vectors(t), INPUTS, "y").select(rounded("loss"), rounded("accuracy", 9))


EPOCHS = 30
CANDIDATE_TEXT = "'41:' || epoch"


@query("search_random", SRC_SQL + f"""
, cand AS MATERIALIZED (SELECT epoch, {weights_sql(CANDIDATE_TEXT)} FROM range(1, {EPOCHS + 1}) AS r(epoch))
SELECT CAST(epoch AS INTEGER) AS epoch, round(avg((y - p) * (y - p)), 6) AS loss, round({HIT}, 9) AS accuracy
FROM ({forward_sql('SELECT * FROM src, cand')}) GROUP BY epoch""")
def random_search(t: Tables) -> DataFrame:
    result = search_random(vectors(t), INPUTS, "y", network(), EPOCHS, seed=41)
    return result.log_table(t.spark).select("epoch", rounded("loss"), rounded("accuracy", 9))


@query("search_random_best", SRC_SQL + f"""
, cand AS MATERIALIZED (
  SELECT 0 AS epoch, {weights_sql(repr('41:start'))}
  UNION ALL SELECT epoch, {weights_sql(CANDIDATE_TEXT)} FROM range(1, {EPOCHS + 1}) AS r(epoch))
, scored AS (SELECT epoch, avg((y - p) * (y - p)) AS loss FROM ({forward_sql('SELECT * FROM src, cand')})
             GROUP BY epoch)
SELECT vec_id, round(p, 6) AS prediction FROM ({forward_sql(
    'SELECT * FROM src, (SELECT * FROM cand WHERE epoch = (SELECT arg_min(epoch, loss) FROM scored))')})""")
def random_search_best(t: Tables) -> DataFrame:
    df = vectors(t)
    best = search_random(df, INPUTS, "y", network(), EPOCHS, seed=41).network
    return best.transform(df, INPUTS).select("vec_id", rounded("prediction"))


BRANCHES = 5
RATE = 0.1


def _descent_sql(epochs: int) -> str:
    names = [slot_name(s) for s in SLOTS]
    sql = START + f""", k0 AS MATERIALIZED (
  SELECT *, (SELECT avg((y - p) * (y - p)) FROM ({forward_sql('SELECT * FROM src, start')})) AS loss,
         (SELECT {HIT} FROM ({forward_sql('SELECT * FROM src, start')})) AS accuracy FROM start)"""
    log = []
    for e in range(1, epochs + 1):
        text = f"'43:{e}:' || branch"
        moved = ", ".join(f"k.{n} + {RATE}::DOUBLE * d.{n} AS {n}" for n in names)
        tried = f"SELECT branch, {moved} FROM k{e - 1} k, d{e} d"
        sql += f"""
, d{e} AS MATERIALIZED (SELECT branch, {weights_sql(text)} FROM range({BRANCHES}) AS r(branch))
, t{e} AS MATERIALIZED ({tried})
, s{e} AS MATERIALIZED (SELECT branch, avg((y - p) * (y - p)) AS loss, {HIT} AS accuracy
                        FROM ({forward_sql(f'SELECT * FROM src, t{e}')}) GROUP BY branch)
, k{e} AS MATERIALIZED (
  SELECT {', '.join(names)}, loss, accuracy FROM (
    SELECT 1 AS fresh, t.branch, {', '.join('t.' + n for n in names)}, s.loss, s.accuracy
    FROM t{e} t JOIN s{e} s USING (branch)
    UNION ALL SELECT 0, -1, {', '.join(names)}, loss, accuracy FROM k{e - 1})
  ORDER BY loss, fresh, branch LIMIT 1)"""
        log.append(f"SELECT {e}::INTEGER AS epoch, round(loss, 6) AS loss, round(accuracy, 9) AS accuracy FROM k{e}")
    return sql + " UNION ALL ".join(log)


@query("search_descent", _descent_sql(3))
def descent(t: Tables) -> DataFrame:
    result = search_descent(vectors(t), INPUTS, "y", network(), 3, BRANCHES, RATE, seed=43)
    return result.log_table(t.spark).select("epoch", rounded("loss"), rounded("accuracy", 9))


def coordinates(t: Tables) -> tuple[DataFrame, list[str]]:
    names = [f"e{i}" for i in range(WIDTH)]
    df = t.embeddings.select("vec_id", (F.col("label") > 4).cast("int").alias("y"),
                             *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return fit_robust_scaler(df, names).transform(df), names


POWER_STEPS = 10_000
# the covariance matrix, and its two largest eigenvectors by repeated multiplication
PCA_SQL = f"""
WITH RECURSIVE
s AS MATERIALIZED (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
q AS (SELECT i, quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.5) AS m, quantile_cont(x, 0.75) AS b FROM s GROUP BY i),
z AS MATERIALIZED (SELECT vec_id, i, (x - m) / (b - a) AS z FROM s JOIN q USING (i)),
d AS MATERIALIZED (SELECT vec_id, i, z, z - avg(z) OVER (PARTITION BY i) AS d FROM z),
cov AS (SELECT l.i, r.i AS j, sum(l.d * r.d) / (count(*) - 1) AS v FROM d l JOIN d r USING (vec_id) GROUP BY ALL),
c1 AS MATERIALIZED (SELECT list(r ORDER BY i) AS c FROM (SELECT i, list(v ORDER BY j) AS r FROM cov GROUP BY i)),
p1 AS (SELECT 0 AS t, list_transform(range({WIDTH}), lambda k: 1 + 0.001::DOUBLE * k) AS v
  UNION ALL SELECT t + 1, list_transform(w, lambda e: e / sqrt(list_dot_product(w, w)))
  FROM (SELECT t, list_transform(c, lambda r: list_dot_product(r, v)) AS w FROM p1, c1 WHERE t < {POWER_STEPS})),
v1 AS MATERIALIZED (SELECT v, list_dot_product(v, list_transform(c, lambda r: list_dot_product(r, v))) AS e FROM p1, c1 WHERE t = {POWER_STEPS}),
c2 AS MATERIALIZED (SELECT list_transform(c, lambda r, k: list_transform(r, lambda x, l: x - e * v[k] * v[l])) AS c FROM c1, v1),
p2 AS (SELECT 0 AS t, list_transform(range({WIDTH}), lambda k: 1 + 0.001::DOUBLE * k) AS v
  UNION ALL SELECT t + 1, list_transform(w, lambda e: e / sqrt(list_dot_product(w, w)))
  FROM (SELECT t, list_transform(c, lambda r: list_dot_product(r, v)) AS w FROM p2, c2 WHERE t < {POWER_STEPS})),
v2 AS MATERIALIZED (SELECT v, list_dot_product(v, list_transform(c, lambda r: list_dot_product(r, v))) AS e FROM p2, c2 WHERE t = {POWER_STEPS})
"""


@query("pca_explained", PCA_SQL + """
SELECT vec_id, round(abs(sum(d * v1.v[i])), 4) AS first, round(abs(sum(d * v2.v[i])), 4) AS second
FROM d, v1, v2 GROUP BY vec_id""")
def explained(t: Tables) -> DataFrame:
    """Two principal components of robust-scaled coordinates, per row."""
    projected, _ = principal_components(*coordinates(t), 2)
    xy = vector_to_array("components")
    return projected.select("vec_id", rounded(F.abs(xy[0]), 4, "first"), rounded(F.abs(xy[1]), 4, "second"))


@query("pca_variance", PCA_SQL + """
, total AS (SELECT list_sum(list_transform(c, lambda r, k: r[k])) AS t FROM c1)
SELECT 1 AS component, round(e / t, 8) AS explained FROM v1, total
UNION ALL SELECT 2, round(e / t, 8) FROM v2, total""")
def explained_variance(t: Tables) -> DataFrame:
    """Share of the variance that each of the two components explains."""
    _, model = principal_components(*coordinates(t), 2)
    shares = [float(v) for v in model.explainedVariance]
    return t.spark.createDataFrame([(i + 1, v) for i, v in enumerate(shares)], "component int, explained double").select(
        "component", rounded("explained", 8))


GRADIENT_RATE = 0.5


def _gradient_sql(epochs: int, adaptive: float | None = None) -> str:
    """Forward and backward pass of every epoch, written out.

    Plain steps on the squared error, or adaptive ones of a given rate on the cross-entropy.
    """
    names = [slot_name(s) for s in SLOTS]
    moments = "".join(f", 0::DOUBLE AS m_{n}, 0::DOUBLE AS v_{n}" for n in names) if adaptive else ""
    sql = START + f", k0 AS MATERIALIZED (SELECT {', '.join(names)}{moments} FROM start)"
    for e in range(1, epochs + 1):
        top = len(SHAPE) - 1
        last = "p - y" if adaptive else "2 * (p - y) * p * (1 - p)"
        deltas = f"SELECT *, {last} AS d{top}_0 FROM ({forward_sql(f'SELECT * FROM src, k{e - 1}')})"
        for layer in range(top - 1, -1, -1):
            back = ", ".join(
                f"CASE WHEN h{layer}_{c} > 0 THEN "
                + " + ".join(f"d{layer + 1}_{j} * w{layer + 1}_{c}_{j}" for j in range(SHAPE[layer + 1][1]))
                + f" ELSE 0 END AS d{layer}_{c}" for c in range(SHAPE[layer][1]))
            deltas = f"SELECT *, {back} FROM ({deltas})"
        moved = []
        for layer, kind, place in SLOTS:
            name = slot_name((layer, kind, place))
            out = f"d{layer}_{place[-1]}"
            inner = out if kind == "b" else f"{INPUTS[place[0]] if layer == 0 else f'h{layer - 1}_{place[0]}'} * {out}"
            if adaptive:
                moved.append(f"any_value({name}) AS {name}, 0.9::DOUBLE * any_value(m_{name}) + 0.1::DOUBLE * avg({inner}) AS m_{name}, "
                             f"0.999::DOUBLE * any_value(v_{name}) + 0.001::DOUBLE * pow(avg({inner}), 2) AS v_{name}")
            else:
                moved.append(f"any_value({name}) - {GRADIENT_RATE}::DOUBLE * avg({inner}) AS {name}")
        step = f"SELECT {', '.join(moved)} FROM ({deltas})"
        if adaptive:
            step = "SELECT " + ", ".join(
                f"{n} - {adaptive}::DOUBLE * (m_{n} / (1 - pow(0.9::DOUBLE, {e}))) / (sqrt(v_{n} / (1 - pow(0.999::DOUBLE, {e}))) "
                f"+ 0.00000001::DOUBLE) AS {n}, m_{n}, v_{n}" for n in names) + f" FROM ({step})"
        sql += f", k{e} AS MATERIALIZED ({step})"
    return sql + f" SELECT vec_id, round(p, 6) AS prediction FROM ({forward_sql(f'SELECT * FROM src, k{epochs}')})"


@query("mlp_gradient", _gradient_sql(3))
def gradient(t: Tables) -> DataFrame:
    """Predictions after three full-batch gradient steps from hash-drawn weights."""
    df = vectors(t)
    trained = fit_gradient(df, INPUTS, "y", network(), 3, GRADIENT_RATE).network
    return trained.transform(df, INPUTS).select("vec_id", rounded("prediction"))


@query("mlp_gradient_ce", _gradient_sql(3, 0.05))
def gradient_cross_entropy(t: Tables) -> DataFrame:
    """Predictions after three adaptive steps on the cross-entropy."""
    df = vectors(t)
    trained = fit_gradient(df, INPUTS, "y", network(loss_function=cross_entropy), 3, steps=AdaptiveSteps(0.05)).network
    return trained.transform(df, INPUTS).select("vec_id", rounded("prediction"))
