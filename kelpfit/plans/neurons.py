"""The single neuron: document quality (classification), event values (regression)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.functions import activation, loss
from kelpfit.operators.neuron import Neuron, grid_search, problem_type
from kelpfit.plans.registry import Tables, query, rounded, sql_uniform

DOC_SQL = """
WITH src AS MATERIALIZED (
  SELECT doc_id AS id, n_chars / 10000::DOUBLE AS x0, toxic::DOUBLE AS x1, quality::DOUBLE AS y
  FROM documents JOIN labels USING (doc_id))"""
EVENT_SQL = """
WITH src AS MATERIALIZED (
  SELECT event_id AS id, user_id / 200::DOUBLE AS x0, length(event_type) / 10::DOUBLE AS x1,
         value / 500 AS y FROM events)"""
SIGMOID = "(1 / (1 + exp(-greatest(least({z}, 500), -500))))"
CROSS = "-(y * ln(p + 1e-7::DOUBLE) + (1 - y) * ln(1 - p + 1e-7::DOUBLE))"


def start_sql(seed: int) -> str:
    draw = [f"2 * {sql_uniform(f'{seed}:w', repr(str(j)))} - 1" for j in range(2)]
    return f", w0 AS MATERIALIZED (SELECT {draw[0]} AS w0, {draw[1]} AS w1, 1::DOUBLE AS b)"


def step_sql(step: int, rate: float, act: str, row_loss: str, error: str, where: str = "") -> str:
    """Loss of one batch under the weights before, and the weights after it."""
    p = act.format(z="x0 * w0 + x1 * w1 + b")
    return f"""
, g{step} AS MATERIALIZED (
  SELECT avg({row_loss}) AS loss, sum(({error}) * x0) AS g0, sum(({error}) * x1) AS g1, sum({error}) AS gb
  FROM (SELECT y, x0, x1, {p} AS p FROM src, w{step - 1} {where}))
, w{step} AS MATERIALIZED (SELECT w0 - {rate}::DOUBLE * g0 AS w0, w1 - {rate}::DOUBLE * g1 AS w1,
                                  b - {rate}::DOUBLE * gb AS b FROM w{step - 1}, g{step})"""


def full_batch_sql(rows: str, seed: int, steps: int, rate: float, act: str, row_loss: str, error: str) -> str:
    return rows + start_sql(seed) + "".join(
        step_sql(i, rate, act, row_loss, error) for i in range(1, steps + 1))


def history_sql(steps: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS epoch, round(loss, 6) AS loss FROM g{i}" for i in range(1, steps + 1))


def documents(t: Tables) -> DataFrame:
    df = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return df.select("doc_id", (F.col("n_chars") / 10000).alias("x0"),
                     F.col("toxic").cast("double").alias("x1"), F.col("quality").alias("y"))


def events(t: Tables) -> DataFrame:
    return t.events.select("event_id", (F.col("user_id") / 200).alias("x0"),
                           (F.length("event_type") / 10).alias("x1"), (F.col("value") / 500).alias("y"))


def _weights(model) -> list:
    return [F.round(F.lit(v), 6).alias(n) for n, v in zip(("w0", "w1", "b"), (*model.weights, model.bias))]


DOC_TRAIN = full_batch_sql(DOC_SQL, 31, 3, 0.001, SIGMOID, CROSS, "p - y")


def trained_on_documents(t: Tables):
    settings = Neuron(epochs=3, learning_rate=0.001, batches=0, random_state=31)
    return settings.fit(documents(t), ["x0", "x1"], "y")


@query("neuron_train", DOC_TRAIN + history_sql(3))
def train(t: Tables) -> DataFrame:
    return trained_on_documents(t).loss_history(t.spark).select("epoch", rounded("loss"))


@query("neuron_predict", DOC_TRAIN + f"""
SELECT id AS doc_id, round({SIGMOID.format(z='x0 * w0 + x1 * w1 + b')}, 6) AS prediction FROM src, w3""")
def predict(t: Tables) -> DataFrame:
    return trained_on_documents(t).transform(documents(t)).select("doc_id", rounded("prediction"))


@query("neuron_score", DOC_TRAIN + f"""
, s AS (SELECT y, {SIGMOID.format(z='x0 * w0 + x1 * w1 + b')} AS p FROM src, w3)
SELECT round(avg({CROSS}), 6) AS loss, round(avg((y = (p > 0.5)::INT)::INT), 9) AS accuracy FROM s""")
def score(t: Tables) -> DataFrame:
    model, df = trained_on_documents(t), documents(t)
    return model.score(df).select(rounded("loss")).withColumn(
        "accuracy", F.round(F.lit(model.accuracy(df).first()[0]), 9))


for _name, _loss, _row, _error, _gradient in (
    ("neuron_regression_mse", "mse", "(y - p) * (y - p)", "p - y", "residual"),
    ("neuron_regression_exact", "mse", "(y - p) * (y - p)", "(p - y) * (1 - p * p)", "exact"),
    ("neuron_regression_mae", "mae", "abs(y - p)", "sign(p - y) * (1 - p * p)", "exact"),
):
    def _run(t: Tables, kind=_loss, gradient=_gradient) -> DataFrame:
        settings = Neuron(epochs=3, learning_rate=0.00005, loss_function=kind, gradient=gradient,
                          batches=0, random_state=32)
        return settings.fit(events(t), ["x0", "x1"], "y").loss_history(t.spark).select(
            "epoch", rounded("loss"))

    query(_name, full_batch_sql(EVENT_SQL, 32, 3, 0.00005, "tanh({z})", _row, _error) + history_sql(3))(_run)


_BATCHED = """, n AS (SELECT count(*) AS n FROM src), b AS MATERIALIZED (
  SELECT src.*, (row_number() OVER (ORDER BY md5('33:1:' || id)) - 1) // greatest(1, n // 10) AS batch
  FROM src, n)"""


@query("neuron_minibatch", EVENT_SQL + _BATCHED + start_sql(33) + "".join(
    step_sql(i, 0.0001, "tanh({z})", "(y - p) * (y - p)", "p - y").replace(
        "FROM src,", f"FROM (SELECT * FROM b WHERE batch = {i - 1}),") for i in range(1, 11)) + """
, h AS (""" + " UNION ALL ".join(f"SELECT loss FROM g{i}" for i in range(1, 11)) + """)
SELECT round((SELECT avg(loss) FROM h), 6) AS loss, round(w0, 6) AS w0, round(w1, 6) AS w1, round(b, 6) AS b
FROM w10""")
def minibatch(t: Tables) -> DataFrame:
    settings = Neuron(epochs=1, learning_rate=0.0001, random_state=33)
    model = settings.fit(events(t), ["x0", "x1"], "y", key="event_id")
    return model.loss_history(t.spark).select(rounded("loss"), *_weights(model))


@query("neuron_curve", """
WITH e AS (SELECT min(n_chars) / 10000::DOUBLE AS lo, max(n_chars) / 10000::DOUBLE AS hi
           FROM documents JOIN labels USING (doc_id))
SELECT CAST(i AS INTEGER) AS point, round(lo + i * ((hi - lo) / 19), 6) AS x0,
       round(1 / (1 + exp(-(0.5::DOUBLE * (lo + i * ((hi - lo) / 19)) + 1))), 6) AS prediction
FROM e, range(20) AS r(i)""")
def curve(t: Tables) -> DataFrame:
    df = documents(t)
    model = Neuron(random_state=1).start(df, ["x0"], "y", weights=[0.5])
    return model.decision_curve(df, 20).select("point", rounded("x0"), rounded("prediction"))


@query("neuron_activations", """
WITH v AS (SELECT event_id, value / 50 - 1 AS z FROM events)
SELECT event_id, round(1 / (1 + exp(-z)), 6) AS sigmoid, round(tanh(z), 6) AS tanh, greatest(z, 0) AS relu,
       round((1 / (1 + exp(-z))) * (1 - 1 / (1 + exp(-z))), 6) AS sigmoid_slope,
       round(1 - tanh(z) * tanh(z), 6) AS tanh_slope FROM v""")
def activations(t: Tables) -> DataFrame:
    z = F.col("value") / 50 - 1
    s, h = activation.sigmoid(z), activation.tanh(z)
    return t.events.select(
        "event_id", rounded(s, 6, "sigmoid"), rounded(h, 6, "tanh"), activation.relu(z).alias("relu"),
        rounded(activation.derivative("sigmoid", s), 6, "sigmoid_slope"),
        rounded(activation.derivative("tanh", h), 6, "tanh_slope"))


@query("neuron_losses", DOC_SQL + """
, s AS (SELECT y, 1 / (1 + exp(-(x0 - x1))) AS p FROM src)
SELECT round(avg(-(y * ln(p + 1e-7::DOUBLE) + (1 - y) * ln(1 - p + 1e-7::DOUBLE))), 6) AS smoothed,
       round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS plain,
       round(avg((y - p) * (y - p)), 6) AS mse, round(avg(abs(y - p)), 6) AS mae FROM s""")
def losses(t: Tables) -> DataFrame:
    y, p = F.col("y").cast("double"), activation.sigmoid(F.col("x0") - F.col("x1"))
    return documents(t).agg(
        rounded(F.avg(loss.cross_entropy(y, p)), 6, "smoothed"),
        rounded(F.avg(loss.cross_entropy(y, p, 0.0)), 6, "plain"),
        rounded(F.avg(loss.squared_error(y, p)), 6, "mse"),
        rounded(F.avg(loss.absolute_error(y, p)), 6, "mae"))


@query("problem_types", """
SELECT 'quality' AS label, CASE WHEN count(DISTINCT quality) > 2 THEN 'regression' ELSE 'classification' END
  AS problem FROM labels
UNION ALL
SELECT 'value', CASE WHEN count(DISTINCT value) > 2 THEN 'regression' ELSE 'classification' END FROM events""")
def problem_types(t: Tables) -> DataFrame:
    rows = [("quality", problem_type(t.labels, "quality")), ("value", problem_type(t.events, "value"))]
    return t.spark.createDataFrame(rows, "label string, problem string")


def _grid_part(rate: float, tag: str, epochs: int) -> str:
    return f"SELECT {epochs}::INTEGER AS epochs, {rate}::DOUBLE AS learning_rate, round(loss, 6) AS loss FROM {tag}g{epochs}"


def _grid_sql() -> str:
    sql, parts = DOC_SQL + start_sql(34).replace("w0 AS MATERIALIZED", "start AS MATERIALIZED", 1), []
    for tag, rate in (("a", 0.001), ("b", 0.01)):
        sql += f", {tag}w0 AS (SELECT * FROM start)"
        for i in range(1, 5):
            step = step_sql(i, rate, SIGMOID, CROSS, "p - y")
            for part in ("g", "w"):
                for j in (i - 1, i):
                    step = step.replace(f", {part}{j} AS", f", {tag}{part}{j} AS").replace(
                        f"FROM {part}{j},", f"FROM {tag}{part}{j},")
            step = step.replace(f"src, w{i - 1} ", f"src, {tag}w{i - 1} ").replace(
                f"{tag}w{i - 1}, g{i})", f"{tag}w{i - 1}, {tag}g{i})")
            sql += step
        parts += [_grid_part(rate, tag, 2), _grid_part(rate, tag, 4)]
    return sql + " UNION ALL ".join(parts)


@query("neuron_grid", _grid_sql())
def grid(t: Tables) -> DataFrame:
    settings = Neuron(batches=0, random_state=34)
    return grid_search(documents(t), ["x0", "x1"], "y", [2, 4], [0.001, 0.01], settings).select(
        "epochs", "learning_rate", rounded("loss"))
