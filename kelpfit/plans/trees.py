"""Trees: yes/no line items, labelled documents, parts and orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.operators import metrics
from kelpfit.operators.tree import DecisionTree, RegressionTree, TreeModel
from kelpfit.plans.registry import Tables, query, rounded, significant, sql_significant

FLAGS = ["returned", "still_open", "bulky", "discounted", "taxed"]
FLAG_SQL = """
SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
       CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS returned,
       CASE WHEN l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS still_open,
       CASE WHEN l_quantity > 25 THEN 'Yes' ELSE 'No' END AS bulky,
       CASE WHEN l_discount > 0.05 THEN 'Yes' ELSE 'No' END AS discounted,
       CASE WHEN l_tax > 0.04 THEN 'Yes' ELSE 'No' END AS taxed,
       CASE WHEN l_extendedprice > 50000 THEN 'Yes' ELSE 'No' END AS y
FROM lineitem"""
DOC_SQL = """
SELECT doc_id AS id, n_chars, lang, source, quality AS y FROM documents JOIN labels USING (doc_id)"""
PART_SQL = "SELECT p_partkey AS id, p_size, p_type, p_brand, p_retailprice AS y FROM part"
ORDER_SQL = """
SELECT o_orderkey AS id, o_custkey, o_orderpriority, o_orderstatus, o_totalprice / 1000 AS y FROM orders"""
PRICE_SQL = """
SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_extendedprice, l_quantity,
       l_returnflag AS y FROM lineitem"""


def tree_sql(rows: str, features: Sequence[tuple[str, str]], classes: Sequence[str] | None, depth: int,
             min_samples: int, answer: str, reuse: bool = False) -> str:
    """Chained statements growing a tree level by level by trying every split.

    ``features`` pairs each name with yesno, text or number; ``classes`` lists the
    label values as SQL literals, or is None for squared residuals. With ``reuse``
    a feature stays on offer below its split.
    """
    names = [f for f, _ in features]
    gini = classes is not None
    if gini:
        stats = {f"s{i}": f"count(*) FILTER (y = {c})" for i, c in enumerate(classes)}
    else:
        stats = {"s0": "count(*)", "s1": "sum(y - m)", "s2": "sum((y - m) * (y - m))"}
    keys = list(stats)
    agg = ", ".join(f"{e} AS {k}" for k, e in stats.items())
    plus = " + ".join
    size = (lambda p: plus(p + k for k in keys)) if gini else (lambda p: p + "s0")

    def spread(p):
        if gini:
            squares = plus(f"{p}{k}::DOUBLE * {p}{k}" for k in keys)
            return f"coalesce(({size(p)}) * (1 - ({squares}) / nullif(({size(p)})::DOUBLE * ({size(p)}), 0)), 0)"
        return f"({p}s2 - coalesce({p}s1 * {p}s1 / nullif({p}s0, 0), 0))"

    score = f"({spread('l_')} + {spread('r_')})" + (
        f" / ({size('l_')} + {size('r_')})" if gini else "")
    own = f"{spread('')}" + (f" / ({size('')})" if gini else "")
    # squared residuals are ranked by their share of the node's own
    rank = (lambda e: f"round({e}, 10)") if gini else (lambda e: f"CASE WHEN own > 0 THEN round({e} / own, 10) ELSE 0 END")
    mean = "0" if gini else "avg(y) OVER (PARTITION BY path)"
    sql = f"""
WITH src AS MATERIALIZED ({rows}), r0 AS MATERIALIZED (
  SELECT *, {mean} AS m FROM (SELECT *, '' AS path, {', '.join(f'FALSE AS u_{f}' for f in names)} FROM src))
, node0 AS MATERIALIZED (SELECT path, any_value(m) AS m, {agg} FROM r0 GROUP BY path)"""
    for level in range(depth):
        options = []
        for at, (f, kind) in enumerate(features):
            head = f"SELECT c.path, {at} AS f, '{f}' AS feature"
            rest = ", ".join(f"n.{k} - c.{k} AS r_{k}" for k in keys)
            left = ", ".join(f"c.{k} AS l_{k}" for k in keys)
            source = f"FROM r{level} WHERE NOT u_{f}"
            if kind == "yesno":
                yes = ", ".join(f"coalesce({e} FILTER ({f} = 'Yes'), 0) AS l_{k}" if "FILTER" not in e
                                else e.replace("FILTER (", f"FILTER ({f} = 'Yes' AND ") + f" AS l_{k}"
                                for k, e in stats.items())
                no = ", ".join(f"coalesce({e} FILTER ({f} = 'No'), 0) AS r_{k}" if "FILTER" not in e
                               else e.replace("FILTER (", f"FILTER ({f} = 'No' AND ") + f" AS r_{k}"
                               for k, e in stats.items())
                options.append(f"SELECT path, {at} AS f, '{f}' AS feature, NULL::DOUBLE AS threshold, "
                               f"'Yes' AS value, {yes}, {no} {source} GROUP BY path")
            elif kind == "text":
                options.append(
                    f"{head}, NULL::DOUBLE AS threshold, c.{f} AS value, {left}, {rest} FROM "
                    f"(SELECT path, {f}, {agg} {source} GROUP BY ALL) c JOIN node{level} n USING (path) "
                    f"WHERE {size('n.')} > {size('c.')}")
            else:
                run = ", ".join(f"sum({k}) OVER w AS {k}" for k in keys)
                cut = f"({f} + lead({f}) OVER w) / 2" if gini else f"lead({f}) OVER w"
                options.append(
                    f"{head}, c.t::DOUBLE AS threshold, NULL AS value, {left}, {rest} FROM "
                    f"(SELECT path, {cut} AS t, {run} FROM (SELECT path, {f}, {agg} {source} GROUP BY ALL) "
                    f"WINDOW w AS (PARTITION BY path ORDER BY {f})) c JOIN node{level} n USING (path) "
                    f"WHERE c.t IS NOT NULL")
        sql += f"""
, open{level} AS MATERIALIZED (
  SELECT *, {own} AS own FROM node{level} WHERE {size('')} >= {min_samples})
, best{level} AS MATERIALIZED (
  SELECT o.*, {score} AS score, own FROM ({' UNION ALL '.join(options)}) o JOIN open{level} USING (path)
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY {rank(score)}, f, threshold, value) = 1)
, split{level} AS MATERIALIZED (
  SELECT * FROM best{level} WHERE {rank('score')} <= {rank('own')})"""
        below = "<=" if gini else "<"
        turn = " ".join(
            f"WHEN feature = '{f}' THEN " + (
                f"CASE WHEN {f} {below} threshold THEN 'L' ELSE 'R' END" if kind == "number"
                else f"CASE WHEN {f} = value THEN 'L' ELSE 'R' END")
            for f, kind in features)
        used = ", ".join(f"u_{f}" if reuse else f"u_{f} OR feature = '{f}' AS u_{f}" for f in names)
        keep = ", ".join(["id", "y", *names])
        sql += f"""
, r{level + 1} AS MATERIALIZED (
  SELECT *, {mean} AS m FROM (
    SELECT {keep}, path || CASE {turn} END AS path, {used} FROM r{level} JOIN split{level} USING (path)))
, node{level + 1} AS MATERIALIZED (SELECT path, any_value(m) AS m, {agg} FROM r{level + 1} GROUP BY path)"""
    if gini:
        label = "CASE greatest(" + ", ".join(keys) + ") " + " ".join(
            f"WHEN {k} THEN {c}" for k, c in zip(keys, classes)) + " END"
    else:
        label = "m + s1 / s0"
    every = " UNION ALL ".join(f"SELECT * FROM node{i}" for i in range(depth + 1))
    splits = " UNION ALL ".join(f"SELECT path, feature, threshold, value, score FROM split{i}"
                                for i in range(depth))
    ends = " UNION ALL ".join(
        f"SELECT id, y, path FROM r{i}" + (f" WHERE path NOT IN (SELECT path FROM split{i})" if i < depth else "")
        for i in range(depth + 1))
    sql += f"""
, nodes AS MATERIALIZED (SELECT n.*, {own} AS impurity, {label} AS prediction FROM ({every}) n)
, splits AS MATERIALIZED ({splits})
, ends AS MATERIALIZED ({ends})"""
    return sql + answer


def node_answer(keys: int | None) -> str:
    n = "s0" if keys is None else " + ".join(f"s{i}" for i in range(keys))
    prediction = "round(prediction, 6)" if keys is None else "prediction::VARCHAR"
    shown = sql_significant if keys is None else (lambda e: f"round({e}, 9)")
    return f"""
SELECT path, CAST(length(path) AS INTEGER) AS depth, feature, round(threshold, 6) AS threshold, value,
       {shown('score')} AS score, {shown('impurity')} AS impurity, CAST({n} AS BIGINT) AS n,
       {prediction} AS prediction, feature IS NULL AS is_leaf FROM nodes LEFT JOIN splits USING (path)"""


def _nodes(t: Tables, model: TreeModel, numeric: bool = False) -> DataFrame:
    """The node table; squared residuals are told to eight significant digits."""
    prediction, shown = "prediction", lambda c: rounded(c, 9)
    if numeric:
        prediction = rounded(F.col("prediction").cast("double"), 6, "prediction")
        shown = lambda c: significant(c, c)
    return model.node_table(t.spark).select(
        "path", "depth", "feature", rounded("threshold"), "value", shown("score"), shown("impurity"), "n",
        prediction, "is_leaf")


def flags(t: Tables) -> DataFrame:
    def says(condition, name):
        return F.when(condition, "Yes").otherwise("No").alias(name)

    c = F.col
    return t.spread("lineitem").select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        says(c("l_returnflag") == "R", "returned"), says(c("l_linestatus") == "O", "still_open"),
        says(c("l_quantity") > 25, "bulky"), says(c("l_discount") > 0.05, "discounted"),
        says(c("l_tax") > 0.04, "taxed"), says(c("l_extendedprice") > 50000, "y"))


def flag_tree(t: Tables) -> TreeModel:
    return DecisionTree(max_depth=3, num_min_samples=20).fit(flags(t), FLAGS, "y")


FLAG_TREE = (FLAG_SQL, [(f, "yesno") for f in FLAGS], ["'No'", "'Yes'"], 3, 20)


@query("tree_yesno_nodes", tree_sql(*FLAG_TREE, node_answer(2)))
def yesno_nodes(t: Tables) -> DataFrame:
    return _nodes(t, flag_tree(t))


@query("tree_yesno_accuracy", tree_sql(*FLAG_TREE, """
SELECT round(avg((prediction = y)::INT), 9) AS accuracy, count(*) AS n
FROM ends JOIN nodes USING (path)"""))
def yesno_accuracy(t: Tables) -> DataFrame:
    scored = flag_tree(t).transform(flags(t))
    return scored.agg(rounded(metrics.accuracy(F.col("y"), F.col("prediction")), 9, "accuracy"),
                      F.count(F.lit(1)).alias("n"))


def documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "n_chars", "lang", "source").join(t.labels, "doc_id")


def document_tree(t: Tables) -> TreeModel:
    return DecisionTree(max_depth=3, num_min_samples=10).fit(
        documents(t), ["n_chars", "lang", "source"], "quality")


DOC_TREE = (DOC_SQL, [("n_chars", "number"), ("lang", "text"), ("source", "text")], ["0", "1"], 3, 10)


@query("tree_mixed_nodes", tree_sql(*DOC_TREE, node_answer(2)))
def mixed_nodes(t: Tables) -> DataFrame:
    return _nodes(t, document_tree(t))


@query("tree_predict", tree_sql(*DOC_TREE, """
SELECT id AS doc_id, path, prediction FROM ends JOIN nodes USING (path)"""))
def predict(t: Tables) -> DataFrame:
    model = document_tree(t)
    return model.node_paths(model.transform(documents(t))).select("doc_id", "path", "prediction")


@query("tree_many_values", tree_sql(
    PRICE_SQL, [("l_extendedprice", "number"), ("l_quantity", "number")], ["'A'", "'N'", "'R'"], 2, 20,
    node_answer(3)))
def many_values(t: Tables) -> DataFrame:
    model = DecisionTree(max_depth=2).fit(t.spread("lineitem"), ["l_extendedprice", "l_quantity"], "l_returnflag")
    return _nodes(t, model)


PART_TREE = (PART_SQL, [("p_size", "number"), ("p_type", "text"), ("p_brand", "text")], None, 3, 2)


def part_tree(t: Tables) -> TreeModel:
    return RegressionTree(max_depth=3).fit(t.part, ["p_size", "p_type", "p_brand"], "p_retailprice")


@query("regtree_nodes", tree_sql(*PART_TREE, node_answer(None)))
def part_nodes(t: Tables) -> DataFrame:
    return _nodes(t, part_tree(t), numeric=True)


@query("regtree_predict", tree_sql(*PART_TREE, """
SELECT id AS p_partkey, path, round(prediction, 6) AS prediction FROM ends JOIN nodes USING (path)"""))
def part_predict(t: Tables) -> DataFrame:
    model = part_tree(t)
    return model.node_paths(model.transform(t.part)).select("p_partkey", "path", rounded("prediction"))


@query("regtree_orders_nodes", tree_sql(
    ORDER_SQL, [("o_custkey", "number"), ("o_orderpriority", "text"), ("o_orderstatus", "text")], None, 2, 2,
    node_answer(None)))
def order_nodes(t: Tables) -> DataFrame:
    df = t.spread("orders").select("o_custkey", "o_orderpriority", "o_orderstatus",
                         (F.col("o_totalprice") / 1000).alias("y"))
    model = RegressionTree(max_depth=2).fit(df, ["o_custkey", "o_orderpriority", "o_orderstatus"], "y")
    return _nodes(t, model, numeric=True)


DEEP_TREE = (
    "SELECT o_orderkey AS id, o_totalprice, o_custkey, o_orderpriority, o_orderstatus AS y FROM orders",
    [("o_totalprice", "number"), ("o_custkey", "number"), ("o_orderpriority", "text")], ["'F'", "'O'", "'P'"], 14, 60)


@query("tree_deep_predict", tree_sql(*DEEP_TREE, """
SELECT id AS o_orderkey, path, prediction FROM ends JOIN nodes USING (path)""", reuse=True))
def deep_predict(t: Tables) -> DataFrame:
    """A tree of fourteen levels, grown and walked."""
    features = ["o_totalprice", "o_custkey", "o_orderpriority"]
    model = DecisionTree(max_depth=14, num_min_samples=60, reuse_features=True).fit(
        t.spread("orders"), features, "o_orderstatus")
    return model.node_paths(model.transform(t.orders)).select("o_orderkey", "path", "prediction")


def class_rows_sql(rows: str, features: Sequence[tuple[str, str]], depth: int, min_samples: int,
                   candidates: int | None = None) -> str:
    """Like :func:`tree_sql` for any number of classes: counts by class are rows.

    Features are texts or numbers and are not used twice on a path. With ``candidates``
    numbers are split between that many quantile ranges of the whole table only.
    """
    names = [f for f, _ in features]
    if candidates:
        shares = ", ".join(f"{i / candidates!r}" for i in range(1, candidates))
        numbers = [f for f, kind in features if kind == "number"]
        rows = "SELECT s.*, " + ", ".join(
            f"len(list_filter(list_distinct(k_{f}), lambda k: k <= {f})) AS b_{f}" for f in numbers) + f""" FROM ({rows}) s,
  (SELECT {', '.join(f'quantile_disc({f}, [{shares}]) AS k_{f}' for f in numbers)} FROM ({rows}))"""
    spread = lambda n, s: f"CASE WHEN {n} > 0 THEN {n} - {s} / {n} ELSE 0 END"
    sql = f"""
WITH r0 AS MATERIALIZED (SELECT *, '' AS path, {', '.join(f'FALSE AS u_{f}' for f in names)} FROM ({rows}))"""
    for level in range(depth + 1):
        sql += f"""
, c{level} AS MATERIALIZED (SELECT path, y, count(*)::DOUBLE AS t FROM r{level} GROUP BY ALL)
, node{level} AS MATERIALIZED (SELECT path, sum(t) AS n, sum(t * t) AS s, arg_min(y, (-t, y)) AS prediction, count(*) AS n_classes
                               FROM c{level} GROUP BY path)"""
        if level == depth:
            break
        options = []
        for at, (f, kind) in enumerate(features):
            x = f"b_{f}" if kind == "number" and candidates else f
            ends = f"min({f}) AS low, max({f}) AS high" if kind == "number" else "NULL AS low, NULL AS high"
            counts = f"(SELECT path, {x} AS x, y, count(*)::DOUBLE AS n, {ends} FROM r{level} WHERE NOT u_{f} GROUP BY path, {x}, y)"
            if kind == "text":
                options.append(f"""
SELECT path, {at} AS f, '{f}' AS feature, NULL::DOUBLE AS threshold, x AS value, sum(n) AS n_l, sum(n * n) AS s_l,
       sum(n * t) AS t_l FROM {counts} JOIN c{level} USING (path, y) GROUP BY path, x""")
            else:
                options.append(f"""
SELECT path, {at} AS f, '{f}' AS feature, (high + lead(low) OVER w) / 2 AS threshold, NULL AS value, sum(n) OVER w AS n_l,
       sum(s) OVER w AS s_l, sum(t) OVER w AS t_l FROM (
  SELECT path, x, sum(n) AS n, sum(n * n + 2 * n * coalesce(before, 0)) AS s, sum(n * t) AS t, min(low) AS low, max(high) AS high FROM (
    SELECT *, sum(n) OVER (PARTITION BY path, y ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM {counts}) JOIN c{level} USING (path, y) GROUP BY path, x) WINDOW w AS (PARTITION BY path ORDER BY x)""")
        score = f"({spread('n_l', 's_l')} + {spread('(n - n_l)', '(s - 2 * t_l + s_l)')}) / n"
        turn = " ".join(f"WHEN feature = '{f}' THEN " + (f"{f} <= threshold" if kind == "number" else f"{f} = value")
                        for f, kind in features)
        used = ", ".join(f"u_{f} OR feature = '{f}' AS u_{f}" for f in names)
        sql += f"""
, split{level} AS MATERIALIZED (
  SELECT path, feature, threshold, value, {score} AS score FROM ({' UNION ALL '.join(options)}) JOIN node{level} USING (path)
  WHERE n >= {min_samples} AND n_l < n AND (value IS NOT NULL OR threshold IS NOT NULL)
    AND round({score}, 10) <= round(1 - s / n / n, 10)
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY round({score}, 10), f, threshold, value) = 1)
, r{level + 1} AS MATERIALIZED (
  SELECT y, {', '.join(names + [f'b_{f}' for f, kind in features if kind == 'number' and candidates])},
         path || CASE WHEN CASE {turn} END THEN 'L' ELSE 'R' END AS path, {used}
  FROM r{level} JOIN split{level} USING (path))"""
    every = " UNION ALL ".join(f"SELECT * FROM node{i}" for i in range(depth + 1))
    splits = " UNION ALL ".join(f"SELECT * FROM split{i}" for i in range(depth))
    return sql + f"""
SELECT path, CAST(length(path) AS INTEGER) AS depth, feature, round(threshold, 6) AS threshold, value,
       round(score, 9) AS score, round(1 - s / n / n, 9) AS impurity, CAST(n AS BIGINT) AS n, n_classes,
       prediction::VARCHAR AS prediction, feature IS NULL AS is_leaf FROM ({every}) LEFT JOIN ({splits}) USING (path)"""


@query("tree_many_classes", class_rows_sql(
    "SELECT l_extendedprice, l_quantity, l_returnflag, l_orderkey AS y FROM lineitem",
    [("l_extendedprice", "number"), ("l_quantity", "number"), ("l_returnflag", "text")], 3, 20))
def many_classes(t: Tables) -> DataFrame:
    """One class per order."""
    features = ["l_extendedprice", "l_quantity", "l_returnflag"]
    model = DecisionTree(max_depth=3).fit(t.spread("lineitem"), features, "l_orderkey")
    return model.node_table(t.spark).select(
        "path", "depth", "feature", rounded("threshold"), "value", rounded("score", 9), rounded("impurity", 9), "n",
        "n_classes", "prediction", "is_leaf")


@query("tree_candidate_cap", class_rows_sql(
    "SELECT p_retailprice, p_size, p_type, p_brand AS y FROM part",
    [("p_retailprice", "number"), ("p_size", "number"), ("p_type", "text")], 3, 20, candidates=16))
def candidate_cap(t: Tables) -> DataFrame:
    """Sixteen quantile ranges per number instead of all thresholds."""
    model = DecisionTree(max_depth=3, candidates=16).fit(t.part, ["p_retailprice", "p_size", "p_type"], "p_brand")
    return model.node_table(t.spark).select(
        "path", "depth", "feature", rounded("threshold"), "value", rounded("score", 9), rounded("impurity", 9), "n",
        F.size("class_counts").cast("long").alias("n_classes"), "prediction", "is_leaf")


def _candidates_sql(rows: str, features: Sequence[tuple[str, str]], classes: Sequence[str] | None) -> str:
    """Every split of all rows with its score, from counts or centred sums of both sides."""
    if classes is not None:
        stats = {f"s{i}": f"count(*) FILTER (y = {c})" for i, c in enumerate(classes)}
    else:
        stats = {"s0": "count(*)", "s1": "sum(y - m)", "s2": "sum((y - m) * (y - m))"}
    keys = list(stats)
    agg = ", ".join(f"{e} AS {k}" for k, e in stats.items())
    n = (lambda p: "(" + " + ".join(p + k for k in keys) + ")") if classes else (lambda p: f"{p}s0")

    def spread(p):
        if classes:
            squares = " + ".join(f"{p}{k}::DOUBLE * {p}{k}" for k in keys)
            return f"({n(p)} - ({squares}) / {n(p)})"
        return f"({p}s2 - {p}s1 * {p}s1 / {p}s0)"

    score = f"({spread('l_')} + {spread('r_')})" + (f" / ({n('l_')} + {n('r_')})" if classes else "")
    own = spread("t_") + (f" / {n('t_')}" if classes else "")
    options = []
    for f, kind in features:
        sides = ", ".join(f"c.{k} AS l_{k}, t.{k} - c.{k} AS r_{k}, t.{k} AS t_{k}" for k in keys)
        if kind == "number":
            run = ", ".join(f"sum({k}) OVER w AS {k}" for k in keys)
            cut = f"({f} + lead({f}) OVER w) / 2" if classes else f"lead({f}) OVER w"
            options.append(f"""
SELECT '{f}' AS feature, c.cut::DOUBLE AS threshold, NULL AS value, {sides} FROM (
  SELECT {cut} AS cut, {run} FROM (SELECT {f}, {agg} FROM src GROUP BY {f}) WINDOW w AS (ORDER BY {f})) c, t
WHERE c.cut IS NOT NULL""")
        else:
            only = f"WHERE {f} = 'Yes'" if kind == "yesno" else ""
            options.append(f"""
SELECT '{f}' AS feature, NULL::DOUBLE AS threshold, c.{f}::VARCHAR AS value, {sides} FROM (
  SELECT {f}, {agg} FROM src {only} GROUP BY {f}) c, t WHERE {n('t.')} > {n('c.')}""")
    shown = (lambda e: f"round({e}, 9)") if classes else sql_significant
    return f"""
WITH src AS MATERIALIZED (SELECT *, avg({'0' if classes else 'y'}) OVER () AS m FROM ({rows})),
t AS (SELECT {agg} FROM src)
SELECT feature, round(threshold, 6) AS threshold, value, {shown(score)} AS score, {shown(own)} AS own,
       CAST({n('l_')} AS BIGINT) AS n_left, CAST({n('r_')} AS BIGINT) AS n_right
FROM ({' UNION ALL '.join(options)})"""


def _listed(df: DataFrame, numeric: bool) -> DataFrame:
    shown = (lambda c: significant(c, c)) if numeric else (lambda c: rounded(c, 9))
    return df.select("feature", rounded("threshold"), "value", shown("score"), shown("own"), "n_left", "n_right")


@query("gini_root", _candidates_sql(FLAG_SQL, [(f, "yesno") for f in FLAGS], ["'No'", "'Yes'"]))
def gini_root(t: Tables) -> DataFrame:
    return _listed(DecisionTree().candidate_splits(flags(t), FLAGS, "y"), False)


@query("gini_thresholds", _candidates_sql(PRICE_SQL, [("l_extendedprice", "number"), ("l_quantity", "number")],
                                          ["'A'", "'N'", "'R'"]))
def gini_thresholds(t: Tables) -> DataFrame:
    return _listed(DecisionTree().candidate_splits(
        t.lineitem, ["l_extendedprice", "l_quantity"], "l_returnflag"), False)


@query("ssr_thresholds", _candidates_sql(ORDER_SQL, [("o_custkey", "number")], None))
def ssr_thresholds(t: Tables) -> DataFrame:
    df = t.orders.select("o_custkey", (F.col("o_totalprice") / 1000).alias("y"))
    return _listed(RegressionTree().candidate_splits(df, ["o_custkey"], "y"), True)


@query("ssr_categorical", _candidates_sql(
    PART_SQL, [("p_size", "number"), ("p_type", "text"), ("p_brand", "text")], None))
def ssr_categorical(t: Tables) -> DataFrame:
    return _listed(RegressionTree().candidate_splits(
        t.part, ["p_size", "p_type", "p_brand"], "p_retailprice"), True)
