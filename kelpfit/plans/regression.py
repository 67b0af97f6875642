"""Line fits on line items: quantity against price in thousands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.operators import linreg, metrics
from kelpfit.plans.registry import Tables, query, rounded

PLACES = 6
ITEM_SQL = """
WITH item AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS x,
         l_extendedprice / 1000 AS y, 1 - l_discount AS w
  FROM lineitem
), line AS (
  SELECT regr_intercept(y, x) AS intercept, regr_slope(y, x) AS slope FROM item
), scored AS (
  SELECT item.*, intercept + slope * x AS p, y - (intercept + slope * x) AS r FROM item, line
)
"""


def items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000).alias("y"), (1 - F.col("l_discount")).alias("w"))


def _rounded_line(df: DataFrame) -> DataFrame:
    return df.select(rounded("intercept"), rounded("slope"))


@query("linreg_fit", ITEM_SQL + "SELECT round(intercept, 6) AS intercept, round(slope, 6) AS slope FROM line")
def line_fit(t: Tables) -> DataFrame:
    return _rounded_line(linreg.coefficients(items(t), "x", "y"))


@query("linreg_origin", ITEM_SQL + """
SELECT 0.0::DOUBLE AS intercept, round(sum(x * y) / sum(x * x), 6) AS slope FROM item""")
def line_through_origin(t: Tables) -> DataFrame:
    return _rounded_line(linreg.coefficients(items(t), "x", "y", fit_intercept=False))


@query("linreg_weighted", ITEM_SQL + """
, m AS (SELECT avg(x) AS mx, avg(y) AS my FROM item),
s AS (SELECT sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS slope FROM item, m)
SELECT round(my - slope * mx, 6) AS intercept, round(slope, 6) AS slope FROM s, m""")
def line_weighted(t: Tables) -> DataFrame:
    return _rounded_line(linreg.coefficients(items(t), "x", "y", weight="w"))


@query("linreg_weighted_means", ITEM_SQL + """
, m AS (SELECT sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM item),
s AS (SELECT sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS slope FROM item, m)
SELECT round(my - slope * mx, 6) AS intercept, round(slope, 6) AS slope FROM s, m""")
def line_weighted_means(t: Tables) -> DataFrame:
    return _rounded_line(linreg.coefficients(items(t), "x", "y", weight="w", weighted_means=True))


@query("linreg_weighted_origin", ITEM_SQL + """
SELECT 0.0::DOUBLE AS intercept, round(sum(w * x * y) / sum(w * x * x), 6) AS slope FROM item""")
def line_weighted_origin(t: Tables) -> DataFrame:
    return _rounded_line(linreg.coefficients(items(t), "x", "y", weight="w", fit_intercept=False))


@query("linreg_predict", ITEM_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(p, 4) AS prediction FROM scored""")
def line_predict(t: Tables) -> DataFrame:
    df = items(t)
    scored = linreg.fit(df, "x", "y").transform(df)
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         rounded("prediction", 4))


@query("linreg_residuals", ITEM_SQL + """
SELECT x, y, round(p, 4) AS prediction, round(r, 4) AS residual FROM scored""")
def line_residuals(t: Tables) -> DataFrame:
    df = items(t)
    return linreg.fit(df, "x", "y").residuals(df, "y").select(
        "x", "y", rounded("prediction", 4), rounded("residual", 4))


@query("linreg_metrics", ITEM_SQL + """
SELECT round(avg((y - p) * (y - p)), 6) AS mse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 9) AS r2,
       round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse
FROM scored""")
def line_metrics(t: Tables) -> DataFrame:
    df = items(t)
    y, p = F.col("y"), F.col("prediction")
    return linreg.fit(df, "x", "y").transform(df).agg(
        rounded(metrics.mse(y, p), 6, "mse"), rounded(metrics.r_squared(y, p), 9, "r2"),
        rounded(metrics.mae(y, p), 6, "mae"), rounded(metrics.rmse(y, p), 6, "rmse"))


@query("linreg_residual_hist", ITEM_SQL + """
, edge AS (SELECT min(r) AS lo, max(r) AS hi, (max(r) - min(r)) / 15 AS width FROM scored)
, counted AS (SELECT CAST(least(floor((r - lo) / width) + 1, 15) AS INTEGER) AS bin, count(*) AS n
              FROM scored, edge GROUP BY ALL)
SELECT b.bin, round(lo + (b.bin - 1) * width, 6) AS bin_start, coalesce(n, 0) AS n
FROM (SELECT unnest(range(1, 16))::INTEGER AS bin) b LEFT JOIN counted USING (bin), edge""")
def line_histogram(t: Tables) -> DataFrame:
    df = items(t)
    return linreg.fit(df, "x", "y").residual_histogram(df, "y", 15).select(
        "bin", rounded("bin_start"), "n")


@query("linreg_by_group", """
SELECT l_returnflag, ship_year, count(*) AS n, round(regr_intercept(y, x), 6) AS intercept,
       round(regr_slope(y, x), 6) AS slope
FROM (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_quantity AS x,
             l_extendedprice / 1000 AS y FROM lineitem)
GROUP BY ALL""")
def line_by_group(t: Tables) -> DataFrame:
    """One line per return flag and year of shipping, all in one aggregate."""
    df = t.lineitem.select(
        "l_returnflag", F.year("l_shipdate").alias("ship_year"), F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000).alias("y"))
    return linreg.coefficients_by(df, ["l_returnflag", "ship_year"], "x", "y").select(
        "l_returnflag", "ship_year", "n", rounded("intercept"), rounded("slope"))
