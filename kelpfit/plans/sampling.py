"""Splits, samples and mini-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.operators import split
from kelpfit.plans.registry import Tables, query


def ranked_sql(table: str, key: str, seed: str, columns: str = "*") -> str:
    return f"""
WITH ranked AS (
  SELECT {columns}, row_number() OVER (ORDER BY md5('{seed}:' || {key})) AS r, count(*) OVER () AS n
  FROM {table}
)
"""


@query("split_exact", ranked_sql("customer", "c_custkey", "7") + """
SELECT c_custkey, CASE WHEN r <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM ranked""")
def split_exact(t: Tables) -> DataFrame:
    return split.with_split(t.customer, "c_custkey", training_size=0.8, random_state=7).select(
        "c_custkey", "split")


@query("split_test_share", ranked_sql("orders", "o_orderkey", "3") + """
SELECT CASE WHEN r <= floor((1 - 0.15::DOUBLE) * n) THEN 'train' ELSE 'test' END AS part,
       o_orderkey, o_totalprice FROM ranked""")
def split_test_share(t: Tables) -> DataFrame:
    train, test = split.train_test_split(t.orders, "o_orderkey", testing_size=0.15, random_state=3)
    return train.select(F.lit("train").alias("part"), "o_orderkey", "o_totalprice").unionByName(
        test.select(F.lit("test").alias("part"), "o_orderkey", "o_totalprice"))


@query("split_paired", ranked_sql("orders", "o_orderkey", "11") + """
SELECT s.side || CASE WHEN r <= floor(0.7::DOUBLE * n) THEN '_train' ELSE '_test' END AS part, o_orderkey
FROM ranked, (VALUES ('X'), ('y')) AS s(side)""")
def split_paired(t: Tables) -> DataFrame:
    X = t.orders.select("o_orderkey", "o_totalprice")
    y = t.orders.select("o_orderkey", "o_orderstatus")
    parts = split.paired_split(X, y, "o_orderkey", training_size=0.7, random_state=11)
    out = None
    for name, part in zip(("X_train", "X_test", "y_train", "y_test"), parts):
        rows = part.select(F.lit(name).alias("part"), "o_orderkey")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("split_counts", ranked_sql("customer", "c_custkey", "5") + """
SELECT c_custkey, CASE WHEN r <= 100 THEN 'train' ELSE 'test' END AS split FROM ranked""")
def split_counts(t: Tables) -> DataFrame:
    return split.with_split(t.customer, "c_custkey", training_size=100, random_state=5).select(
        "c_custkey", "split")


@query("split_both_sizes", ranked_sql("labels", "doc_id", "5") + """
SELECT doc_id, CASE WHEN r <= floor(0.5::DOUBLE * n) THEN 'train'
                    WHEN r <= floor(0.5::DOUBLE * n) + floor(0.3::DOUBLE * n) THEN 'test' END AS split
FROM ranked""")
def split_both_sizes(t: Tables) -> DataFrame:
    return split.with_split(
        t.labels, "doc_id", training_size=0.5, testing_size=0.3, random_state=5).select("doc_id", "split")


@query("split_shuffled", ranked_sql("part", "p_partkey", "9/3") + """
SELECT p_partkey, CASE WHEN r <= floor(0.75::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM ranked""")
def split_shuffled(t: Tables) -> DataFrame:
    return split.with_split(t.part, "p_partkey", random_state=9, num_shuffles=3).select(
        "p_partkey", "split")


@query("split_composite_key", ranked_sql(
    "lineitem", "concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey)", "2") + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN r <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM ranked""")
def split_composite_key(t: Tables) -> DataFrame:
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return split.with_split(t.lineitem, key, training_size=0.8, random_state=2).select(*key, "split")


@query("split_repeated_key", """
WITH rows AS (SELECT l_linenumber, l_orderkey, l_partkey, l_suppkey, md5('6:' || l_linenumber) AS h,
                     md5(concat_ws(chr(1), l_linenumber, l_orderkey, l_partkey, l_suppkey)) AS c FROM lineitem),
ranked AS (SELECT *, row_number() OVER (ORDER BY h, c) AS r, count(*) OVER () AS n FROM rows)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN r <= floor(0.7::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM ranked""")
def split_repeated_key(t: Tables) -> DataFrame:
    """A key of seven values: the parts end between rows that share it."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return split.with_split(t.lineitem.select(*columns), "l_linenumber", training_size=0.7, random_state=6)


@query("permute_rows", ranked_sql("customer", "c_custkey", "13") + """
SELECT c_custkey, r - 1 AS position FROM ranked""")
def permute_rows(t: Tables) -> DataFrame:
    return split.permute(t.customer, "c_custkey", 13).select("c_custkey", "position")


@query("sample_rows", ranked_sql("customer", "c_custkey", "4") + """
SELECT c_custkey, c_acctbal FROM ranked WHERE r <= 50""")
def sample_rows(t: Tables) -> DataFrame:
    return split.sample_rows(t.customer, "c_custkey", 50, 4).select("c_custkey", "c_acctbal")


@query("mini_batches", ranked_sql("events", "event_id", "21:1") + """
SELECT event_id, CAST((r - 1) // greatest(1, n // 10) AS INTEGER) AS batch FROM ranked""")
def mini_batches(t: Tables) -> DataFrame:
    return split.with_batches(t.events, "event_id", 21, 1).select("event_id", "batch")
