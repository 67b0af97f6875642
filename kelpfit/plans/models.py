"""Fitted models that are stored, loaded again, and predict as the ones in memory do."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.operators import linreg
from kelpfit.operators.knn import KNNClassifier
from kelpfit.operators.store import load_model, store_model
from kelpfit.plans import clustering, neighbours, regression, trees
from kelpfit.plans.registry import ORACLES, Tables, query, rounded
from kelpfit.session import shared_path


def reloaded(t: Tables, model):
    """A model after a round trip through the shared folder."""
    folder = shared_path(t.spark, f"models-{uuid.uuid4().hex}")
    return load_model(t.spark, folder, store_model(t.spark, model, folder))


@query("stored_line_predict", ORACLES["linreg_predict"])
def line(t: Tables) -> DataFrame:
    df = regression.items(t)
    return reloaded(t, linreg.fit(df, "x", "y")).transform(df).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rounded("prediction", 4))


@query("stored_kmeans_predict", ORACLES["kmeans_predict"])
def kmeans(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(
        "s_suppkey", F.col("s_acctbal").alias("c_acctbal"), F.col("s_nationkey").alias("c_nationkey"))
    return reloaded(t, clustering.fitted(t, 2)).transform(suppliers).select("s_suppkey", "cluster")


@query("stored_tree_predict", ORACLES["tree_predict"])
def tree(t: Tables) -> DataFrame:
    model = reloaded(t, trees.document_tree(t))
    return model.node_paths(model.transform(trees.documents(t))).select("doc_id", "path", "prediction")


@query("stored_knn_vote", ORACLES["knn_vote"])
def knn(t: Tables) -> DataFrame:
    train, test = neighbours.vectors(t)
    return reloaded(t, KNNClassifier(neighbours.K).fit(train, "embedding", "label", "vec_id")).predict(test)
