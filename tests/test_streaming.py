import numpy as np
from pyspark.sql import functions as F

from kelpfit.operators import linreg
from kelpfit.operators.kmeans import KMeans
from kelpfit.operators.knn import KNNClassifier
from kelpfit.operators.network import Layer, Network
from kelpfit.operators.neuron import Neuron
from kelpfit.operators.tree import DecisionTree
from kelpfit.streaming.scoring import knn_stream, score_stream


def run(stream, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def test_fitted_models_score_streams(spark, tmp_path):
    df = spark.range(60).select(
        "id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"),
        ((F.col("id") % 10) > 4).cast("int").alias("y"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    models = {
        "line": linreg.fit(df, "x", "z"),
        "kmeans": KMeans(k=2, random_state=1).fit(df, ["x", "z"], "id"),
        "tree": DecisionTree(max_depth=2).fit(df, ["x", "z"], "y"),
        "neuron": Neuron(epochs=1, batches=0, random_state=1).fit(df, ["x", "z"], "y"),
    }
    net = Network.random((Layer(2, 2), Layer(2, 1, "sigmoid")), 1)
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for name, model in models.items():
        run(score_stream(model, stream), f"scored_{name}")
        got = {r["id"]: r["prediction"] for r in spark.table(f"scored_{name}").collect()}
        assert got == {r["id"]: r["prediction"] for r in model.transform(df, "prediction").collect()}
    run(net.transform(stream, ["x", "z"]), "scored_network")
    got = [r["prediction"] for r in spark.table("scored_network").orderBy("id").collect()]
    assert np.allclose(got, [r["prediction"] for r in net.transform(df, ["x", "z"]).orderBy("id").collect()])


def test_neighbours_answer_micro_batches(spark, tmp_path):
    train = spark.createDataFrame([(i, float(i), i // 10) for i in range(30)], "id int, x double, y int")
    queries = spark.createDataFrame([(100 + i, i * 3 + 0.2) for i in range(10)], "id int, x double")
    queries.repartition(2).write.parquet(str(tmp_path / "in"))
    model = KNNClassifier(3).fit(train, ["x"], "y", "id")
    out = str(tmp_path / "out")
    stream = spark.readStream.schema(queries.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = knn_stream(
        model, stream, "id",
        lambda df, number: df.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r["id"]: r["prediction"] for r in spark.read.parquet(out).collect()}
    assert got == {r["id"]: r["prediction"] for r in model.predict(queries).collect()}
    assert spark.read.parquet(out).select("batch").distinct().count() == 2
