"""Fitted models on streaming tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from kelpfit.operators.knn import KNNClassifierModel, KNNRegressorModel


def score_stream(model, stream: DataFrame, name: str = "prediction", features=None) -> DataFrame:
    """Lines, clusterings, trees, neurons and networks are stateless columns, so they just apply.

    A network does not know its inputs: name its ``features``.
    """
    return model.transform(stream, name) if features is None else model.transform(stream, features, name)


def knn_stream(
    model: KNNClassifierModel | KNNRegressorModel,
    stream: DataFrame,
    query_key: str,
    write: Callable[[DataFrame, int], None],
    **options,
) -> DataStreamWriter:
    """Answer every micro-batch of queries against the stored training table.

    The join ranks neighbours, which a streaming plan cannot; each micro-batch
    runs as a batch job and goes to ``write`` with its number, so a sink keyed
    by that number stays exactly-once.
    """

    def answer(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            write(model.predict(batch, query_key, **options), number)

    return stream.writeStream.foreachBatch(answer)
