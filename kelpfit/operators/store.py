"""Fitted models on disk, in numbered versions.

A version is a folder with one row of JSON and a Parquet table for every table that the
model holds. It is written under another name first and appears by one rename, so
readers see whole versions only; a version is never changed.
"""

from __future__ import annotations

import datetime
import decimal
import json
import uuid
from dataclasses import fields, is_dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kelpfit.operators.kmeans import KMeansModel
from kelpfit.operators.knn import (
    Cells, Index, KNNClassifier, KNNClassifierModel, KNNRegressor, KNNRegressorModel,
)
from kelpfit.operators.linreg import LineModel
from kelpfit.operators.neuron import NeuronModel
from kelpfit.operators.scaling import Scaler
from kelpfit.operators.tree import Node, TreeModel

FORMAT = 1
CLASSES = {c.__name__: c for c in (
    LineModel, KMeansModel, Scaler, TreeModel, Node, NeuronModel, Cells, Index, KNNClassifier, KNNRegressor,
    KNNClassifierModel, KNNRegressorModel)}


def _encoded(value, tables: dict[str, DataFrame]):
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if isinstance(value, DataFrame):
        name = f"table{len(tables)}"
        tables[name] = value
        return {"table": name}
    if is_dataclass(value) and type(value).__name__ in CLASSES:
        return {"class": type(value).__name__,
                "fields": {f.name: _encoded(getattr(value, f.name), tables) for f in fields(value)}}
    if isinstance(value, T.DataType):
        return {"type": value.jsonValue()}
    if isinstance(value, np.ndarray):
        return {"array": value.tolist(), "dtype": str(value.dtype)}
    if isinstance(value, np.generic):
        return value.item()
    if isinstance(value, tuple):
        return {"tuple": [_encoded(v, tables) for v in value]}
    if isinstance(value, list):
        return [_encoded(v, tables) for v in value]
    if isinstance(value, dict):
        return {"dict": [[_encoded(k, tables), _encoded(v, tables)] for k, v in value.items()]}
    if isinstance(value, datetime.datetime):
        return {"datetime": value.isoformat()}
    if isinstance(value, datetime.date):
        return {"date": value.isoformat()}
    if isinstance(value, decimal.Decimal):
        return {"decimal": str(value)}
    raise TypeError(f"a model with a {type(value).__name__} cannot be stored")


def _decoded(value, table):
    if isinstance(value, list):
        return [_decoded(v, table) for v in value]
    if not isinstance(value, dict):
        return value
    if "table" in value:
        return table(value["table"])
    if "class" in value:
        return CLASSES[value["class"]](**{k: _decoded(v, table) for k, v in value["fields"].items()})
    if "type" in value:
        return T._parse_datatype_json_value(value["type"])
    if "array" in value:
        return np.array(value["array"], dtype=value["dtype"])
    if "tuple" in value:
        return tuple(_decoded(v, table) for v in value["tuple"])
    if "dict" in value:
        return {_decoded(k, table): _decoded(v, table) for k, v in value["dict"]}
    if "datetime" in value:
        return datetime.datetime.fromisoformat(value["datetime"])
    if "date" in value:
        return datetime.date.fromisoformat(value["date"])
    return decimal.Decimal(value["decimal"])


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the stored versions, in order."""
    files, Path = _files(spark, folder)
    if not files.exists(Path(folder)):
        return []
    names = [s.getPath().getName() for s in files.listStatus(Path(folder))]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def store_model(spark: SparkSession, model, folder: str) -> int:
    """Store a fitted model as the next version in ``folder`` and return its number."""
    folder, tables = folder.rstrip("/"), {}
    text = json.dumps({"format": FORMAT, "model": _encoded(model, tables)})
    draft = f"{folder}/_draft-{uuid.uuid4().hex}"
    spark.createDataFrame([(text,)], "model string").coalesce(1).write.parquet(f"{draft}/model")
    for name, df in tables.items():
        df.write.parquet(f"{draft}/{name}")
    files, Path = _files(spark, folder)
    version = max(versions(spark, folder), default=0)
    while True:
        version += 1
        goal = Path(f"{folder}/version={version}")
        # somebody else may have taken the number: a folder that is there is left alone
        if not files.exists(goal) and files.rename(Path(draft), goal):
            return version


def load_model(spark: SparkSession, folder: str, version: int | None = None):
    """A stored model, the latest version unless one is named; any session may load it."""
    known = versions(spark, folder)
    if not known or version is not None and version not in known:
        raise ValueError(f"no such stored model: {folder} version {version}")
    path = f"{folder.rstrip('/')}/version={version or known[-1]}"
    found = json.loads(spark.read.parquet(f"{path}/model").first()["model"])
    if found["format"] != FORMAT:
        raise ValueError(f"stored in format {found['format']}, not {FORMAT}")
    return _decoded(found["model"], lambda name: spark.read.parquet(f"{path}/{name}"))
