"""Where queries register themselves, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpfit.session import ship_package
from kelpfit.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def spread(self, name: str) -> DataFrame:
        """A table about to be passed over many times."""
        return read_table(self.spark, self.folder, name, spread=True)


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name``."""

    def add(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def broadcast_if_few(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A hint to broadcast a table once it is known to have at most so many rows."""
    few = df.limit(most + 1).count() <= most
    return F.broadcast(df) if few else df


def rounded(column: str | Column, places: int = 6, name: str | None = None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, places).alias(name or column)


def significant(column: str | Column, name: str, digits: int = 8) -> Column:
    """A number that is not negative, to so many significant digits; below 1e-6 it counts as 0."""
    c = F.col(column) if isinstance(column, str) else column
    unit = F.pow(F.lit(10.0), F.floor(F.log10(c)))
    return F.when(c < 1e-6, 0.0).otherwise(F.round(c / unit, digits - 1) * unit).alias(name)


def sql_significant(text: str, digits: int = 8) -> str:
    """SQL for :func:`significant`."""
    unit = f"pow(10.0::DOUBLE, floor(log10({text})))"
    return f"CASE WHEN {text} < 1e-6 THEN 0.0::DOUBLE ELSE round({text} / {unit}, {digits - 1}) * {unit} END"


def sql_uniform(seed: str, key: str) -> str:
    """SQL for the seeded uniform of a key expression."""
    return f"((('0x'||substr(md5('{seed}:'||{key}),1,8))::BIGINT + 0.5::DOUBLE)/4294967296.0::DOUBLE)"


def sql_normal(text: str) -> str:
    """SQL for the seeded standard normal of a text expression."""
    u = f"((('0x'||substr(md5({text}),1,8))::BIGINT + 0.5::DOUBLE)/4294967296.0::DOUBLE)"
    v = f"((('0x'||substr(md5({text}),9,8))::BIGINT + 0.5::DOUBLE)/4294967296.0::DOUBLE)"
    return f"(sqrt(-2.0::DOUBLE*ln({u}))*cos({v}*2*pi()))"
