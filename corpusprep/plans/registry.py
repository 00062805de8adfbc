"""Query registry: one function and, where SQL can say it, one equivalent statement per name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ..session import pin_utc, spread

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

MODULES = ["text_queries", "record_queries", "table_queries", "metric_queries", "label_queries", "stream_queries", "file_queries"]


class Tables:
    """The given tables of one folder, read on access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin_utc(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name == "events":
            df = df.withColumn("ts", df["ts"].cast("timestamp"))
        return df

    def spread(self, name: str, key: str) -> DataFrame:
        """A table for text-heavy work: at least one partition per core."""
        return spread(getattr(self, name), key)


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name``."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql:
            _SQL[name] = sql
        return function

    return register


def _load() -> None:
    for module in MODULES:
        import_module(f"{__package__}.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
