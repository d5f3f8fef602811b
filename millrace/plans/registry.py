"""Register of the named queries and of the SQL text each one is compared with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class NamedQuery:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, NamedQuery] = {}


def query(name: str, oracle: str | None = None):
    """Decorator: file a (tables) -> DataFrame function under ``name``."""

    def file_it(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = NamedQuery(lambda spark, sf_dir: fn(Tables(spark, sf_dir)), oracle)
        return fn

    return file_it


class Tables:
    """The parquet tables of one directory, read on attribute access."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
