"""Warehouses that plans can read: stored tables, and tables loaded from sources.

A warehouse is any object with ``spark`` and one attribute per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kalulu.sources.normalise import NormalisedWarehouse
from kalulu.sources.schema import SOURCES, WAREHOUSE, conform, struct_type


class StoredWarehouse:
    """Tables under one root (a path of any store that Spark reads), each in a
    folder of its name, read with its declared schema: nothing is inferred."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCES and name not in WAREHOUSE:
            raise AttributeError(name)
        return self.spark.read.schema(struct_type(name)).format(self.fmt).load(f"{self.root}/{name}")


class LoadedWarehouse:
    """The warehouse that the loaders make of a source: every ``mw_`` table is
    its loader's output in the declared types, the other tables are the
    source's.  Lazy: a report over it is one plan from observations to counts."""

    def __init__(self, source):
        self.source, self.spark = NormalisedWarehouse(source), source.spark

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__") or name in ("source", "spark"):
            raise AttributeError(name)
        if name in WAREHOUSE:
            from kalulu.plans.refresh import LOADERS
            table = conform(LOADERS[name](self.source), name)
        else:
            table = getattr(self.source, name)
        self.__dict__[name] = table        # one plan per table, whoever reads it
        return table
