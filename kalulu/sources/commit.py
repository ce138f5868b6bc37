"""Commits of several tables at once.

A commit writes the new rows of every table into a folder of its own
(``<table>/batch=<id>/<attempt>``) and then one row into ``_manifest``: the
version, the batches so far and, for each table, the folders that make it up.
Readers take the newest manifest row.  That row is a single file, which Spark
moves into place when its job commits, so either all tables of a batch are
there or none: after a crash the old state is read, and folders that no manifest names
are never looked at.  A batch that the manifest holds already is not
loaded again.  One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from kalulu.sources.schema import SOURCES, WAREHOUSE, struct_type
from kalulu.sources.tables import write_table

_MANIFEST = "version bigint, batches array<string>, tables map<string, array<string>>"


class Commits:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def state(self) -> tuple[int, list[str], dict[str, list[str]]]:
        """Version, batches and folders by table; version 0 where nothing is committed."""
        try:
            rows = self.spark.read.schema(_MANIFEST).json(f"{self.root}/_manifest/*")
            newest = rows.orderBy(rows.version.desc()).first()
        except AnalysisException:           # no manifest yet
            newest = None
        return (newest.version, list(newest.batches), {t: list(f) for t, f in newest.tables.items()}) if newest else (0, [], {})

    def commit(self, batch: str, tables: dict[str, Callable[[], DataFrame] | DataFrame], replace: bool = False) -> bool:
        """Adds (or with ``replace`` puts in place of what is there) the rows of ``tables``; False if the batch is there already.

        A table may be given as a function, called only if the batch is new.
        """
        version, batches, folders = self.state()
        if batch in batches:
            return False
        name = re.sub(r"[^A-Za-z0-9_.-]", "_", batch)
        for table, rows in tables.items():
            folder = f"{table}/batch={name}/{uuid.uuid4().hex}"
            write_table(rows() if callable(rows) else rows, f"{self.root}/{folder}", mode="errorifexists",
                        sort_within=["patient_id"] if any(n == "patient_id" for n, _ in WAREHOUSE.get(table, [])) else None)
            folders[table] = [folder] if replace else [*folders.get(table, []), folder]
        row = self.spark.createDataFrame([(version + 1, [*batches, batch], folders)], _MANIFEST)
        row.coalesce(1).write.mode("errorifexists").json(f"{self.root}/_manifest/{version + 1:012d}")
        return True


class CommittedWarehouse:
    """The tables of the newest commit when it was opened, read with their declared schemas."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.version, self.batches, self.folders = Commits(spark, root).state()

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCES and name not in WAREHOUSE:
            raise AttributeError(name)
        paths = [f"{self.root}/{x}" for x in self.folders.get(name, [])]
        if not paths:
            return self.spark.createDataFrame([], struct_type(name))
        return self.spark.read.schema(struct_type(name)).parquet(*paths)
