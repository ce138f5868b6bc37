"""A warehouse whose tables are bucketed by patient.

Every report aggregates and joins the visit tables by patient.  Stored in
``buckets`` buckets of the same hash and sorted by patient, they meet without a
shuffle: a bucket of one table is joined to the same bucket of the others, and
"latest row per patient" is final within its bucket.  What is left to shuffle is the
few counted rows of a report.

The tables are catalogue tables (the bucket layout is kept there, not in the
files): on a cluster the database is one of the shared metastore.  ``buckets``
fixes the largest piece a task reads; take table size / 200 MB or so.  One
patient's rows are in one bucket by nature; loaded tables hold no rows without a
patient (NOT NULL), other tables' rows without one share a bucket too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kalulu.functions.sqltext import quoted
from kalulu.sources.normalise import NormalisedWarehouse
from kalulu.sources.schema import SOURCES, WAREHOUSE

KEY = "patient_id"

#: rows grouped by (patient, date) or joined on (patient, facility) may stay in the buckets of the patient
READ_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def _columns(table: str) -> list[str]:
    return [n for n, _ in (WAREHOUSE.get(table) or SOURCES[table])]


def write_bucketed(wh, database: str, buckets: int, tables: list[str], location: str | None = None) -> None:
    """Write tables of a warehouse into ``database``, in one spelling, replacing what is there.

    Tables with a patient are bucketed and sorted by it, others (the facilities)
    are written as they are.  One shuffle per table deals the rows into the
    buckets, so that a bucket is one file.  Rows without a patient stay, together in one
    bucket; a table may be empty; further columns of a source are not kept.
    ``location`` names the folder of a new database (a shared one), else the session's warehouse folder has it.
    """
    spark: SparkSession = wh.spark
    spark.sql(f"create database if not exists `{database}`" + (f" location {quoted(location)}" if location else ""))
    source = NormalisedWarehouse(wh)
    for name in tables:
        rows = getattr(source, name)
        rows = rows.select(*[c for c in _columns(name) if c in rows.columns])
        if KEY in rows.columns:
            w = rows.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY)
        else:
            w = rows.write
        w.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{name}`")


class BucketedWarehouse:
    """The tables of a database that :func:`write_bucketed` wrote; sets ``READ_CONF`` in the session."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        for k, v in READ_CONF.items():
            spark.conf.set(k, v)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCES and name not in WAREHOUSE:
            raise AttributeError(name)
        return self.spark.table(f"`{self.database}`.`{name}`")
