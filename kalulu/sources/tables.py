"""Reading and writing tables.

Reads always name their columns so that the Parquet scan is pruned
(``ReadSchema`` carries only what the plan needs) and filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, base: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None,
                sort_within: list[str] | None = None) -> None:
    """Sink: full refresh (``overwrite``) or ``append``.

    Warehouse tables are accessed by patient, so callers usually pass
    ``sort_within=["patient_id"]`` to cluster row groups for min/max pruning.
    """
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
