"""Session construction and job-level settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are safe for local tests as well.
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce to the advisory partition size rather than to the core count:
    # fewer, fuller tasks (measured faster here; recommended for busy clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kalulu") -> SparkSession:
    """Create (or reuse) a session.  On a cluster ``master`` is left to spark-submit."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master and master.startswith("local"):
        # local mode runs every task in the driver JVM: give it the heap an
        # executor would have (on a cluster executor sizing comes from submit)
        b = b.config("spark.driver.memory", os.environ.get("KALULU_DRIVER_MEMORY", "12g"))
    for k, v in _SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder that ``spark.checkpoint.dir`` names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is respected as is.  Where the
    setting is unset, a session in one process (local tests) gets a scratch
    folder; on a cluster that is an error, since executors would not see each
    other's files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - no SparkContext access (e.g. remote session)
            d = None
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master or 'the cluster'} share")
        d = tempfile.mkdtemp(prefix="kalulu-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some sessions reject core confs at runtime
            pass
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001
        pass
    return d
