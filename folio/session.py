"""Session helpers.

Library code never creates a session of its own; it takes the caller's.  The
helpers here are for tests, the benchmark and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session configured the way the tests and the benchmark expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folio")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.folio.text.partitions", "16")  # the test tables are single files of one split
        .config("spark.driver.memory", os.environ.get("FOLIO_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset in a local session (tests) a fresh scratch
    folder is made; on a cluster a machine-local folder would lose data.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="folio-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back: computed once for
    several uses, and a lost executor costs only the tasks that read it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
