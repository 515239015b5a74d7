"""Session helpers: building a session, reading the shared tables and cutting lineage.

Lineage is cut with ``DataFrame.checkpoint`` into the folder the cluster names in
``spark.checkpoint.dir`` (a shared, fault-tolerant location).  A folder is only
chosen here when the session has none, which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set one only when the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, rows_per_partition: int = 20_000) -> DataFrame:
    """Round-robin repartition of an input before it is cached for an iterative algorithm
    (model fits, boosting rounds): about ``rows_per_partition`` rows a partition, so a
    single-split file is spread over the cores and a tiny input stays whole."""
    return df.repartition(max(1, -(-df.count() // rows_per_partition)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the shared Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
