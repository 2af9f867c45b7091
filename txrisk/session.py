"""Session helpers: a tuned local session for tests/bench and lineage cutting."""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Settings that matter at scale; all are plain Spark confs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str = "local[8]", app: str = "txrisk",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """A session with SCALE_CONF; sizes (partitions, memory) are the caller's."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SCALE_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``, or None."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; survives executor loss.

    Without a shared folder (conf unset) fall back to a persisted frame, which
    Spark can always recompute from lineage.
    """
    if checkpoint_dir(df.sparkSession) is not None:
        return df.checkpoint(eager=True)
    log.warning("spark.checkpoint.dir is unset; persisting instead of checkpointing")
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def cache_memory(spark: SparkSession) -> int:
    """Bytes that the executors (without a cluster, the driver) have for cached rows."""
    sc = spark.sparkContext
    driver = sc._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    of, it = {}, sc._jsc.sc().getExecutorMemoryStatus().iterator()
    while it.hasNext():
        entry = it.next()
        of[entry._1()] = entry._2()._1()
    return sum(v for k, v in of.items() if k != driver) or sum(of.values())
