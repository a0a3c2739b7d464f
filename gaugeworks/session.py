"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app: str = "gaugeworks", **conf: str) -> SparkSession:
    """Build (or reuse) a session; cluster settings given outside win."""
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


METHOD_CONF = "spark.sql.codegen.hugeMethodLimit"


def configure(spark: SparkSession) -> SparkSession:
    """Session settings every job relies on: observation times are 07:00 UTC, so calendar functions run in UTC.

    The JVM does not compile methods above 8000 bytes, so a wide parser or fit in one generated method is interpreted for good; several small ones
    are faster. A limit given outside wins.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(METHOD_CONF, None) is None:
        spark.conf.set(METHOD_CONF, "8000")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a session on one machine may do with a temporary one."""
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    named = tempfile.mkdtemp(prefix="gaugeworks-")
    spark.conf.set(CHECKPOINT_CONF, named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: a lost executor re-reads files instead of re-running the plan."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


def free_scratch(spark: SparkSession) -> None:
    """Shuffle files and checkpoints of what is done go when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
