"""Session helpers.

Library code never builds its own session: every operator takes DataFrames and
returns DataFrames. ``local_session`` is for tests, the bench and the smoke
entry only. ``checkpoint_root`` reads the shared folder the cluster names in
``spark.checkpoint.dir`` and only falls back to a scratch folder when the
setting is unset (local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Naive UTC timestamps everywhere (the reference
# stores naive UTC datetimes), AQE for runtime re-planning and skew splitting.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # drop RDD checkpoint files once their DataFrames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _registered(spark: SparkSession) -> str | None:
    """What ``setCheckpointDir`` was given; Spark adds a folder of its own to it."""
    folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/").rsplit("/", 1)[0] if folder else None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    Uses ``spark.checkpoint.dir`` when the cluster sets it, or else the folder set
    by ``setCheckpointDir``; only when both are unset in a local session a scratch
    folder is created and registered; a cluster session without it is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or _registered(spark)
        except Exception:  # noqa: BLE001 - sessions without a local SparkContext
            conf_dir = None
    if not conf_dir:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    try:
        spark.sparkContext.setCheckpointDir(conf_dir)
    except Exception:  # noqa: BLE001 - the server side uses spark.checkpoint.dir
        pass
    return conf_dir.rstrip("/")


def cut_lineage(df):
    """Materialise ``df`` into the checkpoint directory (reliable: survives
    executor loss, unlike a local checkpoint). Persisted first so the
    checkpoint write reads the computed partitions instead of recomputing
    them; the cache is dropped once the checkpoint exists."""
    checkpoint_root(df.sparkSession)
    cached = df.persist()
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def spooled(df: DataFrame, name: str = "spool") -> DataFrame:
    """Materialise wide ``df`` as a compressed Parquet table in a folder of its own
    under the checkpoint directory, and read it back: a fraction of what a checkpoint
    takes on disk, and a reader of few columns reads no others. The folder stays."""
    path = f"{checkpoint_root(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
