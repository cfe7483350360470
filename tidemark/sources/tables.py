"""Sinks of the streaming marts and alerts: one folder per micro-batch.

A micro-batch writes its rows under ``<root>/epoch=<batch id>`` with overwrite, so
a replay replaces exactly its own output. A failed write leaves a folder without
``_SUCCESS``, which readers skip. The live tables are in ``tidemark.sources.live``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.live import _fs as _file_system

# --------------------------------------------------------------------------- streaming sinks
# A micro-batch writes its rows under ``<root>/epoch=<batch id>`` with
# overwrite, so a replayed batch replaces exactly its own output
# (idempotent). Readers see the upsert view: the newest epoch per key.
# Small per-key state (latest summary, latest mart row) is kept as one
# snapshot per epoch, so a batch reads O(#keys) rows, not the history.
def epoch_path(root: str, epoch: int) -> str:
    return f"{root.rstrip('/')}/epoch={int(epoch):012d}"


DATE_PART = "_date"  # day of current_time: partition column of the histories


def write_epoch(df: DataFrame, root: str, epoch: int, *, by_date: bool = False) -> str:
    """Overwrite this epoch's folder. ``by_date`` partitions it by the day of
    ``current_time`` so range readers prune whole days."""
    from pyspark.sql import functions as F

    path = epoch_path(root, epoch)
    if by_date and "current_time" in df.columns:
        df.withColumn(DATE_PART, F.to_date("current_time")).write.mode("overwrite").partitionBy(DATE_PART).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def _epochs(spark: SparkSession, root: str) -> list[int]:
    fs, p = _file_system(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("epoch=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def read_epochs(spark: SparkSession, root: str, start=None, end=None) -> DataFrame | None:
    """Every committed epoch's rows, with an ``epoch`` column. With a time
    range, days outside it are pruned (partition filter on ``_date``) and
    rows are cut to the inclusive range."""
    from pyspark.sql import functions as F

    from tidemark.functions.scalars import ts_lit

    eps = _epochs(spark, root)
    if not eps:
        return None
    df = spark.read.option("basePath", root).parquet(*[epoch_path(root, e) for e in eps])
    if DATE_PART in df.columns:
        if start is not None:
            df = df.filter(F.col(DATE_PART) >= F.to_date(ts_lit(start)))
        if end is not None:
            df = df.filter(F.col(DATE_PART) <= F.to_date(ts_lit(end)))
        df = df.drop(DATE_PART)
    if start is not None:
        df = df.filter(F.col("current_time") >= ts_lit(start))
    if end is not None:
        df = df.filter(F.col("current_time") <= ts_lit(end))
    return df


def read_upserted(
    spark: SparkSession, root: str, keys: Sequence[str], start=None, end=None, *, null_keeps: bool = False
) -> DataFrame | None:
    """Upsert view of an epoch-partitioned table: per key, the row of the
    newest epoch (K8 semantics without rewriting the history). With
    ``null_keeps`` (K7) a NULL does not replace an older value: each column has
    its newest non-NULL value."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = read_epochs(spark, root, start, end)
    if df is None:
        return None
    if null_keeps:
        rest = [c for c in df.columns if c not in (*keys, "epoch")]
        newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("epoch"))).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*newest).select(*[c for c in df.columns if c != "epoch"])
    w = Window.partitionBy(*keys).orderBy(F.col("epoch").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "epoch")


def read_state(spark: SparkSession, root: str, before_epoch: int, schema: T.StructType | None = None) -> DataFrame | None:
    """The newest state snapshot written by an epoch strictly before
    ``before_epoch`` (a replayed batch never sees its own output)."""
    eps = [e for e in _epochs(spark, root) if e < before_epoch]
    if eps:
        return spark.read.parquet(epoch_path(root, eps[-1]))
    return spark.createDataFrame([], schema) if schema is not None else None


def next_epoch(spark: SparkSession, root: str) -> int:
    eps = _epochs(spark, root)
    return eps[-1] + 1 if eps else 0


def append_epoch(df: DataFrame, root: str, *, by_date: bool = False) -> str:
    """Batch writers on the epoch layout: the next epoch number, so later
    writes win in the upsert view."""
    return write_epoch(df, root, next_epoch(df.sparkSession, root), by_date=by_date)


def latest_state(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The newest committed state snapshot under ``root``."""
    return read_state(spark, root, 1 << 62, schema)
