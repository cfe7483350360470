"""Streaming fixture queries: files derived from the driver's tables land in
a staging folder under the cluster's checkpoint directory, the stream runs
with ``availableNow`` once per arriving batch, and the query returns the
sink table read back -- comparable with the batch oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import payloads as P
from tidemark.plans import queries as Q
from tidemark.plans.fixtures import load
from tidemark.session import checkpoint_root
from tidemark.sources import live
from tidemark.sources.tables import read_epochs, read_upserted
from tidemark.streaming import jobs as SJ

def _stage(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _years(df: DataFrame) -> list[tuple[int, DataFrame]]:
    """One part per year that the data holds, in order."""
    y = F.year("current_time")
    years = sorted(r[0] for r in df.select(y).distinct().collect() if r[0] is not None)
    return [(yr, df.filter(y == yr)) for yr in years]


@Q.query
def stream_snapshot(spark: SparkSession, d: str) -> DataFrame:
    root = _stage(spark, "stream-snapshot")
    P.polled(P.payloads(spark, d), P.PAYLOAD_AS_OF).write.option("compression", "gzip").json(f"{root}/in")
    q = SJ.snapshot_stream(
        spark,
        f"{root}/in",
        f"{root}/summary",
        f"{root}/quarantine",
        P.lookups(spark, d),
        f"{root}/ckpt",
        transfers=load(spark, d, "transfers"),
        bybit_interval_minutes=Q.BYBIT_INTERVAL_MIN,
        available_now=True,
    )
    q.awaitTermination()
    return Q._summary_rows(live.read(spark, f"{root}/summary"))


@Q.query
def stream_snapshot_backlog(spark: SparkSession, d: str) -> DataFrame:
    """Two polls of every account wait as files when the stream starts: one
    micro-batch, as many summaries as polls."""
    root = _stage(spark, "stream-backlog")
    P.polled(P.payloads(spark, d), P.PAYLOAD_AS_OF, P.PAYLOAD_NEXT).write.option("compression", "gzip").json(f"{root}/in")
    SJ.snapshot_stream(
        spark, f"{root}/in", f"{root}/summary", f"{root}/quarantine", P.lookups(spark, d), f"{root}/ckpt",
        transfers=load(spark, d, "transfers"), bybit_interval_minutes=Q.BYBIT_INTERVAL_MIN, available_now=True,
    ).awaitTermination()
    return Q._summary_rows(live.read(spark, f"{root}/summary"))


def _mart(spark: SparkSession, d: str, level: str, key: str, order=lambda parts: parts) -> DataFrame:
    """One micro-batch per year of summaries; each batch steps the mart at its
    newest summary time."""
    root = _stage(spark, f"stream-mart-{level}")
    summaries = load(spark, d, "account_summary")
    portfolios = load(spark, d, "portfolio")
    for _, part in order(_years(summaries)):
        part.write.mode("append").parquet(f"{root}/in")
        SJ.mart_stream(
            spark,
            f"{root}/in",
            f"{root}/summary",
            portfolios,
            f"{root}/mart",
            f"{root}/ckpt",
            schema=summaries.schema,
            available_now=True,
            level=level,
        ).awaitTermination()
    return Q.finish(read_upserted(spark, f"{root}/mart", [key, "current_time"], null_keeps=True))


@Q.query
def stream_mart(spark: SparkSession, d: str) -> DataFrame:
    return _mart(spark, d, "master", "master_portfolio")


@Q.query
def stream_mart_late(spark: SparkSession, d: str) -> DataFrame:
    """The third year's summaries arrive after the fourth's."""
    return _mart(spark, d, "master", "master_portfolio", lambda parts: [*parts[:2], *parts[3:4], *parts[2:3], *parts[4:]])


@Q.query
def stream_portfolio_mart(spark: SparkSession, d: str) -> DataFrame:
    return _mart(spark, d, "portfolio", "portfolio")


@Q.query
def stream_alert(spark: SparkSession, d: str) -> DataFrame:
    """L2 as a stateful stream, one micro-batch per year of alerts."""
    root = _stage(spark, "stream-alert")
    alerts = Q.cooldown_input(spark, d).withColumnRenamed("ts", "current_time")
    schema = alerts.schema
    for _, part in _years(alerts):
        part.write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(schema).parquet(f"{root}/in").withColumnRenamed("current_time", "ts")
        SJ.alert_stream(src, f"{root}/out", f"{root}/ckpt", Q.COOLDOWN_SEC, dedupe=True, available_now=True).awaitTermination()
    return read_epochs(spark, f"{root}/out").drop("epoch")


@Q.query
def stream_low_value_alert(spark: SparkSession, d: str) -> DataFrame:
    """L1 feeding L2: summaries arrive by year, are checked against the active
    accounts' thresholds, and the alerts pass the cooldown. Each message tells its
    value and time, so equal ones never meet: dedupe is off."""
    root = _stage(spark, "stream-low-value")
    summaries, portfolios = load(spark, d, "account_summary"), load(spark, d, "portfolio")
    for _, part in _years(summaries):
        part.write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(summaries.schema).parquet(f"{root}/in")
        alerts = SJ.low_value_stream(src, portfolios)
        SJ.alert_stream(alerts, f"{root}/out", f"{root}/ckpt", Q.COOLDOWN_SEC, dedupe=False, available_now=True).awaitTermination()
    return read_epochs(spark, f"{root}/out").drop("epoch")


def _jobs(spark: SparkSession, d: str) -> str:
    """The job events as two micro-batches; the folder of the sinks."""
    root = _stage(spark, "stream-jobs")
    events = load(spark, d, "job_events")
    half = F.col("recorded_at") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for part in (events.filter(half), events.filter(~half)):
        part.write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        SJ.job_stats_stream(src, f"{root}/out", f"{root}/ckpt", history_root=f"{root}/history", available_now=True).awaitTermination()
    return root


@Q.query
def stream_job_stats(spark: SparkSession, d: str) -> DataFrame:
    return Q.finish(read_upserted(spark, f"{_jobs(spark, d)}/out", ["job_id"]))


@Q.query
def stream_job_history(spark: SparkSession, d: str) -> DataFrame:
    return Q.finish(read_upserted(spark, f"{_jobs(spark, d)}/history", ["job_id", "rank"]))


__all__ = ["stream_snapshot", "stream_snapshot_backlog", "stream_mart", "stream_mart_late", "stream_portfolio_mart", "stream_alert", "stream_low_value_alert", "stream_job_stats", "stream_job_history"]
