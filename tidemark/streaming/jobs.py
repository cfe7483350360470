"""Structured Streaming versions of the scheduled jobs.

The reference polls on a cron; here each job is a stream over files that
land in a directory (``readStream`` with an explicit schema), processed in
micro-batches. Exactly-once comes from the checkpoint plus idempotent sinks:
``foreachBatch`` writes keyed upserts into versioned tables
(``tidemark.sources.tables``), and every run time is derived from the batch's
own data, never from the wall clock, so a replayed batch writes the same
rows. Checkpoints live under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import message_hash, truncate_second
from tidemark.operators.alerts import low_value_alerts
from tidemark.operators.cooldown import milliseconds
from tidemark.operators.rollup import active_portfolios, latest_per_key
from tidemark.operators.snapshot import Lookups, quarantine_of, snapshot, summaries_of
from tidemark.operators.telemetry import HISTORY_SIZE, event_message
from tidemark.operators.transfers import epoch_ms
from tidemark.plans.jobs import master_mart, portfolio_mart
from tidemark.schemas import ACCOUNT_SUMMARY, MASTER_PERFORMANCE, PORTFOLIO_PERFORMANCE
from tidemark.session import cut_lineage
from tidemark.sources import live
from tidemark.sources.tables import read_state, write_epoch
from tidemark.streaming.stateful import ALERT_OUT, JOB_OUT, CooldownBuckets, JobBuckets, rocksdb

SUMMARY_KEYS = ["portfolio", "current_time"]
ALERT_BUCKETS = 4096
JOB_BUCKETS = 4096
PAYLOAD_STREAM_SCHEMA = "portfolio string, exchange string, payload string, fetched_at timestamp_ntz"


def _start(df_writer, checkpoint: str, available_now: bool, processing_time: str | None):
    w = df_writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


# --------------------------------------------------------------------------- R1
def snapshot_stream(
    spark: SparkSession,
    payload_dir: str,
    summary_root: str,
    quarantine_root: str,
    lookups: Lookups,
    checkpoint: str,
    *,
    transfers: DataFrame | None = None,
    portfolios: DataFrame | None = None,
    alert_root: str | None = None,
    bybit_interval_minutes: float = 0.5,
    available_now: bool = False,
    processing_time: str = "10 seconds",
    max_files_per_trigger: int | None = None,
):
    """Payload files -> X0-X8 -> K8 upsert keyed (portfolio, current_time).
    Every poll of a batch is a summary at its own ``fetched_at`` (to the second),
    so a backlog loses none. With ``portfolios`` only active accounts are valued,
    and the low-value alerts (L1; key, id, ts, message) are written to ``alert_root``,
    the files that ``alert_stream`` reads. A batch is valued once and feeds all
    sinks: the summaries' live table by key, so a replayed batch sets the same rows,
    and its own epoch of the others."""
    reader = spark.readStream.schema(PAYLOAD_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.json(payload_dir)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        as_of = batch.agg(F.max(truncate_second("fetched_at"))).first()[0]
        if as_of is None:
            return
        snap = snapshot(batch, lookups, as_of, transfers=transfers, bybit_interval_minutes=bybit_interval_minutes, portfolios=portfolios)
        with live.spool(snap.rows, "snapshot-rows") as rows:
            summaries = summaries_of(rows)
            live.upsert(summaries, summary_root, SUMMARY_KEYS, settled=True)
            write_epoch(quarantine_of(rows), quarantine_root, epoch)
            if alert_root is not None and portfolios is not None:
                write_epoch(low_value_stream(summaries, portfolios), alert_root, epoch)

    return _start(src.writeStream.foreachBatch(per_batch), checkpoint, available_now, processing_time)


# --------------------------------------------------------------------------- R2
def mart_stream(
    spark: SparkSession,
    summary_dir: str,
    summary_root: str,
    portfolios: DataFrame,
    mart_root: str,
    checkpoint: str,
    *,
    state_root: str | None = None,
    schema: T.StructType | str = ACCOUNT_SUMMARY,
    available_now: bool = False,
    processing_time: str = "20 seconds",
    max_files_per_trigger: int | None = None,
    level: str = "master",
):
    """R2: new summaries land in the history under their epoch (K8 view by
    newest epoch); the latest summary per portfolio and the latest mart row
    per master are kept as small per-epoch state snapshots, so a batch reads
    O(#portfolios) rows, never the history. The mart of ``level`` (master or
    portfolio) then steps once at the batch's newest ``current_time`` (W1). A late
    batch that changes no account's latest summary leaves the mart as it is; one that
    does is a run of its own, a second after the last, so no row is stepped from
    itself or written over. The rows are written under the epoch (K7: a replay rewrites the same rows)."""
    state_root = state_root or f"{mart_root.rstrip('/')}_state"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(summary_dir)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        mart_batch(spark, batch, epoch, summary_root, portfolios, mart_root, state_root, level)

    return _start(src.writeStream.foreachBatch(per_batch), checkpoint, available_now, processing_time)


def mart_batch(
    spark: SparkSession,
    batch: DataFrame,
    epoch: int,
    summary_root: str,
    portfolios: DataFrame,
    mart_root: str,
    state_root: str,
    level: str = "master",
) -> None:
    """One R2 micro-batch. Reads only state written by earlier epochs and
    overwrites only its own epoch's folders, so running it again for the
    same epoch (a replay after a failure) leaves the same tables."""
    as_of = batch.agg(F.max("current_time")).first()[0]
    if as_of is None:
        return
    tiebreak = [F.col("id").desc()] if "id" in batch.columns else []
    write_epoch(batch, summary_root, epoch, by_date=True)
    prev_latest = read_state(spark, f"{state_root}/latest_summary", epoch, batch.schema)
    both = prev_latest.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    latest = cut_lineage(latest_per_key(both, "portfolio", "current_time", [*tiebreak, F.col("_new")]))
    latest_path = write_epoch(latest.drop("_new"), f"{state_root}/latest_summary", epoch)
    key, schema, mart = ("master_portfolio", MASTER_PERFORMANCE, master_mart) if level == "master" else ("portfolio", PORTFOLIO_PERFORMANCE, portfolio_mart)
    prev_mart = read_state(spark, f"{state_root}/latest_mart", epoch, schema)
    last = prev_mart.agg(F.max("current_time")).first()[0]
    if last is not None and as_of <= last:
        if latest.filter("_new = 1").isEmpty():
            write_epoch(prev_mart, f"{state_root}/latest_mart", epoch)
            return
        as_of = last + timedelta(seconds=1)
    step = mart(portfolios, spark.read.parquet(latest_path), prev_mart, as_of)
    step_path = write_epoch(step, mart_root, epoch, by_date=True)
    stepped = spark.read.parquet(step_path).drop("_date").withColumn("_write", F.lit(1))
    both = prev_mart.withColumn("_write", F.lit(0)).unionByName(stepped)
    write_epoch(latest_per_key(both, key, "current_time", [F.col("_write").desc()]).drop("_write"), f"{state_root}/latest_mart", epoch)


# --------------------------------------------------------------------------- R3
def alert_stream(
    alerts: DataFrame,
    sink_root: str,
    checkpoint: str,
    cooldown_sec: float = 60,
    *,
    dedupe: bool = True,
    available_now: bool = False,
    processing_time: str = "10 seconds",
    buckets: int = ALERT_BUCKETS,
):
    """L2 as a stateful stream. ``alerts`` is a streaming frame with
    key, id, ts, message; state per key is (last emitted time, hash) in RocksDB, where
    the keys of one of ``buckets`` hash buckets lie together and are settled in one call.
    A checkpoint keeps the number of buckets that it began with.
    Alerts without a time are left out."""
    ev = alerts.select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"),
        F.col("id").cast("long").alias("id"),
        epoch_ms(F.col("ts")).alias("t"),
        message_hash("message").alias("h"),
    ).filter("t is not null")
    ev = ev.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    out = ev.groupBy("bucket").transformWithStateInPandas(CooldownBuckets(milliseconds(cooldown_sec), dedupe), ALERT_OUT, "Append", "None")

    def per_batch(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch, sink_root, epoch)

    with rocksdb(alerts.sparkSession):
        return _start(out.writeStream.outputMode("append").foreachBatch(per_batch), checkpoint, available_now, processing_time)


def low_value_stream(summaries: DataFrame, portfolios: DataFrame) -> DataFrame:
    """L1 over a stream of account summaries, joined to the active accounts: the
    alerts that ``alert_stream`` takes (key, id, ts, message). A summary without
    an ``id`` is told apart by its account and time."""
    if "id" not in summaries.columns:
        summaries = summaries.withColumn("id", F.xxhash64("portfolio", "current_time"))
    found = low_value_alerts(summaries, active_portfolios(portfolios), keep=("id",))
    return found.select("key", "id", F.col("current_time").alias("ts"), "message")


# --------------------------------------------------------------------------- R4
def job_stats_stream(
    events: DataFrame,
    sink_root: str,
    checkpoint: str,
    *,
    history_root: str | None = None,
    history_size: int = HISTORY_SIZE,
    available_now: bool = False,
    processing_time: str = "10 seconds",
    buckets: int = JOB_BUCKETS,
):
    """A10, W5 and W6 as a stateful stream. Each batch writes the changed
    jobs' ten fields under its epoch of ``sink_root`` (upsert view: newest epoch per
    ``job_id``) and their newest events under ``history_root`` (newest epoch per
    ``job_id`` and ``rank``), both from one pass. State per job is in RocksDB; the jobs of one of
    ``buckets`` hash buckets are settled in one call. A checkpoint keeps the number of buckets
    that it began with."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = lambda c: F.timestamp_diff("MICROSECOND", zero, F.col(c))
    ev = events.select(
        "job_id", F.col("event_id").cast("long").alias("event_id"), "event", micros("recorded_at").alias("recorded_at"),
        micros("scheduled_at").alias("scheduled_at"), event_message().alias("message"),
    )
    ev = ev.withColumn("bucket", F.pmod(F.xxhash64("job_id"), F.lit(buckets)).cast("int"))
    out = ev.groupBy("bucket").transformWithStateInPandas(JobBuckets(history_size), JOB_OUT, "Update", "None")
    back = lambda c: F.timestamp_add("MICROSECOND", F.col(c), zero).alias(c)
    stats = ["total_runs", "total_success", "total_error", "total_missed", "last_event", "last_scheduled_at", "last_started_at", "last_finished_at", "last_duration_ms", "last_error"]
    history = ["rank", "event_id", "event", "recorded_at", "scheduled_at", "duration_ms", "message"]

    def per_batch(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            for root, names, rows in ((sink_root, stats, F.col("rank").isNull()), (history_root or f"{sink_root.rstrip('/')}_history", history, F.col("rank").isNotNull())):
                write_epoch(batch.filter(rows).select("job_id", *[back(c) if c.endswith("_at") else c for c in names]), root, epoch)
        finally:
            batch.unpersist()

    with rocksdb(events.sparkSession):
        return _start(out.writeStream.outputMode("update").foreachBatch(per_batch), checkpoint, available_now, processing_time)
