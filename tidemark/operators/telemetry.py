"""Job-run telemetry rollups.

Input: job events ``job_id, event (submitted | success | error | missed),
recorded_at, scheduled_at, message`` plus a unique ``event_id`` that orders
events recorded at the same instant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

HISTORY_SIZE = 50  # fixed: newest events kept per job
TERMINAL = ["success", "error", "missed"]


def event_message() -> Column:
    """The message that an event has in the history: a missed run's names its
    scheduled time, an error has one always, a submission none."""
    missed = F.when(F.col("scheduled_at").isNull(), F.lit("Job missed its scheduled run")).otherwise(
        F.concat(F.lit("Job missed run scheduled for "), F.date_format("scheduled_at", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return (
        F.when(F.col("event") == "missed", missed)
        .when(F.col("event") == "error", F.coalesce(F.col("message"), F.lit("Unknown error")))
        .when(F.col("event") == "submitted", F.lit(None).cast("string"))
        .otherwise(F.col("message"))
    )


def _order() -> Column:
    return F.struct("recorded_at", "event_id")


def _submitted() -> Column:
    return F.when(F.col("event") == "submitted", F.col("recorded_at"))


def _duration(start: Column) -> Column:
    """``duration_ms`` of a success / error event that began at ``start``."""
    micros = F.timestamp_diff("MICROSECOND", start, F.col("recorded_at"))
    return F.when(F.col("event").isin("success", "error"), micros / 1e6 * 1000.0)


def with_durations(events: DataFrame) -> DataFrame:
    """``duration_ms`` of a success / error event = its time minus the
    latest ``submitted`` time at or before it (NULL when none, and for
    ``missed``); ``message`` of a missed event names its scheduled time.

    Skew: the events are cut into ranges of (job, time, id) of about equal size,
    and the look-back runs per (job, range), so a job with most of the events, or
    most of one day's, is spread over all tasks. The latest submission of earlier
    ranges comes from one row per job and range with a running max."""
    e = events.repartitionByRange("job_id", "recorded_at", "event_id").withColumn("_range", F.spark_partition_id())
    e = cut_lineage(e)  # read twice, in the same ranges
    w = Window.partitionBy("job_id", "_range").orderBy("recorded_at", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    ranges = e.groupBy("job_id", "_range").agg(F.max(_submitted()).alias("_sub"))
    earlier = Window.partitionBy("job_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_carry", F.max("_sub").over(earlier)).drop("_sub")
    e = e.withColumn("_local", F.last(_submitted(), ignorenulls=True).over(w)).join(ranges, ["job_id", "_range"], "left")
    e = e.withColumn("duration_ms", _duration(F.coalesce("_local", "_carry"))).withColumn("message", event_message())
    return e.drop("_range", "_local", "_carry")


def job_stats(events: DataFrame) -> DataFrame:
    """A10: one row per job; counts and last-* fields as the scheduler
    monitor keeps them. Two plain hash aggregates (partial aggregation map-side),
    so a job with most of the events is spread over all tasks: the fields,
    and the latest submission before each job's last terminal event."""
    order, sub, term = _order(), F.col("event") == "submitted", F.col("event").isin(TERMINAL)
    stats = events.groupBy("job_id").agg(
        F.count_if(sub).cast("long").alias("total_runs"),
        F.count_if(F.col("event") == "success").cast("long").alias("total_success"),
        F.count_if(F.col("event") == "error").cast("long").alias("total_error"),
        F.count_if(F.col("event") == "missed").cast("long").alias("total_missed"),
        F.max_by("event", order).alias("last_event"),
        F.max_by(F.when(sub, F.col("scheduled_at")), F.when(sub, order)).alias("last_scheduled_at"),
        F.max(_submitted()).alias("last_started_at"),
        F.max(F.when(term, F.col("recorded_at"))).alias("last_finished_at"),
        F.max(F.when(term, order)).alias("_order"),
        F.max_by(F.when(term, F.struct("event", "recorded_at")), F.when(term, order)).alias("_term"),
        F.max_by(F.when(F.col("event") != "success", event_message()), F.when(term, order)).alias("last_error"),
    )
    ends = stats.filter("_term.event != 'missed'").select("job_id", "_order")
    started = events.filter(sub).join(ends, "job_id").filter(order < F.col("_order")).groupBy("job_id").agg(F.max("recorded_at").alias("_start"))
    out = stats.join(started, "job_id", "left")
    micros = F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("_term.recorded_at"))
    names = [c for c in stats.columns if not c.startswith("_") and c != "last_error"]
    return out.select(*names, (micros / 1e6 * 1000.0).alias("last_duration_ms"), "last_error")


def job_durations(events: DataFrame) -> DataFrame:
    return (
        with_durations(events)
        .filter(F.col("event").isin("success", "error"))
        .select("job_id", "event_id", "event", "recorded_at", "duration_ms")
    )


def job_history(events: DataFrame, size: int = HISTORY_SIZE) -> DataFrame:
    """Newest ``size`` events per job as rows (``rank`` 1 = newest).
    ``row_number() <= size`` is pre-limited per task before the shuffle; only the
    rows kept look back for their submission, among themselves and to the latest
    one before the oldest of them (a plain aggregate)."""
    newest = Window.partitionBy("job_id").orderBy(F.col("recorded_at").desc(), F.col("event_id").desc())
    kept = events.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= size)
    oldest = kept.groupBy("job_id").agg(F.min(_order()).alias("_oldest"), F.count("*").alias("_n")).filter(F.col("_n") == size)
    before = events.filter(F.col("event") == "submitted").join(oldest, "job_id").filter(_order() < F.col("_oldest"))
    before = before.groupBy("job_id").agg(F.max("recorded_at").alias("_carry"))
    w = Window.partitionBy("job_id").orderBy("recorded_at", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    kept = kept.withColumn("_local", F.last(_submitted(), ignorenulls=True).over(w)).join(before, "job_id", "left")
    kept = kept.withColumn("duration_ms", _duration(F.coalesce("_local", "_carry"))).withColumn("message", event_message())
    return kept.select("job_id", "rank", "event_id", "event", "recorded_at", "scheduled_at", "duration_ms", "message")


__all__ = ["job_stats", "job_durations", "job_history", "with_durations", "event_message"]
