"""Batch job runners: the reference's jobs with their table I/O.

A ``Namespace`` is a table root (S4: the refill reads one namespace and
writes another, e.g. production into a test copy). All time enters as
``as_of``.

Layout. The fact and mart tables (summaries, performance, alerts) are live tables
(``tidemark.sources.live``): plain Parquet by day, on which snapshots, maintenance,
marts and refill all work; a rerun sets the same rows by key, and only days whose
rows change are rewritten. Next to a history a small state table
holds the latest row per key, so a live mart run reads O(#portfolios) rows
instead of the whole history; maintenance brings it up to date for the keys it touched.
Quarantines are append-only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import ts_lit

from tidemark.operators import maintenance as M
from tidemark.operators.alerts import DEFAULT_COOLDOWN_SEC, low_value_alerts
from tidemark.operators.cooldown import cooldown
from tidemark.operators.snapshot import Lookups, Snapshot, snapshot, summaries_of
from tidemark.plans import jobs
from tidemark.schemas import MASTER_PERFORMANCE, PORTFOLIO_PERFORMANCE
from tidemark.operators.rollup import active_portfolios, latest_per_key
from tidemark.session import cut_lineage
from tidemark.sources import live
from tidemark.sources.tables import append_epoch, latest_state

PORTFOLIO = "portfolio"
ACCOUNT_SUMMARY = "account_summary_1_minute"
PORTFOLIO_PERF = "portfolio_performance"
MASTER_PERF = "master_portfolio_performance"
REFILL_QUARANTINE = "refill_quarantine"
SNAPSHOT_QUARANTINE = "snapshot_quarantine"
ALERTS = "alerts"
ALERT_STATE = "alerts__last"
MARTS = (PORTFOLIO_PERF, MASTER_PERF)
KEYS = {ACCOUNT_SUMMARY: "portfolio", PORTFOLIO_PERF: "portfolio", MASTER_PERF: "master_portfolio"}


@dataclass(frozen=True)
class Namespace:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str, schema=None) -> DataFrame | None:
        """A whole table."""
        return live.read(spark, self.path(table), schema)

    def replace(self, table: str, rows: DataFrame) -> None:
        """Write a dimension."""
        live.replace(rows, self.path(table))

    def history(self, spark: SparkSession, table: str, schema=None, start: Any = None, end: Any = None) -> DataFrame | None:
        """A live table; a time range prunes days."""
        return live.read(spark, self.path(table), schema, start, end)

    def state(self, spark: SparkSession, table: str, schema=None) -> DataFrame | None:
        return latest_state(spark, self.path(f"{table}__latest"), schema)

    def append(self, spark: SparkSession, table: str, rows: DataFrame, key: str, tiebreak=()) -> None:
        """Set ``rows`` by (``key``, current_time) in the history (in the marts a NULL
        keeps the stored value, K7) and fold them into the latest-row state (O(#keys));
        of two rows at one time the one written last counts, of two in ``rows`` the
        first by ``tiebreak``."""
        stored = live.upsert(rows, self.path(table), [key, live.TIME], null_keeps=table in MARTS, newest=tiebreak)
        stored = stored.withColumn("_write", F.lit(1))
        prev = self.state(spark, table)
        merged = stored if prev is None else prev.withColumn("_write", F.lit(0)).unionByName(stored, allowMissingColumns=True)
        latest = latest_per_key(merged, key, live.TIME, [F.col("_write").desc(), *tiebreak])
        append_epoch(latest.drop("_write"), self.path(f"{table}__latest"))

    def refresh(self, spark: SparkSession, table: str, touched: DataFrame) -> None:
        """The latest-row state anew for the keys in ``touched``, after rows of theirs
        were changed or deleted."""
        prev, key = self.state(spark, table), KEYS.get(table)
        if prev is None or key is None:
            return
        touched = touched.select(key).distinct()
        rows = self.history(spark, table).join(touched, key, "left_semi")
        tiebreak = [F.col("id").desc()] if "id" in rows.columns else []
        latest = latest_per_key(rows, key, live.TIME, tiebreak)
        append_epoch(prev.join(touched, key, "left_anti").unionByName(latest, allowMissingColumns=True), self.path(f"{table}__latest"))


def run_snapshot(
    spark: SparkSession,
    payloads: DataFrame,
    data: Namespace,
    lookups: Lookups,
    as_of: Any,
    *,
    transfers: DataFrame | None = None,
    interval_minutes: float = 0.5,
    cooldown_sec: float = DEFAULT_COOLDOWN_SEC,
    dedupe: bool = True,
) -> Snapshot:
    """S6 -> X0-X8 -> K8 upsert keyed (portfolio, current_time); failed
    portfolios are appended to ``snapshot_quarantine``. Only the accounts that the
    portfolio table has as active are valued, and the pass's low-value alerts (L1)
    go through the cooldown (L2, ``run_alerts``); without that table every account
    is valued and there are no alerts. The payloads are valued once."""
    accounts = data.read(spark, PORTFOLIO)
    snap = snapshot(payloads, lookups, as_of, transfers=transfers, bybit_interval_minutes=interval_minutes, portfolios=accounts)
    rows = cut_lineage(snap.rows)
    alerts = None if accounts is None else low_value_alerts(summaries_of(rows), active_portfolios(accounts))
    snap = Snapshot(rows, snap.missing_prices, alerts)
    data.append(spark, ACCOUNT_SUMMARY, snap.summaries, "portfolio")
    snap.quarantine.withColumn("as_of", ts_lit(as_of)).write.mode("append").parquet(data.path(SNAPSHOT_QUARANTINE))
    if alerts is not None:
        run_alerts(spark, data, alerts, cooldown_sec=cooldown_sec, dedupe=dedupe)
    return snap


def run_alerts(spark: SparkSession, data: Namespace, alerts: DataFrame, *, cooldown_sec: float = DEFAULT_COOLDOWN_SEC, dedupe: bool = True) -> DataFrame:
    """L2 over a run's alerts (key, current_time, message, ...), going on from the
    last emission per key that earlier runs left. The alerts are appended to
    ``alerts`` with ``emitted``; their rows come back."""
    alerts = cut_lineage(alerts.withColumn("id", F.xxhash64("key", "current_time", "message")).dropDuplicates(["id"]))
    state = latest_state(spark, data.path(ALERT_STATE))
    ev = alerts.select("key", "id", F.col("current_time").alias("ts"), "message")
    if state is not None:
        # what was emitted last opens its key's run again
        ev = state.join(ev.select("key").distinct(), "key", "left_semi").select("key", F.lit(None).cast("long").alias("id"), "ts", "message").unionByName(ev)
    decided = cooldown(ev, cooldown_sec, dedupe=dedupe).filter("id is not null").select("id", "emitted")
    done = live.upsert(alerts.join(decided, "id"), data.path(ALERTS), ["id", live.TIME])
    last = done.filter("emitted").select("key", F.col("current_time").alias("ts"), "message", "id")
    if state is not None:
        last = last.unionByName(state.withColumn("id", F.lit(None).cast("long")))
    append_epoch(latest_per_key(last, "key", "ts", [F.col("id").desc_nulls_last()]).drop("id"), data.path(ALERT_STATE))
    return done


def load_summaries(spark: SparkSession, data: Namespace, summaries: DataFrame) -> None:
    """Bulk-load account summaries (history + latest state)."""
    tiebreak = [F.col("id").desc()] if "id" in summaries.columns else []
    data.append(spark, ACCOUNT_SUMMARY, summaries, "portfolio", tiebreak)


def _mart_run(spark, data: Namespace, mart: Namespace, as_of: Any, table: str, key: str, schema, plan) -> DataFrame:
    latest = data.state(spark, ACCOUNT_SUMMARY)
    if not latest.filter(F.col("current_time") > ts_lit(as_of)).isEmpty():
        # a run for a past time: only the summaries known at that time
        latest = data.history(spark, ACCOUNT_SUMMARY, end=as_of)
    prev = mart.state(spark, table, schema)
    if not prev.filter(F.col("current_time") >= ts_lit(as_of)).isEmpty():
        # a replay of a run already in the state: rebuild the state before it
        prev = mart.history(spark, table, schema)
    step = plan(data.read(spark, PORTFOLIO), latest, prev, as_of)
    mart.append(spark, table, step, key)
    return mart.history(spark, table, start=as_of, end=as_of)


def run_portfolio_mart(spark: SparkSession, data: Namespace, mart: Namespace, as_of: Any) -> DataFrame:
    """MART_portfolio_performance: one W1 step from the latest-row states."""
    return _mart_run(spark, data, mart, as_of, PORTFOLIO_PERF, "portfolio", PORTFOLIO_PERFORMANCE, jobs.portfolio_mart)


def run_master_mart(spark: SparkSession, data: Namespace, mart: Namespace, as_of: Any) -> DataFrame:
    """MART_master_portfolio_performance: masters + composites, one W1 step."""
    return _mart_run(spark, data, mart, as_of, MASTER_PERF, "master_portfolio", MASTER_PERFORMANCE, jobs.master_mart)


def run_refill(
    spark: SparkSession,
    source: Namespace,
    target: Namespace,
    *,
    is_master: bool = False,
    start: Any,
    end: Any = None,
    gap_policy: str = "reset",
) -> DataFrame:
    """OP_refill: summaries and the seed snapshot come from ``source``, the
    recomputed performance is upserted into ``target`` by key (a rerun does
    not duplicate rows, unlike the reference's plain insert). Summaries with a
    NULL amount are added to ``refill_quarantine`` of ``target`` with their number
    ``n`` and the bounds of the run, also on a rerun."""
    table, schema, key = (
        (MASTER_PERF, MASTER_PERFORMANCE, "master_portfolio") if is_master else (PORTFOLIO_PERF, PORTFOLIO_PERFORMANCE, "portfolio")
    )
    level = "master" if is_master else "portfolio"
    out, quarantine = jobs.refill_parts(
        source.read(spark, PORTFOLIO),
        source.history(spark, ACCOUNT_SUMMARY, start=start, end=end),
        source.history(spark, table, schema),
        level=level,
        start=start,
        end=end,
        gap_policy=gap_policy,
    )
    target.append(spark, table, out, key)
    bounds = {"level": F.lit(level), "run_start": ts_lit(start), "run_end": F.lit(None).cast("timestamp_ntz") if end is None else ts_lit(end)}
    rows = quarantine.groupBy(*[f.name for f in quarantine.schema.fields]).agg(F.count("*").alias("n")).withColumns(bounds)
    rows.write.mode("append").parquet(target.path(REFILL_QUARANTINE))
    return target.history(spark, table, start=start, end=end)


def _one_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))


def run_dedup(
    spark: SparkSession,
    ns: Namespace,
    table: str,
    *,
    group_fields: Sequence[str],
    time_field: str,
    id_col: str = "id",
    **kw: Any,
) -> DataFrame:
    """OP_delete_duplicate_data: keeps the first row per group, deletes the others
    from the live table (their days are rewritten, K9), returns the summary row.
    The counts come from the pass that finds the rows. Rows are told apart by their
    place in the table; ``id_col``, where the table has it, orders ties."""
    M.check_batch(kw.pop("batch_delete_size", 1000))
    rows = live.read(spark, ns.path(table), row_id=True)
    if id_col in rows.columns and id_col not in [f for f, _ in kw.get("sort_tiebreak", ())]:
        kw["sort_tiebreak"] = [*kw.get("sort_tiebreak", ()), (id_col, 1)]
    seen = Observation()
    flagged = M.dedup_flags(rows, group_fields, time_field, id_col=live.ROW, **kw).observe(seen, *M.dedup_counts())
    key = KEYS.get(table)
    gone = cut_lineage(flagged.filter("_removed").select(live.ROW, live.DAY, *([key] if key else [])))
    counts = seen.get
    if live.remove(spark, ns.path(table), gone) and key:
        ns.refresh(spark, table, gone)
    return _one_row(spark, {k: counts[k] for k in ("matched_groups", "deleted_ids")})


def run_insert_data(
    spark: SparkSession,
    ns: Namespace,
    table: str,
    *,
    mode: str,
    documents: DataFrame | Sequence[Mapping[str, Any]] | None = None,
    update_ops: Sequence[Mapping[str, Any]] | None = None,
    key_fields: Sequence[str] | None = None,
    merge_strategy: str = "set",
    merge_upsert: bool = True,
) -> DataFrame:
    """OP_insert_data: ``insert`` (K1), ``update`` (K5) or ``merge`` (K2-K4) on the
    live table; returns the summary row (K6), counted in the pass that writes.
    ``documents`` may be given inline (S5; typed as the table). Days without a
    changed row stay as they are."""
    m = mode.lower().strip()
    if m not in ("insert", "update", "merge"):
        raise ValueError(f"unknown mode {mode!r}: insert, update or merge")
    root, seen = ns.path(table), Observation()
    if m != "update":
        if documents is None:
            raise ValueError(f"mode {m} needs documents")
        if not isinstance(documents, DataFrame):
            documents = M.documents(spark, documents, live.read(spark, root).schema)
    if m == "insert":
        documents = cut_lineage(documents.observe(seen, F.count(F.lit(1)).alias("inserted")))
        live.insert(documents, root)
        counts, touched = seen.get, documents
    elif m == "update":
        rows = live.read(spark, root, row_id=True)
        edits = M.update_plan(spark, rows, update_ops or [], id_col=live.ROW, order=[F.col(c) for c in ("id", live.ROW) if c in rows.columns])
        after = cut_lineage(edits.rows)
        before = cut_lineage(rows.filter(F.col(live.ROW).isin(edits.ids)))  # one row per op at most
        days = sorted({*live.days_of(before), *live.days_of(live.with_day(after))}, key=str)
        kept = live.read(spark, root, days=days, row_id=True).filter(~F.col(live.ROW).isin(edits.ids))
        live.rewrite(kept.drop(live.ROW, live.DAY).unionByName(after.drop(live.ROW, live.DAY), allowMissingColumns=True), root, days)
        counts, touched = {"matched": edits.matched, "modified": edits.modified, "upserted": edits.upserted}, before.unionByName(after, allowMissingColumns=True)
    else:
        keys = list(key_fields or [])
        M.validate_merge(documents, keys, merge_strategy)
        documents = cut_lineage(documents)
        there = live.read(spark, root, row_id=True)
        if there is None:
            there = live.with_day(documents.limit(0)).withColumn(live.ROW, F.lit(""))
        same = live.same(keys, "o", "n")
        days = live.days_of(there.alias("o").join(documents.select(*keys).alias("n"), same, "left_semi"))
        if live.TIME in documents.columns:
            days = sorted({*days, *live.days_of(live.with_day(documents))}, key=str)
        target = live.read(spark, root, days=days, row_id=True) if live.exists(spark, root) else there
        flagged = M.merge_flags(target.drop(live.ROW, live.DAY), documents, keys, strategy=merge_strategy, upsert=merge_upsert, check_rows=False)
        merged = cut_lineage(flagged.observe(seen, *M.merge_counts()))
        counts = seen.get
        rows = merged.drop(*M.MERGE_FLAGS)
        if live.TIME not in rows.columns:
            rows = rows.withColumn(live.TIME, F.lit(None).cast("timestamp_ntz"))
        live.rewrite(rows, root, sorted({*days, *live.days_of(live.with_day(rows))}, key=str))
        touched = merged.filter("_in_s")
    if KEYS.get(table) in touched.columns:
        ns.refresh(spark, table, touched)
    names = ["inserted"] if m == "insert" else ["matched", "modified", "upserted"]
    return _one_row(spark, {k: counts[k] for k in names})
