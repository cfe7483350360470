"""Performance recurrence: one live step (W1) and the historical refill
(W2-W4, J9) as a windowed closed form instead of a loop over timestamps.

Recurrence per entity, from the previous state (total, nav, crr, hh, mdd):

    net = total + adj
    r   = (net - prev_total) / prev_total
    crr = (1 + crr_prev)(1 + r) - 1 ;  nav = nav_prev (1 + r)
    hh  = max(nav, hh_prev)         ;  cd  = nav / hh - 1
    mdd = min(cd, mdd_prev)

Unrolled over a run of consecutive batches with g = prod(1 + r):
nav = nav0 g, crr = (1 + crr0) g - 1, hh = max(max(nav), hh0),
mdd = min(min(cd), mdd0) -- running window aggregates, no Python loop.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_div, ts_lit, tw_time
from tidemark.operators.rollup import latest_per_key
from tidemark.session import cut_lineage

OUT_METRICS = ["total_usd_value", "history_high", "nav", "current_return", "crr", "cd", "mdd"]


@dataclass(frozen=True)
class Defaults:
    history_high: float
    nav: float
    crr: float
    mdd: float


# Fixed values that must equal the reference's: live step and refill defaults.
LIVE_DEFAULTS = Defaults(history_high=0.0, nav=100.0, crr=0.0, mdd=0.0)
REFILL_DEFAULTS = Defaults(history_high=100.0, nav=100.0, crr=0.0, mdd=0.0)


def output_columns(key: str) -> list[str]:
    return [key, *OUT_METRICS, "current_time", "tw_time"]


# --------------------------------------------------------------------------- W1
def performance_step(
    current: DataFrame,
    previous: DataFrame | None,
    key: str,
    as_of: Any,
    *,
    seed_key: str | Callable[[], str | None] | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Advance every entity of ``current`` one step from its newest row in
    ``previous`` (the mart). Live defaults: hh 0, nav 100, crr 0, mdd 0, and a
    missing previous total falls back to the current *total* (r = adj/total).

    The previous state is the newest row per key strictly before ``as_of``, or
    at it with ``inclusive`` (a state known to be of an earlier run).
    When there is none at all, only the seed row (``seed_key``, a key or a
    function that finds it; default the smallest key) starts from prev_total =
    net, so it returns 0.
    Division by a zero previous total yields NULL (pandas gives +-inf/NaN and
    drops NaN on write; ANSI Spark would raise).
    """
    d = LIVE_DEFAULTS
    if previous is not None:
        # state strictly before this run: a replay at the same as_of reads the
        # same state and writes the same rows (idempotent)
        time = F.col("current_time")
        previous = previous.filter(time <= ts_lit(as_of) if inclusive else time < ts_lit(as_of))
    prev_empty = previous is None or previous.isEmpty()
    if prev_empty:
        # only the very first run of a mart gets here: one small driver-side
        # value (a scalar subquery would embed the whole rollup again)
        first = seed_key() if callable(seed_key) else seed_key
        seed = F.lit(first if first is not None else current.agg(F.min(key)).first()[0])
        prev = None
    else:
        prev = latest_per_key(previous, key).select(
            key,
            F.col("total_usd_value").alias("total_usd_value_prev"),
            F.col("history_high").alias("hh_prev"),
            F.col("nav").alias("nav_prev"),
            F.col("crr").alias("crr_prev"),
            F.col("mdd").alias("mdd_prev"),
        )

    total, adj = F.col("total_usd_value"), F.col("transfer_adjustment")
    net = total + adj
    if prev is None:
        df = current
        seeded = F.col(key) == seed
        prev_total = F.when(seeded, net).otherwise(total)
        hh0, nav0, crr0, mdd0 = (F.lit(v) for v in (d.history_high, d.nav, d.crr, d.mdd))
    else:
        df = current.join(prev, on=key, how="left")
        prev_total = F.coalesce(F.col("total_usd_value_prev"), total)
        hh0 = F.coalesce(F.col("hh_prev"), F.lit(d.history_high))
        nav0 = F.coalesce(F.col("nav_prev"), F.lit(d.nav))
        crr0 = F.coalesce(F.col("crr_prev"), F.lit(d.crr))
        mdd0 = F.coalesce(F.col("mdd_prev"), F.lit(d.mdd))

    r = safe_div(net - prev_total, prev_total, otherwise=None)
    nav = nav0 * (F.lit(1.0) + F.col("current_return"))
    t = ts_lit(as_of)
    out = (
        df.withColumn("current_return", r)
        .withColumn("crr", (F.lit(1.0) + crr0) * (F.lit(1.0) + F.col("current_return")) - F.lit(1.0))
        .withColumn("nav", nav)
        .withColumn("history_high", F.greatest(F.col("nav"), hh0))
        .withColumn("cd", safe_div(F.col("nav"), F.col("history_high"), otherwise=None) - F.lit(1.0))
        .withColumn("mdd", F.least(F.col("cd"), mdd0))
        .withColumn("current_time", t)
        .withColumn("tw_time", tw_time(t))
    )
    return out.select(*output_columns(key))


# --------------------------------------------------------------------------- J9 / T2
def prior_snapshot(performance: DataFrame, start: Any, key: str) -> DataFrame:
    """t* = max(current_time) < start over the whole table, then every row
    at exactly t* (not the newest per key). The bound is resolved to a literal
    first so the second read gets partition pruning / Parquet pushdown."""
    t_star = performance.filter(F.col("current_time") < ts_lit(start)).agg(F.max("current_time")).first()[0]
    if t_star is None:
        return performance.limit(0).select(*output_columns(key))
    return performance.filter(F.col("current_time") == ts_lit(t_star)).select(*output_columns(key))


# --------------------------------------------------------------------------- W4 / T5
def batch_index(rows: DataFrame, time_col: str = "current_time", bucket: str = "day") -> DataFrame:
    """1-based rank of each distinct timestamp, computed without moving
    all timestamps into one task.

    Distinct times are bucketed (default: by day); each bucket numbers its own
    times in parallel, and only the per-bucket counts -- one row per bucket,
    bounded by the span of the range -- go through a running sum to give each
    bucket its offset.
    """
    times = rows.select(F.col(time_col).alias("t")).distinct().withColumn("bucket", F.date_trunc(bucket, "t"))
    counts = times.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(
        "bucket",
        (F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("offset"),
    ).fillna(0, subset=["offset"])
    local = F.row_number().over(Window.partitionBy("bucket").orderBy("t"))
    return (
        times.withColumn("local", local)
        .join(offsets, on="bucket")
        .select(F.col("t").alias(time_col), (F.col("offset") + F.col("local")).cast("long").alias("batch"))
    )


# --------------------------------------------------------------------------- W2 / W3
def split_null_amounts(series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a NULL total or adjustment would reset NAV one step later in
    the reference; they are quarantined instead of entering the recurrence."""
    bad = F.col("total_usd_value").isNull() | F.col("transfer_adjustment").isNull()
    return series.filter(~bad), series.filter(bad)


CHUNK_BATCHES = 4096  # batches per (key, chunk) slice: at most this many rows per group


def refill_performance(
    series: DataFrame,
    key: str,
    seed: DataFrame | None = None,
    *,
    gap_policy: str = "reset",
    bucket: str = "day",
    chunk_batches: int = CHUNK_BATCHES,
) -> DataFrame:
    """W2 + W3: the performance of every row of ``series`` (one row per
    (key, current_time), amounts non-NULL) as if stepped batch by batch.

    ``gap_policy='reset'`` reproduces the reference: the state handed from
    one batch to the next holds only that batch's keys, so a key absent from
    a batch restarts from the refill defaults (a new *segment*), and the
    ``seed`` (J9 rows) applies only to keys present in the first batch.
    ``'carry'`` keeps the state across gaps and seeds every key's first row.

    Skew: a key has at most one row per batch, so slicing its history into
    chunks of ``chunk_batches`` consecutive batches bounds every group. Rows
    are shuffled once, by (key, chunk); segments, running products, maxima,
    minima and falls are computed inside each chunk. A piece (a segment's part in
    a chunk) acts on a state by (product, maximum, minimum, deepest fall), which
    compose; only the first and last piece of a chunk meet others, so the scan
    across chunks has two rows per (key, chunk), not one per gap.
    A key holding a third of all rows is spread over all executors.

    The series is materialised once, its rows with the pieces once; two rows of a
    key at one time have no defined order and raise ``ValueError``.
    """
    if gap_policy not in ("reset", "carry"):
        raise ValueError("gap_policy must be 'reset' or 'carry'")
    d = REFILL_DEFAULTS
    k = F.col(key)
    cols = [key, "current_time", "tw_time", "total_usd_value", "transfer_adjustment"]
    series = cut_lineage(series.select(*cols))  # read for the index, the null keys and the rows
    rows = series

    # NULL keys never match any state (the join drops them), so each such row
    # starts fresh: r = 0, nav = 100, every other metric at its default.
    null_rows = rows.filter(k.isNull()).select(
        k,
        "total_usd_value",
        F.lit(max(d.history_high, d.nav)).alias("history_high"),
        F.lit(d.nav).alias("nav"),
        F.lit(0.0).alias("current_return"),
        F.lit(d.crr).alias("crr"),
        F.lit(0.0).alias("cd"),
        F.lit(min(0.0, d.mdd)).alias("mdd"),
        "current_time",
        "tw_time",
    )
    rows = rows.filter(k.isNotNull())
    rows = rows.join(batch_index(rows, bucket=bucket), on="current_time")
    rows = rows.withColumn("cb", F.floor((F.col("batch") - 1) / F.lit(int(chunk_batches))).cast("long"))

    # ---- pass 1 (one shuffle, by (key, chunk)): local segments ``ls`` and
    # the factors (1 + r) inside each piece = (key, chunk, ls) ---------------
    w_chunk = Window.partitionBy(key, "cb").orderBy("current_time")
    lag_b = F.lag("batch").over(w_chunk)
    local_brk = (lag_b.isNotNull() & (F.col("batch") - lag_b != 1)) if gap_policy == "reset" else F.lit(False)
    rows = rows.withColumn("_twice", lag_b.eqNullSafe(F.col("batch")))
    rows = rows.withColumn("ls", F.sum(local_brk.cast("long")).over(w_chunk.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_outer", (F.col("ls") == 0) | (F.col("ls") == F.max("ls").over(Window.partitionBy(key, "cb"))))
    w_piece = Window.partitionBy(key, "cb", "ls").orderBy("current_time")
    run_piece = w_piece.rowsBetween(Window.unboundedPreceding, 0)
    prev_local = F.lag("total_usd_value").over(w_piece)
    rows = (
        rows.withColumn("_net", F.col("total_usd_value") + F.col("transfer_adjustment"))
        .withColumn("_rl", F.when(prev_local.isNotNull(), safe_div(F.col("_net") - prev_local, prev_local, otherwise=0.0)))
        .withColumn("_gp", F.product(F.lit(1.0) + F.coalesce(F.col("_rl"), F.lit(0.0))).over(run_piece))
        .withColumn("_fall", F.col("_gp") / F.max("_gp").over(run_piece))  # G starts at 1: its maximum is positive
    )
    rows = cut_lineage(rows)
    if not rows.filter("_twice").isEmpty():
        raise ValueError(f"the series holds several rows of one {key} at one time; deduplicate it first")

    # ---- piece table: what a piece does to any state that comes in ---------
    # G = running product inside the piece: its end, maximum, minimum, and the
    # deepest fall from its own running maximum
    pieces = rows.groupBy(key, "cb", "ls").agg(
        F.min_by("_net", "current_time").alias("_net1"),
        F.max_by("total_usd_value", "current_time").alias("_tlast"),
        F.max_by("_gp", "current_time").alias("_pp"),
        F.max("_gp").alias("_gmax"),
        F.min("_gp").alias("_gmin"),
        F.min("_fall").alias("_fall"),
        F.min("batch").alias("_fb"),
        F.max("batch").alias("_lb"),
        F.first("_outer").alias("_outer"),
    )
    # Only a chunk's first and last piece can go on in another chunk; all between
    # them begin and end at gaps. So a key brings two rows per chunk to the scan
    # over chunks, however many gaps it has.
    no_seed = {c: F.lit(None).cast("double") for c in ("s_hh", "s_nav", "s_total", "s_crr", "s_mdd")}
    inner = pieces.filter(~F.col("_outer")).withColumns({"seg": F.lit(-1).cast("long"), "_seedrow": F.lit(False), **no_seed})
    pieces = pieces.filter("_outer")
    w_key = Window.partitionBy(key).orderBy("cb", "ls")
    prev_lb = F.lag("_lb").over(w_key)
    new_seg = prev_lb.isNull() | ((F.col("_fb") - prev_lb != 1) if gap_policy == "reset" else F.lit(False))
    pieces = pieces.withColumn("seg", F.sum(new_seg.cast("long")).over(w_key.rowsBetween(Window.unboundedPreceding, 0)))
    w_seg = Window.partitionBy(key, "seg").orderBy("cb")
    before = w_seg.rowsBetween(Window.unboundedPreceding, -1)
    seedable = (F.min("_fb").over(Window.partitionBy(key, "seg")) == 1) if gap_policy == "reset" else F.lit(True)
    pieces = pieces.withColumn("_seedrow", seedable)
    if seed is not None:
        pieces = pieces.join(
            seed.select(
                key,
                F.col("history_high").alias("s_hh"),
                F.col("nav").alias("s_nav"),
                F.col("total_usd_value").alias("s_total"),
                F.col("crr").alias("s_crr"),
                F.col("mdd").alias("s_mdd"),
            ),
            on=key,
            how="left",
        )
    else:
        pieces = pieces.withColumns(no_seed)

    def seed_or(c: str, default: float) -> Column:
        return F.coalesce(F.when(F.col("_seedrow"), F.col(c)), F.lit(default))

    def with_state(p: DataFrame, last_total: Column, product: Column, high: Column) -> DataFrame:
        """The state that comes into each piece, from that of the pieces before."""
        prev1 = F.coalesce(last_total, F.when(F.col("_seedrow"), F.col("s_total")), F.col("_net1"))
        p = (
            p.withColumn("_nav0", seed_or("s_nav", d.nav))
            .withColumn("_hh0", seed_or("s_hh", d.history_high))
            .withColumn("_crr0", seed_or("s_crr", d.crr))
            .withColumn("_mdd0", seed_or("s_mdd", d.mdd))
            .withColumn("_r1", safe_div(F.col("_net1") - prev1, prev1, otherwise=0.0))
            .withColumn("_f1", F.lit(1.0) + F.col("_r1"))
            .withColumn("_gin", F.coalesce(product, F.lit(1.0)))
        )
        p = p.withColumn("_scale", F.col("_nav0") * F.col("_gin") * F.col("_f1"))
        p = p.withColumn("_navmax", F.when(F.col("_scale") >= 0, F.col("_scale") * F.col("_gmax")).otherwise(F.col("_scale") * F.col("_gmin")))
        return p.withColumn("_hhin", F.greatest(F.col("_hh0"), high))

    none = F.lit(None).cast("double")
    pieces = with_state(pieces, F.lag("_tlast").over(w_seg), F.product(F.col("_f1") * F.col("_pp")).over(before), F.max("_navmax").over(before))
    inner = with_state(inner, none, none, none)
    # Where no product is negative, cd = min(nav / incoming high, nav / own running
    # high) - 1, so a piece's deepest cd follows from its summary. A negative
    # one (debts outweigh the account) needs the rows.
    lowest = F.least(F.when(F.col("_hhin") > 0, F.col("_scale") * F.col("_gmin") / F.col("_hhin")), F.col("_fall")) - F.lit(1.0)
    pieces = pieces.withColumn("_pmin", lowest)
    pieces = pieces.withColumn("_mddin", F.least(F.col("_mdd0"), F.min("_pmin").over(before)))
    inner = inner.withColumn("_pmin", lowest).withColumn("_mddin", F.col("_mdd0"))
    piece = [key, "cb", "ls"]
    pieces = pieces.unionByName(inner)
    pieces = cut_lineage(pieces.select(*piece, "seg", "_nav0", "_crr0", "_mdd0", "_r1", "_f1", "_gin", "_hhin", "_mddin", (~((F.col("_scale") >= 0) & (F.col("_gmin") >= 0) & (F.col("_hhin") > 0))).alias("_odd")))
    odd = not pieces.filter(F.coalesce("_odd", F.lit(True))).isEmpty()

    # ---- nav, crr, hh, cd per row ------------------------------------------
    rows = rows.join(pieces.drop("_odd"), on=piece)
    g = F.col("_gin") * F.col("_f1") * F.col("_gp")
    rows = (
        rows.withColumn("current_return", F.coalesce(F.col("_rl"), F.col("_r1")))
        .withColumn("nav", F.col("_nav0") * g)
        .withColumn("crr", (F.lit(1.0) + F.col("_crr0")) * g - F.lit(1.0))
        .withColumn("history_high", F.greatest(F.col("_hhin"), F.max("nav").over(run_piece)))
        .withColumn(
            "cd",
            F.when(F.col("history_high") != 0, F.col("nav") / F.col("history_high") - F.lit(1.0)).otherwise(0.0),
        )
        .withColumn("_cdmin", F.min("cd").over(run_piece))
        .select(*[c for c in output_columns(key) if c != "mdd"], "cb", "ls", "seg", "_mdd0", "_mddin", "_cdmin")
    )
    if odd:
        # drawdown from the rows: prefix minimum of cd across a segment's pieces
        rows = cut_lineage(rows.drop("_mddin"))
        mins = rows.groupBy(key, "cb", "ls", "seg").agg(F.min("cd").alias("_pmin"), F.first("_mdd0").alias("_mdd0p"))
        outer = mins.filter("seg >= 0").withColumn("_mddin", F.least(F.col("_mdd0p"), F.min("_pmin").over(before)))
        mins = outer.unionByName(mins.filter("seg < 0").withColumn("_mddin", F.col("_mdd0p")))
        rows = rows.join(mins.select(*piece, "_mddin"), on=piece)
    out = rows.withColumn("mdd", F.least(F.col("_mddin"), F.col("_cdmin"))).select(*output_columns(key))
    return out.unionByName(null_rows)
