"""The reference's data jobs as lazy DataFrame plans.

* ``portfolio_mart`` / ``master_mart``: the live marts (one W1 step).
* ``refill``: the historical recurrence over a time range (W2-W4, J9).

Each returns a DataFrame; writing it (keyed upsert, K7) is left to
``tidemark.sources.tables``. Time enters only as ``as_of`` / bounds.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.performance import (
    performance_step,
    prior_snapshot,
    refill_performance,
    split_null_amounts,
)
from tidemark.operators.rollup import (
    active_portfolios,
    composite_refill,
    drop_both_zero,
    join_latest,
    latest_per_key,
    master_rollup,
    master_totals_live,
    portfolio_series,
    refill_base,
    stamp,
    time_range,
)


def latest_summaries(summaries: DataFrame, tiebreak_col: str | None = "id") -> DataFrame:
    tb = [F.col(tiebreak_col).desc()] if tiebreak_col and tiebreak_col in summaries.columns else []
    return latest_per_key(summaries, "portfolio", "current_time", tb)


def master_totals(portfolios: DataFrame, summaries: DataFrame, as_of: Any) -> DataFrame:
    """Masters (A1) plus live composites (A2), both-zero rows dropped."""
    joined = join_latest(active_portfolios(portfolios), latest_summaries(summaries))
    return master_totals_live(joined, as_of)


def smallest_master(portfolios: DataFrame, summaries: DataFrame, as_of: Any) -> str | None:
    """The first row of a first mart run: the smallest master whose totals are
    not both zero; composites come after the masters. None if no master is left."""
    joined = join_latest(active_portfolios(portfolios), latest_summaries(summaries))
    return drop_both_zero(master_rollup(joined, as_of), null_safe=True).agg(F.min("master_portfolio")).first()[0]


def master_mart(
    portfolios: DataFrame,
    summaries: DataFrame,
    previous: DataFrame | None,
    as_of: Any,
    seed_key: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    return performance_step(
        master_totals(portfolios, summaries, as_of),
        previous,
        "master_portfolio",
        as_of,
        seed_key=seed_key or (lambda: smallest_master(portfolios, summaries, as_of)),
        inclusive=inclusive,
    )


def portfolio_totals(portfolios: DataFrame, summaries: DataFrame, as_of: Any) -> DataFrame:
    joined = join_latest(
        active_portfolios(portfolios),
        latest_summaries(summaries),
        columns=("portfolio", "current_time", "tw_time", "total_usd_value", "transfer_adjustment"),
    )
    return stamp(joined, as_of)


def portfolio_mart(
    portfolios: DataFrame,
    summaries: DataFrame,
    previous: DataFrame | None,
    as_of: Any,
    seed_key: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    totals = portfolio_totals(portfolios, summaries, as_of)
    return performance_step(totals, previous, "portfolio", as_of, seed_key=seed_key, inclusive=inclusive)


def refill_series(portfolios: DataFrame, summaries: DataFrame, level: str, start: Any = None, end: Any = None) -> DataFrame:
    """Range scan (S2) + all portfolios (S3) + J1, then A3 (master level) or
    P3/P4 (portfolio level)."""
    rng = time_range(summaries, "current_time", start, end)
    base = refill_base(portfolios, rng)
    if level == "master":
        return composite_refill(base)
    if level == "portfolio":
        return portfolio_series(base)
    raise ValueError("level must be 'portfolio' or 'master'")


def refill_parts(
    portfolios: DataFrame,
    summaries: DataFrame,
    performance: DataFrame | None,
    *,
    level: str = "portfolio",
    start: Any = None,
    end: Any = None,
    gap_policy: str = "reset",
    bucket: str = "day",
    chunk_batches: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Historical refill between inclusive bounds, seeded from the newest
    snapshot of ``performance`` strictly before ``start`` (J9), and the summaries
    in the range with a NULL total or adjustment. At portfolio level these do not
    enter the refill; the sums of the master level count a NULL as 0."""
    key = "master_portfolio" if level == "master" else "portfolio"
    series, _ = split_null_amounts(refill_series(portfolios, summaries, level, start, end))
    quarantine = split_null_amounts(refill_base(portfolios, time_range(summaries, "current_time", start, end)))[1].drop("targets")
    seed = prior_snapshot(performance, start, key) if (performance is not None and start is not None) else None
    kw = {} if chunk_batches is None else {"chunk_batches": chunk_batches}
    return refill_performance(series, key, seed, gap_policy=gap_policy, bucket=bucket, **kw), quarantine


def refill(portfolios: DataFrame, summaries: DataFrame, performance: DataFrame | None, **how: Any) -> DataFrame:
    """The performance rows of ``refill_parts``."""
    return refill_parts(portfolios, summaries, performance, **how)[0]
