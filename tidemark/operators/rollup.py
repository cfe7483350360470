"""Scans, latest-row selection and the master / composite rollups.

Operators S1-S3, P1-P5, P9-P11, J1, J3, J4, A1-A4, A11, A12, U1, U2, U4, T1.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import present, round_half_even, to_number, ts_lit, tw_time

AMOUNTS = ["total_usd_value", "transfer_adjustment"]


# --------------------------------------------------------------------------- S1 / S3
def active_portfolios(portfolios: DataFrame) -> DataFrame:
    """``status == 'active'`` (pushed to the Parquet scan)."""
    return portfolios.filter(F.col("status") == "active")


# --------------------------------------------------------------------------- S2 / P10
def time_range(df: DataFrame, time_col: str, start: Any = None, end: Any = None) -> DataFrame:
    """Inclusive bounds, each optional."""
    cond = match_condition({}, time_col=time_col, start=start, end=end)
    return df if cond is None else df.filter(cond)


def _one_of(c: Column, values: Any) -> Column:
    """Membership that is never NULL; a None among the values matches NULL."""
    known = [_lit_for(v) for v in values if v is not None]
    found = F.coalesce(c.isin(known), F.lit(False)) if known else F.lit(False)
    return found | c.isNull() if len(known) < len(list(values)) else found


# A missing field counts as NULL: ``$ne`` and ``$nin`` match it unless NULL is named.
_OPS = {
    "$eq": lambda c, v: c.eqNullSafe(v),
    "$ne": lambda c, v: ~c.eqNullSafe(v),
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
    "$in": _one_of,
    "$nin": lambda c, v: ~_one_of(c, v),
    "$exists": lambda c, v: c.isNotNull() if v else c.isNull(),
}


def match_condition(
    match: Mapping[str, Any] | Column | None,
    *,
    time_col: str | None = None,
    start: Any = None,
    end: Any = None,
) -> Column | None:
    """P10: AND-fold of a match spec plus an optional inclusive time range.

    ``match`` is a Column, or a dict of ``field -> value`` (equality) or
    ``field -> {"$gte": v, "$in": [...], ...}``. A time range on the same field
    replaces the dict's condition for it, as in the reference.
    """
    conds: list[Column] = []
    if isinstance(match, Column):
        conds.append(match)
    elif match:
        for field, spec in match.items():
            if time_col is not None and field == time_col and (start is not None or end is not None):
                continue
            c = F.col(field)
            if isinstance(spec, Mapping) and spec and all(str(k).startswith("$") for k in spec):
                for op, v in spec.items():
                    if op not in _OPS:
                        raise ValueError(f"unsupported match operator {op!r}")
                    conds.append(_OPS[op](c, _lit_for(v)))
            else:
                conds.append(c.isNull() if spec is None else c == _lit_for(spec))
    if time_col is not None:
        if start is not None:
            conds.append(F.col(time_col) >= ts_lit(start))
        if end is not None:
            conds.append(F.col(time_col) <= ts_lit(end))
    if not conds:
        return None
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _lit_for(v: Any) -> Any:
    import datetime as _dt

    if isinstance(v, _dt.datetime):
        return ts_lit(v)
    return v


# --------------------------------------------------------------------------- A4 / T1
def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    time_col: str = "current_time",
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """A4: newest row per key (``$sort {key:1, time:-1}`` + ``$first``).

    ``row_number() == 1`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot key ships one row per map task, not all.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(time_col).desc(), *tiebreak)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# --------------------------------------------------------------------------- J1 / P1-P3
def join_latest(
    portfolios: DataFrame,
    latest: DataFrame,
    columns: Sequence[str] = ("portfolio", "master_portfolio", "composite", "current_time", "tw_time", *AMOUNTS),
) -> DataFrame:
    """J1 + P2 + P3: dimension x latest summary on ``portfolio``; amounts are
    coerced to double (bad -> NULL) and rounded half-even to 10 places."""
    joined = portfolios.join(latest, on="portfolio", how="inner").select(*columns)
    for c in AMOUNTS:
        if c in columns:
            joined = joined.withColumn(c, round_half_even(to_number(c), 10))
    return joined


def stamp(df: DataFrame, as_of: Any) -> DataFrame:
    """One run time for every row (never ``now()`` inside a plan)."""
    t = ts_lit(as_of)
    return df.withColumn("current_time", t).withColumn("tw_time", tw_time(t))


def _sum0(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0)).alias(c)


# --------------------------------------------------------------------------- A1
def master_totals_live(joined: DataFrame, as_of: Any) -> DataFrame:
    """A1 + A2 in one pass over the joined rows.

    Rows are first summed per (master, composite); a window over each master
    puts the master's whole total on each of its (master, composite) rows;
    one grouping-sets aggregation then yields both the master totals
    (grouping set ``(master)``, summing the per-pair sums) and the composite
    totals (grouping set ``(composite)``, summing the whole totals of the
    masters present in it). No branch re-reads the input."""
    j = joined.filter(F.col("master_portfolio").isNotNull())
    comp_col = F.when(present("composite"), F.col("composite")).alias("composite")
    by_pair = j.groupBy("master_portfolio", comp_col).agg(
        F.sum("total_usd_value").alias("_t"), F.sum("transfer_adjustment").alias("_a")
    )
    w = Window.partitionBy("master_portfolio")
    by_pair = by_pair.withColumn("_mt", F.sum("_t").over(w)).withColumn("_ma", F.sum("_a").over(w))
    g = by_pair.groupingSets(
        [[F.col("master_portfolio")], [F.col("composite")]], F.col("master_portfolio"), F.col("composite")
    ).agg(
        F.sum("_t").alias("_st"),
        F.sum("_a").alias("_sa"),
        F.sum("_mt").alias("_smt"),
        F.sum("_ma").alias("_sma"),
        F.grouping("master_portfolio").alias("_gm"),
    )
    is_master = F.col("_gm") == 0
    t = ts_lit(as_of)
    out = g.filter(is_master | F.col("composite").isNotNull()).select(
        F.when(is_master, F.col("master_portfolio")).otherwise(F.col("composite")).alias("master_portfolio"),
        t.alias("current_time"),
        tw_time(t).alias("tw_time"),
        F.coalesce(F.when(is_master, F.col("_st")).otherwise(F.col("_smt")), F.lit(0.0)).alias("total_usd_value"),
        F.coalesce(F.when(is_master, F.col("_sa")).otherwise(F.col("_sma")), F.lit(0.0)).alias("transfer_adjustment"),
    )
    return drop_both_zero(out, null_safe=True)


def master_rollup(joined: DataFrame, as_of: Any) -> DataFrame:
    """A1: Σ amounts per master at ``as_of``. NULL masters are dropped (pandas
    groupby); an all-NULL sum is 0. Partial aggregation runs map-side."""
    stamped = stamp(joined.filter(F.col("master_portfolio").isNotNull()), as_of)
    return stamped.groupBy("master_portfolio", "current_time", "tw_time").agg(*[_sum0(c) for c in AMOUNTS])


# --------------------------------------------------------------------------- A2 / J3 / U1 / U4 / P4
def drop_both_zero(df: DataFrame, null_safe: bool = True) -> DataFrame:
    """P4. ``null_safe`` (live, pandas): NULL is not 0, so the row stays.
    Otherwise (refill, polars) Kleene logic: a NULL predicate drops the row."""
    t, a = F.col("total_usd_value"), F.col("transfer_adjustment")
    if null_safe:
        return df.filter(~(t.eqNullSafe(0) & a.eqNullSafe(0)))
    return df.filter(~((t == 0) & (a == 0)))


# --------------------------------------------------------------------------- A3 / J4 / A11 / U2
def composite_refill(base: DataFrame) -> DataFrame:
    """A3: a row counts for its master and for each composite its portfolio
    belongs to (``targets`` of ``refill_base``), summed per (master, time). A
    composite named like a master merges with it; NULL masters stay a group. The
    rows are read once and multiplied by their targets, not joined to a map of themselves."""
    aug = base.withColumn("master_portfolio", F.explode(F.concat(F.array("master_portfolio"), "targets")))
    for c in AMOUNTS:
        aug = aug.withColumn(c, round_half_even(c, 10))
    summed = aug.groupBy("master_portfolio", "current_time", "tw_time").agg(*[_sum0(c) for c in AMOUNTS])
    return drop_both_zero(summed, null_safe=False)


def refill_base(portfolios: DataFrame, summaries: DataFrame) -> DataFrame:
    """J1 for the refill: *all* portfolios (S3, inactive included), with the
    composites of each as ``targets`` (J4, A11)."""
    member = F.when(present("composite"), F.col("composite"))
    accounts = portfolios.select(
        "portfolio", "master_portfolio", "composite", F.collect_set(member).over(Window.partitionBy("portfolio")).alias("targets")
    )
    return accounts.join(summaries, on="portfolio", how="inner").select(
        "portfolio", "master_portfolio", "composite", "targets", "current_time", "tw_time", *AMOUNTS
    )


def portfolio_series(base: DataFrame) -> DataFrame:
    """Portfolio-level refill input: P3 + P4 (Kleene) on the base rows."""
    out = base.select("portfolio", "current_time", "tw_time", *AMOUNTS)
    for c in AMOUNTS:
        out = out.withColumn(c, round_half_even(c, 10))
    return drop_both_zero(out, null_safe=False)


# --------------------------------------------------------------------------- A12 / T2
def latest_time_before(df: DataFrame, bound: Any, time_col: str = "current_time") -> Column:
    """``max(time) < bound`` as a scalar subquery column."""
    return df.filter(F.col(time_col) < ts_lit(bound)).agg(F.max(time_col)).scalar()
