"""DuckDB oracle SQL for the named queries.

Written independently of the Spark operators, in plain single-node SQL
(``DENSE_RANK`` over all timestamps, ``QUALIFY``, ``PRODUCT() OVER``). The
role views come from ``tidemark.plans.fixtures`` so both sides read the same
inputs. Every double in a result is rounded to 6 places, as ``finish`` does.
"""

from __future__ import annotations

from tidemark.plans import queries as Q
from tidemark.plans.fixtures import AS_OF, cte

ORACLE: dict[str, str] = {}

AMT = ("total_usd_value", "transfer_adjustment")
PERF_COLS = ("total_usd_value", "history_high", "nav", "current_return", "crr", "cd", "mdd")
CT = '"current_time"'


def ts(v: str) -> str:
    """A timestamp literal, or an SQL expression passed in parentheses."""
    return v if v.startswith("(") else f"TIMESTAMP '{v}'"


def tw(expr: str) -> str:
    return f"strftime({expr} + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')"


def rounded(cols: list[str], doubles: tuple[str, ...] | list[str], src: str) -> str:
    sel = ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' if c in doubles else f'"{c}"' for c in cols)
    return f"SELECT {sel} FROM {src}"


def with_(*parts: tuple[str, str], roles: tuple[str, ...] = ()) -> str:
    head = cte(*roles) if roles else ""
    body = ",\n".join(f"{n} AS ({s})" for n, s in parts)
    if head and body:
        return head + ",\n" + body
    return head or ("WITH " + body if body else "")


# ----------------------------------------------------------------- building blocks
LATEST = f"""SELECT * FROM account_summary
QUALIFY row_number() OVER (PARTITION BY portfolio ORDER BY {CT} DESC, id DESC) = 1"""


def active_join_sql(summary: str = "latest") -> str:
    return f"""SELECT p.portfolio, p.master_portfolio, p.composite, l.{CT}, l.tw_time,
  round_even(TRY_CAST(l.total_usd_value AS DOUBLE), 10) AS total_usd_value,
  round_even(TRY_CAST(l.transfer_adjustment AS DOUBLE), 10) AS transfer_adjustment
FROM portfolio p JOIN {summary} l ON p.portfolio = l.portfolio WHERE p.status = 'active'"""


def masters_sql(aj: str, as_of: str) -> str:
    return f"""SELECT master_portfolio, {ts(as_of)} AS {CT}, {tw(ts(as_of))} AS tw_time,
  COALESCE(SUM(total_usd_value), 0) AS total_usd_value,
  COALESCE(SUM(transfer_adjustment), 0) AS transfer_adjustment
FROM {aj} WHERE master_portfolio IS NOT NULL GROUP BY master_portfolio"""


def composites_parts(prefix: str, aj: str, masters: str) -> list[tuple[str, str]]:
    return [
        (f"{prefix}pairs", f"SELECT DISTINCT composite, master_portfolio FROM {aj} WHERE composite IS NOT NULL AND composite <> ''"),
        (
            f"{prefix}comp",
            f"""SELECT pr.composite AS master_portfolio, m.{CT}, m.tw_time,
  COALESCE(SUM(m.total_usd_value), 0) AS total_usd_value, COALESCE(SUM(m.transfer_adjustment), 0) AS transfer_adjustment
FROM {masters} m JOIN {prefix}pairs pr ON m.master_portfolio = pr.master_portfolio
GROUP BY pr.composite, m.{CT}, m.tw_time""",
        ),
        (
            f"{prefix}totals",
            f"""SELECT * FROM (SELECT * FROM {masters} UNION ALL SELECT * FROM {prefix}comp)
WHERE NOT (total_usd_value IS NOT DISTINCT FROM 0 AND transfer_adjustment IS NOT DISTINCT FROM 0)""",
        ),
    ]


def step_parts(prefix: str, totals: str, key: str, as_of: str, prev: str | None, first_of: str | None = None) -> list[tuple[str, str]]:
    """W1 in SQL. ``prev`` is a mart CTE or None (empty mart); the first row of
    an empty mart is the smallest key of ``first_of`` with an amount, else of ``totals``."""
    if prev is None:
        some = f"(SELECT min({key}) FROM {first_of} WHERE total_usd_value <> 0 OR transfer_adjustment <> 0)" if first_of else "NULL"
        j = f"""SELECT t.*, CASE WHEN t.{key} = COALESCE({some}, (SELECT min({key}) FROM {totals}))
    THEN t.total_usd_value + t.transfer_adjustment ELSE t.total_usd_value END AS prev_total,
  CAST(0 AS DOUBLE) AS hh0, CAST(100 AS DOUBLE) AS nav0, CAST(0 AS DOUBLE) AS crr0, CAST(0 AS DOUBLE) AS mdd0
FROM {totals} t"""
        parts: list[tuple[str, str]] = []
    else:
        parts = [
            (
                f"{prefix}pl",
                f"SELECT * FROM {prev} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {CT} DESC) = 1",
            )
        ]
        j = f"""SELECT t.*, COALESCE(p.total_usd_value, t.total_usd_value) AS prev_total,
  COALESCE(p.history_high, 0) AS hh0, COALESCE(p.nav, 100) AS nav0,
  COALESCE(p.crr, 0) AS crr0, COALESCE(p.mdd, 0) AS mdd0
FROM {totals} t LEFT JOIN {prefix}pl p ON t.{key} = p.{key}"""
    parts += [
        (f"{prefix}j", j),
        (
            f"{prefix}r",
            f"""SELECT *, CASE WHEN prev_total <> 0 THEN (total_usd_value + transfer_adjustment - prev_total) / prev_total END AS current_return
FROM {prefix}j""",
        ),
        (
            f"{prefix}n",
            f"SELECT *, (1 + crr0) * (1 + current_return) - 1 AS crr, nav0 * (1 + current_return) AS nav FROM {prefix}r",
        ),
        (f"{prefix}h", f"SELECT *, greatest(nav, hh0) AS history_high FROM {prefix}n"),
        (f"{prefix}c", f"SELECT *, CASE WHEN history_high <> 0 THEN nav / history_high END - 1 AS cd FROM {prefix}h"),
        (
            f"{prefix}out",
            f"""SELECT {key}, total_usd_value, history_high, nav, current_return, crr, cd, least(cd, mdd0) AS mdd,
  {ts(as_of)} AS {CT}, {tw(ts(as_of))} AS tw_time FROM {prefix}c""",
        ),
    ]
    return parts


def master_mart_parts(prefix: str, summary_filter: str, as_of: str, prev: str | None) -> list[tuple[str, str]]:
    return [
        (f"{prefix}lat", f"SELECT * FROM account_summary {summary_filter} QUALIFY row_number() OVER (PARTITION BY portfolio ORDER BY {CT} DESC, id DESC) = 1"),
        (f"{prefix}aj", active_join_sql(f"{prefix}lat")),
        (f"{prefix}m", masters_sql(f"{prefix}aj", as_of)),
        *composites_parts(prefix, f"{prefix}aj", f"{prefix}m"),
        *step_parts(f"{prefix}s", f"{prefix}totals", "master_portfolio", as_of, prev, f"{prefix}m"),
    ]


def portfolio_mart_parts(prefix: str, summary_filter: str, as_of: str, prev: str | None) -> list[tuple[str, str]]:
    return [
        (f"{prefix}lat", f"SELECT * FROM account_summary {summary_filter} QUALIFY row_number() OVER (PARTITION BY portfolio ORDER BY {CT} DESC, id DESC) = 1"),
        (
            f"{prefix}tot",
            f"""SELECT p.portfolio, {ts(as_of)} AS {CT}, {tw(ts(as_of))} AS tw_time,
  round_even(TRY_CAST(l.total_usd_value AS DOUBLE), 10) AS total_usd_value,
  round_even(TRY_CAST(l.transfer_adjustment AS DOUBLE), 10) AS transfer_adjustment
FROM portfolio p JOIN {prefix}lat l ON p.portfolio = l.portfolio WHERE p.status = 'active'""",
        ),
        *step_parts(f"{prefix}s", f"{prefix}tot", "portfolio", as_of, prev),
    ]


def series_parts(prefix: str, summary: str, level: str, where: str = "") -> list[tuple[str, str]]:
    """Refill input: all portfolios x summaries in range, then A3 or P3/P4."""
    base = f"""SELECT p.portfolio, p.master_portfolio, p.composite, s.{CT}, s.tw_time, s.total_usd_value, s.transfer_adjustment
FROM portfolio p JOIN {summary} s ON p.portfolio = s.portfolio {where}"""
    if level == "portfolio":
        return [
            (f"{prefix}base", base),
            (
                f"{prefix}series",
                f"""SELECT * FROM (SELECT portfolio, {CT}, tw_time, round_even(total_usd_value, 10) AS total_usd_value,
  round_even(transfer_adjustment, 10) AS transfer_adjustment FROM {prefix}base)
WHERE NOT (total_usd_value = 0 AND transfer_adjustment = 0)
  AND total_usd_value IS NOT NULL AND transfer_adjustment IS NOT NULL""",
            ),
        ]
    return [
        (f"{prefix}base", base),
        (
            f"{prefix}pairs",
            f"SELECT DISTINCT composite AS new_master, portfolio FROM {prefix}base WHERE composite IS NOT NULL AND composite <> ''",
        ),
        (
            f"{prefix}aug",
            f"""SELECT master_portfolio, {CT}, tw_time, total_usd_value, transfer_adjustment FROM {prefix}base
UNION ALL
SELECT pr.new_master, b.{CT}, b.tw_time, b.total_usd_value, b.transfer_adjustment
FROM {prefix}base b JOIN {prefix}pairs pr ON b.portfolio = pr.portfolio""",
        ),
        (
            f"{prefix}series",
            f"""SELECT * FROM (SELECT master_portfolio, {CT}, tw_time,
  COALESCE(SUM(round_even(total_usd_value, 10)), 0) AS total_usd_value,
  COALESCE(SUM(round_even(transfer_adjustment, 10)), 0) AS transfer_adjustment
  FROM {prefix}aug GROUP BY master_portfolio, {CT}, tw_time)
WHERE NOT (total_usd_value = 0 AND transfer_adjustment = 0)""",
        ),
    ]


def recurrence_parts(prefix: str, series: str, key: str, seed: str | None, policy: str = "reset") -> list[tuple[str, str]]:
    """W2/W3 in SQL: global DENSE_RANK batches, gaps-and-islands segments,
    then running PRODUCT / MAX / MIN per segment."""
    w_seg = f"PARTITION BY {key}, seg ORDER BY {CT}"
    frame = f"({w_seg} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    if policy == "reset":
        seg = [
            (f"{prefix}b", f"SELECT *, DENSE_RANK() OVER (ORDER BY {CT}) AS batch FROM {series}"),
            (
                f"{prefix}g",
                f"""SELECT *, CASE WHEN {key} IS NULL
  OR batch - LAG(batch) OVER (PARTITION BY {key} ORDER BY {CT}) IS DISTINCT FROM 1 THEN 1 ELSE 0 END AS brk FROM {prefix}b""",
            ),
            (
                f"{prefix}sg",
                f"SELECT *, SUM(brk) OVER (PARTITION BY {key} ORDER BY {CT} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM {prefix}g",
            ),
            (f"{prefix}f", f"SELECT *, MIN(batch) OVER (PARTITION BY {key}, seg) = 1 AS seedrow FROM {prefix}sg"),
        ]
    else:
        seg = [(f"{prefix}f", f"SELECT *, 0 AS seg, TRUE AS seedrow FROM {series}")]
    if seed is None:
        j = f"""SELECT *, CAST(NULL AS DOUBLE) AS s_total, CAST(NULL AS DOUBLE) AS s_nav, CAST(NULL AS DOUBLE) AS s_hh,
  CAST(NULL AS DOUBLE) AS s_crr, CAST(NULL AS DOUBLE) AS s_mdd FROM {prefix}f"""
    else:
        j = f"""SELECT f.*, sd.total_usd_value AS s_total, sd.nav AS s_nav, sd.history_high AS s_hh, sd.crr AS s_crr, sd.mdd AS s_mdd
FROM {prefix}f f LEFT JOIN {seed} sd ON f.{key} = sd.{key}"""
    return seg + [
        (f"{prefix}j", j),
        (
            f"{prefix}pv",
            f"""SELECT *, total_usd_value + transfer_adjustment AS net,
  COALESCE(LAG(total_usd_value) OVER ({w_seg}), CASE WHEN seedrow THEN s_total END, total_usd_value + transfer_adjustment) AS prev_total
FROM {prefix}j""",
        ),
        (
            f"{prefix}r",
            f"SELECT *, CASE WHEN prev_total <> 0 THEN (net - prev_total) / prev_total ELSE 0 END AS current_return FROM {prefix}pv",
        ),
        (
            f"{prefix}n",
            f"""SELECT *, COALESCE(CASE WHEN seedrow THEN s_nav END, 100) * PRODUCT(1 + current_return) OVER {frame} AS nav,
  (1 + COALESCE(CASE WHEN seedrow THEN s_crr END, 0)) * PRODUCT(1 + current_return) OVER {frame} - 1 AS crr
FROM {prefix}r""",
        ),
        (
            f"{prefix}h",
            f"SELECT *, greatest(MAX(nav) OVER {frame}, COALESCE(CASE WHEN seedrow THEN s_hh END, 100)) AS history_high FROM {prefix}n",
        ),
        (f"{prefix}c", f"SELECT *, CASE WHEN history_high <> 0 THEN nav / history_high - 1 ELSE 0 END AS cd FROM {prefix}h"),
        (
            f"{prefix}out",
            f"""SELECT {key}, total_usd_value, history_high, nav, current_return, crr, cd,
  least(MIN(cd) OVER {frame}, COALESCE(CASE WHEN seedrow THEN s_mdd END, 0)) AS mdd, {CT}, tw_time FROM {prefix}c""",
        ),
    ]


def seed_sql(perf: str, start: str) -> str:
    return f"SELECT * FROM {perf} WHERE {CT} = (SELECT max({CT}) FROM {perf} WHERE {CT} < {ts(start)})"


def two_stage_refill(summary: str, level: str, split: str, policy: str = "reset") -> list[tuple[str, str]]:
    key = "master_portfolio" if level == "master" else "portfolio"
    return [
        *series_parts("h_", summary, level, f"WHERE s.{CT} < {ts(split)}"),
        *recurrence_parts("h_", "h_series", key, None, policy),
        ("seed", seed_sql("h_out", split)),
        *series_parts("r_", summary, level, f"WHERE s.{CT} >= {ts(split)}"),
        *recurrence_parts("r_", "r_series", key, "seed", policy),
        ("allout", "SELECT * FROM h_out UNION ALL SELECT * FROM r_out"),
    ]


def perf_cols(key: str) -> list[str]:
    return [key, *PERF_COLS, "current_time", "tw_time"]


# ----------------------------------------------------------------- the oracles
ORACLE["active_scan"] = with_(roles=("portfolio",)) + "\n" + rounded(
    ["portfolio", "exchange", "master_portfolio", "composite", "position_threshold"],
    ("position_threshold",),
    "portfolio WHERE status = 'active'",
)

ORACLE["range_scan"] = with_(roles=("account_summary",)) + "\n" + rounded(
    ["id", "portfolio", "exchange", "total_usd_value", "current_time"],
    ("total_usd_value",),
    f"account_summary WHERE exchange IN ('okx', 'bybit', 'binance') AND {CT} >= {ts(Q.RANGE_START)} AND {CT} <= {ts(Q.RANGE_END)}",
)

ORACLE["latest_per_key"] = with_(("latest", LATEST), roles=("account_summary",)) + "\n" + rounded(
    ["id", "portfolio", "exchange", "total_usd_value", "transfer_adjustment", "current_time", "tw_time"], AMT, "latest"
)

ORACLE["active_join"] = with_(("latest", LATEST), ("aj", active_join_sql()), roles=("portfolio", "account_summary")) + "\n" + rounded(
    ["portfolio", "master_portfolio", "composite", "current_time", "tw_time", *AMT], AMT, "aj"
)

ORACLE["master_rollup"] = with_(
    ("latest", LATEST), ("aj", active_join_sql()), ("m", masters_sql("aj", AS_OF)), roles=("portfolio", "account_summary")
) + "\n" + rounded(["master_portfolio", "current_time", "tw_time", *AMT], AMT, "m")

ORACLE["composite_live"] = with_(
    ("latest", LATEST),
    ("aj", active_join_sql()),
    ("m", masters_sql("aj", AS_OF)),
    *composites_parts("c_", "aj", "m"),
    roles=("portfolio", "account_summary"),
) + "\n" + rounded(["master_portfolio", "current_time", "tw_time", *AMT], AMT, "c_totals")

ORACLE["composite_refill"] = with_(
    *series_parts("", "monthly_summary", "master"), roles=("portfolio", "monthly_summary")
) + "\n" + rounded(["master_portfolio", "current_time", "tw_time", *AMT], AMT, "series")

ORACLE["perf_step_empty"] = with_(
    *master_mart_parts("a_", "", AS_OF, None), roles=("portfolio", "account_summary")
) + "\n" + rounded(perf_cols("master_portfolio"), PERF_COLS, "a_sout")

ORACLE["perf_step_prev"] = with_(
    *master_mart_parts("e_", f"WHERE {CT} < {ts(Q.PREV_AS_OF)}", Q.PREV_AS_OF, None),
    *master_mart_parts("a_", "", AS_OF, "e_sout"),
    roles=("portfolio", "account_summary"),
) + "\n" + rounded(perf_cols("master_portfolio"), PERF_COLS, "a_sout")

ORACLE["portfolio_mart"] = with_(
    *portfolio_mart_parts("e_", f"WHERE {CT} < {ts(Q.PREV_AS_OF)}", Q.PREV_AS_OF, None),
    *portfolio_mart_parts("a_", "", AS_OF, "e_sout"),
    roles=("portfolio", "account_summary"),
) + "\n" + rounded(perf_cols("portfolio"), PERF_COLS, "a_sout")

ORACLE["batch_index"] = with_(
    *series_parts("", "daily_summary", "portfolio"), roles=("portfolio", "daily_summary")
) + f"\nSELECT {CT}, CAST(DENSE_RANK() OVER (ORDER BY {CT}) AS BIGINT) AS batch FROM (SELECT DISTINCT {CT} FROM series)"

ORACLE["prior_snapshot"] = with_(
    *two_stage_refill("daily_summary", "portfolio", Q.DAILY_SPLIT), roles=("portfolio", "daily_summary")
) + "\n" + rounded(perf_cols("portfolio"), PERF_COLS, "seed")

ORACLE["refill_portfolio"] = with_(
    *two_stage_refill("daily_summary", "portfolio", Q.DAILY_SPLIT), roles=("portfolio", "daily_summary")
) + "\n" + rounded(perf_cols("portfolio"), PERF_COLS, "allout")

ORACLE["refill_gap_carry"] = with_(
    *two_stage_refill("daily_summary", "portfolio", Q.DAILY_SPLIT, "carry"), roles=("portfolio", "daily_summary")
) + "\n" + rounded(perf_cols("portfolio"), PERF_COLS, "allout")

ORACLE["refill_master"] = with_(
    *two_stage_refill("monthly_summary", "master", Q.MONTHLY_SPLIT), roles=("portfolio", "monthly_summary")
) + "\n" + rounded(perf_cols("master_portfolio"), PERF_COLS, "allout")

# ----------------------------------------------------------------- dedup / merge / update / append
SUMMARY_COLS = ["id", "portfolio", "exchange", "total_usd_value", "transfer_adjustment", "current_time", "tw_time"]
DEDUP_A_WIN = f"""SELECT id FROM account_summary QUALIFY row_number() OVER (
  PARTITION BY portfolio, {CT} ORDER BY {CT} DESC, total_usd_value DESC, id ASC) = 1"""
DEDUP_B_SCOPE = f"""SELECT * FROM account_summary WHERE exchange IN ('okx', 'bybit', 'bitmex')
  AND {CT} >= {ts(Q.RANGE_START)} AND {CT} <= TIMESTAMP '1998-12-31 23:59:59'"""
DEDUP_B_WIN = f"SELECT id FROM b_scope QUALIFY row_number() OVER (PARTITION BY portfolio ORDER BY {CT} DESC, id DESC) = 1"

ORACLE["dedup_keep"] = with_(("a_win", DEDUP_A_WIN), roles=("account_summary",)) + "\n" + rounded(
    SUMMARY_COLS, AMT, "account_summary WHERE id IN (SELECT id FROM a_win)"
)
ORACLE["dedup_removed"] = with_(("b_scope", DEDUP_B_SCOPE), ("b_win", DEDUP_B_WIN), roles=("account_summary",)) + "\n" + rounded(
    SUMMARY_COLS, AMT, "b_scope WHERE id NOT IN (SELECT id FROM b_win)"
)
ORACLE["dedup_summary"] = with_(("b_scope", DEDUP_B_SCOPE), roles=("account_summary",)) + f"""
SELECT CAST(g AS BIGINT) AS matched_groups, CAST(n - g AS BIGINT) AS deleted_ids, variant FROM (
  SELECT (SELECT count(*) FROM (SELECT DISTINCT portfolio, {CT} FROM account_summary)) AS g,
         (SELECT count(*) FROM account_summary) AS n, 'A' AS variant
  UNION ALL
  SELECT (SELECT count(*) FROM (SELECT DISTINCT portfolio FROM b_scope)), (SELECT count(*) FROM b_scope), 'B')"""

MERGE_PARTS = (
    ("a_win", DEDUP_A_WIN),
    ("kept", "SELECT * FROM account_summary WHERE id IN (SELECT id FROM a_win)"),
    ("tg", f"SELECT * FROM kept WHERE {CT} < {ts(Q.MERGE_TARGET_BEFORE)}"),
    (
        "src",
        f"""SELECT portfolio, {CT},
  CASE WHEN exchange = 'okx' THEN total_usd_value ELSE total_usd_value * 2 END AS total_usd_value,
  CASE WHEN exchange IN ('bybit', 'binance') THEN CAST(NULL AS DOUBLE) ELSE transfer_adjustment END AS transfer_adjustment,
  'merged' AS note
FROM kept WHERE {CT} >= {ts(Q.MERGE_SOURCE_FROM)}""",
    ),
    (
        "fj",
        f"""SELECT COALESCE(t.portfolio, s.portfolio) AS portfolio, COALESCE(t.{CT}, s.{CT}) AS {CT},
  t.portfolio IS NOT NULL AS in_t, s.portfolio IS NOT NULL AS in_s,
  t.id, t.exchange, t.tw_time, t.total_usd_value AS t_total, t.transfer_adjustment AS t_adj,
  s.total_usd_value AS s_total, s.transfer_adjustment AS s_adj, s.note
FROM tg t FULL OUTER JOIN src s ON t.portfolio = s.portfolio AND t.{CT} = s.{CT}""",
    ),
)
MERGE_COLS = [*SUMMARY_COLS, "note"]
MERGE_SELECT = {
    "set": """SELECT id, portfolio, exchange, CASE WHEN in_s THEN s_total ELSE t_total END AS total_usd_value,
  CASE WHEN in_s THEN s_adj ELSE t_adj END AS transfer_adjustment, "current_time", tw_time, note FROM fj""",
    "set_no_null": """SELECT id, portfolio, exchange, COALESCE(s_total, t_total) AS total_usd_value,
  COALESCE(s_adj, t_adj) AS transfer_adjustment, "current_time", tw_time, note FROM fj""",
    "replace": """SELECT CASE WHEN in_s THEN NULL ELSE id END AS id, portfolio, CASE WHEN in_s THEN NULL ELSE exchange END AS exchange,
  CASE WHEN in_s THEN s_total ELSE t_total END AS total_usd_value,
  CASE WHEN in_s THEN s_adj ELSE t_adj END AS transfer_adjustment, "current_time",
  CASE WHEN in_s THEN NULL ELSE tw_time END AS tw_time, note FROM fj""",
    "no_upsert": """SELECT id, portfolio, exchange, CASE WHEN in_s THEN s_total ELSE t_total END AS total_usd_value,
  CASE WHEN in_s THEN s_adj ELSE t_adj END AS transfer_adjustment, "current_time", tw_time, note FROM fj WHERE in_t""",
}
for _v, _sel in MERGE_SELECT.items():
    ORACLE[f"merge_{_v}"] = with_(*MERGE_PARTS, (f"m_{_v}", _sel), roles=("account_summary",)) + "\n" + rounded(
        MERGE_COLS, AMT, f"m_{_v}"
    )

_MOD = {
    "set": "(t_total IS DISTINCT FROM s_total OR t_adj IS DISTINCT FROM s_adj OR note IS NOT NULL)",
    "set_no_null": """((s_total IS NOT NULL AND t_total IS DISTINCT FROM s_total)
      OR (s_adj IS NOT NULL AND t_adj IS DISTINCT FROM s_adj) OR note IS NOT NULL)""",
    "replace": """(id IS NOT NULL OR exchange IS NOT NULL OR tw_time IS NOT NULL
      OR t_total IS DISTINCT FROM s_total OR t_adj IS DISTINCT FROM s_adj OR note IS NOT NULL)""",
    "no_upsert": "(t_total IS DISTINCT FROM s_total OR t_adj IS DISTINCT FROM s_adj OR note IS NOT NULL)",
}
ORACLE["merge_summary"] = with_(*MERGE_PARTS, roles=("account_summary",)) + "\n" + "\nUNION ALL\n".join(
    f"""SELECT CAST(count(*) FILTER (WHERE in_t AND in_s) AS BIGINT) AS matched,
  CAST(count(*) FILTER (WHERE in_t AND in_s AND {mod}) AS BIGINT) AS modified,
  CAST({'0' if v == 'no_upsert' else 'count(*) FILTER (WHERE in_s AND NOT in_t)'} AS BIGINT) AS upserted, '{v}' AS variant FROM fj"""
    for v, mod in _MOD.items()
)

ORACLE["append_rows"] = with_(roles=("account_summary", "daily_summary")) + "\n" + rounded(
    SUMMARY_COLS,
    AMT,
    f"""(SELECT id, portfolio, exchange, total_usd_value, transfer_adjustment, {CT}, tw_time FROM account_summary
  UNION ALL SELECT NULL, portfolio, NULL, total_usd_value, transfer_adjustment, {CT}, tw_time FROM daily_summary)""",
)

ORACLE["update_where"] = with_(
    ("w1", "SELECT min(id) AS id FROM account_summary WHERE portfolio = '7'"),
    ("w2", f"SELECT min(id) AS id FROM account_summary WHERE exchange = 'bybit' AND {CT} >= TIMESTAMP '1998-01-01 00:00:00'"),
    ("w4", "SELECT min(id) AS id FROM account_summary WHERE id = 5"),
    roles=("account_summary",),
) + "\n" + rounded(
    SUMMARY_COLS,
    AMT,
    f"""(SELECT id, portfolio,
  CASE WHEN id = (SELECT id FROM w1) THEN 'okx-migrated' ELSE exchange END AS exchange,
  CASE WHEN id = (SELECT id FROM w2) THEN COALESCE(total_usd_value, 0) + 100.0 ELSE total_usd_value END AS total_usd_value,
  transfer_adjustment, {CT},
  CASE WHEN id = (SELECT id FROM w4) THEN NULL ELSE tw_time END AS tw_time
FROM account_summary
UNION ALL SELECT NULL, 'no-such-portfolio', 'okx', CAST(1.0 AS DOUBLE), NULL, NULL, NULL)""",
)


def _update_sequence() -> str:
    """The updates of UPDATE_SEQUENCE one after the other; the row made by an upsert has no id and comes last."""
    step = lambda k, cond, sets: (f"u{k}", f"""SELECT * REPLACE ({", ".join(f"CASE WHEN hit THEN {v} ELSE {c} END AS {c}" for c, v in sets.items())}) FROM (
  SELECT * EXCLUDE (hit), EXISTS (SELECT 1 FROM u{k - 1} WHERE {cond})
    AND id IS NOT DISTINCT FROM (SELECT id FROM u{k - 1} WHERE {cond} ORDER BY id NULLS LAST LIMIT 1) AS hit FROM u{k - 1})""")  # noqa: E731
    parts = [("u0", "SELECT *, false AS hit FROM account_summary")]
    parts.append(step(1, "portfolio = '7'", {"exchange": "'moved'"}))
    parts.append(step(2, "portfolio = '7'", {"total_usd_value": "total_usd_value + 1000.0"}))
    parts.append(step(3, "exchange = 'moved'", {"total_usd_value": "total_usd_value * 2"}))
    parts.append(("u4", "SELECT * FROM u3 UNION ALL BY NAME SELECT 'new' AS portfolio, CAST(5.0 AS DOUBLE) AS total_usd_value, false AS hit"))
    parts.append(step(5, "portfolio = 'new'", {"total_usd_value": "total_usd_value + 1.5"}))
    parts.append(step(6, "exchange = 'okx'", {"exchange": "'bybit'"}))
    parts.append(step(7, "exchange = 'okx'", {"exchange": "'bybit'"}))
    return with_(*parts, roles=("account_summary",)) + "\nSELECT * EXCLUDE (hit) REPLACE (round(total_usd_value, 6) AS total_usd_value, round(transfer_adjustment, 6) AS transfer_adjustment) FROM u7"


ORACLE["update_sequence"] = _update_sequence()
ORACLE["update_array_filters"] = """
WITH l AS (SELECT CAST(l_orderkey AS BIGINT) AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos,
  l_partkey AS part, CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_extendedprice AS DOUBLE) AS price FROM lineitem),
f AS (SELECT min(id) FILTER (id >= 100) AS a, min(id) FILTER (id >= 5000) AS b FROM l)
SELECT id, pos, part, CASE WHEN id = b THEN 1.0 ELSE quantity END AS quantity,
  round(CASE WHEN id = a THEN CASE WHEN quantity >= 20 THEN price * 2 ELSE price + 1.5 END ELSE price END, 6) AS price FROM l, f"""
ORACLE["update_summary"] = with_(
    ("w1", "SELECT min(id) AS id FROM account_summary WHERE portfolio = '7'"),
    ("w2", f"SELECT min(id) AS id FROM account_summary WHERE exchange = 'bybit' AND {CT} >= TIMESTAMP '1998-01-01 00:00:00'"),
    ("w4", "SELECT min(id) AS id FROM account_summary WHERE id = 5"),
    ("w3", "SELECT min(id) AS id FROM account_summary WHERE portfolio = 'no-such-portfolio'"),
    roles=("account_summary",),
) + """
SELECT
  CAST((SELECT id FROM w1) IS NOT NULL AS BIGINT) + CAST((SELECT id FROM w2) IS NOT NULL AS BIGINT)
    + CAST((SELECT id FROM w3) IS NOT NULL AS BIGINT) + CAST((SELECT id FROM w4) IS NOT NULL AS BIGINT) AS matched,
  CAST(COALESCE((SELECT exchange IS DISTINCT FROM 'okx-migrated' FROM account_summary WHERE id = (SELECT id FROM w1)), FALSE) AS BIGINT)
    + CAST(COALESCE((SELECT COALESCE(total_usd_value, 0) + 100.0 IS DISTINCT FROM total_usd_value
                     FROM account_summary WHERE id = (SELECT id FROM w2)), FALSE) AS BIGINT)
    + CAST(COALESCE((SELECT tw_time IS NOT NULL FROM account_summary WHERE id = (SELECT id FROM w4)), FALSE) AS BIGINT) AS modified,
  CAST((SELECT id FROM w3) IS NULL AS BIGINT) AS upserted"""

# ----------------------------------------------------------------- snapshots / transfers
import calendar as _cal  # noqa: E402
import datetime as _dt  # noqa: E402

from tidemark.plans import payloads as PL  # noqa: E402


def cutoff_ms(as_of: str, minutes: float) -> int:
    t = _dt.datetime.fromisoformat(as_of)
    return _cal.timegm(t.timetuple()) * 1000 - int(round(minutes * 60_000))


def transfer_sql(as_of: str, minutes: float, rule: str, upto: str | None = None) -> str:
    ts_ = "TRY_CAST(ts_ms AS BIGINT)"
    amt = "TRY_CAST(amount AS DOUBLE)"
    if rule == "unified":
        val = f"CASE WHEN lower(to_account) = 'unified' THEN -1.0 ELSE 1.0 END * {amt}"
    else:
        val = f"CASE to_account WHEN '18' THEN -abs({amt}) WHEN '6' THEN abs({amt}) ELSE 0.0 END"
    end = f" AND {ts_} <= {cutoff_ms(upto, 0)}" if upto else ""
    return f"""SELECT portfolio, COALESCE(SUM(CASE WHEN {ts_} > {cutoff_ms(as_of, minutes)}{end} THEN {val} END), 0.0) AS adjustment,
  TRUE AS ok FROM transfers GROUP BY portfolio"""


ORACLE["transfer_unified"] = with_(("t", transfer_sql(Q.TRANSFER_AS_OF, Q.TRANSFER_WINDOW_MIN, "unified")), roles=("transfers",)) + (
    "\n" + rounded(["portfolio", "adjustment", "ok"], ("adjustment",), "t")
)
ORACLE["transfer_18_6"] = with_(("t", transfer_sql(Q.TRANSFER_AS_OF, Q.TRANSFER_WINDOW_MIN, "18/6")), roles=("transfers",)) + (
    "\n" + rounded(["portfolio", "adjustment", "ok"], ("adjustment",), "t")
)

SNAP_LINES = f"""SELECT CAST(l_orderkey AS STRING) AS portfolio, {PL.EXCHANGE} AS exchange,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY {PL.LINE_ORDER}) - 1 AS pos, l_linenumber,
  {PL.ASSET} AS asset, {PL.JUNK} AS junk, l_partkey, l_quantity AS q, l_extendedprice AS ext, l_tax, l_discount,
  l_returnflag, l_linestatus FROM lineitem"""

_IS_STABLE_Z = "asset IN ('USD', 'USDT', 'USDC', 'FDUSD', 'BUSD', 'TUSD', 'DAI', 'USDe', 'USDD')"
# Per exchange: (valued line rows with asset/total/available/notional/liability/interest/usd/keep,
#                portfolio-level total expression or None for Σ usd, error expression)
SNAP_ROWS = {
    "binance": """SELECT l.*, a.amount AS total, a.amount AS available, round_even(a.amount * a.price, 2) AS notional,
    0.0 AS liability, 0.0 AS interest, a.amount * a.price AS usd, a.amount <> 0 AND a.price IS NOT NULL AS keep
  FROM lines l, LATERAL (SELECT (CASE WHEN l.l_discount = 0 THEN 0 ELSE l.q END) + (CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS amount,
    CASE WHEN l.asset IN ('USDT', 'BUSD', 'USDC') THEN 1.0 ELSE (SELECT TRY_CAST(price AS DOUBLE) FROM prices WHERE symbol = l.asset || 'USDT') END AS price) a
  WHERE l.exchange = 'binance'""",
    "bingx": """SELECT l.*, q AS total, CASE WHEN l_linenumber % 2 = 1 THEN q - 1 ELSE ext END AS available, ext AS notional,
    CASE WHEN l_returnflag = 'A' THEN q ELSE 0.0 END AS liability, 0.0 AS interest, ext AS usd, TRUE AS keep
  FROM lines l WHERE exchange = 'bingx'""",
    "bitmart": """SELECT l.*, CASE WHEN k.last IS NOT NULL THEN q * k.last ELSE q END AS total, q AS available,
    CASE WHEN k.last IS NOT NULL THEN (q + fz) * k.last ELSE q + fz END AS notional, 0.0 AS liability, 0.0 AS interest,
    CASE WHEN k.last IS NOT NULL THEN q * k.last ELSE q END AS usd, TRUE AS keep
  FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END AS fz FROM lines WHERE exchange = 'bitmart') l
  LEFT JOIN (SELECT 'A' || CAST(p_partkey AS STRING) AS cur,
      CASE WHEN p_size > 5 THEN p_retailprice WHEN p_size > 2 THEN p_retailprice + 1 END AS last FROM part) k
    ON l.asset = k.cur""",
    "bitmex": """SELECT l.*, amt AS total, amt AS available, amt AS notional, 0.0 AS liability, 0.0 AS interest,
    CASE WHEN upper(asset) IN ('USDT', 'USD', 'USDC') THEN amt ELSE COALESCE(amt * lp, 0.0) END AS usd, TRUE AS keep
  FROM (SELECT l.*, CASE WHEN upper(asset) IN ('XBT', 'BTC', 'WBTC') THEN CAST(CAST(q AS BIGINT) * 1000000 AS DOUBLE) / 1e8
      ELSE CAST(CAST(q AS BIGINT) * 1000000 AS DOUBLE) / 1e6 END AS amt,
      (SELECT arg_min("lastPrice", pos) FROM instruments i WHERE i.typ = 'IFXXXP' AND upper(i.symbol) = upper(l.asset) || '_USDT') AS lp
    FROM lines l WHERE exchange = 'bitmex') l""",
    "bybit": """SELECT l.*, q AS total, q AS available, ext AS notional, l_tax AS liability,
    CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE l_discount END AS interest, ext AS usd, TRUE AS keep
  FROM lines l WHERE exchange = 'bybit'""",
    "okx": """SELECT l.*, q AS total, CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE q - 1 END AS available, ext AS notional,
    CASE WHEN l_returnflag = 'R' THEN l_tax ELSE 0.0 END AS liability, CASE WHEN l_returnflag = 'A' THEN l_discount ELSE 0.0 END AS interest,
    ext AS usd, TRUE AS keep
  FROM lines l WHERE exchange = 'okx'""",
    "zoomex": f"""SELECT l.*, q AS total, q AS available,
    CASE WHEN l_returnflag NOT IN ('R', 'A') THEN ext WHEN {_IS_STABLE_Z} THEN q ELSE 0.0 END AS notional,
    l_tax AS liability, CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE l_discount END AS interest,
    CASE WHEN l_returnflag NOT IN ('R', 'A') THEN ext WHEN {_IS_STABLE_Z} THEN q ELSE 0.0 END AS usd, TRUE AS keep
  FROM lines l WHERE exchange = 'zoomex'""",
}
_JUNK_FAILS = {"binance", "bingx", "bitmart", "bybit", "okx", "zoomex"}
_ADJ = {
    "bybit": transfer_sql(PL.PAYLOAD_AS_OF, Q.BYBIT_INTERVAL_MIN, "unified"),
    "okx": transfer_sql(PL.PAYLOAD_AS_OF, 0.5, "18/6"),
}
SNAP_LOOKUPS = (
    ("lines", SNAP_LINES),
    ("prices", PL.PRICES_SQL),
    ("instruments", PL.INSTRUMENTS_SQL),
)


def snap_parts() -> list[tuple[str, str]]:
    parts = list(SNAP_LOOKUPS)
    for ex, rows in SNAP_ROWS.items():
        parts.append((f"{ex}_rows", rows))
        bad = "bool_or(junk)" if ex in _JUNK_FAILS else "FALSE"
        parts.append(
            (
                f"{ex}_pf",
                f"""SELECT portfolio, exchange, COALESCE(SUM(usd) FILTER (WHERE keep), 0.0) AS sum_usd,
  SUM(ext) AS sum_ext, CAST(count(DISTINCT asset) FILTER (WHERE keep) AS BIGINT) AS n_assets, {bad} AS bad
FROM {ex}_rows GROUP BY portfolio, exchange""",
            )
        )
        if ex in _ADJ:
            parts.append((f"{ex}_adj", _ADJ[ex]))
            adj = f"COALESCE((SELECT adjustment FROM {ex}_adj a WHERE a.portfolio = f.portfolio), 0.0)"
        else:
            adj = "0.0"
        total = "sum_ext" if ex in ("bybit", "okx") else "sum_usd"
        parts.append(
            (
                f"{ex}_sum",
                f"""SELECT portfolio, exchange, {total} AS total_usd_value, {adj} AS transfer_adjustment,
  {ts(PL.PAYLOAD_AS_OF)} AS {CT}, {tw(ts(PL.PAYLOAD_AS_OF))} AS tw_time, n_assets FROM {ex}_pf f WHERE NOT bad""",
            )
        )
    parts.append(("all_sum", " UNION ALL ".join(f"SELECT * FROM {ex}_sum" for ex in SNAP_ROWS)))
    parts.append(
        (
            "all_bal",
            " UNION ALL ".join(
                f"""SELECT portfolio, asset, total, available, notional, liability, interest FROM {ex}_rows r
  WHERE keep AND portfolio IN (SELECT portfolio FROM {ex}_sum)
  QUALIFY row_number() OVER (PARTITION BY portfolio, asset ORDER BY pos DESC) = 1"""
                for ex in SNAP_ROWS
            ),
        )
    )
    return parts


SNAP_COLS = ["portfolio", "exchange", "total_usd_value", "transfer_adjustment", "current_time", "tw_time", "n_assets"]
_SNAP_ROLES = ("transfers",)
for _ex in SNAP_ROWS:
    ORACLE[f"snapshot_{_ex}"] = with_(*snap_parts(), roles=_SNAP_ROLES) + "\n" + rounded(
        SNAP_COLS, ("total_usd_value", "transfer_adjustment"), f"{_ex}_sum"
    )
ORACLE["snapshot_all"] = with_(*snap_parts(), roles=_SNAP_ROLES) + "\n" + rounded(
    SNAP_COLS, ("total_usd_value", "transfer_adjustment"), "all_sum"
)
_POLL_ADJ = [
    (f"{ex}_adj{k}", transfer_sql(at, minutes, rule, upto))
    for k, (at, upto) in enumerate([(PL.PAYLOAD_AS_OF, PL.PAYLOAD_AS_OF), (PL.PAYLOAD_NEXT, None)])  # the newest poll counts later records, too
    for ex, minutes, rule in [("bybit", Q.BYBIT_INTERVAL_MIN, "unified"), ("okx", 0.5, "18/6")]
]
_POLLS = " UNION ALL ".join(
    f"""SELECT portfolio, exchange, total_usd_value, {ts(at)} AS {CT}, {tw(ts(at))} AS tw_time, n_assets,
  COALESCE(CASE exchange WHEN 'bybit' THEN (SELECT adjustment FROM bybit_adj{k} a WHERE a.portfolio = s.portfolio)
                         WHEN 'okx' THEN (SELECT adjustment FROM okx_adj{k} a WHERE a.portfolio = s.portfolio) END, 0.0) AS transfer_adjustment
  FROM all_sum s"""
    for k, at in enumerate([PL.PAYLOAD_AS_OF, PL.PAYLOAD_NEXT])
)
ORACLE["snapshot_two_fetches"] = with_(*snap_parts(), *_POLL_ADJ, ("polls", _POLLS), roles=_SNAP_ROLES) + "\n" + rounded(
    SNAP_COLS, ("total_usd_value", "transfer_adjustment"), "polls"
)
_BAL = ("total", "available", "notional", "liability", "interest")
ORACLE["snapshot_balances"] = with_(*snap_parts(), roles=_SNAP_ROLES) + "\n" + rounded(
    ["portfolio", "asset", *_BAL], _BAL, "all_bal"
)
ORACLE["snapshot_quarantine"] = with_(("lines", SNAP_LINES)) + """
SELECT portfolio, exchange, CASE WHEN exchange = 'kraken' THEN 'unsupported exchange' ELSE 'unparsable payload' END AS reason
FROM lines GROUP BY portfolio, exchange
HAVING exchange = 'kraken' OR (exchange IN ('binance', 'bingx', 'bitmart', 'bybit', 'okx', 'zoomex') AND bool_or(junk))"""
ORACLE["zoomex_missing_prices"] = with_(("lines", SNAP_LINES)) + f"""
SELECT portfolio, asset AS coin, q AS available FROM lines
WHERE exchange = 'zoomex' AND l_returnflag IN ('R', 'A') AND NOT {_IS_STABLE_Z}"""

# ----------------------------------------------------------------- scalar functions
ORACLE["tw_time"] = with_(roles=("scalar_inputs",)) + f"\nSELECT event_id, ts, {tw('ts')} AS tw_time FROM scalar_inputs"
ORACLE["ts_truncate"] = with_(roles=("scalar_inputs",)) + """
SELECT event_id, date_trunc('second', ts) AS ts_second, date_trunc('millisecond', ts) AS ts_milli FROM scalar_inputs"""
ORACLE["iso_normalise"] = with_(roles=("scalar_inputs",)) + r"""
SELECT event_id, iso, parsed, round(epoch_us(parsed) / 1e6, 6) + 0.0 AS unix FROM (
SELECT event_id, iso, CAST(regexp_extract(iso, '^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)', 1) AS TIMESTAMP)
  - to_minutes(CAST(CASE WHEN off IN ('', 'Z') THEN 0
      ELSE (CAST(substr(dg, 1, 2) AS INT) * 60 + CAST(substr(dg, 3, 2) AS INT)) * CASE WHEN off LIKE '-%' THEN -1 ELSE 1 END END AS BIGINT)) AS parsed
FROM (SELECT *, regexp_extract(iso, '(Z|[+-]\d{2}:?\d{2})$', 1) AS off,
        regexp_replace(regexp_extract(iso, '(Z|[+-]\d{2}:?\d{2})$', 1), '[+:Z-]', '', 'g') AS dg FROM scalar_inputs))"""
ORACLE["epoch_normalise"] = with_(roles=("scalar_inputs",)) + """
SELECT event_id, epoch, t AS parsed,
  strftime(t, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(CAST((epoch_us(t) % 1000000) // 1000 AS BIGINT) AS VARCHAR), 3, '0') || 'Z' AS iso,
  strftime(make_timestamp(CAST(trunc(CASE WHEN epoch >= 1e18 THEN epoch / 1e9 WHEN epoch >= 1e15 THEN epoch / 1e6
      WHEN epoch >= 1e12 THEN epoch / 1e3 ELSE epoch END) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') || '.'
    || CASE WHEN epoch >= 1e18 THEN lpad(CAST(CAST(trunc(fmod(epoch, 1e9)) AS BIGINT) AS VARCHAR), 9, '0')
            WHEN epoch >= 1e15 THEN lpad(CAST(CAST(trunc(fmod(epoch, 1e6)) AS BIGINT) AS VARCHAR), 6, '0')
            WHEN epoch >= 1e12 THEN lpad(CAST(CAST(trunc(fmod(epoch, 1e3)) AS BIGINT) AS VARCHAR), 3, '0')
            ELSE substr(lpad(CAST(CAST(trunc(fmod(epoch, 1) * 1e9) AS BIGINT) AS VARCHAR), 9, '0'), 1, 3) END || 'Z' AS iso_exact
FROM (SELECT *, make_timestamp(CAST(CASE WHEN epoch >= 1e18 THEN floor(epoch / 1000) WHEN epoch >= 1e15 THEN floor(epoch)
    WHEN epoch >= 1e12 THEN floor(epoch * 1000) ELSE floor(epoch * 1000000) END AS BIGINT)) AS t FROM scalar_inputs)"""
ORACLE["strict_bool"] = with_(roles=("scalar_inputs",)) + """
SELECT event_id, word, CASE WHEN lower(trim(word)) IN ('1', 'true', 't', 'yes', 'y', 'on') THEN TRUE
  WHEN lower(trim(word)) IN ('0', 'false', 'f', 'no', 'n', 'off') THEN FALSE END AS flag FROM scalar_inputs"""

# ----------------------------------------------------------------- alerts / telemetry
LOW_VALUE_MESSAGE = f"""'Total_Usd_Value Under ' || CAST(p.position_threshold AS VARCHAR) || chr(10)
  || '\U0001F4BC Portfolio     : ' || {{s}}.portfolio || chr(10)
  || '\U0001F4B0 Current Value : ' || format('{{{{:,.2f}}}}', TRY_CAST({{s}}.total_usd_value AS DOUBLE)) || chr(10)
  || '\U0001F552 Time(UTC)     : ' || strftime({{s}}.{CT}, '%Y-%m-%d %H:%M:%S')"""
ORACLE["low_value_alert"] = with_(
    ("latest", LATEST),
    (
        "al",
        f"""SELECT 'usd_under:' || l.portfolio AS key, l.portfolio, 'CRITICAL' AS severity, CAST(5 AS BIGINT) AS level,
  p.position_threshold AS threshold, TRY_CAST(l.total_usd_value AS DOUBLE) AS total_usd_value, l.{CT},
  {LOW_VALUE_MESSAGE.format(s="l")} AS message
FROM latest l JOIN portfolio p ON l.portfolio = p.portfolio
WHERE p.status = 'active' AND p.position_threshold IS NOT NULL AND p.position_threshold <> 0
  AND TRY_CAST(l.total_usd_value AS DOUBLE) <= p.position_threshold""",
    ),
    roles=("portfolio", "account_summary"),
) + "\n" + rounded(
    ["key", "portfolio", "severity", "level", "threshold", "total_usd_value", "current_time", "message", "text", "hash"],
    ("threshold", "total_usd_value"),
    "(SELECT *, '\U0001F525 ' || message AS text, sha256(message) AS hash FROM al)",
)

JOB_DUR = f"""SELECT job_id, event_id, event, recorded_at, scheduled_at,
  CASE WHEN event IN ('success', 'error') THEN (epoch_us(recorded_at) - epoch_us(st)) / 1e6 * 1000.0 END AS duration_ms,
  CASE WHEN event = 'missed' THEN CASE WHEN scheduled_at IS NULL THEN 'Job missed its scheduled run'
         ELSE 'Job missed run scheduled for ' || strftime(scheduled_at, '%Y-%m-%dT%H:%M:%S') END
       WHEN event = 'error' THEN COALESCE(message, 'Unknown error')
       WHEN event = 'submitted' THEN NULL ELSE message END AS message
FROM (SELECT *, last_value(CASE WHEN event = 'submitted' THEN recorded_at END IGNORE NULLS) OVER (
  PARTITION BY job_id ORDER BY recorded_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st FROM job_events)"""

ORACLE["job_durations"] = with_(("jd", JOB_DUR), roles=("job_events",)) + "\n" + rounded(
    ["job_id", "event_id", "event", "recorded_at", "duration_ms"], ("duration_ms",), "jd WHERE event IN ('success', 'error')"
)
ORACLE["job_history"] = with_(("jd", JOB_DUR), roles=("job_events",)) + "\n" + rounded(
    ["job_id", "rank", "event_id", "event", "recorded_at", "scheduled_at", "duration_ms", "message"],
    ("duration_ms",),
    """(SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY recorded_at DESC, event_id DESC) AS rank FROM jd
  QUALIFY rank <= 50)""",
)
ORACLE["job_stats"] = with_(
    ("jd", JOB_DUR),
    ("cnt", """SELECT job_id, CAST(count(*) FILTER (WHERE event = 'submitted') AS BIGINT) AS total_runs,
  CAST(count(*) FILTER (WHERE event = 'success') AS BIGINT) AS total_success,
  CAST(count(*) FILTER (WHERE event = 'error') AS BIGINT) AS total_error,
  CAST(count(*) FILTER (WHERE event = 'missed') AS BIGINT) AS total_missed,
  max(recorded_at) FILTER (WHERE event = 'submitted') AS last_started_at,
  max(recorded_at) FILTER (WHERE event IN ('success', 'error', 'missed')) AS last_finished_at FROM jd GROUP BY job_id"""),
    ("lst", "SELECT job_id, event AS last_event FROM jd QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY recorded_at DESC, event_id DESC) = 1"),
    ("lsub", """SELECT job_id, scheduled_at AS last_scheduled_at FROM jd WHERE event = 'submitted'
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY recorded_at DESC, event_id DESC) = 1"""),
    ("lterm", """SELECT job_id, duration_ms AS last_duration_ms, CASE WHEN event <> 'success' THEN message END AS last_error FROM jd
  WHERE event IN ('success', 'error', 'missed')
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY recorded_at DESC, event_id DESC) = 1"""),
    roles=("job_events",),
) + "\n" + rounded(
    ["job_id", "total_runs", "total_success", "total_error", "total_missed", "last_event", "last_scheduled_at",
     "last_started_at", "last_finished_at", "last_duration_ms", "last_error"],
    ("last_duration_ms",),
    "cnt LEFT JOIN lst USING (job_id) LEFT JOIN lsub USING (job_id) LEFT JOIN lterm USING (job_id)",
)

# ----------------------------------------------------------------- alert cooldown (recursive, sequential per key)
_CD = Q.COOLDOWN_SEC
ORACLE["alert_cooldown"] = cte("portfolio", "account_summary").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
al AS (SELECT 'usd_under:' || s.portfolio AS key, s.id, (epoch_us(s.{CT}) // 1000) / 1000.0 AS t,
    sha256('Total_Usd_Value Under ' || CAST(p.position_threshold AS VARCHAR) || ' band '
           || CAST(CAST(floor(s.total_usd_value / 100000) AS BIGINT) AS VARCHAR)) AS h
  FROM account_summary s JOIN portfolio p ON s.portfolio = p.portfolio
  WHERE p.status = 'active' AND p.position_threshold IS NOT NULL AND p.position_threshold <> 0
    AND s.total_usd_value <= p.position_threshold),
ev AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t, id) AS rn FROM al),
r AS (
  SELECT key, id, rn, t AS last_t, h AS last_h, TRUE AS emitted FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.key, e.id, e.rn,
    CASE WHEN e.t - r.last_t >= {_CD} OR e.h <> r.last_h THEN e.t ELSE r.last_t END,
    CASE WHEN e.t - r.last_t >= {_CD} OR e.h <> r.last_h THEN e.h ELSE r.last_h END,
    e.t - r.last_t >= {_CD} OR e.h <> r.last_h
  FROM r JOIN ev e ON e.key = r.key AND e.rn = r.rn + 1)
SELECT r.key, r.id, ev.h AS hash, r.emitted FROM r JOIN ev ON r.key = ev.key AND r.id = ev.id"""


# ----------------------------------------------------------------- streams (same results as the batch queries)
ORACLE["stream_snapshot"] = ORACLE["snapshot_all"]
ORACLE["stream_snapshot_backlog"] = ORACLE["snapshot_two_fetches"]
ORACLE["stream_alert"] = ORACLE["alert_cooldown"]
ORACLE["stream_job_stats"] = ORACLE["job_stats"]
ORACLE["stream_job_history"] = ORACLE["job_history"]
# L1 over all summaries, then the cooldown without dedupe
ORACLE["stream_low_value_alert"] = cte("portfolio", "account_summary").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
al AS (SELECT 'usd_under:' || s.portfolio AS key, s.id, (epoch_us(s.{CT}) // 1000) / 1000.0 AS t, sha256({LOW_VALUE_MESSAGE.format(s="s")}) AS h
  FROM account_summary s JOIN portfolio p ON s.portfolio = p.portfolio
  WHERE p.status = 'active' AND p.position_threshold IS NOT NULL AND p.position_threshold <> 0
    AND TRY_CAST(s.total_usd_value AS DOUBLE) <= p.position_threshold),
ev AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t, id) AS rn FROM al),
r AS (
  SELECT key, id, rn, t AS last_t, TRUE AS emitted FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.key, e.id, e.rn, CASE WHEN e.t - r.last_t >= {_CD} THEN e.t ELSE r.last_t END, e.t - r.last_t >= {_CD}
  FROM r JOIN ev e ON e.key = r.key AND e.rn = r.rn + 1)
SELECT r.key, r.id, ev.h AS hash, r.emitted FROM r JOIN ev ON r.key = ev.key AND r.id = ev.id"""


# the years of the given tables; SQL needs them spelled out, the query takes them from the data
YEARS = list(range(1995, 2002))


def _stream_mart_parts(mart_parts=master_mart_parts, years=YEARS) -> list[tuple[str, str]]:
    """A mart run per year in the order of arrival; a year that comes after a later
    one is a run one second after the last."""
    parts: list[tuple[str, str]] = []
    prev, newest, late = None, None, 0
    for k, y in enumerate(years):
        newest, late = (y, 0) if newest is None or y > newest else (newest, late + 1)
        as_of = f"(SELECT max({CT}) + INTERVAL {late} SECOND FROM account_summary WHERE year({CT}) = {newest})"
        seen = ", ".join(map(str, years[: k + 1]))
        parts += mart_parts(f"y{y}_", f"WHERE year({CT}) IN ({seen})", as_of, prev)
        union = f"SELECT * FROM y{y}_sout" if prev is None else f"SELECT * FROM {prev} UNION ALL SELECT * FROM y{y}_sout"
        parts.append((f"mart{y}", union))
        prev = f"mart{y}"
    return parts


ORACLE["stream_mart_late"] = with_(
    *_stream_mart_parts(years=[*YEARS[:2], YEARS[3], YEARS[2], *YEARS[4:]]), roles=("portfolio", "account_summary")
) + "\n" + rounded(perf_cols("master_portfolio"), PERF_COLS, "mart2001")
ORACLE["stream_mart"] = with_(*_stream_mart_parts(), roles=("portfolio", "account_summary")) + "\n" + rounded(
    perf_cols("master_portfolio"), PERF_COLS, "mart2001"
)
ORACLE["stream_portfolio_mart"] = with_(*_stream_mart_parts(portfolio_mart_parts), roles=("portfolio", "account_summary")) + "\n" + rounded(
    perf_cols("portfolio"), PERF_COLS, "mart2001"
)
