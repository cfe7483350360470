"""Alerts: low-value detection (L1) and cooldown / dedupe suppression (L2).

L1 is a filter + projection. L2 is a per-key recurrence (the state is the
last *emitted* time and message hash), computed exactly and in parallel by
``cooldown`` in ``tidemark.operators.cooldown``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import message_hash, severity_ordinal, severity_prefix, thousands

ALERT_KEY_PREFIX = "usd_under:"  # fixed
DEFAULT_COOLDOWN_SEC = 60  # fixed


def _py_float_str(c):
    """``str(float)`` for the threshold in the message: an integral value keeps
    ``.0``, and no exponent is used below 1e16 (Spark's cast writes one from 1e7 on)."""
    whole = (c == F.floor(c)) & (F.abs(c) < 1e16)
    plain = F.concat(F.format_string("%d", F.when(whole, c).cast("long")), F.lit(".0"))
    digits = F.regexp_replace(c.cast("decimal(38,18)").cast("string"), r"0+$", "")
    return F.when(whole, plain).when((F.abs(c) >= 1e7) & (F.abs(c) < 1e16), digits).otherwise(c.cast("string"))


def low_value_alerts(summaries: DataFrame, portfolios: DataFrame, severity: str = "CRITICAL", keep: tuple[str, ...] = ()) -> DataFrame:
    """L1: ``threshold`` set and non-zero, and ``total <= threshold``.

    Output: key, portfolio, severity, level, threshold, total_usd_value,
    current_time, message, text (prefixed), hash (SHA-256 of the message), and the
    columns of ``summaries`` named in ``keep``.
    The dimension side is joined on ``portfolio`` (one row per portfolio).
    """
    th = F.col("position_threshold")
    total = F.col("total_usd_value").try_cast("double")
    j = summaries.join(portfolios.select("portfolio", "position_threshold"), "portfolio", "inner")
    j = j.filter(th.isNotNull() & (th != 0) & ~F.isnan(th) & (total <= th))
    message = F.concat_ws(
        "\n",
        F.concat(F.lit("Total_Usd_Value Under "), _py_float_str(th)),
        F.concat(F.lit("\U0001F4BC Portfolio     : "), F.col("portfolio")),
        F.concat(F.lit("\U0001F4B0 Current Value : "), thousands(total, 2)),
        F.concat(F.lit("\U0001F552 Time(UTC)     : "), F.date_format("current_time", "yyyy-MM-dd HH:mm:ss")),
    )
    sev = F.lit(severity)
    prefix = severity_prefix(sev)
    return j.select(
        F.concat(F.lit(ALERT_KEY_PREFIX), F.col("portfolio")).alias("key"),
        "portfolio",
        sev.alias("severity"),
        severity_ordinal(sev).cast("long").alias("level"),
        th.alias("threshold"),
        total.alias("total_usd_value"),
        "current_time",
        message.alias("message"),
        F.when(prefix == "", message).otherwise(F.concat(prefix, F.lit(" "), message)).alias("text"),
        message_hash(message).alias("hash"),
        *keep,
    )
