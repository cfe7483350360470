"""Scalar column expressions (all JVM-side built-ins, no Python UDFs).

Every helper takes and returns ``Column`` so it composes inside whole-stage
codegen. ANSI mode is on by default in Spark 4, so casts use ``try_cast`` and
divisions are guarded.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
TW_OFFSET_HOURS = 8  # display zone UTC+8
TW_FORMAT = "yyyy-MM-dd HH:mm:ss"
TRUE_WORDS = ["1", "true", "t", "yes", "y", "on"]
FALSE_WORDS = ["0", "false", "f", "no", "n", "off"]
SEVERITY_ORDINAL = {"TRACE": 0, "DEBUG": 1, "INFO": 2, "WARNING": 3, "ERROR": 4, "CRITICAL": 5}
SEVERITY_PREFIX = {
    "CRITICAL": "\U0001F525",
    "ERROR": "❌",
    "WARNING": "⚠️",
    "INFO": "ℹ️",
    "DEBUG": "\U0001F41E",
    "TRACE": "\U0001F50D",
}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: str | _dt.datetime | Column) -> Column:
    """A naive-UTC timestamp literal (TIMESTAMP_NTZ)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


# F1 -------------------------------------------------------------------------
def tw_time(ts: str | Column) -> Column:
    """UTC+8 display string ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(col_of(ts) + F.expr(f"INTERVAL {TW_OFFSET_HOURS} HOURS"), TW_FORMAT)


# F2 -------------------------------------------------------------------------
def truncate_second(ts: str | Column) -> Column:
    return F.date_trunc("second", col_of(ts)).cast("timestamp_ntz")


def truncate_milli(ts: str | Column) -> Column:
    return F.date_trunc("millisecond", col_of(ts)).cast("timestamp_ntz")


# F3 -------------------------------------------------------------------------
_ISO_LOCAL = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)"
_ISO_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def iso_to_timestamp(c: str | Column) -> Column:
    """ISO-8601 string -> naive UTC timestamp, independent of the session zone.

    The local part is parsed as TIMESTAMP_NTZ and a trailing ``Z`` /
    ``+hh:mm`` / ``-hhmm`` offset is subtracted; a string without offset is
    taken as UTC. NULL passes through; an unparsable string raises (ANSI cast),
    as the reference raises ``ValueError``.
    """
    s = F.trim(col_of(c))
    local = F.regexp_extract(s, _ISO_LOCAL, 1)
    off = F.regexp_extract(s, _ISO_OFFSET, 1)
    digits = F.regexp_replace(off, "[+:Z-]", "")
    minutes = F.when((off == "") | (off == "Z"), F.lit(0)).otherwise(
        (F.substring(digits, 1, 2).cast("int") * 60 + F.substring(digits, 3, 2).cast("int"))
        * F.when(F.substring(off, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    )
    parsed = F.when(local == "", s).otherwise(local).cast("timestamp_ntz")
    return F.when(s.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(
        parsed - F.make_dt_interval(mins=minutes)
    )


# F4 -------------------------------------------------------------------------
def epoch_to_timestamp(c: str | Column) -> Column:
    """Unix number whose magnitude picks the unit (ns >= 1e18, us >= 1e15,
    ms >= 1e12, else seconds) -> naive UTC timestamp (microsecond precision)."""
    x = col_of(c).cast("double")
    micros = (
        F.when(x >= 1e18, F.floor(x / 1000))
        .when(x >= 1e15, F.floor(x))
        .when(x >= 1e12, F.floor(x * 1000))
        .otherwise(F.floor(x * 1_000_000))
    )
    return F.timestamp_add("MICROSECOND", micros.cast("long"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def unix_to_iso(c: str | Column) -> Column:
    """Unix number -> ``yyyy-MM-ddTHH:mm:ss.<fraction>Z``: nanoseconds keep 9
    fraction digits, microseconds 6, milliseconds 3, seconds the first 3 of
    the nanosecond fraction. Whole seconds are truncated (``int``); the wall
    clock is UTC (the reference used the host's local zone)."""
    x = col_of(c).cast("double")

    def lp(v: Column, n: int) -> Column:
        return F.lpad(v.cast("long").cast("string"), n, "0")

    secs = (
        F.when(x >= 1e18, x / 1e9).when(x >= 1e15, x / 1e6).when(x >= 1e12, x / 1e3).otherwise(x)
    ).cast("long")
    frac = (
        F.when(x >= 1e18, lp(x % 1e9, 9))
        .when(x >= 1e15, lp(x % 1e6, 6))
        .when(x >= 1e12, lp(x % 1e3, 3))
        .otherwise(F.substring(lp((x % 1) * 1e9, 9), 1, 3))
    )
    wall = F.timestamp_add("SECOND", secs, F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), frac, F.lit("Z"))


def iso_to_unix(c: str | Column) -> Column:
    """ISO-8601 string -> Unix seconds as a double (offsets honoured)."""
    t = iso_to_timestamp(c)
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), t) / 1e6


def timestamp_to_iso(ts: str | Column) -> Column:
    """Naive UTC timestamp -> ``yyyy-MM-ddTHH:mm:ss.SSSZ``."""
    return F.date_format(col_of(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


# F5 -------------------------------------------------------------------------
def strict_bool(c: str | Column, on_error: str = "raise") -> Column:
    """Strict string -> boolean. Unknown words raise (``on_error='raise'``)
    or become NULL (``on_error='null'``)."""
    s = F.lower(F.trim(col_of(c).cast("string")))
    bad = (
        F.raise_error(F.concat(F.lit("Cannot strictly parse bool from: "), F.coalesce(s, F.lit("NULL"))))
        if on_error == "raise"
        else F.lit(None)
    )
    return (
        F.when(s.isin(TRUE_WORDS), F.lit(True))
        .when(s.isin(FALSE_WORDS), F.lit(False))
        .otherwise(bad.cast("boolean"))
    )


# F6 / P2 --------------------------------------------------------------------
def to_number(c: str | Column) -> Column:
    """``to_numeric(errors='coerce')``: anything unparsable -> NULL."""
    return col_of(c).try_cast("double")


# P3 -------------------------------------------------------------------------
def round_half_even(c: str | Column, places: int = 10) -> Column:
    return F.bround(col_of(c), places)


# P5 -------------------------------------------------------------------------
def present(c: str | Column) -> Column:
    c = col_of(c)
    return c.isNotNull() & (c != "")


# P7 -------------------------------------------------------------------------
def safe_div(n: Column, d: Column, otherwise: float | None = 0.0) -> Column:
    return F.when(d != 0, n / d).otherwise(F.lit(otherwise).cast("double"))


# F9 -------------------------------------------------------------------------
def thousands(c: str | Column, places: int = 2) -> Column:
    return F.format_number(col_of(c), places)


# F10 ------------------------------------------------------------------------
def message_hash(c: str | Column) -> Column:
    return F.sha2(col_of(c), 256)


# F11 ------------------------------------------------------------------------
def severity_ordinal(c: str | Column) -> Column:
    m = F.create_map(*[x for k, v in SEVERITY_ORDINAL.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, F.upper(col_of(c)))


def severity_prefix(c: str | Column) -> Column:
    m = F.create_map(*[x for k, v in SEVERITY_PREFIX.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, F.upper(col_of(c))), F.lit(""))
