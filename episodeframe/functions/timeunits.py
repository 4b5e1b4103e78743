"""Timestamp helpers (P13, P14).  The engine's time key is ``ts_ns BIGINT``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_us(ts: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column,
    independent of the session time zone for NTZ values."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def epoch_ns(ts: str | Column) -> Column:
    return epoch_us(ts) * F.lit(1000)


def normalize_to_ns(raw: str | Column) -> Column:
    """Guess the unit of a raw stamp and return int ns.

    abs >= 1e17 -> ns, >= 1e14 -> us, >= 1e11 -> ms, else seconds.  The value
    goes through double (as the reference does) and truncates toward zero;
    unparseable input, and a value outside the BIGINT nanosecond range, give
    null."""
    c = F.col(raw) if isinstance(raw, str) else raw
    x = c.cast("string").try_cast("double")
    a = F.abs(x)
    scaled = (F.when(a >= 1e17, x)
              .when(a >= 1e14, x * 1e3)
              .when(a >= 1e11, x * 1e6)
              .otherwise(x * 1e9))
    ok = x.isNotNull() & ~F.isnan(x) & (a != F.lit(float("inf")))
    # a stamp whose nanoseconds fall outside BIGINT is null, not clamped
    # (2^63 itself passes the JVM's own range check, hence the explicit bounds)
    in_range = (scaled < F.lit(float(2 ** 63))) & (scaled >= F.lit(-float(2 ** 63)))
    return F.when(ok & in_range, scaled.cast("long"))


def header_stamp(sec: str | Column, nanosec: str | Column, arrival: str | Column) -> Column:
    """``sec + nanosec / 1e9`` (float seconds), else the arrival time."""
    s = F.col(sec) if isinstance(sec, str) else sec
    n = F.col(nanosec) if isinstance(nanosec, str) else nanosec
    a = F.col(arrival) if isinstance(arrival, str) else arrival
    return F.coalesce(s.cast("double") + n.cast("double") / F.lit(1e9), a.cast("double"))


def header_stamp_ns(sec: str | Column, nanosec: str | Column) -> Column:
    """P14, exact: ``sec * 1e9 + nanosec`` as BIGINT."""
    s = F.col(sec) if isinstance(sec, str) else sec
    n = F.col(nanosec) if isinstance(nanosec, str) else nanosec
    return s.cast("long") * F.lit(1_000_000_000) + n.cast("long")


def floor_div(a, b) -> Column:
    """Exact floor division of BIGINTs (``a / b`` would go through double
    and can be off by one for nanosecond values)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else (b if isinstance(b, Column) else F.lit(b))
    return F.call_function("div", a - F.pmod(a, b), b)


def ceil_div(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else (b if isinstance(b, Column) else F.lit(b))
    return -floor_div(-a, b)
