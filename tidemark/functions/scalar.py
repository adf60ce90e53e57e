"""Scalar helpers.

Timestamps in this library are ``TIMESTAMP_NTZ`` (wall-clock, no zone): the
supplied tables load that way and it keeps every result independent of the
session zone. Helpers that need epoch arithmetic measure the distance from the
NTZ epoch literal, which is exact and zone-free.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FAR_FUTURE_NTZ = "timestamp_ntz'9999-12-31 00:00:00'"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c: Column | str) -> Column:
    """Cast to ``TIMESTAMP_NTZ`` (no-op for NTZ input)."""
    return _c(c).cast("timestamp_ntz")


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp, as BIGINT.

    Built from the wall-clock fields (day number, hour, minute, seconds with
    fraction), which NTZ values carry without any zone: ``timestampdiff`` and
    casts to a zoned timestamp would both shift by the session zone's
    daylight-saving offset.
    """
    t = to_ntz(c)
    day_us = F.unix_date(F.to_date(t)).cast("bigint") * 86_400_000_000
    clock_us = (F.hour(t).cast("bigint") * 3_600_000_000 + F.minute(t).cast("bigint") * 60_000_000
                + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint"))
    return day_us + clock_us


def epoch_ms(c: Column | str) -> Column:
    """Epoch milliseconds, truncated (not rounded) like ``ts_ms`` of a change event."""
    us = epoch_micros(c)
    return ((us - F.pmod(us, F.lit(1000))) / 1000).cast("bigint")


def boundary_seconds(start: Column | str, end: Column | str) -> Column:
    """Number of whole-second boundaries crossed from ``start`` to ``end``.

    This is the warehouse ``datediff('second', a, b)``: 00.9 s to 01.1 s is 1.
    ``timestampdiff(SECOND, ...)`` would give 0 there, so it is not used.
    """
    def floor_sec(c):
        us = epoch_micros(c)
        return ((us - F.pmod(us, F.lit(1_000_000))) / 1_000_000).cast("bigint")
    return floor_sec(end) - floor_sec(start)


def trunc_ntz(grain: str, c: Column | str) -> Column:
    """``date_trunc(grain, ts)`` kept as ``TIMESTAMP_NTZ``.

    Spark's ``date_trunc`` returns a zoned TIMESTAMP even for NTZ input; going
    through a DATE (``to_date`` / ``trunc``) is zone-free for day and coarser.
    """
    grain = grain.lower()
    day = F.to_date(to_ntz(c))
    if grain == "day":
        d = day
    elif grain in ("week", "month", "quarter", "year"):
        d = F.trunc(day, grain)
    elif grain in ("hour", "minute", "second"):
        return F.date_trunc(grain, to_ntz(c)).cast("timestamp_ntz")
    else:
        raise ValueError(f"unknown grain {grain!r}")
    return d.cast("timestamp_ntz")


def clean_email(c: Column | str) -> Column:
    return F.lower(F.trim(_c(c)))


def nullif_blank(c: Column | str) -> Column:
    return F.nullif(F.trim(_c(c)), F.lit(""))


def far_future() -> Column:
    """Open end of a validity interval (``coalesce(valid_to, '9999-12-31')``)."""
    return F.expr(_FAR_FUTURE_NTZ)
