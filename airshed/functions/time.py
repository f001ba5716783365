"""Date and time expressions.

Inputs may be text (schema-less CSV) or timestamps (inferred schema);
``substr`` on a timestamp renders it as ``yyyy-MM-dd HH:mm:ss`` first, so
the text offsets work for both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions._util import col



def epoch_ntz() -> Column:
    """1970-01-01 00:00:00 as TIMESTAMP_NTZ (time-zone free epoch)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_micros(c) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), col(c))


def day_text(c) -> Column:
    """``substr(s, 1, 10)``: the ``yyyy-MM-dd`` part of a time text."""
    return F.substring(col(c).cast("string"), 1, 10)


def time_text(c) -> Column:
    """``substr(s, 12, 8)``: the ``HH:mm:ss`` part of a time text."""
    return F.substring(col(c).cast("string"), 12, 8)


def day_of(c, fmt: str | None = None, strict: bool = False) -> Column:
    """Text -> date.

    ``strict`` mirrors SQL ``date(varchar)``: malformed text raises (ANSI).
    Otherwise malformed text becomes NULL, which is what a data-quality
    count of NULL dates expects.
    """
    c = col(c)
    if strict:
        return F.to_date(c, fmt) if fmt else c.cast("date")
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def ts_of(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text -> timestamp, NULL on malformed text."""
    return F.try_to_timestamp(col(c), F.lit(fmt))


def iso_text(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Time text -> ISO-8601 ``yyyy-MM-dd'T'HH:mm:ss``."""
    return F.date_format(ts_of(c, fmt), "yyyy-MM-dd'T'HH:mm:ss")


def date_text(c) -> Column:
    """Date -> ``yyyy-MM-dd`` text."""
    return F.date_format(col(c), "yyyy-MM-dd")


def valid_date(c, strict: bool = True) -> Column:
    """Validate and normalise a date text (``2024-1-5`` -> ``2024-01-05``).

    Non-strict mode returns NULL for invalid text; strict mode raises inside
    the plan (callers that must fail before writing check eagerly).
    """
    d = F.try_to_date(col(c), "yyyy-M-d")
    out = F.date_format(d, "yyyy-MM-dd")
    if not strict:
        return out
    return F.when(col(c).isNull(), F.lit(None).cast("string")).when(d.isNull(), F.raise_error(
        F.concat(F.lit("not a calendar date (year-month-day): "), col(c)))).otherwise(out)


def nano_date(c, tz: str = "UTC") -> Column:
    """Epoch nanoseconds -> local calendar date in ``tz``.

    Built on TIMESTAMP_NTZ arithmetic so the answer does not depend on the
    session time zone.
    """
    # decimal division is exact; a double would lose the last digits of 19
    micros = F.floor(col(c).cast("decimal(20,0)") / F.lit(1000).cast("decimal(4,0)")).cast("long")
    utc_wall = F.timestamp_add("MICROSECOND", micros, epoch_ntz())
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall) if tz != "UTC" else utc_wall
    return local.cast("date")


def utc_text(ts) -> Column:
    """An instant (TIMESTAMP) as UTC ISO text, independent of the session zone."""
    wall = F.timestamp_add("MICROSECOND", F.unix_micros(col(ts)), epoch_ntz())
    return F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def event_time_or(c, default: Column | None = None) -> Column:
    """Event time, or a default (UTC now) when it is missing or empty text."""
    if default is None:
        default = utc_text(F.current_timestamp())
    return F.coalesce(F.nullif(col(c), F.lit("")), default)
