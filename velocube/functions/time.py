"""Date/time expressions.

Timestamps stay TIMESTAMP_NTZ (wall clock) unless a function says otherwise.
The session time zone is expected to be UTC (``session.get_spark`` sets it).
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from velocube.functions._util import col

EASTERN = "America/New_York"


def parse_ts(c, strict: bool = False) -> Column:
    """Text -> TIMESTAMP_NTZ.  Lenient mode turns unparsable text into NULL."""
    c = col(c)
    if strict:
        return F.to_timestamp_ntz(c)
    return c.cast("string").try_cast("timestamp_ntz")  # never through the session zone


def duration_min(start, end) -> Column:
    """Minutes between two timestamps, exact to the microsecond."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(60000000.0)


def trunc_ntz(ts, unit: str = "hour") -> Column:
    """Floor a wall-clock timestamp to 'hour', 'day' or 'month' as
    TIMESTAMP_NTZ, built from its fields so the session time zone (and its
    DST gaps) never enters."""
    t = col(ts)
    zero = F.lit(0)
    day = F.lit(1) if unit == "month" else F.dayofmonth(t)
    hour = F.hour(t) if unit == "hour" else zero
    return F.make_timestamp_ntz(F.year(t), F.month(t), day, hour, zero, zero)


def hour_bucket(ts) -> Column:
    """Floor to the hour, result TIMESTAMP_NTZ."""
    return trunc_ntz(ts, "hour")


def hour_of_day(ts) -> Column:
    return F.hour(col(ts))


def day_of_week(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col(ts))


def is_weekend(ts) -> Column:
    return F.weekday(col(ts)).isin(5, 6).cast("int")


def month_of_year(ts) -> Column:
    return F.month(col(ts))


def day_name(ts) -> Column:
    return F.date_format(col(ts), "EEEE")


def as_utc(ts) -> Column:
    """Attach UTC to a wall-clock value (NTZ -> TIMESTAMP)."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), col(ts).cast("timestamp_ntz"))
    return local.cast("timestamp")


def as_naive(ts) -> Column:
    """TIMESTAMP instant -> its UTC wall clock as TIMESTAMP_NTZ (whatever the
    session zone)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col(ts).cast("timestamp_ntz"))


def to_eastern(ts, source_tz: str = "UTC") -> Column:
    """UTC wall clock -> US/Eastern wall clock (DST aware), NTZ result."""
    return F.convert_timezone(F.lit(source_tz), F.lit(EASTERN), col(ts).cast("timestamp_ntz"))


def resolve_epoch(n) -> Column:
    """Epoch number -> TIMESTAMP: values above 1e15 are microseconds, else ms.

    Microseconds are truncated to whole milliseconds first, as a JS Date would.
    """
    n = col(n).cast("long")
    return F.when(n > F.lit(10 ** 15), F.timestamp_millis(F.floor(n / 1000)))\
        .otherwise(F.timestamp_millis(n))


def time_label(ts, fmt: str) -> Column:
    """Formatted label; common formats: 'hh:mm a', 'hh a', ISO-Z, 'yyyyMMdd_HHmm'."""
    presets = {
        "12h": "hh:mm a",
        "hour": "hh a",
        "iso_z": "yyyy-MM-dd'T'HH:mm:ss'Z'",
        "stamp": "yyyyMMdd_HHmm",
    }
    return F.date_format(col(ts), presets.get(fmt, fmt))
