"""String expressions: route keys, bins, labels."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from velocube.functions._util import col

# Fixed values that must equal the reference's output format.
ROUTE_SEP = " → "          # route key separator, canonical report
ROUTE_SEP_STRICT = " to "  # route key separator, dashboard variant
LABEL_MAX = 40             # labels longer than this are shortened ...
LABEL_KEEP = 37            # ... to this many characters plus "..."


def route(a, b, sep: str = ROUTE_SEP) -> Column:
    """Route key where a missing end becomes ''."""
    return F.concat(F.coalesce(col(a), F.lit("")), F.lit(sep), F.coalesce(col(b), F.lit("")))


def route_strict(a, b, sep: str = ROUTE_SEP_STRICT) -> Column:
    """Route key that is NULL when either end is NULL."""
    return F.concat(col(a), F.lit(sep), col(b))


def duration_bin(x, width: int = 5, cap: int = 60) -> Column:
    """floor(x / width) * width, capped at ``cap``; INT."""
    return F.least(F.floor(col(x) / width) * width, F.lit(cap)).cast("int")


def bin_label(b, width: int = 5) -> Column:
    """'lo-hi' label of a bin start (the capped bin keeps its nominal label)."""
    b = col(b)
    return F.concat(b.cast("string"), F.lit("-"), (b + width).cast("string"))


def short_label(s, max_len: int = LABEL_MAX, keep: int = LABEL_KEEP) -> Column:
    s = col(s)
    return F.when(F.length(s) > max_len, F.concat(F.substring(s, 1, keep), F.lit("..."))).otherwise(s)


def month_from_path(path) -> Column:
    """'yyyyMM' taken from a file name such as '202401-tripdata.csv'."""
    return F.regexp_extract(col(path), r"(\d{6})[^/]*$", 1)
