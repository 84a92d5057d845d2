"""Cleaning filters and predicates."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from velocube.functions import duration_min, hour_of_day

# The open interval of plausible trip durations, in minutes.
MIN_DURATION = 1
MAX_DURATION = 240


def with_duration(trips: DataFrame, start: str = "started_at", end: str = "ended_at",
                  name: str = "duration_min") -> DataFrame:
    return trips.withColumn(name, duration_min(start, end))


def clean_trips(trips: DataFrame, lo: float = MIN_DURATION, hi: float = MAX_DURATION) -> DataFrame:
    """Keep trips with lo < duration < hi minutes and a start time; adds
    ``duration_min`` and ``hour``.  NULL durations are dropped."""
    d = F.col("duration_min")
    return (with_duration(trips)
            .filter((d > lo) & (d < hi) & F.col("started_at").isNotNull())
            .withColumn("hour", hour_of_day("started_at")))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def in_top(df: DataFrame, top: DataFrame, key: str, top_key: str | None = None) -> DataFrame:
    """Rows whose ``key`` is in a top-k key set.  ``top`` is a top-k result
    (k rows, bounded by construction), so it is broadcast."""
    t = top.select(F.col(top_key or key).alias(key)).distinct()
    return df.join(F.broadcast(t), key, "left_semi")


def nonzero_coords(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Drop points with NULL/zero/NaN coordinates."""
    ok = lambda c: F.col(c).isNotNull() & (F.col(c) != 0) & ~F.isnan(F.col(c))
    return df.filter(ok(lat) & ok(lng))
