"""Time-series features: lags, calendar, feature table, split, last state."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from velocube import schemas
from velocube.functions import day_of_week, hour_of_day, is_weekend, month_of_year
from velocube.operators import aggregates as A
from velocube.operators.ordering import lags_distributed, prefix_sums


def calendar_features(df: DataFrame, ts: str = "start_hour") -> DataFrame:
    return (df.withColumn("hour", hour_of_day(ts))
              .withColumn("day_of_week", day_of_week(ts))
              .withColumn("is_weekend", is_weekend(ts))
              .withColumn("month", month_of_year(ts)))


def add_lags(df: DataFrame, by: Sequence[str] | None, order: str, y: str,
             n: int = schemas.N_LAGS) -> DataFrame:
    """``lag_k`` = value ``k`` present rows earlier (absent hours are not
    filled).  Per-key series use one window spec (a single Window node); its
    partitions hold one key's series, which for hourly tables is bounded by
    the number of hours in the history.  ``by=None`` (one combined series)
    uses the blocked, halo-copied variant so no task holds the whole series."""
    if not by:
        return lags_distributed(df, y, [order], n)
    w = Window.partitionBy(*by).orderBy(order)
    return df.select("*", *[F.lag(y, k).over(w).alias(f"lag_{k}") for k in range(1, n + 1)])


def station_hourly(counts: DataFrame, top: DataFrame) -> DataFrame:
    """Hourly totals of the top stations, with their rank.  ``counts`` is
    ``station_hour_counts``; ``top`` the k-row top-station table (broadcast:
    bounded by k)."""
    ranked = F.broadcast(top.select("station_id", "station_rank"))
    # the 'complete' rule is applied inside the sum (not as a filter) so the
    # counts subtree stays identical to the popularity branch and its
    # exchange is reused: the trips are scanned and shuffled once.
    total = F.sum(F.when(F.col("complete"), F.col("count")))
    return (counts.join(ranked, "station_id", "inner")
            .groupBy("start_hour", "station_id", "station_rank")
            .agg(total.alias("total_trips"))
            .filter(F.col("total_trips").isNotNull()))


def build_features(trips: DataFrame, k: int = 3, n: int = schemas.N_LAGS,
                   counts: DataFrame | None = None) -> DataFrame:
    """Trips -> the model feature table (key start_hour, station_id).

    Plan: one aggregation of the trips to (hour, station, complete) counts;
    station popularity and the hourly series both come from that small table;
    top-k stations are broadcast (k rows); lags are one Window node per
    station; rows with any NULL (the first ``n`` hours of a station) dropped.
    """
    counts = counts if counts is not None else A.station_hour_counts(trips)
    popularity = counts.groupBy("station_id").agg(F.sum("count").alias("trips"))
    top = A.top_stations(popularity, k)
    series = station_hourly(counts, top)
    lagged = add_lags(series, ["station_id"], "start_hour", "total_trips", n)
    feats = calendar_features(lagged).dropna(how="any")
    return feats.select("start_hour", "station_id", "total_trips", "station_rank",
                        *[f"lag_{i}" for i in range(1, n + 1)], *schemas.CALENDAR_COLS)


def latest_state(features: DataFrame, key: str = "station_id", ts: str = "start_hour") -> DataFrame:
    """Last feature row per station.

    The table's key is (station, hour), so each column's value at the last hour is of one row; columns of
    fixed width stay in a hash aggregate.
    """
    cols = [c for c in features.columns if c != key]
    fixed = (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)
    if all(isinstance(features.schema[c].dataType, fixed) for c in cols):
        last = features.groupBy(key).agg(*[(F.max(c) if c == ts else F.max_by(c, ts)).alias(c) for c in cols])
        return last.select(*features.columns)
    last = features.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("_s"))
    return last.select(key, "_s.*").select(*features.columns)


def chrono_split(df: DataFrame, order: Sequence[str] = ("start_hour", "station_rank"),
                 frac: float = 0.8, col: str = "split") -> DataFrame:
    """Positional split: after sorting by ``order`` the first int(n*frac)
    rows are 'train', the rest 'test'.

    Counts per key of ``order`` and their running sums give the key of the last row in 'train'; rows are labelled by
    comparing with it, so the table is read twice (counts, labels) and neither shuffled as a whole nor sorted.  Rows that tie
    with that row in all of ``order`` stay with it.
    """
    keys = list(order)
    sums = prefix_sums(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, ["_n"])
    n = sums.agg(F.max("_n_cum")).first()[0] or 0
    cut = math.floor(n * frac)
    if cut == 0:
        return df.withColumn(col, F.lit("test"))
    last = sums.filter(F.col("_n_cum") >= cut).orderBy("_n_cum").select(*keys).first()
    edge = F.struct(*[F.lit(last[c]).cast(df.schema[c].dataType).alias(c) for c in keys])
    return df.withColumn(col, F.when(F.struct(*keys) <= edge, "train").otherwise("test"))


def data_lag(features: DataFrame, as_of, key: str = "station_id", ts: str = "start_hour") -> DataFrame:
    """Latest hour per station and whole hours from it to ``as_of``
    (truncated toward zero)."""
    as_of = F.lit(as_of).cast("timestamp_ntz") if not hasattr(as_of, "alias") else as_of
    last = features.groupBy(key).agg(F.max(ts).alias("last_hour"))
    secs = F.timestamp_diff("MICROSECOND", F.col("last_hour"), as_of) / F.lit(3.6e9)
    return last.withColumn("gap_hours", secs.cast("int"))
