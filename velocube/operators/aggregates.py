"""Aggregations: counts, cubes, top-k, report pieces.

NULL group keys are dropped before grouping (pandas ``groupby`` semantics);
every top-k orders by count DESC then key ASC so ties are deterministic.
Top-k results are k rows (``TakeOrderedAndProject``: each task keeps its own
top k, the driver merges k x tasks rows), so broadcasting them is safe.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from velocube.functions import bin_label, duration_bin, hour_bucket, route, route_strict
from velocube.functions.text import ROUTE_SEP, ROUTE_SEP_STRICT
from velocube.functions import round_py


def _nonnull(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)


def value_counts(df: DataFrame, keys: str | Sequence[str], name: str = "count") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _nonnull(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, count_col: str, keys: str | Sequence[str], k: int) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.orderBy(F.col(count_col).desc(), *[F.col(c).asc() for c in keys]).limit(k)


def rank_top(top: DataFrame, count_col: str, key: str, rank_col: str = "station_rank") -> DataFrame:
    """0-based rank inside a top-k result (k rows: the one-partition window is bounded)."""
    w = Window.orderBy(F.col(count_col).desc(), F.col(key).asc())
    return top.withColumn(rank_col, (F.row_number().over(w) - 1).cast("int"))


# ------------------------------------------------------------------ stations
def station_popularity(trips: DataFrame) -> DataFrame:
    """Trips per start station over every row with a station id, even when
    other fields are missing."""
    return (trips.filter(F.col("start_station_id").isNotNull())
            .groupBy(F.col("start_station_id").alias("station_id"))
            .agg(F.count(F.lit(1)).alias("trips")))


def top_stations(popularity: DataFrame, k: int = 3) -> DataFrame:
    return rank_top(top_k(popularity, "trips", "station_id", k), "trips", "station_id")


def hourly_cube(trips: DataFrame) -> DataFrame:
    """Trips per (hour, station, rider class, bike type); rows with a NULL in
    any of the four keys are left out."""
    keys = ["start_hour", "start_station_id", "member_casual", "rideable_type"]
    return value_counts(trips.withColumn("start_hour", hour_bucket("started_at")), keys, "count")


def station_hour_counts(trips: DataFrame) -> DataFrame:
    """One pass that serves both station popularity and the station-hour
    series: counts per (hour, station, complete) where ``complete`` says
    whether the row would enter the four-key cube.  The result is bounded by
    hours x stations x 2, far smaller than the trips."""
    t = trips.filter(F.col("start_station_id").isNotNull())
    hour = hour_bucket("started_at")
    complete = hour.isNotNull() & F.col("member_casual").isNotNull() & F.col("rideable_type").isNotNull()
    return (t.groupBy(hour.alias("start_hour"), F.col("start_station_id").alias("station_id"),
                      complete.alias("complete"))
             .agg(F.count(F.lit(1)).alias("count")))


def rollup_sum(df: DataFrame, keys: Sequence[str], value: str = "count",
               name: str = "total_trips") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


# ------------------------------------------------------------------ report pieces
def hourly_density(clean: DataFrame) -> DataFrame:
    return value_counts(clean, ["hour", "member_casual"])


def rideable_counts(clean: DataFrame) -> DataFrame:
    return value_counts(clean, "rideable_type")


def duration_hist(clean: DataFrame, width: int = 5, cap: int = 60) -> DataFrame:
    b = clean.withColumn("bin", duration_bin("duration_min", width, cap))
    return (value_counts(b, ["bin", "member_casual"])
            .withColumn("binLabel", bin_label("bin", width)))


def route_counts(clean: DataFrame, strict: bool = False, sep: str | None = None) -> DataFrame:
    """Counts per route.  Default: a missing end becomes '' and only routes
    missing both ends are dropped; ``strict``: any missing end drops the row."""
    a, b = "start_station_name", "end_station_name"
    if strict:
        return value_counts(clean.withColumn("route", route_strict(a, b, sep or ROUTE_SEP_STRICT)), "route")
    sep = sep or ROUTE_SEP
    return value_counts(clean.withColumn("route", route(a, b, sep)).filter(F.col("route") != sep), "route")


def top_routes(clean: DataFrame, n: int = 10) -> DataFrame:
    return top_k(route_counts(clean), "count", "route", n)


def order_key(ts: str = "started_at", tie: str = "ride_id", newest_month: bool = False):
    """One number that orders rows by start time and then by a hash of their id; rows without a start time come last.

    A number of fixed width keeps ``min``/``min_by`` in a hash aggregate, which a struct with a text would not.
    With ``newest_month`` later months come first (the order inside a month stays).
    """
    wide, t = "decimal(38,0)", F.col(ts).cast("timestamp")
    micros = F.coalesce(F.unix_micros(t), F.lit(10 ** 16 - 1)).cast(wide)
    key = micros * F.lit(2 ** 48).cast("decimal(15,0)") + F.xxhash64(tie).bitwiseAND(F.lit(2 ** 48 - 1)).cast(wide)
    if newest_month:
        month = F.coalesce(F.year(ts) * 100 + F.month(ts), F.lit(0))
        key = (F.lit(999_999) - month).cast("decimal(6,0)") * F.lit(str(10 ** 31)).cast("decimal(32,0)") + key
    return key.cast(wide)


def first_places(clean: DataFrame, ts: str = "started_at", tie: str = "ride_id") -> DataFrame:
    """Per start-station name: trips, trips with a start time, and the first non-NULL latitude and longitude, each on its own."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_key")))
    return (clean.filter(F.col("start_station_name").isNotNull()).withColumn("_key", order_key(ts, tie))
            .groupBy("start_station_name")
            .agg(F.count(F.lit(1)).alias("trips"), F.count(ts).alias("count"), first("start_lat").alias("lat"), first("start_lng").alias("lng")))


def station_geo(clean: DataFrame, n: int = 500, order: Sequence[str] = ("started_at", "ride_id")) -> DataFrame:
    """``first_places`` of the stations that have coordinates; top ``n`` by trips with a start time."""
    g = first_places(clean, *order).drop("trips").filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    return top_k(g.select("start_station_name", "lat", "lng", "count"), "count", "start_station_name", n)


def geo_points(clean: DataFrame, n: int | None = None) -> DataFrame:
    keys = ["start_station_name", "start_lat", "start_lng"]
    g = value_counts(clean, keys)
    return top_k(g, "count", keys, n) if n else g


def top_station_names(clean: DataFrame, n: int = 10) -> DataFrame:
    return top_k(value_counts(clean, "start_station_name"), "count", "start_station_name", n)


def trip_summary(clean: DataFrame) -> DataFrame:
    """Total trips, mean duration, member share (NULL counts as non-member)
    and the most common hour (smallest hour among ties); one row."""
    return clean.agg(
        F.count(F.lit(1)).alias("totalTrips"),
        round_py(F.avg("duration_min"), 1).alias("avgDuration"),
        round_py(F.avg(F.when(F.col("member_casual") == "member", 1.0).otherwise(0.0)) * 100, 1)
        .alias("memberRatio"),
        F.mode("hour", True).alias("peakHour"),
    )


def hour_mean(df: DataFrame, hour: str = "hour", y: str = "total_trips",
              name: str = "hour_mean") -> DataFrame:
    return df.groupBy(hour).agg(F.avg(y).alias(name))


def station_names(trips: DataFrame) -> DataFrame:
    """First non-NULL name per station id: newest month first, then start time (then a hash of the ride id) inside a month.

    Rows collapse to (station, name) with the least order key first; the few names of a station are then compared.
    """
    named = trips.filter(F.col("start_station_id").isNotNull() & F.col("start_station_name").isNotNull())
    each = (named.groupBy(F.col("start_station_id").alias("station_id"), F.col("start_station_name").alias("station_name"))
            .agg(F.min(order_key(newest_month=True)).alias("_key")))
    return each.groupBy("station_id").agg(F.min_by("station_name", "_key").alias("station_name"))


def pivot_counts(df: DataFrame, key: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``col`` values per ``key`` as columns, zero filled (explicit
    values: no extra job to discover them)."""
    return (df.filter(F.col(key).isNotNull() & F.col(col).isNotNull())
            .groupBy(key).pivot(col, list(values)).count().fillna(0))


def hourly_wide(trips: DataFrame) -> DataFrame:
    """Per hour: member, casual, electric_bike, classic_bike counts, outer
    aligned (an hour appears if either dimension is present) and
    total_trips = member + casual; fused into one conditional aggregation."""
    t = trips.withColumn("start_hour", hour_bucket("started_at")).filter(F.col("start_hour").isNotNull())
    cnt = lambda c, v: F.count(F.when(F.col(c) == v, 1)).cast("long")
    g = (t.groupBy("start_hour")
         .agg(cnt("member_casual", "member").alias("member"), cnt("member_casual", "casual").alias("casual"),
              cnt("rideable_type", "electric_bike").alias("electric_bike"),
              cnt("rideable_type", "classic_bike").alias("classic_bike"),
              (F.count("member_casual") + F.count("rideable_type")).alias("_present")))
    return (g.filter(F.col("_present") > 0).drop("_present")
            .withColumn("total_trips", F.col("member") + F.col("casual")))


def widen(long: DataFrame, key: str, type_col: str, value: str, values: Sequence[str]) -> DataFrame:
    """Long -> wide for charts, duplicates summed, ordered by key."""
    return long.groupBy(key).pivot(type_col, list(values)).agg(F.sum(value)).orderBy(key)


def top_names(trips: DataFrame, k: int, counts: DataFrame | None = None) -> DataFrame:
    """Names of the ``k`` most used stations (the id where there is no name).

    Only trips of those stations are aggregated for names.
    """
    pop = station_popularity(trips) if counts is None else counts
    top = F.broadcast(top_stations(pop, k).select("station_id"))  # k rows
    used = trips.join(top.withColumnRenamed("station_id", "start_station_id"), "start_station_id", "left_semi")
    return top.join(station_names(used), "station_id", "left").select("station_id", F.coalesce("station_name", "station_id").alias("station_name"))


def update_popularity(spark, bronze: str, store: str) -> DataFrame:
    """``station_popularity`` of all landed months, from counts that are stored by month.

    Only months that the store lacks are scanned (which ones follows from folder names and the store's manifest); their
    counts are added as partitions of a new version, and the totals are sums over the stored counts.
    """
    from velocube.sources import tables, versions
    base, folders = versions.manifest(spark, store)
    new = [m for m in tables.bronze_months(spark, bronze) if m not in folders]
    if new:
        counts = (tables.read_bronze(spark, bronze, new).filter(F.col("start_station_id").isNotNull())
                  .groupBy("ym", F.col("start_station_id").alias("station_id")).agg(F.count(F.lit(1)).alias("trips")))
        versions.replace(spark, store, counts, "ym", base, folders)
    return tables.read_table(spark, store).groupBy("station_id").agg(F.sum("trips").alias("trips"))
