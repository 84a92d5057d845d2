"""Registered queries: one per operator of SURVEY §2, each a function
(spark, sf_dir) -> DataFrame over the driver tables, plus the DuckDB oracle
SQL for every SQL-expressible one (``velocube.oracle``)."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from velocube import functions as VF
from velocube import oracle as O
from velocube.operators import aggregates as A
from velocube.operators import clean as CL
from velocube.operators import features as FE
from velocube.operators import stats as ST
from velocube.sources import adapters
from velocube.sources import tables
from velocube.sources.tables import months_before
from velocube import schemas
from velocube.operators import drift as DR
from velocube.operators import evaluation as EV
from velocube.operators import forecast as FC
from velocube.operators import models as M
from velocube.operators import serving as SV
from velocube.operators import trees as TR
from velocube.plans.report import monthly_report, report_json
from velocube.session import checkpoint_dir, scratch_path
from velocube.streaming import jobs as SJ

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _trips(spark, d):
    return adapters.trips(spark, d)


def _clean(spark, d):
    return CL.clean_trips(_trips(spark, d))


def _features(spark, d):
    return FE.build_features(_trips(spark, d))


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ======================================================================= scans & scalars
@register("last_months", O.T("""
SELECT i, strftime(date_trunc('month', as_of) - to_months(i), '%Y%m') AS ym
FROM (SELECT max(started_at) AS as_of FROM trips) a, range(1, 13) r(i)"""))
def q_last_months(spark, d):
    from velocube.sources.tables import last_months
    a = _trips(spark, d).agg(F.max("started_at").alias("as_of"))
    return (a.select(F.posexplode(last_months(F.col("as_of"), 12)).alias("p", "ym"))
            .select((F.col("p") + 1).cast("bigint").alias("i"), "ym"))


@register("clean_trips", O.C("""
SELECT ride_id, started_at, ended_at, member_casual, rideable_type, start_station_id,
       round(duration_min, 6) AS duration_min, hour FROM clean"""))
def q_clean_trips(spark, d):
    return _clean(spark, d).select("ride_id", "started_at", "ended_at", "member_casual", "rideable_type",
                                   "start_station_id", r6("duration_min").alias("duration_min"), "hour")


@register("duration_min", O.T("""
SELECT ride_id, round(date_diff('microsecond', started_at, ended_at) / cast(60000000 AS DOUBLE), 6) AS duration_min
FROM trips"""))
def q_duration_min(spark, d):
    return _trips(spark, d).select("ride_id", r6(VF.duration_min("started_at", "ended_at")).alias("duration_min"))


@register("hour_bucket", O.T("SELECT ride_id, date_trunc('hour', started_at) AS start_hour FROM trips"))
def q_hour_bucket(spark, d):
    return _trips(spark, d).select("ride_id", VF.hour_bucket("started_at").alias("start_hour"))


@register("calendar_features", O.T("""
SELECT DISTINCT date_trunc('hour', started_at) AS start_hour, cast(hour(started_at) AS INTEGER) AS hour,
       cast(isodow(started_at) - 1 AS INTEGER) AS day_of_week,
       cast(CASE WHEN isodow(started_at) IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       cast(month(started_at) AS INTEGER) AS month FROM trips"""))
def q_calendar(spark, d):
    h = _trips(spark, d).select(VF.hour_bucket("started_at").alias("start_hour")).distinct()
    return FE.calendar_features(h)


@register("day_name", O.C("SELECT dayname(started_at) AS day_name, count(*) AS count FROM clean GROUP BY 1"))
def q_day_name(spark, d):
    return A.value_counts(_clean(spark, d).withColumn("day_name", VF.day_name("started_at")), "day_name")


@register("to_eastern", O.T("""
SELECT DISTINCT date_trunc('hour', started_at) AS start_hour,
       timezone('America/New_York', timezone('UTC', date_trunc('hour', started_at))) AS start_hour_et
FROM trips"""))
def q_to_eastern(spark, d):
    h = _trips(spark, d).select(VF.hour_bucket("started_at").alias("start_hour")).distinct()
    return h.withColumn("start_hour_et", VF.to_eastern("start_hour"))


@register("resolve_epoch", """
SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_ms,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_us
FROM events""")
def q_resolve_epoch(spark, d):
    ev = adapters.load_table(spark, d, "events")
    as_ts = F.col("ts").cast("timestamp")
    return ev.select("event_id",
                     VF.resolve_epoch(F.unix_millis(as_ts)).cast("timestamp_ntz").alias("from_ms"),
                     VF.resolve_epoch(F.unix_micros(as_ts)).cast("timestamp_ntz").alias("from_us"))


@register("short_label", O.C("""
SELECT route, CASE WHEN length(route) > 40 THEN substring(route, 1, 37) || '...' ELSE route END AS label,
       count(*) AS count
FROM (SELECT start_station_name || ' → ' || end_station_name || ' via ' || rideable_type AS route FROM clean) r
WHERE route IS NOT NULL GROUP BY 1, 2"""))
def q_short_label(spark, d):
    c = _clean(spark, d).withColumn(
        "route", F.concat("start_station_name", F.lit(" → "), "end_station_name", F.lit(" via "), "rideable_type"))
    return A.value_counts(c.withColumn("label", VF.short_label("route")), ["route", "label"])


@register("rounding", O.C("""
SELECT member_casual, round_even(avg(duration_min), 1) AS avg_py,
       floor(avg(duration_min) * 10 + 0.5) / 10 AS avg_js,
       greatest(min(duration_min) - 5, 0) AS clamp0
FROM clean GROUP BY 1"""))
def q_rounding(spark, d):
    return _clean(spark, d).groupBy("member_casual").agg(
        VF.round_py(F.avg("duration_min"), 1).alias("avg_py"),
        VF.round_js(F.avg("duration_min"), 1).alias("avg_js"),
        VF.clamp0(F.min("duration_min") - 5).alias("clamp0"))


# ======================================================================= aggregates
@register("station_popularity", O.T("""
SELECT start_station_id AS station_id, count(*) AS trips FROM trips
WHERE start_station_id IS NOT NULL GROUP BY 1"""))
def q_station_popularity(spark, d):
    return A.station_popularity(_trips(spark, d))


@register("top_stations", O.Fe("SELECT station_id, trips, station_rank FROM top"))
def q_top_stations(spark, d):
    return A.top_stations(A.station_popularity(_trips(spark, d)), 3)


@register("hourly_cube", O.T("""
SELECT date_trunc('hour', started_at) AS start_hour, start_station_id, member_casual, rideable_type,
       count(*) AS count FROM trips
WHERE started_at IS NOT NULL AND start_station_id IS NOT NULL AND member_casual IS NOT NULL
  AND rideable_type IS NOT NULL GROUP BY 1, 2, 3, 4"""))
def q_hourly_cube(spark, d):
    return A.hourly_cube(_trips(spark, d))


@register("station_hourly", O.Fe("SELECT start_hour, station_id, station_rank, total_trips FROM series"))
def q_station_hourly(spark, d):
    counts = A.station_hour_counts(_trips(spark, d))
    pop = counts.groupBy("station_id").agg(F.sum("count").alias("trips"))
    return FE.station_hourly(counts, A.top_stations(pop, 3)).select(
        "start_hour", "station_id", "station_rank", "total_trips")


ALL_LAGS = ",\n".join(f"lag(total_trips, {k}) OVER (PARTITION BY station_id ORDER BY start_hour) AS lag_{k}"
                      for k in range(1, 29))


@register("add_lags", O.T(f"""
SELECT *, {ALL_LAGS} FROM (
  SELECT date_trunc('hour', started_at) AS start_hour, start_station_id AS station_id, count(*) AS total_trips
  FROM trips WHERE started_at IS NOT NULL AND start_station_id IS NOT NULL AND member_casual IS NOT NULL
    AND rideable_type IS NOT NULL GROUP BY 1, 2) s"""))
def q_add_lags(spark, d):
    counts = A.station_hour_counts(_trips(spark, d)).filter("complete")
    series = counts.select("start_hour", "station_id", F.col("count").alias("total_trips"))
    return FE.add_lags(series, ["station_id"], "start_hour", "total_trips")


GLOBAL_LAGS = ", ".join(f"lag(total_trips, {k}) OVER (ORDER BY start_hour) AS lag_{k}" for k in range(1, 29))


@register("add_lags_global", O.with_ctes(f"""
SELECT start_hour, member, casual, electric_bike, classic_bike, total_trips, {O.LAG_COLS},
       cast(hour(start_hour) AS INTEGER) AS hour, cast(isodow(start_hour) - 1 AS INTEGER) AS day_of_week,
       cast(CASE WHEN isodow(start_hour) IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
FROM (SELECT *, {GLOBAL_LAGS} FROM wide) l WHERE {O.LAG_NN}""", O.TRIPS, O.FEATURES.split(",\nseries AS")[0], """wide AS (
  SELECT start_hour, member, casual, electric_bike, classic_bike, member + casual AS total_trips FROM (
    SELECT date_trunc('hour', started_at) AS start_hour,
           count(CASE WHEN member_casual = 'member' THEN 1 END) AS member,
           count(CASE WHEN member_casual = 'casual' THEN 1 END) AS casual,
           count(CASE WHEN rideable_type = 'electric_bike' THEN 1 END) AS electric_bike,
           count(CASE WHEN rideable_type = 'classic_bike' THEN 1 END) AS classic_bike,
           count(member_casual) + count(rideable_type) AS present
    FROM trips WHERE start_station_id IN (SELECT station_id FROM top) AND started_at IS NOT NULL
    GROUP BY 1) g WHERE present > 0)"""))
def q_add_lags_global(spark, d):
    t = _trips(spark, d)
    top = A.top_stations(A.station_popularity(t), 3)
    wide = A.hourly_wide(CL.in_top(t, top, "start_station_id", "station_id"))
    lagged = FE.add_lags(wide, None, "start_hour", "total_trips")
    return (FE.calendar_features(lagged).drop("month").dropna(how="any"))


@register("build_features", O.Fe("SELECT * FROM features"))
def q_build_features(spark, d):
    return _features(spark, d)


@register("latest_state", O.Fe("""
SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY start_hour DESC) = 1"""))
def q_latest_state(spark, d):
    return FE.latest_state(_features(spark, d))


AS_OF = "2024-02-19 12:34:56"


@register("data_lag", O.Fe(f"""
SELECT station_id, max(start_hour) AS last_hour,
       cast(trunc(date_diff('microsecond', max(start_hour), TIMESTAMP '{AS_OF}') / 3600000000.0) AS INTEGER) AS gap_hours
FROM features GROUP BY 1"""))
def q_data_lag(spark, d):
    return FE.data_lag(_features(spark, d), AS_OF)


@register("chrono_split", O.Fe("""
SELECT start_hour, station_id, total_trips,
       CASE WHEN row_number() OVER (ORDER BY start_hour, station_rank) - 1 < floor(count(*) OVER () * 0.8)
            THEN 'train' ELSE 'test' END AS split
FROM features"""))
def q_chrono_split(spark, d):
    checkpoint_dir(spark)
    return FE.chrono_split(_features(spark, d).checkpoint()).select("start_hour", "station_id", "total_trips", "split")


# ======================================================================= monthly report pieces
@register("hourly_density", O.C("""
SELECT hour, member_casual, count(*) AS count FROM clean WHERE member_casual IS NOT NULL GROUP BY 1, 2"""))
def q_hourly_density(spark, d):
    return A.hourly_density(_clean(spark, d))


@register("rideable_counts", O.C("""
SELECT rideable_type, count(*) AS count FROM clean WHERE rideable_type IS NOT NULL GROUP BY 1"""))
def q_rideable_counts(spark, d):
    return A.rideable_counts(_clean(spark, d))


@register("duration_hist", O.C("""
SELECT bin, member_casual, count(*) AS count, cast(bin AS VARCHAR) || '-' || cast(bin + 5 AS VARCHAR) AS binLabel
FROM (SELECT cast(least(floor(duration_min / 5) * 5, 60) AS INTEGER) AS bin, member_casual FROM clean) b
WHERE member_casual IS NOT NULL GROUP BY 1, 2"""))
def q_duration_hist(spark, d):
    return A.duration_hist(_clean(spark, d))


@register("route_counts", O.C("""
SELECT route, count(*) AS count FROM (
  SELECT coalesce(start_station_name, '') || ' → ' || coalesce(end_station_name, '') AS route FROM clean) r
WHERE route <> ' → ' GROUP BY 1"""))
def q_route_counts(spark, d):
    return A.route_counts(_clean(spark, d))


@register("route_strict", O.C("""
SELECT route, count(*) AS count FROM (
  SELECT start_station_name || ' to ' || end_station_name AS route FROM clean) r
WHERE route IS NOT NULL GROUP BY 1"""))
def q_route_strict(spark, d):
    return A.route_counts(_clean(spark, d), strict=True)


@register("top_routes", O.C("""
SELECT route, count(*) AS count FROM (
  SELECT coalesce(start_station_name, '') || ' → ' || coalesce(end_station_name, '') AS route FROM clean) r
WHERE route <> ' → ' GROUP BY 1 ORDER BY count DESC, route LIMIT 10"""))
def q_top_routes(spark, d):
    return A.top_routes(_clean(spark, d), 10)


@register("station_geo", O.C("""
SELECT * FROM (
  SELECT start_station_name,
         first(start_lat ORDER BY started_at, ride_id) FILTER (WHERE start_lat IS NOT NULL) AS lat,
         first(start_lng ORDER BY started_at, ride_id) FILTER (WHERE start_lng IS NOT NULL) AS lng,
         count(started_at) AS count
  FROM clean WHERE start_station_name IS NOT NULL GROUP BY 1) g
WHERE lat IS NOT NULL AND lng IS NOT NULL ORDER BY count DESC, start_station_name LIMIT 500"""))
def q_station_geo(spark, d):
    return A.station_geo(_clean(spark, d), 500)


@register("geo_points", O.C("""
SELECT start_station_name, start_lat, start_lng, count(*) AS count FROM clean
WHERE start_station_name IS NOT NULL AND start_lat IS NOT NULL AND start_lng IS NOT NULL
GROUP BY 1, 2, 3 ORDER BY count DESC, 1, 2, 3 LIMIT 20"""))
def q_geo_points(spark, d):
    return A.geo_points(_clean(spark, d), 20)


@register("top_station_names", O.C("""
SELECT start_station_name, count(*) AS count FROM clean WHERE start_station_name IS NOT NULL
GROUP BY 1 ORDER BY count DESC, 1 LIMIT 10"""))
def q_top_station_names(spark, d):
    return A.top_station_names(_clean(spark, d), 10)


@register("trip_summary", O.C("""
SELECT count(*) AS totalTrips, round_even(avg(duration_min), 1) AS avgDuration,
       round_even(avg(CASE WHEN member_casual = 'member' THEN 1.0 ELSE 0.0 END) * 100, 1) AS memberRatio,
       (SELECT hour FROM clean GROUP BY hour ORDER BY count(*) DESC, hour LIMIT 1) AS peakHour
FROM clean"""))
def q_trip_summary(spark, d):
    return A.trip_summary(_clean(spark, d))


@register("station_names", O.T("""
SELECT start_station_id AS station_id,
       first(start_station_name ORDER BY year(started_at) * 100 + month(started_at) DESC, started_at, ride_id)
         AS station_name
FROM trips WHERE start_station_id IS NOT NULL AND start_station_name IS NOT NULL GROUP BY 1"""))
def q_station_names(spark, d):
    return A.station_names(_trips(spark, d))


@register("hourly_wide", O.T("""
SELECT start_hour, member, casual, electric_bike, classic_bike, member + casual AS total_trips FROM (
  SELECT date_trunc('hour', started_at) AS start_hour,
         count(CASE WHEN member_casual = 'member' THEN 1 END) AS member,
         count(CASE WHEN member_casual = 'casual' THEN 1 END) AS casual,
         count(CASE WHEN rideable_type = 'electric_bike' THEN 1 END) AS electric_bike,
         count(CASE WHEN rideable_type = 'classic_bike' THEN 1 END) AS classic_bike,
         count(member_casual) + count(rideable_type) AS present
  FROM trips WHERE started_at IS NOT NULL GROUP BY 1) g WHERE present > 0"""))
def q_hourly_wide(spark, d):
    return A.hourly_wide(_trips(spark, d))


@register("pivot_counts", O.T("""
SELECT start_station_id, count(CASE WHEN rideable_type = 'classic_bike' THEN 1 END) AS classic_bike,
       count(CASE WHEN rideable_type = 'electric_bike' THEN 1 END) AS electric_bike
FROM trips WHERE start_station_id IS NOT NULL AND rideable_type IS NOT NULL GROUP BY 1"""))
def q_pivot_counts(spark, d):
    return A.pivot_counts(_trips(spark, d), "start_station_id", "rideable_type", ["classic_bike", "electric_bike"])


@register("widen", O.C("""
SELECT hour, cast(sum(CASE WHEN member_casual = 'member' THEN c END) AS BIGINT) AS member,
       cast(sum(CASE WHEN member_casual = 'casual' THEN c END) AS BIGINT) AS casual
FROM (SELECT hour, member_casual, count(*) AS c FROM clean WHERE member_casual IS NOT NULL GROUP BY 1, 2) h
GROUP BY 1"""))
def q_widen(spark, d):
    w = A.widen(A.hourly_density(_clean(spark, d)), "hour", "member_casual", "count", ["member", "casual"])
    return w.select("hour", F.col("member").cast("bigint"), F.col("casual").cast("bigint"))


# ======================================================================= exploration statistics
@register("describe_by", O.C("""
SELECT member_casual, count(*) AS count, round(avg(duration_min), 6) AS mean,
       round(quantile_cont(duration_min, 0.5), 6) AS median, round(stddev_samp(duration_min), 6) AS std
FROM clean GROUP BY 1"""))
def q_describe_by(spark, d):
    s = ST.describe_by(_clean(spark, d), ["member_casual"], "duration_min")
    return s.select("member_casual", "count", r6("mean").alias("mean"), r6("median").alias("median"),
                    r6("std").alias("std"))


@register("box_stats", O.C("""
SELECT member_casual, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(min(CASE WHEN duration_min >= q1 - 1.5 * iqr THEN duration_min END), 6) AS whisker_lo,
       round(max(CASE WHEN duration_min <= q3 + 1.5 * iqr THEN duration_min END), 6) AS whisker_hi,
       count(CASE WHEN duration_min < q1 - 1.5 * iqr OR duration_min > q3 + 1.5 * iqr THEN 1 END) AS n_outliers
FROM clean JOIN (
  SELECT member_casual, q1, median, q3, q3 - q1 AS iqr FROM (
    SELECT member_casual, quantile_cont(duration_min, 0.25) AS q1, quantile_cont(duration_min, 0.5) AS median,
           quantile_cont(duration_min, 0.75) AS q3 FROM clean GROUP BY 1) x) q USING (member_casual)
GROUP BY member_casual, q1, median, q3, iqr"""))
def q_box_stats(spark, d):
    s = ST.box_stats(_clean(spark, d), ["member_casual"], "duration_min")
    return s.select("member_casual", *[r6(c).alias(c) for c in ["q1", "median", "q3", "iqr", "whisker_lo",
                                                                 "whisker_hi"]], "n_outliers")


@register("kde", O.C("""
SELECT member_casual, i, round(x, 6) AS x,
       round(sum(c * exp(-0.5 * pow((x - v) / h, 2))) / (n * h * sqrt(2 * pi())), 9) AS density
FROM (
  SELECT p.member_casual, p.v, p.c, s.n, s.h, g.i,
         (s.lo - 3 * s.h) + g.i * (((s.hi + 3 * s.h) - (s.lo - 3 * s.h)) / 199) AS x
  FROM (SELECT member_casual, cast(hour AS DOUBLE) AS v, count(*) AS c FROM clean GROUP BY 1, 2) p
  JOIN (SELECT member_casual, count(*) AS n, min(hour) AS lo, max(hour) AS hi,
               stddev_samp(hour) * pow(count(*), -0.2) AS h FROM clean GROUP BY 1) s USING (member_casual)
  CROSS JOIN range(0, 200) g(i)) t
GROUP BY member_casual, i, x, n, h"""))
def q_kde(spark, d):
    k = ST.kde(_clean(spark, d), ["member_casual"], "hour")
    return k.select("member_casual", F.col("i").cast("bigint").alias("i"), r6("x").alias("x"),
                    F.round("density", 9).alias("density"))


@register("kde_binned", O.C("""
SELECT member_casual, g.i AS i, round(gmin + g.i * (span / 199), 6) AS x, round(coalesce(t, 0) / (n * h * sqrt(2 * pi())), 8) AS density
FROM st CROSS JOIN range(0, 200) g(i) LEFT JOIN (
  SELECT member_casual AS m, j.i AS i, sum(w * exp(-0.5 * pow((j.i * (span / 199) - k * (span / 4095)) / h, 2))) AS t
  FROM (SELECT member_casual, k, any_value(h) AS h, any_value(span) AS span, sum(w) AS w FROM (
          SELECT member_casual, h, span, floor(a) AS k, 1 - (a - floor(a)) AS w FROM pos
          UNION ALL SELECT member_casual, h, span, floor(a) + 1, a - floor(a) FROM pos) u GROUP BY 1, 2) f
  CROSS JOIN range(0, 200) j(i) WHERE abs(j.i * (span / 199) - k * (span / 4095)) <= 8 * h + 1e-9 GROUP BY 1, 2) d
  ON d.m = st.member_casual AND d.i = g.i""").replace("WITH ", "WITH ", 1).replace("\nSELECT member_casual, g.i", """,
st AS (
  SELECT member_casual, n, h, lo - 3 * h AS gmin, (hi + 3 * h) - (lo - 3 * h) AS span FROM (
    SELECT member_casual, count(*) AS n, min(duration_min) AS lo, max(duration_min) AS hi,
           stddev_samp(duration_min) * pow(count(*), -0.2) AS h FROM clean GROUP BY 1) q),
pos AS (
  SELECT member_casual, h, span, (duration_min - gmin) / (span / 4095) AS a FROM clean JOIN st USING (member_casual))
SELECT member_casual, g.i""", 1))
def q_kde_binned(spark, d):
    """Density of the durations, a continuous column, per rider class."""
    k = ST.kde_binned(_clean(spark, d), ["member_casual"], "duration_min")
    return k.select("member_casual", "i", r6("x").alias("x"), F.round("density", 8).alias("density"))


HIST_SQL = """
SELECT member_casual, bin_start, bin_start + step AS bin_end, count(*) AS count FROM (
  SELECT member_casual, step,
         start + step * floor(1e-14 + (least(duration_min, stop - step) - start) / step) AS bin_start
  FROM clean, (
    SELECT step, floor(lo / step + 1e-14) * step AS start, ceil(hi / step) * step AS stop FROM (
      SELECT lo, hi, CASE WHEN span / (s1 / 2) <= 50 THEN s1 / 2 ELSE s1 END AS step FROM (
        SELECT lo, hi, span, CASE WHEN span / (s0 / 5) <= 50 THEN s0 / 5 ELSE s0 END AS s1 FROM (
          SELECT lo, hi, span,
                 CASE WHEN ceil(span / b) <= 50 THEN b WHEN ceil(span / (b * 10)) <= 50 THEN b * 10
                      WHEN ceil(span / (b * 100)) <= 50 THEN b * 100 ELSE b * 1000 END AS s0 FROM (
            SELECT lo, hi, span, pow(10.0, floor(log10(span) + 0.5) - 2) AS b FROM (
              SELECT min(duration_min) AS lo, max(duration_min) AS hi,
                     CASE WHEN max(duration_min) - min(duration_min) > 0 THEN max(duration_min) - min(duration_min)
                          ELSE greatest(abs(min(duration_min)), 1.0) END AS span FROM clean) a) b) c) e) f) ext) r
GROUP BY 1, 2, 3"""


@register("histogram", O.C(HIST_SQL))
def q_histogram(spark, d):
    return ST.histogram(_clean(spark, d), "duration_min", ["member_casual"], 50).select(
        "member_casual", "bin_start", "bin_end", "count")


CORR_COLS = [f"lag_{k}" for k in range(1, 29)] + ["station_rank", "hour", "day_of_week", "is_weekend", "month"]


@register("corr_scan", O.Fe("SELECT feature, round(CASE WHEN isnan(c) THEN NULL ELSE c END, 9) AS corr FROM ("
                            + " UNION ALL ".join(
                                f"SELECT '{c}' AS feature, corr(cast({c} AS DOUBLE), cast(total_trips AS DOUBLE)) AS c "
                                f"FROM features" for c in CORR_COLS) + ") x"))
def q_corr_scan(spark, d):
    s = ST.corr_scan(_features(spark, d), "total_trips", CORR_COLS)
    return s.select("feature", F.round("corr", 9).alias("corr"))


PROFILE_COLS = ["ride_id", "started_at", "ended_at", "member_casual", "rideable_type", "start_station_id",
                "start_station_name", "end_station_name", "start_lat", "start_lng"]


@register("profile", O.T(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS non_null, count(*) AS rows FROM trips" for c in PROFILE_COLS)))
def q_profile(spark, d):
    return ST.profile(_trips(spark, d)).select("column", "non_null", "rows")


GEO = O.C("""
SELECT * FROM (
  SELECT start_station_name,
         first(start_lat ORDER BY started_at, ride_id) FILTER (WHERE start_lat IS NOT NULL) AS lat,
         first(start_lng ORDER BY started_at, ride_id) FILTER (WHERE start_lng IS NOT NULL) AS lng,
         count(started_at) AS count
  FROM clean WHERE start_station_name IS NOT NULL GROUP BY 1) g
WHERE lat IS NOT NULL AND lng IS NOT NULL ORDER BY count DESC, start_station_name LIMIT 500""")


@register("bbox", "SELECT round(min(lat) - 0.005, 6) AS lat_min, round(max(lat) + 0.005, 6) AS lat_max, "
                  "round(min(lng) - 0.005, 6) AS lng_min, round(max(lng) + 0.005, 6) AS lng_max FROM ("
                  + GEO + ") g WHERE lat <> 0 AND lng <> 0")
def q_bbox(spark, d):
    b = ST.bbox(A.station_geo(_clean(spark, d), 500))
    return b.select(*[r6(c).alias(c) for c in b.columns])


@register("marker_scale", """
SELECT start_station_name, count, round(ratio, 9) AS ratio,
       CASE WHEN ratio < 0.33 THEN '#00d4ff' WHEN ratio < 0.66 THEN '#a78bfa' ELSE '#ff4b4b' END AS color,
       round(4 + ratio * 22, 9) AS radius
FROM (SELECT start_station_name, count, least(count / max(count) OVER (), 1.0) AS ratio FROM (""" + GEO + ") g) r")
def q_marker_scale(spark, d):
    m = ST.marker_scale(A.station_geo(_clean(spark, d), 500))
    return m.select("start_station_name", "count", F.round("ratio", 9).alias("ratio"), "color",
                    F.round("radius", 9).alias("radius"))


# ======================================================================= forecasting

# Fixed parameters of the registered forecast queries (a linear demand model).
FORECAST_SPEC = FC.LinearSpec(intercept=0.2, lag_w=[0.35, 0.15, 0.1] + [0.0] * 20 + [0.2] + [0.0] * 4,
                              hour_w=0.01, dow_w=-0.02, weekend_w=0.05, month_w=0.0, rank_w=-0.1)


def _forecast(spark, d, mode="reference", bridge=False):
    st = FE.latest_state(_features(spark, d))
    return FC.forecast_linear(st, FORECAST_SPEC, AS_OF, mode=mode, emit_bridge=bridge)


def _fc_out(df):
    return df.select("station_id", "station_rank", F.col("step").cast("int").alias("step"), "target_hour",
                     r6("predicted_trips").alias("predicted_trips"))


FC_BODY = ("SELECT station_id, station_rank, cast(step AS INTEGER) AS step, target_hour, "
           "round(predicted_trips, 6) AS predicted_trips FROM preds")


@register("forecast", O.forecast_sql(FORECAST_SPEC, AS_OF, FC_BODY))
def q_forecast(spark, d):
    return _fc_out(_forecast(spark, d))


@register("forecast_aligned", O.forecast_sql(FORECAST_SPEC, AS_OF, FC_BODY, mode="aligned"))
def q_forecast_aligned(spark, d):
    return _fc_out(_forecast(spark, d, "aligned"))


@register("bridge", O.forecast_sql(FORECAST_SPEC, AS_OF, FC_BODY, bridge=True))
def q_bridge(spark, d):
    return _fc_out(_forecast(spark, d, bridge=True))


WIDE_BODY = """, p AS (SELECT station_rank, target_hour, floor(predicted_trips * 10 + 0.5) / 10 AS v FROM preds),
wide AS (
  SELECT target_hour, max(CASE WHEN station_rank = 0 THEN v END) AS station_0,
         max(CASE WHEN station_rank = 1 THEN v END) AS station_1, max(CASE WHEN station_rank = 2 THEN v END) AS station_2,
         floor(sum(v) * 10 + 0.5) / 10 AS total_trips,
         timezone('America/New_York', timezone('UTC', target_hour)) AS target_hour_et
  FROM p GROUP BY target_hour)
"""


def _wide(spark, d):
    return SV.forecast_wide(_forecast(spark, d))


def _wsql(body):
    return O.forecast_sql(FORECAST_SPEC, AS_OF, "") .rstrip() + WIDE_BODY + body


NOW_SERVE = "2024-02-19 18:00:00"


@register("forecast_wide", _wsql("SELECT * FROM wide"))
def q_forecast_wide(spark, d):
    return _wide(spark, d)


@register("upcoming", _wsql(f"SELECT * FROM wide WHERE target_hour >= TIMESTAMP '{NOW_SERVE}'"))
def q_upcoming(spark, d):
    return SV.upcoming(_wide(spark, d), NOW_SERVE)


@register("rush_hours", _wsql("SELECT * FROM wide WHERE total_trips > 1.25 * (SELECT avg(total_trips) FROM wide)"))
def q_rush_hours(spark, d):
    return SV.rush_hours(_wide(spark, d))


@register("rush_window", _wsql("""SELECT min(target_hour) AS rush_start, max(target_hour) AS rush_end,
  count(*) AS rush_hours FROM wide WHERE total_trips > 1.25 * (SELECT avg(total_trips) FROM wide)"""))
def q_rush_window(spark, d):
    return SV.rush_window(_wide(spark, d))


@register("forecast_summary", _wsql("""SELECT (SELECT total_trips FROM wide ORDER BY target_hour LIMIT 1) AS live,
  max(total_trips) AS peak,
  (SELECT target_hour FROM wide ORDER BY total_trips DESC, target_hour LIMIT 1) AS peak_hour,
  floor(avg(total_trips) * 10 + 0.5) / 10 AS avg_demand FROM wide"""))
def q_forecast_summary(spark, d):
    return SV.forecast_summary(_wide(spark, d))


@register("label_stations", O.forecast_sql(FORECAST_SPEC, AS_OF, """
SELECT p.station_id, cast(p.step AS INTEGER) AS step, coalesce(n.station_name, p.station_id) AS station_name
FROM preds p LEFT JOIN (
  SELECT start_station_id AS station_id,
         first(start_station_name ORDER BY year(started_at) * 100 + month(started_at) DESC, started_at, ride_id)
           AS station_name
  FROM trips WHERE start_station_id IS NOT NULL AND start_station_name IS NOT NULL GROUP BY 1) n
  USING (station_id)"""))
def q_label_stations(spark, d):
    names = A.station_names(_trips(spark, d))
    return SV.label_stations(_forecast(spark, d), names).select(
        "station_id", F.col("step").cast("int").alias("step"), "station_name")


# ======================================================================= evaluation
def _split(spark, d):
    checkpoint_dir(spark)
    s = FE.chrono_split(_features(spark, d).checkpoint())  # hours x stations rows, read several times
    return s.filter("split = 'train'"), s.filter("split = 'test'")


@register("baseline_hour_mean", O.Sp("""
SELECT start_hour, station_id, total_trips, hour, round(predicted, 6) AS predicted FROM scored"""))
def q_baseline(spark, d):
    tr, te = _split(spark, d)
    s = EV.baseline_hour_mean(tr, te)
    return s.select("start_hour", "station_id", "total_trips", "hour", r6("predicted").alias("predicted"))


def _metrics_cols(df):
    return df.select(*[r6(c).alias(c) for c in ("mae", "rmse", "wmape")], "n")


@register("mae_rmse_wmape", O.Sp("""
SELECT round(avg(abs(total_trips - predicted)), 6) AS mae, round(sqrt(avg(pow(total_trips - predicted, 2))), 6) AS rmse,
       round(sum(abs(total_trips - predicted)) / nullif(sum(total_trips), 0) * 100, 6) AS wmape, count(*) AS n
FROM scored"""))
def q_metrics(spark, d):
    tr, te = _split(spark, d)
    return _metrics_cols(EV.error_metrics(EV.baseline_hour_mean(tr, te)))


LAG_MEAN = "(" + " + ".join(f"lag_{k}" for k in range(1, 29)) + ") / 28.0"
MODELS_SQL = f"""
SELECT model_name, round(avg(abs(total_trips - p)), 6) AS mae, round(sqrt(avg(pow(total_trips - p, 2))), 6) AS rmse,
       round(sum(abs(total_trips - p)) / nullif(sum(total_trips), 0) * 100, 6) AS wmape, count(*) AS n
FROM (SELECT 'hour_mean' AS model_name, total_trips, predicted AS p FROM scored
      UNION ALL SELECT 'persistence', total_trips, cast(lag_1 AS DOUBLE) FROM test
      UNION ALL SELECT 'lag_mean', total_trips, {LAG_MEAN} FROM test) x
GROUP BY model_name"""


def _models(spark, d):
    tr, te = _split(spark, d)
    lag_mean = sum(F.col(f"lag_{k}") for k in range(1, 29)) / F.lit(28.0)
    scored = EV.baseline_hour_mean(tr, te).withColumn("lag_mean", lag_mean)
    out = EV.compare(scored, {"hour_mean": "predicted", "persistence": "lag_1", "lag_mean": "lag_mean"})
    return out.select("model_name", *[r6(c).alias(c) for c in ("mae", "rmse", "wmape")], "n")


@register("compare_runs", O.Sp(MODELS_SQL))
def q_compare_runs(spark, d):
    return EV.runs_table(_models(spark, d))


@register("best_model", O.Sp(f"SELECT * FROM ({MODELS_SQL}) r ORDER BY mae, model_name LIMIT 1"))
def q_best_model(spark, d):
    return EV.best_model(_models(spark, d))


@register("promote", O.Sp(f"""
SELECT c.mae AS challenger_mae, p.mae AS champion_mae,
       CASE WHEN p.mae IS NULL OR c.mae < p.mae THEN 'Promoted' ELSE 'Rejected' END AS promotion_status
FROM (SELECT * FROM ({MODELS_SQL}) r WHERE model_name = 'hour_mean') c,
     (SELECT * FROM ({MODELS_SQL}) r WHERE model_name = 'persistence') p"""))
def q_promote(spark, d):
    m = _models(spark, d)
    return EV.promote(m.filter("model_name = 'hour_mean'"), m.filter("model_name = 'persistence'"))


@register("importance_share", O.Fe("""
SELECT feature, round_even(importance / (sum(importance) OVER ()) * 100, 1) AS share FROM (
  SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr(cast({c} AS DOUBLE), cast(total_trips AS DOUBLE))), 9) AS importance "
    f"FROM features" for c in CORR_COLS if c != "month") + """) x
  ORDER BY importance DESC, feature LIMIT 10) t"""))
def q_importance_share(spark, d):
    imp = ST.corr_scan(_features(spark, d), "total_trips", [c for c in CORR_COLS if c != "month"])
    imp = imp.select("feature", F.round(F.abs("corr"), 9).alias("importance"))
    return EV.importance_share(imp, 10)


# ======================================================================= drift
DRIFT_COLS = [f"lag_{k}" for k in range(1, 29)] + ["total_trips"]


def _long_sql():
    parts = []
    for c in DRIFT_COLS:
        parts.append(f"SELECT '{c}' AS feature, cast({c} AS DOUBLE) AS v, split = 'train' AS is_ref FROM split")
    return "long AS (" + " UNION ALL ".join(parts) + ")"


@register("drift_ks", O.with_ctes("""
SELECT feature, round(max(abs(cr / n_ref - cc / n_cur)), 9) AS ks_stat,
       round(1.358 * sqrt((n_ref + n_cur) / (n_ref * n_cur)), 9) AS critical,
       max(abs(cr / n_ref - cc / n_cur)) > 1.358 * sqrt((n_ref + n_cur) / (n_ref * n_cur)) AS drift
FROM (SELECT feature, sum(c_ref) OVER w AS cr, sum(c_cur) OVER w AS cc,
             sum(c_ref) OVER (PARTITION BY feature) AS n_ref, sum(c_cur) OVER (PARTITION BY feature) AS n_cur
      FROM (SELECT feature, v, count(*) FILTER (WHERE is_ref) AS c_ref, count(*) FILTER (WHERE NOT is_ref) AS c_cur
            FROM long GROUP BY 1, 2) dd
      WINDOW w AS (PARTITION BY feature ORDER BY v)) x
GROUP BY feature, n_ref, n_cur""", O.TRIPS, O.FEATURES, O.SPLIT, _long_sql()))
def q_drift_ks(spark, d):
    tr, te = _split(spark, d)
    k = DR.drift_ks(tr, te, DRIFT_COLS)
    return k.select("feature", F.round("ks_stat", 9).alias("ks_stat"), F.round("critical", 9).alias("critical"),
                    "drift")


@register("drift_psi", O.with_ctes("""
SELECT feature, round(sum((a - e) * ln(a / e)), 9) AS psi, sum((a - e) * ln(a / e)) >= 0.2 AS drift FROM (
  SELECT feature, greatest(n_ref / t_ref, 1e-6) AS e, greatest(n_cur / t_cur, 1e-6) AS a FROM (
    SELECT feature, bin, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur,
           sum(count(*) FILTER (WHERE is_ref)) OVER (PARTITION BY feature) AS t_ref,
           sum(count(*) FILTER (WHERE NOT is_ref)) OVER (PARTITION BY feature) AS t_cur
    FROM (SELECT l.feature, l.is_ref, len(list_filter(q.edges, lambda x: x < l.v)) AS bin
          FROM long l JOIN (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
                            FROM long WHERE is_ref GROUP BY 1) q USING (feature)) b
    GROUP BY feature, bin) c) p
GROUP BY feature""", O.TRIPS, O.FEATURES, O.SPLIT, _long_sql()))
def q_drift_psi(spark, d):
    tr, te = _split(spark, d)
    p = DR.drift_psi(tr, te, DRIFT_COLS)
    return p.select("feature", F.round("psi", 9).alias("psi"), "drift")


_BINS_SQL = """bins AS (
  SELECT feature, bin, greatest(count(*) FILTER (WHERE is_ref) / any_value(t_ref), 1e-6) AS e,
         greatest(count(*) FILTER (WHERE NOT is_ref) / any_value(t_cur), 1e-6) AS a
  FROM (SELECT l.feature, l.is_ref, t_ref, t_cur, len(list_filter(q.edges, lambda x: x < l.v)) AS bin
        FROM long l JOIN (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FILTER (WHERE is_ref) AS edges,
                                 count(*) FILTER (WHERE is_ref) AS t_ref, count(*) FILTER (WHERE NOT is_ref) AS t_cur
                          FROM long GROUP BY 1) q USING (feature)) b
  GROUP BY feature, bin)"""


@register("drift_js", O.with_ctes("""
SELECT feature, round(sqrt(sum(a * ln(a / ((a + e) / 2)) + e * ln(e / ((a + e) / 2))) / 2), 9) AS js FROM bins GROUP BY feature""",
    O.TRIPS, O.FEATURES, O.SPLIT, _long_sql(), _BINS_SQL))
def q_drift_js(spark, d):
    js = DR.jensen_shannon(DR.drift_table(*_split(spark, d), DRIFT_COLS))
    return js.select("feature", F.round("js", 9).alias("js"))


@register("drift_wasserstein", O.with_ctes("""
SELECT feature, round(sum((nxt - v) * abs(cr / n_ref - cc / n_cur)), 9) AS wasserstein
FROM (SELECT feature, v, lead(v) OVER w AS nxt, sum(c_ref) OVER w AS cr, sum(c_cur) OVER w AS cc,
             sum(c_ref) OVER (PARTITION BY feature) AS n_ref, sum(c_cur) OVER (PARTITION BY feature) AS n_cur
      FROM (SELECT feature, v, count(*) FILTER (WHERE is_ref) AS c_ref, count(*) FILTER (WHERE NOT is_ref) AS c_cur
            FROM long GROUP BY 1, 2) dd
      WINDOW w AS (PARTITION BY feature ORDER BY v)) x
GROUP BY feature""", O.TRIPS, O.FEATURES, O.SPLIT, _long_sql()))
def q_drift_wasserstein(spark, d):
    w = DR.wasserstein(DR.drift_table(*_split(spark, d), DRIFT_COLS))
    return w.select("feature", F.round("wasserstein", 9).alias("wasserstein"))


@register("drift_share", O.with_ctes("""
SELECT count(*) AS columns, count(*) FILTER (WHERE psi >= 0.2) AS drifted, count(*) FILTER (WHERE psi >= 0.2) / count(*) AS share
FROM (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM bins GROUP BY feature) p""",
    O.TRIPS, O.FEATURES, O.SPLIT, _long_sql(), _BINS_SQL))
def q_drift_share(spark, d):
    return DR.drifted_share(DR.psi(DR.drift_table(*_split(spark, d), DRIFT_COLS)))


# ======================================================================= models (rows-only checks)


GBT_ROUNDS, NOTEBOOK_ROUNDS = 1000, 100  # the training plan's default; the notebook models'


_SAVED: dict[tuple[str, str], tuple[str, int]] = {}  # models of this session by the tables they are fitted on


def _gbt(spark, d):
    """The champion model of the split, and the test rows; fitted once a session, then read back."""
    from pyspark.ml import PipelineModel
    tr, te = _split(spark, d)
    key = (spark.sparkContext.applicationId if spark else "", str(d))
    if key in _SAVED:
        path, rounds = _SAVED[key]
        return PipelineModel.load(path), rounds, te
    model, rounds = M.train_gbt(tr, te, max_iter=GBT_ROUNDS)
    path = scratch_path(spark, f"champion-{uuid.uuid4().hex}")
    model.write().save(path)
    _SAVED[key] = path, rounds
    return model, rounds, te


@register("train_gbt")
def q_train_gbt(spark, d):
    from velocube.plans.training import metrics_record
    from datetime import datetime, timezone
    model, rounds, te = _gbt(spark, d)
    errors = EV.error_metrics(M.score(model, te, schemas.MODEL_INPUTS))
    decision = EV.promote(errors, None)
    split = FE.chrono_split(_features(spark, d))
    imp = M.importances(model, schemas.MODEL_INPUTS)
    return metrics_record(errors, decision, split, imp, rounds, len(schemas.MODEL_INPUTS),
                          datetime.now(timezone.utc))


@register("score")
def q_score(spark, d):
    model, _, te = _gbt(spark, d)
    return TR.score(te, M.node_table(model, schemas.MODEL_INPUTS)).select("start_hour", "station_id", "total_trips", "predicted")


@register("forecast_gbt")
def q_forecast_gbt(spark, d):
    from velocube.plans.inference import forecast_with_model
    model, _, _ = _gbt(spark, d)
    return forecast_with_model(model, _features(spark, d), AS_OF)


@register("importance_splits")
def q_importance_splits(spark, d):
    """Shares of the ten inputs that the champion's nodes split on most."""
    model, _, _ = _gbt(spark, d)
    return EV.importance_share(M.importances(model, schemas.MODEL_INPUTS), 10)


# Fixed parameters of the registered ensemble queries: three trees of two levels over lags, calendar and rank.
ENSEMBLE = [
    (0, 0, 1, 2, "lag_1", 1.5, None, None, 1.2, 1.0), (0, 1, 3, 4, "hour", None, [7.0, 8.0, 9.0, 16.0, 17.0, 18.0], False, 0.9, 1.0),
    (0, 2, 5, 6, "lag_24", 2.5, None, None, 1.9, 1.0), (0, 3, -1, -1, None, None, None, None, 1.4, 1.0),
    (0, 4, -1, -1, None, None, None, None, 0.6, 1.0), (0, 5, -1, -1, None, None, None, None, 1.7, 1.0), (0, 6, -1, -1, None, None, None, None, 2.8, 1.0),
    (1, 0, 1, 2, "day_of_week", None, [5.0, 6.0], True, 0.0, 0.5), (1, 1, 3, 4, "lag_2", 1.0, None, None, 0.1, 0.5),
    (1, 2, -1, -1, None, None, None, None, -0.4, 0.5), (1, 3, -1, -1, None, None, None, None, -0.3, 0.5), (1, 4, -1, -1, None, None, None, None, 0.55, 0.5),
    (2, 0, 1, 2, "month", None, [12.0, 1.0, 2.0], False, 0.0, 0.5), (2, 1, -1, -1, None, None, None, None, -0.25, 0.5),
    (2, 2, 3, 4, "station_rank", None, [0.0], False, 0.2, 0.5), (2, 3, -1, -1, None, None, None, None, 0.7, 0.5), (2, 4, -1, -1, None, None, None, None, 0.05, 0.5),
]


@register("score_trees", O.Fe(f"""
SELECT start_hour, station_id, total_trips, round({O.tree_expr(ENSEMBLE, str)}, 9) AS predicted FROM features"""))
def q_score_trees(spark, d):
    """A node table scored over all feature rows, in the JVM."""
    scored = TR.score(_features(spark, d), TR.node_rows(spark, ENSEMBLE))
    return scored.select("start_hour", "station_id", "total_trips", F.round("predicted", 9).alias("predicted"))


@register("tree_importance", O.Fe(O.tree_cover_sql(ENSEMBLE)))
def q_tree_importance(spark, d):
    """Nodes that split on each input and feature rows that reach them, and the share of the splits."""
    nodes = TR.node_rows(spark, ENSEMBLE)
    shares = EV.importance_share(TR.split_counts(nodes, schemas.MODEL_INPUTS), 10)
    return TR.cover(_features(spark, d), nodes).join(shares, "feature").select("feature", "splits", "rows", "share")


@register("forecast_trees", O.tree_forecast_sql(ENSEMBLE, AS_OF, FC_BODY))
def q_forecast_trees(spark, d):
    """The bridge and forecast of a node table, in the JVM."""
    return _fc_out(FC.forecast_trees(FE.latest_state(_features(spark, d)), TR.node_rows(spark, ENSEMBLE), AS_OF))


@register("monthly_report")
def q_monthly_report(spark, d):
    clean = _clean(spark, d)
    month = clean.agg(F.date_format(F.max("started_at"), "yyyyMM")).first()[0]
    return report_json(monthly_report(clean, A.top_names(_trips(spark, d), 3), f"{month}-tripdata.csv"))


@register("sample_head", O.T("SELECT * FROM trips ORDER BY started_at NULLS FIRST, ride_id NULLS FIRST LIMIT 100000"))
def q_sample_head(spark, d):
    return ST.sample_head(_trips(spark, d), ["started_at", "ride_id"], 100000).select(*TRIP_COLS)


@register("sample_n", O.C("SELECT * FROM clean ORDER BY md5(ride_id || '42') LIMIT 10000"))
def q_sample_n(spark, d):
    """Random sample of min(10000, n) cleaned trips (seeded)."""
    return ST.sample_n(_clean(spark, d), "ride_id", 10000, 42)


@register("stations", O.Fe("SELECT station_id, min(station_rank) AS station_rank FROM features GROUP BY 1"))
def q_stations(spark, d):
    return SV.stations(_features(spark, d))


# ======================================================================= sources and sinks
TRIP_COLS = ["ride_id", "started_at", "ended_at", "member_casual", "rideable_type", "start_station_id",
             "start_station_name", "end_station_name", "start_lat", "start_lng"]


@register("read_trips_csv", O.T("SELECT * FROM trips"))
def q_read_trips_csv(spark, d):
    """Trips written as CSV (header) and scanned back with the declared schema."""
    from velocube.sources.trips import read_trips
    from velocube.sources.tables import write_csv
    path = scratch_path(spark, f"trips-csv-{uuid.uuid4().hex}")
    write_csv(_trips(spark, d), path)
    return read_trips(spark, path).select(*TRIP_COLS)


@register("read_trips_by_header", O.T(
    "SELECT ride_id, started_at, ended_at, member_casual, rideable_type, start_station_id, "
    "NULL::VARCHAR AS start_station_name, end_station_name, start_lat, start_lng FROM trips"))
def q_read_trips_by_header(spark, d):
    """An export without the station-name column: the name comes back as typed NULLs."""
    from velocube.sources.trips import read_trips_by_header
    from velocube.sources.tables import write_csv
    path = scratch_path(spark, f"trips-csv-noname-{uuid.uuid4().hex}")
    write_csv(_trips(spark, d).drop("start_station_name"), path)
    return read_trips_by_header(spark, [path]).select(*TRIP_COLS)


@register("read_trips_mixed", O.T("""
SELECT ride_id, started_at, ended_at, member_casual, rideable_type, start_station_id,
       CASE WHEN k = 2 THEN NULL ELSE start_station_name END AS start_station_name, end_station_name, start_lat, start_lng
FROM (SELECT *, ascii(right(md5(ride_id), 1)) % 3 AS k FROM trips)"""))
def q_read_trips_mixed(spark, d):
    """Exports with three layouts in one folder: declared order, reversed order, and one that lacks the
    station name and has a column of its own."""
    from velocube.sources.tables import write_csv
    from velocube.sources.trips import read_trips
    path = scratch_path(spark, f"trips-csv-mixed-{uuid.uuid4().hex}")
    trips = _trips(spark, d).select(*TRIP_COLS)
    kind = F.ascii(F.substring(F.md5(F.col("ride_id").cast("binary")), -1, 1)) % 3
    layouts = [TRIP_COLS, TRIP_COLS[::-1], [c for c in TRIP_COLS if c != "start_station_name"] + ["extra"]]
    for k, cols in enumerate(layouts):
        write_csv(trips.withColumn("extra", F.lit("x")).filter(kind == k).select(*cols), f"{path}/{k}")
    return read_trips(spark, [f"{path}/{k}" for k in range(3)]).select(*TRIP_COLS)


@register("read_trip_archives", O.T("SELECT * FROM trips"))
def q_read_trip_archives(spark, d):
    """Trips written as zip archives of several CSV members and read back, a partition for each member (or a few)."""
    from velocube.sources.trips import read_trip_archives, write_trip_archives
    path = scratch_path(spark, f"trips-zip-{uuid.uuid4().hex}")
    write_trip_archives(_trips(spark, d).select(*TRIP_COLS).hint("rebalance"), path, 20_000)
    return read_trip_archives(spark, path).select(*TRIP_COLS)


@register("coerce_numeric", """
SELECT event_id, try_cast(cast(value AS VARCHAR) AS DOUBLE) AS value_s, try_cast(props AS DOUBLE) AS props,
       try_cast(event_type AS DOUBLE) AS event_type FROM events""")
def q_coerce_numeric(spark, d):
    from velocube.sources.tables import coerce_numeric
    ev = adapters.load_table(spark, d, "events")
    return coerce_numeric(ev.select("event_id", F.col("value").cast("string").alias("value_s"), "props",
                                    "event_type"))


FEATURE_COLS = ["start_hour", "station_id", "total_trips", "station_rank"] + [f"lag_{k}" for k in range(1, 29)] + \
    ["hour", "day_of_week", "is_weekend", "month"]


@register("upsert", O.Fe("""
SELECT start_hour, station_id, CASE WHEN day_of_week = 0 THEN total_trips + 1000 ELSE total_trips END AS total_trips,
       station_rank, """ + O.LAG_COLS + """, hour, day_of_week, is_weekend, month FROM features
UNION ALL
SELECT start_hour + INTERVAL 365 DAY, station_id, total_trips, station_rank, """ + O.LAG_COLS + """,
       hour, day_of_week, is_weekend, month FROM features WHERE hour = 3"""))
def q_upsert(spark, d):
    """Keyed upsert into a month-partitioned table: changed rows replace
    their keys, new keys are added; only touched months are rewritten."""
    from velocube.sources.tables import upsert
    feats = _features(spark, d)
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    keyed = lambda df: df.withColumn("month_key", F.date_format("start_hour", "yyyyMM"))
    keyed(feats).write.partitionBy("month_key").parquet(path)
    changed = feats.filter("day_of_week = 0").withColumn("total_trips", F.col("total_trips") + 1000)
    added = feats.filter("hour = 3").withColumn("start_hour", F.timestamp_add("DAY", F.lit(365), "start_hour"))
    out = upsert(spark, path, keyed(changed.unionByName(added)), ["start_hour", "station_id"], "start_hour",
                 "month_key")
    return out.select(*FEATURE_COLS)


@register("load_features", O.Fe("""
SELECT 1 AS version, start_hour, station_id, total_trips, lag_28 FROM features WHERE hour < 12
UNION ALL
SELECT 2, start_hour, station_id, CASE WHEN hour < 12 THEN total_trips ELSE total_trips + 1 END, lag_28 FROM features"""))
def q_load_features(spark, d):
    """The feature table in two versions: the second adds hours and leaves the first as it was."""
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    feats = _features(spark, d)
    keys = ["start_hour", "station_id"]
    tables.upsert(spark, path, feats.filter("hour < 12"), keys, "start_hour")
    tables.upsert(spark, path, feats.filter("hour >= 12").withColumn("total_trips", F.col("total_trips") + 1), keys, "start_hour")
    first, second = (tables.load_features(spark, path, v).withColumn("version", F.lit(v)) for v in (1, 2))
    return first.unionByName(second).select("version", "start_hour", "station_id", "total_trips", "lag_28")


@register("incremental_popularity", O.T("""
SELECT start_station_id AS station_id, count(*) AS trips FROM trips WHERE start_station_id IS NOT NULL GROUP BY 1"""))
def q_incremental_popularity(spark, d):
    """Trips land month by month; each run counts the months that the stored counts lack and adds all up."""
    from velocube.sources.tables import write_bronze
    root = scratch_path(spark, f"popularity-{uuid.uuid4().hex}")
    t = _trips(spark, d).withColumn("landed_at", F.timestamp_add("DAY", 30 * (F.dayofmonth("started_at") % 6), "started_at"))
    late = F.dayofmonth("started_at") % 6 >= 3
    write_bronze(t.filter(~late), f"{root}/bronze", "landed_at")
    A.update_popularity(spark, f"{root}/bronze", f"{root}/counts")
    write_bronze(t.filter(late), f"{root}/bronze", "landed_at", mode="append")
    return A.update_popularity(spark, f"{root}/bronze", f"{root}/counts")


@register("read_predictions", O.forecast_sql(FORECAST_SPEC, AS_OF, """
SELECT station_id, station_rank, target_hour, round(predicted_trips, 6) AS predicted_trips FROM preds"""))
def q_read_predictions(spark, d):
    """A forecast table with its columns in another order and one more, read by name."""
    path = scratch_path(spark, f"predictions-{uuid.uuid4().hex}")
    pred = FC.with_generated_at(_forecast(spark, d), "2024-02-19 13:00:00").withColumn("extra", F.lit("x"))
    pred.select(*pred.columns[::-1]).write.parquet(path)
    out = tables.read_predictions(spark, path)
    return out.select("station_id", "station_rank", VF.as_naive("target_hour").alias("target_hour"), r6("predicted_trips").alias("predicted_trips"))


@register("metrics_json", O.Sp("""
SELECT round_even(avg(abs(total_trips - predicted)), 4) AS mae, round_even(sqrt(avg(pow(total_trips - predicted, 2))), 4) AS rmse,
       round_even(sum(abs(total_trips - predicted)) / nullif(sum(total_trips), 0) * 100, 2) AS mape, NULL::DOUBLE AS champion_mae,
       (SELECT count(*) FROM train) AS n_train, count(*) AS n_test, 'Promoted' AS promotion_status FROM scored"""))
def q_metrics_json(spark, d):
    """The metrics record of a model, written as one JSON document and read back by its declared schema."""
    from datetime import datetime, timezone
    from velocube.plans.training import metrics_record
    path = scratch_path(spark, f"metrics-{uuid.uuid4().hex}")
    tr, te = _split(spark, d)
    errors = EV.error_metrics(EV.baseline_hour_mean(tr, te))
    shares = TR.split_counts(TR.node_rows(spark, ENSEMBLE), schemas.MODEL_INPUTS)
    record = metrics_record(errors, EV.promote(errors, None), tr.unionByName(te), shares, 1, 1, datetime.now(timezone.utc))
    tables.write_json_doc(record, path)
    names = ["mae", "rmse", "mape", "champion_mae", "n_train", "n_test", "promotion_status"]
    return tables.read_json_doc(spark, path, record.schema).select(*names)


@register("month_from_file", O.T("""
SELECT strftime(started_at + to_days(cast(30 * (day(started_at) % 4) AS INTEGER)), '%Y%m') AS month, count(*) AS trips
FROM trips GROUP BY 1"""))
def q_month_from_file(spark, d):
    """Trips exported as files named by month, and counted by the month in their names alone."""
    from velocube.functions import month_from_path
    from velocube.sources import versions
    path = scratch_path(spark, f"months-{uuid.uuid4().hex}")
    month = F.date_format(F.timestamp_add("DAY", 30 * (F.dayofmonth("started_at") % 4), "started_at"), "yyyyMM")
    _trips(spark, d).select("ride_id", month.alias("ym")).hint("rebalance", "ym").write.partitionBy("ym").option("header", True).csv(path)
    for ym in [f for f in versions.listed(spark, path) if f.startswith("ym=")]:  # months
        for k, part in enumerate(f for f in versions.listed(spark, f"{path}/{ym}") if f.startswith("part-")):
            versions.renamed(spark, f"{path}/{ym}/{part}", f"{path}/files/{ym[3:]}-tripdata_{k}.csv")
    rows = spark.read.schema("ride_id string").option("header", True).csv(f"{path}/files")
    return rows.groupBy(month_from_path(F.col("_metadata.file_path")).alias("month")).agg(F.count(F.lit(1)).alias("trips"))


@register("upcoming_fallback", _wsql("SELECT * FROM wide QUALIFY row_number() OVER (ORDER BY target_hour DESC) <= 24"))
def q_upcoming_fallback(spark, d):
    """All of the forecast lies before the time asked for: the last 24 hours are served instead."""
    return SV.upcoming(_wide(spark, d), "2031-01-01 00:00:00")


@register("parse_ts", """
SELECT event_id, date_trunc('millisecond', ts) AS from_millis, ts AS from_micros, date_trunc('second', ts) AS from_seconds,
       CAST(NULL AS TIMESTAMP) AS from_junk FROM events""")
def q_parse_ts(spark, d):
    """Wall clocks written with milliseconds, microseconds and whole seconds, and text that is none."""
    ev = adapters.load_table(spark, d, "events")
    text = lambda f: VF.parse_ts(F.date_format("ts", f))
    return ev.select("event_id", text("yyyy-MM-dd HH:mm:ss.SSS").alias("from_millis"), text("yyyy-MM-dd HH:mm:ss.SSSSSS").alias("from_micros"),
                     text("yyyy-MM-dd HH:mm:ss").alias("from_seconds"), VF.parse_ts(F.concat(F.lit("x"), "event_type")).alias("from_junk"))


@register("actual_vs_predicted", O.Fe(f"""
SELECT f.start_hour, f.station_id, f.total_trips, p.predicted, round(f.total_trips - p.predicted, 9) AS error
FROM features f JOIN (SELECT start_hour, station_id, round({O.tree_expr(ENSEMBLE, str)}, 9) AS predicted FROM features WHERE hour % 2 = 0) p
  USING (start_hour, station_id)"""))
def q_actual_vs_predicted(spark, d):
    """Predictions stored apart and joined to what was counted, by hour and station."""
    feats = _features(spark, d)
    pred = TR.score(feats.filter("hour % 2 = 0"), TR.node_rows(spark, ENSEMBLE)).select("start_hour", "station_id", F.round("predicted", 9).alias("predicted"))
    out = feats.select("start_hour", "station_id", "total_trips").join(pred, ["start_hour", "station_id"])
    return out.withColumn("error", F.round(F.col("total_trips") - F.col("predicted"), 9))


@register("publish_latest", O.forecast_sql(FORECAST_SPEC, AS_OF, """
SELECT station_id, station_rank, target_hour, round(predicted_trips, 6) AS predicted_trips,
       TIMESTAMP '2024-02-19 13:00:00' AS prediction_generated_at FROM preds"""))
def q_publish_latest(spark, d):
    """Two timestamped snapshots appended; the reader sees only the newest."""
    from velocube.sources.tables import latest, publish
    root = scratch_path(spark, f"predictions-{uuid.uuid4().hex}")
    pred = _forecast(spark, d)
    publish(FC.with_generated_at(pred.withColumn("predicted_trips", F.col("predicted_trips") * 2),
                                 "2024-02-19 12:00:00"), root)
    publish(FC.with_generated_at(pred, "2024-02-19 13:00:00"), root)
    out = latest(spark, root)
    return out.select("station_id", "station_rank", VF.as_naive("target_hour").alias("target_hour"),
                      r6("predicted_trips").alias("predicted_trips"),
                      VF.as_naive("prediction_generated_at").alias("prediction_generated_at"))


@register("read_stats_json", O.C("""
SELECT count(*) AS totalTrips, round_even(avg(duration_min), 1) AS avgDuration,
       round_even(avg(CASE WHEN member_casual = 'member' THEN 1.0 ELSE 0.0 END) * 100, 1) AS memberRatio,
       (SELECT hour FROM clean GROUP BY hour ORDER BY count(*) DESC, hour LIMIT 1) AS peakHour,
       (SELECT count(*) FROM (SELECT DISTINCT hour, member_casual FROM clean)) AS n_density,
       (SELECT count(*) FROM (SELECT route FROM (SELECT coalesce(start_station_name, '') || ' → ' ||
          coalesce(end_station_name, '') AS route FROM clean) r WHERE route <> ' → ' GROUP BY 1 LIMIT 10)) AS n_routes
FROM clean"""))
def q_read_stats_json(spark, d):
    """Monthly report written as one JSON document and read back with the
    declared schema."""
    from velocube.sources.tables import read_json_doc, write_json_doc
    path = scratch_path(spark, f"monthly-stats-{uuid.uuid4().hex}")
    write_json_doc(monthly_report(_clean(spark, d), None, "202401-tripdata.csv"), path)
    doc = read_json_doc(spark, path, schemas.MONTHLY_STATS)
    return doc.select("summary.totalTrips", "summary.avgDuration", "summary.memberRatio", "summary.peakHour",
                      F.size("hourlyDensity").cast("bigint").alias("n_density"),
                      F.size("topRoutes").cast("bigint").alias("n_routes"))


# ======================================================================= other tables (generality)
@register("order_cube", """
SELECT date_trunc('month', o_orderdate) AS month, o_orderpriority, o_orderstatus, count(*) AS count,
       round(sum(o_totalprice), 2) AS revenue
FROM orders WHERE o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL
GROUP BY 1, 2, 3""")
def q_order_cube(spark, d):
    o = adapters.load_table(spark, d, "orders")
    keys = [VF.trunc_ntz("o_orderdate", "month").alias("month"), "o_orderpriority",
            "o_orderstatus"]
    return (o.filter(F.col("o_orderdate").isNotNull() & F.col("o_orderpriority").isNotNull()
                     & F.col("o_orderstatus").isNotNull())
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.round(F.sum("o_totalprice"), 2).alias("revenue")))


@register("top_parts", """
SELECT l_partkey, sum(l_quantity) AS qty, cast(row_number() OVER (ORDER BY sum(l_quantity) DESC, l_partkey) - 1
       AS INTEGER) AS part_rank
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY qty DESC, l_partkey LIMIT 10""")
def q_top_parts(spark, d):
    li = adapters.load_table(spark, d, "lineitem")
    g = li.filter(F.col("l_partkey").isNotNull()).groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return A.rank_top(A.top_k(g, "qty", "l_partkey", 10), "qty", "l_partkey", "part_rank")


SEG_LAGS = ", ".join(f"lag(orders, {k}) OVER (PARTITION BY c_mktsegment ORDER BY day) AS lag_{k}" for k in range(1, 8))


@register("segment_lags", f"""
SELECT *, {SEG_LAGS} FROM (
  SELECT c_mktsegment, date_trunc('day', o_orderdate) AS day, count(*) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_mktsegment IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1, 2) s""")
def q_segment_lags(spark, d):
    """Daily orders per market segment with 7 lags (dimension join left to
    the planner: AQE broadcasts the customer side only when it is small)."""
    o = adapters.load_table(spark, d, "orders")
    c = adapters.load_table(spark, d, "customer")
    daily = (o.join(c, o.o_custkey == c.c_custkey)
             .filter(F.col("c_mktsegment").isNotNull() & F.col("o_orderdate").isNotNull())
             .groupBy("c_mktsegment", VF.trunc_ntz("o_orderdate", "day").alias("day"))
             .agg(F.count(F.lit(1)).alias("orders")))
    return FE.add_lags(daily, ["c_mktsegment"], "day", "orders", 7)


# ======================================================================= streaming

WM = "10 minutes"
CLOSED = f"""closed AS (
  SELECT max(started_at) - INTERVAL {WM} AS wm FROM trips
  WHERE start_station_id IS NOT NULL AND member_casual IS NOT NULL AND rideable_type IS NOT NULL)"""


def _stream_hourly_to(spark, d, root):
    ev = SJ.events_stream(spark, d)
    hourly = SJ.hourly_counts(adapters.trips_from_events(ev), WM)
    sink = f"{root}/hourly"
    SJ.run_available_now(hourly, None, f"{root}/ckpt-hourly",
                         foreach_batch=SJ.upsert_sink(sink, ["start_hour", "station_id"], "start_hour"))
    return sink


@register("stream_hourly", O.with_ctes("""
SELECT date_trunc('hour', started_at) AS start_hour, start_station_id AS station_id, count(*) AS total_trips
FROM trips, closed
WHERE start_station_id IS NOT NULL AND member_casual IS NOT NULL AND rideable_type IS NOT NULL
  AND date_trunc('hour', started_at) + INTERVAL 1 HOUR <= wm
GROUP BY 1, 2""", O.TRIPS, CLOSED))
def q_stream_hourly(spark, d):
    """Watermarked hourly window counts per station, upserted per micro-batch."""
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    sink = _stream_hourly_to(spark, d, root)
    return tables.read_table(spark, sink).select("start_hour", "station_id", "total_trips")


@register("stream_popularity", O.T("""
SELECT start_station_id AS station_id, count(*) AS trips FROM trips WHERE start_station_id IS NOT NULL GROUP BY 1"""))
def q_stream_popularity(spark, d):
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    ev = SJ.events_stream(spark, d)
    pop = SJ.popularity(adapters.trips_from_events(ev))

    def overwrite(batch, epoch_id):
        batch.write.mode("overwrite").parquet(f"{root}/popularity")
    SJ.run_available_now(pop, None, f"{root}/ckpt-pop", mode="complete", foreach_batch=overwrite)
    return spark.read.parquet(f"{root}/popularity")


STREAM_LAGS = ", ".join(f"lag(total_trips, {k}) OVER (PARTITION BY station_id ORDER BY start_hour) AS lag_{k}"
                        for k in range(1, 29))


@register("stream_lags", O.with_ctes(f"""
SELECT * FROM (SELECT *, {STREAM_LAGS} FROM hourly) l WHERE {O.LAG_NN}""", O.TRIPS, CLOSED, """hourly AS (
  SELECT date_trunc('hour', started_at) AS start_hour, start_station_id AS station_id, count(*) AS total_trips
  FROM trips, closed
  WHERE start_station_id IS NOT NULL AND member_casual IS NOT NULL AND rideable_type IS NOT NULL
    AND date_trunc('hour', started_at) + INTERVAL 1 HOUR <= wm
  GROUP BY 1, 2)"""))
def q_stream_lags(spark, d):
    """Second stage: closed hours are appended to a folder that nothing
    rewrites; it is read as a file stream, and a per-station state of the
    last 28 counts emits feature rows."""
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    closed = SJ.hourly_counts(adapters.trips_from_events(SJ.events_stream(spark, d)), WM)
    SJ.run_available_now(closed, f"{root}/hourly", f"{root}/ckpt-hourly")
    hourly = spark.readStream.schema("start_hour timestamp_ntz, station_id string, total_trips long").parquet(f"{root}/hourly")
    lags = SJ.rolling_lags(hourly)
    SJ.run_available_now(lags, f"{root}/lags", f"{root}/ckpt-lags")
    return spark.read.parquet(f"{root}/lags")


# ======================================================================= remaining small operators
@register("time_labels", O.T("""
SELECT DISTINCT date_trunc('hour', started_at) AS start_hour,
       strftime(date_trunc('hour', started_at), '%I:%M %p') AS label_12h,
       strftime(date_trunc('hour', started_at), '%I %p') AS label_hour,
       strftime(date_trunc('hour', started_at), '%Y-%m-%dT%H:%M:%SZ') AS label_iso,
       strftime(date_trunc('hour', started_at), '%Y%m%d_%H%M') AS label_stamp FROM trips"""))
def q_time_labels(spark, d):
    h = _trips(spark, d).select(VF.hour_bucket("started_at").alias("start_hour")).distinct()
    return h.select("start_hour", VF.time_label("start_hour", "12h").alias("label_12h"),
                    VF.time_label("start_hour", "hour").alias("label_hour"),
                    VF.time_label("start_hour", "iso_z").alias("label_iso"),
                    VF.time_label("start_hour", "stamp").alias("label_stamp"))


@register("nonzero_coords", O.C("""
SELECT start_station_name, start_lat AS lat, start_lng AS lng, count(*) AS count FROM clean
WHERE start_station_name IS NOT NULL AND start_lat IS NOT NULL AND start_lng IS NOT NULL
  AND start_lat <> 0 AND start_lng <> 0 GROUP BY 1, 2, 3"""))
def q_nonzero_coords(spark, d):
    g = A.geo_points(_clean(spark, d)).select("start_station_name", F.col("start_lat").alias("lat"),
                                              F.col("start_lng").alias("lng"), "count")
    return CL.nonzero_coords(g)


@register("hour_mean", O.Fe("SELECT hour, round(avg(total_trips), 6) AS hour_mean FROM features GROUP BY 1"))
def q_hour_mean(spark, d):
    return A.hour_mean(_features(spark, d)).select("hour", r6("hour_mean").alias("hour_mean"))


@register("volume_series", O.Fe("SELECT start_hour, sum(total_trips)::BIGINT AS total_trips FROM series GROUP BY 1"))
def q_volume_series(spark, d):
    counts = A.station_hour_counts(_trips(spark, d))
    pop = counts.groupBy("station_id").agg(F.sum("count").alias("trips"))
    s = FE.station_hourly(counts, A.top_stations(pop, 3))
    return A.rollup_sum(s, ["start_hour"], "total_trips", "total_trips").orderBy("start_hour")


@register("train_gbt_lags")
def q_train_gbt_lags(spark, d):
    """Lag-only regressor (no calendar inputs), scored on the test split."""
    tr, te = _split(spark, d)
    model, _ = M.train_gbt(tr, None, cats=(), max_iter=NOTEBOOK_ROUNDS, early_stop=False)
    return EV.error_metrics(M.score(model, te, schemas.LAG_COLS))


@register("train_gbt_multi")
def q_train_gbt_multi(spark, d):
    """Multi-feature regressor (lags, calendar and rank), no early stop, scored on the test split."""
    tr, te = _split(spark, d)
    model, _ = M.train_gbt(tr, None, max_iter=NOTEBOOK_ROUNDS, early_stop=False)
    return EV.error_metrics(M.score(model, te, schemas.MODEL_INPUTS))


@register("train_reduced")
def q_train_reduced(spark, d):
    """Feature-reduced regressor on the 10 most important lags."""
    tr, te = _split(spark, d)
    full, _ = M.train_gbt(tr, None, cats=(), max_iter=NOTEBOOK_ROUNDS, early_stop=False)
    reduced, keep = M.train_reduced(full, tr, None, 10, max_iter=NOTEBOOK_ROUNDS)
    return EV.error_metrics(M.score(reduced, te, keep)).withColumn("features", F.lit(",".join(keep)))


BRONZE_AS_OF = "2024-02-15"


@register("bronze_last_months", O.T("""
SELECT strftime(started_at, '%Y%m') AS ym, start_station_id, count(*) AS trips,
       round(sum(date_diff('microsecond', started_at, ended_at) / cast(60000000 AS DOUBLE)), 6) AS minutes
FROM trips WHERE strftime(started_at, '%Y%m') IN (""" + ", ".join(
    f"'{m}'" for m in months_before(BRONZE_AS_OF, 12))
    + """) AND start_station_id IS NOT NULL AND member_casual = 'member'
GROUP BY 1, 2"""))
def q_bronze_last_months(spark, d):
    """Trips landed once as month-partitioned Parquet, then the last 12
    months before ``as_of`` read back with partition pruning and a pushed
    filter (member trips per station and month)."""
    from velocube.sources.tables import read_bronze, write_bronze
    path = scratch_path(spark, f"bronze-{uuid.uuid4().hex}")
    write_bronze(_trips(spark, d), path)
    t = read_bronze(spark, path, months_before(BRONZE_AS_OF, 12))
    t = t.filter((F.col("member_casual") == "member") & F.col("start_station_id").isNotNull())
    return t.groupBy("ym", "start_station_id").agg(
        F.count(F.lit(1)).alias("trips"),
        r6(F.sum(VF.duration_min("started_at", "ended_at"))).alias("minutes"))


@register("forecast_linear_model")
def q_forecast_linear_model(spark, d):
    """Linear regression fitted with Spark ML on the training split, then
    bridged and forecast by the JVM fold (no Python per step)."""
    tr, _ = _split(spark, d)
    lr = M.train_linear(tr)
    spec = FC.LinearSpec.from_model(lr.stages[-1].coefficients.toArray(), lr.stages[-1].intercept)
    return _fc_out(FC.forecast_linear(FE.latest_state(_features(spark, d)), spec, AS_OF))


@register("monthly_report_flat", O.C("""
SELECT 'summary' AS section, 'totalTrips' AS k1, NULL::VARCHAR AS k2, count(*) AS count, NULL::DOUBLE AS x,
       NULL::DOUBLE AS y FROM clean
UNION ALL SELECT 'summary', 'avgDuration', NULL, NULL, round_even(avg(duration_min), 1), NULL FROM clean
UNION ALL SELECT 'summary', 'memberRatio', NULL, NULL,
       round_even(avg(CASE WHEN member_casual = 'member' THEN 1.0 ELSE 0.0 END) * 100, 1), NULL FROM clean
UNION ALL SELECT 'summary', 'peakHour', NULL,
       (SELECT hour FROM clean GROUP BY hour ORDER BY count(*) DESC, hour LIMIT 1), NULL, NULL
UNION ALL SELECT 'hourlyDensity', cast(hour AS VARCHAR), member_casual, count(*), NULL, NULL FROM clean
  WHERE member_casual IS NOT NULL GROUP BY hour, member_casual
UNION ALL SELECT 'rideableData', rideable_type, NULL, count(*), NULL, NULL FROM clean
  WHERE rideable_type IS NOT NULL GROUP BY rideable_type
UNION ALL SELECT 'durationData', cast(bin AS VARCHAR) || '-' || cast(bin + 5 AS VARCHAR), member_casual, count(*),
       NULL, NULL FROM (SELECT cast(least(floor(duration_min / 5) * 5, 60) AS INTEGER) AS bin, member_casual
                        FROM clean) b WHERE member_casual IS NOT NULL GROUP BY bin, member_casual
UNION ALL SELECT 'topRoutes', route, NULL, count, NULL, NULL FROM (
  SELECT route, count(*) AS count FROM (SELECT coalesce(start_station_name, '') || ' → ' ||
         coalesce(end_station_name, '') AS route FROM clean) r
  WHERE route <> ' → ' GROUP BY 1 ORDER BY count DESC, route LIMIT 10) t
UNION ALL SELECT 'geoData', start_station_name, NULL, count, lat, lng FROM (
  SELECT * FROM (
    SELECT start_station_name,
           first(start_lat ORDER BY started_at, ride_id) FILTER (WHERE start_lat IS NOT NULL) AS lat,
           first(start_lng ORDER BY started_at, ride_id) FILTER (WHERE start_lng IS NOT NULL) AS lng,
           count(started_at) AS count
    FROM clean WHERE start_station_name IS NOT NULL GROUP BY 1) g
  WHERE lat IS NOT NULL AND lng IS NOT NULL ORDER BY count DESC, start_station_name LIMIT 500) gg
UNION ALL SELECT 'topStations', start_station_name, NULL, count, NULL, NULL FROM (
  SELECT start_station_name, count(*) AS count FROM clean WHERE start_station_name IS NOT NULL
  GROUP BY 1 ORDER BY count DESC, 1 LIMIT 10) s"""))
def q_monthly_report_flat(spark, d):
    """The whole assembled report (one GROUPING SETS pass), flattened."""
    from velocube.plans.report import flatten_report
    report = monthly_report(_clean(spark, d), None, "202401-tripdata.csv")
    return flatten_report(report.checkpoint(eager=True))  # one row, read by seven branches


@register("clean_counts", O.T("""
SELECT count(*) AS rows_loaded,
       count(*) FILTER (WHERE date_diff('microsecond', started_at, ended_at) / cast(60000000 AS DOUBLE) > 1
                          AND date_diff('microsecond', started_at, ended_at) / cast(60000000 AS DOUBLE) < 240
                          AND started_at IS NOT NULL) AS rows_clean
FROM trips"""))
def q_clean_counts(spark, d):
    """Rows loaded and rows kept by the cleaning rule, in one pass."""
    t = CL.with_duration(_trips(spark, d))
    d_ = F.col("duration_min")
    keep = (d_ > CL.MIN_DURATION) & (d_ < CL.MAX_DURATION) & F.col("started_at").isNotNull()
    return t.agg(F.count(F.lit(1)).alias("rows_loaded"), F.count_if(keep).alias("rows_clean"))
