"""Monthly dashboard report as one nested row (and its JSON text).

Counts roll up from a small cube (hour x class x bike x bin); stations and routes are hash aggregates of their own.
Every piece is bounded by construction (24 hours x 2 classes, bike types,
13 bins x 2, top 10, top 500) before it is folded into an array of structs
with ``collect_list``; the pieces are joined as one-row tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from velocube.operators import aggregates as A
from velocube.operators.ordering import attach_group_stats


def _arr(df: DataFrame, name: str, fields: list, sort_by: list) -> DataFrame:
    s = F.struct(*[F.struct(*sort_by).alias("_k")] + fields)
    return df.agg(F.array_sort(F.collect_list(s)).alias("_a")).select(
        F.transform("_a", lambda e: e.dropFields("_k")).alias(name))


def report_cells(clean: DataFrame, width: int = 5, cap: int = 60) -> DataFrame:
    """Trips and their minutes per (hour, rider class, bike type, duration bin): a cube of bounded size that every count
    over these rolls up from."""
    from velocube.functions import duration_bin
    return (clean.withColumn("bin", duration_bin("duration_min", width, cap))
            .groupBy("hour", "member_casual", "rideable_type", "bin")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("duration_min").alias("minutes")))


def monthly_report(clean: DataFrame, top_station_names: DataFrame | None = None,
                   file_name: str = "", width: int = 5, cap: int = 60) -> DataFrame:
    """The report row: summary, top-station names, hourly density, bike
    types, duration histogram, top routes, station geo, top stations."""
    from velocube.functions import bin_label, round_py
    from velocube.session import checkpoint_dir
    checkpoint_dir(clean.sparkSession)
    # three hash aggregates, each over the columns it needs; the grouped counts are materialised once and every piece
    # reads them
    cells = report_cells(clean, width, cap).checkpoint(eager=True)
    places = A.first_places(clean).checkpoint(eager=True)
    sums = lambda *keys: cells.dropna(subset=list(keys)).groupBy(*keys).agg(F.sum("count").alias("count"))
    tot = cells.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"), F.try_divide(F.sum("minutes"), F.sum("count")).alias("avg_duration"),
                    F.try_divide(F.sum(F.when(F.col("member_casual") == "member", F.col("count")).otherwise(0)), F.sum("count")).alias("member_share"))
    peak = sums("hour").agg(
        F.max_by("hour", F.struct(F.col("count"), -F.col("hour"))).cast("int").alias("peakHour"))
    s = attach_group_stats(tot, peak, []).select(F.struct(
        F.col("count").alias("totalTrips"), round_py("avg_duration", 1).alias("avgDuration"),
        round_py(F.col("member_share") * 100, 1).alias("memberRatio"), F.col("peakHour"),
        F.lit(file_name).alias("fileName")).alias("summary"))
    hd = _arr(sums("hour", "member_casual"), "hourlyDensity",
              [F.col("hour"), F.col("member_casual").alias("type"), F.col("count")],
              [F.col("hour"), F.col("member_casual")])
    rd = _arr(sums("rideable_type"), "rideableData",
              [F.col("rideable_type").alias("type"), F.col("count")],
              [(-F.col("count")).alias("c"), F.col("rideable_type")])
    dh = _arr(sums("bin", "member_casual"), "durationData",
              [F.col("bin"), bin_label("bin", width).alias("binLabel"), F.col("member_casual").alias("type"),
               F.col("count")], [F.col("bin"), F.col("member_casual")])
    tr = _arr(A.top_routes(clean, 10), "topRoutes", [F.col("route"), F.col("count")],
              [(-F.col("count")).alias("c"), F.col("route")])
    geo = A.top_k(places.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()), "count", "start_station_name", 500)
    geo = _arr(geo, "geoData", [F.col("start_station_name").alias("station"), F.col("lat"), F.col("lng"),
                                F.col("count")], [(-F.col("count")).alias("c"), F.col("start_station_name")])
    ts = _arr(A.top_k(places, "trips", "start_station_name", 10), "topStations",
              [F.col("start_station_name").alias("station"), F.col("trips").alias("count")],
              [(-F.col("trips")).alias("c"), F.col("start_station_name")])
    if top_station_names is not None:
        nm = top_station_names.agg(F.map_from_entries(F.collect_list(
            F.struct("station_id", "station_name"))).alias("topStationNames"))
    else:
        nm = s.select(F.create_map().cast("map<string,string>").alias("topStationNames"))
    out = s
    for piece in (nm, hd, rd, dh, tr, geo, ts):
        out = attach_group_stats(out, piece, [])
    return out.select("summary", "topStationNames", "hourlyDensity", "rideableData", "durationData",
                      "topRoutes", "geoData", "topStations")


def report_json(report: DataFrame) -> DataFrame:
    return report.select(F.to_json(F.struct(*report.columns)).alias("json"))


def flatten_report(report: DataFrame) -> DataFrame:
    """The report row as a long table (section, k1, k2, count, x, y): one
    row per array element plus the summary fields - for checks and tabular
    consumers."""
    def arr(col: str, k1, k2=None, count="count", x=None, y=None) -> DataFrame:
        e = report.select(F.explode(col).alias("e"))
        return e.select(F.lit(col).alias("section"), k1.cast("string").alias("k1"),
                        (k2 if k2 is not None else F.lit(None)).cast("string").alias("k2"),
                        F.col(f"e.{count}").cast("long").alias("count"),
                        (x if x is not None else F.lit(None)).cast("double").alias("x"),
                        (y if y is not None else F.lit(None)).cast("double").alias("y"))
    s = report.select("summary.*")
    def field(name, count=None, x=None):
        return F.struct(F.lit(name).alias("k1"),
                        (count if count is not None else F.lit(None)).cast("long").alias("count"),
                        (x if x is not None else F.lit(None)).cast("double").alias("x"))
    summary = s.select(F.inline(F.array(
        field("totalTrips", count=F.col("totalTrips")), field("avgDuration", x=F.col("avgDuration")),
        field("memberRatio", x=F.col("memberRatio")), field("peakHour", count=F.col("peakHour")))))
    summary = summary.select(F.lit("summary").alias("section"), "k1", F.lit(None).cast("string").alias("k2"),
                             "count", "x", F.lit(None).cast("double").alias("y"))
    parts = [summary,
             arr("hourlyDensity", F.col("e.hour"), F.col("e.type")),
             arr("rideableData", F.col("e.type")),
             arr("durationData", F.col("e.binLabel"), F.col("e.type")),
             arr("topRoutes", F.col("e.route")),
             arr("geoData", F.col("e.station"), None, "count", F.col("e.lat"), F.col("e.lng")),
             arr("topStations", F.col("e.station"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
