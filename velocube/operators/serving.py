"""Serving-side shaping of the forecast table: wide pivot with total,
from-now filter with fallback, rush hours/window, summary, station labels.
Inputs are forecast tables (stations x horizon rows); the plans are still
written without single-partition windows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from velocube.functions import hour_bucket, round_js, to_eastern
from velocube.operators.ordering import attach_group_stats

RUSH_FACTOR = 1.25  # fixed value: rush = demand above 1.25 x the mean


def rounded(pred: DataFrame) -> DataFrame:
    """Per-station values as served: half-up to one decimal."""
    return pred.withColumn("predicted_trips", round_js("predicted_trips", 1))


def _last(pred: DataFrame) -> Column:
    """The served value of a (hour, station): of repeated rows the one generated last."""
    if "prediction_generated_at" in pred.columns:
        return F.max_by("predicted_trips", "prediction_generated_at")
    return F.max("predicted_trips")


def forecast_wide(pred: DataFrame) -> DataFrame:
    """One row per target hour, one column per station rank in the data
    (``station_0`` ...), and ``total_trips`` = rounded sum of what is shown."""
    p = rounded(pred)
    ranks = [r[0] for r in p.select("station_rank").distinct().orderBy("station_rank").collect()]  # a forecast's stations
    p = p.groupBy("target_hour", "station_rank").agg(_last(p).alias("predicted_trips"))
    wide = p.groupBy("target_hour").pivot("station_rank", ranks).agg(F.max("predicted_trips"))
    wide = wide.select("target_hour", *[F.col(str(i)).alias(f"station_{i}") for i in ranks])
    tot = p.groupBy("target_hour").agg(round_js(F.sum("predicted_trips"), 1).alias("total_trips"))
    return wide.join(tot, "target_hour").withColumn("target_hour_et", to_eastern("target_hour"))


def stations(df: DataFrame) -> DataFrame:
    """The distinct stations of a feature or forecast table with their rank."""
    return df.groupBy("station_id").agg(F.min("station_rank").alias("station_rank"))


def upcoming(df: DataFrame, as_of, ts: str = "target_hour", n: int = 24, floor_hour: bool = False) -> DataFrame:
    """Rows at or after ``as_of``; when there are none, the last ``n`` rows.
    The fallback is a top-n (bounded), the emptiness test a one-row aggregate."""
    now = F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of
    if floor_hour:
        now = hour_bucket(now)
    future = df.filter(F.col(ts) >= now)
    flag = df.agg(F.max((F.col(ts) >= now).cast("int")).alias("_any"))
    tail = df.orderBy(F.col(ts).desc()).limit(n)
    tail = attach_group_stats(tail, flag, []).filter(F.coalesce(F.col("_any"), F.lit(0)) == 0).drop("_any")
    return future.unionByName(tail)


def rush_hours(df: DataFrame, value: str = "total_trips", factor: float = RUSH_FACTOR) -> DataFrame:
    """Rows whose value exceeds ``factor`` x the mean (one-row mean joined)."""
    m = df.agg(F.avg(value).alias("_mean"))
    return attach_group_stats(df, m, []).filter(F.col(value) > factor * F.col("_mean")).drop("_mean")


def rush_window(df: DataFrame, ts: str = "target_hour", value: str = "total_trips") -> DataFrame:
    r = rush_hours(df, value)
    return r.agg(F.min(ts).alias("rush_start"), F.max(ts).alias("rush_end"), F.count(F.lit(1)).alias("rush_hours"))


def forecast_summary(df: DataFrame, ts: str = "target_hour", value: str = "total_trips") -> DataFrame:
    """Live value (earliest hour), peak value, first hour reaching the peak,
    mean (half-up, one decimal)."""
    first_max = F.max_by(F.col(ts), F.struct(F.col(value), -F.unix_micros(F.col(ts).cast("timestamp"))))
    return df.agg(F.min_by(value, ts).alias("live"), F.max(value).alias("peak"),
                  first_max.alias("peak_hour"), round_js(F.avg(value), 1).alias("avg_demand"))


def label_stations(pred: DataFrame, names: DataFrame) -> DataFrame:
    """Attach station names (id as fallback).  ``names`` is a per-station
    table; the join is left so unmatched stations keep their id."""
    return (pred.join(names, "station_id", "left")
            .withColumn("station_name", F.coalesce("station_name", "station_id")))
