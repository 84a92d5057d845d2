"""Driver tables -> trip table.

The test data carries no trip table; ``events`` is mapped onto the trip
schema with a fixed, documented rule so that every operator runs on a real,
growing input.  The same rule exists as DuckDB SQL in ``velocube.oracle``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

N_STATIONS = 20


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_from_events(events: DataFrame) -> DataFrame:
    """Map the ``events`` table onto the trip schema (see SURVEY §7.2)."""
    k = F.get_json_object("props", "$.k").try_cast("int")  # malformed props -> NULL, not a failed job
    uid = F.col("user_id") % N_STATIONS
    sid = F.lpad(uid.cast("string"), 2, "0")
    end_sid = F.lpad((F.col("_k") % N_STATIONS).cast("string"), 2, "0")
    has_start = (F.col("_k") % 23) != 0
    has_end = (F.col("_k") % 17) != 0
    has_geo = (F.col("_k") % 31) != 0
    return (events
            .withColumn("_k", k)
            .select(
                F.col("event_id").cast("string").alias("ride_id"),
                F.col("ts").alias("started_at"),
                F.timestamp_add("MICROSECOND", F.round(F.col("value") * 60000000).cast("long"),
                                F.col("ts")).alias("ended_at"),
                F.when(F.col("user_id") % 3 == 0, "casual").otherwise("member").alias("member_casual"),
                F.when(F.col("event_type").isin("click", "view"), "classic_bike")
                 .otherwise("electric_bike").alias("rideable_type"),
                F.when(has_start, F.concat(F.lit("S"), sid)).alias("start_station_id"),
                F.when(has_start, F.concat(F.lit("Station "), sid)).alias("start_station_name"),
                F.when(has_end, F.concat(F.lit("Station "), end_sid)).alias("end_station_name"),
                F.when(has_geo, F.lit(40.70) + F.lit(0.001) * uid).alias("start_lat"),
                F.when(has_geo, F.lit(-74.00) + F.lit(0.001) * uid).alias("start_lng"),
            ))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(load_table(spark, sf_dir, "events"))
