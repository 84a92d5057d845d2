"""Feature job: trips -> feature table (+ monthly report JSON).

One lazy plan over all input files; the trips are aggregated once to
(hour, station) counts which feed popularity, the top-k and the series.
The feature table is written partitioned by month (``month_key``) so that
monthly re-runs rewrite only the touched partitions (``tables.upsert``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from velocube.operators import aggregates as A
from velocube.operators import clean as CL
from velocube.operators import features as FE
from velocube.plans.report import monthly_report
from velocube.session import checkpoint_dir
from velocube.sources import tables


def run_features(spark: SparkSession, trips: DataFrame, features_path: str, report_path: str | None = None,
                 report_month: str | None = None, k: int = 3, n: int = 28) -> DataFrame:
    checkpoint_dir(spark)
    counts = A.station_hour_counts(trips).checkpoint(eager=True)  # hours x stations x 2 rows, computed once
    feats = FE.build_features(trips, k, n, counts=counts)
    if feats.isEmpty():  # no station has more than n hours: leave the table as it is
        return feats
    keyed = feats.withColumn("month_key", F.date_format("start_hour", "yyyyMM"))
    tables.upsert(spark, features_path, keyed, ["start_hour", "station_id"], "start_hour", "month_key")
    if report_path:
        clean = CL.clean_trips(trips)
        if report_month:
            clean = clean.filter(F.date_format("started_at", "yyyyMM") == report_month)
        names = A.top_names(trips, k, counts.groupBy("station_id").agg(F.sum("count").alias("trips")))
        rep = monthly_report(clean, names, f"{report_month or ''}-tripdata.csv")
        tables.write_json_doc(rep, report_path)
    return tables.read_table(spark, features_path)
