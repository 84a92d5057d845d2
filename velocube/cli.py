"""Command line for the scheduled jobs (features monthly, training monthly,
inference hourly), each a thin wrapper over ``velocube.plans``.

    python -m velocube.cli features --trips <csv dir or bronze> --features <path> [--report <path>]
    python -m velocube.cli train --features <path> --runs <path> --models <path> [--rounds 1000] [--metrics <path>]
    python -m velocube.cli infer --features <path> --runs <path> --out <path> [--as-of ISO]

Paths may be any Spark-readable URI; the session (cluster settings,
``spark.checkpoint.dir``) comes from ``spark-submit``.
"""
from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from velocube.session import get_spark


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="velocube")
    sub = p.add_subparsers(dest="job", required=True)
    f = sub.add_parser("features")
    f.add_argument("--trips", required=True, help="directory of trip CSVs, or a bronze Parquet table")
    f.add_argument("--format", choices=["csv", "bronze", "events"], default="csv")
    f.add_argument("--features", required=True)
    f.add_argument("--report")
    f.add_argument("--report-month", help="yyyyMM of the report (default: newest month)")
    f.add_argument("--months", type=int, help="keep the N whole months before --as-of (US/Eastern now)")
    f.add_argument("--as-of", help="ISO date for --months (default: now on the US/Eastern clock)")
    t = sub.add_parser("train")
    t.add_argument("--features", required=True)
    t.add_argument("--runs", required=True)
    t.add_argument("--models", required=True)
    t.add_argument("--rounds", type=int, default=1000)
    t.add_argument("--metrics", help="write the metrics record there as one JSON document")
    i = sub.add_parser("infer")
    i.add_argument("--features", required=True)
    i.add_argument("--runs", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--as-of", help="ISO time (UTC); default now")
    a = p.parse_args(argv)

    spark = get_spark(app=f"velocube-{a.job}")
    if a.job == "features":
        from pyspark.sql import functions as F
        from velocube.plans.feature_job import run_features
        from velocube.sources import adapters, tables, trips as T
        months = None
        if a.months:
            as_of = a.as_of or spark.range(1).select(tables.eastern_now().cast("string")).first()[0]
            months = tables.months_before(as_of, a.months)
        if a.format == "csv":
            trips = T.read_trips(spark, a.trips)
        elif a.format == "bronze":
            trips = tables.read_bronze(spark, a.trips, months).drop("ym")  # partition pruning
        else:
            trips = adapters.trips_from_events(spark.read.parquet(a.trips))
        if months and a.format != "bronze":
            trips = trips.filter(F.date_format("started_at", "yyyyMM").isin(months))
        if trips.isEmpty():  # nothing landed for the window: abort without touching the tables
            print(json.dumps({"job": "features", "rows": 0, "status": "no data"}))
            return
        month = a.report_month
        if a.report and not month:
            month = trips.agg(F.date_format(F.max("started_at"), "yyyyMM")).first()[0]
        n = run_features(spark, trips, a.features, a.report, month).count()
        print(json.dumps({"job": "features", "rows": n, "report_month": month}))
    elif a.job == "train":
        from velocube.plans.training import run_training
        from velocube.sources import tables
        feats = tables.read_table(spark, a.features).drop("month_key")
        rec = run_training(spark, feats, a.runs, a.models, max_iter=a.rounds, metrics_path=a.metrics).first().asDict(recursive=True)
        print(json.dumps(rec, default=str))
    else:
        from velocube.plans.inference import run_inference
        from velocube.sources import tables
        as_of = a.as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        feats = tables.read_table(spark, a.features).drop("month_key")
        out = run_inference(spark, feats, a.runs, a.out, as_of)
        print(json.dumps({"job": "infer", "rows": 0 if out is None else out.count(), "as_of": as_of}))


if __name__ == "__main__":
    main()
