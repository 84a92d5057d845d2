from datetime import datetime

from pyspark.sql import functions as F

from velocube import functions as VF
from velocube.operators import clean as CL
from tests.conftest import trips_df


def test_duration_bounds_open_interval(spark):
    base = datetime(2024, 1, 1, 8, 0, 0)
    mins = [0.5, 1.0, 1.0001, 239.99, 240.0, None, -3.0]
    rows = []
    for i, m in enumerate(mins):
        end = None if m is None else base + __import__("datetime").timedelta(minutes=m)
        rows.append({"ride_id": str(i), "started_at": base, "ended_at": end})
    kept = CL.clean_trips(trips_df(spark, rows)).select("ride_id").toPandas()["ride_id"].tolist()
    assert sorted(kept) == ["2", "3"]


def test_calendar_monday_zero(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5),), (datetime(2024, 1, 6, 5),), (datetime(2024, 1, 7, 5),)],
                               "ts timestamp_ntz")
    out = df.select(VF.day_of_week("ts").alias("d"), VF.is_weekend("ts").alias("w"),
                    VF.hour_of_day("ts").alias("h"), VF.month_of_year("ts").alias("m")).collect()
    assert [(r.d, r.w) for r in out] == [(0, 0), (5, 1), (6, 1)]
    assert out[0].h == 5 and out[0].m == 1


def test_rounding_half_even_vs_half_up(spark):
    r = spark.range(1).select(VF.round_py(F.lit(0.25), 1).alias("py"), VF.round_js(F.lit(0.25), 1).alias("js"),
                              VF.clamp0(F.lit(-2.0)).alias("c")).first()
    assert r.py == 0.2 and r.js == 0.3 and r.c == 0.0


def test_duration_bins_and_label(spark):
    df = spark.createDataFrame([(4.99,), (5.0,), (64.2,), (200.0,)], "x double")
    out = df.select(VF.duration_bin("x").alias("b")).withColumn("l", VF.bin_label("b")).collect()
    assert [r.b for r in out] == [0, 5, 60, 60]
    assert out[-1].l == "60-65"


def test_to_eastern_dst_edges(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 7),), (datetime(2024, 11, 3, 5),), (datetime(2024, 11, 3, 6),)],
                               "ts timestamp_ntz")
    out = [r.e for r in df.select(VF.to_eastern("ts").alias("e")).collect()]
    assert out[0] == datetime(2024, 3, 10, 3)
    assert out[1] == datetime(2024, 11, 3, 1) and out[2] == datetime(2024, 11, 3, 1)


def test_epoch_units(spark):
    df = spark.createDataFrame([(1704067200000,), (1704067200000000,)], "n long")
    out = [r.t for r in df.select(VF.resolve_epoch("n").cast("timestamp_ntz").alias("t")).collect()]
    assert out[0] == out[1] == datetime(2024, 1, 1)


def test_route_keys(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, "B"), (None, None)], "a string, b string")
    out = df.select(VF.route("a", "b").alias("r"), VF.route_strict("a", "b").alias("s")).collect()
    assert [r.r for r in out] == ["A → B", "A → ", " → B", " → "]
    assert [r.s for r in out] == ["A to B", None, None, None]


def test_short_label(spark):
    df = spark.createDataFrame([("x" * 40,), ("y" * 41,)], "s string")
    out = [r.l for r in df.select(VF.short_label("s").alias("l")).collect()]
    assert out[0] == "x" * 40 and out[1] == "y" * 37 + "..."


def test_parse_ts_lenient(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("bad",)], "s string")
    out = [r.t for r in df.select(VF.parse_ts("s").alias("t")).collect()]
    assert out == [datetime(2024, 1, 1, 10), None]


def test_hour_bucket_ignores_session_zone(spark):
    """Wall-clock buckets must not move with the session zone (DST gap hour)."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30),)], "ts timestamp_ntz")
        r = df.select(VF.hour_bucket("ts").alias("h"), VF.trunc_ntz("ts", "day").alias("d"),
                      VF.trunc_ntz("ts", "month").alias("m")).first()
        assert r.h == datetime(2024, 3, 10, 2) and r.d == datetime(2024, 3, 10) and r.m == datetime(2024, 3, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
