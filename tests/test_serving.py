from datetime import datetime, timedelta

from velocube.operators import serving as SV

T0 = datetime(2024, 1, 1, 0)


def wide(spark, values):
    return spark.createDataFrame([(T0 + timedelta(hours=i), float(v)) for i, v in enumerate(values)],
                                 "target_hour timestamp_ntz, total_trips double")


def test_upcoming_future_and_fallback(spark):
    df = wide(spark, range(30))
    assert SV.upcoming(df, T0 + timedelta(hours=25)).count() == 5
    past = SV.upcoming(df, T0 + timedelta(days=10)).toPandas()
    assert len(past) == 24 and past.target_hour.min() == T0 + timedelta(hours=6)


def test_rush_and_summary(spark):
    df = wide(spark, [1, 1, 5, 5, 1, 1])
    r = SV.rush_hours(df).collect()
    assert [x.total_trips for x in r] == [5.0, 5.0]
    w = SV.rush_window(df).first()
    assert w.rush_start == T0 + timedelta(hours=2) and w.rush_end == T0 + timedelta(hours=3)
    s = SV.forecast_summary(df).first()
    assert s.peak == 5.0 and s.peak_hour == T0 + timedelta(hours=2) and s.live == 1.0 and s.avg_demand == 2.3


def test_forecast_wide_totals(spark):
    pred = spark.createDataFrame([("A", 0, T0, 1.25), ("B", 1, T0, 2.04), ("C", 2, T0, 0.0)],
                                 "station_id string, station_rank int, target_hour timestamp_ntz, "
                                 "predicted_trips double")
    r = SV.forecast_wide(pred).first()
    assert (r.station_0, r.station_1, r.station_2, r.total_trips) == (1.3, 2.0, 0.0, 3.3)


def test_upcoming_floor_hour_variant(spark):
    df = wide(spark, range(10))
    now = T0 + timedelta(hours=5, minutes=30)
    assert SV.upcoming(df, now).count() == 4                    # API rule: strictly from now
    assert SV.upcoming(df, now, floor_hour=True).count() == 5   # dashboard rule: from the current hour


def test_forecast_wide_shows_every_station(spark):
    rows = [(f"S{k}", k, T0, 1.0 + k) for k in range(5)]
    r = SV.forecast_wide(spark.createDataFrame(rows, "station_id string, station_rank int, target_hour timestamp_ntz, predicted_trips double")).first()
    assert [r[f"station_{k}"] for k in range(5)] == [1.0, 2.0, 3.0, 4.0, 5.0] and r.total_trips == 15.0
    assert sorted(tuple(x) for x in SV.stations(spark.createDataFrame(rows, "station_id string, station_rank int, h timestamp_ntz, v double")).collect()) == [(f"S{k}", k) for k in range(5)]
