from datetime import datetime, timedelta

from velocube.operators import aggregates as A
from velocube.operators import clean as CL
from tests.conftest import trips_df

T0 = datetime(2024, 1, 1, 8, 0, 0)


def trip(i, station="S1", member="member", bike="classic_bike", start=T0, minutes=10.0, **kw):
    d = {"ride_id": str(i), "started_at": start, "ended_at": start + timedelta(minutes=minutes),
         "member_casual": member, "rideable_type": bike, "start_station_id": station}
    d.update(kw)
    return d


def test_null_dimension_counts_for_popularity_not_cube(spark):
    t = trips_df(spark, [trip(1), trip(2, member=None)])
    pop = A.station_popularity(t).collect()
    assert pop[0].trips == 2
    cube = A.hourly_cube(t).collect()
    assert len(cube) == 1 and cube[0]["count"] == 1


def test_top_k_tie_smaller_key_first(spark):
    t = trips_df(spark, [trip(1, "B"), trip(2, "A"), trip(3, "C"), trip(4, "C")])
    top = A.top_stations(A.station_popularity(t), 2).orderBy("station_rank").collect()
    assert [(r.station_id, r.station_rank) for r in top] == [("C", 0), ("A", 1)]


def test_mode_smallest_tie(spark):
    rows = [trip(i, start=T0.replace(hour=h)) for i, h in enumerate([9, 9, 17, 17])]
    s = A.trip_summary(CL.clean_trips(trips_df(spark, rows))).first()
    assert s.peakHour == 9 and s.totalTrips == 4 and s.memberRatio == 100.0


def test_geo_first_non_null_each_coordinate(spark):
    rows = [trip(1, start_station_name="X", start_lat=None, start_lng=-74.0),
            trip(2, start=T0 + timedelta(minutes=5), start_station_name="X", start_lat=40.7, start_lng=-73.9)]
    g = A.station_geo(CL.clean_trips(trips_df(spark, rows))).first()
    assert g.lat == 40.7 and g.lng == -74.0 and g["count"] == 2


def test_routes_drop_only_both_missing(spark):
    rows = [trip(1, start_station_name="A", end_station_name="B"), trip(2, start_station_name="A"),
            trip(3, end_station_name="B"), trip(4)]
    r = A.route_counts(CL.clean_trips(trips_df(spark, rows))).collect()
    assert sorted(x.route for x in r) == [" → B", "A → ", "A → B"]


def test_hourly_wide_outer_alignment(spark):
    rows = [trip(1), trip(2, member="casual", bike="electric_bike"),
            trip(3, start=T0 + timedelta(hours=1), member=None)]
    w = {r.start_hour.hour: r for r in A.hourly_wide(trips_df(spark, rows)).collect()}
    assert (w[8].member, w[8].casual, w[8].total_trips) == (1, 1, 2)
    assert (w[9].member, w[9].classic_bike, w[9].total_trips) == (0, 1, 0)


def test_station_names_newest_month_first(spark):
    rows = [trip(1, start=datetime(2024, 1, 5), start_station_name="Old"),
            trip(2, start=datetime(2024, 2, 5), start_station_name="New"),
            trip(3, start=datetime(2024, 2, 6), start_station_name=None)]
    n = A.station_names(trips_df(spark, rows)).first()
    assert n.station_name == "New"


def test_binned_density_is_close_to_the_exact_one(spark):
    import numpy as np
    from velocube.operators import stats as ST
    rng = np.random.default_rng(2)
    rows = [("a", float(x)) for x in rng.gamma(2, 9, 700)] + [("b", float(x)) for x in rng.normal(0, 1, 50)] + [("c", 3.0)] * 4 + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    exact = {(r.g, r.i): (r.x, r.density) for r in ST.kde(df.filter("g <> 'c'"), ["g"], "v").collect()}
    binned = {(r.g, r.i): (r.x, r.density) for r in ST.kde_binned(df, ["g"], "v").collect()}
    assert binned.keys() == exact.keys() and len(exact) == 400
    top = {g: max(d for (k, _), (_, d) in exact.items() if k == g) for g in "ab"}
    for key, (x, density) in exact.items():
        assert abs(binned[key][0] - x) < 1e-9 and abs(binned[key][1] - density) < 1e-5 * top[key[0]]
