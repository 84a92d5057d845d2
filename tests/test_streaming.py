import os
import tempfile

import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from velocube.operators import aggregates as A
from velocube.sources import adapters, tables
from velocube.streaming import jobs as SJ
from tests.conftest import SF0001


def _batch_counts(events):
    return (A.hourly_cube(adapters.trips_from_events(events))
            .groupBy("start_hour", F.col("start_station_id").alias("station_id"))
            .agg(F.sum("count").alias("batch")))


def test_stream_watermark_semantics(spark):
    """After a landing, the sink holds exactly the batch counts of every
    window the watermark closed.  Rows landing later for closed windows are
    late and dropped (never double counted); the batch job corrects them."""
    land = tempfile.mkdtemp(prefix="velocube-land-")
    root = tempfile.mkdtemp(prefix="velocube-stream-")
    tab = pq.read_table(f"{SF0001}/events.parquet")
    even = pc.equal(pc.bit_wise_and(tab["event_id"], 1), 0)
    sink, ck = os.path.join(root, "hourly"), os.path.join(root, "ck")

    def land_and_run(name, mask):
        pq.write_table(tab.filter(mask), os.path.join(land, name), coerce_timestamps="us")
        trips = adapters.trips_from_events(SJ.events_stream(spark, land, "*.parquet"))
        SJ.run_available_now(SJ.hourly_counts(trips, "10 minutes"), None, ck,
                             foreach_batch=SJ.upsert_sink(sink, ["start_hour", "station_id"], "start_hour"))
        return tables.read_table(spark, sink).select("start_hour", "station_id", "total_trips")

    first = land_and_run("events-a.parquet", even)
    ev_all = spark.read.parquet(f"{SF0001}/events.parquet")
    ev_even = ev_all.filter("event_id % 2 = 0")
    wm = adapters.trips_from_events(ev_even).filter("start_station_id IS NOT NULL")\
        .agg(F.max("started_at")).first()[0]
    closed = _batch_counts(ev_even).filter(
        F.timestamp_add("HOUR", F.lit(1), "start_hour") <= F.lit(wm) - F.expr("INTERVAL 10 MINUTES"))
    a = {(r.start_hour, r.station_id): r.total_trips for r in first.collect()}
    b = {(r.start_hour, r.station_id): r.batch for r in closed.collect()}
    assert a == b and len(a) > 0

    second = {(r.start_hour, r.station_id): r.total_trips for r in land_and_run("events-b.parquet", pc.invert(even))
              .collect()}
    for k, v in a.items():          # closed windows are final
        assert second[k] == v
    full = {(r.start_hour, r.station_id): r.batch for r in _batch_counts(ev_all).collect()}
    assert all(v <= full[k] for k, v in second.items())
