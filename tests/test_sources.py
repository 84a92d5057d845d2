import csv
import io
import os
import tempfile
import uuid
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from velocube import schemas
from velocube.sources import tables
from velocube.sources.trips import read_trip_archives, read_trips, read_trips_by_header

HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name," \
         "start_lat,start_lng,member_casual"
ROW = "r1,classic_bike,2024-01-01 08:00:00.123,2024-01-01 08:10:00,Main St,S1,Elm St,40.7,-74.0,member"


def _tmp():
    return tempfile.mkdtemp(prefix="velocube-src-")


def test_csv_by_header_name_and_bad_values(spark):
    d = _tmp()
    with open(os.path.join(d, "202401-tripdata.csv"), "w") as f:
        f.write(HEADER + "\n" + ROW + "\n" + "r2,classic_bike,bad,2024-01-01 08:10:00,,S2,,x,,casual\n")
    df = read_trips(spark, d).orderBy("ride_id").collect()
    assert df[0].started_at == datetime(2024, 1, 1, 8, 0, 0, 123000) and df[0].start_lat == 40.7
    assert df[1].started_at is None and df[1].start_lat is None and df[1].start_station_id == "S2"


def test_missing_column_becomes_null(spark):
    d = _tmp()
    hdr = HEADER.replace("start_station_name,", "")
    row = ROW.replace("Main St,", "")
    p = os.path.join(d, "old.csv")
    with open(p, "w") as f:
        f.write(hdr + "\n" + row + "\n")
    r = read_trips_by_header(spark, [p]).first()
    assert r.start_station_name is None and r.start_station_id == "S1" and r.end_station_name == "Elm St"


def test_zip_skips_macosx(spark):
    d = _tmp()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("__MACOSX/._a.csv", "garbage")
        zf.writestr("a.csv", HEADER + "\n" + ROW + "\n")
    with open(os.path.join(d, "202401-tripdata.zip"), "wb") as f:
        f.write(buf.getvalue())
    rows = read_trip_archives(spark, d).collect()
    assert len(rows) == 1 and rows[0].ride_id == "r1" and rows[0].start_lng == -74.0


def test_upsert_newer_row_wins(spark):
    path = os.path.join(_tmp(), "t")
    s = "start_hour timestamp_ntz, station_id string, total_trips long"
    old = spark.createDataFrame([(datetime(2024, 1, 1, 1), "A", 1), (datetime(2024, 2, 1, 1), "A", 5)], s)
    tables.upsert(spark, path, old, ["start_hour", "station_id"], "start_hour")
    new = spark.createDataFrame([(datetime(2024, 1, 1, 1), "A", 9), (datetime(2024, 1, 1, 2), "A", 3)], s)
    out = {(r.start_hour, r.total_trips) for r in
           tables.upsert(spark, path, new, ["start_hour", "station_id"], "start_hour").collect()}
    assert out == {(datetime(2024, 1, 1, 1), 9), (datetime(2024, 1, 1, 2), 3), (datetime(2024, 2, 1, 1), 5)}


def test_json_doc_missing_file_gives_empty_map(spark):
    doc = tables.read_json_doc(spark, os.path.join(_tmp(), "nope.json"), schemas.MONTHLY_STATS).first()
    assert doc.topStationNames == {} and doc.summary is None


def test_publish_latest_snapshot(spark):
    root = os.path.join(_tmp(), "pred")
    s = "station_id string, predicted_trips double, prediction_generated_at timestamp"
    tables.publish(spark.createDataFrame([("A", 1.0, datetime(2024, 1, 1, 10))], s), root)
    tables.publish(spark.createDataFrame([("A", 2.0, datetime(2024, 1, 1, 11))], s), root)
    assert [r.predicted_trips for r in tables.latest(spark, root).collect()] == [2.0]


def test_last_months_newest_first(spark):
    out = spark.range(1).select(tables.last_months(F.lit(datetime(2024, 3, 15)).cast("timestamp_ntz"), 3)
                                .alias("m")).first().m
    assert out == ["202402", "202401", "202312"]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5", "x", 2)], "a string, b string, c int")
    r = tables.coerce_numeric(df).first()
    assert r.a == 1.5 and r.b is None and r.c == 2


def test_upsert_unpartitioned_table(spark):
    path = os.path.join(_tmp(), "flat")
    s = "k string, v long, t timestamp_ntz"
    tables.upsert(spark, path, spark.createDataFrame([("a", 1, datetime(2024, 1, 1))], s), ["k"], "t", None)
    out = tables.upsert(spark, path, spark.createDataFrame([("a", 2, datetime(2024, 1, 2)),
                                                            ("b", 3, datetime(2024, 1, 2))], s), ["k"], "t", None)
    assert sorted((r.k, r.v) for r in out.collect()) == [("a", 2), ("b", 3)]


def test_month_from_file_name(spark):
    from velocube.functions import month_from_path
    d = _tmp()
    with open(os.path.join(d, "202403-tripdata.csv"), "w") as f:
        f.write(HEADER + "\n" + ROW + "\n")
    r = spark.read.option("header", True).csv(d).select(
        month_from_path(F.col("_metadata.file_path")).alias("m")).first()
    assert r.m == "202403"


def _archive(d, name, members):
    with zipfile.ZipFile(os.path.join(d, name), "w", zipfile.ZIP_DEFLATED) as zf:
        for member, text in members.items():
            zf.writestr(member, text)
    return os.path.join(d, name)


def test_zip_all_members(spark):
    d = _tmp()
    _archive(d, "202402-tripdata.zip", {"a.csv": HEADER + "\n" + ROW + "\n", "b.csv": HEADER + "\n" + ROW.replace("r1,", "r2,") + "\n"})
    assert read_trip_archives(spark, d, first_only=True).count() == 1
    rows = read_trip_archives(spark, d).collect()
    assert sorted((r.ride_id, r.source_file) for r in rows) == [("r1", "202402-tripdata.zip/a.csv"), ("r2", "202402-tripdata.zip/b.csv")]


def test_zip_members_are_partitions_bound_by_their_own_header(spark, monkeypatch):
    """Reversed columns, a missing one, quotes with line ends, a byte-order mark, empty members; no task holds a member."""
    d = _tmp()
    names, values = HEADER.split(","), dict(zip(HEADER.split(","), next(csv.reader([ROW]))))
    short = [n for n in names if n != "start_station_name"]
    line = lambda cols, **x: ",".join({**values, **x}[n] for n in cols)
    long = "\n".join(line(names, ride_id=f"l{k}") for k in range(30000))
    _archive(d, "1.zip", {"a.csv": HEADER + "\n" + long + "\n", "b.csv": "\ufeff" + ",".join(names[::-1]) + "\n" + line(names[::-1], ride_id="b") + "\n"})
    _archive(d, "2.zip", {"c.csv": ",".join(short) + "\n" + line(short, ride_id="c") + "\n", "d.csv": "", "e.csv": HEADER + "\n", "f.txt": "no", "__MACOSX/._c.csv": "x",
                          "g.csv": HEADER + "\n" + line(names, ride_id="g", start_station_name='"Main\nSt, ""N"""') + "\n"})
    from velocube.sources import archives
    reader = archives.ArchiveReader({"path": d})
    monkeypatch.setattr(archives, "PACK", 1)
    parts = reader.partitions()
    assert [p.members[0][1] for p in parts] == ["a.csv", "b.csv", "c.csv", "d.csv", "e.csv", "g.csv"]
    monkeypatch.setattr(archives, "BLOCK", 1 << 16)
    sizes = [b.num_rows for b in reader.read(parts[0])]
    assert sum(sizes) == 30000 and max(sizes) < 2000
    got = {r.ride_id: r for r in read_trip_archives(spark, d).collect()}
    assert len(got) == 30003
    one = {k: v for k, v in got["l0"].asDict().items() if k not in ("ride_id", "source_file")}
    assert one["start_station_name"] == "Main St" and one["started_at"] == datetime(2024, 1, 1, 8, 0, 0, 123000)
    for name, change in (("b", {}), ("c", {"start_station_name": None}), ("g", {"start_station_name": 'Main\nSt, "N"'})):
        assert {k: v for k, v in got[name].asDict().items() if k not in ("ride_id", "source_file")} == {**one, **change}
    assert read_trip_archives(spark, _tmp()).count() == 0


def test_zip_damaged_member(spark):
    """By default a damaged member fails the job; with skip it is left out whole, and so is a file that is no archive."""
    d = _tmp()
    rows = "\n".join(ROW.replace("r1,", f"r{k},") for k in range(5000))
    path = _archive(d, "1.zip", {"a.csv": HEADER + "\n" + rows + "\n", "b.csv": HEADER + "\n" + ROW.replace("r1,", "ok,") + "\n"})
    with zipfile.ZipFile(path) as zf:
        info = zf.getinfo("a.csv")
    data = bytearray(open(path, "rb").read())
    at = info.header_offset + 30 + len("a.csv") + info.compress_size - 20
    data[at] ^= 0xFF
    open(path, "wb").write(bytes(data))
    with pytest.raises(Exception):
        read_trip_archives(spark, d).count()
    assert [r.ride_id for r in read_trip_archives(spark, d, damaged="skip").collect()] == ["ok"]
    open(os.path.join(d, "2.zip"), "wb").write(b"nothing")
    assert [r.ride_id for r in read_trip_archives(spark, d, damaged="skip").collect()] == ["ok"]


def test_zip_written_archives_come_back(spark):
    from velocube.sources.trips import write_trip_archives
    d = os.path.join(_tmp(), "out")
    trips = spark.createDataFrame([(f"r{k}", datetime(2024, 1, 1, 0, 0, 0, k), None if k % 7 else 'a "q", b', 40.1 + k) for k in range(500)],
                                  "ride_id string, started_at timestamp_ntz, start_station_name string, start_lat double")
    write_trip_archives(trips.repartition(3), d, 60)
    assert sorted(f for f in os.listdir(d) if f.endswith(".zip")) and not os.listdir(os.path.join(d, "_staged"))
    back = read_trip_archives(spark, d).select(*trips.columns)
    assert sorted(back.collect()) == sorted(trips.collect())


def test_header_pass_reads_heads_only(spark, monkeypatch):
    """A megabyte of rows beside a kilobyte: the same few bytes of each; both ways to open files agree."""
    import gzip
    from velocube.sources import trips as TR
    d = _tmp()
    for name, n in (("a", 1), ("b", 20000)):
        with open(os.path.join(d, f"{name} x.csv"), "w") as f:
            f.write(HEADER + "\r\n" + (ROW + "\r\n") * n)
    with gzip.open(os.path.join(d, "c.csv.gz"), "wt") as f:
        f.write(",".join(HEADER.split(",")[::-1]) + "\n")
    open(os.path.join(d, "empty.csv"), "w").close()
    files = spark.read.text(d).inputFiles()
    assert len(files) == 4
    lines = TR.first_lines(spark, files)
    assert lines == TR._first_lines_by_driver(spark, files)
    assert sorted(lines.values()) == sorted(["", HEADER, HEADER, ",".join(HEADER.split(",")[::-1])])
    monkeypatch.setattr(TR, "HEAD", 50)
    with pytest.raises(Exception):
        TR.first_lines(spark, files)
    monkeypatch.undo()
    assert sorted(len(f) for f in TR.headers(spark, [d]).values()) == [1, 2]
    assert read_trips(spark, d).count() == 20001


def test_versioned_features_and_predictions_by_name(spark):
    root = _tmp()
    df = spark.createDataFrame([(1.5, datetime(2024, 1, 1, 1), "S1", 0, datetime(2024, 1, 1))],
                               "predicted_trips double, target_hour timestamp, station_id string, "
                               "station_rank int, prediction_generated_at timestamp")
    df.write.parquet(os.path.join(root, "v=2"))
    assert tables.load_features(spark, root, 2).count() == 1
    p = tables.read_predictions(spark, os.path.join(root, "v=2"))
    assert p.columns[:4] == ["station_id", "station_rank", "target_hour", "predicted_trips"]


def test_upsert_damaged_table_raises_and_stays(spark):
    path = os.path.join(_tmp(), "t")
    s = "k string, v int, t timestamp"
    spark.createDataFrame([("a", 1, datetime(2024, 1, 1)), ("b", 1, datetime(2024, 1, 1))], s).coalesce(1).write.parquet(path)
    name = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    data = open(os.path.join(path, name), "rb").read()
    with open(os.path.join(path, name), "wb") as f:
        f.write(data[:-8] + b"\0" * 8)
    with pytest.raises(Exception):
        tables.upsert(spark, path, spark.createDataFrame([("c", 2, datetime(2024, 1, 2))], s), ["k"], "t", None)
    assert open(os.path.join(path, name), "rb").read() == data[:-8] + b"\0" * 8


def test_upsert_repeated_key_newer_wins(spark):
    path = os.path.join(_tmp(), "t")
    s = "k string, v int, t timestamp"
    rows = [("a", 1, datetime(2024, 1, 1, 1)), ("a", 2, datetime(2024, 1, 1, 3)), ("a", 3, datetime(2024, 1, 1, 2))]
    out = tables.upsert(spark, path, spark.createDataFrame(rows, s), ["k"], "t")
    assert [r.v for r in out.collect()] == [2]
    out = tables.upsert(spark, path, spark.createDataFrame([("a", 9, datetime(2024, 1, 1, 3)), ("z", 5, datetime(2024, 2, 1))], s), ["k"], "t")
    assert sorted((r.k, r.v) for r in out.collect()) == [("a", 9), ("z", 5)]


def test_mixed_headers_bind_by_name(spark):
    d = _tmp()
    names = HEADER.split(",")
    values = dict(zip(names, next(csv.reader([ROW]))))
    orders = [names, names[::-1], [n for n in names if n != "start_station_name"] + ["extra"]]
    for k, order in enumerate(orders):
        with open(os.path.join(d, f"{k}.csv"), "w") as f:
            f.write(",".join(order) + "\n" + ",".join({**values, "ride_id": f"m{k}", "extra": "x"}[n] for n in order) + "\n")
    got = {r.ride_id: r for r in read_trips(spark, d).collect()}
    one = got["m0"].asDict()
    assert got["m1"].asDict() == {**one, "ride_id": "m1"}
    assert got["m2"].asDict() == {**one, "ride_id": "m2", "start_station_name": None}
    with open(os.path.join(d, "none.csv"), "w") as f:
        f.write("1,2,3\n")
    with pytest.raises(ValueError):
        read_trips(spark, d)


def test_wall_clock_in_any_session_zone(spark):
    from velocube.functions import parse_ts
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/London")
        df = spark.createDataFrame([("2024-03-31 01:30:00",), ("bad",)], "s string").select(parse_ts("s").alias("t"))
        assert [r.t for r in df.collect()] == [datetime(2024, 3, 31, 1, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_versions_are_whole(spark, monkeypatch):
    """A job that dies between its rows and its manifest leaves the old version; older versions stay readable."""
    from velocube.sources import versions
    path = os.path.join(_tmp(), "t")
    s = "k string, v long, t timestamp_ntz"
    row = lambda k, v, month, day=1: (k, v, datetime(2024, month, day))
    tables.upsert(spark, path, spark.createDataFrame([row("a", 1, 1), row("b", 1, 2), row("c", 1, 3)], s), ["k"], "t")
    monkeypatch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        tables.upsert(spark, path, spark.createDataFrame([row("a", 2, 1, 2), row("b", 2, 2, 2)], s), ["k"], "t")
    monkeypatch.undo()
    values = lambda *v: sorted((r.k, r.v) for r in tables.read_table(spark, path, *v).collect())
    assert values() == [("a", 1), ("b", 1), ("c", 1)] and versions.history(spark, path) == [1]
    tables.upsert(spark, path, spark.createDataFrame([row("a", 3, 1, 2), row("d", 3, 4)], s), ["k"], "t")
    assert values() == [("a", 3), ("b", 1), ("c", 1), ("d", 3)] and values(1) == [("a", 1), ("b", 1), ("c", 1)]
    old, new = (versions.manifest(spark, path, v)[1] for v in (1, 2))
    assert {m for m in old if old[m] == new[m]} == {"202402", "202403"} and set(new) - set(old) == {"202404"}
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, 2, {})
    with pytest.raises(ValueError):
        tables.read_table(spark, path, 9)
    assert tables.load_features(spark, path, 1).count() == 3 and tables.load_features(spark, path).count() == 4


def test_upsert_takes_over_a_plain_folder(spark):
    path = os.path.join(_tmp(), "t")
    s = "k string, v long, t timestamp_ntz, month_key string"
    spark.createDataFrame([("a", 1, datetime(2024, 1, 1), "202401"), ("b", 1, datetime(2024, 2, 1), "202402")], s).write.partitionBy("month_key").parquet(path)
    out = tables.upsert(spark, path, spark.createDataFrame([("a", 2, datetime(2024, 1, 2))], s.rsplit(",", 1)[0]), ["k"], "t")
    assert sorted((r.k, r.v, r.month_key) for r in out.collect()) == [("a", 2, "202401"), ("b", 1, "202402")]
    none = spark.createDataFrame([("z", 5, None)], s.rsplit(",", 1)[0])
    assert sorted((r.k, r.month_key) for r in tables.upsert(spark, path, none, ["k"], "t").collect()) == [("a", "202401"), ("b", "202402"), ("z", None)]
    out = tables.upsert(spark, path, none.withColumn("v", F.lit(6).cast("long")), ["k"], "t")
    assert sorted((r.k, r.v) for r in out.collect()) == [("a", 2), ("b", 1), ("z", 6)]
