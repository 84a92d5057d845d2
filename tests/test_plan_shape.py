"""Scale properties of key plans (regression guards)."""
import re

from velocube.catalog import QUERIES
from tests.conftest import SF0001


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_feature_build_scans_once_and_prunes_columns(spark):
    plan = final_plan(QUERIES["build_features"](spark, SF0001))
    assert "ReusedExchange" in plan                      # trips aggregated once for both branches
    assert "SinglePartition" not in plan                 # no single-task window or sort on data
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert schemas == {"struct<ts:timestamp_ntz,user_id:bigint,props:string>"}
    assert plan.count("BroadcastExchange") + plan.count("BroadcastQueryStage") >= 1  # the k-row top table


def test_bronze_scan_prunes_partitions_and_pushes_filters(spark):
    plan = final_plan(QUERIES["bronze_last_months"](spark, SF0001))
    assert re.search(r"PartitionFilters: \[[^\]]*ym", plan)
    assert "EqualTo(member_casual,member)" in plan


def test_linear_forecast_stays_in_the_jvm(spark):
    plan = final_plan(QUERIES["forecast"](spark, SF0001))
    assert not re.search(r"ArrowEvalPython|FlatMapGroupsInPandas|BatchEvalPython", plan)


def test_popularity_over_bronze_reads_one_column(spark, tmp_path):
    """O-S6: the count pass over landed trips reads only the station id."""
    from velocube.operators.aggregates import station_popularity
    from velocube.sources import adapters
    from velocube.sources.tables import read_bronze, write_bronze
    path = str(tmp_path / "bronze")
    write_bronze(adapters.trips(spark, SF0001), path)
    plan = final_plan(station_popularity(read_bronze(spark, path)))
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)) == {"struct<start_station_id:string>"}
    assert "IsNotNull(start_station_id)" in plan


def test_report_cells_and_first_values_are_hash_aggregates(spark):
    """No sort aggregate and no expand over trips: order keys are numbers, counts roll up from one cube."""
    from velocube.operators import aggregates as A
    from velocube.operators import clean as CL
    from velocube.plans.report import report_cells
    from velocube.sources import adapters
    trips = adapters.trips(spark, SF0001)
    for df in (report_cells(CL.clean_trips(trips)), A.first_places(CL.clean_trips(trips)), QUERIES["latest_state"](spark, SF0001)):
        plan = final_plan(df)
        assert "HashAggregate" in plan and not re.search(r"SortAggregate|ObjectHashAggregate|Expand", plan)
    names = final_plan(A.station_names(trips))
    assert names.count("SortAggregate") <= 2 and names.count("HashAggregate") >= 2  # names of a station, after the trips are counted


def test_lags_of_one_series_shuffle_once(spark):
    """One range exchange, before the checkpoint; the result only reads it."""
    from velocube.operators.ordering import lags_distributed
    df = lags_distributed(spark.range(1000).withColumnRenamed("id", "t"), "t", ["t"], 3, num_partitions=5)
    assert "Exchange" not in final_plan(df)


def test_popularity_scans_new_months_only(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from velocube.operators import aggregates as A
    from velocube.sources import adapters, tables
    asked = []
    read = tables.read_bronze
    monkeypatch.setattr(tables, "read_bronze", lambda s, p, months=None: asked.append(months) or read(s, p, months))
    trips = adapters.trips(spark, SF0001)
    landed = lambda k: trips.withColumn("at", F.timestamp_add("DAY", F.lit(366 * k), "started_at"))
    bronze, store = str(tmp_path / "bronze"), str(tmp_path / "store")
    total = {r.station_id: r.trips for r in A.station_popularity(trips).collect()}
    for k in range(3):
        tables.write_bronze(landed(k), bronze, "at", mode="append")
        got = {r.station_id: r.trips for r in A.update_popularity(spark, bronze, store).collect()}
        assert got == {s: (k + 1) * n for s, n in total.items()}
    assert {r.station_id: r.trips for r in A.update_popularity(spark, bronze, store).collect()} == got
    assert len(asked) == 3 and sorted(m for a in asked for m in a) == tables.bronze_months(spark, bronze)
