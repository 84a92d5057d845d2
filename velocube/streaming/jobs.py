"""Incremental versions of the batch jobs.

* ``hourly_counts``: trips -> watermark -> tumbling 1-hour windows per
  station (append mode: a window is emitted once the watermark passes its
  end; later rows for it are dropped and the batch job stays the corrector).
* ``popularity``: running trips per station (complete mode; state is one
  row per station).
* ``rolling_lags``: per-station state of the last N closed hourly counts
  (``applyInPandasWithState``), emitting feature rows with all N lags.
* ``upsert_sink``: ``foreachBatch`` writer that upserts each micro-batch by
  key, so a replayed batch rewrites the same rows.

Event time must be TIMESTAMP for ``withWatermark``; trips carry
TIMESTAMP_NTZ wall clock, cast under the UTC session zone.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from velocube import schemas
from velocube.sources import tables

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def events_stream(spark: SparkSession, directory: str, pattern: str = "events*.parquet",
                  max_files: int | None = None) -> DataFrame:
    """Event files landing in ``directory`` (name filter ``pattern``).  Where
    ``directory`` holds the table as a folder ``events.parquet`` of part files,
    as cluster jobs write it, that folder is the source."""
    table = f"{directory.rstrip('/')}/events.parquet"
    if tables.is_folder(spark, table):
        directory, pattern = table, "*.parquet"
    r = spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


def hourly_counts(trips: DataFrame, delay: str = "10 minutes") -> DataFrame:
    complete = (F.col("start_station_id").isNotNull() & F.col("member_casual").isNotNull()
                & F.col("rideable_type").isNotNull())
    t = (trips.filter(F.col("started_at").isNotNull() & complete)
         .withColumn("event_time", F.col("started_at").cast("timestamp"))
         .withWatermark("event_time", delay))
    g = t.groupBy(F.window("event_time", "1 hour").alias("w"), F.col("start_station_id").alias("station_id"))
    return g.agg(F.count(F.lit(1)).alias("total_trips")).select(
        F.col("w.start").cast("timestamp_ntz").alias("start_hour"), "station_id", "total_trips")


def popularity(trips: DataFrame) -> DataFrame:
    return (trips.filter(F.col("start_station_id").isNotNull())
            .groupBy(F.col("start_station_id").alias("station_id")).agg(F.count(F.lit(1)).alias("trips")))


LAG_OUT = T.StructType([T.StructField("start_hour", T.TimestampNTZType()),
                        T.StructField("station_id", T.StringType()),
                        T.StructField("total_trips", T.LongType())]
                       + [T.StructField(f"lag_{k}", T.LongType()) for k in range(1, schemas.N_LAGS + 1)])
LAG_STATE = T.StructType([T.StructField("hours", T.ArrayType(T.TimestampNTZType())),
                          T.StructField("counts", T.ArrayType(T.LongType()))])


def _lag_updater(n: int):
    def update(key, pdfs, state):
        hours, counts = (list(state.get[0]), list(state.get[1])) if state.exists else ([], [])
        new = pd.concat(list(pdfs), ignore_index=True).sort_values("start_hour")
        if hours:  # an hour at or before the last one is a replay; corrected hours are the batch job's
            new = new[new["start_hour"] > pd.Timestamp(hours[-1])]
        series = np.concatenate([np.array(counts, np.int64), new["total_trips"].to_numpy(np.int64)])
        at = np.arange(len(counts), len(series))
        full = at >= n  # rows with n predecessors
        windows = np.lib.stride_tricks.sliding_window_view(series, n + 1)[at[full] - n] if full.any() else np.zeros((0, n + 1), np.int64)
        out = pd.DataFrame(windows[:, ::-1], columns=[f.name for f in LAG_OUT.fields[2:]])
        out.insert(0, "start_hour", new["start_hour"].to_numpy()[full])
        out.insert(1, "station_id", key[0])
        state.update(((hours + list(new["start_hour"]))[-n:], [int(c) for c in series[-n:]]))
        yield out
    return update


def rolling_lags(hourly: DataFrame, n: int = schemas.N_LAGS) -> DataFrame:
    """Per station, keep the last ``n`` hourly counts as state (bounded per
    key) and emit one row per new hour that has ``n`` predecessors."""
    return hourly.groupBy("station_id").applyInPandasWithState(
        _lag_updater(n), LAG_OUT, LAG_STATE, "append", GroupStateTimeout.NoTimeout)


def upsert_sink(path: str, keys: Sequence[str], event_time: str, partition_col: str = "month_key"):
    def write(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        tables.upsert(batch.sparkSession, path, batch, keys, event_time, partition_col)
    return write


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                      foreach_batch=None, fmt: str = "parquet", rocksdb: bool = True) -> None:
    """Process everything available, then stop (idempotent restarts from
    the checkpoint).  State lives in RocksDB (off-heap, spills to local
    disk, snapshots to the checkpoint) rather than on the executor heap; the
    provider is recorded in the checkpoint, so restarts keep it."""
    if rocksdb:
        stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).start(sink_path)
    q.awaitTermination()
