"""Recursive bridge + multi-step forecast, in parallel over stations.

State per station = its last feature row (``features.latest_state``): lags
lag_1..lag_n, calendar of its hour L, rank.  With G = whole hours from L to
``as_of`` (truncated toward zero) and B = max(G, 0), steps j = 1..B+h run

    p_j = max(0, f(state_{j-1}));  state_j = shift(p_j), calendar(t_j)
    t_j = L + min(G, 0) + j hours;  rows with j > B are emitted.

``mode='reference'`` scores step j with the calendar of t_{j-1} and leaves
the last observed count out of the lags (the original behaviour);
``mode='aligned'`` first pushes the observed count into lag_1 and scores
with the calendar of t_j.

Linear models and tree ensembles (``operators.trees``) run as a Spark SQL ``aggregate`` fold, JVM only, one row per
station.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from velocube import schemas

HORIZON = 24


@dataclass
class LinearSpec:
    """p = intercept + sum(lag_w[k] * lag_{k+1}) + hour_w*hour + dow_w*day_of_week
           + weekend_w*is_weekend + month_w*month + rank_w*station_rank"""
    intercept: float = 0.0
    lag_w: Sequence[float] = field(default_factory=lambda: [1.0 / schemas.N_LAGS] * schemas.N_LAGS)
    hour_w: float = 0.0
    dow_w: float = 0.0
    weekend_w: float = 0.0
    month_w: float = 0.0
    rank_w: float = 0.0

    @classmethod
    def from_model(cls, coefficients: Sequence[float], intercept: float,
                   inputs: Sequence[str] = schemas.MODEL_INPUTS) -> "LinearSpec":
        c = dict(zip(inputs, map(float, coefficients)))
        return cls(float(intercept), [c.get(x, 0.0) for x in schemas.LAG_COLS], c.get("hour", 0.0),
                   c.get("day_of_week", 0.0), c.get("is_weekend", 0.0), c.get("month", 0.0),
                   c.get("station_rank", 0.0))


def materialize_state(state: DataFrame) -> DataFrame:
    """Persist the per-station state (one row per station) with a reliable
    checkpoint.  This cuts the lineage back to the trips (inference restarts
    from the state table) and keeps the optimizer from propagating the
    feature table's column constraints through the fold."""
    from velocube.session import checkpoint_dir
    checkpoint_dir(state.sparkSession)
    return state.checkpoint(eager=True)


def _gap_cols(state: DataFrame, as_of, ts: str = "start_hour") -> DataFrame:
    as_of = F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of
    g = (F.timestamp_diff("MICROSECOND", F.col(ts), as_of) / F.lit(3.6e9)).cast("int")
    return (state.withColumn("_G", g)
            .withColumn("_B", F.greatest(F.col("_G"), F.lit(0)))
            .withColumn("_base", F.timestamp_add("HOUR", F.least(F.col("_G"), F.lit(0)), F.col(ts))))


def linear(spec: LinearSpec):
    """A linear model as a function of lags and calendar, for ``forecast_fold``."""
    def predict(lags: Column, h: Column, d: Column, wk: Column, m: Column, rank: Column) -> Column:
        acc = F.lit(float(spec.intercept))
        for k, w in enumerate(spec.lag_w):
            if w != 0.0:
                acc = acc + F.lit(float(w)) * lags.getItem(k)
        for w, c in ((spec.hour_w, h), (spec.dow_w, d), (spec.weekend_w, wk), (spec.month_w, m), (spec.rank_w, rank)):
            if w != 0.0:
                acc = acc + F.lit(float(w)) * c
        return acc
    return predict


def forecast_linear(state: DataFrame, spec: LinearSpec, as_of, horizon: int = HORIZON,
                    mode: str = "reference", n: int = schemas.N_LAGS,
                    emit_bridge: bool = False) -> DataFrame:
    """``forecast_fold`` of a linear model."""
    return forecast_fold(materialize_state(state), linear(spec), as_of, horizon, mode, n, emit_bridge)


def forecast_trees(state: DataFrame, nodes: DataFrame, as_of, horizon: int = HORIZON, mode: str = "reference",
                   n: int = schemas.N_LAGS, emit_bridge: bool = False) -> DataFrame:
    """``forecast_fold`` of a tree ensemble (a node table of ``operators.trees``, in the order of the model's inputs)."""
    from velocube.operators import trees as TR
    inputs = [f"lag_{k}" for k in range(1, n + 1)] + list(schemas.CATEGORICAL_COLS)
    rows = TR.attached(materialize_state(state), nodes, inputs)

    def predict(lags: Column, *calendar: Column) -> Column:
        return TR.predict(F.concat(lags, F.array(*calendar)), F.col("trees"), F.col("depth"))

    return forecast_fold(rows, predict, as_of, horizon, mode, n, emit_bridge)


def forecast_fold(state: DataFrame, model, as_of, horizon: int = HORIZON, mode: str = "reference",
                  n: int = schemas.N_LAGS, emit_bridge: bool = False) -> DataFrame:
    """Emit (station_id, station_rank, step, target_hour, predicted_trips).

    ``model`` maps (lags, hour, day_of_week, is_weekend, month, station_rank) to a prediction.  The fold state is
    (lags, calendar, out).  Each step computes its
    prediction once and pushes it into lag_1; the value is appended to
    ``out`` by the next step (and by the finish function for the last one),
    so the lambda never repeats the model expression.
    """
    s = _gap_cols(state, as_of)
    lags = F.array(*[F.col(f"lag_{k}").cast("double") for k in range(1, n + 1)])
    if mode == "aligned":
        lags = F.concat(F.array(F.col("total_trips").cast("double")), F.slice(lags, 1, n - 1))
    rank = F.col("station_rank").cast("double")

    init = F.struct(lags.alias("lags"), F.col("hour").cast("double").alias("h"),
                    F.col("day_of_week").cast("double").alias("d"),
                    F.col("is_weekend").cast("double").alias("wk"), F.col("month").cast("double").alias("m"),
                    F.array().cast("array<double>").alias("out"))

    def wanted(j: Column) -> Column:  # is step j emitted?
        return (j >= 1) & ((j <= F.col("_B")) if emit_bridge else (j > F.col("_B")))

    def step(acc: Column, j: Column) -> Column:
        t = F.timestamp_add("HOUR", j, F.col("_base"))
        cal = F.struct(F.hour(t).cast("double").alias("h"), F.weekday(t).cast("double").alias("d"),
                       F.weekday(t).isin(5, 6).cast("double").alias("wk"), F.month(t).cast("double").alias("m"))
        src = cal if mode == "aligned" else acc
        p = F.greatest(F.lit(0.0), model(acc["lags"], src["h"], src["d"], src["wk"], src["m"], rank))
        prev = F.when(wanted(j - 1), F.concat(acc["out"], F.array(acc["lags"].getItem(0)))).otherwise(acc["out"])
        return F.struct(F.concat(F.array(p), F.slice(acc["lags"], 1, n - 1)).alias("lags"),
                        cal["h"].alias("h"), cal["d"].alias("d"), cal["wk"].alias("wk"), cal["m"].alias("m"),
                        prev.alias("out"))

    steps = F.col("_B") if emit_bridge else F.col("_B") + horizon

    def finish(acc: Column) -> Column:
        return F.when(wanted(steps), F.concat(acc["out"], F.array(acc["lags"].getItem(0)))).otherwise(acc["out"])

    seq = F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    folded = s.withColumn("_out", F.aggregate(seq, init, step, finish))
    first = F.lit(1) if emit_bridge else F.col("_B") + 1
    out = folded.select("station_id", "station_rank", "_base", first.alias("_first"),
                        F.posexplode("_out").alias("_i", "predicted_trips"))
    return out.select("station_id", "station_rank", (F.col("_first") + F.col("_i")).alias("step"),
                      F.timestamp_add("HOUR", F.col("_first") + F.col("_i"), F.col("_base")).alias("target_hour"),
                      "predicted_trips")


def with_generated_at(pred: DataFrame, generated_at) -> DataFrame:
    """Attach the UTC generation time; target_hour becomes a UTC TIMESTAMP."""
    g = F.lit(generated_at).cast("timestamp_ntz") if not isinstance(generated_at, Column) else generated_at
    return pred.select("station_id", "station_rank",
                       F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("target_hour"))
                       .cast("timestamp").alias("target_hour"),
                       "predicted_trips",
                       F.convert_timezone(F.lit("UTC"), F.current_timezone(), g).cast("timestamp")
                       .alias("prediction_generated_at"))
