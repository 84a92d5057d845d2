"""Baselines, error metrics, champion/challenger promotion, run tables and
feature importances - all as aggregates over scored DataFrames."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from velocube.functions import round_py
from velocube.operators import aggregates as A


def baseline_hour_mean(train: DataFrame, test: DataFrame, hour: str = "hour", y: str = "total_trips",
                       name: str = "predicted") -> DataFrame:
    """Mean target per hour of day learnt on ``train`` and looked up for
    ``test`` (unseen hours -> NULL).  The lookup has at most 24 rows, so it
    is broadcast."""
    means = A.hour_mean(train, hour, y, name)
    return test.join(F.broadcast(means), hour, "left")


def error_metrics(scored: DataFrame, y: str = "total_trips", p: str = "predicted",
                  group: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and WMAPE (% of total actual volume; NULL when it is 0)."""
    e = F.col(y).cast("double") - F.col(p)
    aggs = [F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
            (F.try_divide(F.sum(F.abs(e)), F.sum(F.col(y).cast("double"))) * 100).alias("wmape"),
            F.count(F.lit(1)).alias("n")]
    return scored.groupBy(*group).agg(*aggs) if group else scored.agg(*aggs)


def compare(scored: DataFrame, models: dict, y: str = "total_trips") -> DataFrame:
    """Error metrics per model in one pass: ``models`` maps names to prediction columns of ``scored``."""
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("model_name"), F.col(c).cast("double").alias("predicted")) for n, c in models.items()]))
    rows = scored.select(y, stacked.alias("_m")).select(y, "_m.*")
    return error_metrics(rows, y, "predicted", ["model_name"])


def promote(challenger_mae: DataFrame, champion_mae: DataFrame | None) -> DataFrame:
    """One row: challenger MAE, champion MAE (NULL = none) and the decision:
    'Promoted' when there is no champion or the challenger is strictly
    better, else 'Rejected'."""
    ch = challenger_mae.select(F.col("mae").alias("challenger_mae"))
    if champion_mae is None:
        both = ch.withColumn("champion_mae", F.lit(None).cast("double"))
    else:
        from velocube.operators.ordering import attach_group_stats
        both = attach_group_stats(ch, champion_mae.select(F.col("mae").alias("champion_mae")), [])
    better = F.col("champion_mae").isNull() | (F.col("challenger_mae") < F.col("champion_mae"))
    return both.withColumn("promotion_status", F.when(better, "Promoted").otherwise("Rejected"))


def best_model(runs: DataFrame, metric: str = "mae", key: str = "model_name") -> DataFrame:
    """The run with the smallest metric (ties: smallest key) - one row."""
    return runs.agg(F.min_by(F.struct(*runs.columns), F.struct(F.col(metric), F.col(key))).alias("b")) \
        .select("b.*")


def importance_share(importances: DataFrame, k: int = 10, feature: str = "feature",
                     value: str = "importance") -> DataFrame:
    """Top-k features by importance, as % of the top-k total, half-even to
    one decimal (the k-row window is bounded by k)."""
    top = A.top_k(importances, value, feature, k)
    tot = F.sum(value).over(Window.partitionBy())
    denom = F.when(tot == 0, F.lit(1.0)).otherwise(tot)
    return top.select(feature, round_py(F.col(value) / denom * 100, 1).alias("share"))


def runs_table(models: DataFrame) -> DataFrame:
    """Comparison table of evaluated models, best first."""
    return models.orderBy("mae", "model_name")
