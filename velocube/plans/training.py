"""Training job: features -> chronological split -> boosted trees ->
champion/challenger on the same test rows -> runs table + metrics record.

The runs table (Parquet, append) replaces a model registry: each run has
a version, its MAE, the champion's MAE and the decision; the champion is the
promoted run with the smallest MAE.
"""
from __future__ import annotations

import os
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from velocube import schemas
from velocube.operators import evaluation as EV
from velocube.operators import features as FE
from velocube.operators import models as M
from velocube.sources import tables

MODEL_NAME = "station_hour_trees"


def champion_run(spark: SparkSession, runs_path: str) -> DataFrame | None:
    runs = tables.existing(spark, runs_path)
    if runs is None:
        return None
    promoted = runs.filter(F.col("status") == "Promoted")
    return EV.best_model(promoted.withColumnRenamed("version", "v").withColumn("model_name", F.col("run_id")),
                         "mae", "model_name")


def run_training(spark: SparkSession, features: DataFrame, runs_path: str, model_root: str,
                 max_iter: int = 1000, depth: int = 5, metrics_path: str | None = None) -> DataFrame:
    """One training run; the metrics record is also written to
    ``metrics_path`` as one JSON document where that is given."""
    split = FE.chrono_split(features)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    cols = schemas.MODEL_INPUTS
    model, rounds = M.train_gbt(train, test, max_iter=max_iter, depth=depth)
    scored = M.score(model, test, cols)
    ch = EV.error_metrics(scored)
    champ = champion_run(spark, runs_path)
    champ_mae = None
    if champ is not None:
        row = champ.select("path").first()
        if row is not None and row["path"] and tables.path_exists(spark, row["path"]):  # a model that is gone is no champion
            champ_mae = EV.error_metrics(M.score(PipelineModel.load(row["path"]), test, cols))
    decision = EV.promote(ch, champ_mae)
    d = decision.first()
    run_id = uuid.uuid4().hex[:8]
    now = datetime.now(timezone.utc)
    runs = tables.existing(spark, runs_path)
    version = 1 if runs is None else (runs.agg(F.max("version")).first()[0] or 0) + 1
    path = os.path.join(model_root, f"version={version}")
    if d["promotion_status"] == "Promoted":
        model.write().overwrite().save(path)
    run = spark.createDataFrame(
        [(run_id, MODEL_NAME, version, float(d["challenger_mae"]),
          None if d["champion_mae"] is None else float(d["champion_mae"]), d["promotion_status"], now,
          path if d["promotion_status"] == "Promoted" else None)], schemas.RUNS)
    run.write.mode("append").parquet(runs_path)
    imp = M.importances(model, cols)
    record = metrics_record(ch, decision, split, imp, rounds, len(cols), now)
    if metrics_path:
        tables.write_json_doc(record, metrics_path)
    return record


def metrics_record(errors: DataFrame, decision: DataFrame, split: DataFrame, importances: DataFrame,
                   rounds: int, n_features: int, run_date) -> DataFrame:
    from velocube.operators.ordering import attach_group_stats
    shares = EV.importance_share(importances, 10).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "share"))).alias("top_features"))
    sizes = split.agg(F.count(F.when(F.col("split") == "train", 1)).alias("n_train"),
                      F.count(F.when(F.col("split") == "test", 1)).alias("n_test"))
    rec = attach_group_stats(errors, decision, [])
    rec = attach_group_stats(rec, sizes, [])
    rec = attach_group_stats(rec, shares, [])
    return rec.select(F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"),
                      F.round("wmape", 2).alias("mape"), F.round("champion_mae", 4).alias("champion_mae"),
                      "n_train", "n_test", F.lit(n_features).alias("n_features"),
                      F.lit(rounds).alias("n_estimators"), "top_features", "promotion_status",
                      F.lit(run_date.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("run_date"))
