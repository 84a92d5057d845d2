"""Inference job: champion model + latest feature state -> recursive bridge
to ``as_of`` -> 24 hourly forecasts per station -> published table."""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from velocube import schemas
from velocube.operators import features as FE
from velocube.operators import forecast as FC
from velocube.operators import models as M
from velocube.plans.training import champion_run
from velocube.sources import tables


def forecast_with_model(model: PipelineModel, features: DataFrame, as_of, horizon: int = 24,
                        mode: str = "reference") -> DataFrame:
    return FC.forecast_trees(FE.latest_state(features), M.node_table(model, schemas.MODEL_INPUTS), as_of, horizon, mode)


def run_inference(spark: SparkSession, features: DataFrame, runs_path: str, out_root: str, as_of,
                  generated_at=None) -> DataFrame | None:
    champ = champion_run(spark, runs_path)
    row = champ.first() if champ is not None else None
    if row is None or not row["path"]:
        return None
    model = PipelineModel.load(row["path"])
    pred = forecast_with_model(model, features, as_of)
    out = FC.with_generated_at(pred, generated_at or as_of)
    tables.publish(out, out_root)
    return tables.latest(spark, out_root)
