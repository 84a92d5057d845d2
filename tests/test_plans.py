"""End-to-end jobs on sf0.001: feature build + report, two training runs
(champion/challenger), inference with publish."""
import json
import os
import tempfile

from velocube.plans.inference import run_inference
from velocube.plans.feature_job import run_features
from velocube.plans.training import run_training
from velocube.sources import adapters
from tests.conftest import SF0001


def test_feature_train_infer_cycle(spark):
    root = tempfile.mkdtemp(prefix="velocube-plan-")
    trips = adapters.trips(spark, SF0001)
    feats = run_features(spark, trips, os.path.join(root, "features"), os.path.join(root, "stats"), "202401")
    n = feats.count()
    assert n > 0 and "month_key" in feats.columns
    # re-running the job upserts: same keys, same row count
    feats = run_features(spark, trips, os.path.join(root, "features"))
    assert feats.count() == n
    text = spark.read.text(os.path.join(root, "stats")).first()[0]
    doc = json.loads(text)
    assert set(doc) >= {"summary", "topStationNames", "hourlyDensity", "durationData", "topRoutes", "geoData"}
    assert len(doc["topStationNames"]) == 3 and doc["summary"]["totalTrips"] > 0

    runs, models = os.path.join(root, "runs"), os.path.join(root, "models")
    m1 = run_training(spark, feats.drop("month_key"), runs, models, max_iter=4, depth=3).first()
    assert m1.promotion_status == "Promoted" and m1.champion_mae is None
    assert m1.n_train + m1.n_test == n and m1.n_features == 33 and len(m1.top_features) == 10
    m2 = run_training(spark, feats.drop("month_key"), runs, models, max_iter=4, depth=3).first()
    assert m2.champion_mae is not None
    assert m2.promotion_status == ("Promoted" if m2.mae < m2.champion_mae else "Rejected")
    assert spark.read.parquet(runs).count() == 2

    pred = run_inference(spark, feats.drop("month_key"), runs, os.path.join(root, "pred"),
                         "2024-02-10 00:30:00").toPandas()
    assert len(pred) == 72 and (pred.predicted_trips >= 0).all()
    assert pred.groupby("station_id").size().tolist() == [24, 24, 24]
