from pyspark.sql import functions as F

from velocube.operators import evaluation as EV
from velocube.operators import drift as DR


def scored(spark, rows):
    return spark.createDataFrame(rows, "total_trips double, predicted double")


def test_metrics_and_wmape_zero_volume(spark):
    m = EV.error_metrics(scored(spark, [(1.0, 2.0), (3.0, 1.0)])).first()
    assert m.mae == 1.5 and abs(m.rmse - (2.5 ** 0.5)) < 1e-12 and abs(m.wmape - 75.0) < 1e-12
    z = EV.error_metrics(scored(spark, [(0.0, 1.0), (0.0, 2.0)])).first()
    assert z.wmape is None


def test_promote_strict_and_no_champion(spark):
    mae = lambda v: spark.createDataFrame([(v,)], "mae double")
    assert EV.promote(mae(1.0), None).first().promotion_status == "Promoted"
    assert EV.promote(mae(1.0), mae(1.0)).first().promotion_status == "Rejected"
    assert EV.promote(mae(0.9), mae(1.0)).first().promotion_status == "Promoted"


def test_best_model_and_importance_share(spark):
    runs = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 1.0)], "model_name string, mae double")
    assert EV.best_model(runs).first().model_name == "b"
    imp = spark.createDataFrame([(f"f{i}", float(i)) for i in range(12)], "feature string, importance double")
    sh = {r.feature: r.share for r in EV.importance_share(imp, 10).collect()}
    assert len(sh) == 10 and "f0" not in sh and abs(sum(sh.values()) - 100) < 0.5


def test_baseline_hour_mean(spark):
    tr = spark.createDataFrame([(8, 2.0), (8, 4.0), (9, 1.0)], "hour int, total_trips double")
    te = spark.createDataFrame([(8, 5.0), (10, 1.0)], "hour int, total_trips double")
    out = {r.hour: r.predicted for r in EV.baseline_hour_mean(tr, te).collect()}
    assert out == {8: 3.0, 10: None}


def test_drift_identical_vs_shifted(spark):
    a = spark.range(200).select(F.col("id").cast("double").alias("x"))
    b = spark.range(200).select((F.col("id") + 150).cast("double").alias("x"))
    ks_same = DR.drift_ks(a, a, ["x"]).first()
    ks_shift = DR.drift_ks(a, b, ["x"]).first()
    assert ks_same.ks_stat == 0.0 and not ks_same.drift
    assert abs(ks_shift.ks_stat - 0.75) < 1e-12 and ks_shift.drift
    assert DR.drift_psi(a, b, ["x"]).first().drift


def test_wasserstein_and_js(spark):
    a = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 5]], "x double")
    b = spark.createDataFrame([(float(v),) for v in [3, 4, 4, 7, 7, 7, 2, 1]], "x double")
    t = DR.drift_table(a, b, ["x"])
    import numpy as np
    xs = np.sort(np.concatenate([[1, 2, 2, 5], [3, 4, 4, 7, 7, 7, 2, 1]]))
    grid = np.unique(xs)
    f = lambda v: np.searchsorted(np.sort(v), grid[:-1], side="right") / len(v)
    want = float((np.diff(grid) * abs(f([1, 2, 2, 5]) - f([3, 4, 4, 7, 7, 7, 2, 1]))).sum())
    assert abs(DR.wasserstein(t).first().wasserstein - want) < 1e-12
    same = DR.drift_table(a, a, ["x"])
    assert DR.wasserstein(same).first().wasserstein == 0.0 and DR.jensen_shannon(same).first().js < 1e-9
    assert 0 < DR.jensen_shannon(t).first().js < 1
    share = DR.drifted_share(DR.psi(t)).first()
    assert share["columns"] == 1 and share.share in (0.0, 1.0)
