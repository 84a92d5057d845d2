from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from velocube import schemas
from velocube.operators import forecast as FC

L = datetime(2024, 1, 5, 10)  # a Friday


def state(spark, last=L, lags=None, total=7, rank=0, station="S1"):
    lags = lags or [float(k) for k in range(1, 29)]
    row = {"start_hour": last, "station_id": station, "total_trips": total, "station_rank": rank,
           "hour": last.hour, "day_of_week": last.weekday(), "is_weekend": int(last.weekday() >= 5),
           "month": last.month}
    row.update({f"lag_{k}": int(v) for k, v in enumerate(lags, start=1)})
    return spark.createDataFrame([row], schemas.FEATURES)


def reference_walk(spec, last, lags, total, rank, as_of, mode="reference", h=24):
    """Plain-Python statement of the bridge rule (the thing the fold must equal)."""
    lags = list(map(float, lags))
    if mode == "aligned":
        lags = [float(total)] + lags[:-1]
    G = int((as_of - last).total_seconds() / 3600)
    cal = (last.hour, last.weekday(), int(last.weekday() >= 5), last.month)

    def f(lg, c):
        v = spec.intercept + sum(w * x for w, x in zip(spec.lag_w, lg))
        v += spec.hour_w * c[0] + spec.dow_w * c[1] + spec.weekend_w * c[2] + spec.month_w * c[3] + spec.rank_w * rank
        return max(0.0, v)
    for i in range(1, G + 1):
        t = last + timedelta(hours=i)
        tc = (t.hour, t.weekday(), int(t.weekday() >= 5), t.month)
        p = f(lags, tc if mode == "aligned" else cal)
        lags, cal = [p] + lags[:-1], tc
    out = []
    end = last + timedelta(hours=G)
    for i in range(1, h + 1):
        t = end + timedelta(hours=i)
        tc = (t.hour, t.weekday(), int(t.weekday() >= 5), t.month)
        p = f(lags, tc if mode == "aligned" else cal)
        out.append((t, p))
        lags, cal = [p] + lags[:-1], tc
    return out


SPEC = FC.LinearSpec(0.3, [0.4, 0.2] + [0.0] * 21 + [0.25] + [0.0] * 4, 0.02, -0.05, 0.3, 0.01, -0.2)


@pytest.mark.parametrize("gap,mode", [(0, "reference"), (3, "reference"), (-2, "reference"), (30, "aligned"),
                                      (3, "aligned")])
def test_fold_equals_walk(spark, gap, mode):
    as_of = L + timedelta(hours=gap, minutes=40)
    out = FC.forecast_linear(state(spark), SPEC, as_of, mode=mode).orderBy("step").toPandas()
    exp = reference_walk(SPEC, L, list(range(1, 29)), 7, 0, as_of, mode)
    assert len(out) == 24
    assert [pd.Timestamp(t) for t, _ in exp] == list(out["target_hour"])
    np.testing.assert_allclose(out["predicted_trips"].values, [p for _, p in exp], rtol=1e-12)


def test_negative_model_output_clamped(spark):
    spec = FC.LinearSpec(-100.0, [0.0] * 28)
    out = FC.forecast_linear(state(spark), spec, L + timedelta(hours=5)).toPandas()
    assert len(out) == 24 and (out["predicted_trips"] == 0.0).all()


def _tree_rows(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        t = L + timedelta(hours=i)
        lags = rng.integers(0, 20, 28)
        rows.append({"start_hour": t, "station_id": "S%d" % (i % 3), "total_trips": int(lags[:3].sum() + 9 * (t.hour in (7, 8, 17)) + 4 * (i % 3 == 1)),
                     "station_rank": i % 3, "hour": t.hour, "day_of_week": t.weekday(),
                     "is_weekend": int(t.weekday() >= 5), "month": t.month,
                     **{f"lag_{k}": int(v) for k, v in enumerate(lags, start=1)}})
    return spark.createDataFrame(rows, schemas.FEATURES)


def test_node_table_scores_like_spark_transform(spark):
    """The walk over the node table, in the JVM and as SQL in DuckDB, equals model.transform; unseen categories included."""
    import duckdb
    from velocube import oracle
    from velocube.operators import models as M
    from velocube.operators import trees as TR
    df = _tree_rows(spark).cache()
    model, _ = M.train_gbt(df.filter("hour <> 5"), None, max_iter=5, depth=4, early_stop=False)
    nodes = M.node_table(model, schemas.MODEL_INPUTS)
    assert nodes.filter("categories IS NOT NULL").count() > 0
    expected = {(r.start_hour, r.station_id): r.predicted for r in M.score(model, df, schemas.MODEL_INPUTS).collect()}
    scored = TR.score(df, nodes)
    assert not any(w in scored._jdf.queryExecution().toString() for w in ("Python", "Pandas", "Arrow"))
    got = {(r.start_hour, r.station_id): r.predicted for r in scored.collect()}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    features = df.toPandas()  # noqa: F841 - read by DuckDB
    sql = f"SELECT start_hour, station_id, {oracle.tree_expr([tuple(r) for r in nodes.collect()], str)} AS p FROM features"
    for hour, station, p in duckdb.sql(sql).fetchall():
        assert abs(got[(hour, station)] - p) < 1e-9
    counts = {r.feature: r.importance for r in M.importances(model, schemas.MODEL_INPUTS).collect()}
    assert list(sorted(counts)) == sorted(schemas.MODEL_INPUTS) and sum(counts.values()) == nodes.filter("left >= 0").count()
    reached = {r.feature: (r.splits, r.rows) for r in TR.cover(df, nodes).collect()}
    roots = [r.feature for r in nodes.filter("node = 0 AND left >= 0").collect()]
    assert all(reached[f][1] >= 300 * roots.count(f) for f in roots) and {f: n for f, (n, _) in reached.items()} == {f: n for f, n in counts.items() if n}


def test_tree_forecast_starts_with_the_models_prediction(spark):
    from velocube.operators import models as M
    df = _tree_rows(spark)
    model, _ = M.train_gbt(df, None, max_iter=4, depth=3, early_stop=False)
    last = df.orderBy(F.col("start_hour").desc()).limit(3).cache()
    expected = {r.station_id: max(0.0, r.predicted) for r in M.score(model, last, schemas.MODEL_INPUTS).collect()}
    out = FC.forecast_trees(last, M.node_table(model, schemas.MODEL_INPUTS), L + timedelta(hours=297)).collect()
    assert len(out) == 72
    ends = {r.station_id: r.start_hour for r in last.collect()}
    first = {r.station_id: r.predicted_trips for r in FC.forecast_trees(last, M.node_table(model, schemas.MODEL_INPUTS), L, emit_bridge=False).filter("step = 1").collect()}
    assert len(ends) == 3 and all(abs(first[k] - expected[k]) < 1e-9 for k in expected)


def test_fold_first_step_equals_spark_ml_transform(spark):
    """With no gap, step 1 of the fold scores the last feature row itself:
    it must equal the fitted Spark ML linear model's own prediction."""
    from velocube.operators import models as M
    rng = np.random.default_rng(5)
    rows = []
    for i in range(200):
        t = L + timedelta(hours=i)
        lags = rng.integers(0, 20, 28)
        rows.append({"start_hour": t, "station_id": "S1", "total_trips": int(lags[0] + lags[23] + 2),
                     "station_rank": 0, "hour": t.hour, "day_of_week": t.weekday(),
                     "is_weekend": int(t.weekday() >= 5), "month": t.month,
                     **{f"lag_{k}": int(v) for k, v in enumerate(lags, start=1)}})
    df = spark.createDataFrame(rows, schemas.FEATURES)
    lr = M.train_linear(df)
    spec = FC.LinearSpec.from_model(lr.stages[-1].coefficients.toArray(), lr.stages[-1].intercept)
    last = df.orderBy(F.col("start_hour").desc()).limit(1)
    expected = max(0.0, M.score(lr, last, schemas.MODEL_INPUTS).first().predicted)
    last_hour = rows[-1]["start_hour"]
    out = FC.forecast_linear(last, spec, last_hour + timedelta(minutes=30)).orderBy("step").first()
    assert out.target_hour == last_hour + timedelta(hours=1)
    assert abs(out.predicted_trips - expected) < 1e-9
