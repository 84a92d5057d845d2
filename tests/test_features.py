from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from velocube.operators import features as FE
from velocube.operators.ordering import exact_quantiles, lags_distributed, prefix_sums, with_global_rank

T0 = datetime(2024, 1, 1, 0, 0, 0)


def series(spark, hours, station="S1", values=None):
    values = values or list(range(1, len(hours) + 1))
    rows = [(T0 + timedelta(hours=h), station, v) for h, v in zip(hours, values)]
    return spark.createDataFrame(rows, "start_hour timestamp_ntz, station_id string, total_trips long")


def test_sparse_hours_lag_is_previous_present_row(spark):
    df = FE.add_lags(series(spark, [0, 1, 5], values=[10, 20, 30]), ["station_id"], "start_hour", "total_trips", 2)
    r = df.filter(F.hour("start_hour") == 5).first()
    assert r.lag_1 == 20 and r.lag_2 == 10


def test_short_station_rows_after_dropna(spark):
    a = series(spark, list(range(28)), "A")
    b = series(spark, list(range(29)), "B")
    f = FE.calendar_features(FE.add_lags(a.unionByName(b), ["station_id"], "start_hour", "total_trips")).dropna()
    counts = {r.station_id: r["count"] for r in f.groupBy("station_id").count().collect()}
    assert counts == {"B": 1}


def test_chrono_split_positional(spark):
    rows = []
    for i in range(10):
        rows.append((T0 + timedelta(hours=i // 3), f"S{i % 3}", i % 3, i))
    df = spark.createDataFrame(rows, "start_hour timestamp_ntz, station_id string, station_rank int, total_trips long")
    out = FE.chrono_split(df).toPandas().sort_values(["start_hour", "station_rank"])
    assert (out["split"] == "train").sum() == 8
    assert out["split"].tolist() == ["train"] * 8 + ["test"] * 2


def test_latest_state_is_last_row(spark):
    df = FE.add_lags(series(spark, [0, 1, 2, 7]), ["station_id"], "start_hour", "total_trips", 2)
    r = FE.latest_state(df).first()
    assert r.start_hour == T0 + timedelta(hours=7) and r.total_trips == 4 and r.lag_1 == 3


def test_global_rank_matches_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 5000), "v": rng.normal(size=5000), "id": np.arange(5000)})
    # a hot group: one key holds most rows
    pdf.loc[:3500, "g"] = 1
    out = with_global_rank(spark.createDataFrame(pdf), ["v", "id"], ["g"], num_partitions=7).toPandas()
    exp = pdf.sort_values(["g", "v", "id"]).assign(r=lambda x: x.groupby("g").cumcount())
    m = out.merge(exp, on="id")
    assert (m.row_idx == m.r).all()


def test_prefix_sums_match_cumsum(spark):
    pdf = pd.DataFrame({"k": np.arange(1000), "x": np.arange(1000) % 7})
    out = prefix_sums(spark.createDataFrame(pdf), ["k"], ["x"], num_partitions=5).toPandas().sort_values("k")
    assert (out["x_cum"].values == pdf["x"].cumsum().values).all()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 777), "v": rng.integers(0, 50, 777).astype(float)})
    q = exact_quantiles(spark.createDataFrame(pdf), "v", [0.1, 0.5, 0.75], ["g"]).toPandas().set_index("g")
    for g, grp in pdf.groupby("g"):
        np.testing.assert_allclose(q.loc[g, ["q0", "q1", "q2"]].values.astype(float),
                                   np.quantile(grp.v, [0.1, 0.5, 0.75]))


def test_distributed_lags_cross_pieces(spark, monkeypatch):
    """Pieces shorter than the lags, groups that span, begin and end within pieces, null groups and values, small batches."""
    pdf = pd.DataFrame({"t": np.arange(300), "y": np.arange(300) * 3})
    out = lags_distributed(spark.createDataFrame(pdf), "y", ["t"], 5, num_partitions=100).toPandas().sort_values("t")
    for k in (1, 5):
        exp = pdf["y"].shift(k)
        assert ((out[f"lag_{k}"].isna() & exp.isna()) | (out[f"lag_{k}"] == exp)).all()
    rng = np.random.default_rng(4)
    rows = [(g, int(t), None if rng.random() < 0.1 else int(rng.integers(0, 99)))
            for g, n in (("a", 3), ("b", 150), (None, 40), ("c", 1), ("", 30)) for t in rng.permutation(n)]
    df = spark.createDataFrame(rows, "g string, t int, y long")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        got = {(r.g, r.t): tuple(r[c] for c in ("lag_1", "lag_2", "lag_4")) for r in lags_distributed(df, "y", ["t"], 4, ["g"], num_partitions=9).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    values = {(g, t): y for g, t, y in rows}
    assert got == {(g, t): tuple(values.get((g, t - k)) for k in (1, 2, 4)) for g, t in values}


def test_chrono_split_ties_and_edges(spark):
    from velocube.operators.features import chrono_split
    rows = [(h, r) for h in range(10) for r in (0, 0, 1)]
    df = spark.createDataFrame(rows, "start_hour int, station_rank int")
    split = lambda d, f: sorted((r.start_hour, r.station_rank) for r in chrono_split(d, frac=f).filter("split = 'train'").collect())
    assert split(df, 0.8) == rows[:24] and split(df, 0.5) == rows[:15]
    assert split(df, 0.51) == rows[:15] and split(df, 0.0) == [] and split(df, 1.0) == rows
    assert split(df, 16 / 30) == rows[:17]  # the row that ties with the last one stays with it
    assert chrono_split(df.limit(0)).count() == 0


def test_rank_keeps_null_group(spark):
    pdf = pd.DataFrame({"g": [None, None, "a", "a", None], "v": [3.0, 1.0, 2.0, 1.0, 2.0]})
    out = with_global_rank(spark.createDataFrame(pdf, "g string, v double"), ["v"], ["g"]).toPandas()
    assert len(out) == 5
    assert sorted(out[out.g.isna()].row_idx.tolist()) == [0, 1, 2]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "x", "y"]), st.integers(0, 30)),
                min_size=1, max_size=120),
       st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantiles_property(spark, rows, q):
    pdf = pd.DataFrame(rows, columns=["g", "v"]).astype({"v": float})
    out = exact_quantiles(spark.createDataFrame(pdf), "v", [q], ["g"], num_partitions=3).toPandas()
    exp = pdf.groupby("g")["v"].quantile(q)
    got = out.set_index("g")["q0"]
    assert set(got.index) == set(exp.index)
    for g in exp.index:
        assert abs(got[g] - exp[g]) < 1e-9
