"""Spark ML models: boosted trees (the champion/challenger model), a linear
model (forecastable by the SQL fold), scoring and importances.

Boosting uses ``GBTRegressor``; the five calendar/rank inputs are marked
categorical with a ``VectorIndexer`` over those columns only (indexing the
lags would turn low-count lags into categories).  Early stopping chooses the
round with the lowest validation error from ``evaluateEachIteration``
(within a patience); the trees after it are cut off the fitted ensemble.
"""
from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from velocube import schemas
from velocube.operators import trees as TR
from velocube.session import scratch_path


def _prep(lags: Sequence[str], cats: Sequence[str], max_categories: int):
    stages = []
    inputs = list(lags)
    if cats:
        stages += [VectorAssembler(inputCols=list(cats), outputCol="_cats", handleInvalid="keep"),
                   VectorIndexer(inputCol="_cats", outputCol="_cats_idx", maxCategories=max_categories,
                                 handleInvalid="keep")]
        inputs.append("_cats_idx")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages


def cast_inputs(df: DataFrame, cols: Sequence[str], y: str = "total_trips") -> DataFrame:
    return df.select(*[c for c in df.columns if c not in cols and c != y],
                     *[F.col(c).cast("double").alias(c) for c in cols], F.col(y).cast("double").alias(y))


def train_gbt(train: DataFrame, valid: DataFrame | None = None,
              lags: Sequence[str] = schemas.LAG_COLS, cats: Sequence[str] = schemas.CATEGORICAL_COLS,
              y: str = "total_trips", max_iter: int = 50, step: float = 0.05, depth: int = 5,
              seed: int = 42, early_stop: bool = True, patience: int = 50) -> tuple[PipelineModel, int]:
    """Fit the boosted-tree pipeline; returns (model, rounds kept).

    With ``early_stop`` the rounds up to the best validation error are kept,
    looking no further than ``patience`` rounds without a gain.  Rounds are
    fitted from the first on, twice as many each time, until the stop is among
    them or ``max_iter`` is reached: equal seeds give equal first rounds, so
    the kept ones are those of a fit of all ``max_iter``.  Every category
    column stays categorical: the limit follows the data.
    """
    from velocube.session import checkpoint_dir
    checkpoint_dir(train.sparkSession)  # lets the boosting loop cut lineage every 10 rounds
    cols = list(lags) + list(cats)
    tr = cast_inputs(train, cols, y)
    most = max([2, *(tr.agg(*[F.count_distinct(c).alias(c) for c in cats]).first() if cats else ())])
    gbt = GBTRegressor(featuresCol="features", labelCol=y, maxIter=max_iter, stepSize=step,
                       maxDepth=depth, seed=seed, maxBins=max(64, most + 1), checkpointInterval=10)
    prep = Pipeline(stages=_prep(lags, cats, most)).fit(tr)
    feats = _parted(prep.transform(tr).select("features", y), len(cols)).checkpoint()  # read by every round, in the same parts
    if not early_stop or valid is None:
        return PipelineModel(prep.stages + [gbt.fit(feats)]), max_iter
    held = _parted(prep.transform(cast_inputs(valid, cols, y)).select("features", y), len(cols)).checkpoint()
    fitted = min(max_iter, patience + max(1, patience // 4))
    while True:
        model = gbt.copy({gbt.maxIter: fitted}).fit(feats)
        rounds, stopped = stop_round(model.evaluateEachIteration(held, "absolute"), patience)
        if stopped or fitted == max_iter:
            break
        fitted = min(max_iter, 2 * fitted)
    return PipelineModel(prep.stages + [_prefix(model, rounds) if rounds < fitted else model]), rounds


PART = 16 << 20


def _parted(feats: DataFrame, width: int) -> DataFrame:
    """In as many parts as its bytes need: a boosting round is a job for every level, so small parts cost more than they give."""
    rows = feats.count()
    return feats.coalesce(max(1, -(-rows * (8 * width + 40) // PART)))


def stop_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the least error, and whether ``patience`` rounds without a gain followed it."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def _prefix(gbt: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The first ``rounds`` trees of a fitted ensemble, with their weights."""
    sc = SparkSession.getActiveSession().sparkContext
    java, gateway = gbt._java_obj, sc._gateway  # noqa: SLF001
    ml = sc._jvm.org.apache.spark.ml.regression  # noqa: SLF001
    trees, weights = gateway.new_array(ml.DecisionTreeRegressionModel, rounds), gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], float(java.treeWeights()[i])
    cut = GBTRegressionModel._from_java(ml.GBTRegressionModel(gbt.uid, trees, weights))  # noqa: SLF001
    return cut.setFeaturesCol(gbt.getFeaturesCol()).setPredictionCol(gbt.getPredictionCol())


def train_linear(train: DataFrame, inputs: Sequence[str] = schemas.MODEL_INPUTS,
                 y: str = "total_trips", reg: float = 0.0) -> PipelineModel:
    tr = cast_inputs(train, inputs, y)
    lr = LinearRegression(featuresCol="features", labelCol=y, regParam=reg)
    return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="features",
                                            handleInvalid="keep"), lr]).fit(tr)


def score(model: PipelineModel, df: DataFrame, cols: Sequence[str], y: str = "total_trips",
          name: str = "predicted") -> DataFrame:
    out = model.transform(cast_inputs(df, cols, y)).withColumnRenamed("prediction", name)
    return out.drop("features", "_cats", "_cats_idx")


def importances(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """(feature, importance) of a fitted boosted-tree model: how many of its nodes split on each input."""
    return TR.split_counts(node_table(model, names), names)


def node_table(model: PipelineModel, inputs: Sequence[str]) -> DataFrame:
    """The nodes of a fitted boosted-tree pipeline as a table of ``operators.trees`` (model-sized, not data-sized).

    ``inputs`` are the model's, lags first.  Category indices become the values they stand for; where the index of unseen
    values goes left, the values that go right are named instead.
    """
    spark = SparkSession.getActiveSession()
    gbt = model.stages[-1]
    maps = next((s.categoryMaps for s in model.stages if s.__class__.__name__ == "VectorIndexerModel"), {})
    first = len(model.stages[-2].getInputCols()) - 1 if maps else 0
    values = {first + j: {int(i): float(v) for v, i in m.items()} for j, m in maps.items()}
    path = scratch_path(spark, f"gbt-{gbt.uid}-{uuid.uuid4().hex}")
    gbt.write().save(path)
    weights, rows = list(gbt.treeWeights), []
    for r in spark.read.parquet(os.path.join(path, "data")).collect():
        n = r["nodeData"]
        split, leaf = n["split"], n["leftChild"] < 0
        feature, threshold, cats, negate = None, None, None, None
        if not leaf:
            feature, parts = split["featureIndex"], list(split["leftCategoriesOrThreshold"])
            if split["numCategories"] == -1:
                threshold = float(parts[0])
            else:
                named = values.get(feature, {})
                left, size, unseen = {int(c) for c in parts}, int(split["numCategories"]), len(named)
                # an index beyond the split's categories goes left where the set of those that go right is the shorter one
                negate = unseen in left or (unseen >= size and len(left) > size // 2)
                cats = [v for i, v in sorted(named.items()) if (i in left) != negate]
            feature = inputs[feature]
        rows.append((r["treeID"], n["id"], n["leftChild"], n["rightChild"], feature, threshold, cats, negate, float(n["prediction"]), float(weights[r["treeID"]])))
    return TR.node_rows(spark, sorted(rows, key=lambda x: x[:2]))


def train_reduced(model: PipelineModel, train: DataFrame, valid: DataFrame | None = None, k: int = 10,
                  candidates: Sequence[str] = schemas.LAG_COLS, y: str = "total_trips",
                  max_iter: int = 50, depth: int = 5, seed: int = 42) -> tuple[PipelineModel, list[str]]:
    """Refit on the ``k`` most important of ``candidates`` (split counts of
    a fitted model whose first inputs are the lags, in order)."""
    imp = {r["feature"]: r["importance"] for r in importances(model, candidates).collect()}
    ranked = sorted(range(len(candidates)), key=lambda i: (-imp[candidates[i]], i))[:k]
    keep = [candidates[i] for i in sorted(ranked)]
    reduced, _ = train_gbt(train, valid, lags=keep, cats=(), y=y, max_iter=max_iter, depth=depth, seed=seed,
                           early_stop=False)
    return reduced, keep
