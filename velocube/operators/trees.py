"""Tree ensembles as a table: one row a node, scored, forecast and explained by Spark SQL expressions.

A node table has the columns of ``NODES``.  Inner nodes name the input they split on and send a row left when its value is
at most ``threshold``, or, for categories, when it is among ``categories`` (with ``negate``: when it is not); leaves have no
children.  A tree counts with its weight.  The table comes from a fitted model (``models.node_table``) or from anywhere else.

For scoring the table becomes one row of arrays (its size is the model's, whatever the data), attached to the rows; a
tree is walked by an ``aggregate`` over its depth whose state is the node, so nothing leaves the JVM.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from velocube import schemas
from velocube.operators.ordering import attach_group_stats

NODES = ("tree int, node int, left int, right int, feature string, threshold double, categories array<double>, "
         "negate boolean, prediction double, weight double")
_TREE = ["left", "right", "input", "threshold", "categories", "negate", "prediction"]


def node_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """A node table of rows on the driver (a model's)."""
    return spark.createDataFrame(list(rows), NODES)


def ensemble(nodes: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """One row: ``trees``, an array of structs of arrays by node number, and ``depth``, the longest walk.

    Node numbers of a tree run from 0, its root, without gaps; a feature becomes its place in ``inputs``.
    """
    place = F.array_position(F.array(*[F.lit(c) for c in inputs]), F.col("feature")) - 1
    each = F.array_sort(F.collect_list(F.struct(
        "node", "left", "right", F.coalesce(place, F.lit(-1)).cast("int").alias("input"), F.coalesce("threshold", F.lit(0.0)).alias("threshold"),
        "categories", F.coalesce("negate", F.lit(False)).alias("negate"), "prediction")))
    trees = nodes.groupBy("tree", "weight").agg(each.alias("n"))
    one = F.struct("tree", "weight", *[F.col("n")[c].alias(c) for c in _TREE])  # a field of an array of structs is an array
    trees = trees.select(one.alias("t")).agg(F.array_sort(F.collect_list("t")).alias("trees"))
    return trees.withColumn("depth", F.coalesce(F.array_max(F.transform("trees", lambda t: F.size(t["left"]))), F.lit(0)))


def _step(t: Column, x: Column, n: Column) -> Column:
    """The node after node n of tree t for inputs x; a leaf stays."""
    v = F.get(x, F.get(t["input"], n))
    cats = F.get(t["categories"], n)
    member = F.array_contains(cats, v) != F.get(t["negate"], n)
    left = F.coalesce(F.when(cats.isNotNull(), member).otherwise(v <= F.get(t["threshold"], n)), F.lit(False))
    inner = F.get(t["left"], n) >= 0
    return F.when(inner, F.when(left, F.get(t["left"], n)).otherwise(F.get(t["right"], n))).otherwise(n)


def _walk(t: Column, x: Column, depth: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), F.lit(0), lambda n, _: _step(t, x, n))


def predict(x: Column, trees: Column, depth: Column) -> Column:
    """Weighted sum of the leaves that inputs ``x`` (doubles, in the ensemble's order) reach."""
    return F.aggregate(trees, F.lit(0.0), lambda acc, t: acc + t["weight"] * F.get(t["prediction"], _walk(t, x, depth)))


def deepest(nodes: DataFrame) -> int:
    """Levels below the roots: how far a walk goes."""
    level, n = nodes.where("node = 0").select("tree", "left", "right"), 0
    children = nodes.select("tree", F.col("node").alias("at"), F.col("left").alias("l"), F.col("right").alias("r"))
    while True:
        down = level.where("left >= 0").select("tree", F.explode(F.array("left", "right")).alias("at")).join(children, ["tree", "at"])
        if down.isEmpty():
            return n
        level, n = down.select("tree", F.col("l").alias("left"), F.col("r").alias("right")), n + 1


def attached(df: DataFrame, nodes: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """The rows with the ensemble's two columns, ``trees`` and ``depth``."""
    return attach_group_stats(df, ensemble(nodes, inputs).withColumn("depth", F.lit(deepest(nodes))), [])


def _inputs(inputs: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in inputs])


def score(df: DataFrame, nodes: DataFrame, inputs: Sequence[str] = schemas.MODEL_INPUTS, name: str = "predicted") -> DataFrame:
    """The rows with the ensemble's prediction."""
    return attached(df, nodes, inputs).withColumn(name, predict(_inputs(inputs), F.col("trees"), F.col("depth"))).drop("trees", "depth")


def split_counts(nodes: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """(feature, importance): how many nodes split on each input, 0 for the others (the default of the usual boosters)."""
    counts = nodes.where("left >= 0").groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    names = nodes.sparkSession.createDataFrame([(c,) for c in inputs], "feature string")
    return names.join(counts, "feature", "left").select("feature", F.coalesce("n", F.lit(0)).cast("double").alias("importance"))


def cover(df: DataFrame, nodes: DataFrame, inputs: Sequence[str] = schemas.MODEL_INPUTS) -> DataFrame:
    """(feature, splits, rows): nodes that split on an input, and how many rows of df reach them."""
    rows = attached(df, nodes, inputs).withColumn("x", _inputs(inputs))
    paths = F.flatten(F.transform("trees", lambda t: F.filter(F.transform(
        F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("depth"), F.lit(1))), F.array(F.lit(0)),
                    lambda path, _: F.concat(path, F.array(_step(t, F.col("x"), F.element_at(path, -1))))),
        lambda n: F.when(F.get(t["left"], n) >= 0, F.get(t["input"], n))), lambda f: f.isNotNull())))
    seen = rows.select(F.explode(paths).alias("input")).groupBy("input").agg(F.count(F.lit(1)).alias("rows"))
    names = F.element_at(F.array(*[F.lit(c) for c in inputs]), F.col("input") + 1)
    splits = split_counts(nodes, inputs).where("importance > 0")
    return splits.join(seen.select(names.alias("feature"), "rows"), "feature", "left").select(
        "feature", F.col("importance").cast("long").alias("splits"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))
