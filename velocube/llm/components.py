"""Connected components of an edge table, as Spark joins; nothing is gathered on the driver."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocube.llm.common import written


def _jump(parent: DataFrame) -> DataFrame:
    up = parent.select(F.col("id").alias("parent"), F.col("parent").alias("up"))
    return parent.join(up, "parent", "left").select("id", F.coalesce("up", "parent").alias("parent"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of edges (a, b): component is the smallest id reachable.

    Each round every vertex takes its smallest neighbour as parent, parents are followed four steps, and the
    edges are rewritten between parents; edges inside one tree vanish.  Self loops and repeated edges are harmless.
    """
    edges = edges.select("a", "b")
    label = written(edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
                    .select("id", F.col("id").alias("component")), "cc-label")
    while True:
        edges = written(edges.where("a <> b").distinct(), "cc-edges")
        if edges.isEmpty():
            return label
        both = edges.union(edges.select("b", "a")).toDF("id", "other")
        parent = written(both.groupBy("id").agg(F.min("other").alias("other")).select("id", F.least("id", "other").alias("parent")), "cc-parent")
        parent = written(_jump(_jump(parent)), "cc-parent")
        step = parent.select(F.col("id").alias("component"), "parent")
        label = written(label.join(step, "component", "left").select("id", F.coalesce("parent", "component").alias("component")), "cc-label")
        a, b = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        edges = edges.join(a, "a").join(b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
