"""Distribution drift between a reference and a current table, per column.

``drift_table`` counts every distinct value of every column in both tables
and adds running counts (``ordering.prefix_sums``, so no column is gathered
into one task).  It is materialised once; all measures read it:

* PSI over decile bins of the reference (exact quantiles), proportions
  floored at 1e-6; drift when PSI >= 0.2.
* Jensen-Shannon distance over the same bins (natural logarithm).
* Two-sample Kolmogorov-Smirnov statistic D = max |F_ref - F_cur|; drift when
  D exceeds the alpha=0.05 critical value 1.358 * sqrt((n+m)/(n*m)).
* Wasserstein distance: the area between the two distribution functions.

Totals come with the running counts; bin edges have one row a column, so they
are broadcast.
Thresholds are this library's parameters.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from velocube.operators.ordering import lags_distributed, prefix_sums

PSI_THRESHOLD = 0.2
KS_C_ALPHA = 1.358  # alpha = 0.05
PSI_FLOOR = 1e-6


def drift_table(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, v, c_ref, c_cur, c_ref_cum, c_cur_cum, n_ref, n_cur), one row per distinct value; materialised."""
    both = (ref.select(*cols, F.lit(1).alias("_ref")).unionByName(cur.select(*cols, F.lit(0).alias("_ref")))
            .select("_ref", *[F.col(c).cast("double").alias(c) for c in cols]))
    long = both.unpivot(["_ref"], list(cols), "feature", "v").filter(F.col("v").isNotNull())
    dist = long.groupBy("feature", "v").agg(F.sum("_ref").alias("c_ref"), F.sum(1 - F.col("_ref")).alias("c_cur"))
    cum = prefix_sums(dist, ["v"], ["c_ref", "c_cur"], ["feature"], total_suffix="_all")
    return cum.withColumnsRenamed({"c_ref_all": "n_ref", "c_cur_all": "n_cur"})


def _bins(table: DataFrame, bins: int) -> DataFrame:
    """(feature, bin, e, a): shares of reference and current per quantile bin of the reference."""
    lo, hi = F.col("c_ref_cum") - F.col("c_ref"), F.col("c_ref_cum") - 1
    picks, edges = [], []
    for i in range(1, bins):
        pos = F.lit(i / bins) * (F.col("n_ref") - 1)
        for name, r in ((f"_a{i}", F.floor(pos)), (f"_b{i}", F.ceil(pos))):
            picks.append(F.max(F.when((F.col("c_ref") > 0) & (r >= lo) & (r <= hi), F.col("v"))).alias(name))
        picks.append(F.max(pos - F.floor(pos)).alias(f"_f{i}"))
        edges.append(F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}"))
    edges = table.groupBy("feature").agg(*picks).select("feature", F.array(*edges).alias("edges"))
    placed = table.join(F.broadcast(edges), "feature").withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("v"))))
    share = lambda c: F.greatest(F.sum(f"c_{c}") / F.max(f"n_{c}"), F.lit(PSI_FLOOR))
    return placed.groupBy("feature", "bin").agg(share("ref").alias("e"), share("cur").alias("a"))


def psi(table: DataFrame, bins: int = 10) -> DataFrame:
    e, a = F.col("e"), F.col("a")
    out = _bins(table, bins).groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    return out.withColumn("drift", F.col("psi") >= PSI_THRESHOLD)


def jensen_shannon(table: DataFrame, bins: int = 10) -> DataFrame:
    e, a = F.col("e"), F.col("a")
    m = (a + e) / 2
    return _bins(table, bins).groupBy("feature").agg(F.sqrt(F.sum(a * F.log(a / m) + e * F.log(e / m)) / 2).alias("js"))


def ks(table: DataFrame) -> DataFrame:
    gap = F.abs(F.col("c_ref_cum") / F.col("n_ref") - F.col("c_cur_cum") / F.col("n_cur"))
    out = table.groupBy("feature", "n_ref", "n_cur").agg(F.max(gap).alias("ks_stat"))
    crit = KS_C_ALPHA * F.sqrt((F.col("n_ref") + F.col("n_cur")) / (F.col("n_ref") * F.col("n_cur")))
    return out.select("feature", "ks_stat", crit.alias("critical"), (F.col("ks_stat") > crit).alias("drift"))


def wasserstein(table: DataFrame) -> DataFrame:
    """Sum over neighbouring values of their distance times the gap between the functions below the upper one."""
    steps = lags_distributed(table, "v", ["v"], 1, ["feature"], prefix="_below_")
    gap = F.abs((F.col("c_ref_cum") - F.col("c_ref")) / F.col("n_ref") - (F.col("c_cur_cum") - F.col("c_cur")) / F.col("n_cur"))
    return steps.groupBy("feature").agg(F.coalesce(F.sum((F.col("v") - F.col("_below_1")) * gap), F.lit(0.0)).alias("wasserstein"))


def drifted_share(verdicts: DataFrame) -> DataFrame:
    """One row: columns, drifted ones, and their share, from (feature, drift)."""
    return verdicts.agg(F.count(F.lit(1)).alias("columns"), F.count_if("drift").alias("drifted"),
                        (F.count_if("drift") / F.count(F.lit(1))).alias("share"))


def drift_psi(ref: DataFrame, cur: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    return psi(drift_table(ref, cur, cols), bins)


def drift_ks(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    return ks(drift_table(ref, cur, cols))
