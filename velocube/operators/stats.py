"""Exploration statistics: describe, box plot, KDE, histogram, correlation
scan, profile, bounding box, marker scaling.  All one-pass or two-pass
distributed aggregates; exact quantiles use ``ordering.exact_quantiles``."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from velocube.operators.ordering import attach_group_stats, quantiles_from_ranks, value_rank_table
from velocube.session import checkpoint_dir


def _moments(cum: DataFrame, group: Sequence[str], x: str) -> DataFrame:
    """count, mean, sample std, min and max from (value, count) rows - two passes over
    the small distinct-value table (mean first, then squared deviations) for
    the numerical stability of a streaming variance."""
    g = list(group)
    c, v = F.col("_vc_c"), F.col(x)
    first = cum.groupBy(*g).agg(F.sum(c).alias("count"), (F.sum(c * v) / F.sum(c)).alias("mean"),
                                F.min(v).alias("min"), F.max(v).alias("max"))
    dev = attach_group_stats(cum, first, g)
    second = dev.groupBy(*g).agg(F.sum(c * F.pow(v - F.col("mean"), 2)).alias("_ss"))
    out = first.join(second, g, "inner") if g else attach_group_stats(first, second, [])
    return out.select(*g, "count", "mean", "min", "max",
                      F.sqrt(F.try_divide(F.col("_ss"), F.col("count") - 1)).alias("std"))


def describe_by(df: DataFrame, group: Sequence[str], x: str) -> DataFrame:
    """count, mean, median (exact, linear) and sample std of ``x`` per group;
    one scan: everything comes from the materialised distinct-value table."""
    g = list(group)
    cum = value_rank_table(df, x, g)
    med = quantiles_from_ranks(cum, x, [0.5], g, names=["median"])
    mom = _moments(cum, g, x).drop("min", "max")
    return mom.join(med, g, "inner") if g else attach_group_stats(mom, med, [])


def box_stats(df: DataFrame, group: Sequence[str], x: str, whis: float = 1.5) -> DataFrame:
    """Quartiles, IQR, whiskers (most extreme values within whis*IQR of the
    box) and number of outliers per group; one scan (distinct-value table)."""
    g = list(group)
    cum = value_rank_table(df, x, g)
    qs = quantiles_from_ranks(cum, x, [0.25, 0.5, 0.75], g, names=["q1", "median", "q3"])
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1"))
    rows = attach_group_stats(cum, qs, g)
    lo = F.col("q1") - whis * F.col("iqr")
    hi = F.col("q3") + whis * F.col("iqr")
    v = F.col(x)
    agg = rows.groupBy(*g).agg(
        F.min(F.when(v >= lo, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).alias("whisker_hi"),
        F.sum(F.when((v < lo) | (v > hi), F.col("_vc_c")).otherwise(0)).alias("n_outliers"))
    return qs.join(agg, g, "inner") if g else attach_group_stats(qs, agg, [])


def kde(df: DataFrame, group: Sequence[str], x: str, gridsize: int = 200, cut: float = 3.0,
        bw_adjust: float = 1.0) -> DataFrame:
    """Gaussian KDE of ``x`` per group, each group normalised on its own,
    Scott bandwidth (sample std * n^-1/5), evaluated on ``gridsize`` points
    from min - cut*h to max + cut*h.

    Exact and linear in the data: rows collapse to (group, value, weight);
    every distinct value looks up its group's grid (one stats row per group)
    and emits its weighted kernel at the ``gridsize`` grid points, which a
    ``groupBy(group, grid point)`` sums (combined map-side, so the shuffle
    carries at most groups x gridsize x partitions rows).
    """
    g = list(group)
    v = F.col(x).cast("double")
    checkpoint_dir(df.sparkSession)
    pts = df.filter(v.isNotNull()).groupBy(*g, v.alias("v")).agg(F.count(F.lit(1)).alias("_vc_c")).checkpoint()
    st = _moments(pts, g, "v")  # mean first, then squared deviations: no cancellation
    pts = pts.withColumnRenamed("_vc_c", "c")
    st = st.select(*g, F.col("count").alias("n"), F.col("min").alias("lo"), F.col("max").alias("hi"),
                   (F.col("std") * F.pow(F.col("count"), F.lit(-0.2)) * bw_adjust).alias("h"))
    st = (st.withColumn("gmin", F.col("lo") - cut * F.col("h"))
            .withColumn("step", ((F.col("hi") + cut * F.col("h")) - F.col("gmin")) / (gridsize - 1))
            .select(*g, "n", "h", "gmin", "step"))
    rows = attach_group_stats(pts, st, g)
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    contrib = F.transform(F.sequence(F.lit(0), F.lit(gridsize - 1)), lambda i: F.col("c") * F.exp(
        -0.5 * F.pow(((F.col("gmin") + i * F.col("step")) - F.col("v")) / F.col("h"), 2)) / norm)
    exploded = rows.select(*g, "gmin", "step", F.posexplode(contrib).alias("i", "w"))
    return (exploded.groupBy(*g, "i", "gmin", "step").agg(F.sum("w").alias("density"))
            .select(*g, "i", (F.col("gmin") + F.col("i") * F.col("step")).alias("x"), "density"))


def kde_binned(df: DataFrame, group: Sequence[str], x: str, gridsize: int = 200, cut: float = 3.0, bins: int = 4096,
               reach: float = 8.0) -> DataFrame:
    """``kde`` of a continuous column by linear binning: at most ``bins`` + 1 rows a group, whatever the distinct values.

    Each row divides its weight between the two neighbouring points of a fine grid (one hash aggregate of counts and
    offsets); the fine grid's points then add their kernels, cut off ``reach`` bandwidths away, to the ``gridsize`` points
    asked for.  The result is off by less than (fine step / bandwidth)^2 / 8 of the kernel's height.
    Groups without spread (one value) have no row.
    """
    g = list(group)
    v = F.col(x).cast("double")
    st = df.filter(v.isNotNull()).groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.stddev_samp(v).alias("std"))
    st = st.withColumn("h", F.col("std") * F.pow("n", F.lit(-0.2))).filter("h > 0")
    st = (st.withColumn("gmin", F.col("lo") - cut * F.col("h")).withColumn("span", (F.col("hi") + cut * F.col("h")) - F.col("gmin"))
            .select(*g, "n", "h", "gmin", "span"))
    at = (v - F.col("gmin")) / (F.col("span") / (bins - 1))
    rows = attach_group_stats(df.filter(v.isNotNull()).select(*g, v.alias(x)), st, g)
    keys = [*g, "n", "h", "gmin", "span"]
    near = rows.groupBy(*keys, F.floor(at).alias("b")).agg(F.count(F.lit(1)).alias("c"), F.sum(at - F.floor(at)).alias("s"))
    fine = near.select(*keys, F.inline(F.array(F.struct(F.col("b").alias("k"), (F.col("c") - F.col("s")).alias("w")),
                                               F.struct((F.col("b") + 1).alias("k"), F.col("s").alias("w")))))
    fine = fine.groupBy(*keys, "k").agg(F.sum("w").alias("w")).withColumn("u", F.col("k") * (F.col("span") / (bins - 1)))
    step = F.col("span") / (gridsize - 1)
    first = F.greatest(F.ceil((F.col("u") - reach * F.col("h")) / step), F.lit(0))
    last = F.least(F.floor((F.col("u") + reach * F.col("h")) / step), F.lit(gridsize - 1))
    terms = fine.withColumn("i", F.explode(F.sequence(first, last)))
    kernel = F.col("w") * F.exp(-0.5 * F.pow((F.col("i") * step - F.col("u")) / F.col("h"), 2))
    dens = terms.groupBy(*keys, "i").agg(F.sum(kernel).alias("t"))
    grid = st.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(gridsize - 1).cast("long"))))
    out = grid.join(dens.select(*g, "i", "t"), [*g, "i"], "left")
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return out.select(*g, "i", (F.col("gmin") + F.col("i") * step).alias("x"), (F.coalesce("t", F.lit(0.0)) / norm).alias("density"))


def nice_step(span: Column, maxbins: int = 50) -> Column:
    """Bin step chosen like Vega's ``bin`` with base 10 and divisors [5, 2]."""
    level = math.ceil(math.log10(maxbins))
    step = F.pow(F.lit(10.0), F.floor(F.log10(span) + 0.5) - level)
    for _ in range(3):  # grows at most twice for any maxbins
        step = F.when(F.ceil(span / step) > maxbins, step * 10).otherwise(step)
    for d in (5, 2):
        step = F.when(span / (step / d) <= maxbins, step / d).otherwise(step)
    return step


def histogram(df: DataFrame, x: str, group: Sequence[str] = (), maxbins: int = 50) -> DataFrame:
    """Counts per 'nice' bin of ``x`` (at most ``maxbins`` bins over the
    extent of all rows), per group.  Runs on every row."""
    g = list(group)
    v = F.col(x)
    ext = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    span = F.when(span > 0, span).otherwise(F.greatest(F.abs(F.col("_lo")), F.lit(1.0)))
    ext = ext.withColumn("_step", nice_step(span, maxbins))
    ext = (ext.withColumn("_start", F.floor(F.col("_lo") / F.col("_step") + 1e-14) * F.col("_step"))
              .withColumn("_stop", F.ceil(F.col("_hi") / F.col("_step")) * F.col("_step")))
    rows = attach_group_stats(df.filter(v.isNotNull()).select(*g, x), ext, [])
    clamped = F.least(v, F.col("_stop") - F.col("_step"))
    b = F.col("_start") + F.col("_step") * F.floor(F.lit(1e-14) + (clamped - F.col("_start")) / F.col("_step"))
    return (rows.withColumn("bin_start", b).withColumn("bin_end", F.col("bin_start") + F.col("_step"))
            .filter(F.col("bin_start").isNotNull() if not g else F.lit(True))
            .groupBy(*g, "bin_start", "bin_end").agg(F.count(F.lit(1)).alias("count")))


def corr_scan(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column with ``target`` (one aggregate),
    unpivoted to (feature, corr) and sorted descending; NaN -> NULL."""
    y = F.col(target).cast("double")

    def corr(c):  # covariance / (std x * std y); NULL when a column is constant
        x = F.col(c).cast("double")
        return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
    wide = df.agg(*[corr(c).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "feature", "corr")
    return (long.withColumn("corr", F.when(F.isnan("corr"), None).otherwise(F.col("corr")))
            .orderBy(F.col("corr").desc_nulls_last(), "feature"))


def profile(df: DataFrame) -> DataFrame:
    """Per column: declared type, non-NULL count and row count (one pass)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    long = wide.unpivot(["_rows"], cols, "column", "non_null")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
        "column string, dtype string, position int")
    return long.join(F.broadcast(types), "column").select(
        "position", "column", "dtype", "non_null", F.col("_rows").alias("rows"))


def bbox(df: DataFrame, lat: str = "lat", lng: str = "lng", pad: float = 0.005) -> DataFrame:
    """Bounding box of non-zero coordinates, padded."""
    ok = lambda c: F.when(F.col(c).isNotNull() & (F.col(c) != 0) & ~F.isnan(c), F.col(c))
    return df.agg((F.min(ok(lat)) - pad).alias("lat_min"), (F.max(ok(lat)) + pad).alias("lat_max"),
                  (F.min(ok(lng)) - pad).alias("lng_min"), (F.max(ok(lng)) + pad).alias("lng_max"))


# Marker colour tiers and radius rule of the station map.
TIER_LOW, TIER_MID = 0.33, 0.66
COLOR_LOW, COLOR_MID, COLOR_HIGH = "#00d4ff", "#a78bfa", "#ff4b4b"
RADIUS_MIN, RADIUS_SPAN = 4, 22


def marker_scale(df: DataFrame, count: str = "count") -> DataFrame:
    """ratio = min(count / max count, 1), colour tier and radius."""
    mx = df.agg(F.max(count).alias("_max"))
    rows = attach_group_stats(df, mx, [])
    ratio = F.least(F.col(count) / F.col("_max"), F.lit(1.0))
    return (rows.withColumn("ratio", ratio)
            .withColumn("color", F.when(F.col("ratio") < TIER_LOW, COLOR_LOW)
                        .when(F.col("ratio") < TIER_MID, COLOR_MID).otherwise(COLOR_HIGH))
            .withColumn("radius", RADIUS_MIN + F.col("ratio") * RADIUS_SPAN).drop("_max"))


def sample_head(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows in a stated order (a top-k: every task sends k rows at most)."""
    return df.orderBy(*order).limit(k)


def sample_n(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """min(k, n) rows in the order of a hash of their key and a seed, however the rows are partitioned.

    From the row count follows a hash threshold that about k rows pass, so that hardly more than those are
    sorted.  Should fewer than k pass (six standard deviations), the filter is left out.
    """
    code = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    n = df.count()
    share = (k + 6 * k ** 0.5 + 50) / max(n, 1)
    if share < 1:
        few = df.filter(F.substring(code, 1, 8) < f"{int(share * 2 ** 32):08x}")
        if few.count() >= k:
            df = few
    return df.orderBy(code).limit(k)
