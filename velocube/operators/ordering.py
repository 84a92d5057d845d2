"""Distributed ordered primitives.

Spark's ``row_number()`` / running sums over a window without (or with a
heavily skewed) ``partitionBy`` pull a whole group into one task.  These
helpers compute the same numbers with a two-level scheme:

1. range-partition the rows on (group, order) keys - a hot group is spread
   over many partitions by its order key;
2. inside each (group, partition) piece compute the local running value with
   an ordinary window (each piece holds ~N/P rows);
3. a tiny table of per-piece totals (one row per partition and group) gives
   every piece its offset via a running sum over partitions;
4. offset + local value = the global value.

The range-partitioned rows (with their partition id) are materialised once
with a reliable ``checkpoint()`` in the session's shared checkpoint folder:
both branches then read identical pieces (a sampled range exchange evaluated
twice could draw different bounds), and the lineage is cut, so a lost
executor does not force the sampling and shuffle to rerun.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

_PID = "_vc_pid"


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ranged(df: DataFrame, keys: Sequence[str], n: int | None) -> DataFrame:
    from velocube.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return (df.repartitionByRange(_num_partitions(df, n), *keys)
              .withColumn(_PID, F.spark_partition_id())
              .checkpoint(eager=True))


def prefix_sums(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                partition_cols: Sequence[str] = (), num_partitions: int | None = None,
                suffix: str = "_cum", total_suffix: str | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_cols`` order within
    ``partition_cols``; ``order_cols`` must be unique within a partition group
    for a well-defined result.  With ``total_suffix`` the group's totals come
    along from the per-piece offsets, so nobody needs a join on the group."""
    part, order = list(partition_cols), list(order_cols)
    r = _ranged(df, part + order, num_partitions)
    w_local = (Window.partitionBy(*part, _PID).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = r.select("*", *[F.sum(c).over(w_local).alias(f"_loc_{c}") for c in sum_cols])
    totals = r.groupBy(*part, _PID).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    w_off = (Window.partitionBy(*part).orderBy(_PID)
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*[F.col(c).alias(f"_o_{c}") for c in part], F.col(_PID).alias("_o_pid"), *[
        F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in sum_cols], *[
        F.sum(f"_tot_{c}").over(Window.partitionBy(*part)).alias(f"_all_{c}") for c in sum_cols])
    # null-safe keys: a NULL group is a group too
    cond = [local[c].eqNullSafe(offsets[f"_o_{c}"]) for c in part] + [local[_PID] == offsets["_o_pid"]]
    out = local.join(offsets, cond, "inner")
    return out.select(*df.columns, *[
        (F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"{c}{suffix}") for c in sum_cols], *[
        F.col(f"_all_{c}").alias(f"{c}{total_suffix}") for c in sum_cols if total_suffix])


def with_global_rank(df: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (),
                     rank_col: str = "row_idx", num_partitions: int | None = None) -> DataFrame:
    """0-based ``row_number()`` within ``partition_cols`` ordered by
    ``order_cols`` (which should form a total order), computed without a
    single-task window."""
    one = "_vc_one"
    ranked = prefix_sums(df.withColumn(one, F.lit(1).cast("long")), order_cols, [one],
                         partition_cols, num_partitions, suffix="_cum")
    return ranked.withColumn(rank_col, F.col(f"{one}_cum") - 1).drop(one, f"{one}_cum")


def lags_distributed(df: DataFrame, y: str, order_cols: Sequence[str], n: int,
                     partition_cols: Sequence[str] = (), prefix: str = "lag_", num_partitions: int | None = None) -> DataFrame:
    """``lag(y, 1..n)`` over rows ordered by ``order_cols`` within
    ``partition_cols``, for series of any length.

    Rows are range-partitioned and sorted once.  Only the last ``n`` values of each range piece travel on: from the pieces'
    first and last groups and these values (one short row a piece) follow the values that each piece begins with, and
    every piece then shifts its own rows, batch by batch.
    """
    part = list(partition_cols)
    group = F.to_json(F.struct(*part), {"ignoreNullFields": "false"}) if part else F.lit("")
    ranged = df.withColumn("_vc_g", group).repartitionByRange(_num_partitions(df, num_partitions), *part, *order_cols)
    from velocube.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    ranged = ranged.sortWithinPartitions(*part, *order_cols).withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)
    kind = df.schema[y].dataType

    def ends(batches):
        first = last = pid = None
        tail = None
        for batch in batches:
            if not batch.num_rows:
                continue
            pids, groups, values = batch.columns
            if first is None:
                first, pid = groups[0].as_py(), pids[0].as_py()
            now = groups[len(groups) - 1].as_py()
            same = len(groups) - (pc.index(pc.equal(groups, now), True).as_py() if len(groups) else 0)
            mine = values.slice(len(values) - min(n, same))
            if tail is not None and now == last and same == len(groups):
                mine = pa.concat_arrays([tail, mine])
            tail, last = mine.slice(max(0, len(mine) - n)), now
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([first]), pa.array([last]), pa.ListArray.from_arrays(pa.array([0, len(tail)], pa.int32()), tail)], names=["pid", "first", "last", "tail"])

    schema = T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("first", T.StringType()),
                           T.StructField("last", T.StringType()), T.StructField("tail", T.ArrayType(kind))])
    pieces = ranged.select(_PID, "_vc_g", y).mapInArrow(ends, schema).toArrow().sort_by("pid").combine_chunks()  # one row a piece
    before, held, group_of = {}, None, None
    for i in range(pieces.num_rows):
        pid, first, last = (pieces[c][i].as_py() for c in ("pid", "first", "last"))
        tail = pieces["tail"][i].values
        if held is not None and first == group_of:
            before[pid] = held
        if first == last == group_of:
            tail = pa.concat_arrays([held, tail])
        held, group_of = tail.slice(max(0, len(tail) - n)), last
    shared = {pid: (x.to_pylist()) for pid, x in before.items()}  # n values a piece at most
    names, columns = [f"{prefix}{k}" for k in range(1, n + 1)], df.columns
    out = T.StructType([*df.schema.fields, *[T.StructField(c, kind) for c in names]])

    def shift(batches):
        tail = last = None
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            groups, values = batch.column(rows_at["_vc_g"]), batch.column(rows_at[y])
            if last is None:
                start = shared.get(batch.column(rows_at[_PID])[0].as_py(), [])
                tail, last = pa.array(start, values.type), groups[0].as_py()
            new = np.ones(rows, bool)
            new[1:] = pc.not_equal(groups.slice(1), groups.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
            new[0] = groups[0].as_py() != last
            every = pa.concat_arrays([tail, values])
            place = np.arange(rows) + len(tail)
            begin = np.maximum.accumulate(np.where(new, place, 0))
            lags = []
            for k in range(1, n + 1):
                at = place - k
                lags.append(every.take(pa.array(at, pa.int64(), mask=at < begin)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], *lags], names=[*columns, *names])
            keep = len(every) - max(int(begin[-1]), len(every) - n)
            tail, last = every.slice(len(every) - keep), groups[rows - 1].as_py()

    cols = [*columns, "_vc_g", _PID]
    rows_at = {c: i for i, c in enumerate(cols)}
    return ranged.select(*cols).mapInArrow(shift, out)


#: Groups whose statistics a checked broadcast may hold.
GROUP_ROWS = 100_000


def attach_group_stats(df: DataFrame, stats: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Join a per-group statistics table onto rows (a lookup: one stats row
    per group).  The statistics are materialised and counted: up to
    ``GROUP_ROWS`` groups are broadcast, so that rows of a hot group stay
    where they are; beyond that both sides are shuffled.  Without group
    columns the statistics are one row of a global aggregate, attached by a
    cross join with that one broadcast row."""
    g = list(group_cols)
    if g:
        from velocube.session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        stats = stats.checkpoint(eager=True)
        return df.join(F.broadcast(stats) if stats.count() <= GROUP_ROWS else stats, g, "inner")
    return df.crossJoin(F.broadcast(stats.limit(1)))


def value_rank_table(df: DataFrame, value: str, group_cols: Sequence[str] = (),
                     num_partitions: int | None = None) -> DataFrame:
    """Distinct (group, value) with ``_vc_c`` = count and ``_vc_c_cum`` =
    running count in value order (the value covers 0-based ranks
    [cum - c, cum - 1]), ``_vc_c_all`` = rows of the group.  Duplicates collapse map-side; the result is
    materialised (``prefix_sums``), so several statistics can read it
    without rescanning the input."""
    g = list(group_cols)
    dist = (df.filter(F.col(value).isNotNull()).groupBy(*g, value)
            .agg(F.count(F.lit(1)).alias("_vc_c")))
    return prefix_sums(dist, [value], ["_vc_c"], g, num_partitions, total_suffix="_all")


def quantiles_from_ranks(cum: DataFrame, value: str, qs: Sequence[float], group_cols: Sequence[str] = (),
                         names: Sequence[str] | None = None) -> DataFrame:
    g = list(group_cols)
    names = list(names or [f"q{i}" for i in range(len(qs))])
    v = F.col(value)
    rows = cum.withColumn("_vc_n", F.col("_vc_c_all"))
    lo = F.col("_vc_c_cum") - F.col("_vc_c")
    hi = F.col("_vc_c_cum") - 1
    aggs = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("_vc_n") - 1)
        r0, r1 = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when((r0 >= lo) & (r0 <= hi), v)).alias(f"_v0_{i}"),
                 F.max(F.when((r1 >= lo) & (r1 <= hi), v)).alias(f"_v1_{i}"),
                 F.max(pos - r0).alias(f"_fr_{i}")]
    picked = rows.groupBy(*g).agg(*aggs)
    return picked.select(*g, *[
        (F.col(f"_v0_{i}") + (F.col(f"_v1_{i}") - F.col(f"_v0_{i}")) * F.col(f"_fr_{i}")).alias(names[i])
        for i in range(len(qs))])


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float],
                    group_cols: Sequence[str] = (), num_partitions: int | None = None,
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles (NumPy/pandas 'linear', DuckDB
    ``quantile_cont``, Spark ``percentile``) per group, without gathering a
    group into one task: the distinct-value rank table gives every value its
    rank range and its group's size, and a distributed aggregate picks the values at
    floor/ceil of q*(n-1)."""
    cum = value_rank_table(df, value, group_cols, num_partitions)
    return quantiles_from_ranks(cum, value, qs, group_cols, names)
