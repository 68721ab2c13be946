"""Distributed running totals, ranks and exact percentiles.

A window ordered over a whole column (``Window.orderBy(x)`` with no
partition, or partitioned by a handful of groups) runs in one task per
group. These helpers keep that work parallel, in one way for all sizes:

1. rows are laid out by range over (group, order key) and written once, so
   that a lost task can't change the layout; a large group covers many parts
   and small groups share one;
2. per-(group, part) totals (at most groups + parts rows) become offsets by
   a window over that small table;
3. the running sum inside each (group, part) is a window over one part only,
   plus its offset.

Callers pre-aggregate to one row per distinct key, so no part can grow beyond
its share of the distinct keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _laid_out(df: DataFrame, keys: Sequence[str], parts: int | None) -> DataFrame:
    """Rows by range of ``keys``, with their part's number; written once.
    ``parts`` is the number of ranges (default: left to the session)."""
    count = [] if parts is None else [parts]
    return materialize(df.repartitionByRange(*count, *keys).withColumn("_part", F.spark_partition_id()))


def running_totals(df: DataFrame, group_cols: Sequence[str], order_col: str, sum_cols: Sequence[str],
                   parts: int | None = None, suffix: str = "_cum", total_suffix: str | None = None) -> DataFrame:
    """Adds ``<c><suffix>``: the inclusive running sum of each ``sum_cols``
    column in ``order_col`` order, restarting per ``group_cols`` (a NULL group
    is a group), and with ``total_suffix`` the group's whole sum too.
    ``order_col`` must be unique within a group (pre-aggregate first)."""
    group_cols = list(group_cols)
    part_cols = [*group_cols, "_part"]
    laid = _laid_out(df, [*group_cols, order_col], parts)
    sums = laid.groupBy(*part_cols).agg(*[F.sum(c).alias(f"{c}_in") for c in sum_cols])
    whole = Window.partitionBy(*(group_cols or [F.lit(0)]))  # one row per part of a group
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*part_cols, *[
        F.coalesce(F.sum(f"{c}_in").over(before), F.lit(0)).alias(f"{c}_off") for c in sum_cols], *[
        F.sum(f"{c}_in").over(whole).alias(f"{c}_all") for c in sum_cols])
    inside = Window.partitionBy(*part_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return join_groups(laid, offsets, part_cols, "inner").select(
        *df.columns,
        *[(F.sum(c).over(inside) + F.col(f"{c}_off")).alias(f"{c}{suffix}") for c in sum_cols],
        *([F.col(f"{c}_all").alias(f"{c}{total_suffix}") for c in sum_cols] if total_suffix else []),
    )


def ranks(df: DataFrame, group_col: str, order_col: str, name: str) -> DataFrame:
    """Adds ``name``: the 0-based rank (bigint) of each row in its group by
    ``order_col``, unique within a group; no task holds a whole group."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), [group_col], order_col, ["_one"])
    return counted.select(*df.columns, (F.col("_one_cum") - 1).alias(name))


def join_groups(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Join on group columns of equal names, a NULL group being a group."""
    r = right.select([F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols]
    return left.join(r, on, how).drop(*[f"_r_{c}" for c in cols])


def exact_percentiles(long_df: DataFrame, group_cols, value_col: str,
                      percentages: Sequence[float], names: Sequence[str] | None = None,
                      parts: int | None = None, weight_col: str | None = None) -> DataFrame:
    """Exact linear-interpolated percentiles (``percentile`` / pandas
    ``quantile`` / DuckDB ``quantile_cont``) of ``value_col`` per group,
    NULL and NaN ignored. Returns one row per group that has values, with one
    column per percentage.

    Work: one distributed count per (group, value), and running totals of the
    counts; the values at the two places beside each percentage are read off
    them. ``weight_col`` marks ``long_df`` as already counted: one row per
    (group, value) with its row count."""
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    names = list(names or [f"p{int(round(p * 100))}" for p in percentages])
    v = F.col(value_col)
    valid = long_df.where(v.isNotNull() & ~F.isnan(v.cast("double")))
    if weight_col is None:
        counts = valid.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_w"))
    else:
        counts = valid.select(*group_cols, value_col, F.col(weight_col).cast("long").alias("_w"))
    rt = running_totals(counts, group_cols, value_col, ["_w"], parts, total_suffix="_n")
    cum, prev = F.col("_w_cum"), F.col("_w_cum") - F.col("_w")
    aggs = []
    for p, name in zip(percentages, names):
        h = (F.col("_w_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs.append(F.max(F.when((prev <= lo) & (lo < cum), v)).alias(f"{name}__lo"))
        aggs.append(F.max(F.when((prev <= hi) & (hi < cum), v)).alias(f"{name}__hi"))
        aggs.append(F.max(h - lo).alias(f"{name}__f"))
    out = [F.col(g) for g in group_cols]
    for name in names:
        lo_v, hi_v, f = F.col(f"{name}__lo"), F.col(f"{name}__hi"), F.col(f"{name}__f")
        # as the built-in percentile does; lo + (hi - lo) * f would make NaN of infinities
        between = F.when((f == 0) | (lo_v == hi_v), lo_v).otherwise(lo_v * (1 - f) + hi_v * f)
        out.append(between.cast("double").alias(name))
    return rt.groupBy(*group_cols).agg(*aggs).select(*out)


def stack_columns(df: DataFrame, cols: Sequence[str], name_col: str = "feature",
                  value_col: str = "value", value_type: str = "double") -> DataFrame:
    """Wide -> long: one (name, value) row per input column (``stack``)."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(name_col), F.col(c).cast(value_type).alias(value_col)) for c in cols
    ])).alias("_s")).select(f"_s.{name_col}", f"_s.{value_col}")
