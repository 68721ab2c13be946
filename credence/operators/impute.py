"""F1 / F1s: median imputation.

The median is exact (mean of the two middle values for an even count; not
``Imputer``, which returns an element). It is fitted by a distributed
count per distinct value (``exact_percentiles``) and applied as literal
expressions: eight numbers travel to the driver, never the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cumulative import exact_percentiles, join_groups, stack_columns


def fit_medians(df: DataFrame, cols: Sequence[str], method: str = "exact") -> dict[str, float | None]:
    """Median per column (NULLs ignored; all NULL -> None).

    ``method='exact'`` is distributed-exact; ``'approx'`` uses
    ``percentile_approx`` (one pass, bounded memory) for very wide data."""
    cols = list(cols)
    if method == "approx":
        row = df.agg(*[F.percentile_approx(c, 0.5, 100000).alias(c) for c in cols]).first()
        return {c: (None if row[c] is None else float(row[c])) for c in cols}
    long = stack_columns(df, cols)
    res = exact_percentiles(long, "feature", "value", [0.5], ["median"]).collect()
    found = {r["feature"]: r["median"] for r in res}
    return {c: found.get(c) for c in cols}


def impute(df: DataFrame, fills: Mapping[str, float | None]) -> DataFrame:
    """``coalesce(c, fill)`` for each column; a None fill leaves the column."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(float(v))) for c, v in fills.items() if v is not None
    })


def impute_by_group(df: DataFrame, group_cols: Sequence[str], cols: Sequence[str],
                    single_row_fill: float = 0.0) -> DataFrame:
    """F1s per group: a group (a NULL key is one too) is imputed with its own
    medians when it has more than one row, else with ``single_row_fill``.

    One path for all sizes: distributed exact medians per (group, column),
    joined back on the group; a hot group is split like any other."""
    group_cols = list(group_cols)
    long = df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("_s")).select(*group_cols, "_s.feature", "_s.value")
    med = exact_percentiles(long, group_cols + ["feature"], "value", [0.5], ["median"])
    wide = med.groupBy(*group_cols).agg(*[
        F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"__m_{c}") for c in cols])
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__rows"))
    fills = join_groups(sizes, wide, group_cols, "left")
    out = join_groups(df, fills, group_cols, "left").withColumns({
        c: F.coalesce(F.col(c), F.when(F.col("__rows") > 1, F.col(f"__m_{c}")).otherwise(F.lit(float(single_row_fill))))
        for c in cols})
    return out.select(*df.columns)
