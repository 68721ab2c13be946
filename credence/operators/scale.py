"""standardisation with the population standard deviation.

Not ML ``StandardScaler`` (sample std). Zero (or undefined) std -> 1, as
the reference scaler does. Fitted by one aggregate; applied as literals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float]]:
    """{column: (mean, scale)} in one pass (``avg`` + ``stddev_pop``)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    row = df.agg(*aggs).first()
    out = {}
    for c in cols:
        mean, std = row[f"{c}__mean"], row[f"{c}__std"]
        scale = 1.0 if std is None or std == 0.0 else float(std)
        out[c] = (None if mean is None else float(mean), scale)
    return out


def standardize(df: DataFrame, params: Mapping[str, tuple[float | None, float]]) -> DataFrame:
    """(x - mean) / scale for each fitted column."""
    return df.withColumns({
        c: (F.col(c) - F.lit(m if m is not None else 0.0)) / F.lit(s) for c, (m, s) in params.items()
    })
