"""Column selection and alignment."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec

log = logging.getLogger(__name__)


def require_columns(df: DataFrame, cols: Sequence[str], label: str | None = spec.TARGET) -> DataFrame:
    """Analysis-time check; the error names every missing column."""
    if label is not None and label not in df.columns:
        raise KeyError(f"Target column '{label}' not found.")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"Missing expected columns in data: {missing}")
    return df


def select_features(df: DataFrame, features: Sequence[str] | None, label: str = spec.TARGET) -> DataFrame:
    """P10: keep the requested columns that exist (warn on the rest) and the
    label; when none of them exists, keep everything."""
    if not features:
        return df
    available = [f for f in features if f in df.columns]
    missing = [f for f in features if f not in df.columns]
    if missing:
        log.warning("Missing features: %s", missing)
    if not available:
        return df
    if label in df.columns and label not in available:
        available.append(label)
    return df.select(*available)


def split_features_label(df: DataFrame, label: str = spec.TARGET) -> tuple[DataFrame, str]:
    """The features frame (label dropped) and the label's name; rows
    stay together (no index alignment is needed in Spark)."""
    return df.drop(label), label


def align_to_model(df: DataFrame, model_features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Missing model feature -> constant 0.0; project in model order."""
    cols = [F.col(c) for c in keep if c in df.columns]
    cols += [F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in model_features]
    return df.select(*cols)


def _bound(df: DataFrame, ts: str, value):
    """A literal of the column's own type, parsed from text so that no time
    zone enters (a naive ``datetime`` literal would be read as local time)."""
    dtype = dict(df.dtypes)[ts]
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast(dtype)


def time_range(df: DataFrame, start=None, end=None, ts: str = spec.TS) -> DataFrame:
    """``start <= ts < end`` (either bound optional); a plain filter, so
    Catalyst pushes it to the Parquet scan."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= _bound(df, ts, start))
    if end is not None:
        cond = cond & (F.col(ts) < _bound(df, ts, end))
    return df.where(cond) if (start is not None or end is not None) else df


def first_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``keys`` as an input example (a distributed
    top-n; with ties among the keys, name more of them)."""
    return df.orderBy(*keys).limit(n)
