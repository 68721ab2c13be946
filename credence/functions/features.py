"""P5: feature build (ratios, buckets, flags) on unimputed raw columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec
from .columns import nan_to_null, right_closed_bucket, safe_ratio, threshold_flag


def feature_columns() -> list[Column]:
    """The nine derived columns, in creation order."""
    cols = [safe_ratio(num, den).alias(name) for name, num, den in spec.RATIOS]
    cols += [right_closed_bucket(src, edges, labels).alias(name)
             for name, src, edges, labels in spec.BUCKETS]
    cols += [threshold_flag(src, op, v).alias(name) for name, src, op, v in spec.FLAGS]
    return cols


def normalize_raw(df: DataFrame) -> DataFrame:
    """P1 on raw numeric inputs: NaN -> NULL (only the columns present)."""
    present = set(df.columns)
    return df.select(*[
        nan_to_null(c).alias(c) if c in spec.RAW_NUMERIC and c in present else F.col(c)
        for c in df.columns
    ])


def build_features(df: DataFrame) -> DataFrame:
    """Raw records -> raw columns + 9 engineered features (one projection).

    Features are built before imputation, as in the reference (SURVEY D6),
    so a missing income gives ratio 0.0, category NULL and flag 0.0."""
    df = normalize_raw(df)
    derived = {name for name, *_ in spec.RATIOS} | {name for name, *_ in spec.BUCKETS} | \
        {name for name, *_ in spec.FLAGS}
    keep = [F.col(c) for c in df.columns if c not in derived]
    return df.select(*keep, *feature_columns())


def register_feature_view(spark: SparkSession, source: DataFrame, name: str = "application_features") -> DataFrame:
    """Registers P5 over ``source`` as a temporary SQL view and returns it."""
    out = build_features(source)
    out.createOrReplaceTempView(name)
    return out
