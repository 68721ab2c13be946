"""Column profiles.

Every profile is one multi-column aggregate over the data (one scan, codegen
common-subexpression reuse), reshaped to a long ``(column, ...)`` form
afterwards on a single row per column. Percentiles reuse the distributed
exact routine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from .cumulative import exact_percentiles, stack_columns

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def pandas_dtype(dt: T.DataType) -> str:
    """A5: the type name pandas would report for a column of this type."""
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float64"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int64"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime64[ns]"
    return "object"


def round2(x):
    """pandas ``round(2)``: half to even on the scaled binary value."""
    return F.rint(x * F.lit(100.0)) / F.lit(100.0)


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: count, mean, sample std, min, 25/50/75 % (linear), max per numeric
    column. Not ``summary()``, whose percentiles are approximate."""
    cols = list(cols or numeric_columns(df))
    long = stack_columns(df, cols, "column", "value")
    v = F.col("value")
    basic = long.groupBy("column").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    pct = exact_percentiles(long, "column", "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return basic.join(pct, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None, distinct: bool | str = True) -> DataFrame:
    """A3 (+A4, A5, A6): one row per column with missing count and percent
    (2 digits), non-null distinct count, type, numeric min/max and flags.
    One scan. Exact distinct counts count narrow (column, value) pairs, partially
    aggregated per task, from which all else of the profile follows;
    ``distinct='approx'`` uses HyperLogLog++ sketches instead (no pairs, ~1 %
    error) for very wide or very large inputs, and ``distinct=False`` skips them."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    if distinct is True and not any(isinstance(types[c], (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for c in cols):
        return _finished(_from_values(df, cols, types))
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"m{i}"))
        if distinct == "approx":
            aggs.append(F.approx_count_distinct(F.col(c), 0.01).alias(f"d{i}"))
        elif distinct:
            aggs.append(F.count_distinct(F.col(c)).alias(f"d{i}"))
        if isinstance(types[c], NUMERIC_TYPES):
            aggs.append(F.min(F.col(c)).cast("double").alias(f"lo{i}"))
            aggs.append(F.max(F.col(c)).cast("double").alias(f"hi{i}"))
    row = df.agg(*aggs)
    entries = []
    for i, c in enumerate(cols):
        numeric = isinstance(types[c], NUMERIC_TYPES)
        entries.append(F.struct(
            F.lit(c).alias("column"),
            F.lit(pandas_dtype(types[c])).alias("dtype"),
            F.lit(numeric).alias("is_numeric"),
            F.coalesce(F.col(f"m{i}"), F.lit(0)).cast("long").alias("missing_count"),
            (F.col(f"d{i}") if distinct else F.lit(None)).cast("long").alias("distinct_count"),
            (F.col(f"lo{i}") if numeric else F.lit(None).cast("double")).alias("min"),
            (F.col(f"hi{i}") if numeric else F.lit(None).cast("double")).alias("max"),
        ))
    return _finished(row.select("__n", F.posexplode(F.array(*entries)).alias("ordinal", "e"))
                     .select("__n", "ordinal", "e.*"))


def _from_values(df: DataFrame, cols: Sequence[str], types: dict) -> DataFrame:
    """The facts of ``missing_profile`` from (column, value) counts. Whole numbers
    and floating numbers have a place of their own, all else is a string."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    entries = []
    for i, c in enumerate(cols):
        kind = "l" if isinstance(types[c], whole) else "d" if isinstance(types[c], (T.DoubleType, T.FloatType)) else "s"
        entries.append(F.struct(F.lit(i).alias("ordinal"), *[
            (F.col(c) if k == kind else F.lit(None)).cast(t).alias(k) for k, t in (("l", "long"), ("d", "double"), ("s", "string"))]))
    pairs = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    counts = pairs.groupBy("ordinal", "l", "d", "s").agg(F.count(F.lit(1)).alias("n"))
    empty = F.col("l").isNull() & F.col("d").isNull() & F.col("s").isNull()
    decimals = [i for i, c in enumerate(cols) if isinstance(types[c], T.DecimalType)]
    number = F.coalesce(F.col("l").cast("double"), F.col("d"),
                        F.when(F.col("ordinal").isin(decimals), F.col("s").try_cast("double")) if decimals else F.lit(None))
    facts = counts.groupBy("ordinal").agg(
        F.sum("n").alias("__n"), F.sum(F.when(empty, F.col("n")).otherwise(0)).alias("missing_count"),
        F.count_if(~empty).alias("distinct_count"), F.min(number).alias("min"), F.max(number).alias("max"))
    names = df.sparkSession.createDataFrame(
        [(i, c, pandas_dtype(types[c]), isinstance(types[c], NUMERIC_TYPES)) for i, c in enumerate(cols)],
        "ordinal int, column string, dtype string, is_numeric boolean")
    return names.join(facts, "ordinal", "left").select(
        F.coalesce("__n", F.lit(0)).alias("__n"), "ordinal", "column", "dtype", "is_numeric",
        F.coalesce("missing_count", F.lit(0)).alias("missing_count"), F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        *[F.when(F.col("is_numeric"), F.col(c)).alias(c) for c in ("min", "max")])


def _finished(long: DataFrame) -> DataFrame:
    pct = F.try_divide(F.col("missing_count").cast("double"), F.col("__n").cast("double")) * F.lit(100.0)
    return long.select(
        "ordinal", "column", "dtype", "is_numeric",
        F.col("__n").cast("long").alias("total_records"),
        "missing_count", pct.alias("missing_pct_raw"), round2(pct).alias("missing_pct"),
        "distinct_count",
        # A4: reported when the column is a string column or has < 20 distinct values
        ((F.col("dtype") == "object") | (F.col("distinct_count") < spec.DISTINCT_REPORT_BELOW))
        .alias("distinct_reported"),
        # Numeric column with min = max (all-NULL columns compare NULL -> not constant)
        F.coalesce(F.col("is_numeric") & (F.col("min") == F.col("max")), F.lit(False)).alias("constant"),
    )


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None, bits: int = 128) -> DataFrame:
    """Rows - distinct rows (NULLs equal). Digests of ``bits`` bits are counted
    first, 16 bytes a row; a row whose digest no other row has is distinct, and only
    rows of digests that repeat are compared in full, which also keeps different
    rows of one digest apart."""
    cols = list(cols or df.columns)
    halves = [F.xxhash64(F.lit(seed), *cols) for seed in (1, 2)]
    if bits < 64:
        halves = [F.pmod(halves[0], F.lit(1 << bits)), F.lit(0).cast("long")]
    digested = df.select(*cols, F.struct(*[h.alias(f"h{i}") for i, h in enumerate(halves)]).alias("__digest"))
    counts = digested.groupBy("__digest").agg(F.count(F.lit(1)).alias("__c"))
    alone = counts.where("__c = 1").agg(F.count(F.lit(1)).alias("alone"))
    again = digested.join(counts.where("__c > 1").select("__digest"), "__digest", "left_semi")
    groups = again.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c")).agg(
        F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"), F.count(F.lit(1)).alias("repeated"))
    return groups.select("duplicate_rows", (F.col("repeated") + alone.scalar()).cast("long").alias("distinct_rows"))


def overall_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing cells / (rows x columns) in percent (NULL for no rows)."""
    cols = list(cols or df.columns)
    cells = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
    agg = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(cells), F.lit(0)).alias("missing"))
    pct = F.try_divide(F.col("missing").cast("double"), (F.col("rows") * len(cols)).cast("double")) * 100.0
    return agg.select(F.col("rows").cast("long"), F.lit(len(cols)).cast("long").alias("columns"),
                      F.col("missing").cast("long").alias("missing_cells"), pct.alias("missing_pct"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Share of each non-null label value (``value_counts(normalize)``)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per class: the window over this tiny table is cheap
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select(F.col(label), F.col("n").cast("long").alias("count"),
                         (F.col("n") / total).alias("share"))


def schema_summary(df: DataFrame, label: str = spec.TARGET) -> DataFrame:
    """Per non-label column name, numeric/categorical type and nullable
    (any missing), from one aggregate."""
    cols = [c for c in df.columns if c != label]
    prof = missing_profile(df, cols, distinct=False)
    return prof.select(
        "ordinal", F.col("column").alias("name"),
        F.when(F.col("dtype").isin("int64", "float64"), F.lit("numeric"))
        .otherwise(F.lit("categorical")).alias("type"),
        F.concat(F.lit("Feature: "), F.col("column")).alias("description"),
        (F.col("missing_count") > 0).alias("nullable"),
        F.col("total_records").alias("sample_count"),
    )
