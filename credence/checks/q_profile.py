"""Suite: profiles A2-A9, A14 and T3 on the applications / features views."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import spec
from ..fixtures import applications
from ..functions.features import build_features
from ..operators.profile import (class_distribution, describe, duplicate_rows, missing_profile,
                                 overall_missing, schema_summary)
from ..operators.select import first_rows
from ..operators.sketch import sketch
from ..plans.catalog import Catalog
from ..session import work_dir
from .oracle_sql import with_base
from .registry import register

FEATURE_COLS = ["application_id", "application_ts", "age", "income", "employment_length", "credit_score",
                "debt_to_income", "loan_amount", "home_ownership", "loan_purpose", "loan_approved",
                "loan_to_income_ratio", "credit_score_to_age_ratio", "age_category", "income_category",
                "credit_category", "high_income", "excellent_credit", "low_debt_ratio",
                "experienced_employment"]
STRING_COLS = {"home_ownership", "loan_purpose", "age_category", "income_category", "credit_category"}
NUMERIC_COLS = [c for c in FEATURE_COLS if c not in STRING_COLS and c != "application_ts"]


def _dtype_of(c):
    """pandas dtype names of the feature view's columns (the Spark types
    bigint/int, double, string and timestamp)."""
    if c == "application_ts":
        return "datetime64[ns]"
    if c in ("application_id", "loan_approved"):
        return "int64"
    return "object" if c in STRING_COLS else "float64"


def r6(c):
    return F.round(c, 6)


def features(spark, sf):
    return build_features(applications(spark, sf))


@register("A2_describe", with_base(" UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, "
    f"round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, "
    f"max({c}) AS max FROM applications" for c in spec.RAW_NUMERIC)))
def a2(spark, sf):
    d = describe(applications(spark, sf), spec.RAW_NUMERIC)
    return d.select("column", F.col("count").cast("long").alias("count"), r6("mean").alias("mean"),
                    r6("std").alias("std"), "min", r6("p25").alias("p25"), r6("p50").alias("p50"),
                    r6("p75").alias("p75"), "max")


def _profile_sql(select_fn):
    return with_base(" UNION ALL ".join(select_fn(c) for c in FEATURE_COLS))


@register("A3_missing_profile", _profile_sql(
    lambda c: f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
              f"round_even(CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100E0, 2) "
              f"AS missing_pct FROM features"))
def a3(spark, sf):
    return missing_profile(features(spark, sf), distinct=False).select("column", "missing_count", "missing_pct")


@register("A4_distinct_profile", _profile_sql(
    lambda c: f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_count, "
              f"({'TRUE' if c in STRING_COLS else 'FALSE'} OR count(DISTINCT {c}) < 20) AS distinct_reported "
              f"FROM features"))
def a4(spark, sf):
    return missing_profile(features(spark, sf)).select("column", "distinct_count", "distinct_reported")


@register("A5_dtype_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{_dtype_of(c)}' AS dtype" for c in FEATURE_COLS))
def a5(spark, sf):
    return missing_profile(features(spark, sf), distinct=False).select("column", "dtype")


@register("A6_constant_columns", with_base(" UNION ALL ".join(
    f"SELECT '{c}' AS column, COALESCE(min({c}) = max({c}), FALSE) AS constant FROM features"
    for c in NUMERIC_COLS)))
def a6(spark, sf):
    return missing_profile(features(spark, sf), NUMERIC_COLS, distinct=False).select("column", "constant")


RAW_NO_KEY = spec.RAW_COLUMNS + [spec.TARGET]


@register("A7_duplicate_rows", with_base(f"""
SELECT CAST((SELECT count(*) FROM applications) - count(*) AS BIGINT) AS duplicate_rows,
       CAST(count(*) AS BIGINT) AS distinct_rows
FROM (SELECT DISTINCT {", ".join(RAW_NO_KEY)} FROM applications) d
"""))
def a7(spark, sf):
    return duplicate_rows(applications(spark, sf).select(*RAW_NO_KEY))


@register("A8_overall_missing", with_base(f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST({len(FEATURE_COLS)} AS BIGINT) AS columns,
       CAST(sum({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in FEATURE_COLS)}) AS BIGINT)
         AS missing_cells,
       round(CAST(sum({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in FEATURE_COLS)}) AS DOUBLE)
             / CAST(count(*) * {len(FEATURE_COLS)} AS DOUBLE) * 100E0, 6) AS missing_pct
FROM features
"""))
def a8(spark, sf):
    o = overall_missing(features(spark, sf).select(*FEATURE_COLS))
    return o.select("rows", "columns", "missing_cells", r6("missing_pct").alias("missing_pct"))


SKETCHED = ["income", "credit_score", "loan_to_income_ratio", "home_ownership", "age_category"]


# parts added one after another; counts and extremes are exact, quartiles and
# distinct counts within their bounds of the exact ones, and the merged sketch
# is that of a rebuild, number by number
@register("A3_sketch_profile", with_base(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(count(*) AS BIGINT) AS total_records, CAST(count(*) - count({c}) AS BIGINT) AS missing_count,
       {f"round(min({c}), 6)" if c in NUMERIC_COLS else "NULL"} AS min, {f"round(max({c}), 6)" if c in NUMERIC_COLS else "NULL"} AS max,
       TRUE AS distinct_close, {"TRUE" if c in NUMERIC_COLS else "NULL"} AS quartiles_close, CAST(0 AS BIGINT) AS unlike_rebuild
FROM features""" for c in SKETCHED)))
def a3_sketch(spark, sf):
    f = features(spark, sf).select(spec.KEY, *SKETCHED)
    cat = Catalog(spark, work_dir(spark, "profiles"))
    for n in range(3):
        cat.add_profile_part("features", f"part-{n}", f.where(F.col(spec.KEY) % 3 == n).select(*SKETCHED))
    parts, rebuilt = cat.profile_sketch("features"), sketch(f, SKETCHED)
    unlike = parts.exceptAll(rebuilt).unionByName(rebuilt.exceptAll(parts)).agg(F.count("*").alias("unlike_rebuild"))
    numeric = [c for c in SKETCHED if c in NUMERIC_COLS]
    exact = missing_profile(f, SKETCHED).select("column", F.col("distinct_count").alias("d")).join(
        describe(f, numeric).select(F.col("column"), *[F.col(c).alias(f"e{c}") for c in ("p25", "p50", "p75")]), "column", "left")
    j = cat.profile("features").join(exact, "column")
    close = F.lit(True)
    for c in ("p25", "p50", "p75"):
        close = close & (F.abs(F.col(c) - F.col(f"e{c}")) <= F.abs(F.col(f"e{c}")) / 128 + 1e-9)
    return j.select("column", "total_records", "missing_count", r6("min").alias("min"), r6("max").alias("max"),
                    (F.abs(F.col("distinct_count") - F.col("d")) <= F.col("d") * 0.08 + 1).alias("distinct_close"),
                    close.alias("quartiles_close"), unlike.scalar().alias("unlike_rebuild"))


@register("A9_class_distribution", with_base("""
SELECT loan_approved, CAST(count(*) AS BIGINT) AS count,
       round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share
FROM applications WHERE loan_approved IS NOT NULL GROUP BY loan_approved
"""))
def a9(spark, sf):
    d = class_distribution(applications(spark, sf), spec.TARGET)
    return d.select(spec.TARGET, "count", r6("share").alias("share"))


@register("A14_schema_summary", with_base(" UNION ALL ".join(
    f"SELECT '{c}' AS name, '{'categorical' if c in STRING_COLS or c == 'application_ts' else 'numeric'}' "
    f"AS type, 'Feature: {c}' AS description, count(*) > count({c}) AS nullable, "
    f"CAST(count(*) AS BIGINT) AS sample_count FROM features"
    for c in FEATURE_COLS if c != "loan_approved")))
def a14(spark, sf):
    return schema_summary(features(spark, sf).select(*FEATURE_COLS)).drop("ordinal")


@register("T3_first_n_sample", with_base("""
SELECT * REPLACE (round(loan_to_income_ratio, 6) AS loan_to_income_ratio,
                  round(credit_score_to_age_ratio, 6) AS credit_score_to_age_ratio)
FROM features ORDER BY application_id LIMIT 5
"""))
def t3(spark, sf):
    f = features(spark, sf)
    return first_rows(f, [spec.KEY], 5).select(
        *[r6(c).alias(c) if c in spec.RATIO_FEATURES else F.col(c) for c in f.columns])
