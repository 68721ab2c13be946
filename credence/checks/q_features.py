"""Suite: slice 7.2 and the scalar feature operators P1-P8, P13, P14."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import spec
from ..fixtures import applications
from ..functions import columns as C
from ..functions.features import build_features
from ..functions.scorecard import score
from .oracle_sql import SCORE_SQL, with_base
from .registry import register


def r6(c):
    return F.round(c, 6)


def features(spark, sf):
    return build_features(applications(spark, sf))


# --- slice 7.2: applications -> P5 -> P6 label -> approval by category -------

def approval_by_category(spark, sf):
    f = features(spark, sf)
    return (f.groupBy(C.categorical_str("credit_category").alias("credit_category"),
                      C.categorical_str("income_category").alias("income_category"))
            .agg(F.count(F.lit(1)).alias("n_applications"),
                 r6(F.avg(spec.TARGET)).alias("approval_rate")))


register("SLICE_approval_by_category", with_base("""
SELECT COALESCE(credit_category, 'unknown') AS credit_category,
       COALESCE(income_category, 'unknown') AS income_category,
       CAST(count(*) AS BIGINT) AS n_applications,
       round(avg(loan_approved), 6) AS approval_rate
FROM features GROUP BY 1, 2
"""))(approval_by_category)


@register("P1_missing_normalisation", with_base("""
SELECT application_id,
  CASE WHEN income IS NULL THEN 'null' WHEN income = 0 AND loan_amount > 0 THEN 'inf'
       WHEN income = 0 AND loan_amount < 0 THEN '-inf' WHEN income = 0 THEN 'nan'
       ELSE 'finite' END AS raw_kind,
  CASE WHEN income IS NULL OR income = 0 THEN NULL ELSE round(loan_amount / income, 6) END AS ratio_clean,
  age, credit_score
FROM applications
"""))
def p1(spark, sf):
    a = applications(spark, sf)
    r = C.ieee_divide("loan_amount", "income")
    kind = (F.when(F.isnan(r), "nan").when(r == float("inf"), "inf")
            .when(r == float("-inf"), "-inf").when(r.isNull(), "null").otherwise("finite"))
    return a.select(spec.KEY, kind.alias("raw_kind"), r6(C.missing_to_null(r)).alias("ratio_clean"),
                    C.nan_to_null("age").alias("age"), C.nan_to_null("credit_score").alias("credit_score"))


@register("P2_safe_ratio", with_base("""
SELECT application_id, round(loan_to_income_ratio, 6) AS loan_to_income_ratio,
       round(credit_score_to_age_ratio, 6) AS credit_score_to_age_ratio FROM features
"""))
def p2(spark, sf):
    a = applications(spark, sf)
    return a.select(spec.KEY, *[r6(C.safe_ratio(n, d)).alias(name) for name, n, d in spec.RATIOS])


def _bucket_query(name):
    target, source, edges, labels = next(b for b in spec.BUCKETS if b[0] == name)

    def q(spark, sf):
        a = applications(spark, sf)
        return a.select(spec.KEY, source, C.right_closed_bucket(source, edges, labels).alias(target))
    return q, target, source


for _id, _name in [("P3a_age_bucket", "age_category"), ("P3b_income_bucket", "income_category"),
                   ("P3c_credit_bucket", "credit_category")]:
    _q, _t, _s = _bucket_query(_name)
    register(_id, with_base(f"SELECT application_id, {_s}, {_t} FROM features"))(_q)


@register("P3_bucket_counts", with_base("""
SELECT 'age_category' AS feature, COALESCE(age_category, 'unknown') AS category, CAST(count(*) AS BIGINT) AS n
  FROM features GROUP BY 1, 2
UNION ALL
SELECT 'income_category', COALESCE(income_category, 'unknown'), CAST(count(*) AS BIGINT) FROM features GROUP BY 1, 2
UNION ALL
SELECT 'credit_category', COALESCE(credit_category, 'unknown'), CAST(count(*) AS BIGINT) FROM features GROUP BY 1, 2
"""))
def p3_counts(spark, sf):
    f = features(spark, sf)
    long = f.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), C.categorical_str(n).alias("category"))
        for n, *_ in spec.BUCKETS])).alias("s")).select("s.*")
    return long.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))


@register("P4_threshold_flags", with_base("""
SELECT application_id, high_income, excellent_credit, low_debt_ratio, experienced_employment FROM features
"""))
def p4(spark, sf):
    a = applications(spark, sf)
    return a.select(spec.KEY, *[C.threshold_flag(src, op, v).alias(n) for n, src, op, v in spec.FLAGS])


@register("P5_feature_build", with_base("""
SELECT application_id, application_ts, age, income, employment_length, credit_score, debt_to_income,
       loan_amount, home_ownership, loan_purpose, loan_approved,
       round(loan_to_income_ratio, 6) AS loan_to_income_ratio,
       round(credit_score_to_age_ratio, 6) AS credit_score_to_age_ratio,
       age_category, income_category, credit_category,
       high_income, excellent_credit, low_debt_ratio, experienced_employment
FROM features
"""))
def p5(spark, sf):
    f = features(spark, sf)
    return f.select(*[r6(c).alias(c) if c in spec.RATIO_FEATURES else F.col(c) for c in f.columns])


@register("P6_scorecard", with_base(f"""
SELECT application_id, CAST({SCORE_SQL} AS INTEGER) AS score,
       CAST((application_id * 104729) % 41 - 20 AS DOUBLE) AS noise, loan_approved
FROM applications
"""))
def p6(spark, sf):
    from ..fixtures import noise
    a = applications(spark, sf)
    return a.select(spec.KEY, score().cast("int").alias("score"), noise(F.col(spec.KEY)).alias("noise"),
                    spec.TARGET)


@register("P7_clip", with_base("SELECT application_id, " + ", ".join(
    f"CASE WHEN {c} < {lo} THEN CAST({lo} AS DOUBLE) WHEN {c} > {hi} THEN CAST({hi} AS DOUBLE) "
    f"ELSE {c} END AS {c}" for c, lo, hi in spec.CLIP_RANGES) + " FROM applications"))
def p7(spark, sf):
    a = applications(spark, sf)
    return a.select(spec.KEY, *[C.clip(c, lo, hi).alias(c) for c, lo, hi in spec.CLIP_RANGES])


@register("P8_round_half_even", with_base("""
SELECT application_id,
       round_even(debt_to_income, 2) AS dti_2,
       round_even(employment_length, 0) AS employment_0,
       round_even(loan_amount / 1000E0, 0) AS loan_thousands
FROM applications
"""))
def p8(spark, sf):
    a = applications(spark, sf)
    return a.select(spec.KEY,
                    C.round_half_even("debt_to_income", 2).alias("dti_2"),
                    C.round_half_even("employment_length", 0).alias("employment_0"),
                    C.round_half_even(F.col("loan_amount") / F.lit(1000.0), 0).alias("loan_thousands"))


@register("P13_categorical_unknown", with_base("""
SELECT application_id,
  COALESCE(home_ownership, 'unknown') AS home_ownership, COALESCE(loan_purpose, 'unknown') AS loan_purpose,
  COALESCE(age_category, 'unknown') AS age_category, COALESCE(income_category, 'unknown') AS income_category,
  COALESCE(credit_category, 'unknown') AS credit_category
FROM features
"""))
def p13(spark, sf):
    f = features(spark, sf)
    return f.select(spec.KEY, *[C.categorical_str(c).alias(c) for c in spec.CATEGORICAL_FEATURES])


@register("P14_confidence_band", with_base(f"""
SELECT application_id, round(p, 6) AS approval_probability,
       CASE WHEN p >= 0.8E0 THEN 'high' WHEN p >= 0.6E0 THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT application_id, 1E0 / (1E0 + exp(-(CAST({SCORE_SQL} AS DOUBLE) - 50E0) / 10E0)) AS p
      FROM applications)
"""))
def p14(spark, sf):
    a = applications(spark, sf)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(score().cast("double") - F.lit(50.0)) / F.lit(10.0)))
    return a.select(spec.KEY, p.alias("p")).select(
        spec.KEY, r6("p").alias("approval_probability"), C.confidence_band("p").alias("confidence"))
