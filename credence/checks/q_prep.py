"""Suite: fit / transform operators F1-F7, S8 and P16."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import spec
from ..fixtures import applications
from ..functions.columns import categorical_str
from ..functions.features import build_features
from ..operators.cumulative import exact_percentiles, stack_columns
from ..operators.encode import Dictionary, encode, fit_dictionaries, mask_unseen
from ..operators.impute import fit_medians, impute, impute_by_group
from ..operators.scale import fit_scaler, standardize
from ..operators.split import stratified_split
from ..plans.preprocess import feature_info_frame, preprocess
from ..session import materialize, work_dir
from ..sources.params import load_params, save_params
from ..sources.readers import process_test_set
from .oracle_sql import CATS, FLAGS, MODEL_ORDER, NUMS, prep_ctes, with_base
from .registry import register

R6 = 6


def r6(c):
    return F.round(c, R6)


def features(spark, sf):
    return build_features(applications(spark, sf))


def _long_medians_sql():
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(median({c}), 6) AS median FROM features" for c in NUMS)


@register("F1_medians", with_base(_long_medians_sql()))
def f1_medians(spark, sf):
    long = stack_columns(features(spark, sf), spec.NUMERICAL_FEATURES)
    return exact_percentiles(long, "feature", "value", [0.5], ["median"]).select(
        "feature", r6("median").alias("median"))


@register("F1_median_impute", with_base(prep_ctes() + "SELECT application_id, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in NUMS) + " FROM imp"))
def f1_impute(spark, sf):
    f = features(spark, sf)
    med = fit_medians(f, spec.NUMERICAL_FEATURES)
    return impute(f, med).select(spec.KEY, *[r6(c).alias(c) for c in spec.NUMERICAL_FEATURES])


# F1s: the serving rule per micro-batch (one batch = the applications of one
# day; days of 1998 have no batch name, so NULL is a batch too): the batch
# median when the batch has more than one row, else 0.
@register("F1s_serving_impute", with_base("""
, d AS (SELECT *, CASE WHEN year(application_ts) < 1998 THEN CAST(application_ts AS DATE) END AS batch_day
        FROM features),
b AS (SELECT *, count(*) OVER (PARTITION BY batch_day) AS batch_rows FROM d),
m AS (SELECT batch_day, """ + ", ".join(f"median({c}) AS m_{c}" for c in NUMS) + """
      FROM b GROUP BY batch_day)
SELECT application_id, b.batch_day, """ + ", ".join(
    f"round(COALESCE({c}, CASE WHEN batch_rows > 1 THEN m_{c} ELSE 0E0 END), 6) AS {c}" for c in NUMS) + """
FROM b JOIN m ON b.batch_day IS NOT DISTINCT FROM m.batch_day
"""))
def f1s(spark, sf):
    f = features(spark, sf).withColumn("batch_day", F.when(F.year(spec.TS) < 1998, F.to_date(spec.TS)))
    return impute_by_group(f, ["batch_day"], spec.NUMERICAL_FEATURES).select(
        spec.KEY, "batch_day", *[r6(c).alias(c) for c in spec.NUMERICAL_FEATURES])


@register("F2_scaler_params", with_base(prep_ctes() + "SELECT feature, round(mean, 6) AS mean, "
                                        "round(scale, 6) AS scale FROM scaler"))
def f2_params(spark, sf):
    f = features(spark, sf)
    imp = impute(f, fit_medians(f, spec.NUMERICAL_FEATURES))
    sc = fit_scaler(imp, spec.NUMERICAL_FEATURES)
    rows = [(c, m, s) for c, (m, s) in sc.items()]
    return spark.createDataFrame(rows, "feature string, mean double, scale double").select(
        "feature", r6("mean").alias("mean"), r6("scale").alias("scale"))


@register("F2_standardize", with_base(prep_ctes() + "SELECT application_id, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in NUMS) + " FROM enc"))
def f2(spark, sf):
    f = features(spark, sf)
    imp = impute(f, fit_medians(f, spec.NUMERICAL_FEATURES))
    out = standardize(imp, fit_scaler(imp, spec.NUMERICAL_FEATURES))
    return out.select(spec.KEY, *[r6(c).alias(c) for c in spec.NUMERICAL_FEATURES])


@register("F3_dictionary", with_base(prep_ctes() + "SELECT feature, category, code FROM dict"))
def f3(spark, sf):
    f = features(spark, sf).withColumns({c: categorical_str(c) for c in spec.CATEGORICAL_FEATURES})
    return fit_dictionaries(f, spec.CATEGORICAL_FEATURES)


@register("F4_encode", with_base(prep_ctes() + "SELECT application_id, " + ", ".join(CATS) + " FROM enc"))
def f4(spark, sf):
    f = features(spark, sf).withColumns({c: categorical_str(c) for c in spec.CATEGORICAL_FEATURES})
    d = Dictionary(fit_dictionaries(f, spec.CATEGORICAL_FEATURES))
    return encode(f, d, spec.CATEGORICAL_FEATURES).select(spec.KEY, *spec.CATEGORICAL_FEATURES)


PROCESSED_SQL = with_base(prep_ctes() + "SELECT application_id, application_ts, " + ", ".join(
    (f"round({c}, 6) AS {c}" if c in NUMS else c) for c in MODEL_ORDER) + ", loan_approved FROM enc")


def processed(spark, sf):
    out, _ = preprocess(applications(spark, sf))
    return out.select(*[r6(c).alias(c) if c in spec.NUMERICAL_FEATURES else F.col(c) for c in out.columns])


register("F5_preprocess", PROCESSED_SQL)(processed)


# --- F6 -----------------------------------------------------------------------

QUOTAS_SQL = """
, cnt AS (SELECT loan_approved AS label, count(*) AS n_c FROM applications GROUP BY 1),
tot AS (SELECT sum(n_c) AS n, CAST(ceil(0.2E0 * sum(n_c)) AS BIGINT) AS n_test FROM cnt),
qa AS (SELECT label, n_c, CAST(n_c AS DOUBLE) * CAST(n - n_test AS DOUBLE) / CAST(n AS DOUBLE) AS cont,
             n - n_test AS n_train FROM cnt, tot),
qb AS (SELECT label, n_c, floor(cont) AS fl, cont - floor(cont) AS rem,
              n_train - (SELECT sum(floor(cont)) FROM qa) AS need FROM qa),
qc AS (SELECT *, row_number() OVER (ORDER BY rem DESC, label ASC) AS r FROM qb),
quotas AS (SELECT label, n_c, CAST(fl + CASE WHEN r <= need THEN 1 ELSE 0 END AS BIGINT) AS train_c,
                  CAST(n_c - (fl + CASE WHEN r <= need THEN 1 ELSE 0 END) AS BIGINT) AS test_c FROM qc)
"""


@register("F6_split_counts", with_base(QUOTAS_SQL + """
SELECT label AS loan_approved, 'train' AS split, train_c AS n FROM quotas
UNION ALL SELECT label, 'test', test_c FROM quotas
"""))
def f6_counts(spark, sf):
    s = stratified_split(applications(spark, sf), spec.TARGET, spec.KEY, spec.TEST_SIZE, spec.SEED)
    return s.groupBy(spec.TARGET, "split").agg(F.count(F.lit(1)).alias("n"))


LEHMER_SPLIT_SQL = QUOTAS_SQL + """,
hashed AS (SELECT application_id, loan_approved,
                  ((((application_id + 42) % 2147483647) + 2147483647) % 2147483647) * 48271 % 2147483647 AS h
           FROM applications),
ranked AS (SELECT *, row_number() OVER (PARTITION BY loan_approved ORDER BY h, application_id) AS rn FROM hashed),
split AS (SELECT r.application_id, r.loan_approved,
                 CASE WHEN r.rn <= q.test_c THEN 'test' ELSE 'train' END AS split
          FROM ranked r JOIN quotas q ON r.loan_approved = q.label)
"""


@register("F6_split_membership", with_base(LEHMER_SPLIT_SQL + "SELECT * FROM split"))
def f6_members(spark, sf):
    s = stratified_split(applications(spark, sf), spec.TARGET, spec.KEY, spec.TEST_SIZE, spec.SEED,
                         method="lehmer")
    return s.select(spec.KEY, spec.TARGET, "split")


SPEC_SQL = " UNION ALL ".join(
    [f"SELECT '{name}' AS list, {i} AS position, '{c}' AS feature"
     for name, cols in (("numerical_features", NUMS), ("categorical_features", CATS), ("boolean_features", FLAGS),
                        ("all_features", MODEL_ORDER)) for i, c in enumerate(cols)]
    + ["SELECT 'target', 0, 'loan_approved'"])


@register("F7_feature_spec", SPEC_SQL)
def f7(spark, sf):
    _, params = preprocess(applications(spark, sf))
    path = work_dir(spark, "params")
    save_params(spark, params, path)
    info = feature_info_frame(spark, load_params(spark, path).info)
    lists = [F.struct(F.lit(n).alias("list"), F.col(n).alias("names"))
             for n in ("numerical_features", "categorical_features", "boolean_features", "all_features")]
    lists.append(F.struct(F.lit("target").alias("list"), F.array("target").alias("names")))
    return info.select(F.explode(F.array(*lists)).alias("l")).select(
        "l.list", F.posexplode("l.names").alias("position", "feature"))


# --- S8: fit, write, read back --------------------------------------------------

@register("S8_params_roundtrip", with_base(prep_ctes() + """
SELECT 'median' AS kind, feature, CAST(NULL AS VARCHAR) AS category, round(median, 6) AS value FROM (
""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS median FROM fit_med" for c in NUMS) + """) x
UNION ALL SELECT 'mean', feature, NULL, round(mean, 6) FROM scaler
UNION ALL SELECT 'scale', feature, NULL, round(scale, 6) FROM scaler
UNION ALL SELECT 'code', feature, category, CAST(code AS DOUBLE) FROM dict
UNION ALL SELECT 'spec', feature, list, CAST(position AS DOUBLE) FROM (""" + SPEC_SQL + ") y"))
def s8(spark, sf):
    _, params = preprocess(applications(spark, sf))
    path = work_dir(spark, "params")
    save_params(spark, params, path)
    back = load_params(spark, path)
    from ..sources.params import params_frame
    return params_frame(spark, back).select("kind", "feature", "category", r6("value").alias("value"))


# --- F5 in apply mode: fitted on one half, saved, loaded, applied to the other ---

STORED_SQL = with_base(LEHMER_SPLIT_SQL + """,
tr AS (SELECT f.* FROM features f JOIN split s ON f.application_id = s.application_id WHERE s.split = 'train'),
te AS (SELECT f.* FROM features f JOIN split s ON f.application_id = s.application_id WHERE s.split = 'test')
""" + prep_ctes("te", "tr") + "SELECT application_id, application_ts, " + ", ".join(
    (f"round({c}, 6) AS {c}" if c in NUMS else c) for c in MODEL_ORDER) + ", loan_approved FROM enc")


@register("S3_processed_test", STORED_SQL)
def s3_test(spark, sf):
    s = materialize(stratified_split(applications(spark, sf), spec.TARGET, spec.KEY, spec.TEST_SIZE, spec.SEED,
                                     method="lehmer"))
    _, params = preprocess(s.where(F.col("split") == "train").drop("split"))
    path, out = work_dir(spark, "params"), work_dir(spark, "test-processed")
    save_params(spark, params, path)
    process_test_set(s.where(F.col("split") == "test").drop("split"), path, out)
    back = spark.read.parquet(out)
    return back.select(*[r6(c).alias(c) if c in spec.NUMERICAL_FEATURES else F.col(c) for c in back.columns])


# --- P16: dictionary fitted on the training split, applied to validation ------

@register("P16_unseen_mask", with_base(LEHMER_SPLIT_SQL + """,
tr AS (SELECT """ + ", ".join(f"COALESCE(f.{c}, 'unknown') AS {c}" for c in CATS) + """
       FROM features f JOIN split s ON f.application_id = s.application_id WHERE s.split = 'train'),
va AS (SELECT f.application_id, """ + ", ".join(f"COALESCE(f.{c}, 'unknown') AS {c}" for c in CATS) + """
       FROM features f JOIN split s ON f.application_id = s.application_id WHERE s.split = 'test')
SELECT application_id, """ + ", ".join(
    f"CASE WHEN {c} IN (SELECT {c} FROM tr) THEN {c} ELSE 'unknown' END AS {c}" for c in CATS) + """
FROM va
"""))
def p16(spark, sf):
    f = features(spark, sf).withColumns({c: categorical_str(c) for c in spec.CATEGORICAL_FEATURES})
    s = materialize(stratified_split(f, spec.TARGET, spec.KEY, spec.TEST_SIZE, spec.SEED, method="lehmer"))
    d = Dictionary(fit_dictionaries(s.where(F.col("split") == "train"), spec.CATEGORICAL_FEATURES))
    va = s.where(F.col("split") == "test")
    return mask_unseen(va, d, spec.CATEGORICAL_FEATURES).select(spec.KEY, *spec.CATEGORICAL_FEATURES)

