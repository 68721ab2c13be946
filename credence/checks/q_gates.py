"""Suite: selection (P9-P12, P15, P17), datasets (S7) and gates (Q1-Q6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import spec
from ..fixtures import applications, table
from ..functions.features import build_features
from ..functions.maps import parse_tags
from ..operators.gates import (dataset_check, dataset_gate, data_quality_gate, feature_gate,
                               performance_gate, profile_gate, rollup, run_gates)
from ..operators.metrics import binary_metrics, roc_auc
from ..operators.select import (align_to_model, require_columns, select_features,
                                split_features_label, time_range)
from ..operators.split import stratified_split
from ..plans.catalog import Catalog
from ..session import materialize, work_dir
from .oracle_sql import with_base
from .q_metrics import SCORED_SQL, scored
from .q_prep import LEHMER_SPLIT_SQL
from .q_profile import FEATURE_COLS, NUMERIC_COLS
from .registry import register


def features(spark, sf):
    return build_features(applications(spark, sf))


# --- selection ------------------------------------------------------------------

@register("P9_required_columns", with_base("SELECT * FROM features"))
def p9(spark, sf):
    f = features(spark, sf)
    return require_columns(f, spec.NUMERICAL_FEATURES + spec.CATEGORICAL_FEATURES + spec.BOOLEAN_FEATURES)


REQUESTED = ["income", "age", "credit_score", "not_a_feature"]


@register("P10_feature_selection", with_base(
    "SELECT income, age, credit_score, loan_approved FROM applications"))
def p10(spark, sf):
    return select_features(applications(spark, sf), REQUESTED)


@register("P11_features_without_label", with_base(
    "SELECT * EXCLUDE (loan_approved) FROM applications"))
def p11(spark, sf):
    x, _ = split_features_label(applications(spark, sf))
    return x


@register("P12_align_to_model", with_base("SELECT application_id, " + ", ".join(
    (c if c in spec.RAW_COLUMNS else f"0E0 AS {c}") for c in spec.ALL_FEATURES) + " FROM applications"))
def p12(spark, sf):
    return align_to_model(applications(spark, sf), spec.ALL_FEATURES, keep=[spec.KEY])


P15_START, P15_END = dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1)


@register("P15_time_range", with_base("""
SELECT * FROM applications
WHERE application_ts >= TIMESTAMP '1996-01-01 00:00:00' AND application_ts < TIMESTAMP '1997-01-01 00:00:00'
"""))
def p15(spark, sf):
    return time_range(applications(spark, sf), P15_START, P15_END)


# P17 over part: tags built from the part columns, one without '=', one
# with a second '=', and a repeated key whose last value wins.
@register("P17_tag_parse", """
WITH t AS (SELECT p_partkey,
                  ['brand=' || p_brand, 'type=' || p_type, 'size=' || CAST(p_size AS VARCHAR), p_name,
                   'name=' || p_name || '=x', 'size=' || CAST(p_size * 2 AS VARCHAR)] AS tags FROM part),
u AS (SELECT p_partkey, unnest(tags) AS tag, generate_subscripts(tags, 1) AS i FROM t),
kv AS (SELECT p_partkey, i, substr(tag, 1, instr(tag, '=') - 1) AS key, substr(tag, instr(tag, '=') + 1) AS value
       FROM u WHERE instr(tag, '=') > 0),
last AS (SELECT p_partkey, key, max(i) AS i FROM kv GROUP BY 1, 2)
SELECT kv.p_partkey, kv.key, kv.value FROM kv JOIN last USING (p_partkey, key, i)
""")
def p17(spark, sf):
    p = table(spark, sf, "part")
    tags = F.array(F.concat(F.lit("brand="), "p_brand"), F.concat(F.lit("type="), "p_type"),
                   F.concat(F.lit("size="), F.col("p_size").cast("string")), F.col("p_name"),
                   F.concat(F.lit("name="), "p_name", F.lit("=x")),
                   F.concat(F.lit("size="), (F.col("p_size") * 2).cast("string")))
    return p.select("p_partkey", F.explode(parse_tags(tags)).alias("key", "value"))


# --- S7 / Q5: required input datasets -----------------------------------------------

REQUIRED_INPUTS = ["orders", "customer"]
OPTIONAL_INPUTS = ["labels", "events"]
CATALOG_TABLES = ["orders", "customer", "part", "events"]


def input_catalog(spark, sf):
    frames = [table(spark, sf, t).agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("rows"))
              for t in CATALOG_TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


CATALOG_SQL = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in CATALOG_TABLES)
WANTED_SQL = " UNION ALL ".join(
    [f"SELECT '{n}' AS name, TRUE AS required, {i} AS ordinal" for i, n in enumerate(REQUIRED_INPUTS)] +
    [f"SELECT '{n}', FALSE, {len(REQUIRED_INPUTS) + i}" for i, n in enumerate(OPTIONAL_INPUTS)])
DATASETS_SQL = f"""
ds AS (SELECT w.name, w.required, w.ordinal, COALESCE(c.rows > 0, FALSE) AS found,
              CAST(COALESCE(c.rows, 0) AS BIGINT) AS rows
       FROM ({WANTED_SQL}) w LEFT JOIN ({CATALOG_SQL}) c ON w.name = c.name)
"""


@register("S7_required_datasets", f"WITH {DATASETS_SQL} SELECT name, required, found, rows FROM ds")
def s7(spark, sf):
    return dataset_check(input_catalog(spark, sf), REQUIRED_INPUTS, OPTIONAL_INPUTS).select(
        "name", "required", "found", "rows")


def gate_out(g):
    return g.select("check", "passed", F.array_join("issues", " | ").alias("issues"))


Q5_SQL = """
q5 AS (SELECT 'artifacts' AS check, NOT COALESCE(bool_or(required AND NOT found), FALSE) AS passed,
              COALESCE(string_agg(CASE WHEN required AND NOT found THEN 'Missing required artifact: ' || name END,
                                  ' | ' ORDER BY ordinal), '') AS issues FROM ds)
"""


@register("Q5_dataset_gate", f"WITH {DATASETS_SQL}, {Q5_SQL} SELECT * FROM q5")
def q5(spark, sf):
    return gate_out(dataset_gate(input_catalog(spark, sf), REQUIRED_INPUTS, OPTIONAL_INPUTS))


# --- Q1: feature validation on the feature view ------------------------------------

def _q1_sql():
    parts = []
    for i, c in enumerate(FEATURE_COLS):
        pct = f"CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100E0"
        const = (f"WHEN min({c}) = max({c}) THEN 'No variance in numeric feature: {c}'"
                 if c in NUMERIC_COLS else "")
        parts.append(
            f"SELECT {i} AS ord, {pct} > 50 AS fail, "
            f"CASE WHEN {pct} > 50 THEN 'High missing values in {c}: ' || printf('%.1f', {pct}) || '%' END AS i1, "
            f"CASE {const} ELSE NULL END AS i2 FROM features" if const else
            f"SELECT {i} AS ord, {pct} > 50 AS fail, "
            f"CASE WHEN {pct} > 50 THEN 'High missing values in {c}: ' || printf('%.1f', {pct}) || '%' END AS i1, "
            f"CAST(NULL AS VARCHAR) AS i2 FROM features")
    return f"""
q1p AS ({" UNION ALL ".join(parts)}),
q1i AS (SELECT ord * 2 AS o, i1 AS t FROM q1p WHERE i1 IS NOT NULL
        UNION ALL SELECT ord * 2 + 1, i2 FROM q1p WHERE i2 IS NOT NULL),
q1 AS (SELECT 'feature_validation' AS check, NOT bool_or(fail) AS passed,
              COALESCE((SELECT string_agg(t, ' | ' ORDER BY o) FROM q1i), '') AS issues FROM q1p)
"""


@register("Q1_feature_gate", with_base(", " + _q1_sql() + " SELECT * FROM q1"))
def q1(spark, sf):
    return gate_out(feature_gate(features(spark, sf).select(*FEATURE_COLS)))


# --- Q2: performance gate for two candidate predictors on the validation split ------

CANDIDATES = [("scorecard", "pred", "prob"), ("high_income_rule", "hi_pred", "hi_pred")]


def _val_metrics(spark, sf, view=None):
    f = features(spark, sf) if view is None else view
    s = scored(spark, sf, f, ["high_income"]).withColumn("hi_pred", F.col("high_income").cast("int"))
    split = stratified_split(f.select(spec.KEY, spec.TARGET), spec.TARGET, spec.KEY, spec.TEST_SIZE, spec.SEED, method="lehmer")
    # the validation rows feed several metric plans: cut their lineage once
    val = materialize(split.where(F.col("split") == "test").select(spec.KEY).join(s, spec.KEY))
    out = []
    for name, pred, prob in CANDIDATES:
        m = binary_metrics(val, spec.TARGET, pred)
        auc = roc_auc(val, spec.TARGET, prob)
        long = m.select(F.explode(F.array(*[
            F.struct(F.lit(f"val_{c}").alias("metric"), F.col(c).alias("value")) for c in m.columns
        ])).alias("s")).select("s.*").unionByName(
            auc.select(F.lit("val_auc").alias("metric"), F.col("auc").alias("value")))
        out.append((name, long))
    return out


def _q2_sql():
    body = []
    for name, pred, prob in CANDIDATES:
        body.append(f"""
{name}_c AS (SELECT CAST(count(*) AS DOUBLE) AS n,
                CAST(sum(CASE WHEN loan_approved = {pred} THEN 1 ELSE 0 END) AS DOUBLE) AS correct,
                CAST(sum(CASE WHEN loan_approved = 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
                CAST(sum(CASE WHEN {pred} = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pp,
                CAST(sum(CASE WHEN loan_approved = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS ap FROM val),
{name}_m AS (SELECT correct / n AS acc, CASE WHEN pp = 0 THEN 0E0 ELSE tp / pp END AS prec,
                    CASE WHEN ap = 0 THEN 0E0 ELSE tp / ap END AS rec FROM {name}_c),
{name}_s AS (SELECT CAST({prob} AS DOUBLE) AS v, sum(CASE WHEN loan_approved = 1 THEN 1 ELSE 0 END) AS pos,
                    sum(CASE WHEN loan_approved = 1 THEN 0 ELSE 1 END) AS neg FROM val GROUP BY 1),
{name}_a AS (SELECT sum(CAST(pos AS DOUBLE) * (CAST(COALESCE(nb, 0) AS DOUBLE) + 0.5E0 * neg))
                    / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
             FROM (SELECT *, sum(neg) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb
                   FROM {name}_s) x),
{name}_long AS (SELECT 0 AS o, 'Accuracy' AS d, 0.8E0 AS th, acc AS v FROM {name}_m
                UNION ALL SELECT 1, 'Precision', 0.75E0, prec FROM {name}_m
                UNION ALL SELECT 2, 'Recall', 0.75E0, rec FROM {name}_m
                UNION ALL SELECT 3, 'F1_Score', 0.75E0,
                       CASE WHEN prec + rec = 0 THEN 0E0 ELSE 2E0 * prec * rec / (prec + rec) END FROM {name}_m
                UNION ALL SELECT 4, 'Auc', 0.75E0, auc FROM {name}_a),
{name}_g AS (SELECT '{name}' AS candidate, 'performance' AS check, NOT bool_or(v < th) AS passed,
                    COALESCE(string_agg(CASE WHEN v < th THEN d || ': ' || printf('%.4f', v) || ' below threshold '
                                        || printf('%.4f', th) END, ' | ' ORDER BY o), '') AS issues
             FROM {name}_long)""")
    return (LEHMER_SPLIT_SQL + SCORED_SQL + """
, val AS (SELECT s.application_id, s.loan_approved, s.pred, s.prob, f.high_income AS hi_pred
          FROM scored s JOIN split p ON s.application_id = p.application_id AND p.split = 'test'
          JOIN features f ON f.application_id = s.application_id),
""" + ",".join(body) + "\n")


@register("Q2_performance_gate", with_base(_q2_sql() + " UNION ALL ".join(
    f"SELECT * FROM {n}_g" for n, _, _ in CANDIDATES)))
def q2(spark, sf):
    frames = [gate_out(performance_gate(long)).select(F.lit(name).alias("candidate"), "*")
              for name, long in _val_metrics(spark, sf)]
    return frames[0].unionByName(frames[1])


# --- Q3: data quality of the feature view -------------------------------------------

def _q3_sql():
    cells = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in FEATURE_COLS)
    return f"""
q3b AS (SELECT count(*) AS n, sum({cells}) AS miss FROM features),
q3c AS (SELECT loan_approved, count(*) AS k FROM features WHERE loan_approved IS NOT NULL GROUP BY 1),
q3 AS (SELECT 'data_quality' AS check,
              NOT (n < 1000 OR CAST(miss AS DOUBLE) / (n * {len(FEATURE_COLS)}) * 100 > 10) AS passed,
              concat_ws(' | ',
                CASE WHEN n < 1000 THEN 'Insufficient test samples: ' || n || ' < 1000' END,
                CASE WHEN CAST(miss AS DOUBLE) / (n * {len(FEATURE_COLS)}) * 100 > 10
                     THEN 'Excessive missing values: '
                          || printf('%.1f', CAST(miss AS DOUBLE) / (n * {len(FEATURE_COLS)}) * 100) || '%' END,
                CASE WHEN (SELECT min(k) FROM q3c) * 1.0 / (SELECT sum(k) FROM q3c) < 0.1
                     THEN 'Imbalanced target distribution: {{'
                          || (SELECT string_agg(loan_approved || ': ' || CAST(k AS DOUBLE) / (SELECT sum(k) FROM q3c),
                                                ', ' ORDER BY k DESC, loan_approved) FROM q3c) || '}}' END) AS issues
       FROM q3b)
"""


@register("Q3_data_quality_gate", with_base(", " + _q3_sql() + " SELECT * FROM q3"))
def q3(spark, sf):
    return gate_out(data_quality_gate(features(spark, sf).select(*FEATURE_COLS)))


# the same gate on a rare label, approved with the best of scores, over all rows:
# the class shares are an issue
@register("Q3_imbalanced_classes", with_base(
    ", rare AS (SELECT * REPLACE (CASE WHEN loan_approved IS NULL THEN NULL "
    "WHEN loan_approved = 1 AND credit_score >= 800 THEN 1 ELSE 0 END AS loan_approved) FROM features), "
    + _q3_sql().replace("FROM features", "FROM rare") + " SELECT * FROM q3"))
def q3_imbalanced(spark, sf):
    label = F.col(spec.TARGET)
    best = (label == 1) & F.coalesce(F.col("credit_score") >= 800, F.lit(False))
    rare = features(spark, sf).withColumn(spec.TARGET, F.when(label.isNotNull(), best.cast("int")))
    return gate_out(data_quality_gate(rare.select(*FEATURE_COLS)))


# --- Q4: stored feature-validation result, read back --------------------------------

def _stored_q1(spark, sf, view=None):
    """The validation result of the set's second version, from the catalog: the
    first version has an older, failed one."""
    cat = Catalog(spark, work_dir(spark, "validation-catalog"))
    gate = materialize(feature_gate((features(spark, sf) if view is None else view).select(*FEATURE_COLS)))
    cat.log_validation("loan-approval-features", 1, gate.withColumn("passed", F.lit(False)))
    cat.log_validation("loan-approval-features", 2, gate)
    return cat.validations("loan-approval-features", 2)


@register("Q4_profile_gate", with_base(", " + _q1_sql() + """
SELECT 'feature_store' AS check, passed, issues FROM q1
"""))
def q4(spark, sf):
    return gate_out(profile_gate(_stored_q1(spark, sf)))


# --- Q6: roll-up -----------------------------------------------------------------------

@register("Q6_rollup", with_base(_q2_sql() + ", " + _q1_sql() + ", " + _q3_sql() + ", " + DATASETS_SQL
                                 + ", " + Q5_SQL + """,
allg AS (SELECT 0 AS o, "check", passed, issues FROM scorecard_g
         UNION ALL SELECT 1, "check", passed, issues FROM q3
         UNION ALL SELECT 2, "check", passed, issues FROM q5
         UNION ALL SELECT 3, 'inference', TRUE, ''
         UNION ALL SELECT 4, 'feature_store', passed, issues FROM q1)
SELECT "check", passed, issues FROM allg
UNION ALL SELECT 'overall', bool_and(passed),
       COALESCE(string_agg(CASE WHEN issues <> '' THEN issues END, ' | ' ORDER BY o), '') FROM allg
"""))
def q6(spark, sf):
    from .q_models import inference_check

    # every gate reads the feature view that is written once
    path = work_dir(spark, "gate-view")
    features(spark, sf).write.parquet(path)
    view = spark.read.parquet(path)
    metrics = dict(_val_metrics(spark, sf, view))
    gates = run_gates(spark, [
        ("performance", lambda: performance_gate(metrics["scorecard"])),
        ("data_quality", lambda: data_quality_gate(view.select(*FEATURE_COLS))),
        ("artifacts", lambda: dataset_gate(input_catalog(spark, sf), REQUIRED_INPUTS, OPTIONAL_INPUTS)),
        ("inference", lambda: inference_check(spark, sf)),
        ("feature_store", lambda: profile_gate(_stored_q1(spark, sf, view))),
    ])
    r = rollup(gates)
    return r.select("check", "passed", F.array_join("issues", " | ").alias("issues"))

