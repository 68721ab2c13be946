"""Suite: payloads (S4, S5), models (L1-L6, L8, L9) and importances.

Payloads are rendered by Spark from the applications (pairs of records;
every third pair as two single-object payloads, the rest as arrays), plus
every ``events.props`` text (valid JSON of the wrong shape) and every
``pages.html`` text (not JSON), so the error paths run on real rows.
Models are trained on the preprocessed training split; one fit per model
type is reused within a process.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import spec
from ..fixtures import applications, table
from ..operators.split import stratified_split
from ..plans.model_tables import ModelTable, fit_logistic, gradient_table
from ..plans.preprocess import preprocess
from ..plans.scoring import inference_gate, score_payloads
from ..plans.training import (assembler, evaluate, feature_importances, load_model, predict,
                              save_model, train, transform_predict)
from ..session import work_dir
from ..sources.payloads import (ERROR_PREFIX, REQUIRED_KEYS, parse_payloads, parse_split_payloads,
                                records_to_payloads, records_to_split_payloads)
from ..sources.readers import write_processed
from .oracle_sql import MODEL_ORDER, prep_ctes, with_base
from .q_prep import QUOTAS_SQL
from .registry import register

RAW_FIELDS = spec.RAW_COLUMNS


def r6(c):
    return F.round(c, 6)


def payload_table(spark, sf):
    apps = applications(spark, sf).withColumn("g", F.expr(f"{spec.KEY} div 2"))
    own = records_to_payloads(apps, spec.KEY, "g", (F.col("g") % 3) == 0)
    ev = table(spark, sf, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("payload_id"),
                                           F.col("props").alias("payload"))
    pg = table(spark, sf, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("payload_id"),
                                          F.col("html").alias("payload"))
    return own.unionByName(ev).unionByName(pg)


@register("S4_parse_payloads", with_base(f"""
, recs AS (SELECT *, application_id // 2 AS g FROM applications)
SELECT CASE WHEN g % 3 = 0 THEN CAST(g AS VARCHAR) || '-' || CAST(application_id AS VARCHAR)
            ELSE CAST(g AS VARCHAR) END AS payload_id,
       CAST(CASE WHEN g % 3 = 0 THEN 0
                 ELSE row_number() OVER (PARTITION BY g ORDER BY application_id) - 1 END AS INTEGER) AS record_index,
       {", ".join(RAW_FIELDS)}, CAST(NULL AS VARCHAR) AS error
FROM recs
UNION ALL
SELECT 'e' || CAST(event_id AS VARCHAR), NULL, {", ".join("NULL" for _ in RAW_FIELDS)},
       '{ERROR_PREFIX}missing columns {", ".join(REQUIRED_KEYS)}' FROM events
UNION ALL
SELECT 'p' || CAST(page_id AS VARCHAR), NULL, {", ".join("NULL" for _ in RAW_FIELDS)},
       '{ERROR_PREFIX}malformed JSON payload' FROM pages
"""))
def s4(spark, sf):
    return parse_payloads(payload_table(spark, sf), "payload", "payload_id")


SPLIT_ORDER = list(reversed(RAW_FIELDS))


@register("S5_split_payloads", with_base(f"""
SELECT CAST(application_id // 4 AS VARCHAR) AS payload_id, application_id AS row_index, {", ".join(RAW_FIELDS)}
FROM applications
"""))
def s5(spark, sf):
    apps = applications(spark, sf).withColumn("g", F.expr(f"{spec.KEY} div 4"))
    payloads = records_to_split_payloads(apps, "g", SPLIT_ORDER)
    wanted = [(c, "double") for c in spec.RAW_NUMERIC] + [(c, "string") for c in spec.RAW_CATEGORICAL]
    return parse_split_payloads(payloads, "payload", "payload_id", wanted).drop("error")


SPLIT_TYPES = [(c, "double") for c in spec.RAW_NUMERIC] + [(c, "string") for c in spec.RAW_CATEGORICAL]
SPLIT_ERRORS = {1: "values of another type in age", 2: "missing columns income", 3: "empty payload"}


# of the split payloads of four applications each, every fifth holds a text for
# an age, one lacks the income column, one has no rows; beside them texts that
# are no payloads
@register("S5_split_errors", with_base(f"""
, p AS (SELECT *, application_id // 4 AS g FROM applications)
SELECT CAST(g AS VARCHAR) AS payload_id, application_id AS row_index, age, income, home_ownership, CAST(NULL AS VARCHAR) AS error
FROM p WHERE g % 5 IN (0, 4)
UNION ALL SELECT DISTINCT CAST(g AS VARCHAR), NULL, NULL, NULL, NULL, '{ERROR_PREFIX}' || CASE g % 5
  {" ".join(f"WHEN {k} THEN '{e}'" for k, e in SPLIT_ERRORS.items())} END FROM p WHERE g % 5 IN (1, 2, 3)
UNION ALL SELECT 'e' || CAST(event_id AS VARCHAR), NULL, NULL, NULL, NULL, '{ERROR_PREFIX}malformed JSON payload' FROM events
UNION ALL SELECT 'p' || CAST(page_id AS VARCHAR), NULL, NULL, NULL, NULL, '{ERROR_PREFIX}malformed JSON payload' FROM pages
"""))
def s5_errors(spark, sf):
    apps = applications(spark, sf).withColumn("g", F.expr(f"{spec.KEY} div 4"))
    kind = F.col("g") % 5
    apps = apps.withColumn("age", F.when(kind == 1, "thirty").otherwise(F.col("age").cast("string")))
    payloads = records_to_split_payloads(apps.where(~kind.isin(2, 3)), "g", SPLIT_ORDER).unionByName(
        records_to_split_payloads(apps.where(kind == 2), "g", [c for c in SPLIT_ORDER if c != "income"])).unionByName(
        apps.where(kind == 3).select(F.col("g").cast("string").alias("payload_id")).distinct().withColumn(
            "payload", F.lit('{"input_data": {"columns": ["age", "income"], "index": [], "data": []}}')))
    others = [table(spark, sf, t).select(F.concat(F.lit(t[0]), F.col(f"{t[:-1]}_id").cast("string")).alias("payload_id"),
                                         F.col(c).alias("payload")) for t, c in (("events", "props"), ("pages", "html"))]
    every = payloads.unionByName(others[0]).unionByName(others[1])
    return parse_split_payloads(every, "payload", "payload_id", SPLIT_TYPES, required=REQUIRED_KEYS).select(
        "payload_id", "row_index", "age", "income", "home_ownership", "error")


# --- training context ------------------------------------------------------------

_FITS: dict = {}
_SETS: dict = {}


def processed_sets(spark, sf):
    """(params, train, val): preprocessed and split once per process, shared
    by every model type, as the pipeline prepares its data once and then
    trains."""
    key = (sf, spark.sparkContext.applicationId)
    if key not in _SETS:
        processed, params = preprocess(applications(spark, sf))
        # the split scans its input three times (histogram, boundary bucket,
        # the rest): it reads the processed rows written once, not the
        # preprocess plan (features, impute, scale, dictionary lookups)
        full = work_dir(spark, "processed-full")
        processed.write.parquet(full)
        s = stratified_split(spark.read.parquet(full), spec.TARGET, spec.KEY, spec.TEST_SIZE, spec.SEED)
        # cut the lineage: the processed sets are written once (S3), then read
        path = work_dir(spark, "processed-sets")
        write_processed(s, path)
        s = spark.read.parquet(path)
        tr = s.where(F.col("split") == "train").drop("split")
        va = s.where(F.col("split") == "test").drop("split")
        _SETS[key] = (params, tr, va)
    return _SETS[key]


def context(spark, sf, model_type="random_forest"):
    """(model, params, train, val) for this process; fitted once per type."""
    key = (sf, model_type, spark.sparkContext.applicationId)
    if key not in _FITS:
        params, tr, va = processed_sets(spark, sf)
        model = train(tr, model_type)
        _FITS[key] = (model, params, tr, va)
    return _FITS[key]


def _metrics(spark, sf, model_type, prefix="val"):
    model, _, tr, va = context(spark, sf, model_type)
    m = evaluate(model, va if prefix == "val" else tr, prefix)
    return m.select(F.lit(model_type).alias("model_type"), "metric", r6("value").alias("value"))


@register("L1_random_forest")
def l1(spark, sf):
    return _metrics(spark, sf, "random_forest")


@register("L2_logistic_regression")
def l2(spark, sf):
    return _metrics(spark, sf, "logistic_regression")


# the saved-and-loaded model must reproduce every validation prediction
@register("L3_model_roundtrip", with_base(QUOTAS_SQL + """
SELECT CAST(sum(test_c) AS BIGINT) AS rows, CAST(sum(test_c) AS BIGINT) AS same_class,
       0E0 AS max_probability_diff FROM quotas
"""))
def l3(spark, sf):
    model, _, _, va = context(spark, sf, "logistic_regression")
    path = work_dir(spark, "model")
    save_model(model, path)
    back = load_model(path)
    a = predict(model, va, keep=[spec.KEY]).alias("a")
    b = predict(back, va, keep=[spec.KEY]).alias("b")
    j = a.join(b, spec.KEY)
    return j.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col(f"a.{spec.TARGET}") == F.col(f"b.{spec.TARGET}")).alias("same_class"),
                 F.max(F.abs(F.col("a.approval_probability") - F.col("b.approval_probability")))
                 .alias("max_probability_diff"))


@register("L4_feature_vector", with_base(prep_ctes() + " UNION ALL ".join(
    f"SELECT application_id, {i} AS position, round(CAST({c} AS DOUBLE), 6) AS value FROM enc"
    for i, c in enumerate(MODEL_ORDER))))
def l4(spark, sf):
    processed, _ = preprocess(applications(spark, sf))
    from pyspark.ml.functions import vector_to_array
    v = assembler().transform(processed)
    return v.select(spec.KEY, F.posexplode(vector_to_array("features")).alias("position", "value")).select(
        spec.KEY, "position", r6("value").alias("value"))


@register("L5_batch_predict")
def l5(spark, sf):
    model, _, _, va = context(spark, sf, "random_forest")
    return predict(model, va, keep=[spec.KEY]).select(
        spec.KEY, spec.TARGET, r6("approval_probability").alias("approval_probability"), "confidence")


@register("L6_score_payloads")
def l6(spark, sf):
    return scored_payloads(spark, sf).select(
        "payload_id", "record_index", spec.TARGET, r6("approval_probability").alias("approval_probability"),
        "confidence", "error")


@register("L8_train_evaluate")
def l8(spark, sf):
    return _metrics(spark, sf, "random_forest", "train").unionByName(_metrics(spark, sf, "random_forest", "val"))


def validation_payloads(spark, sf, model_type="random_forest"):
    """The raw records of the whole validation set, two to an array payload."""
    _, _, _, va = context(spark, sf, model_type)
    raw = applications(spark, sf).join(va.select(spec.KEY), spec.KEY, "left_semi")
    return records_to_payloads(raw.withColumn("g", F.expr(f"{spec.KEY} div 2")), spec.KEY, "g", F.lit(False))


def inference_check(spark, sf, model_type="random_forest"):
    """L9 over the whole validation set."""
    model, params, _, _ = context(spark, sf, model_type)
    return inference_gate(score_payloads(model, params, validation_payloads(spark, sf, model_type)))


# a valid model scores every validation record without errors, with a class
# per row and probabilities in [0, 1]: the gate passes with no issues
@register("L9_inference_gate", with_base(QUOTAS_SQL + """
SELECT 'inference' AS "check", TRUE AS passed, '' AS issues, CAST(sum(test_c) AS BIGINT) AS rows,
       'true' AS has_probabilities FROM quotas
"""))
def l9(spark, sf):
    return inference_check(spark, sf).select(
        "check", "passed", F.array_join("issues", " | ").alias("issues"),
        F.try_element_at("stats", F.lit("rows")).cast("long").alias("rows"),
        F.try_element_at("stats", F.lit("has_probabilities")).alias("has_probabilities"))


# --- what SQL can say of the model queries ------------------------------------------

def _outcome(out):
    """Per scored row: is there a prediction, do class and band agree with
    the probability."""
    p = F.col("approval_probability")
    band = F.when(p >= 0.8, "high").when(p >= 0.6, "medium").otherwise("low")
    return out.select(
        "payload_id", "record_index", p.isNotNull().alias("has_prediction"),
        (p.between(0, 1) & (F.col(spec.TARGET) == (p > 0.5).cast("int"))).alias("class_agrees"),
        F.when(p.isNotNull(), F.col("confidence") == band).alias("band_agrees"), "error")


OUTCOME_SQL = with_base(f"""
, recs AS (SELECT *, application_id // 2 AS g FROM applications)
SELECT CASE WHEN g % 3 = 0 THEN CAST(g AS VARCHAR) || '-' || CAST(application_id AS VARCHAR)
            ELSE CAST(g AS VARCHAR) END AS payload_id,
       CAST(CASE WHEN g % 3 = 0 THEN 0
                 ELSE row_number() OVER (PARTITION BY g ORDER BY application_id) - 1 END AS INTEGER) AS record_index,
       TRUE AS has_prediction, TRUE AS class_agrees, TRUE AS band_agrees, CAST(NULL AS VARCHAR) AS error
FROM recs
UNION ALL
SELECT 'e' || CAST(event_id AS VARCHAR), NULL, FALSE, NULL, NULL,
       '{ERROR_PREFIX}missing columns {", ".join(REQUIRED_KEYS)}' FROM events
UNION ALL
SELECT 'p' || CAST(page_id AS VARCHAR), NULL, FALSE, NULL, NULL, '{ERROR_PREFIX}malformed JSON payload' FROM pages
""")


def scored_payloads(spark, sf):
    model, params, _, _ = context(spark, sf, "random_forest")
    return score_payloads(model, params, payload_table(spark, sf))


@register("L6_score_outcomes", OUTCOME_SQL)
def l6_outcomes(spark, sf):
    return _outcome(scored_payloads(spark, sf))


@register("L7_stream_outcomes", OUTCOME_SQL)
def l7_outcomes(spark, sf):
    return _outcome(streamed_payloads(spark, sf))


# the medians that L6 fills in: those of each payload's own records
@register("L6_payload_fills", with_base(f"""
, recs AS (SELECT *, application_id // 2 AS g FROM applications),
m AS (SELECT g, count(*) AS n, {", ".join(f"median({c}) AS m_{c}" for c in spec.RAW_NUMERIC)} FROM recs GROUP BY g)
SELECT CASE WHEN m.g % 3 = 0 THEN CAST(m.g AS VARCHAR) || '-' || CAST(application_id AS VARCHAR)
            ELSE CAST(m.g AS VARCHAR) END AS payload_id,
       CAST(CASE WHEN m.g % 3 = 0 THEN 0
                 ELSE row_number() OVER (PARTITION BY m.g ORDER BY application_id) - 1 END AS INTEGER) AS record_index,
       {", ".join(f"round(COALESCE({c}, CASE WHEN n > 1 AND m.g % 3 <> 0 THEN m_{c} ELSE 0E0 END), 6) AS {c}"
                  for c in spec.RAW_NUMERIC)}
FROM recs JOIN m ON recs.g = m.g
"""))
def l6_fills(spark, sf):
    rows = parse_payloads(payload_table(spark, sf), "payload", "payload_id", with_fills=True)
    return rows.where(F.col("error").isNull()).select("payload_id", "record_index", *[
        r6(F.coalesce(F.col(c), F.col(f"fill_{c}"))).alias(c) for c in spec.RAW_NUMERIC])


@register("L5_predict_outcomes", with_base(QUOTAS_SQL + """
SELECT CAST(sum(test_c) AS BIGINT) AS rows, CAST(sum(test_c) AS BIGINT) AS keys,
       CAST(sum(test_c) AS BIGINT) AS class_agrees FROM quotas
"""))
def l5_outcomes(spark, sf):
    p = F.col("approval_probability")
    model, _, _, va = context(spark, sf, "random_forest")
    return predict(model, va, keep=[spec.KEY]).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(spec.KEY).alias("keys"),
        F.count_if(p.between(0, 1) & (F.col(spec.TARGET) == (p > 0.5).cast("int"))).alias("class_agrees"))


@register("T1_importance_features", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 1E0 AS total" for c in MODEL_ORDER))
def t1_features(spark, sf):
    model, _, _, _ = context(spark, sf, "random_forest")
    imp = feature_importances(model, 20)
    total = imp.agg(F.round(F.sum("importance"), 6)).scalar()
    return imp.where(F.col("importance") >= 0).select("feature", total.alias("total"))


# both model types pass the acceptance limits on validation
@register("L8_acceptance", " UNION ALL ".join(
    f"SELECT '{m}' AS model_type, 'val_{k}' AS metric, TRUE AS passed"
    for m in ("random_forest", "logistic_regression") for k in ("accuracy", "precision", "recall", "f1", "auc")))
def l8_acceptance(spark, sf):
    both = _metrics(spark, sf, "random_forest").unionByName(_metrics(spark, sf, "logistic_regression"))
    limit = F.when(F.col("metric") == "val_accuracy", 0.80).otherwise(0.75)
    return both.select("model_type", "metric", ((F.col("value") >= limit) & (F.col("value") <= 1)).alias("passed"))


@register("T1_feature_importance")
def t1(spark, sf):
    model, _, _, _ = context(spark, sf, "random_forest")
    return feature_importances(model, 20).select("feature", r6("importance").alias("importance"))


def write_payload_files(payloads, path):
    """Payload files for a stream: JSON lines, compressed, as their texts repeat the
    same names in every record."""
    payloads.write.mode("append").option("compression", "gzip").json(path)


def streamed_payloads(spark, sf):
    from ..streaming.scoring_stream import start_scoring

    model, params, _, _ = context(spark, sf, "random_forest")
    src, out, ckpt = (work_dir(spark, n) for n in ("payload-files", "stream-out", "stream-checkpoint"))
    write_payload_files(payload_table(spark, sf), src)
    start_scoring(spark, model, params, src, out, ckpt, available_now=True).awaitTermination()
    return spark.read.parquet(out)


@register("L7_stream_score")
def l7(spark, sf):
    return streamed_payloads(spark, sf).select(
        "payload_id", "record_index", spec.TARGET, r6("approval_probability").alias("approval_probability"),
        "confidence", "error")


# --- models as tables -----------------------------------------------------------------

def model_table(spark, sf, model_type="random_forest"):
    model, _, _, _ = context(spark, sf, model_type)
    path = work_dir(spark, "model-with-table")
    save_model(model, path)
    return ModelTable.load(spark, path)


# every validation row has the same class and probability from the table's
# rows, by path look-ups or sums, as from the model
@register("L5_table_scores", with_base(QUOTAS_SQL + """
SELECT m AS model_type, CAST(sum(test_c) AS BIGINT) AS rows, CAST(sum(test_c) AS BIGINT) AS same_class,
       0E0 AS max_probability_diff FROM quotas, (VALUES ('random_forest'), ('logistic_regression')) v(m) GROUP BY m
"""))
def l5_table(spark, sf):
    frames = []
    for kind in ("random_forest", "logistic_regression"):
        model, _, _, va = context(spark, sf, kind)
        a, b = transform_predict(model, va, keep=[spec.KEY]).alias("a"), predict(model_table(spark, sf, kind), va, keep=[spec.KEY]).alias("b")
        frames.append(a.join(b, spec.KEY).agg(
            F.lit(kind).alias("model_type"), F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(f"a.{spec.TARGET}") == F.col(f"b.{spec.TARGET}")).alias("same_class"),
            F.round(F.max(F.abs(F.col("a.approval_probability") - F.col("b.approval_probability"))), 9).alias("max_probability_diff")))
    return frames[0].unionByName(frames[1])


# payloads scored end to end with the table: the same rows as with the model,
# equal to nine digits
@register("L6_table_scores", OUTCOME_SQL.replace("TRUE AS has_prediction, TRUE AS class_agrees, TRUE AS band_agrees",
                                                 "TRUE AS same_as_model").replace("FALSE, NULL, NULL,", "TRUE,"))
def l6_table(spark, sf):
    model, params, _, _ = context(spark, sf, "random_forest")
    payloads = payload_table(spark, sf)
    a = score_payloads(model, params, payloads, predict_by=transform_predict).alias("a")
    b = score_payloads(model_table(spark, sf), params, payloads).alias("b")
    same = F.lit(True)
    for c in (spec.TARGET, "confidence", "error"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    same = same & F.round("a.approval_probability", 9).eqNullSafe(F.round("b.approval_probability", 9))
    key = (F.col("a.payload_id") == F.col("b.payload_id")) & F.col("a.record_index").eqNullSafe(F.col("b.record_index"))
    return a.join(b, key).select("a.payload_id", "a.record_index", same.alias("same_as_model"), "a.error")


# importances from the nodes' gains equal the model's
@register("T1_table_importances", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 0E0 AS diff" for c in MODEL_ORDER))
def t1_table(spark, sf):
    model, _, _, _ = context(spark, sf, "random_forest")
    a = feature_importances(model, len(MODEL_ORDER)).alias("a")
    b = model_table(spark, sf).importances().withColumnRenamed("importance", "own")
    return a.join(b, "feature", "left").select("feature", F.round(F.abs(F.col("importance") - F.coalesce("own", F.lit(0.0))), 9).alias("diff"))


# the fit's proof: at the coefficients found by Newton steps the gradient,
# summed over all training rows, is zero in every coordinate
@register("L2_optimality", with_base(QUOTAS_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(sum(train_c) AS BIGINT) AS rows, 0E0 AS gradient FROM quotas" for c in [*MODEL_ORDER, "(intercept)"])))
def l2_optimality(spark, sf):
    _, tr, _ = processed_sets(spark, sf)
    table, _ = fit_logistic(tr)
    g = gradient_table(tr, table)
    return g.select("feature", "rows", F.abs(F.round("gradient", 4)).alias("gradient"))


# two files, two batches: the second is scored by the version registered between
# them; every payload has its rows once
@register("L7_versioned_stream", OUTCOME_SQL)
def l7_versioned(spark, sf):
    from ..plans.catalog import Catalog
    from ..streaming.versioned_scoring import VersionedScorer, register_scorer, start_versioned_scoring

    catalog = Catalog(spark, work_dir(spark, "stream-catalog"))
    src, out, ckpt = (work_dir(spark, n) for n in ("payload-files", "versioned-out", "versioned-checkpoint"))
    scorer = VersionedScorer(catalog, "loan-approval-model", out)
    payloads = payload_table(spark, sf)
    for n, kind in enumerate(("logistic_regression", "random_forest")):
        model, params, _, _ = context(spark, sf, kind)
        register_scorer(catalog, "loan-approval-model", model, params, work_dir(spark, f"scorer-{n}"))
        write_payload_files(payloads.where(F.pmod(F.hash("payload_id"), F.lit(2)) == n), src)
        start_versioned_scoring(scorer, src, ckpt).awaitTermination()
    return _outcome(scorer.rows())


# the forest's nodes by their own numbers: 100 trees no deeper than 10; a split's
# rows and positive rows are those of its children, and its gain is the fall in Gini
# impurity that they make
@register("L1_forest_nodes", """
SELECT CAST(100 AS BIGINT) AS trees, TRUE AS depth_within_limit, CAST(0 AS BIGINT) AS wrong_rows, CAST(0 AS BIGINT) AS wrong_gains,
       CAST(0 AS BIGINT) AS useless_splits
""")
def l1_nodes(spark, sf):
    table = model_table(spark, sf)
    n = table.table.select("tree", "node", "feature", "left", "right", "rows", "gain", "p1", (2 * F.col("p1") * (1 - F.col("p1"))).alias("gini"))

    def child(side: str):
        return n.select("tree", F.col("node").alias(side), *[F.col(c).alias(f"{side[0]}_{c}") for c in ("rows", "p1", "gini")])
    j = n.where("feature is not null").join(child("left"), ["tree", "left"]).join(child("right"), ["tree", "right"])
    fall = F.col("gini") - (F.col("l_rows") * F.col("l_gini") + F.col("r_rows") * F.col("r_gini")) / F.col("rows")
    rows_differ = (F.abs(F.col("rows") - F.col("l_rows") - F.col("r_rows")) > 1e-6) | (
        F.abs(F.col("rows") * F.col("p1") - F.col("l_rows") * F.col("l_p1") - F.col("r_rows") * F.col("r_p1")) > 1e-6)
    wrong = j.agg(F.count_if(rows_differ).alias("wrong_rows"), F.count_if(F.abs(fall - F.col("gain")) > 1e-9).alias("wrong_gains"),
                  F.count_if(F.col("gain") <= 0).alias("useless_splits"), F.count("*").alias("joined"))
    facts = n.agg(F.count_distinct("tree").alias("trees"), F.count("feature").alias("splits"))
    # a split whose children aren't there counts as wrong
    return wrong.select(facts.select("trees").scalar().alias("trees"), F.lit(table.depth() <= spec.RF_DEPTH).alias("depth_within_limit"),
                        (F.col("wrong_rows") + facts.select("splits").scalar() - F.col("joined")).alias("wrong_rows"), "wrong_gains", "useless_splits")
