"""Suite: catalog operations C1-C12 and T2.

Feature-set operations run on a fresh catalog folder holding the feature
view of the applications. Model-version operations run on a registry
derived from ``part`` (FIXTURES.md: part stands in for T2, P17 and C10):
one registered version per part, name = brand, version = part key, tags
from the part's type, size and price.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import spec
from ..fixtures import applications, table
from ..functions.features import build_features
from ..functions.maps import merge_tags
from ..plans.catalog import (Catalog, exact_versions, last_registered, latest_versions, list_models, model_counts,
                             resolve_versions, select_model)
from ..session import work_dir
from .oracle_sql import with_base
from .q_gates import REQUESTED
from .q_metrics import SCORED_SQL, scored
from .q_profile import FEATURE_COLS, STRING_COLS
from .registry import register

SET_NAME = "loan-approval-features"


def registry(spark, sf):
    p = table(spark, sf, "part")
    env = F.when(F.col("p_size") <= 10, "staging").when(F.col("p_size") <= 25, "prod")
    stage = F.when(F.col("p_retailprice") > 1500, "Production")
    tags = F.map_filter(F.create_map(F.lit("model_type"), F.lower("p_type"), F.lit("environment"), env,
                                     F.lit("stage"), stage), lambda k, v: v.isNotNull())
    # time-zone free: a TIMESTAMP_NTZ base plus a day-time interval
    reg = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (p_partkey * 7919) % 100003)")
    return p.select(F.col("p_brand").alias("name"), F.col("p_partkey").alias("version"),
                    F.concat(F.col("p_brand"), F.lit(":"), F.col("p_partkey").cast("string")).alias("id"),
                    F.concat(F.lit("job-"), F.col("p_partkey").cast("string")).alias("training_job"),
                    reg.alias("registration_time"),
                    tags.alias("tags"), F.col("p_name").alias("description"))


REGISTRY_SQL = """
reg AS (SELECT p_brand AS name, p_partkey AS version, p_brand || ':' || CAST(p_partkey AS VARCHAR) AS id,
               lower(p_type) AS model_type,
               CASE WHEN p_size <= 10 THEN 'staging' WHEN p_size <= 25 THEN 'prod' END AS environment,
               CASE WHEN p_retailprice > 1500 THEN 'Production' END AS stage,
               TIMESTAMP '2024-01-01 00:00:00' + to_seconds((p_partkey * 7919) % 100003) AS registration_time
        FROM part),
latest AS (SELECT r.* FROM reg r JOIN (SELECT name, max(version) AS v FROM reg GROUP BY name) m
           ON r.name = m.name AND r.version = m.v)
"""


@register("T2_latest_version", f"WITH {REGISTRY_SQL} SELECT name, version FROM latest")
def t2(spark, sf):
    return latest_versions(registry(spark, sf)).select("name", "version")


@register("C8_last_registered", f"""WITH {REGISTRY_SQL}
SELECT name, version, registration_time FROM reg ORDER BY registration_time DESC, version DESC LIMIT 1""")
def c8(spark, sf):
    return last_registered(registry(spark, sf)).select("name", "version", "registration_time")


# exact versions: each part asked for under its own brand, and under the brand
# of its size's number, which seldom has it
@register("T2_exact_version", f"""WITH {REGISTRY_SQL},
req AS (SELECT p_brand AS name, p_partkey AS version FROM part
        UNION SELECT 'Brand#' || CAST(p_size AS VARCHAR), p_partkey FROM part)
SELECT req.name, req.version, reg.id IS NOT NULL AS found, reg.id
FROM req LEFT JOIN reg ON req.name = reg.name AND req.version = reg.version
""")
def t2_exact(spark, sf):
    p = table(spark, sf, "part")
    other = F.concat(F.lit("Brand#"), F.col("p_size").cast("string"))
    requests = p.select(F.col("p_brand").alias("name"), F.col("p_partkey").alias("version")).union(
        p.select(other, "p_partkey")).distinct()
    return exact_versions(registry(spark, sf), requests)


@register("C9_list_models", f"""WITH {REGISTRY_SQL}
SELECT name, version, registration_time, COALESCE(environment, 'Unknown') AS environment,
       COALESCE(model_type, 'Unknown') AS model_type FROM reg
""")
def c9(spark, sf):
    return list_models(registry(spark, sf))


@register("C9_model_counts", f"""WITH {REGISTRY_SQL}
SELECT name, CAST(1 AS BIGINT) AS models, CAST(count(*) AS BIGINT) AS versions FROM reg GROUP BY name
UNION ALL SELECT NULL, CAST(count(DISTINCT name) AS BIGINT), CAST(count(*) AS BIGINT) FROM reg
""")
def c9_counts(spark, sf):
    return model_counts(registry(spark, sf))


NEW_TAGS_SQL = "'environment', 'size-' || CAST(p_size AS VARCHAR), 'owner', 'team-' || CAST(p_size % 5 AS VARCHAR)"


@register("C10_merge_tags", f"""WITH {REGISTRY_SQL},
old AS (SELECT version, 'model_type' AS key, model_type AS value FROM reg
        UNION ALL SELECT version, 'environment', environment FROM reg WHERE environment IS NOT NULL
        UNION ALL SELECT version, 'stage', stage FROM reg WHERE stage IS NOT NULL),
new AS (SELECT p_partkey AS version, 'environment' AS key, 'size-' || CAST(p_size AS VARCHAR) AS value FROM part
        UNION ALL SELECT p_partkey, 'owner', 'team-' || CAST(p_size % 5 AS VARCHAR) FROM part)
SELECT version, key, value FROM old WHERE NOT EXISTS
       (SELECT 1 FROM new WHERE new.version = old.version AND new.key = old.key)
UNION ALL SELECT version, key, value FROM new
""")
def c10(spark, sf):
    reg = registry(spark, sf).alias("r")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("version"), "p_size")
    j = reg.join(p, "version")
    new = F.create_map(F.lit("environment"), F.concat(F.lit("size-"), F.col("p_size").cast("string")),
                       F.lit("owner"), F.concat(F.lit("team-"), (F.col("p_size") % 5).cast("string")))
    return j.select("version", F.explode(merge_tags(F.col("tags"), new)).alias("key", "value"))


@register("C11_select_model", f"""WITH {REGISTRY_SQL}
SELECT name, version, id, COALESCE(stage, 'Unknown') AS stage FROM latest""")
def c11(spark, sf):
    return select_model(registry(spark, sf)).select("name", "version", "id", "stage")


# A request per brand (explicit version for even brand numbers: the
# smallest part key of the brand), plus one request per nation name, which
# names no model. A previous selection exists for brands divisible by 3: the
# newest part of size <= 25, under a name of its own for brands divisible by 9.
# A last registered record exists for brands divisible by 5: the oldest part.
@register("C12_resolve_version", f"""WITH {REGISTRY_SQL},
brands AS (SELECT p_brand AS name, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS num, min(p_partkey) AS lo,
                  max(CASE WHEN p_size <= 25 THEN p_partkey END) AS sel
           FROM part GROUP BY 1, 2),
req AS (SELECT name, CASE WHEN num % 2 = 0 THEN lo END AS version, CASE WHEN num % 3 = 0 THEN sel END AS sel,
               CASE WHEN num % 9 = 0 THEN 'alias-' || name END AS own, CASE WHEN num % 5 = 0 THEN lo END AS last
        FROM brands
        UNION ALL SELECT n_name, NULL, NULL, NULL, NULL FROM nation)
SELECT req.name, CASE WHEN req.version IS NULL AND req.sel IS NOT NULL AND req.own IS NOT NULL THEN req.own
                      WHEN COALESCE(req.version, req.sel, req.last, latest.version) IS NOT NULL THEN req.name
                 END AS resolved_name,
       COALESCE(req.version, req.sel, req.last, latest.version) AS resolved_version,
       CASE WHEN req.version IS NOT NULL THEN 'explicit' WHEN req.sel IS NOT NULL THEN 'selected'
            WHEN req.last IS NOT NULL THEN 'registered' WHEN latest.version IS NOT NULL THEN 'latest' END AS source,
       CASE WHEN COALESCE(req.version, req.sel, req.last, latest.version) IS NULL
            THEN 'No models found with name ''' || req.name || '''' END AS error
FROM req LEFT JOIN latest ON req.name = latest.name
""")
def c12(spark, sf):
    p = table(spark, sf, "part")
    num = F.split("p_brand", "#").getItem(1).cast("int")
    brands = p.groupBy(F.col("p_brand").alias("name"), num.alias("num")).agg(
        F.min("p_partkey").alias("lo"), F.max(F.when(F.col("p_size") <= 25, F.col("p_partkey"))).alias("sel"))
    requests = brands.select("name", F.when(F.col("num") % 2 == 0, F.col("lo")).alias("version")).unionByName(
        table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.lit(None).cast("long").alias("version")))
    own = F.when(F.col("num") % 9 == 0, F.concat(F.lit("alias-"), F.col("name")))
    selected = brands.where((F.col("num") % 3 == 0) & F.col("sel").isNotNull()).select(
        "name", own.alias("selected_name"), F.col("sel").alias("version"))
    registered = brands.where(F.col("num") % 5 == 0).select("name", F.col("lo").alias("version"))
    return resolve_versions(requests, registry(spark, sf), selected, registered)


# --- feature-set catalog ----------------------------------------------------------------

def feature_catalog(spark, sf):
    cat = Catalog(spark, work_dir(spark, "catalog"))
    data_path = work_dir(spark, "feature-data")
    build_features(applications(spark, sf)).write.mode("overwrite").parquet(data_path)
    data = spark.read.parquet(data_path)
    cat.create_feature_set(SET_NAME, data.select(*FEATURE_COLS), "Loan approval features",
                           {"created_by": "credence", "model_type": "loan_approval"}, data_path=data_path)
    cat.create_feature_set(SET_NAME + "-meta", None, "Loan approval features (metadata only)")
    return cat


def _schema_rows_sql():
    return " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS feature, "
        f"'{'categorical' if c in STRING_COLS or c == 'application_ts' else 'numeric'}' AS type, "
        f"count(*) > count({c}) AS nullable FROM features"
        for i, c in enumerate([c for c in FEATURE_COLS if c != "loan_approved"]))


@register("C1_create_feature_set", with_base(f"""
, fs AS ({_schema_rows_sql()})
SELECT '{SET_NAME}' AS name, CAST(1 AS BIGINT) AS version, 'created_with_schema' AS status,
       feature, type, nullable, CAST((SELECT count(*) FROM fs) AS BIGINT) AS total_features,
       CAST((SELECT count(*) FROM features) AS BIGINT) AS sample_count
FROM fs
"""))
def c1(spark, sf):
    cat = feature_catalog(spark, sf)
    fs = cat.feature_sets().where(F.col("name") == SET_NAME)
    return fs.select("name", "version", "status", "total_features", "sample_count",
                     F.explode("features").alias("f")).select(
        "name", "version", "status", F.col("f.name").alias("feature"), F.col("f.type").alias("type"),
        F.col("f.nullable").alias("nullable"), "total_features", "sample_count")


@register("C2_feature_view", with_base(
    "SELECT income, age, credit_score, loan_approved FROM features"))
def c2(spark, sf):
    cat = feature_catalog(spark, sf)
    return cat.create_feature_view(SET_NAME + "-view", REQUESTED, SET_NAME, 1, "training view",
                                   view="loan_approval_view")


@register("C3_list_feature_sets", with_base(f"""
SELECT '{SET_NAME}' AS name, CAST(1 AS BIGINT) AS version, 'created_with_schema' AS status,
       CAST(count(*) AS BIGINT) AS sample_count FROM features
UNION ALL SELECT '{SET_NAME}-meta', 1, 'created_metadata_only', NULL
"""))
def c3(spark, sf):
    cat = feature_catalog(spark, sf)
    return cat.list_feature_sets().join(cat.feature_sets().select("name", "version", "sample_count"),
                                        ["name", "version"])


@register("C4_get_feature_data", with_base("""
SELECT income, age, credit_score, loan_approved FROM features
WHERE application_ts >= TIMESTAMP '1996-01-01 00:00:00' AND application_ts < TIMESTAMP '1997-01-01 00:00:00'
"""))
def c4(spark, sf):
    import datetime as dt
    cat = feature_catalog(spark, sf)
    return cat.get_feature_data(SET_NAME, 1, REQUESTED, dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1))


# data written by time: one year opens a part of the files, the rows are the same
@register("C4_file_pruning", with_base("""
SELECT year(application_ts) AS year, CAST(count(*) AS BIGINT) AS rows, round(sum(income), 2) AS income, TRUE AS opens_fewer_files
FROM features WHERE year(application_ts) BETWEEN 1996 AND 2000 GROUP BY 1
"""))
def c4_pruning(spark, sf):
    import datetime as dt
    cat = Catalog(spark, work_dir(spark, "catalog"))
    cat.write_feature_set(SET_NAME, build_features(applications(spark, sf)), files=16)
    everything = len(cat.get_feature_data(SET_NAME, 1).inputFiles())
    frames = []
    for year in range(1996, 2001):
        data = cat.get_feature_data(SET_NAME, 1, ["income", spec.TS], dt.datetime(year, 1, 1), dt.datetime(year + 1, 1, 1))
        frames.append(data.agg(F.lit(year).cast("long").alias("year"), F.count("*").alias("rows"), F.round(F.sum("income"), 2).alias("income"),
                               F.lit(len(data.inputFiles()) < everything / 2).alias("opens_fewer_files")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("C5_archive_feature_set", with_base(f"""
SELECT '{SET_NAME}' AS name, CAST(2 AS BIGINT) AS version, 'created_with_schema' AS status,
       CAST(count(*) AS BIGINT) AS sample_count FROM features
UNION ALL SELECT '{SET_NAME}-meta', 1, 'created_metadata_only', NULL
"""))
def c5(spark, sf):
    cat = feature_catalog(spark, sf)
    data = cat.feature_sets().where((F.col("name") == SET_NAME) & (F.col("version") == 1)).select("data_path").first()
    cat.create_feature_set(SET_NAME, spark.read.parquet(data["data_path"]).select(*FEATURE_COLS),
                           "Loan approval features, second version", data_path=data["data_path"])
    cat.archive_feature_set(SET_NAME, 1)
    return cat.list_feature_sets().join(cat.feature_sets().select("name", "version", "sample_count"),
                                        ["name", "version"])


def _scorecard_metrics(spark, sf):
    from ..operators.metrics import binary_metrics, roc_auc
    s = scored(spark, sf)
    m = binary_metrics(s, spec.TARGET, "pred")
    long = m.select(F.explode(F.array(*[F.struct(F.lit(f"val_{c}").alias("metric"), F.col(c).alias("value"))
                                       for c in m.columns])).alias("s")).select("s.*")
    return long.unionByName(roc_auc(s, spec.TARGET, "prob").select(F.lit("val_auc").alias("metric"),
                                                                     F.col("auc").alias("value")))


C6_ORACLE = with_base(SCORED_SQL + """
, c AS (SELECT CAST(count(*) AS DOUBLE) AS n,
               CAST(sum(CASE WHEN loan_approved = pred THEN 1 ELSE 0 END) AS DOUBLE) AS correct,
               CAST(sum(CASE WHEN loan_approved = 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
               CAST(sum(CASE WHEN pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pp,
               CAST(sum(CASE WHEN loan_approved = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS ap FROM scored),
m AS (SELECT correct / n AS accuracy, CASE WHEN pp = 0 THEN 0E0 ELSE tp / pp END AS precision,
             CASE WHEN ap = 0 THEN 0E0 ELSE tp / ap END AS recall FROM c),
s AS (SELECT prob AS v, sum(CASE WHEN loan_approved = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN loan_approved = 1 THEN 0 ELSE 1 END) AS neg FROM scored GROUP BY 1),
a AS (SELECT sum(CAST(pos AS DOUBLE) * (CAST(COALESCE(nb, 0) AS DOUBLE) + 0.5E0 * neg))
             / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
      FROM (SELECT *, sum(neg) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM s) x)
SELECT 'run-1' AS run_id, 'param' AS kind, 'model_type' AS key, 'scorecard' AS text_value,
       CAST(NULL AS DOUBLE) AS num_value
UNION ALL SELECT 'run-1', 'param', 'cutoff', '50', NULL
UNION ALL SELECT 'run-1', 'metric', 'val_accuracy', NULL, round(accuracy, 6) FROM m
UNION ALL SELECT 'run-1', 'metric', 'val_precision', NULL, round(precision, 6) FROM m
UNION ALL SELECT 'run-1', 'metric', 'val_recall', NULL, round(recall, 6) FROM m
UNION ALL SELECT 'run-1', 'metric', 'val_f1', NULL,
       round(CASE WHEN precision + recall = 0 THEN 0E0 ELSE 2E0 * precision * recall / (precision + recall) END, 6)
       FROM m
UNION ALL SELECT 'run-1', 'metric', 'val_auc', NULL, round(auc, 6) FROM a
""")


@register("C6_log_run", C6_ORACLE)
def c6(spark, sf):
    cat = Catalog(spark, work_dir(spark, "catalog"))
    cat.log_run("run-1", {"model_type": "scorecard", "cutoff": spec.APPROVAL_CUTOFF}, _scorecard_metrics(spark, sf))
    runs = cat.read("runs")
    metric = F.col("kind") == "metric"
    return runs.select("run_id", "kind", "key", F.when(~metric, F.col("value")).alias("text_value"),
                       F.when(metric, F.round(F.col("value").cast("double"), 6)).alias("num_value"))


C7_METRICS_SQL = """
UNION ALL SELECT v, 'metric_val_accuracy', NULL, round(accuracy, 6) FROM m, vs
UNION ALL SELECT v, 'metric_val_precision', NULL, round(precision, 6) FROM m, vs
UNION ALL SELECT v, 'metric_val_recall', NULL, round(recall, 6) FROM m, vs
UNION ALL SELECT v, 'metric_val_f1', NULL,
       round(CASE WHEN precision + recall = 0 THEN 0E0 ELSE 2E0 * precision * recall / (precision + recall) END, 6)
       FROM m, vs
UNION ALL SELECT v, 'metric_val_auc', NULL, round(auc, 6) FROM a, vs
"""


@register("C7_register_model", C6_ORACLE.split("SELECT 'run-1' AS run_id")[0] + """,
vs AS (SELECT 1 AS v UNION ALL SELECT 2),
t AS (SELECT 1 AS v, 'model_type' AS key, 'scorecard' AS text_value, CAST(NULL AS DOUBLE) AS num_value
      UNION ALL SELECT 1, 'environment', 'dev', NULL
      UNION ALL SELECT 2, 'model_type', 'scorecard', NULL
      UNION ALL SELECT 2, 'environment', 'prod', NULL
      UNION ALL SELECT 2, 'stage', 'Production', NULL""" + C7_METRICS_SQL + """)
SELECT 'loan-approval-model' AS name, CAST(v AS BIGINT) AS version, key, text_value, num_value FROM t
""")
def c7(spark, sf):
    cat = Catalog(spark, work_dir(spark, "catalog"))
    metrics = _scorecard_metrics(spark, sf)
    for _ in range(2):
        cat.register_model("loan-approval-model", path="(scorecard)", metrics=metrics,
                           tags={"model_type": "scorecard", "environment": "dev"},
                           properties={"model_format": "spark-ml"}, training_job="local_training")
    cat.add_model_tags("loan-approval-model", 2, {"stage": "Production", "environment": "prod"})
    tags = cat.model_versions().select("name", "version", F.explode("tags").alias("key", "value"))
    metric = F.col("key").startswith("metric_")
    return tags.select("name", "version", "key", F.when(~metric, F.col("value")).alias("text_value"),
                       F.when(metric, F.round(F.col("value").cast("double"), 6)).alias("num_value"))
