"""Suite: scans and sinks S1-S3, S6, S9, S10 (written to the shared work
folder, then read back)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..fixtures import applications, table
from ..operators.split import stratified_split
from ..plans.catalog import Catalog, publish_dataset, read_dataset
from ..plans.preprocess import preprocess
from ..session import work_dir
from ..sources.csv_scan import scan_csv
from ..sources.readers import (RAW_SCHEMA, load_csv, load_train_val, read_documents, write,
                               write_documents, write_processed, write_splits)
from .oracle_sql import with_base
from .q_catalog import _schema_rows_sql
from .q_prep import LEHMER_SPLIT_SQL, PROCESSED_SQL, QUOTAS_SQL
from .registry import register

CSV_SCHEMA = T.StructType([T.StructField(f.name, T.TimestampNTZType() if f.name == spec.TS else f.dataType)
                           for f in RAW_SCHEMA.fields])


@register("S1_csv_scan", with_base("SELECT * FROM applications"))
def s1(spark, sf):
    path = work_dir(spark, "applications-csv")
    write(applications(spark, sf), path, "csv")
    return load_csv(spark, path, CSV_SCHEMA)


REFERENCE_ORDER = [*spec.RAW_NUMERIC, *spec.RAW_CATEGORICAL, spec.TARGET]   # no key, no time


def csv_folder(spark, sf):
    """Applications as CSV files of three layouts: by key thirds, columns in
    schema order, reversed with a column more, and as files without key and time."""
    apps = applications(spark, sf)
    part = F.pmod(F.col(spec.KEY), F.lit(3))
    layouts = [(0, apps.columns), (1, ["extra", *reversed(apps.columns)]), (2, REFERENCE_ORDER)]
    paths = [work_dir(spark, f"csv-layout-{n}") for n, _ in layouts]
    for (n, columns), path in zip(layouts, paths, strict=True):
        write(apps.withColumn("extra", F.lit("a,b")).where(part == n).select(*columns), path, "csv")
    return paths


@register("S1_csv_by_name", with_base(f"""
SELECT CASE WHEN application_id % 3 < 2 THEN application_id END AS application_id,
       CASE WHEN application_id % 3 < 2 THEN application_ts END AS application_ts, {", ".join(REFERENCE_ORDER)}
FROM applications
"""))
def s1_by_name(spark, sf):
    rows = scan_csv(spark, csv_folder(spark, sf), CSV_SCHEMA).rows
    return rows.select(spec.KEY, spec.TS, *REFERENCE_ORDER)


# keys from content and occurrence: as many as rows, the same from other files
@register("S1_csv_made_keys", with_base("""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS keys, CAST(count(*) AS BIGINT) AS same_keys FROM applications
"""))
def s1_keys(spark, sf):
    paths = [work_dir(spark, "keyless") for _ in range(2)]
    df = applications(spark, sf).select(*REFERENCE_ORDER)
    write(df, paths[0], "csv")
    write(df.select(*reversed(REFERENCE_ORDER)).repartition(5), paths[1], "csv")
    a, b = (scan_csv(spark, p, CSV_SCHEMA, spec.KEY).rows.select(spec.KEY) for p in paths)
    return a.agg(F.count("*").alias("rows"), F.count_distinct(spec.KEY).alias("keys")).join(
        a.join(b, spec.KEY).agg(F.count("*").alias("same_keys")))


# each events.props text as a line beside the applications: every one is
# malformed, every application a row
@register("S1_csv_quarantine", with_base("""
SELECT 'row' AS kind, CAST(application_id AS VARCHAR) AS content FROM applications
UNION ALL SELECT 'malformed', props FROM events WHERE trim(props) <> ''
UNION ALL SELECT 'malformed', 'not-a-number,' || CAST(application_id AS VARCHAR) FROM applications WHERE age IS NULL
"""))
def s1_quarantine(spark, sf):
    path = work_dir(spark, "csv-malformed")
    apps = applications(spark, sf).select("age", spec.KEY)
    write(apps, path, "csv")
    bad = table(spark, sf, "events").select(F.col("props").alias("value")).unionByName(
        apps.where("age is null").select(F.concat(F.lit("not-a-number,"), F.col(spec.KEY).cast("string")).alias("value")))
    # a file of its own, under a header like the others'
    header = spark.range(1).select(F.lit(f"age,{spec.KEY}").alias("value"))
    other = work_dir(spark, "csv-malformed-lines")
    bad.write.text(other + "-raw")
    lines = spark.read.text(other + "-raw")
    header.withColumn("o", F.lit(0)).unionByName(lines.withColumn("o", F.lit(1))).coalesce(1).sortWithinPartitions("o") \
        .select("value").write.text(other)
    scan = scan_csv(spark, [path, other], CSV_SCHEMA)
    return scan.rows.select(F.lit("row").alias("kind"), F.col(spec.KEY).cast("string").alias("content")).unionByName(
        scan.malformed.select(F.lit("malformed").alias("kind"), F.col("record").alias("content")))


# Only a training set is present, so the validation half is derived by F6;
# per-class counts of the two halves are fixed by the quotas (hash-free).
@register("S2_train_val_resolution", with_base(QUOTAS_SQL + """
SELECT 'train' AS split, label AS loan_approved, train_c AS n FROM quotas
UNION ALL SELECT 'val', label, test_c FROM quotas
"""))
def s2(spark, sf):
    root = work_dir(spark, "training-root")
    processed, _ = preprocess(applications(spark, sf))
    write(processed, f"{root}/train")          # no validation set present
    train, val, _ = load_train_val(spark, root)
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    return both.groupBy("split", spec.TARGET).agg(F.count(F.lit(1)).alias("n"))


def _processed_rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if c in spec.NUMERICAL_FEATURES else F.col(c) for c in df.columns])


@register("S3_write_processed", "WITH p AS (" + PROCESSED_SQL + "), s AS (" + with_base(
    LEHMER_SPLIT_SQL + " SELECT application_id, split FROM split") + """)
SELECT p.*, s.split FROM p JOIN s ON p.application_id = s.application_id
""")
def s3(spark, sf):
    processed, _ = preprocess(applications(spark, sf))
    s = stratified_split(processed, spec.TARGET, spec.KEY, spec.TEST_SIZE, spec.SEED, method="lehmer")
    path = work_dir(spark, "processed")
    write_processed(s, path)
    return _processed_rounded(spark.read.parquet(path))


DOC_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("total_features", T.LongType()),
    T.StructField("sample_count", T.LongType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("nullable", T.BooleanType())]))),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])


@register("S6_metadata_documents", with_base(f"""
, fs AS ({_schema_rows_sql()})
SELECT 'loan-approval-features' AS name, CAST(1 AS BIGINT) AS version, 'created_with_schema' AS status,
       CAST((SELECT count(*) FROM fs) AS BIGINT) AS total_features,
       CAST((SELECT count(*) FROM features) AS BIGINT) AS sample_count,
       feature, type, 'Feature: ' || feature AS description, nullable
FROM fs
"""))
def s6(spark, sf):
    from ..functions.features import build_features
    cat = Catalog(spark, work_dir(spark, "catalog"))
    doc = cat.create_feature_set("loan-approval-features", build_features(applications(spark, sf)),
                                 "Loan approval features", {"model_type": "loan_approval"})
    path = work_dir(spark, "documents")
    write_documents(doc.select(*[f.name for f in DOC_SCHEMA.fields]), path)
    back = read_documents(spark, path, DOC_SCHEMA)
    return back.select("name", "version", "status", "total_features", "sample_count",
                       F.explode("features").alias("f")).select(
        "name", "version", "status", "total_features", "sample_count", F.col("f.name").alias("feature"),
        F.col("f.type").alias("type"), F.col("f.description").alias("description"),
        F.col("f.nullable").alias("nullable"))


@register("S9_publish_dataset", with_base("""
SELECT 2 AS version, application_id FROM features
UNION ALL
SELECT 1, application_id FROM features WHERE application_ts < TIMESTAMP '1998-01-01 00:00:00'
"""))
def s9(spark, sf):
    from ..functions.features import build_features
    cat = Catalog(spark, work_dir(spark, "catalog"))
    f = build_features(applications(spark, sf))
    publish_dataset(cat, "loan-approval-features-data",
                    f.where(F.col(spec.TS) < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")))
    publish_dataset(cat, "loan-approval-features-data", f)
    latest = read_dataset(cat, "loan-approval-features-data")
    first = read_dataset(cat, "loan-approval-features-data", 1)
    return latest.select(F.lit(2).alias("version"), spec.KEY).unionByName(
        first.select(F.lit(1).alias("version"), spec.KEY))


@register("S10_split_writeout", with_base(LEHMER_SPLIT_SQL.split(",\nhashed AS")[0] + """
SELECT 'train' AS split, CAST(sum(train_c) AS BIGINT) AS rows,
       round(CAST(sum(CASE WHEN label = 1 THEN train_c ELSE 0 END) AS DOUBLE) / sum(train_c), 6) AS label_rate
FROM quotas
UNION ALL
SELECT 'test', CAST(sum(test_c) AS BIGINT),
       round(CAST(sum(CASE WHEN label = 1 THEN test_c ELSE 0 END) AS DOUBLE) / sum(test_c), 6) FROM quotas
UNION ALL
SELECT 'full', CAST(count(*) AS BIGINT), round(avg(loan_approved), 6) FROM applications
"""))
def s10(spark, sf):
    out = write_splits(applications(spark, sf), work_dir(spark, "raw-splits"))
    return out.select("split", "rows", F.round("label_rate", 6).alias("label_rate"))
