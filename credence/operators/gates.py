"""Quality gates (Q1-Q6, S7). Each gate is a DataFrame of rows
``(check, passed, issues array<string>, stats map<string,string>)``.

Gates read small summaries (profiles, metric tables, class counts), never
rows. Summaries of different shapes are combined by ``unionByName`` into a
long ``(name, value)`` form and one global aggregate, not by joining
one-row frames. Issue texts keep the reference's wording.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..session import materialize
from .profile import missing_profile

GATE_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("issues", T.ArrayType(T.StringType()), False),
    T.StructField("stats", T.MapType(T.StringType(), T.StringType()), True),
])


def fmt(x: Column, digits: int) -> Column:
    """Python ``f"{x:.{digits}f}"`` for values below 1000 (half-even on the
    binary value, no grouping commas below 1000)."""
    return F.regexp_replace(F.format_number(x, digits), ",", "")


def ordered_texts(ordinal: Column, text: Column) -> Column:
    """Aggregate: the non-NULL ``text`` values ordered by ``ordinal``."""
    coll = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(ordinal.alias("o"), text.alias("t")))))
    return F.transform(coll, lambda s: s["t"])


def gate_frame(df: DataFrame) -> DataFrame:
    return df.select(F.col("check").cast("string"), F.col("passed").cast("boolean"),
                     F.col("issues").cast("array<string>"), F.col("stats").cast("map<string,string>"))


# --- Q1 -------------------------------------------------------------------------

def feature_gate(df: DataFrame, max_missing_pct: float = spec.MAX_COLUMN_MISSING_PCT) -> DataFrame:
    """Q1: a column with > 50 % missing fails the gate; a constant numeric
    column is an issue only."""
    prof = missing_profile(df, distinct=False)
    miss = F.col("missing_pct_raw") > F.lit(float(max_missing_pct))
    numeric = F.col("dtype").isin("int64", "float64")
    issue_missing = F.when(miss, F.concat(F.lit("High missing values in "), F.col("column"), F.lit(": "),
                                          fmt(F.col("missing_pct_raw"), 1), F.lit("%")))
    issue_const = F.when(numeric & F.col("constant"),
                         F.concat(F.lit("No variance in numeric feature: "), F.col("column")))
    rows = prof.select("ordinal", "total_records", miss.alias("_fail"),
                       F.array(issue_missing, issue_const).alias("_pair"))
    agg = rows.agg(
        (~F.coalesce(F.bool_or("_fail"), F.lit(False))).alias("passed"),
        # per column in column order: the missing issue, then the variance issue
        F.filter(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "_pair"))),
                                       lambda s: s["_pair"])), lambda t: t.isNotNull()).alias("issues"),
        F.max("total_records").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return gate_frame(agg.select(
        F.lit("feature_validation").alias("check"), "passed", "issues",
        F.create_map(F.lit("total_records"), F.col("_n").cast("string"),
                     F.lit("total_features"), F.col("_k").cast("string")).alias("stats")))


# --- Q2 -------------------------------------------------------------------------

def thresholds_frame(spark: SparkSession) -> DataFrame:
    rows = [(i, key, float(th), disp.title()) for i, (key, th, disp) in enumerate(spec.PERFORMANCE_THRESHOLDS)]
    return spark.createDataFrame(rows, "ordinal int, metric string, threshold double, display string")


def performance_gate(metrics: DataFrame) -> DataFrame:
    """Q2: ``metrics`` is ``(metric, value)`` (e.g. ``val_accuracy``). Below a
    threshold -> fail with issue; metric absent -> issue only; no metrics at
    all -> fail."""
    spark = metrics.sparkSession
    t = thresholds_frame(spark)
    m = metrics.select(F.col("metric").alias("_m"), F.col("value").cast("double").alias("value"))
    j = t.join(m, t["metric"] == m["_m"], "left")
    below = F.col("value") < F.col("threshold")
    issue = (F.when(F.col("value").isNull(), F.concat(F.lit("Missing metric: "), F.col("metric")))
             .when(below, F.concat(F.col("display"), F.lit(": "), fmt(F.col("value"), 4),
                                   F.lit(" below threshold "), fmt(F.col("threshold"), 4))))
    per = j.select("ordinal", below.alias("_below"), issue.alias("_issue"), F.lit(0).alias("_k"))
    present = metrics.select(F.lit(None).cast("int").alias("ordinal"), F.lit(None).cast("boolean").alias("_below"),
                             F.lit(None).cast("string").alias("_issue"), F.lit(1).alias("_k"))
    agg = per.unionByName(present).agg(
        F.sum("_k").alias("_n_metrics"),
        F.coalesce(F.bool_or("_below"), F.lit(False)).alias("_any_below"),
        ordered_texts(F.col("ordinal"), F.col("_issue")).alias("_issues"))
    none = F.col("_n_metrics") == 0
    return gate_frame(agg.select(
        F.lit("performance").alias("check"),
        (~none & ~F.col("_any_below")).alias("passed"),
        F.when(none, F.array(F.lit("No metrics file found for validation"))).otherwise(F.col("_issues"))
        .alias("issues"),
        F.create_map(F.lit("metrics"), F.col("_n_metrics").cast("string")).alias("stats")))


# --- Q3 -------------------------------------------------------------------------

def data_quality_gate(df: DataFrame | None, label: str = spec.TARGET, min_rows: int = spec.MIN_TEST_ROWS,
                      max_missing_pct: float = spec.MAX_OVERALL_MISSING_PCT,
                      min_share: float = spec.MIN_CLASS_SHARE, name: str = "test data",
                      spark: SparkSession | None = None) -> DataFrame:
    """Q3: rows < 1000 -> fail; overall missing > 10 % -> fail; smallest class
    share < 0.1 -> issue only; dataset missing -> fail."""
    if df is None:
        return spark.createDataFrame(
            [("data_quality", False, [f"Test data file not found: {name}"], {})], GATE_SCHEMA)
    cols = df.columns
    cells = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
    n = F.col("_n")
    # one read: copies fold to (row, count), on which every figure rests
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    value = F.col(label) if label in cols else F.lit(None).cast("string")
    by_class = per.groupBy(value.alias("_value")).agg(
        F.sum(n).cast("double").alias("_n"), F.sum(n * cells).cast("double").alias("_missing"),
        F.sum(n - 1).cast("double").alias("_dups"))
    in_class = F.col("_value").isNotNull()
    text = F.col("_value").cast("string")
    agg = by_class.agg(
        F.coalesce(F.sum("_n"), F.lit(0.0)).alias("rows"), F.coalesce(F.sum("_missing"), F.lit(0.0)).alias("missing"),
        F.coalesce(F.sum("_dups"), F.lit(0.0)).alias("dups"),
        F.sum(F.when(in_class, n)).alias("labelled"), F.min(F.when(in_class, n)).alias("min_class"),
        F.count(F.when(in_class, n)).alias("n_classes"),
        F.array_sort(F.collect_list(F.when(in_class, F.struct((-n).alias("o"), text.alias("t"), n.alias("n")))))
        .alias("dist"))
    rows, missing = F.col("rows"), F.col("missing")
    pct = F.try_divide(missing, rows * F.lit(float(len(cols)))) * F.lit(100.0)
    share_min = F.col("min_class") / F.col("labelled")
    dist_text = F.concat(F.lit("{"), F.concat_ws(", ", F.transform(
        F.col("dist"), lambda s: F.concat(s["t"], F.lit(": "), (s["n"] / F.col("labelled")).cast("string")))),
        F.lit("}"))
    fail_rows = rows < F.lit(float(min_rows))
    fail_missing = F.coalesce(pct > F.lit(float(max_missing_pct)), F.lit(False))
    issues = F.filter(F.array(
        F.when(fail_rows, F.concat(F.lit("Insufficient test samples: "), rows.cast("long").cast("string"),
                                   F.lit(f" < {min_rows}"))),
        F.when(fail_missing, F.concat(F.lit("Excessive missing values: "), fmt(pct, 1), F.lit("%"))),
        F.when(share_min < F.lit(float(min_share)),
               F.concat(F.lit("Imbalanced target distribution: "), dist_text)),
    ), lambda x: x.isNotNull())
    return gate_frame(agg.select(
        F.lit("data_quality").alias("check"), (~fail_rows & ~fail_missing).alias("passed"),
        issues.alias("issues"),
        F.create_map(F.lit("total_samples"), rows.cast("long").cast("string"),
                     F.lit("total_features"), F.lit(str(len(cols))),
                     F.lit("missing_values"), missing.cast("long").cast("string"),
                     F.lit("duplicate_rows"), F.col("dups").cast("long").cast("string"),
                     F.lit("classes"), F.col("n_classes").cast("string")).alias("stats")))


# --- Q4 -------------------------------------------------------------------------

def profile_gate(stored: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """Q4: the latest stored Q1 result (``check, passed, issues, created_at``):
    absent -> issue only; stored ``passed=false`` -> fail with its issues."""
    if stored is None:
        return spark.createDataFrame(
            [("feature_store", True, ["Feature validation results not found"], {})], GATE_SCHEMA)
    latest = stored.agg(F.max_by(F.struct("passed", "issues"), "created_at").alias("s"),
                        F.count(F.lit(1)).alias("n"))
    return gate_frame(latest.select(
        F.lit("feature_store").alias("check"),
        F.coalesce(F.col("s.passed"), F.lit(True)).alias("passed"),
        F.when(F.col("n") == 0, F.array(F.lit("Feature validation results not found")))
        .when(F.col("s.passed"), F.array().cast("array<string>")).otherwise(F.col("s.issues")).alias("issues"),
        F.create_map(F.lit("profiles"), F.col("n").cast("string")).alias("stats")))


# --- S7 / Q5 ----------------------------------------------------------------------

def dataset_check(catalog: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Per required / optional dataset name -> found (``catalog`` is
    ``(name, rows)``; a dataset is found when it exists with rows > 0)."""
    spark = catalog.sparkSession
    wanted = spark.createDataFrame([(n, True, i) for i, n in enumerate(required)] +
                                   [(n, False, len(required) + i) for i, n in enumerate(optional)],
                                   "name string, required boolean, ordinal int")
    have = catalog.groupBy(F.col("name").alias("_n")).agg(F.sum("rows").alias("rows"))
    j = wanted.join(have, wanted["name"] == have["_n"], "left")
    return j.select("name", "required", "ordinal", F.coalesce(F.col("rows") > 0, F.lit(False)).alias("found"),
                    F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows"))


def dataset_gate(catalog: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Q5: missing required datasets fail; optional ones are reported only."""
    d = dataset_check(catalog, required, optional)
    miss = F.col("required") & ~F.col("found")
    return gate_frame(d.agg(
        F.lit("artifacts").alias("check"),
        (~F.coalesce(F.bool_or(miss), F.lit(False))).alias("passed"),
        ordered_texts(F.col("ordinal"), F.when(miss, F.concat(F.lit("Missing required artifact: "),
                                                               F.col("name")))).alias("issues"),
        F.create_map(F.lit("found"), F.concat_ws(",", ordered_texts(F.col("ordinal"),
                                                                    F.when(F.col("found"), F.col("name"))))
                     ).alias("stats")))


# --- Q6 -------------------------------------------------------------------------

def run_gates(spark: SparkSession, builders: Sequence[tuple[str, Callable[[], DataFrame]]]) -> DataFrame:
    """Q6: build and run each gate; a gate that raises becomes a failed row
    carrying the error text. Returns one row per check, in order."""
    frames = []
    for i, (name, build) in enumerate(builders):
        try:
            g = materialize(build())  # one row; run here, so that its errors are its result too
        except Exception as e:  # noqa: BLE001 - the error is the gate's result
            g = spark.createDataFrame([(name, False, [f"{type(e).__name__}: {e}"], {})], GATE_SCHEMA)
        frames.append(g.withColumn("ordinal", F.lit(i)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def rollup(gates: DataFrame) -> DataFrame:
    """Q6: one report row per check plus ``overall`` = AND of all checks.

    The per-check rows and the overall row both read the gate table; it is
    one row per check, so it is cut from its lineage once (reliable
    checkpoint) and every gate plan runs a single time."""
    gates = materialize(gates)
    overall = gates.agg(
        F.lit("overall").alias("check"), F.bool_and("passed").alias("passed"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "issues"))),
                              lambda s: s["issues"])).alias("issues"),
        F.create_map(F.lit("checks"), F.count(F.lit(1)).cast("string")).alias("stats"),
        F.lit(10 ** 6).alias("ordinal"))
    return gates.select("check", "passed", "issues", "stats", "ordinal").unionByName(overall)
