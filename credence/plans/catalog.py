"""Catalog tables: feature sets, feature views, runs, model versions and
published datasets (C1-C12, T2, S6, S9).

Each table is an append-only table of commits (``commit_log``) under one
catalog root, a durable folder that all writers share. Versions are
allocated by optimistic commits: of writers that come at one time each gets
its own. Updates are new rows; readers pick the latest row per key with
``max_by`` aggregations over the commit number (partial aggregation, no
per-key window), and archived entries are removed with a ``left_anti`` join
against tombstones.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..functions.maps import merge_tags
from ..operators.profile import schema_summary
from ..operators.select import select_features, time_range
from ..operators.sketch import merged, profile_of, sketch
from ..session import materialize
from .commit_log import COMMIT, CommitLog

FEATURE_TYPE = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
                             T.StructField("description", T.StringType()),
                             T.StructField("nullable", T.BooleanType())])
SCHEMAS = {
    "feature_sets": T.StructType([
        T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
        T.StructField("description", T.StringType()), T.StructField("features", T.ArrayType(FEATURE_TYPE)),
        T.StructField("total_features", T.LongType()), T.StructField("sample_count", T.LongType()),
        T.StructField("created_at", T.TimestampType()), T.StructField("status", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("data_path", T.StringType()), T.StructField("manifest_path", T.StringType())]),
    "feature_set_archive": T.StructType([
        T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
        T.StructField("archived_at", T.TimestampType())]),
    "feature_views": T.StructType([
        T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
        T.StructField("feature_set_name", T.StringType()), T.StructField("feature_set_version", T.LongType()),
        T.StructField("features", T.ArrayType(T.StringType())), T.StructField("description", T.StringType()),
        T.StructField("created_at", T.TimestampType())]),
    "runs": T.StructType([
        T.StructField("run_id", T.StringType()), T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
        T.StructField("logged_at", T.TimestampType())]),
    "model_versions": T.StructType([
        T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
        T.StructField("id", T.StringType()), T.StructField("training_job", T.StringType()),
        T.StructField("registration_time", T.TimestampType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("description", T.StringType()), T.StructField("path", T.StringType()),
        T.StructField("updated_at", T.TimestampType())]),
    "feature_validations": T.StructType([
        T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
        T.StructField("check", T.StringType()), T.StructField("passed", T.BooleanType()),
        T.StructField("issues", T.ArrayType(T.StringType())),
        T.StructField("stats", T.MapType(T.StringType(), T.StringType())),
        T.StructField("created_at", T.TimestampType())]),
    "profile_sketches": T.StructType([
        T.StructField("name", T.StringType()), T.StructField("part", T.StringType()),
        T.StructField("column", T.StringType()), T.StructField("kind", T.StringType()),
        T.StructField("slot", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType())]),
    "datasets": T.StructType([
        T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()), T.StructField("rows", T.LongType()),
        T.StructField("created_at", T.TimestampType())]),
}


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Catalog:
    """Append-only catalog tables under ``root``, a durable folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- generic ----------------------------------------------------------------
    def log(self, table: str) -> CommitLog:
        state = (lambda rows: current_versions(rows, COMMIT)) if table == "model_versions" else None
        return CommitLog(self.spark, f"{self.root}/{table}", SCHEMAS[table], state)

    def read(self, table: str) -> DataFrame:
        return self.log(table).read().drop(COMMIT)

    def append(self, table: str, df: DataFrame) -> None:
        self.log(table).append(df)

    def _add_version(self, table: str, name: str, row: DataFrame, **derived: Callable[[int], Column]) -> int:
        """Appends a one-row frame as the name's next version (max + 1), with
        columns that derive from the version; returns the version."""
        made = row.first()   # built once, whatever the number of tries
        fixed = self.spark.createDataFrame([made], row.schema)
        got: list[int] = []

        def build(rows: DataFrame) -> DataFrame:
            top = rows.where(F.col("name") == name).agg(F.max("version")).first()[0]
            got.append(int(top or 0) + 1)
            return fixed.withColumns({"name": F.lit(name), "version": F.lit(got[-1])} | {
                c: f(got[-1]) for c, f in derived.items()})
        self.log(table).transact(build)
        return got[-1]

    # --- feature sets (C1-C5) ------------------------------------------------------
    def create_feature_set(self, name: str, data: DataFrame | None = None, description: str = "",
                           tags: Mapping[str, str] | None = None, data_path: str | None = None) -> DataFrame:
        """A14 schema summary + name, version (max+1), tags and status
        ``created_with_schema``; ``created_metadata_only`` without data. Data at a
        path gets a manifest, with which C4 opens only the files it needs."""
        manifest = write_manifest(self.spark, data_path, f"{self.root}/manifests/{uuid.uuid4().hex}") if data_path else None
        now = _now()
        tag_map = F.create_map(*[x for k, v in (tags or {}).items() for x in (F.lit(k), F.lit(v))]) \
            if tags else F.create_map().cast("map<string,string>")
        if data is None:
            row = self.spark.range(1).select(
                F.lit(description).alias("description"), F.lit(None).cast(T.ArrayType(FEATURE_TYPE)).alias("features"),
                F.lit(None).cast("long").alias("total_features"), F.lit(None).cast("long").alias("sample_count"),
                F.lit(now).alias("created_at"), F.lit("created_metadata_only").alias("status"),
                tag_map.alias("tags"), F.lit(data_path).cast("string").alias("data_path"),
                F.lit(manifest).cast("string").alias("manifest_path"))
        else:
            summ = schema_summary(data)
            row = summ.agg(
                F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "name", "type", "description",
                                                                 "nullable"))),
                            lambda s: F.struct(s["name"].alias("name"), s["type"].alias("type"),
                                               s["description"].alias("description"),
                                               s["nullable"].alias("nullable"))).alias("features"),
                F.count(F.lit(1)).alias("total_features"), F.max("sample_count").alias("sample_count")
            ).select(F.lit(description).alias("description"), "features", "total_features", "sample_count",
                     F.lit(now).alias("created_at"), F.lit("created_with_schema").alias("status"),
                     tag_map.alias("tags"), F.lit(data_path).cast("string").alias("data_path"),
                F.lit(manifest).cast("string").alias("manifest_path"))
        version = self._add_version("feature_sets", name, row)
        return self.read("feature_sets").where((F.col("name") == name) & (F.col("version") == version))

    def archive_feature_set(self, name: str, version: int) -> None:
        """Tombstone row; readers drop archived versions."""
        self.append("feature_set_archive", self.spark.range(1).select(
            F.lit(name).alias("name"), F.lit(int(version)).cast("long").alias("version"),
            F.lit(_now()).alias("archived_at")))

    def feature_sets(self) -> DataFrame:
        live = self.read("feature_sets").join(self.read("feature_set_archive"), ["name", "version"], "left_anti")
        return live

    def list_feature_sets(self) -> DataFrame:
        """Name, version, status (default 'Unknown')."""
        return self.feature_sets().select("name", "version",
                                          F.coalesce(F.col("status"), F.lit("Unknown")).alias("status"))

    def get_feature_data(self, name: str, version: int | None = 1, features: Sequence[str] | None = None,
                         start=None, end=None) -> DataFrame:
        """C4: data of a feature-set version (default 1), error if absent;
        then P10 feature selection and P15 time range."""
        rows = self.feature_sets().where((F.col("name") == name) & (F.col("version") == int(version or 1))) \
            .select("data_path", "manifest_path").collect()   # one catalog row
        if not rows or not rows[0]["data_path"]:
            raise FileNotFoundError(f"Feature data not found: {name}:{version or 1}")
        path, manifest = rows[0]
        df = self.spark.read.parquet(path)
        if spec.TS in df.columns and (start is not None or end is not None):
            df = time_range(files_within(df, path, manifest, start, end) if manifest else df, start, end)
        return select_features(df, features)

    def write_feature_set(self, name: str, df: DataFrame, description: str = "", tags: Mapping[str, str] | None = None,
                          files: int | None = None) -> DataFrame:
        """C1 of data that is written here: in ranges of its timestamp, so that a
        file holds a short time (rows without one stand together)."""
        path = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        if spec.TS in df.columns:
            key = [F.col(spec.TS), F.xxhash64(*df.columns)]   # one time on very many rows is several files
            df = (df.repartitionByRange(files, *key) if files else df.repartitionByRange(*key)).sortWithinPartitions(spec.TS)
        df.write.parquet(path)
        return self.create_feature_set(name, self.spark.read.parquet(path), description, tags, data_path=path)

    def create_feature_view(self, name: str, features: Sequence[str], set_name: str, set_version: int = 1,
                            description: str = "", view: str | None = None) -> DataFrame:
        """Named feature subset bound to a set version; also registered as
        a temporary SQL view of the selected data."""
        self._add_version("feature_views", name, self.spark.range(1).select(
            F.lit(set_name).alias("feature_set_name"),
            F.lit(int(set_version)).alias("feature_set_version"),
            F.array(*[F.lit(f) for f in features]).alias("features"), F.lit(description).alias("description"),
            F.lit(_now()).alias("created_at")))
        data = self.get_feature_data(set_name, set_version, features)
        data.createOrReplaceTempView(view or name.replace("-", "_"))
        return data

    # --- validation results (Q1, read by Q4) -------------------------------------------
    def log_validation(self, name: str, version: int, gate: DataFrame) -> None:
        """Stores the result of Q1 with the feature-set version it is about."""
        self.append("feature_validations", gate.select(
            F.lit(name).alias("name"), F.lit(int(version)).cast("long").alias("version"), "check", "passed", "issues", "stats",
            F.lit(_now()).alias("created_at")))

    def validations(self, name: str, version: int) -> DataFrame:
        """The stored results of a feature-set version, for Q4."""
        return self.read("feature_validations").where((F.col("name") == name) & (F.col("version") == int(version)))

    # --- profiles from sketches (A2-A4) --------------------------------------------------
    def add_profile_part(self, name: str, part: str, df: DataFrame, columns: Sequence[str] | None = None) -> None:
        """Sketches a new part of a data set, once: a part that is there already, or
        that another writer adds meanwhile, is an error."""
        made = materialize(sketch(df, columns).select(F.lit(name).alias("name"), F.lit(part).alias("part"),
                                                      "column", "kind", "slot", "n", "x"))

        def build(rows: DataFrame) -> DataFrame:
            if not rows.where((F.col("name") == name) & (F.col("part") == part)).isEmpty():
                raise ValueError(f"{name}: part '{part}' has been added before")
            return made
        self.log("profile_sketches").transact(build)

    def profile_sketch(self, name: str) -> DataFrame:
        """The sketch of all parts of a data set."""
        return merged(self.read("profile_sketches").where(F.col("name") == name))

    def profile(self, name: str) -> DataFrame:
        """The profile of all parts, from their sketches alone."""
        return profile_of(self.profile_sketch(name))

    # --- runs (C6) ------------------------------------------------------------------
    def log_run(self, run_id: str, params: Mapping[str, object] | None = None,
                metrics: DataFrame | None = None) -> None:
        """Params (driver-side dict) and metrics (a ``(metric, value)``
        DataFrame, appended without collecting) as ``runs`` rows."""
        now = _now()
        if params:
            self.append("runs", self.spark.createDataFrame(
                [(run_id, "param", k, str(v), now) for k, v in params.items()], SCHEMAS["runs"]))
        if metrics is not None:
            self.append("runs", metrics.select(F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"),
                                               F.col("metric").alias("key"), F.col("value").cast("string"),
                                               F.lit(now).alias("logged_at")))

    def run_metrics(self, run_id: str) -> DataFrame:
        return self.read("runs").where((F.col("run_id") == run_id) & (F.col("kind") == "metric")) \
            .select(F.col("key").alias("metric"), F.col("value").cast("double").alias("value"))

    # --- model versions (C7-C12, T2) ------------------------------------------------------
    def register_model(self, name: str, path: str, metrics: DataFrame | None = None,
                       tags: Mapping[str, str] | None = None, properties: Mapping[str, str] | None = None,
                       description: str = "", training_job: str = "local_training",
                       job_status: str | None = None) -> DataFrame:
        """version = max+1; tags gain ``metric_<name>`` for numeric
        metrics; from a job only when its status is Completed."""
        if job_status is not None and job_status != "Completed":
            raise ValueError(f"Job {training_job} has not completed successfully. Status: {job_status}")
        base = F.create_map(*[x for k, v in (tags or {}).items() for x in (F.lit(k), F.lit(str(v)))]) \
            if tags else F.create_map().cast("map<string,string>")
        props = F.create_map(*[x for k, v in (properties or {}).items() for x in (F.lit(k), F.lit(str(v)))]) \
            if properties else F.create_map().cast("map<string,string>")
        if metrics is not None:
            mt = metrics.where(F.col("value").isNotNull()).agg(F.map_from_entries(F.collect_list(F.struct(
                F.concat(F.lit("metric_"), F.col("metric")).alias("key"),
                F.col("value").cast("string").alias("value")))).alias("m"))
            tag_col = merge_tags(base, F.coalesce(F.col("m"), F.create_map().cast("map<string,string>")))
            src = mt
        else:
            tag_col, src = base, self.spark.range(1)
        now = _now()
        row = src.select(F.lit(training_job).alias("training_job"),
                         F.lit(now).alias("registration_time"), tag_col.alias("tags"), props.alias("properties"),
                         F.lit(description).alias("description"), F.lit(path).alias("path"),
                         F.lit(now).alias("updated_at"))
        version = self._add_version("model_versions", name, row, id=lambda v: F.lit(f"{name}:{v}"))
        return self.model_versions().where((F.col("name") == name) & (F.col("version") == version))

    def model_versions(self) -> DataFrame:
        """Current state: the latest row per (name, version)."""
        return current_versions(self.log("model_versions").read(), COMMIT).drop(COMMIT)

    def add_model_tags(self, name: str, version: int, tags: Mapping[str, str]) -> DataFrame:
        """Merge tags onto a version, the new value winning. Merges that
        come at one time all hold."""
        new = F.create_map(*[x for k, v in tags.items() for x in (F.lit(k), F.lit(str(v)))])
        mine = (F.col("name") == name) & (F.col("version") == int(version))

        def build(rows: DataFrame) -> DataFrame:
            cur = current_versions(rows.where(mine), COMMIT).drop(COMMIT)
            if cur.isEmpty():
                raise KeyError(f"model {name}:{version} not found")
            return cur.withColumn("tags", merge_tags(F.col("tags"), new)).withColumn("updated_at", F.lit(_now()))
        self.log("model_versions").transact(build)
        return self.model_versions().where(mine)


def current_versions(rows: DataFrame, by: str = "updated_at") -> DataFrame:
    """Latest row per (name, version)."""
    cols = [c for c in rows.columns if c not in ("name", "version")]
    agg = rows.groupBy("name", "version").agg(F.max_by(F.struct(*cols), by).alias("r"))
    return agg.select("name", "version", *[F.col(f"r.{c}").alias(c) for c in cols])


def latest_versions(models: DataFrame) -> DataFrame:
    """The latest version per name by numeric version (a ``max_by``
    aggregation, so a name with very many versions is partially
    aggregated, not gathered into one task)."""
    cols = [c for c in models.columns if c != "name"]
    agg = models.groupBy("name").agg(F.max_by(F.struct(*cols), F.col("version").cast("long")).alias("r"))
    return agg.select("name", *[F.col(f"r.{c}").alias(c) for c in cols])


def exact_version(models: DataFrame, name: str, version: int) -> DataFrame:
    """T2 with an explicit version; error listing the available ones (the
    latest ``LISTED`` and the number of all)."""
    mine = models.where(F.col("name") == name)
    hit = mine.where(F.col("version") == int(version))
    if hit.limit(1).count() == 0:
        versions = mine.select(F.col("version").cast("long").alias("v")).distinct()
        avail = sorted(r["v"] for r in versions.orderBy(F.col("v").desc()).limit(LISTED).collect())
        raise KeyError(f"Version '{version}' not found for '{name}'. Available: {avail} of {versions.count()}")
    return hit


def exact_versions(models: DataFrame, requests: DataFrame) -> DataFrame:
    """T2 for a table of ``(name, version)`` requests: ``found`` and the id of
    each."""
    m = models.select("name", "version", "id")
    return requests.join(m, ["name", "version"], "left").select(
        "name", "version", F.col("id").isNotNull().alias("found"), "id")


# versions that the text of an error lists
LISTED = 100


def tag_or_unknown(tags: Column | str, key: str) -> Column:
    t = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(F.try_element_at(t, F.lit(key)), F.lit("Unknown"))


def last_registered(models: DataFrame) -> DataFrame:
    """The most recently registered version (ties: higher version)."""
    return models.agg(F.max_by(F.struct(*models.columns),
                               F.struct("registration_time", "version")).alias("r")).select("r.*")


def list_models(models: DataFrame, name: str | None = None) -> DataFrame:
    """Every registered version with its registration time and its
    environment / type tags ('Unknown' when absent)."""
    m = models if name is None else models.where(F.col("name") == name)
    return m.select("name", "version", "registration_time", tag_or_unknown("tags", "environment").alias("environment"),
                    tag_or_unknown("tags", "model_type").alias("model_type"))


def model_counts(models: DataFrame, name: str | None = None) -> DataFrame:
    """Per name its number of versions (those of one name, if given), and in a
    row without a name the numbers of all names and versions."""
    m = models if name is None else models.where(F.col("name") == name)
    by_name = m.groupBy("name").agg(F.count("*").alias("versions"))
    rows = by_name.select("name", F.lit(1).cast("long").alias("models"), "versions")
    if name is not None:
        return rows
    return rows.unionByName(by_name.agg(F.lit(None).cast("string").alias("name"), F.count("*").alias("models"),
                                        F.coalesce(F.sum("versions"), F.lit(0)).cast("long").alias("versions")))


def select_model(models: DataFrame) -> DataFrame:
    """C11: per name, the latest version with its tags and stage tag."""
    return latest_versions(models).select("name", "version", "id", "tags",
                                          tag_or_unknown("tags", "stage").alias("stage"))


def resolve_versions(requests: DataFrame, models: DataFrame, selected: DataFrame | None = None,
                     registered: DataFrame | None = None) -> DataFrame:
    """C12 per request ``(name, version)``: the explicit version when given;
    else the selected record, whose own name wins when it has one
    (``selected``: name asked for, selected_name, version); else the record
    registered last under the name (``registered``: name, version); else the
    latest version; none -> NULL with an error text. Returns name (asked
    for), resolved_name, resolved_version, source, error."""
    latest = latest_versions(models).select("name", F.col("version").alias("_latest"))
    r = requests.join(latest, "name", "left")
    if selected is not None:
        own = F.col("selected_name") if "selected_name" in selected.columns else F.lit(None).cast("string")
        r = r.join(selected.select("name", own.alias("_own"), F.col("version").alias("_selected")), "name", "left")
    else:
        r = r.withColumns({"_own": F.lit(None).cast("string"), "_selected": F.lit(None).cast("long")})
    if registered is not None:
        r = r.join(registered.select("name", F.col("version").alias("_registered")), "name", "left")
    else:
        r = r.withColumn("_registered", F.lit(None).cast("long"))
    explicit, by_selection = F.col("version").isNotNull(), F.col("_selected").isNotNull()
    chosen = F.coalesce(F.col("version"), F.col("_selected"), F.col("_registered"), F.col("_latest"))
    source = (F.when(explicit, "explicit").when(by_selection, "selected")
              .when(F.col("_registered").isNotNull(), "registered").when(F.col("_latest").isNotNull(), "latest"))
    name = F.when(~explicit & by_selection & (F.col("_own") != ""), F.col("_own")).otherwise(F.col("name"))
    return r.select("name", F.when(chosen.isNotNull(), name).alias("resolved_name"),
                    chosen.alias("resolved_version"), source.alias("source"),
                    F.when(chosen.isNull(), F.concat(F.lit("No models found with name '"), F.col("name"),
                                                     F.lit("'"))).alias("error"))


def write_manifest(spark: SparkSession, data_path: str, manifest_path: str, ts: str = spec.TS) -> str | None:
    """Least and greatest timestamp, rows, and rows without one, of every file of a
    Parquet folder: one pass over one column. None if the data has no such column."""
    df = spark.read.parquet(data_path)
    if ts not in df.columns:
        return None
    (df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(ts).alias("least"), F.max(ts).alias("greatest"), F.count("*").alias("rows"), F.count_if(F.col(ts).isNull()).alias("without"))
     .write.parquet(manifest_path))
    return manifest_path


def _plain(file: str) -> str:
    """One spelling of a file's name."""
    return unquote(re.sub("^file:/+", "/", file))


def files_within(df: DataFrame, data_path: str, manifest_path: str, start=None, end=None) -> DataFrame:
    """The files of ``df`` that may hold rows of a time range. Files that the
    manifest doesn't know are read; rows without a timestamp are in no range."""
    spark = df.sparkSession
    known = spark.read.parquet(manifest_path)
    within = time_range(time_range(known, None, end, "least"), start, None, "greatest")   # least < end, start <= greatest
    wanted = {r["file"] for r in within.where("greatest is not null").select("file").collect()}   # file names
    skip = {_plain(r["file"]) for r in known.select("file").collect()} - set(map(_plain, wanted))
    files = [f for f in df.inputFiles() if _plain(f) not in skip]
    if not files:
        return df.where(F.lit(False))
    return spark.read.schema(df.schema).option("basePath", data_path).parquet(*files)


def publish_dataset(catalog: Catalog, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` to a folder of its own, then append the catalog row that
    names it as the next version; returns the version. Of writers that come at
    one time each gets a version; a writer that fails leaves none."""
    path = f"{catalog.root}/data/{name}/{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    rows = catalog.spark.read.parquet(path).count()
    return catalog._add_version("datasets", name, catalog.spark.range(1).select(
        F.lit(path).alias("path"), F.lit(rows).cast("long").alias("rows"), F.lit(_now()).alias("created_at")))


def read_dataset(catalog: Catalog, name: str, version: int | None = None) -> DataFrame:
    """S9 reader: the given version, else the latest."""
    ds = catalog.read("datasets").where(F.col("name") == name)
    pick = ds.where(F.col("version") == int(version)) if version else latest_versions(ds)
    row = pick.select("path").first()
    if row is None:
        raise FileNotFoundError(f"dataset {name} version {version or 'latest'} not found")
    return catalog.spark.read.parquet(row["path"])
