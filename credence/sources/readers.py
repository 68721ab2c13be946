"""Scans and sinks (S1-S3, S6, S10): CSV / Parquet / JSON with explicit
schemas, ordered candidate paths, processed-set and split write-outs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import spec
from ..functions.features import normalize_raw
from ..operators.metrics import split_summary
from ..operators.split import stratified_split
from .csv_scan import scan_csv

RAW_SCHEMA = T.StructType(
    [T.StructField(spec.KEY, T.LongType()), T.StructField(spec.TS, T.TimestampType())] +
    [T.StructField(c, T.DoubleType()) for c in spec.RAW_NUMERIC] +
    [T.StructField(c, T.StringType()) for c in spec.RAW_CATEGORICAL] +
    [T.StructField(spec.TARGET, T.IntegerType())])


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
         header: bool = True) -> DataFrame:
    """One reader for the three formats; a missing path is an error."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    try:
        if fmt == "csv":
            return r.option("header", header).option("mode", "PERMISSIVE").csv(path)
        if fmt == "json":
            return r.json(path)
        if fmt == "parquet":
            return r.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"Data file not found: {path}") from e
        raise
    raise ValueError(f"unknown format {fmt}")


def load_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = RAW_SCHEMA, quarantine: str | None = None) -> DataFrame:
    """CSV files bound by their headers' names (``csv_scan``), then P1 (CSV
    text ``NaN`` in a double column reads as NaN, not NULL). Malformed lines
    aren't rows; they are appended to the ``quarantine`` folder if one is named,
    and ``scan_csv`` returns them."""
    scan = scan_csv(spark, path, schema, spec.KEY if spec.KEY in schema.fieldNames() else None)
    if quarantine is not None:
        scan.malformed.write.mode("append").parquet(quarantine)
    return normalize_raw(scan.rows)


def write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
          mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def first_existing(spark: SparkSession, candidates: Sequence[str], fmt: str = "parquet",
                   schema: T.StructType | None = None) -> tuple[str | None, DataFrame | None]:
    """S2 helper: the first readable path of an ordered candidate list."""
    for p in candidates:
        try:
            return p, read(spark, p, fmt, schema)
        except FileNotFoundError:
            continue
    return None, None


TRAIN_NAMES = ["train_processed", "processed_data/train_processed", "train", "data/train"]
VAL_NAMES = ["val_processed", "processed_data/val_processed", "val", "data/val"]


def load_train_val(spark: SparkSession, root: str, fmt: str = "parquet", test_size: float = spec.TEST_SIZE,
                   seed: int = spec.SEED) -> tuple[DataFrame, DataFrame, dict]:
    """Training set required (first of 4 names), validation optional;
    without one, the validation half is derived from the training set by F6."""
    root = root.rstrip("/")
    tp, train = first_existing(spark, [f"{root}/{n}" for n in TRAIN_NAMES], fmt)
    if train is None:
        raise FileNotFoundError(f"Training data not found. Tried: {[f'{root}/{n}' for n in TRAIN_NAMES]}")
    vp, val = first_existing(spark, [f"{root}/{n}" for n in VAL_NAMES], fmt)
    if val is None:
        s = stratified_split(train, spec.TARGET, spec.KEY, test_size, seed)
        train = s.where(F.col("split") == "train").drop("split")
        val = s.where(F.col("split") == "test").drop("split")
    return train, val, {"train_path": tp, "val_path": vp}


def training_sets(spark: SparkSession, root: str, raw_path: str | Sequence[str] | None = None, raw_fmt: str = "csv",
                  test_size: float = spec.TEST_SIZE, seed: int = spec.SEED) -> tuple[DataFrame, DataFrame, dict]:
    """S2 with its fallback: processed sets under ``root`` are reused when
    present; otherwise the raw data is preprocessed (F5), split (F6) and
    written as processed sets (S3) first, then read back. Malformed lines of raw
    CSV files go to ``quarantine`` under ``root``."""
    try:
        return load_train_val(spark, root, "parquet", test_size, seed)
    except FileNotFoundError:
        if raw_path is None:
            raise
    from ..plans.preprocess import preprocess

    quarantine = f"{root.rstrip('/')}/quarantine"
    raw = load_csv(spark, raw_path, quarantine=quarantine) if raw_fmt == "csv" else read(spark, raw_path, raw_fmt)
    processed, _ = preprocess(raw)
    s = stratified_split(processed, spec.TARGET, spec.KEY, test_size, seed)
    out = f"{root.rstrip('/')}/processed_data"
    write(s.where(F.col("split") == "train").drop("split"), f"{out}/train_processed")
    write(s.where(F.col("split") == "test").drop("split"), f"{out}/val_processed")
    return load_train_val(spark, root, "parquet", test_size, seed)


def process_test_set(raw: DataFrame, params_path: str, out: str, fmt: str = "parquet",
                     impute_with: str = "batch") -> None:
    """S3 for a test set: F5 with the saved scaler and dictionaries (medians of
    the set itself, or the stored ones), written with the label last."""
    from ..plans.preprocess import preprocess
    from .params import load_params

    processed, _ = preprocess(raw, params=load_params(raw.sparkSession, params_path), impute_with=impute_with)
    write(label_last(processed), out, fmt)


def label_last(df: DataFrame, label: str = spec.TARGET) -> DataFrame:
    return df.select(*[c for c in df.columns if c != label], label) if label in df.columns else df


def write_processed(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """S3: processed sets with the label last, partitioned by split."""
    write(label_last(df.select(*[c for c in df.columns if c != split_col], split_col)), path, fmt,
          partition_by=[split_col])


def write_splits(df: DataFrame, root: str, fmt: str = "parquet", test_size: float = spec.TEST_SIZE,
                 seed: int = spec.SEED) -> DataFrame:
    """Full, train and test write-outs of a raw table plus a summary
    (rows and label rate per split, and for the whole table)."""
    root = root.rstrip("/")
    write(df, f"{root}/full", fmt)
    full = df.sparkSession.read.parquet(f"{root}/full") if fmt == "parquet" else df
    s = stratified_split(full, spec.TARGET, spec.KEY, test_size, seed)
    write(s, f"{root}/splits", fmt, partition_by=["split"])
    back = df.sparkSession.read.parquet(f"{root}/splits") if fmt == "parquet" else s
    whole = back.withColumn("split", F.lit("full"))
    return split_summary(back.unionByName(whole), spec.TARGET)


def write_documents(docs: DataFrame, path: str) -> None:
    """Metadata documents (one JSON object per row)."""
    docs.write.mode("append").json(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Metadata documents read back with their schema."""
    return read(spark, path, "json", schema)
