"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credence.session import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Strings of a string column; null is empty."""
    return ["" if v is None else v for v in column.to_pylist()]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet under the shared folder named by
    ``spark.checkpoint.dir`` and reads it back: lineage is cut, and a lost
    executor costs nothing that was written."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_kept(name: str, key, make):
    """``make()``, kept for later tasks of the same Python worker: one value per
    name, made anew when the key differs. For caches only; results never depend
    on it."""
    kept = sys.modules.setdefault("_credence_llm_kept", types.ModuleType("_credence_llm_kept")).__dict__
    if name not in kept or kept[name][0] != key:
        kept[name] = (key, make())
    return kept[name][1]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
