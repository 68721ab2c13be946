"""CSV files bound by the names in their own headers, malformed rows kept.

Files of one folder may have their columns in any order, lack some, or have
more; each file's first line says which. A line that can't be a row - other
number of values than the header, broken quotes, a text where a number or a
time belongs, a file whose header names no column - is a row of
``malformed`` with its file, line and reason; every other line that isn't blank is a
row of ``rows``. Rows and malformed lines together are the lines.

How: the files are read as lines. A first pass keeps a row per file split
(its number of lines, the first line of its file); that small table gives
each file's header and each split's first line number; it is written once and
comes back to the lines by broadcast (above FEW_SPLITS splits by a shuffle, in
which a large file is as many keys as it has splits). Values are then found by
name. One row is one line: quoted line breaks aren't rows of this format.

A file without a key column gets keys from the content of its rows and, for
equal rows, their occurrence: the same rows get the same keys in whatever files
and order they come. Occurrences are counted per split, with one running sum
per repeated content over splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import materialize

MAX_HEADERS = 1000
# so many splits' numbers are broadcast to their lines
FEW_SPLITS = 100_000
_BAD = "_bad"


class CsvScan(NamedTuple):
    rows: DataFrame
    malformed: DataFrame    # file, line (the header is 1), record, reason


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    try:
        text = spark.read.text(path if isinstance(path, str) else list(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"Data file not found: {path}") from e
        raise
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("id"))


def _header(spark: SparkSession, line: str, sep: str) -> list[str]:
    """Names of a header line, as Spark's own reader splits it."""
    n = line.count(sep) + 1
    kind = ", ".join(f"c{i} string" for i in range(n))
    values = spark.range(1).select(F.from_csv(F.lit(line.lstrip("﻿")), kind, {"sep": sep}).alias("h")).first()["h"]
    names = [(v or "").strip() for v in values]
    while names and not names[-1] and len(names) > 1:   # a separator inside quotes
        names.pop()
    return names


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return value
    return F.btrim(value).try_cast(kind)


def _by_name(names: list[str], wanted: list[str]):
    """The wanted columns of a line's values."""
    def pick(r: Column) -> Column:
        own = [(r[f"c{names.index(c)}"] if c in names else F.lit(None).cast("string")).alias(c) for c in wanted]
        return F.struct(*own, r[_BAD].alias(_BAD))
    return pick


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, key: str | None = None,
             sep: str = ",") -> CsvScan:
    """Rows of ``schema`` (columns that a file lacks are NULL, others it has are
    left out) and the malformed lines. ``key``: a long column that is filled from
    content and occurrence where a file has none."""
    lines = _lines(spark, path)
    splits = lines.groupBy("file", "block").agg(F.min("id").alias("first_id"), F.count("*").alias("n"),
                                                F.min_by("value", "id").alias("first"))
    in_file = Window.partitionBy("file").orderBy("block")   # splits of a file
    splits = splits.select("file", "block", "first_id", F.first("first").over(in_file).alias("header"),
                           (F.sum("n").over(in_file) - F.col("n")).alias("lines_before"))
    splits = materialize(splits)
    texts = [r["header"] for r in splits.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(texts) > MAX_HEADERS:
        raise ValueError(f"{path}: more than {MAX_HEADERS} different headers")
    headers = {t: _header(spark, t, sep) for t in texts}
    for names in headers.values():
        twice = sorted({n for n in names if n and names.count(n) > 1})
        if twice:
            raise ValueError(f"{path}: header names {twice} more than once")

    few = splits.count() <= FEW_SPLITS
    at = lines.join(F.broadcast(splits) if few else splits, ["file", "block"]).select(
        "file", "block", "value", "header", (F.col("lines_before") + F.col("id") - F.col("first_id") + 1).alias("line"))
    at = at.where((F.col("line") > 1) & (F.btrim("value") != ""))

    # per header: the values of the schema's columns, as texts, and whether the line splits as its header does
    wanted = schema.fieldNames()
    text_type = T.StructType([T.StructField(c, T.StringType()) for c in [*wanted, _BAD]])
    parsed = F.lit(None).cast(text_type)
    for text, names in headers.items():
        kind = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField(_BAD, T.StringType())])
        cut = F.from_csv(F.col("value"), kind.simpleString()[7:-1].replace(":", " "),
                         {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
        values = F.transform(F.array(cut), _by_name(names, wanted))   # parsed once, whatever the number of columns
        parsed = F.when(F.col("header") == text, F.get(values, F.lit(0))).otherwise(parsed)
    # exploded: a filter on the values stays above them, so that a line is cut once
    at = at.select("file", "block", "line", "value", "header", F.explode(F.array(parsed)).alias("p"))

    wrong = F.array_compact(F.array(*[
        F.when((F.btrim(F.col(f"p.{f.name}")) != "") & _typed(F.col(f"p.{f.name}"), f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields]))
    nameless = [t for t, names in headers.items() if not set(names) & set(wanted)]
    reason = (F.when(F.col("header").isin(nameless) if nameless else F.lit(False), F.lit("header names no column"))
              .when(F.col(f"p.{_BAD}").isNotNull(), F.lit("other number of values than the header"))
              .when(F.size(wrong) > 0, F.concat(F.lit("values of another type in "), F.concat_ws(", ", wrong))))
    judged = at.withColumn("reason", reason)
    malformed = judged.where("reason is not null").select("file", "line", F.col("value").alias("record"), "reason")
    good = judged.where("reason is null")
    values = {f.name: F.when(F.btrim(F.col(f"p.{f.name}")) != "", _typed(F.col(f"p.{f.name}"), f.dataType)).cast(f.dataType)
              for f in schema.fields}
    keyless = [t for t, names in headers.items() if key is not None and key not in names]
    if not keyless:
        return CsvScan(good.select(*[v.alias(c) for c, v in values.items()]), malformed)

    content = F.xxhash64(*[values[c] for c in wanted if c != key])
    good = good.select("file", "block", "line", F.col("header").isin(keyless).alias("keyless"), content.alias("content"),
                       *[v.alias(f"v_{c}") for c, v in values.items()])
    # equal rows of a split are numbered in it; the splits before it add what they hold
    held = good.where("keyless").groupBy("content", "file", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("content").orderBy("file", "block")) - F.col("n")
    held = held.select("content", "file", "block", before.alias("before"))
    here = F.row_number().over(Window.partitionBy("content", "file", "block").orderBy("line"))
    numbered = good.withColumn("here", here).join(held, ["content", "file", "block"], "left")
    made = F.when(F.col("keyless"), F.xxhash64("content", F.col("before") + F.col("here"))).otherwise(F.col(f"v_{key}"))
    return CsvScan(numbered.select(*[(made if c == key else F.col(f"v_{c}")).alias(c) for c in wanted]), malformed)
