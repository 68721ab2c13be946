"""Label encoding with an explicit ``unknown`` class.

Fit: distinct strings per column, ordered by code point, numbered 0..k-1;
``unknown`` is appended as code k when it was not seen (when it was seen it
keeps its sorted place). The numbers are distributed ranks (``ranks``), so no
task holds all categories of a feature.

Apply: ``coalesce(code, code of unknown, 0)`` by a literal map for a dictionary
of at most ``FEW_ENTRIES`` rows, else by a left join per column. A
feature's dictionary whose measured bytes are within the session's
``spark.sql.autoBroadcastJoinThreshold`` is broadcast; a larger one is a
shuffle join; several larger ones share one look-up. ``StringIndexer`` is not used: with ``handleInvalid='keep'`` it
sends unseen values to a new index even when ``unknown`` is in the data
(SURVEY V6).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..session import materialize
from .cumulative import ranks, stack_columns

DICT_COLUMNS = ["feature", "category", "code"]

# bytes of a joined row beside its category text
ROW_BYTES = 32
# a dictionary of at most this many rows is looked up as a literal map
FEW_ENTRIES = 64


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: never)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b").strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text)
    return int(m[1]) * 1024 ** " kmgt".index(m[2] or " ") if m else -1


def fit_dictionaries(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Dictionary table ``(feature, category, code bigint)`` for ``cols``
    (values must already be strings, missing mapped to 'unknown')."""
    distinct = stack_columns(df, cols, "feature", "category", "string") \
        .where(F.col("category").isNotNull()).distinct()
    return dictionary_from_distinct(distinct)


def dictionary_from_distinct(distinct: DataFrame) -> DataFrame:
    """F3 from one row per distinct ``(feature, category)``."""
    seen = ranks(distinct.select("feature", "category"), "feature", "category", "code")
    # unknown appended where absent: code = number of distinct values
    extra = (seen.groupBy("feature")
             .agg(F.count(F.lit(1)).alias("k"),
                  F.max((F.col("category") == spec.UNKNOWN).cast("int")).alias("has_unknown"))
             .where(F.col("has_unknown") == 0)
             .select("feature", F.lit(spec.UNKNOWN).alias("category"), F.col("k").cast("long").alias("code")))
    return seen.unionByName(extra)


class Dictionary:
    """An applied view of a dictionary table: per-feature sizes and the code
    of ``unknown`` (a few numbers) are collected once; the table itself stays
    a DataFrame."""

    def __init__(self, table: DataFrame, cut_lineage: bool = True):
        table = table.select(*DICT_COLUMNS)
        if cut_lineage:
            # a fitted parameter: cut its lineage once (reliable checkpoint in
            # the shared spark.checkpoint.dir) so every lookup reads it directly
            table = materialize(table)
        self.table = table
        stats = self.table.groupBy("feature").agg(
            F.sum(F.octet_length("category") + ROW_BYTES).alias("bytes"),
            F.max(F.when(F.col("category") == spec.UNKNOWN, F.col("code"))).alias("unknown_code"),
            F.count(F.lit(1)).alias("rows"), F.count_distinct("category").alias("categories"),
        ).collect()
        self.bytes = {r["feature"]: int(r["bytes"]) for r in stats}
        self.unknown = {r["feature"]: r["unknown_code"] for r in stats}
        # a repeated or NULL category is left to the join
        few = [r["feature"] for r in stats if r["rows"] == r["categories"] <= FEW_ENTRIES]
        self.few: dict[str, dict[str, int]] = {c: {} for c in few}
        for r in self.table.where(F.col("feature").isin(few)).collect() if few else []:
            self.few[r["feature"]][r["category"]] = r["code"]

    def classes(self, feature: str) -> DataFrame:
        return self.table.where(F.col("feature") == feature).select("category", "code")

    def lookup(self, feature: str) -> DataFrame:
        t = self.classes(feature)
        return F.broadcast(t) if self.bytes.get(feature, 0) <= broadcast_limit(t.sparkSession) else t


def _literal_code(category: Column, entries: dict[str, int]) -> Column:
    """The code by a literal map (NULL for an unseen category). The map is asked
    inside a lambda, which whole-stage code generation leaves out: compiled into one
    method with the joins, features and scaling before it, that method passes the
    8,000 bytes up to which the JVM compiles one, and every row is interpreted."""
    codes = F.create_map(*[F.lit(x) for entry in entries.items() for x in entry])
    return F.get(F.transform(F.array(category), lambda c: F.try_element_at(codes, c)), F.lit(0)).cast("long")


# a category on more than this share of the rows is looked up by broadcast
HEAVY = 1 / 1000


def _with_codes(df: DataFrame, dictionary: Dictionary, cols: Sequence[str]) -> DataFrame:
    """``df`` and, for each column c, ``__c_code`` (NULL for an unseen value). Short
    dictionaries are literal maps, small ones are broadcast; one large one is a join;
    several large ones are looked up together."""
    limit = broadcast_limit(df.sparkSession)
    large = [c for c in cols if dictionary.bytes.get(c, 0) > limit]
    if len(large) < 2 or df.isStreaming:
        large = []
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    literal = {c: dictionary.few[c] for c in cols if c in strings and c in dictionary.few and dictionary.bytes[c] <= limit}
    out = df.withColumns({f"__{c}_code": _literal_code(F.col(c), few) for c, few in literal.items()}) if literal else df
    for c in cols:
        if c not in large and c not in literal:
            lk = dictionary.lookup(c).select(F.col("category").alias(f"__{c}_cat"), F.col("code").alias(f"__{c}_code"))
            out = out.join(lk, out[c] == lk[f"__{c}_cat"], "left").drop(f"__{c}_cat")
    return _looked_up_together(out, dictionary, large) if large else out


def _looked_up_together(df: DataFrame, dictionary: Dictionary, cols: Sequence[str]) -> DataFrame:
    """Codes of several large dictionaries by one look-up: (row, column, category)
    pairs meet the dictionary in one shuffle, their codes go back to the rows in
    another. The rows are written once, so that a row keeps its number. Categories
    on more than ``HEAVY`` of the rows - at most ``len(cols) / HEAVY`` of them -
    come to the pairs by broadcast, so that none is a hot task."""
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()))
    pairs = rows.select("__row", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in cols])).alias("p"))
    pairs = pairs.select("__row", "p.feature", "p.category").where("category is not null")
    least = F.lit(HEAVY) * F.lit(rows.count())
    often = pairs.groupBy("feature", "category").agg(F.count("*").alias("n")).where(F.col("n") > least)
    known = dictionary.table.where(F.col("feature").isin(list(cols)))
    heavy = materialize(often.join(known, ["feature", "category"], "left").select(
        "feature", "category", F.col("code").alias("often"), F.lit(True).alias("is_often")))
    marked = pairs.join(F.broadcast(heavy), ["feature", "category"], "left")
    light = marked.where("is_often is null").select("__row", "feature", "category").join(known, ["feature", "category"])
    found = marked.where("often is not null").select("__row", "feature", F.col("often").alias("code")).unionByName(
        light.select("__row", "feature", "code"))
    codes = found.groupBy("__row").agg(*[F.max(F.when(F.col("feature") == c, F.col("code"))).alias(f"__{c}_code") for c in cols])
    return rows.join(codes, "__row", "left").drop("__row")


def encode(df: DataFrame, dictionary: Dictionary, cols: Sequence[str],
           out_type: str = "double") -> DataFrame:
    """replace each column by its code; unseen -> code of 'unknown';
    if the dictionary has no 'unknown', class 0 (serving fallback)."""
    out = _with_codes(df, dictionary, cols)
    fallback = {c: dictionary.unknown.get(c) for c in cols}
    return out.select(*[F.coalesce(F.col(f"__{c}_code"), F.lit(fallback[c] if fallback[c] is not None else 0)).cast(out_type).alias(c)
                        if c in fallback else F.col(c) for c in df.columns])


def mask_unseen(df: DataFrame, dictionary: Dictionary, cols: Sequence[str]) -> DataFrame:
    """Value not in the fitted dictionary -> 'unknown' (strings kept)."""
    out = _with_codes(df, dictionary, cols)
    return out.select(*[F.when(F.col(f"__{c}_code").isNotNull(), F.col(c)).otherwise(F.lit(spec.UNKNOWN)).alias(c)
                        if c in cols else F.col(c) for c in df.columns])
