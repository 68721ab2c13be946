"""Cleaning pipeline over ``documents``: toxic documents go, one document of
each group of near-duplicates stays, contaminated documents go, and the rest is
encoded to token ids. Every stage works on all rows its predecessor kept, is
written as Parquet and reread.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns doc_id, n_tokens, ids, and the digest of what the
ids decode to.

Cases. Null and empty texts, and texts without words, are neither toxic by their
own words nor copies nor contaminated: such a row stays, unless the fitted model
scores the empty text as toxic, and is encoded to no ids; rows that repeat id and
text stay once, those without an id each. Of repeated rows and copies with words one
stays: the row of the least id, one without an id only if no copy has any. Rows that
share an id are judged by their own texts. Whole texts count, however long. Labels
and benchmark may be empty: then nothing is learned and nothing is contaminated.
Other columns come through every stage but the last as they are, whatever their
names. An empty table gives no rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from credence.llm import byte_bpe, decontaminate, minhash, toxicity
from credence.llm.common import stored, table

RANKS = "byte_bpe_multi_50k.tiktoken"

#: No stage but decontamination can be said in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, width=5, per_100=80)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_checked(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
