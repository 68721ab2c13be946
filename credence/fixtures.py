"""The ``applications`` fixture: loan applications derived from the driver's
``orders`` and ``customer`` tables.

There is no loan table among the driver tables, so every query in the
correctness suite derives one deterministically. The derivation is plain
column arithmetic over an ``orders ⋈ customer`` equi-join; Catalyst prunes
both scans to the six and two columns used and picks the join strategy
(sort-merge at scale, broadcast when AQE sees a small customer side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spec
from .functions.scorecard import approval_label


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None).cast("double")).otherwise(value)


def raw_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw application records (no label): key, timestamp, 8 inputs."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")

    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    age = _null_when(k % 41 == 0, (F.lit(18) + ck % 63).cast("double"))
    income = (
        F.when(k % 37 == 0, F.lit(None).cast("double"))
        .when(k % 101 == 0, F.lit(0.0))
        .otherwise((F.lit(20000) + F.floor((F.col("c_acctbal") + 1000) * 10)).cast("double"))
    )
    employment = _null_when(k % 43 == 0, (k % 201).cast("double") / F.lit(10.0))
    credit = _null_when(k % 47 == 0, (F.lit(300) + (k * 7919) % 551).cast("double"))
    dti = ((ck * 31 + k) % 800).cast("double") / F.lit(1000.0)
    loan = (F.lit(5000) + F.floor(F.col("o_totalprice") * 0.1)).cast("double")
    ownership = (
        F.when(k % 53 == 0, F.lit(None).cast("string"))
        .when(ck % 10 < 4, F.lit("RENT"))
        .when(ck % 10 < 7, F.lit("OWN"))
        .otherwise(F.lit("MORTGAGE"))
    )
    prio = F.col("o_orderpriority")
    purpose = (
        F.when(prio == "1-URGENT", F.lit("debt_consolidation"))
        .when(prio == "2-HIGH", F.lit("home_improvement"))
        .when(prio == "3-MEDIUM", F.lit("major_purchase"))
        .otherwise(F.lit("other"))
    )
    return j.select(
        k.alias(spec.KEY),
        F.col("o_orderdate").alias(spec.TS),
        age.alias("age"),
        income.alias("income"),
        employment.alias("employment_length"),
        credit.alias("credit_score"),
        dti.alias("debt_to_income"),
        loan.alias("loan_amount"),
        ownership.alias("home_ownership"),
        purpose.alias("loan_purpose"),
    )


def noise(key: Column) -> Column:
    """Deterministic stand-in for the generator's N(0, 10) noise."""
    return ((key * 104729) % 41 - 20).cast("double")


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records plus the scorecard label ``loan_approved``."""
    raw = raw_applications(spark, sf_dir)
    return raw.withColumn(spec.TARGET, approval_label(noise(F.col(spec.KEY))))


# The same fixture as SQL text, for DuckDB oracles (runs unchanged on Spark
# with session time zone UTC). Kept verbatim from FIXTURES.md.
RAW_APPLICATIONS_SQL = """
SELECT o.o_orderkey AS application_id, o.o_orderdate AS application_ts,
 CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE CAST(18 + o.o_custkey % 63 AS DOUBLE) END AS age,
 CASE WHEN o.o_orderkey % 37 = 0 THEN NULL WHEN o.o_orderkey % 101 = 0 THEN CAST(0 AS DOUBLE)
      ELSE CAST(20000 + floor((c.c_acctbal + 1000) * 10) AS DOUBLE) END AS income,
 CASE WHEN o.o_orderkey % 43 = 0 THEN NULL
      ELSE CAST(o.o_orderkey % 201 AS DOUBLE) / CAST(10 AS DOUBLE) END AS employment_length,
 CASE WHEN o.o_orderkey % 47 = 0 THEN NULL ELSE CAST(300 + (o.o_orderkey * 7919) % 551 AS DOUBLE) END AS credit_score,
 CAST((o.o_custkey * 31 + o.o_orderkey) % 800 AS DOUBLE) / CAST(1000 AS DOUBLE) AS debt_to_income,
 CAST(5000 + floor(o.o_totalprice * 0.1) AS DOUBLE) AS loan_amount,
 CASE WHEN o.o_orderkey % 53 = 0 THEN NULL WHEN o.o_custkey % 10 < 4 THEN 'RENT'
      WHEN o.o_custkey % 10 < 7 THEN 'OWN' ELSE 'MORTGAGE' END AS home_ownership,
 CASE o.o_orderpriority WHEN '1-URGENT' THEN 'debt_consolidation' WHEN '2-HIGH' THEN 'home_improvement'
      WHEN '3-MEDIUM' THEN 'major_purchase' ELSE 'other' END AS loan_purpose
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""
