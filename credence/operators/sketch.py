"""A2-A4 from sketches that merge: a profile of old and new parts without reading
the old ones.

The sketch of some rows is a small table, (column, kind, slot, n, x):

- ``rows``, ``missing``, ``nan``: counts, exact;
- ``least``, ``greatest``: exact, in x;
- ``bucket``: a histogram of a numeric column. A value m * 2 ** e with 0.5 <= m < 1
  falls by e and the first ``PARTS`` steps of m, exactly, so a bucket's middle is
  within 1 / (2 * PARTS) of each of its values, relatively;
- ``register``: for distinct values, the greatest number of leading zeros (plus one)
  among the hashes of a register (HyperLogLog, 2 ** ``BITS`` registers; standard
  error 1.04 / 2 ** (BITS / 2), that is 1.6 %).

Counts add up, extremes and registers are extremes: merged sketches of parts are the
sketch of all rows, number by number, whatever the parts, their order and tasks. A
task sends one small table; no row is expanded by columns. Exact profiles
(``profile``) stay the default, also for gates.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .profile import NUMERIC_TYPES

PARTS, BITS = 64, 12
OFFSET = 1100           # more than the least exponent of a double, below zero
INFINITE = 4_000_000    # bucket of infinity
SKETCH = "column string, kind string, slot int, n long, x double"
_SCHEMA = pa.schema([("column", pa.string()), ("kind", pa.string()), ("slot", pa.int32()), ("n", pa.int64()), ("x", pa.float64())])


def buckets(x: np.ndarray) -> np.ndarray:
    """Bucket of every value: ascending with it, 0 for 0."""
    m, e = np.frexp(np.abs(np.where(np.isfinite(x), x, 1.0)))
    size = (e.astype(np.int64) + OFFSET) * PARTS + np.floor((m - 0.5) * 2 * PARTS).astype(np.int64) + 1
    size = np.where(np.isinf(x), INFINITE, size)
    return np.where(x == 0, 0, np.where(x < 0, -size, size)).astype(np.int32)


def registers(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(register, leading zeros of the rest plus one) of 64-bit hashes."""
    h = hashes.view(np.uint64)
    rest = (h << np.uint64(BITS)) | np.uint64(1 << (BITS - 1))
    high, low = rest >> np.uint64(32), rest & np.uint64(0xFFFFFFFF)
    length = np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], np.frexp(low.astype(np.float64))[1])
    return (h >> np.uint64(64 - BITS)).astype(np.int64), (65 - length).astype(np.int64)


def _of_task(columns: Sequence[str], numeric: Sequence[bool]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, missing, nan = 0, np.zeros(len(columns), np.int64), np.zeros(len(columns), np.int64)
        counts = [(np.zeros(0, np.int32), np.zeros(0, np.int64)) for _ in columns]
        least, greatest = np.full(len(columns), np.inf), np.full(len(columns), -np.inf)
        some = np.zeros(len(columns), bool)
        top = np.zeros((len(columns), 1 << BITS), np.int64)
        for b in batches:
            rows += b.num_rows
            for k in range(len(columns)):
                h = b.column(f"h{k}").drop_null()
                missing[k] += b.num_rows - len(h)
                at, zeros = registers(h.to_numpy(zero_copy_only=False).astype(np.int64))
                np.maximum.at(top[k], at, zeros)
                if numeric[k]:
                    x = b.column(f"x{k}").drop_null().to_numpy(zero_copy_only=False)
                    nan[k] += int(np.isnan(x).sum())
                    x = x[~np.isnan(x)]
                    if len(x):
                        least[k], greatest[k], some[k] = min(least[k], x.min()), max(greatest[k], x.max()), True
                        slot, n = np.unique(np.concatenate([counts[k][0], buckets(x)]), return_inverse=True)
                        n = np.bincount(n, np.concatenate([counts[k][1], np.ones(len(x), np.int64)])).astype(np.int64)
                        counts[k] = (slot, n)
        for k, c in enumerate(columns):
            hit = np.flatnonzero(top[k])
            kinds = ["rows", "missing", "nan"] + ["least", "greatest"] * int(some[k]) + ["bucket"] * len(counts[k][0]) + ["register"] * len(hit)
            ends = [least[k], greatest[k]] if some[k] else []
            rest = len(kinds) - 3 - len(ends)
            yield pa.record_batch([
                pa.array([c] * len(kinds)), pa.array(kinds),
                pa.array(np.concatenate([np.zeros(3 + len(ends), np.int64), counts[k][0], hit]).astype(np.int32)),
                pa.array(np.concatenate([[rows, missing[k], nan[k]], np.zeros(len(ends), np.int64), counts[k][1], top[k][hit]]).astype(np.int64)),
                pa.array([None] * 3 + ends + [None] * rest, pa.float64())], schema=_SCHEMA)
    return run


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of parts as one (or one for each value of ``by``)."""
    n = F.when(F.col("kind") == "register", F.max("n")).otherwise(F.sum("n"))
    x = F.when(F.col("kind") == "least", F.min("x")).otherwise(F.max("x"))
    return sketches.groupBy(*by, "column", "kind", "slot").agg(n.cast("long").alias("n"), x.alias("x"))


def sketch(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The sketch of a frame's columns."""
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [isinstance(types[c], NUMERIC_TYPES) for c in columns]
    picked = []
    for k, c in enumerate(columns):
        # one zero, whatever its sign
        value = F.col(c) + F.lit(0.0).cast(types[c]) if isinstance(types[c], (T.DoubleType, T.FloatType)) else F.col(c)
        picked.append(F.when(F.col(c).isNotNull(), F.xxhash64(value)).alias(f"h{k}"))
        if numeric[k]:
            picked.append(F.col(c).cast("double").alias(f"x{k}"))
    return merged(df.select(*picked).mapInArrow(_of_task(columns, numeric), SKETCH))


def profile_of(sketches: DataFrame) -> DataFrame:
    """Per column of merged sketches: total_records, missing_count, missing_pct,
    distinct_count (estimated), min, max, p25, p50, p75 (within 1 / (2 * PARTS) of
    the interpolated order statistics' sizes); NaN counts as a value but has no place
    in an order."""
    m = float(1 << BITS)
    reg = F.col("kind") == "register"
    zero = F.lit(m) - F.count_if(reg)
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (zero + F.sum(F.when(reg, F.pow(F.lit(2.0), -F.col("n"))).otherwise(0.0)))
    few = (raw <= 2.5 * m) & (zero > 0)
    distinct = F.when(few, F.lit(m) * F.log(F.lit(m) / zero)).otherwise(raw)

    def only(kind: str, value: str = "n"):
        return F.max(F.when(F.col("kind") == kind, F.col(value)))
    facts = sketches.groupBy("column").agg(
        only("rows").alias("total_records"), only("missing").alias("missing_count"), F.round(distinct).cast("long").alias("distinct_count"),
        only("least", "x").alias("min"), only("greatest", "x").alias("max"))
    # a column has a few thousand buckets at most
    hist = sketches.where("kind = 'bucket'").withColumn("upto", F.sum("n").over(Window.partitionBy("column").orderBy("slot")))
    size = F.abs("slot") - 1
    middle = F.pow(F.lit(2.0), F.floor(size / PARTS) - OFFSET) * (0.5 + (F.pmod(size, F.lit(PARTS)) + 0.5) / (2 * PARTS))
    middle = F.when(F.abs("slot") == INFINITE, F.lit(float("inf"))).otherwise(middle)
    hist = hist.select("column", "upto", F.when(F.col("slot") == 0, 0.0).otherwise(F.signum("slot") * middle).alias("v"))
    hist = hist.groupBy("column").agg(F.sort_array(F.collect_list(F.struct("upto", "v"))).alias("h"))
    joined = facts.join(hist, "column", "left")

    def at(rank):
        return F.get(F.filter("h", lambda s: s["upto"] > rank), F.lit(0))["v"]

    def quantile(q: float):
        last = F.get("h", F.size("h") - 1)["upto"] - 1
        place = F.lit(q) * last
        lo, hi = at(F.floor(place)), at(F.ceil(place))
        inside = F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (place - F.floor(place)))
        return F.least(F.greatest(inside, F.col("min")), F.col("max"))
    return joined.select("column", "total_records", "missing_count",
                         F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("total_records")), 2).alias("missing_pct"),
                         "distinct_count", "min", "max", *[quantile(q).alias(f"p{int(100 * q)}") for q in (0.25, 0.5, 0.75)])
