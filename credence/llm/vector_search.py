"""Exact top-k inner-product search with vector-approximation files (Weber et
al., 1998).

Vectors are whole numbers per component. Two files are written: the vectors, and
their approximations - each component quantised to one of ``2 ** BITS`` equal
cells between its least and greatest value, one byte a component. Of equal vectors
only the k + 1 rows of smallest id are kept beside them, which is exact, since of
equal scores the smaller ids win and a query drops one row, its own.

First only cells are read. From the middles of its cells a vector's score is known
up to half a cell in each component, which gives a lower and an upper bound. Of a
block of cells a query keeps the vectors whose upper bound reaches the block's
k-th greatest lower bound (own row apart); then the k-th greatest lower bound over
all blocks sorts out most of these. Only for the rest exact vectors are read: per
query in the order of their upper bounds, until the k-th best exact score is above
the next bound (ties are read too).

Query blocks meet cell blocks by an equi-join on the block number. The queries
are a stated set; nothing is broadcast or collected but the cells' ranges, two
numbers a component.

Cases: a vector that is null, or holds a null or non-finite component, takes no
part, nor does a row without id; shorter vectors count as padded with zeros, an
empty vector scores 0. A query's candidates are all rows but its own: rows that
repeat its id, or its id and vector, are candidates each, and each asks for
itself if it is a query. Ties go to the smaller id. Scores beyond 64 bits stop at
the limits of a long. Fewer candidates than k are all returned. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credence.llm.common import stored

BITS = 6
QUERY_BLOCK, VECTOR_BLOCK = 512, 8192
EXACT = 2**52   # whole numbers up to here are exact as doubles


def whole(embedding: str, scale: int = 256):
    """floor(scale * x) of every component; null where the vector takes no part."""
    x = F.transform(F.col(embedding), lambda v: F.floor(v.cast("double") * scale))
    bad = F.exists(F.col(embedding), lambda v: v.isNull() | F.isnan(v.cast("double"))
                   | (F.abs(v.cast("double")) == float("inf")))
    return F.when(F.col(embedding).isNotNull() & ~bad, x)


def _matrix(rows: list[list[int]], width: int) -> np.ndarray:
    big = any(abs(v) >= 2**53 for r in rows for v in (min(r, default=0), max(r, default=0)))
    out = np.zeros((len(rows), width), object if big else np.float64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def exact(q: list[int], x: list[int]) -> int:
    """Inner product of two vectors, stopped at the limits of a long."""
    return max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, x, strict=False))))


class Cells:
    """How components are quantised, and bounds on scores from cells."""

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        self.low, self.step = low, (high - low) / 2**BITS

    def of(self, x: np.ndarray) -> np.ndarray:
        step = np.where(self.step > 0, self.step, 1)
        return np.clip((x.astype(np.float64) - self.low) / step, 0, 2**BITS - 1).astype(np.uint8)

    def bounds(self, q: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Middle scores (queries x vectors) and the most they can be off."""
        q = q.astype(np.float64)
        middle = (q * self.step) @ cells.T.astype(np.float64) + (q @ (self.low + self.step / 2))[:, None]
        reach = np.abs(q) @ (np.abs(self.low) + self.step * 2**BITS)
        return middle, np.abs(q) @ self.step / 2 + 1 + 1e-9 * reach  # also rounding


def as_stopped(lower: np.ndarray) -> np.ndarray:
    """Lower bounds of scores that stop at the limits of a long: what is beyond a
    limit is a tie there, and ties are read."""
    return np.where(lower <= -2.0**63, -np.inf, np.minimum(lower, 2.0**63))


def kept(middle: np.ndarray, slack: float, k: int) -> np.ndarray:
    """Places of the vectors whose upper bound reaches the k-th greatest lower one."""
    if len(middle) <= k:
        return np.arange(len(middle))
    least = np.partition(middle, len(middle) - k)[len(middle) - k]
    return np.flatnonzero(middle + slack >= as_stopped(least - slack))


def _ranges(vectors: DataFrame) -> Cells:
    """Least and greatest value of every component (0 where a vector is shorter)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros(0), np.zeros(0)
        for b in batches:
            rows = b.column(0).to_pylist()
            width = max([len(low), *map(len, rows)])
            x = np.vstack([np.pad(low, (0, width - len(low))), np.pad(high, (0, width - len(high))), _matrix(rows, width).astype(np.float64)])
            low, high = x.min(0), x.max(0)
        yield pa.record_batch([pa.array([low.tolist()], pa.list_(pa.float64())), pa.array([high.tolist()], pa.list_(pa.float64()))],
                              names=["low", "high"])
    each = vectors.select("x").mapInArrow(run, "low array<double>, high array<double>")
    found = (each.select(F.posexplode(F.arrays_zip("low", "high")).alias("i", "r")).groupBy("i")
             .agg(F.min("r.low").alias("low"), F.max("r.high").alias("high")).orderBy("i").collect())   # a row a component
    return Cells(np.array([min(0.0, r["low"]) for r in found]), np.array([max(0.0, r["high"]) for r in found]))


def _blocks(rows: DataFrame, size: int, key: str, *columns: str) -> DataFrame:
    """Rows gathered in blocks of about ``size``, by hash."""
    n = max(1, -(-rows.count() // size))
    return (rows.withColumn("block", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).groupBy("block")
            .agg(F.sort_array(F.collect_list(F.struct(key, *columns))).alias("r"))
            .select("block", *[F.col(f"r.{c}").alias(c) for c in (key, *columns)]))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """vectors: (vec_id, x array<long>); is_query: which rows ask. Each asking
    row's k best rows: query_id, row (number of the asking row), rank (from 1),
    vec_id, score."""
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("x").cast("array<long>").alias("x"),
                           F.coalesce(is_query, F.lit(False)).alias("asks")).where("vec_id is not null and x is not null"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vector-rows")
    of_vector = Window.partitionBy("x").orderBy("vec_id", "row")
    pairs = "array<struct<vec_id:long,row:long>>"
    folded = (rows.withColumn("n", F.row_number().over(of_vector)).where(F.col("n") <= k + 1).groupBy("x")
              .agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("rows")))
    file = stored(folded.withColumn("v", F.monotonically_increasing_id()), "vectors")
    asked = stored(rows.where("asks").select("x").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
    ranges = _ranges(file)
    width = len(ranges.low)

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = ranges.of(_matrix(b.column(1).to_pylist(), width))
            yield pa.record_batch([b.column(0), pa.array([c.tobytes() for c in cells], pa.binary())], names=["v", "cells"])
    # a copy of a vector counts once: a query drops one row, so k + 1 vectors are sure to hold k
    cells = stored(file.select("v", "x").mapInArrow(quantise, "v long, cells binary"), "cells")
    cell_blocks = stored(_blocks(cells, VECTOR_BLOCK, "v", "cells"), "cell-blocks")
    query_blocks = stored(_blocks(asked, QUERY_BLOCK, "q", "x"), "query-blocks")
    n = query_blocks.agg(F.max("block")).first()[0]
    numbers = F.sequence(F.lit(0), F.lit(n if n is not None else 0))
    met = (cell_blocks.select(F.col("block").alias("cell_block"), "v", "cells", F.explode(numbers).alias("block"))
           .join(query_blocks, "block").repartition("block", "cell_block").select("v", "cells", "q", "x"))
    bound = pa.schema([("q", pa.int64()), ("v", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                c = np.frombuffer(b"".join(r["cells"]), np.uint8).reshape(len(r["v"]), width)
                v = np.array(r["v"], np.int64)
                middle, slack = ranges.bounds(_matrix(r["x"], width), c)
                for q, m, s in zip(r["q"], middle, slack, strict=True):
                    at = kept(m, s, k + 1)
                    yield pa.record_batch([pa.array([q] * len(at), pa.int64()), pa.array(v[at]), pa.array(as_stopped(m[at] - s)), pa.array(m[at] + s)],
                                          schema=bound)
    found = stored(met.mapInArrow(scan, "q long, v long, lower double, upper double"), "bounds")
    by_lower = Window.partitionBy("q").orderBy(F.col("lower").desc(), "v")
    # the k + 1-st greatest lower bound of all blocks; without so many vectors all are read
    sure = (found.withColumn("n", F.row_number().over(by_lower)).where(F.col("n") <= k + 1).groupBy("q")
            .agg(F.min(F.when(F.col("n") == k + 1, F.col("lower"))).alias("least")))
    left = found.join(sure, "q").where("least is null or upper >= least").select("q", "v", "upper")
    read = (left.join(file.select("v", "x", "rows"), "v").join(asked.select("q", F.col("x").alias("own")), "q")
            .select("q", "upper", "rows", "x", "own").repartition("q").sortWithinPartitions("q", F.col("upper").desc()))
    schema = pa.schema([("q", pa.int64()), ("near", pa.list_(pa.struct([("far", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()),
                                                                         ("score", pa.int64())])))])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, []

        def told() -> pa.RecordBatch:
            near = [{"far": -1 - s, "vec_id": i, "row": r, "score": s} for s, i, r in best]
            return pa.record_batch([pa.array([now], pa.int64()), pa.array([near], schema.field("near").type)], schema=schema)
        for b in batches:
            for r in b.to_pylist():
                if r["q"] != now:
                    if now is not None:
                        yield told()
                    now, best = r["q"], []
                if len(best) == k + 1 and -2**63 < best[-1][0] > r["upper"]:
                    continue   # neither this vector nor one behind it
                score = exact(r["own"], r["x"])
                best = sorted([*best, *((score, o["vec_id"], o["row"]) for o in r["rows"])], key=lambda s: (-s[0], s[1], s[2]))[: k + 1]
        if now is not None:
            yield told()
    near = read.mapInArrow(rank, "q long, near array<struct<far:long,vec_id:long,row:long,score:long>>")
    near = near.join(asked, "q").select("x", "near")
    answers = rows.where("asks").join(near, "x").select(F.col("vec_id").alias("query_id"), "row", F.posexplode(F.slice(
        F.filter("near", lambda r: r["row"] != F.col("row")), 1, k)).alias("p", "r"))
    return answers.select("query_id", "row", (F.col("p") + 1).cast("int").alias("rank"), "r.vec_id", "r.score")
