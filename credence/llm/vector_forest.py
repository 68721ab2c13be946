"""Approximate nearest neighbours by a forest of random-projection trees
(Dasgupta and Freund, 2008), nearness being the cosine.

Fit. Vectors of length one are split by hyperplanes: a node's direction is the
difference of two of its sample vectors, chosen at random, its threshold the
median of their projections. ``TREES`` trees are grown by one task on a sample
of at most ``SAMPLE`` distinct vectors (by hash), down to ``LEAF`` rows a leaf
or ``LEAVES`` leaves a tree. The nodes are a table of bounded size.

Index. Every distinct vector is routed down every tree; of equal vectors only
the k + 1 rows of smallest id are kept beside it, which is exact, since of equal
scores the smaller ids win and a query drops one row, its own. A leaf of more
than ``BLOCK`` vectors is dealt to blocks by hash.

Search. All trees of a query wait in one priority queue, at each node with the
sum of the squared distances to the hyperplanes that were crossed on the way;
the least is taken first, until the leaves read hold ``budget`` vectors. Leaves
and the queries that read them meet in one sort by leaf: a task holds a block
and streams its queries. Cosines are ranked by a matrix product, the best (and
all within rounding of them) computed again in extended precision; a task passes on
the k + 1 best of a query over its leaves.

Budget. What the search must read depends on the data, so it is measured:
``CALIBRATION`` query vectors (by hash) are compared with all vectors, and the
budget is the ``RECALL`` quantile of what the queue read before it came to each
true neighbour. Vectors without any structure need a large part of the table,
as with any index; then the budget says so. ``recall`` measures a result.

Cases: a vector that is null, empty, all zeros, or holds a null or non-finite
component takes no part, nor does a row without id; shorter vectors count as
padded with zeros. A query's candidates are all rows but its own: rows that
repeat its id, or id and vector, are candidates each. Ties go to the smaller id.
Fewer candidates than k are all returned. An empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credence.llm.common import stored

TREES, LEAF, LEAVES = 4, 256, 4096
SAMPLE, SAMPLE_LEAF = 65_536, 16
BLOCK = 16_384
CALIBRATION, RECALL = 128, 0.95
HELD = 20_000   # queries whose best a task holds before it passes them on
CLOSE = 1e-9   # more than the rounding of a matrix product of unit vectors


def usable(embedding: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(embedding, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return F.coalesce(F.exists(embedding, lambda v: v != 0) & ~bad, F.lit(False))


def units(vectors: list[list[float]], width: int) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows."""
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    out /= np.abs(out).max(1, initial=0, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Of two vectors of length one to rounding, free of that rounding."""
    return math.sumprod(a, b) / math.sqrt(math.sumprod(a, a) * math.sumprod(b, b))


class Forest:
    """Nodes of all trees: direction, threshold, children. A child below zero is
    leaf -1 - child. Tree t starts at node or leaf ``roots[t]``."""

    def __init__(self, directions: np.ndarray, thresholds: np.ndarray, children: np.ndarray, roots: list[int]) -> None:
        self.directions, self.thresholds, self.children, self.roots = directions, thresholds, children, roots

    @staticmethod
    def grow(sample: np.ndarray, leaf: int, trees: int = TREES, seed: int = 11) -> Forest:
        rng = np.random.default_rng(seed)
        directions, thresholds, children, roots, leaves = [], [], [], [], 0
        for _ in range(trees):
            roots.append(0)
            todo = [(np.arange(len(sample)), len(children), None)]
            while todo:
                rows, _, parent = todo.pop()
                split = None
                if len(rows) > leaf:
                    a, b = sample[rng.choice(rows, 2, replace=False)]
                    along = sample[rows] @ (a - b)
                    at = float(np.median(along))
                    split = along >= at
                if split is None or split.all() or not split.any():
                    leaves += 1
                    me = -leaves
                else:
                    me = len(children)
                    size = float(np.linalg.norm(a - b))
                    directions.append((a - b) / size)
                    thresholds.append(at / size)
                    children.append([0, 0])
                    todo += [(rows[~split], me, (me, 0)), (rows[split], me, (me, 1))]
                if parent is None:
                    roots[-1] = me
                else:
                    children[parent[0]][parent[1]] = me
        return Forest(np.array(directions).reshape(-1, sample.shape[1]), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2), roots)

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree (rows x trees)."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root, np.int64)
            while len(rows := np.flatnonzero(at >= 0)):
                node = at[rows]
                over = np.einsum("ij,ij->i", x[rows], self.directions[node]) >= self.thresholds[node]
                at[rows] = self.children[node, over.astype(np.int64)]
            out[:, t] = -1 - at
        return out

    def visits(self, margins: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) in the order of the queue; margins: of a query to every hyperplane."""
        queue = [(0.0, t, root) for t, root in enumerate(self.roots)]
        heapq.heapify(queue)
        while queue:
            far, t, at = heapq.heappop(queue)
            while at >= 0:  # the near child has the same priority: on down
                m = margins[at]
                below, above = self.children[at].tolist()
                near, other = (above, below) if m >= 0 else (below, above)
                heapq.heappush(queue, (far + m * m, t, other))
                at = near
            yield t, -1 - at

    def margins(self, q: np.ndarray) -> np.ndarray:
        return q @ self.directions.T - self.thresholds

    def read(self, margins: np.ndarray, sizes: dict[int, int], budget: int, total: int) -> list[int]:
        """The leaves to read: until they hold ``budget`` vectors, or, where that is
        as much as the table, every leaf of one tree."""
        out, held = [], 0
        for t, leaf in self.visits(margins):
            if budget >= total:
                out += [leaf] if t == 0 else []
            else:
                out.append(leaf)
                held += sizes.get(leaf, 0)
                if held >= budget:
                    break
        return out


def _rows(vectors: DataFrame, is_query: Column) -> DataFrame:
    """(vec_id, x, asks, row) with a number for each row."""
    x = F.col("embedding")
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    kept = x if kind in ("float", "double") else x.cast("array<double>")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(x)).select(
        F.col("vec_id").cast("long").alias("vec_id"), kept.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "forest-rows")


def _fitted(entries: DataFrame, n: int, width: int, seed: int) -> Forest:
    """Grown by one task on at most about ``SAMPLE`` vectors."""
    share = int(min(1.0, SAMPLE / max(1, n)) * (1 << 20))
    leaf = max(LEAF, -(-n // LEAVES))
    sample = entries.where(F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(1 << 20)) < share).select("x")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [units(b.column(0).to_pylist(), width) for b in batches]
        x = np.concatenate(parts) if parts else np.zeros((0, width))
        x = x[np.lexsort(x.T[::-1])] if len(x) else x   # the same trees whatever the order of rows
        f = Forest.grow(x, max(SAMPLE_LEAF if n > SAMPLE else 1, leaf * len(x) // max(1, n)), TREES, seed)
        m = len(f.children)
        yield pa.record_batch([
            pa.array(list(range(m)) + [-1 - t for t in range(len(f.roots))], pa.int64()),
            pa.array([*f.directions.tolist(), *[[]] * len(f.roots)], pa.list_(pa.float64())),
            pa.array([*f.thresholds.tolist(), *[0.0] * len(f.roots)]),
            pa.array([*f.children[:, 0].tolist(), *f.roots], pa.int64()), pa.array([*f.children[:, 1].tolist(), *f.roots], pa.int64())],
            names=["node", "direction", "threshold", "below", "above"])
    nodes = stored(sample.repartition(1).mapInArrow(
        grow, "node long, direction array<double>, threshold double, below long, above long"), "forest-nodes")
    got = nodes.orderBy("node").collect()   # bounded: TREES x SAMPLE / SAMPLE_LEAF nodes at most
    inner = [r for r in got if r["node"] >= 0]
    roots = [r["below"] for r in reversed(got) if r["node"] < 0]
    return Forest(np.array([r["direction"] for r in inner]).reshape(-1, width), np.array([r["threshold"] for r in inner]),
                  np.array([[r["below"], r["above"]] for r in inner], np.int64).reshape(-1, 2), roots)


def _best(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """For each query row the k best rows of x: (cosine, row), ties by ``first``."""
    rough = q @ x.T
    out = []
    for i in range(len(q)):
        if len(x) > k:
            least = np.partition(rough[i], len(x) - k)[len(x) - k]
            rows = np.flatnonzero(rough[i] >= least - CLOSE)
        else:
            rows = np.arange(len(x))
        own = q[i].tolist()
        out.append(sorted(((cosine(own, x[r].tolist()), int(r)) for r in rows), key=lambda s: (-s[0], first[s[1]]))[:k])
    return out


def _true_neighbours(entries: DataFrame, asked: list, width: int, k: int) -> list[list[list[int]]]:
    """By query of ``asked`` the leaves of each of its k nearest of all entries."""
    q = units(asked, width)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int, list[int]]]] = [[] for _ in range(len(q))]
        for b in batches:
            ids, leaves = [r[0]["vec_id"] for r in b.column(1).to_pylist()], b.column(2).to_pylist()
            for i, found in enumerate(_best(q, units(b.column(0).to_pylist(), width), np.array(ids), k)):
                best[i] = sorted([*best[i], *((s, ids[r], leaves[r]) for s, r in found)], key=lambda s: (-s[0], s[1]))[:k]
        rows = [(i, *r) for i, rs in enumerate(best) for r in rs]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()),
                               pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                              names=["q", "score", "vec_id", "leaves"])
    found = entries.select("x", "rows", "leaves").mapInArrow(scan, "q int, score double, vec_id long, leaves array<long>")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    top = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).collect()   # CALIBRATION x k rows
    return [[r["leaves"] for r in top if r["q"] == i] for i in range(len(q))]


def needed(forest: Forest, q: np.ndarray, truth: list[list[int]], sizes: dict[int, int]) -> list[int]:
    """What is read before the queue comes to each of a query's true neighbours."""
    left, out, held = {n: set(leaves) for n, leaves in enumerate(truth)}, [], 0
    for _, leaf in forest.visits(forest.margins(q[None])[0]):
        if not left:
            break
        held += sizes.get(leaf, 0)
        for n in [n for n, leaves in left.items() if leaf in leaves]:
            del left[n]
            out.append(held)
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, budget: int | None = None, seed: int = 11) -> DataFrame:
    """vectors: (vec_id, embedding); is_query: which rows ask. Of each asking row
    the k nearest rows found: query_id, row (number of the asking row), rank
    (from 1), vec_id, score. ``budget``: vectors to read for a query; measured
    if None."""
    rows = _rows(vectors, is_query)
    of_vector = Window.partitionBy("x").orderBy("vec_id", "row")
    folded = (rows.withColumn("n", F.row_number().over(of_vector)).where(F.col("n") <= k + 1).groupBy("x")
              .agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("rows")))
    folded = stored(folded, "forest-vectors")
    n, width = folded.agg(F.count("*"), F.max(F.size("x"))).first()
    width = width or 1
    forest = _fitted(folded, n, width, seed)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaves = forest.leaves_of(units(b.column(0).to_pylist(), width))
            yield pa.record_batch([*b.columns, pa.array(leaves.tolist(), pa.list_(pa.int64()))], names=["x", "rows", "leaves"])
    kind = folded.schema["x"].dataType.simpleString()
    pairs = "array<struct<vec_id:long,row:long>>"
    index = stored(folded.mapInArrow(route, f"x {kind}, rows {pairs}, leaves array<long>"), "forest-index")
    counted = index.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()   # one row a leaf
    sizes = {r["leaf"]: r["count"] for r in counted}
    blocks = {leaf: -(-c // BLOCK) for leaf, c in sizes.items()}

    asked = stored(rows.where("asks").select("x").distinct().withColumn("q", F.monotonically_increasing_id()), "forest-asked")
    if budget is None:
        some = [r["x"] for r in asked.select("x", F.xxhash64("x").alias("h")).orderBy("h").limit(CALIBRATION).collect()]
        truth = _true_neighbours(index, some, width, k + 1) if some else []
        reads = sorted(r for v, t in zip(units(some, width), truth, strict=True) for r in needed(forest, v, t, sizes))
        budget = reads[min(len(reads) - 1, int(len(reads) * RECALL))] if reads else 0
    budget = max(budget, 2 * TREES * (k + 1))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                b = batch.slice(at, 64)
                margins = forest.margins(units(b.column(0).to_pylist(), width))
                out = [(i, leaf, block) for i in range(b.num_rows) for leaf in forest.read(margins[i], sizes, budget, n)
                       for block in range(blocks.get(leaf, 0))]
                at_rows = pa.array([o[0] for o in out], pa.int64())
                yield pa.record_batch([pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int32()),
                                       b.column(0).take(at_rows), b.column(1).take(at_rows)], names=["leaf", "block", "x", "q"])
    readers = asked.select("x", "q").mapInArrow(ask, f"leaf long, block int, x {kind}, q long")
    parts = F.create_map(*[F.lit(v) for kv in blocks.items() if kv[1] > 1 for v in kv]) if max(blocks.values(), default=0) > 1 else None
    at_block = F.lit(0) if parts is None else F.pmod(F.xxhash64("x"), F.coalesce(F.try_element_at(parts, F.col("leaf")), F.lit(1)))
    held = (index.select("x", "rows", F.explode("leaves").alias("leaf"))
            .select("leaf", at_block.cast("int").alias("block"), "x", F.lit(None).cast("long").alias("q"), "rows"))
    met = (held.unionByName(readers.withColumn("rows", F.lit(None).cast(pairs)))
           .repartition("leaf", "block").sortWithinPartitions("leaf", "block", "q"))   # nulls, the vectors, come first
    schema = pa.schema([("q", pa.int64()), ("score", pa.float64()),
                        ("rows", pa.list_(pa.struct([("vec_id", pa.int64()), ("row", pa.int64())])))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, x, owners = None, [], []
        best: dict[int, list[tuple]] = {}   # of each query, over the leaves of this task

        def told() -> pa.RecordBatch:
            found = [(i, -far, rows) for i, near in best.items() for far, _, _, rows in near]
            best.clear()
            return pa.record_batch([pa.array([f[n] for f in found], schema.field(n).type) for n in range(3)], schema=schema)
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            q = np.array([-1 if v is None else v for v in b.column(3).to_pylist()], np.int64)
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or (q[i] < 0) != (q[i - 1] < 0)), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if keys[lo] != now:
                    now, x, owners = keys[lo], [], []
                part = b.slice(lo, hi - lo)
                if q[lo] < 0:
                    x.append(units(part.column(2).to_pylist(), width))
                    owners += part.column(4).to_pylist()
                elif x:
                    x = [np.concatenate(x)]
                    first = np.array([o[0]["vec_id"] for o in owners])
                    for at in range(0, hi - lo, 256):
                        some = part.slice(at, 256)
                        near = _best(units(some.column(2).to_pylist(), width), x[0], first, k + 1)
                        for i, got in zip(q[lo + at: lo + at + len(near)].tolist(), near, strict=True):
                            merged = best.get(i, []) + [(-s, owners[r][0]["vec_id"], owners[r][0]["row"], owners[r]) for s, r in got]
                            once = {m[2]: m for m in merged}
                            best[i] = sorted(once.values(), key=lambda m: m[:3])[: k + 1]
                        if len(best) > HELD:
                            yield told()
        yield told()
    found = met.mapInArrow(search, f"q long, score double, rows {pairs}")
    # a vector that is found in several trees counts once
    once = found.groupBy("q", F.col("rows")[0]["row"].alias("r")).agg(F.max("score").alias("score"), F.first("rows").alias("rows"))
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("rows")[0]["vec_id"], "r")
    near = (once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
            .select("q", F.inline(F.transform("rows", lambda r: F.struct((-F.col("score")).alias("far"), r["vec_id"].alias("vec_id"), r["row"].alias("row")))))
            .groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct("far", "vec_id", "row"))), 1, k + 1).alias("near")))
    near = near.join(asked, "q").select("x", "near")
    answers = rows.where("asks").join(near, "x").select(F.col("vec_id").alias("query_id"), F.col("row"), F.posexplode(F.slice(
        F.filter("near", lambda r: r["row"] != F.col("row")), 1, k)).alias("p", "r"))
    return answers.select("query_id", "row", (F.col("p") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("vec_id"),
                          (-F.col("r.far")).alias("score"))
