"""L1 at size: the forest of ``RandomForestClassifier`` - bags by Poisson(1), binned
splits, sqrt(d) features drawn for every node, Gini gain, equal leaves merged - grown
level by level for all trees at once.

Spark's own fit keeps a node number per row and tree beside the rows and updates, row
by row, statistics of all nodes of all trees, which no core's cache holds. Here a row
is one byte per feature and one for its label (a number of rows make a block, which is
all that is cached); its bag counts are drawn again from the block's seed in each
pass, and its nodes found again from the roots. A task counts one tree after the
other, so that what it counts into stays in its core's cache, and hands on a node's
counts per bin; they are added by node, and the node's best split is found where they
meet. The driver holds the nodes: at most 2 ** (depth + 1) a tree, whatever the rows.

Rows lie by a hash of their key and values and in order inside a part, so the forest
depends on the seed and the number of parts, not on cores or files. The result is
loaded as a ``RandomForestClassificationModel``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

# functions go to the workers by value: they needn't have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 128                  # of a feature, as training.make_estimator asks for
MAX_DEPTH = 12              # nodes are numbered as in a full tree
BLOCK_ROWS = 131_072        # rows drawn with one seed
TASK_ROWS = 1_048_576       # rows counted together
CHUNK = 32_768              # rows whose intermediate values fit a core's cache
WHOLE = float(2 ** 26)      # a sum of rows below, a sum of positive rows above


# --- bins ------------------------------------------------------------------------------

def _summaries(width: int):
    """Per feature the values of some rows in groups that agree in sign, exponent and the
    first 13 bits of the fraction: least and greatest value, number of rows. All rows
    count; NaN does not. Groups of several tasks merge exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered(batches, 4 * BLOCK_ROWS):
            for k in range(width):
                x = t.column(k).to_numpy().astype(float)
                x = np.sort(x[~np.isnan(x)]) + 0.0
                key = x.view(np.int64) >> 39
                starts = np.flatnonzero(np.diff(key, prepend=~key[:1]))
                ends = np.append(starts[1:], len(x))
                yield pa.record_batch([pa.array(np.full(len(starts), k, np.int32)), pa.array(key[starts]), pa.array(x[starts]),
                                       pa.array(x[ends - 1] if len(x) else x), pa.array((ends - starts)[: len(starts)])], names=["f", "g", "low", "high", "n"])
    return run


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def cut_points(low: np.ndarray, high: np.ndarray, n: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins - 1`` thresholds between groups of values: between all of them, or
    where the running number of rows passes equal shares."""
    order = np.argsort(low)
    low, high, n = low[order], high[order], n[order]
    if len(low) <= bins:
        at = np.arange(max(len(low) - 1, 0))
    else:
        at = np.searchsorted(np.cumsum(n), np.arange(1, bins) * (n.sum() / bins), side="left")
        at = np.unique(at[at < len(low) - 1])
    below, above = high[at], low[at + 1]
    with np.errstate(invalid="ignore"):
        middle = below / 2 + above / 2
    return np.where((middle >= below) & (middle < above), middle, below)


def thresholds(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """The cut points of each feature; how the rows lie changes nothing."""
    def cut(group: pa.Table) -> pa.Table:
        c = cut_points(*[group[x].to_numpy() for x in ("low", "high", "n")], bins)
        return pa.table({"f": pa.array([group["f"][0].as_py()], pa.int32()), "cuts": pa.array([c.tolist()], pa.list_(pa.float64()))})
    parts = rows.select(*features).mapInArrow(_summaries(len(features)), "f int, g long, low double, high double, n long")
    groups = parts.groupBy("f", "g").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    found = {r["f"]: r["cuts"] for r in groups.groupBy("f").applyInArrow(cut, "f int, cuts array<double>").collect()}   # a row a feature
    return [np.array(found.get(k, []), float) for k in range(len(features))]


# --- rows as bytes ------------------------------------------------------------------------

def _as_bytes(cuts: list[np.ndarray]):
    """(hash, one byte per feature - the number of thresholds below its value, NaN above
    all - and the label's)."""
    width = len(cuts) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, width), np.uint8)
            for k, c in enumerate(cuts):
                x[:, k] = np.searchsorted(c, b.column(k).to_numpy(zero_copy_only=False).astype(float), side="left")
            x[:, -1] = b.column(width - 1).to_numpy(zero_copy_only=False)
            ends = np.arange(0, (b.num_rows + 1) * width, width, dtype=np.int32)
            rows = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(x)])
            yield pa.record_batch([b.column(width), rows], names=["h", "row"])
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    held, n, number = [], 0, 0

    def block(rows: list[bytes]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([b"".join(rows)], pa.binary())],
                               names=["part", "number", "rows"])
    for b in batches:
        at = 0
        while at < b.num_rows:
            some = b.column(1).slice(at, BLOCK_ROWS - n).to_pylist()
            held += some
            n, at = n + len(some), at + len(some)
            if n == BLOCK_ROWS:
                yield block(held)
                held, n, number = [], 0, number + 1
    if n:
        yield block(held)


# --- a level -------------------------------------------------------------------------------

def _poisson_table() -> tuple[np.ndarray, np.ndarray]:
    """The distribution function of Poisson(1), and the count of each 1/65,536 of the
    unit interval (255: a step of the function is inside)."""
    p = np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 25.0)]))
    steps = np.cumsum(p)
    low = np.searchsorted(steps, np.arange(65_536) / 65_536, side="right")
    high = np.searchsorted(steps, np.arange(1, 65_537) / 65_536, side="right")
    return steps, np.where(low == high, low, 255).astype(np.uint8)


def bag(seed: Sequence[int], rows: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How often each of a block's rows is in a tree's bag."""
    steps, counts = table
    rng = np.random.Generator(np.random.SFC64(np.random.SeedSequence(list(seed))))
    cell = rng.bit_generator.random_raw(-(-rows // 4)).astype("<u8").view("<u2")[:rows]
    w = counts.take(cell)
    on_step = np.flatnonzero(w == 255)
    w[on_step] = np.searchsorted(steps, (cell[on_step] + rng.random(len(on_step))) / 65_536, side="right")
    return w


def _counts(level: int, seed: int, width: int, feature: np.ndarray, cut: np.ndarray, slots: np.ndarray, drawn: list[np.ndarray]):
    """Per tree and open node, the rows and the positive rows in each bin of the node's
    drawn features. ``feature`` and ``cut``: by tree and node (1: the root, 2n and 2n + 1:
    the children of n; ``width - 1`` and 255 at a leaf). ``slots``: by tree and node of
    the level, its place among the tree's open nodes, -1 for none. ``drawn``: per tree,
    a row of features for each open node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _poisson_table()
        for t in _gathered_blocks(batches, width):
            x = np.concatenate([np.frombuffer(r, np.uint8) for *_, r in t])
            label = np.ascontiguousarray(x[width - 1:: width])
            for tree, own in enumerate(drawn):
                if len(own):
                    w = np.concatenate([bag((seed, tree, part, number), len(r) // width, table) for part, number, r in t])
                    yield _sent(tree, _count_tree(x, label, w, level, width, feature[tree], cut[tree], slots[tree], own))
    return run


def _gathered_blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple[int, int, bytes]]]:
    held, n = [], 0
    for b in batches:
        for part, number, rows in zip(*[b.column(k).to_pylist() for k in range(3)], strict=True):
            held.append((part, number, rows))
            n += len(rows) // width
            if n >= TASK_ROWS:
                yield held
                held, n = [], 0
    if held:
        yield held


def _count_tree(x: np.ndarray, label: np.ndarray, w: np.ndarray, level: int, width: int, feature: np.ndarray, cut: np.ndarray,
                slots: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """(open nodes, drawn features, bins) of sums: rows, and ``WHOLE`` times positive rows."""
    inside = np.flatnonzero(w > 0)
    columns = [np.ascontiguousarray(drawn[:, j]).astype(np.intp) for j in range(drawn.shape[1])]
    of_code = np.arange(512) // 2 * (1.0 + WHOLE * (np.arange(512) % 2))
    keys, weights, n = np.empty((len(columns), len(inside)), np.intp), np.empty(len(inside)), 0
    for start in range(0, len(inside), CHUNK):
        some = inside[start: start + CHUNK]
        v = of_code.take(2 * w.take(some).astype(np.intp) + label.take(some), mode="clip")
        base = some * width
        node = np.ones(len(base), np.intp)
        at, g = np.empty_like(node), np.empty(len(base), np.uint8)
        for _ in range(level):
            np.take(feature, node, out=at, mode="clip")
            at += base
            b = x.take(at, mode="clip")
            np.greater(b, np.take(cut, node, out=g, mode="clip"), out=g.view(bool))
            node += node
            node += g
        node -= 1 << level
        slot = slots.take(node, mode="clip")
        open_ = np.flatnonzero(slot >= 0)
        if len(open_) < len(slot):
            slot, base, v = slot[open_], base[open_], v[open_]
        m = len(slot)
        weights[n: n + m] = v
        first, at = slot * BINS, at[:m]
        for j, c in enumerate(columns):
            np.take(c, slot, out=at, mode="clip")
            at += base
            np.add(x.take(at, mode="clip"), first, out=keys[j, n: n + m])
        n += m
    size = len(drawn) * BINS
    return np.stack([np.bincount(k[:n], weights=weights[:n], minlength=size).reshape(-1, BINS) for k in keys], axis=1)


def _sent(tree: int, sums: np.ndarray) -> pa.RecordBatch:
    """(tree, slot, counts), the counts as bytes: rows per bin, then positive rows."""
    positive = np.floor(sums / WHOLE)
    counts = np.stack([sums - positive * WHOLE, positive], axis=1)
    counts = counts.astype("<u2" if counts.max(initial=0) < 65_536 else "<u4").reshape(len(sums), -1)
    size = counts.shape[1] * counts.itemsize
    ends = np.arange(0, (len(sums) + 1) * size, size, dtype=np.int32)
    return pa.record_batch([pa.array(np.full(len(sums), tree, np.int32)), pa.array(np.arange(len(sums), dtype=np.int32)),
                            pa.Array.from_buffers(pa.binary(), len(sums), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(counts))])],
                           names=["tree", "slot", "counts"])


BEST = "tree int, slot int, which int, cut int, gain double, n double, p double, n_left double, p_left double"


def _best(k: int):
    """Adds the counts of each node and finds the split with the greatest gain (-1: no
    split has rows on both sides)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for tree, slot, counts in zip(*[b.column(c).to_pylist() for c in range(3)], strict=True):
                a = np.frombuffer(counts, "<u2" if len(counts) == 4 * k * BINS else "<u4")
                if (tree, slot) in sums:
                    sums[tree, slot] += a
                else:
                    sums[tree, slot] = a.astype(np.int64)
        nodes = list(sums)
        for start in range(0, len(nodes), 512):
            some = nodes[start: start + 512]
            yield best_splits(some, np.stack([sums[s] for s in some]).reshape(len(some), 2, k, BINS))
    return run


def best_splits(nodes: list[tuple[int, int]], counts: np.ndarray) -> pa.RecordBatch:
    """``counts``: (nodes, rows / positive rows, features, bins)."""
    left = np.cumsum(counts, axis=3, dtype=float)
    n, p = left[:, 0, :, -1:], left[:, 1, :, -1:]
    n_left, p_left = left[:, 0], left[:, 1]
    n_right, p_right = n - n_left, p - p_left

    def gini(rows, positive):
        share = positive / np.maximum(rows, 1)
        return 2 * share * (1 - share)
    gain = gini(n, p) - n_left / np.maximum(n, 1) * gini(n_left, p_left) - n_right / np.maximum(n, 1) * gini(n_right, p_right)
    gain = np.where((n_left > 0) & (n_right > 0), gain, -1.0).reshape(len(nodes), -1)
    at, each = gain.argmax(axis=1), np.arange(len(nodes))
    which, cut = at // counts.shape[3], at % counts.shape[3]
    tree, slot = np.array(nodes, np.int32).T
    columns = [tree, slot, which.astype(np.int32), cut.astype(np.int32), gain[each, at], n[:, 0, 0], p[:, 0, 0],
               n_left[each, which, cut], p_left[each, which, cut]]
    return pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=[c.split()[0] for c in BEST.split(", ")])


# --- the forest -----------------------------------------------------------------------------

class Forest:
    """Trees as arrays by tree and node number, as ``_counts`` reads them."""

    def __init__(self, trees: int, depth: int, width: int):
        self.trees, self.depth, self.width = trees, depth, width
        shape = (trees, 2 ** (depth + 1))
        self.feature, self.cut = np.full(shape, width - 1, np.intp), np.full(shape, 255, np.uint8)
        self.gain, self.n, self.p = np.full(shape, -1.0), np.zeros(shape), np.zeros(shape)
        self.open = np.ones((trees, 1), bool)      # by tree and node of the level that comes next


def grow(blocks: DataFrame, tasks: int, features: int, trees: int, depth: int, seed: int) -> Forest:
    """All trees from ``blocks`` (part, number, rows), a pass per level."""
    width, k = features + 1, max(1, int(np.ceil(np.sqrt(features))))
    forest = Forest(trees, depth, width)
    for level in range(depth):
        first = 1 << level
        places = [np.flatnonzero(o) for o in forest.open]
        if not sum(map(len, places)):
            break
        slots = np.where(forest.open, np.cumsum(forest.open, axis=1) - 1, -1).astype(np.intp)
        rng = np.random.default_rng([seed, level])
        drawn = [np.sort(rng.random((len(p), features)).argsort(axis=1)[:, :k], axis=1) for p in places]
        counts = blocks.coalesce(tasks).mapInArrow(
            _counts(level, seed, width, forest.feature[:, : 2 * first], forest.cut[:, : 2 * first], slots, drawn), "tree int, slot int, counts binary")
        best = counts.repartition(tasks, "tree", "slot").mapInArrow(_best(k), BEST).toArrow()   # a row an open node
        tree, slot, which, cut, gain, n, p, n_left, p_left = (c.to_numpy() for c in best.columns)
        forest.open = np.zeros((trees, 2 * first), bool)
        place = np.array([places[t][s] for t, s in zip(tree, slot, strict=True)], np.intp)
        node = first + place
        forest.n[tree, node], forest.p[tree, node] = n, p
        split = gain > 0
        t, node, place = tree[split], node[split], place[split]
        forest.gain[t, node], forest.cut[t, node] = gain[split], cut[split]
        forest.feature[t, node] = [drawn[a][b][c] for a, b, c in zip(t, slot[split], which[split], strict=True)]
        n, p, n_left, p_left = n[split], p[split], n_left[split], p_left[split]
        for side, rows, positive in ((0, n_left, p_left), (1, n - n_left, p - p_left)):
            child = 2 * node + side
            forest.n[t, child], forest.p[t, child] = rows, positive
            forest.open[t, 2 * place + side] = (positive > 0) & (positive < rows) & (level + 1 < depth)
    return forest


def node_table(forest: Forest, cuts: list[np.ndarray]) -> pa.Table:
    """The trees as Spark ML saves them: nodes in preorder from 0; a split whose two
    children come to be leaves of one class is a leaf."""
    columns: dict[str, list] = {c: [] for c in ("tree", "id", "prediction", "impurity", "stats", "n", "gain", "left", "right", "feature", "threshold")}
    for tree in range(forest.trees):
        feature, n, p = forest.feature[tree], forest.n[tree], forest.p[tree]
        predicted = (p > n - p).astype(float)
        leaf = feature == forest.width - 1
        for node in range(2 ** forest.depth - 1, 0, -1):
            if not leaf[node] and leaf[2 * node] and leaf[2 * node + 1] and predicted[2 * node] == predicted[2 * node + 1]:
                leaf[node] = True
        order, stack = [], [1]
        while stack:
            node = stack.pop()
            order.append(node)
            if not leaf[node]:
                stack += [2 * node + 1, 2 * node]
        number = {node: i for i, node in enumerate(order)}
        for node in order:
            inner, share = not leaf[node], p[node] / max(n[node], 1.0)
            columns["tree"].append(tree)
            columns["id"].append(number[node])
            columns["prediction"].append(predicted[node])
            columns["impurity"].append(2 * share * (1 - share))
            columns["stats"].append([n[node] - p[node], p[node]])
            columns["n"].append(int(n[node]))
            columns["gain"].append(forest.gain[tree, node] if inner else -1.0)
            columns["left"].append(number[2 * node] if inner else -1)
            columns["right"].append(number[2 * node + 1] if inner else -1)
            columns["feature"].append(int(feature[node]) if inner else -1)
            columns["threshold"].append([float(cuts[feature[node]][forest.cut[tree, node]])] if inner else [])
    number = {c: pa.array(columns[c], pa.int32()) for c in ("tree", "id", "left", "right", "feature")}
    real = {c: pa.array(columns[c], pa.float64()) for c in ("prediction", "impurity", "gain")}
    split = pa.StructArray.from_arrays([number["feature"], pa.array(columns["threshold"], pa.list_(pa.float64())), pa.array(np.full(len(columns["n"]), -1, np.int32))],
                                       ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    data = pa.StructArray.from_arrays([number["id"], real["prediction"], real["impurity"], pa.array(columns["stats"], pa.list_(pa.float64())),
                                       pa.array(columns["n"], pa.int64()), real["gain"], number["left"], number["right"], split],
                                      ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.table({"treeID": number["tree"], "nodeData": data})


def as_model(spark: SparkSession, estimator: RandomForestClassifier, features: int, nodes: pa.Table) -> RandomForestClassificationModel:
    """Spark ML's model of these nodes: the saved form of one fitted by ``estimator`` on
    two rows, which brings the parameters, with the nodes in place of its own."""
    two = spark.createDataFrame([(Vectors.dense([float(y)] * features), float(y)) for y in (0, 1)], [estimator.getFeaturesCol(), estimator.getLabelCol()])
    path = work_dir(spark, "forest")
    estimator.fit(two).write().save(f"{path}/of-two-rows")
    spark.read.text(f"{path}/of-two-rows/metadata").coalesce(1).write.text(f"{path}/fitted/metadata")
    spark.read.parquet(f"{path}/of-two-rows/treesMetadata").write.parquet(f"{path}/fitted/treesMetadata")
    spark.createDataFrame(nodes).write.parquet(f"{path}/fitted/data")
    return RandomForestClassificationModel.load(f"{path}/fitted")


def fit_forest(rows: DataFrame, features: Sequence[str], label: str, estimator: RandomForestClassifier, parts: int, rows_hash: Column,
               count: int) -> RandomForestClassificationModel:
    """Fits ``estimator`` (bins, trees, depth, seed) to rows whose label is 0 or 1, laid
    out in ``parts`` parts by ``rows_hash``."""
    x = [F.col(c).cast("double").alias(c) for c in features]
    cuts = thresholds(rows.select(*x), features)
    coded = rows.select(*x, F.col(label).cast("int").alias(label), rows_hash.alias("h")).mapInArrow(_as_bytes(cuts), "h long, row binary")
    blocks = coded.repartition(parts, "h").sortWithinPartitions("h", "row").mapInArrow(_blocks, "part int, number int, rows binary")
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tasks = max(1, min(parts, -(-count // TASK_ROWS) if count > 32 * TASK_ROWS else 32))
        forest = grow(blocks, tasks, len(features), estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed())
    finally:
        blocks.unpersist()
    return as_model(rows.sparkSession, estimator, len(features), node_table(forest, cuts))
