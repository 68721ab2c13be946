"""Models as tables (L2, L3, L5, T1): forest nodes and linear coefficients that any
SQL engine can score with, and a logistic regression fitted by Newton steps.

A forest is a row per node: its tree, the feature and threshold it splits at, its
children, and the share of class 1 among the training rows that reached it. A row
is scored by walking from each tree's first node to a leaf (at most the threshold:
left; more, NaN or NULL: right) and averaging the leaves' shares. A linear model is
a row per feature and one for the intercept.

Scoring has no shuffle and no join: the nodes, whose size is that of the model (100
trees of depth 10: some MB), come to the tasks, which walk a batch of rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..functions.columns import confidence_band
from ..session import work_dir

INTERCEPT = "(intercept)"
MAX_STEPS, TOLERANCE = 50, 1e-9


def forest_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """(tree, node, feature, threshold, left, right, rows, gain, p1) of a saved
    forest pipeline (L3); a leaf has neither feature nor children."""
    names = PipelineModel.load(model_path).stages[0].getInputCols()
    n = spark.read.parquet(f"{model_path}/stages/1_*/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    if not n.where(inner & (F.col("split.numCategories") >= 0)).isEmpty():
        raise ValueError("splits by sets of categories have no threshold")
    stats = F.col("impurityStats")
    return n.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(inner, F.get(F.array(*[F.lit(c) for c in names]), F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.reduce(stats, F.lit(0.0), lambda a, x: a + x).alias("rows"), F.when(inner, F.col("gain")).alias("gain"),
        (F.get(stats, F.lit(1)) / F.reduce(stats, F.lit(0.0), lambda a, x: a + x)).alias("p1"))


def linear_table(spark: SparkSession, names: Sequence[str], coefficients: Sequence[float], intercept: float) -> DataFrame:
    """(feature, coefficient), the intercept under ``INTERCEPT``."""
    rows = [*zip(names, map(float, coefficients), strict=True), (INTERCEPT, float(intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def save_table(model: PipelineModel, model_path: str) -> str:
    """Writes the table of a saved model into its folder; returns the table's path."""
    spark = SparkSession.getActiveSession()
    path = f"{model_path}/table"
    last = model.stages[-1]
    table = forest_nodes(spark, model_path) if hasattr(last, "featureImportances") else linear_table(
        spark, model.stages[0].getInputCols(), last.coefficients.toArray().tolist(), last.intercept)
    table.write.mode("overwrite").parquet(path)
    return path


class ModelTable:
    """A model to ``predict`` with, from its table."""

    def __init__(self, table: DataFrame):
        self.table = table
        self.is_forest = "threshold" in table.columns

    @classmethod
    def load(cls, spark: SparkSession, model_path: str) -> ModelTable:
        return cls(spark.read.parquet(f"{model_path}/table"))

    @classmethod
    def of(cls, model: PipelineModel) -> ModelTable:
        """The table of a model, written once and kept with it."""
        if not hasattr(model, "_table_path"):
            path = work_dir(SparkSession.getActiveSession(), "model-of-table")
            model.write().save(path)
            model._table_path = save_table(model, path)
        return cls(SparkSession.getActiveSession().read.parquet(model._table_path))

    def with_probability(self, df: DataFrame, name: str, keep: Sequence[str], features: Sequence[str] = spec.ALL_FEATURES) -> DataFrame:
        """The kept columns and P(class 1)."""
        if not self.is_forest:
            return df.select(*keep, self._linear().alias(name))
        x = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)]
        rows = df.select(F.struct(*keep).alias("_keep") if keep else F.lit(0).alias("_keep"), *x)
        kept = T.StructType([rows.schema["_keep"], T.StructField(name, T.DoubleType())])
        scored = rows.mapInArrow(_mean_of_leaves(self._flat(features), len(features), name), kept)
        return scored.select(*[F.col("_keep")[c].alias(c) for c in keep], name)

    def _linear(self) -> Column:
        found = {r["feature"]: r["coefficient"] for r in self.table.collect()}   # a row a feature
        z = F.lit(found.pop(INTERCEPT))
        for c, w in found.items():
            z = z + F.col(c).cast("double") * F.lit(w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def _flat(self, features: Sequence[str]) -> dict[str, np.ndarray]:
        """The nodes of all trees, numbered through: the first node of each tree; per
        node its feature's place (-1: none), threshold, right and left child, and share
        (a leaf leads to itself). Some MB, whatever the rows to score."""
        at = F.array_position(F.array(*[F.lit(c) for c in features]), F.col("feature")) - 1
        t = self.table.select("tree", "node", F.coalesce(at, F.lit(-1)).cast("int").alias("f"), F.coalesce("threshold", F.lit(0.0)).alias("t"),
                              F.coalesce("right", F.col("node")).alias("r"), F.coalesce("left", F.col("node")).alias("l"), "p1")
        n = {c: v.to_numpy() for c, v in zip(t.columns, t.orderBy("tree", "node").toArrow().columns, strict=True)}
        if not len(n["tree"]):
            raise ValueError("the table has no trees")
        # nodes are numbered from 0 in each tree
        first, of_tree = np.unique(n["tree"], return_index=True)[1], np.unique(n["tree"], return_inverse=True)[1]
        if not np.array_equal(n["node"], np.arange(len(of_tree)) - first[of_tree]):
            raise ValueError("a tree's nodes must be numbered from 0")
        children = np.stack([n["r"] + first[of_tree], n["l"] + first[of_tree]], axis=1).astype(np.int64)
        return {"first": first, "f": n["f"].astype(np.int64), "t": n["t"], "children": children.ravel(), "p1": n["p1"]}

    def depth(self) -> int:
        """Length of the longest path, level by level: a join of nodes each."""
        links = self.table.where("feature is not null").select(
            "tree", "node", F.explode(F.array("left", "right")).alias("child"))
        level, n = self.table.where("node = 0").select("tree", "node"), 0
        while not (level := level.join(links, ["tree", "node"]).select("tree", F.col("child").alias("node"))).isEmpty():
            n += 1
        return max(n, 1)

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """L5, as ``training.predict`` returns it."""
        scored = self.with_probability(df, "approval_probability", keep)
        p = F.col("approval_probability")
        return scored.select(*keep, (p > 0.5).cast("int").alias(spec.TARGET), p, confidence_band(p).alias("confidence"))

    def importances(self) -> DataFrame:
        """Every split's gain by the rows it splits, per feature as a share of
        its tree, averaged over the trees that split at all, as a share of all."""
        split = self.table.where("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
        total = split.groupBy("tree").agg(F.sum("g").alias("t"))
        by = split.join(total, "tree").where("t > 0").groupBy("feature").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
        return by.select("feature", (F.col("s") / by.agg(F.sum("s")).scalar()).alias("importance"))


def _mean_of_leaves(nodes: dict[str, np.ndarray], width: int, name: str):
    """Per row the mean share of the leaves that its ``width`` values come to, all rows
    of a batch a step at a time."""
    first, t, children, p1 = (nodes[k] for k in ("first", "t", "children", "p1"))
    f = np.where(nodes["f"] < 0, width, nodes["f"])   # the last column is no feature's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.full((b.num_rows, width + 1), np.nan)
            for k in range(width):
                x[:, k] = b.column(f"_x{k}").to_numpy(zero_copy_only=False)
            x, start, total = x.ravel(), np.arange(b.num_rows) * (width + 1), np.zeros(b.num_rows)
            for root in first:
                at = np.full(b.num_rows, root)
                for _ in range(len(p1)):
                    there = children[2 * at + (x[start + f[at]] <= t[at])]   # NaN: right
                    if np.array_equal(there, at):
                        break
                    at = there
                total += p1[at]
            yield pa.record_batch([b.column("_keep"), pa.array(total / len(first))], names=["_keep", name])
    return run


# --- logistic regression by Newton steps ----------------------------------------------

def _sums(features: Sequence[str], label: str, beta: np.ndarray):
    """Partial sums of a task at ``beta``: rows, loss, gradient, Hessian."""
    d = len(features) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + d + d * d)
        for b in batches:
            x = np.ones((b.num_rows, d))
            for k, c in enumerate(features):
                x[:, k] = b.column(c).to_numpy(zero_copy_only=False)
            y = b.column(label).to_numpy(zero_copy_only=False)
            z = x @ beta
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            total[0] += len(y)
            total[1] += float(np.sum(np.logaddexp(0, z) - y * z))
            total[2: 2 + d] += x.T @ (p - y)
            total[2 + d:] += (x.T @ (x * (p * (1 - p))[:, None])).ravel()
        yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])
    return run


def at_coefficients(df: DataFrame, beta: np.ndarray, features: Sequence[str] = spec.ALL_FEATURES, label: str = spec.TARGET,
                    penalty: float = 1.0) -> tuple[int, float, np.ndarray, np.ndarray]:
    """(rows, objective, gradient, Hessian): the log-loss over all rows plus half the
    penalty times the squared coefficients; the intercept, the last one, is free."""
    rows = df.where(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in features],
                                                     F.col(label).cast("double").alias(label))
    parts = rows.mapInArrow(_sums(features, label, beta), "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
    found = {r["i"]: r["v"] for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect()}   # d * d numbers
    d = len(features) + 1
    s = np.array([found.get(i, 0.0) for i in range(2 + d + d * d)])
    if not np.isfinite(s).all():
        raise ValueError("features must be numbers: impute and scale them first")
    free = np.append(np.full(d - 1, penalty), 0.0)
    return (int(s[0]), float(s[1] + 0.5 * np.sum(free * beta * beta)), s[2: 2 + d] + free * beta,
            s[2 + d:].reshape(d, d) + np.diag(free))


def fit_logistic(df: DataFrame, features: Sequence[str] = spec.ALL_FEATURES, label: str = spec.TARGET,
                 penalty: float = 1.0) -> tuple[DataFrame, int]:
    """L2 by Newton steps, each one aggregate over the rows; steps that don't lower
    the objective are halved. Returns the coefficients' table and the number of
    passes. The objective is strictly convex but for the intercept, so a gradient of
    zero is the optimum."""
    spark = df.sparkSession
    beta = np.zeros(len(features) + 1)
    n, value, gradient, hessian = at_coefficients(df, beta, features, label, penalty)
    if not n:
        raise ValueError("no labelled rows")
    passes = 1
    while passes < MAX_STEPS and np.abs(gradient).max() > TOLERANCE * n:
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        size = 1.0
        while True:
            there = at_coefficients(df, beta - size * step, features, label, penalty)
            passes += 1
            if there[1] <= value + 1e-12 * abs(value) or size < 1e-6 or passes >= MAX_STEPS:
                break
            size /= 2
        beta, (n, value, gradient, hessian) = beta - size * step, there
    return linear_table(spark, features, beta[:-1], beta[-1]), passes


def gradient_table(df: DataFrame, table: DataFrame, label: str = spec.TARGET, penalty: float = 1.0) -> DataFrame:
    """(feature, rows, gradient) of the objective at a linear table's coefficients, by
    plain SQL sums over all rows."""
    found = {r["feature"]: r["coefficient"] for r in table.collect()}
    p = ModelTable(table)._linear()
    rows = df.where(F.col(label).isNotNull()).withColumn("_error", p - F.col(label).cast("double"))
    sums = [F.struct(F.lit(c).alias("feature"), F.count("*").alias("rows"),
                     (F.sum(F.col("_error") * (F.lit(1.0) if c == INTERCEPT else F.col(c).cast("double")))
                      + F.lit(0.0 if c == INTERCEPT else penalty * w)).alias("gradient")) for c, w in found.items()]
    return rows.agg(F.array(*sums).alias("g")).select(F.inline("g"))
