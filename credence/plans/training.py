"""Model training, evaluation and persistence.

Models are ``pyspark.ml`` pipelines: a ``VectorAssembler`` over the 17 model
features by name (label codes enter as plain numbers, no one-hot) and a
random forest or a logistic regression. The training input is persisted for
the iterative fit only and released afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import confidence_band
from ..operators.metrics import binary_metrics, roc_auc
from ..session import materialize
from . import forest_fit
from .catalog import Catalog
from .model_tables import ModelTable, save_table

MODEL_TYPES = ("random_forest", "logistic_regression")


def assembler(features: Sequence[str] = spec.ALL_FEATURES, out: str = "features") -> VectorAssembler:
    """L4: the feature vector, assembled by column name."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def make_estimator(model_type: str = "random_forest", n_train: int | None = None,
                   n_estimators: int = spec.RF_TREES, max_depth: int = spec.RF_DEPTH,
                   random_state: int = spec.SEED, label: str = spec.TARGET):
    """L1 / L2. Any other model type is an error.

    Random forest: ``numTrees``, ``maxDepth``, sqrt(d) features per split,
    seeded. Splits are binned (``maxBins``), so compare metrics, not trees.
    Logistic regression: the objective of L2-penalised LR with C=1 is Spark's
    with ``regParam = 1/n``, no elastic net and no standardisation."""
    if model_type == "random_forest":
        return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=n_estimators,
                                      maxDepth=max_depth, maxBins=128, seed=random_state,
                                      featureSubsetStrategy="sqrt", maxMemoryInMB=1024,
                                      cacheNodeIds=True, checkpointInterval=10)
    if model_type == "logistic_regression":
        if not n_train:
            raise ValueError("logistic regression needs the training row count")
        return LogisticRegression(labelCol=label, featuresCol="features", regParam=1.0 / n_train,
                                  elasticNetParam=0.0, standardization=False, maxIter=spec.LR_MAX_ITER)
    raise ValueError(f"Unsupported model type: {model_type}")


# partitions of the training rows unless the caller names a number: as many as
# TRAIN_PARTITIONS, and more where they would hold above ROWS_PER_PARTITION rows
TRAIN_PARTITIONS = 32
ROWS_PER_PARTITION = 250_000


def train_partitions(rows: int) -> int:
    return max(TRAIN_PARTITIONS, -(-rows // ROWS_PER_PARTITION))


# with more rows a forest is grown by ``forest_fit``: Spark's own fit caches some 1.9 KB
# a row. Up to them the parts, and so the forests, are those of Spark's fit
GROW_ROWS = TRAIN_PARTITIONS * ROWS_PER_PARTITION


def train(train_df: DataFrame, model_type: str = "random_forest",
          features: Sequence[str] = spec.ALL_FEATURES, partitions: int | None = None, **hyper) -> PipelineModel:
    """Fits assembler + classifier. The forest draws its bags by partition, so
    the rows are laid out by a hash of their key (of their values, without a
    key) into ``partitions`` parts and ordered inside them: the model depends
    on that number (record it with the run), not on the cores or the input's
    files. By default it follows from the number of rows (``train_partitions``),
    so that no task holds more bagged rows at more rows. The input is persisted
    during the fit."""
    cols = list(features) + [spec.TARGET]
    keys = [spec.KEY] if spec.KEY in train_df.columns else cols
    labelled = train_df.where(F.col(spec.TARGET).isNotNull())
    n, others = labelled.agg(F.count(F.lit(1)), F.count_if(~F.col(spec.TARGET).cast("double").isin(0.0, 1.0))).first()
    if model_type == "random_forest" and n > GROW_ROWS and not others and hyper.get("max_depth", spec.RF_DEPTH) <= forest_fit.MAX_DEPTH:
        est = make_estimator(model_type, **hyper)
        grown = forest_fit.fit_forest(labelled, features, spec.TARGET, est, partitions or train_partitions(n),
                                      F.xxhash64(*dict.fromkeys([*keys, *cols])), n)
        return PipelineModel([assembler(features), grown])
    data = labelled.withColumn(spec.TARGET, F.col(spec.TARGET).cast("double")) \
        .select(*cols, F.xxhash64(*keys).alias("_h")).repartition(partitions or train_partitions(n), "_h") \
        .sortWithinPartitions("_h", *cols).select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        est = make_estimator(model_type, n_train=n, **hyper)
        return Pipeline(stages=[assembler(features), est]).fit(data)
    finally:
        data.unpersist()


def predict(model: PipelineModel | ModelTable, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Class as int and P(class 1), plus the P14 confidence band. A forest scores
    by its table, a batch of rows at a time: row by row, its nodes don't stay in a
    core's cache."""
    if isinstance(model, ModelTable):
        return model.predict(df, keep)
    if hasattr(model.stages[-1], "featureImportances"):
        return ModelTable.of(model).predict(df, keep)
    return transform_predict(model, df, keep)


def transform_predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """L5 by the model's own ``transform``."""
    scored = model.transform(df)
    p1 = vector_to_array(F.col("probability"))[1]
    return scored.select(*[F.col(c) for c in keep],
                         F.col("prediction").cast("int").alias(spec.TARGET),
                         p1.alias("approval_probability"),
                         confidence_band(p1).alias("confidence"))


def evaluate(model: PipelineModel, df: DataFrame, prefix: str) -> DataFrame:
    """Metrics ``(metric, value)``: ``<prefix>_{accuracy,precision,recall,f1,auc}``.
    The set is scored once, as ``predict`` scores it; all metrics read the
    written (label, class, probability) rows."""
    rows = df.where(F.col(spec.TARGET).isNotNull()).withColumn("_y", F.col(spec.TARGET).cast("int"))
    s = materialize(predict(model, rows, keep=["_y"]).select(
        F.col("_y").alias("y"), F.col(spec.TARGET).alias("p"), F.col("approval_probability").alias("prob")))
    m = binary_metrics(s, "y", "p")
    auc = roc_auc(s, "y", "prob")
    long = m.select(F.explode(F.array(*[
        F.struct(F.lit(f"{prefix}_{c}").alias("metric"), F.col(c).alias("value")) for c in m.columns
    ])).alias("s")).select("s.*")
    return long.unionByName(auc.select(F.lit(f"{prefix}_auc").alias("metric"), F.col("auc").alias("value")))


def train_and_evaluate(train_df: DataFrame, val_df: DataFrame, model_type: str = "random_forest",
                       catalog: Catalog | None = None, run_id: str | None = None, **hyper) -> tuple[PipelineModel, DataFrame]:
    """Fit on train, metric record on train and validation. With a catalog the
    run's parameters and metrics are logged under ``run_id`` (C6), and the record
    returned is the logged one."""
    model = train(train_df, model_type, **hyper)
    metrics = evaluate(model, train_df, "train").unionByName(evaluate(model, val_df, "val"))
    if catalog is not None:
        run_id = run_id or f"{model_type}-{uuid.uuid4().hex[:12]}"
        defaults = {"model_type": model_type, "partitions": train_partitions(train_df.where(F.col(spec.TARGET).isNotNull()).count())}
        if model_type == "random_forest":
            defaults |= {"n_estimators": spec.RF_TREES, "max_depth": spec.RF_DEPTH, "random_state": spec.SEED}
        catalog.log_run(run_id, defaults | hyper, metrics)
        metrics = catalog.run_metrics(run_id)
    return model, metrics


def feature_importances(model: PipelineModel, top: int = 20) -> DataFrame:
    """Top-``top`` importances, descending (name breaks ties). The
    importance vector has one entry per feature (17 here)."""
    clf = model.stages[-1]
    if not hasattr(clf, "featureImportances"):
        raise ValueError("model has no feature importances")
    names = model.stages[0].getInputCols()
    imp = [float(x) for x in clf.featureImportances.toArray().tolist()]
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(names, imp)), "feature string, importance double")
    # a top-k report: the limit is the feature
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(top)


def save_model(model: PipelineModel, path: str) -> None:
    """L3, with the model's table in ``path``/table."""
    model.write().overwrite().save(path)
    save_table(model, path)


def load_model(path: str) -> PipelineModel:
    """L3."""
    return PipelineModel.load(path)
