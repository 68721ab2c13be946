"""Model tests: the LR objective, the performance gate and
save/load."""

import numpy as np
from pyspark.sql import functions as F

from credence import spec
from credence.fixtures import applications
from credence.operators.gates import performance_gate
from credence.operators.split import stratified_split
from credence.plans.preprocess import preprocess
from credence.plans.training import evaluate, load_model, predict, save_model, train
from credence.session import work_dir


def _sets(spark, sf):
    processed, _ = preprocess(applications(spark, sf))
    s = stratified_split(processed, spec.TARGET, spec.KEY).cache()
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")


def test_lr_solves_the_c1_objective(spark, sf):
    """At Spark's solution with regParam = 1/n (no standardisation), the
    gradient of  sum(logloss) + 0.5 * ||w||^2  (intercept unpenalised) is ~0."""
    tr, _ = _sets(spark, sf)
    model = train(tr, "logistic_regression")
    lr = model.stages[-1]
    pdf = tr.select(*spec.ALL_FEATURES, spec.TARGET).toPandas()   # small fixture, test-only brute force
    x = pdf[spec.ALL_FEATURES].to_numpy(float)
    y = pdf[spec.TARGET].to_numpy(float)
    w = lr.coefficients.toArray()
    b = lr.intercept
    p = 1.0 / (1.0 + np.exp(-(x @ w + b)))
    grad_w = x.T @ (p - y) + w
    grad_b = float(np.sum(p - y))
    scale = np.abs(x.T @ y).max()
    assert np.abs(grad_w).max() / scale < 1e-3 and abs(grad_b) / len(y) < 1e-3


def test_models_pass_the_performance_gate_and_round_trip(spark, sf):
    tr, va = _sets(spark, sf)
    for kind in ("logistic_regression", "random_forest"):
        model = train(tr, kind, **({"n_estimators": 20} if kind == "random_forest" else {}))
        g = performance_gate(evaluate(model, va, "val")).first()
        assert g["passed"], g["issues"]
    path = work_dir(spark, "test-model")
    save_model(model, path)
    a = predict(model, va, keep=[spec.KEY]).orderBy(spec.KEY).collect()
    b = predict(load_model(path), va, keep=[spec.KEY]).orderBy(spec.KEY).collect()
    assert a == b
