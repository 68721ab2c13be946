"""Models as tables: DuckDB scores with them; Newton's optimum."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from credence import spec
from credence.checks import q_models
from credence.plans.model_tables import INTERCEPT, ModelTable, at_coefficients, fit_logistic, gradient_table
from credence.plans.scoring import prepare_records, score_payloads
from credence.plans.training import evaluate, load_model, predict, save_model, train, train_partitions, transform_predict
from credence.session import work_dir
from credence.sources.payloads import parse_payloads

WALK = """
WITH RECURSIVE x AS (SELECT row, name, value FROM (UNPIVOT rows ON {features} INTO NAME name VALUE value)),
walk AS (SELECT r.row, n.tree, n.node, n.feature, n.threshold, n.left, n.right, n.p1 FROM rows r, nodes n WHERE n.node = 0
  UNION ALL SELECT w.row, n.tree, n.node, n.feature, n.threshold, n.left, n.right, n.p1 FROM walk w
  JOIN x ON x.row = w.row AND x.name = w.feature
  JOIN nodes n ON n.tree = w.tree AND n.node = CASE WHEN x.value <= w.threshold THEN w.left ELSE w.right END)
SELECT row, avg(p1) AS p FROM walk WHERE feature IS NULL GROUP BY row"""


def by_duckdb(spark, model_path, ready):
    """Probabilities by path look-ups in DuckDB over the written table; ready: row and
    features."""
    path = work_dir(spark, "ready")
    ready.coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW nodes AS SELECT * FROM read_parquet('{model_path}/table/*.parquet')")
    con.execute(f"CREATE VIEW rows AS SELECT row, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in spec.ALL_FEATURES)} "
                f"FROM read_parquet('{path}/*.parquet')")
    return dict(con.execute(WALK.format(features=", ".join(spec.ALL_FEATURES))).fetchall())


@pytest.fixture(scope="module")
def forest(spark, sf):
    model, params, _, va = q_models.context(spark, sf, "random_forest")
    path = work_dir(spark, "forest")
    save_model(model, path)
    return model, params, va, path


def test_duckdb_scores_validation_rows_with_the_table(spark, forest):
    model, _, va, path = forest
    want = {r["row"]: round(r["approval_probability"], 9)
            for r in predict(model, va.withColumn("row", F.col(spec.KEY)), keep=["row"]).collect()}
    got = by_duckdb(spark, path.replace("file:", ""), va.select(F.col(spec.KEY).alias("row"), *spec.ALL_FEATURES))
    assert len(want) > 100 and {k: round(v, 9) for k, v in got.items()} == want


def test_duckdb_scores_payloads_with_the_table(spark, sf, forest):
    model, params, va, path = forest
    payloads = q_models.validation_payloads(spark, sf)
    scored = score_payloads(model, params, payloads).where("error is null")
    want = {f"{r['payload_id']}/{r['record_index']}": round(r["approval_probability"], 9) for r in scored.collect()}
    parsed = parse_payloads(payloads, "payload", "payload_id", with_fills=True)
    ready = prepare_records(params, parsed, ["payload_id", "record_index", "error"], "payload").where("error is null")
    got = by_duckdb(spark, path.replace("file:", ""), ready.select(
        F.concat_ws("/", "payload_id", F.col("record_index").cast("string")).alias("row"), *spec.ALL_FEATURES))
    assert {k: round(v, 9) for k, v in got.items()} == want


def test_a_table_scores_missing_values_and_repeated_rows_as_the_model(spark, forest):
    model, _, va, path = forest
    table = ModelTable.load(spark, path)
    rows = va.limit(20)
    odd = rows.unionByName(rows).unionByName(rows.withColumn("income", F.lit(None).cast("double"))).unionByName(
        rows.withColumn("age", F.lit(float("nan"))))
    show = [spec.KEY, F.round("approval_probability", 9), spec.TARGET, "confidence"]
    assert sorted(map(str, predict(table, odd, [spec.KEY]).select(*show).collect())) == sorted(
        map(str, predict(model, odd, [spec.KEY]).select(*show).collect()))
    assert predict(table, va.limit(0), [spec.KEY]).count() == 0
    assert load_model(path).stages[-1].getNumTrees == model.stages[-1].getNumTrees   # the table is no part of the model


def test_a_forest_scores_a_batch_at_a_time(spark, forest):
    """No row carries the nodes, and the model's own transform says the same."""
    model, _, va, path = forest
    rows = va.unionByName(va.limit(5).withColumn("income", F.lit(None).cast("double")))
    show = [spec.KEY, F.round("approval_probability", 9), spec.TARGET, "confidence"]
    want = sorted(map(str, transform_predict(model, rows, [spec.KEY]).select(*show).collect()))
    for scorer in (model, ModelTable.load(spark, path)):
        scored = predict(scorer, rows, [spec.KEY])
        plan = scored._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "subquery" not in plan
        assert sorted(map(str, scored.select(*show).collect())) == want
    assert predict(model, rows).columns == [spec.TARGET, "approval_probability", "confidence"]


def test_a_forest_is_evaluated_a_batch_at_a_time(spark, forest, monkeypatch):
    """Metrics come from the batches' scores, and equal those of the model's own transform."""
    model, _, va, _ = forest
    rows = va.unionByName(va.limit(7).withColumn("income", F.lit(None).cast("double"))).unionByName(
        va.limit(5).withColumn(spec.TARGET, F.lit(None).cast("int")))
    scored = transform_predict(model, rows.withColumn("y", F.col(spec.TARGET)), ["y"]).where("y is not null").collect()
    y, p, c = (np.array([r[k] for r in scored]) for k in ("y", "approval_probability", spec.TARGET))
    better = np.sign(p[y == 1][:, None] - p[y == 0][None, :])
    want = {"val_accuracy": (y == c).mean(), "val_precision": y[c == 1].mean(), "val_recall": c[y == 1].mean(),
            "val_auc": (better / 2 + 0.5).mean()}
    monkeypatch.setattr(type(model), "transform", None)
    got = {r["metric"]: r["value"] for r in evaluate(model, rows, "val").collect()}
    assert {k: round(got[k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()} and len(got) == 5


def test_walks_of_small_tables(spark):
    kind = "tree int, node int, feature string, threshold double, left int, right int, p1 double"
    nodes = [(0, 0, "age", 1.0, 1, 2, 0.5), (0, 1, None, None, None, None, 0.25), (0, 2, None, None, None, None, 1.0),
             (3, 0, None, None, None, None, 0.5),
             (4, 0, "not_there", 9.0, 1, 2, 0.5), (4, 1, None, None, None, None, 0.0), (4, 2, None, None, None, None, 0.75)]
    rows = spark.createDataFrame([(v, 0.0) for v in (1.0, 1.5, None, float("nan"), float("-inf"))], "age double, income double")
    table = ModelTable(spark.createDataFrame(nodes, kind))
    got = [r["p"] for r in table.with_probability(rows, "p", ["age"], ["age", "income"]).collect()]
    assert got == [0.5, 0.75, 0.75, 0.75, 0.5]
    with pytest.raises(ValueError, match="no trees"):
        ModelTable(spark.createDataFrame([], kind)).with_probability(rows, "p", ["age"], ["age", "income"])


def test_partitions_follow_the_rows():
    assert train_partitions(0) == train_partitions(120_000) == 32
    assert train_partitions(43_200_000) == 173


def some_rows(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(i, *[rng.gauss((i % 2) * 0.4, 1) for _ in spec.ALL_FEATURES], i % 2 if i % 50 else None) for i in range(n)]
    return spark.createDataFrame(rows, [spec.KEY, *spec.ALL_FEATURES, spec.TARGET]).repartition(3)


def test_newton_reaches_the_optimum_in_few_passes(spark):
    df = some_rows(spark)
    table, passes = fit_logistic(df)
    assert passes < 10
    g = gradient_table(df, table).collect()
    assert [r["feature"] for r in g] == [*spec.ALL_FEATURES, INTERCEPT] and {r["rows"] for r in g} == {392}
    assert max(abs(r["gradient"]) for r in g) < 1e-6
    beta = np.array([r["coefficient"] for r in table.collect()])
    value = at_coefficients(df, beta)[1]
    rng = np.random.default_rng(2)
    assert all(at_coefficients(df, beta + rng.normal(0, 0.01, len(beta)))[1] > value for _ in range(3))


def test_newton_and_the_iterative_fit_agree(spark):
    df = some_rows(spark)
    model = train(df, "logistic_regression", partitions=2).stages[-1]
    found = {r["feature"]: r["coefficient"] for r in fit_logistic(df)[0].collect()}
    assert np.allclose([found[c] for c in spec.ALL_FEATURES], model.coefficients.toArray(), atol=2e-3)
    assert abs(found[INTERCEPT] - model.intercept) < 2e-3


def test_newton_of_odd_tables(spark):
    df = some_rows(spark, 60)
    with pytest.raises(ValueError, match="labelled"):
        fit_logistic(df.limit(0))
    with pytest.raises(ValueError, match="numbers"):
        fit_logistic(df.withColumn("age", F.lit(None).cast("double")))
    # a column that says the label, and one that says nothing
    told = df.withColumn("age", F.col(spec.TARGET) * 100.0).withColumn("income", F.lit(0.0))
    table, passes = fit_logistic(told)
    assert passes < 50 and max(abs(r["gradient"]) for r in gradient_table(told, table).collect()) < 1e-5
