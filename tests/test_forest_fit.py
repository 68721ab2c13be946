"""The forest grown level by level (L1 at size), and look-ups and files of the queries
that need it."""

import os

import numpy as np
from pyspark.sql import functions as F

from credence import spec
from credence.checks.q_models import write_payload_files
from credence.fixtures import applications
from credence.operators.encode import Dictionary, dictionary_from_distinct, encode
from credence.operators.gates import performance_gate
from credence.operators.split import stratified_split
from credence.plans import forest_fit, training
from credence.plans.preprocess import preprocess
from credence.session import work_dir


def _sets(spark, sf):
    processed, _ = preprocess(applications(spark, sf))
    s = stratified_split(processed, spec.TARGET, spec.KEY).cache()
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")


def _nodes(model):
    table = training.ModelTable.of(model).table
    return sorted(map(str, table.collect()))


def test_above_its_limit_a_forest_is_grown_from_bytes(spark, sf, monkeypatch):
    """Whole: it scores, is saved, tabled and explained as Spark's own; the files'
    layout changes nothing."""
    tr, va = _sets(spark, sf)
    asked = []
    fit = forest_fit.fit_forest
    monkeypatch.setattr(forest_fit, "fit_forest", lambda *a: asked.append(a) or fit(*a))
    monkeypatch.setattr(training, "GROW_ROWS", 0)
    model = training.train(tr, n_estimators=20, partitions=4)
    assert asked and model.stages[-1].getNumTrees == 20
    g = performance_gate(training.evaluate(model, va, "val")).first()
    assert g["passed"], g["issues"]
    a = {r[spec.KEY]: r for r in training.predict(model, va, keep=[spec.KEY]).collect()}
    b = {r[spec.KEY]: r for r in training.transform_predict(model, va, keep=[spec.KEY]).collect()}
    assert a.keys() == b.keys() and all(abs(a[k]["approval_probability"] - b[k]["approval_probability"]) < 1e-9 for k in a)
    path = work_dir(spark, "grown")
    training.save_model(model, path)
    assert training.load_model(path).stages[-1].toDebugString == model.stages[-1].toDebugString
    own = {r["feature"]: r["importance"] for r in training.ModelTable.of(model).importances().collect()}
    of_model = {r["feature"]: r["importance"] for r in training.feature_importances(model).collect()}
    assert all(abs(own.get(c, 0.0) - x) < 1e-9 for c, x in of_model.items())
    again = training.train(tr.repartition(7, "income"), n_estimators=20, partitions=4)
    assert _nodes(again) == _nodes(model)


def test_a_grown_tree_has_the_best_splits(spark):
    """One feature drawn of one: each split is the best by brute force over its bag."""
    rng = np.random.default_rng(3)
    n, cuts = 3000, [np.arange(40) / 40 + 0.0125]
    x = rng.random(n)
    y = ((x > 0.3) & (x < 0.7) ^ (rng.random(n) < 0.1)).astype(np.uint8)
    coded = np.searchsorted(cuts[0], x).astype(np.uint8)
    block = np.stack([coded, y], axis=1).tobytes()
    blocks = spark.createDataFrame([(0, 0, block)], "part int, number int, rows binary")
    forest = forest_fit.grow(blocks, 1, 1, 2, 3, 42)
    for tree in range(2):
        w = forest_fit.bag((42, tree, 0, 0), n, forest_fit._poisson_table()).astype(float)
        inside = {1: np.ones(n, bool)}
        for node in range(1, 8):
            rows = inside.get(node)
            if rows is None or forest.feature[tree, node] == 1:
                continue
            total, positive = w[rows].sum(), w[rows & (y == 1)].sum()
            assert (forest.n[tree, node], forest.p[tree, node]) == (total, positive)

            def gain(c):
                left, right, share = rows & (coded <= c), rows & (coded > c), 0.0
                for side in (left, right):
                    m, p = w[side].sum(), w[side & (y == 1)].sum()
                    if m == 0:
                        return -1.0
                    share += m / total * 2 * p / m * (1 - p / m)
                return 2 * positive / total * (1 - positive / total) - share
            gains = [gain(c) for c in range(40)]
            assert abs(forest.gain[tree, node] - max(gains)) < 1e-12
            assert abs(gains[forest.cut[tree, node]] - max(gains)) < 1e-12
            inside[2 * node], inside[2 * node + 1] = rows & (coded <= forest.cut[tree, node]), rows & (coded > forest.cut[tree, node])


def test_bags_are_poisson_draws_and_cuts_lie_between_values():
    w = forest_fit.bag((1, 2, 3, 4), 400_000, forest_fit._poisson_table())
    share = np.bincount(w, minlength=6)[:6] / len(w)
    assert np.abs(share - np.exp(-1) / np.array([1, 1, 2, 6, 24, 120])).max() < 0.003
    assert not np.array_equal(w, forest_fit.bag((1, 3, 3, 4), 400_000, forest_fit._poisson_table()))
    three, ten_thousand = np.array([2.0, 0.0, 1.0]), np.arange(10_000.0)
    assert forest_fit.cut_points(three, three, np.ones(3)).tolist() == [0.5, 1.5]
    assert forest_fit.cut_points(three[:1], three[:1], np.ones(1)).tolist() == []
    many = forest_fit.cut_points(ten_thousand, ten_thousand, np.ones(10_000))
    assert len(many) == forest_fit.BINS - 1 and np.abs(np.diff(many) - 10_000 / forest_fit.BINS).max() <= 1


def test_odd_rows_grow_a_forest(spark, monkeypatch):
    """NaN and NULL go right, a constant feature makes no split, repeated rows count."""
    monkeypatch.setattr(training, "GROW_ROWS", 0)
    rows = [(float(i % 5) if i % 7 else (None if i % 2 else float("nan")), 1.0, int(i % 7 == 0 or i % 5 == 4)) for i in range(400)]
    df = spark.createDataFrame(rows, f"a double, b double, {spec.TARGET} int")
    model = training.train(df, features=["a", "b"], n_estimators=5)
    table = training.ModelTable.of(model)
    assert {r["feature"] for r in table.table.where("feature is not null").collect()} <= {"a"}
    scored = table.with_probability(df, "p", [spec.TARGET], ["a", "b"]).collect()
    assert all((r["p"] > 0.5) == (r[spec.TARGET] == 1) for r in scored)


def test_a_short_dictionary_is_looked_up_without_a_join(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("new",)], "x string")
    known = spark.createDataFrame([("x", "a"), ("x", "b")], "feature string, category string")
    d = Dictionary(dictionary_from_distinct(known))
    out = encode(df, d, ["x"])
    assert [r["x"] for r in out.collect()] == [1.0, 2.0, 0.0, 2.0]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_payload_files_are_compressed_and_read_back(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").cast("string").alias("payload_id"), F.lit('{"age": 30, "income": 1000.5}').alias("payload"))
    path = str(tmp_path / "files")
    write_payload_files(df.where("id < 1000"), path)
    write_payload_files(df.where("id >= 1000"), path)
    back = spark.read.schema("payload_id string, payload string").json(path)
    assert back.exceptAll(df.select("payload_id", "payload")).isEmpty() and back.count() == 2000
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.startswith("part-"))
    assert size < 2000 * 20
