"""Payload parsing, end-to-end scoring and batch = stream."""

import json

from pyspark.sql import functions as F

from credence import spec
from credence.fixtures import applications
from credence.operators.split import stratified_split
from credence.plans.preprocess import preprocess
from credence.plans.scoring import inference_gate, score_payloads
from credence.plans.training import train
from credence.session import work_dir
from credence.sources.payloads import parse_payloads
from credence.streaming.scoring_stream import start_scoring

REC1 = {"age": 35, "income": 65000, "employment_length": 5.2, "credit_score": 720, "debt_to_income": 0.25,
        "loan_amount": 25000, "home_ownership": "MORTGAGE", "loan_purpose": "debt_consolidation"}
REC2 = {"age": 28, "income": 45000, "employment_length": 2.5, "credit_score": 650, "debt_to_income": 0.35,
        "loan_amount": 15000, "home_ownership": "RENT", "loan_purpose": "home_improvement"}


def _payloads(spark):
    unseen = dict(REC2, home_ownership="HOUSEBOAT")
    zero_income = dict(REC1, income=0)
    null_num = dict(REC1, age=None)
    rows = [("single", json.dumps(REC1)), ("array", json.dumps([REC1, REC2])), ("empty", "[]"),
            ("bad", "{not json"), ("unseen", json.dumps([unseen])), ("zero", json.dumps(zero_income)),
            ("nullnum", json.dumps([null_num, REC2])), ("wrong", '{"k": 1}')]
    return spark.createDataFrame(rows, "payload_id string, payload string")


def test_parse_payloads(spark):
    p = {(r["payload_id"], r["record_index"]): r for r in parse_payloads(_payloads(spark), "payload",
                                                                          "payload_id").collect()}
    assert p[("single", 0)]["age"] == 35.0 and p[("array", 1)]["loan_amount"] == 15000.0
    assert p[("empty", None)]["error"].endswith("empty payload")
    assert p[("bad", None)]["error"].endswith("malformed JSON payload")
    assert "missing columns age" in p[("wrong", None)]["error"]
    assert p[("nullnum", 0)]["age"] is None and p[("nullnum", 0)]["error"] is None
    assert len(p) == 10


def _fit(spark, sf):
    processed, params = preprocess(applications(spark, sf))
    s = stratified_split(processed, spec.TARGET, spec.KEY)
    model = train(s.where(F.col("split") == "train"), "logistic_regression")
    return model, params


def test_score_payloads_and_gate(spark, sf):
    model, params = _fit(spark, sf)
    out = {(r["payload_id"], r["record_index"]): r for r in score_payloads(model, params,
                                                                           _payloads(spark)).collect()}
    good = [r for r in out.values() if r["error"] is None]
    assert len(good) == 7 and all(r[spec.TARGET] in (0, 1) and 0 <= r["approval_probability"] <= 1
                                  for r in good)
    assert out[("bad", None)][spec.TARGET] is None
    g = inference_gate(score_payloads(model, params, _payloads(spark).where("payload_id = 'array'"))).first()
    assert g["passed"] and g["issues"] == []
    g2 = inference_gate(score_payloads(model, params, _payloads(spark))).first()
    assert not g2["passed"]


def test_batch_equals_stream(spark, sf):
    model, params = _fit(spark, sf)
    payloads = _payloads(spark).union(
        applications(spark, sf).select(F.col(spec.KEY).cast("string").alias("payload_id"),
                                       F.to_json(F.struct(*spec.RAW_COLUMNS), {"ignoreNullFields": "false"})
                                       .alias("payload")))
    src, out, ckpt = (work_dir(spark, n) for n in ("t-src", "t-out", "t-ckpt"))
    payloads.repartition(3).write.mode("overwrite").json(src)
    start_scoring(spark, model, params, src, out, ckpt).awaitTermination()
    stream = spark.read.parquet(out)
    batch = score_payloads(model, params, spark.read.json(src), impute_with="stored")
    cols = ["payload_id", "record_index", spec.TARGET, "approval_probability", "confidence", "error"]
    # two payloads carry two records each
    assert stream.count() == batch.count() == payloads.count() + 2
    assert stream.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert batch.select(*cols).exceptAll(stream.select(*cols)).count() == 0


def test_training_sets_fallback_runs_preprocess(spark, sf):
    from credence.sources.readers import training_sets, write

    root = work_dir(spark, "t-root")
    raw_path = work_dir(spark, "t-raw")
    write(applications(spark, sf), raw_path, "csv")
    tr, va, info = training_sets(spark, root, raw_path)
    assert info["train_path"].endswith("processed_data/train_processed")
    assert info["val_path"].endswith("processed_data/val_processed")
    assert tr.count() + va.count() == applications(spark, sf).count()
    again, _, info2 = training_sets(spark, root)          # now reused, no raw data needed
    assert info2["train_path"] == info["train_path"] and again.count() == tr.count()


def test_bad_payloads_give_one_error_row_each(spark):
    rows = [("word", json.dumps(dict(REC1, age="abc"))), ("blank", json.dumps(dict(REC1, age=""))),
            ("nan", json.dumps(dict(REC1, age=float("nan")))), ("quoted", json.dumps(dict(REC1, age="35"))),
            ("null-element", json.dumps([REC1, None])), ("numbers", "[1, 2]"), ("number", "5"), ("null", "null"),
            ("after", json.dumps(REC1) + " x"), ("two", json.dumps(REC1) + "," + json.dumps(REC2)),
            ("more", json.dumps(REC1) + ',"x":{}'), ("space", "\n\t " + json.dumps(REC1) + " \n"), ("none", None),
            ("text", ""), ("partly", json.dumps([REC1, dict(REC2, income="n/a")])), (None, json.dumps(REC1)),
            ("nested", json.dumps(dict(REC1, income={"a": 1}))), ("array-null", "[null]")]
    df = spark.createDataFrame(rows, "payload_id string, payload string")
    got = parse_payloads(df, "payload", "payload_id").collect()
    assert len(got) == len(rows)
    errors = {r["payload_id"]: r["error"] for r in got}
    good = {"nan", "quoted", "space", None}
    assert {k for k, e in errors.items() if e is None} == good
    assert errors["word"].endswith("values that are no numbers in age") and errors["partly"].endswith("in income")
    assert all(errors[k].endswith("malformed JSON payload") for k in ("number", "null", "after", "two", "none", "text"))
    assert errors["null-element"].endswith("record that is no object")
    assert all(r["record_index"] is None and r["age"] is None for r in got if r["error"])


def test_each_payload_row_takes_its_own_medians(spark):
    def text(values):
        return json.dumps([dict(REC1, age=v) for v in values])

    rows = [("a", text([1, None, 3])), ("a", text([10, 20, None])), (None, text([1, None, 3])),
            (None, text([None])), ("b", text([None, None])), ("b", text([None, 4, 4, 4, float("nan")]))]
    df = spark.createDataFrame(rows, "payload_id string, payload string").repartition(3)
    fills = parse_payloads(df, "payload", "payload_id", with_fills=True).where("age is null or isnan(age)")
    got = sorted((r["payload_id"] or "", r["record_index"], r["fill_age"] if r["fill_age"] is not None else -1.0)
                 for r in fills.collect())
    assert got == sorted([("a", 1, 2.0), ("a", 2, 15.0), ("", 1, 2.0), ("", 0, 0.0), ("b", 0, -1.0), ("b", 1, -1.0),
                          ("b", 0, 4.0), ("b", 4, 4.0)])


def test_payload_medians_equal_grouped_medians(spark, sf):
    """The medians taken inside a payload are those of the distributed path
    over the same rows."""
    from credence.functions.features import build_features
    from credence.operators.impute import impute_by_group

    recs = applications(spark, sf).withColumn("g", F.expr(f"{spec.KEY} % 7"))
    many = recs.groupBy(F.col("g").cast("string").alias("payload_id")).agg(
        F.to_json(F.collect_list(F.struct(*spec.RAW_COLUMNS)), {"ignoreNullFields": "false"}).alias("payload"))
    rows = build_features(parse_payloads(many, "payload", "payload_id", with_fills=True))
    own = rows.select("payload_id", "record_index", *[
        F.coalesce(F.col(c), F.col(f"fill_{c}")).alias(c) for c in spec.RAW_NUMERIC])
    grouped = impute_by_group(rows, ["payload_id"], spec.RAW_NUMERIC).select(*own.columns)
    assert own.count() == recs.count()
    assert own.exceptAll(grouped).count() == 0 and grouped.exceptAll(own).count() == 0


def test_split_payload_errors(spark):
    from credence.sources.payloads import parse_split_payloads

    def text(columns, data, index="[7, 8, 9]"):
        return f'{{"input_data": {{"columns": {columns}, "index": {index}, "data": {data}}}}}'
    rows = [("good", text('["s", "x"]', '[["a", 1], ["b", "2.5"], ["c"]]')), ("no index", text('["x"]', '[[3]]', "null")),
            ("bad number", text('["x"]', '[[1], ["abc"]]')), ("no rows", text('["x"]', "[]")), ("no array", text('["x"]', "[1]")),
            ("no column", text('["s"]', '[["a"]]')), ("no json", "{"), ("no payload", '{"a": 1}'), (None, None)]
    df = spark.createDataFrame(rows, "id string, p string")
    got = parse_split_payloads(df, "p", "id", [("x", "double"), ("s", "string")], required=["x"]).collect()
    values = sorted((r["id"], r["row_index"], r["x"], r["s"]) for r in got if r["error"] is None)
    assert values == [("good", 7, 1.0, "a"), ("good", 8, 2.5, "b"), ("good", 9, None, "c"), ("no index", 0, 3.0, None)]
    errors = {r["id"]: r["error"].split(": ")[1] for r in got if r["error"] is not None}
    assert errors.pop("no array") in ("row that is no array", "malformed JSON payload")
    assert errors == {"bad number": "values of another type in x", "no rows": "empty payload", "no column": "missing columns x",
                      "no json": "malformed JSON payload", "no payload": "malformed JSON payload", None: "malformed JSON payload"}
    assert all(r["x"] is None and r["row_index"] is None for r in got if r["error"]) and len(got) == 11


def test_inference_gate_counts_probabilities(spark):
    from credence.plans.scoring import inference_gate

    def stats(rows):
        df = spark.createDataFrame(rows, "loan_approved int, approval_probability double, error string")
        return inference_gate(df).first()["stats"]["has_probabilities"]
    assert stats([(1, 0.9, None)]) == "true" and stats([(1, None, None)]) == "false" and stats([]) == "false"


def test_training_logs_its_run(spark):
    import random

    from credence import spec
    from credence.plans.catalog import Catalog
    from credence.plans.training import train_and_evaluate
    from credence.session import work_dir

    rng = random.Random(1)
    rows = [(i, *[rng.gauss(i % 2, 1) for _ in spec.ALL_FEATURES], i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, [spec.KEY, *spec.ALL_FEATURES, spec.TARGET])
    catalog = Catalog(spark, work_dir(spark, "runs"))
    _, metrics = train_and_evaluate(df, df, "logistic_regression", catalog=catalog, run_id="r1", partitions=2)
    logged = {r["key"]: (r["kind"], r["value"]) for r in catalog.read("runs").where("run_id = 'r1'").collect()}
    names = [f"{s}_{m}" for s in ("train", "val") for m in ("accuracy", "precision", "recall", "f1", "auc")]
    assert {k for k, (kind, _) in logged.items() if kind == "metric"} == set(names)
    assert logged["model_type"] == ("param", "logistic_regression") and logged["partitions"] == ("param", "2")
    assert {r["metric"]: r["value"] for r in metrics.collect()} == {k: float(logged[k][1]) for k in names}


def test_validations_are_kept_by_set_and_version(spark):
    from credence.operators.gates import profile_gate
    from credence.plans.catalog import Catalog
    from credence.session import work_dir

    catalog = Catalog(spark, work_dir(spark, "validations"))
    gate = spark.createDataFrame([("feature_store", False, ["bad"], {})], "check string, passed boolean, issues array<string>, stats map<string,string>")
    catalog.log_validation("s", 1, gate)
    assert profile_gate(catalog.validations("s", 1)).first()["issues"] == ["bad"]
    assert profile_gate(catalog.validations("s", 2)).first()["issues"] == ["Feature validation results not found"]
