"""Tags, gates and the roll-up."""

from pyspark.sql import functions as F

from credence.functions.maps import merge_tags, parse_tags
from credence.operators.gates import (data_quality_gate, feature_gate, performance_gate, rollup,
                                      run_gates)


def test_parse_and_merge_tags(spark):
    df = spark.createDataFrame([(["a=1", "k=v=w", "bad"],)], "t array<string>")
    assert df.select(parse_tags("t")).first()[0] == {"a": "1", "k": "v=w"}
    m = spark.range(1).select(merge_tags(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("3")),
                                         F.create_map(F.lit("a"), F.lit("2")))).first()[0]
    assert m == {"a": "2", "b": "3"}


def test_feature_gate_fails_on_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0), (1.0, 1.0)], "x double, k double")
    g = feature_gate(df).first()
    assert g["passed"] is False
    assert g["issues"] == ["High missing values in x: 66.7%", "No variance in numeric feature: x",
                           "No variance in numeric feature: k"]


def test_performance_gate(spark):
    m = spark.createDataFrame([("val_accuracy", 0.79), ("val_precision", 0.9), ("val_recall", 0.8),
                               ("val_f1", 0.8)], "metric string, value double")
    g = performance_gate(m).first()
    assert g["passed"] is False
    assert g["issues"] == ["Accuracy: 0.7900 below threshold 0.8000", "Missing metric: val_auc"]
    empty = performance_gate(spark.createDataFrame([], "metric string, value double")).first()
    assert empty["passed"] is False and empty["issues"] == ["No metrics file found for validation"]


def test_data_quality_gate(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 1), (2.0, 0)], "x double, loan_approved int")
    g = data_quality_gate(df).first()
    assert g["passed"] is False
    assert g["issues"][0] == "Insufficient test samples: 3 < 1000"
    assert g["issues"][1] == "Excessive missing values: 16.7%"


def test_rollup_counts_raising_gate_as_failed(spark):
    ok = spark.createDataFrame([("a", True, [], {})], "check string, passed boolean, issues array<string>, "
                                                      "stats map<string,string>")

    def boom():
        raise RuntimeError("no table")
    r = {x["check"]: x for x in rollup(run_gates(spark, [("a", lambda: ok), ("b", boom)])).collect()}
    assert r["a"]["passed"] and not r["b"]["passed"] and not r["overall"]["passed"]
    assert r["overall"]["issues"] == ["RuntimeError: no table"]
