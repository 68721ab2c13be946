"""Metrics and profiles against brute force."""

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from credence.operators.metrics import binary_metrics, classification_report, confusion_matrix, roc_auc
from credence.operators.profile import class_distribution, duplicate_rows, missing_profile, overall_missing


def brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y != 1]
    if not pos or not neg:
        return None
    u = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return u / (len(pos) * len(neg))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.5, 0.7, 0.9, 0.95])),
                min_size=1, max_size=120))
def test_auc_ties_half(spark, rows):
    df = spark.createDataFrame(rows, "y int, s double")
    got = roc_auc(df, "y", "s", parts=3).first()["auc"]
    want = brute_auc([y for y, _ in rows], [s for _, s in rows])
    assert (got is None and want is None) or abs(got - want) < 1e-12


def test_auc_monotone_invariant(spark):
    rows = [(i % 2, (i * 37 % 101) / 101.0) for i in range(300)]
    a = roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()["auc"]
    b = roc_auc(spark.createDataFrame([(y, s ** 3 * 5 + 1) for y, s in rows], "y int, s double"),
                "y", "s").first()["auc"]
    assert abs(a - b) < 1e-12


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    m = binary_metrics(df, "y", "p").first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (2 / 3, 0.0, 0.0, 0.0)


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "y int, p int")
    cm = {(r["actual"], r["predicted"]): r["count"] for r in confusion_matrix(df, "y", "p").collect()}
    assert len(cm) == 9 and cm[(1, 1)] == 2 and cm[(2, 2)] == 0 and cm[(0, 1)] == 1
    rep = {r["class"]: r for r in classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0.5 and rep["1"]["recall"] == 1.0 and rep["2"]["support"] == 1
    assert rep["accuracy"]["f1_score"] == 3 / 5 and rep["weighted avg"]["support"] == 5


def test_duplicates_nulls_equal(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (None, "y")], "a int, b string")
    assert duplicate_rows(df).first()["duplicate_rows"] == 2


def test_class_share(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "y int")
    got = {r["y"]: r["share"] for r in class_distribution(df, "y").collect()}
    assert got == {1: 2 / 3, 0: 1 / 3}


def test_missing_profile(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, "a"), (None, None)], "x double, s string")
    p = {r["column"]: r for r in missing_profile(df).collect()}
    assert p["x"]["missing_count"] == 1 and p["x"]["missing_pct"] == 33.33 and p["x"]["constant"]
    assert p["s"]["missing_pct"] == 66.67 and p["s"]["distinct_count"] == 1 and p["s"]["distinct_reported"]
    o = overall_missing(df).first()
    assert o["missing_cells"] == 3 and o["missing_pct"] == 50.0


def test_profile_from_values_equals_the_aggregates(spark):
    import datetime as dt
    import decimal

    rows = [(1, 0.0, "a", True, dt.date(2020, 1, 1), decimal.Decimal("1.50"), 2**62), (None, -0.0, "", None, None, decimal.Decimal("2.50"), 2**62 + 1),
            (1, float("nan"), None, False, dt.date(2020, 1, 1), None, 2**62), (3, float("nan"), "a", True, None, decimal.Decimal("1.50"), None)]
    df = spark.createDataFrame(rows, "i int, d double, s string, b boolean, t date, m decimal(9,2), l long")
    show = ["ordinal", "column", "dtype", "total_records", "missing_count", "missing_pct", "distinct_count", "distinct_reported", "constant"]
    for frame in (df, df.limit(0), df.unionByName(df)):
        values = missing_profile(frame).orderBy("ordinal")
        # a column of another kind takes the way of one aggregate
        other = missing_profile(frame.withColumn("z", F.array(F.lit(1))), [*frame.columns, "z"]).where("column <> 'z'").orderBy("ordinal")
        assert values.select(*show).collect() == other.select(*show).collect()


@pytest.mark.parametrize("bits", [128, 4, 0])
def test_duplicates_of_colliding_digests(spark, bits):
    rows = [(i % 70, None if i % 5 == 0 else f"s{i % 3}") for i in range(300)] + [(1000 + i, "x") for i in range(50)] + [(7, "hot")] * 400
    df = spark.createDataFrame(rows, "a int, s string")
    got = duplicate_rows(df, bits=bits).first()
    assert (got["duplicate_rows"], got["distinct_rows"]) == (len(rows) - len(set(rows)), len(set(rows)))
    assert tuple(duplicate_rows(df.limit(0), bits=bits).first()) == (0, 0)
    assert duplicate_rows(df, ["s"], bits).first()["distinct_rows"] == 6
