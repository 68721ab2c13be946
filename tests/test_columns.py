"""Edge cases of the scalar expressions (FIXTURES.md §5)."""

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from credence import spec
from credence.functions import columns as C
from credence.functions.scorecard import approval_label, score

NAN = float("nan")


def col_values(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_age_bucket_edges(spark):
    _, src, edges, labels = spec.BUCKETS[0]
    vals = [-1.0, 0.0, 18.0, 25.0, 25.0001, 100.0, 101.0, None, NAN]
    got = col_values(spark, [(v,) for v in vals], "age double",
                     C.categorical_str(C.right_closed_bucket(C.nan_to_null("age"), edges, labels)))
    assert got == ["unknown", "young", "young", "young", "adult", "senior", "unknown", "unknown", "unknown"]


def test_inf_falls_in_top_open_bin(spark):
    _, src, edges, labels = spec.BUCKETS[1]
    got = col_values(spark, [(float("inf"),), (80000.0,), (80000.5,)], "income double",
                     C.right_closed_bucket("income", edges, labels))
    assert got == ["very_high", "high", "very_high"]


def test_safe_ratio(spark):
    rows = [(1.0, 0.0), (0.0, 0.0), (None, 2.0), (2.0, None), (float("inf"), 2.0), (NAN, 2.0), (1.0, 2.0)]
    got = col_values(spark, rows, "n double, d double", C.safe_ratio("n", "d"))
    assert got == [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5]


def test_flags_missing_is_zero(spark):
    got = col_values(spark, [(None,), (4.9,), (5.0,)], "e double", C.threshold_flag("e", ">=", 5))
    assert got == [0.0, 0.0, 1.0]


def test_half_even_matches_pandas(spark):
    vals = [0.5, 1.5, 2.5, 0.125, 0.545, 0.575, -2.5, 0.135]
    got0 = col_values(spark, [(v,) for v in vals], "x double", C.round_half_even("x", 0))
    got2 = col_values(spark, [(v,) for v in vals], "x double", C.round_half_even("x", 2))
    assert got0 == pd.Series(vals).round(0).tolist()
    assert got2 == pd.Series(vals).round(2).tolist()


def test_clip_keeps_missing(spark):
    got = col_values(spark, [(10.0,), (None,), (90.0,), (40.0,)], "a double", C.clip("a", 18, 80))
    assert got == [18.0, None, 80.0, 40.0]


def test_missing_normalisation(spark):
    rows = [(NAN,), (float("inf"),), (float("-inf"),), (None,), (3.0,)]
    assert col_values(spark, rows, "x double", C.missing_to_null("x")) == [None, None, None, None, 3.0]
    raw = col_values(spark, rows, "x double", C.nan_to_null("x"))
    assert raw[0] is None and raw[1] == float("inf") and raw[4] == 3.0


def test_confidence_band(spark):
    got = col_values(spark, [(0.8,), (0.79,), (0.6,), (0.1,)], "p double", C.confidence_band("p"))
    assert got == ["high", "medium", "medium", "low"]


def _py_score(r):
    s = 0
    cs, inc, dti, emp, own, loan = (r[k] for k in ("credit_score", "income", "debt_to_income",
                                                   "employment_length", "home_ownership", "loan_amount"))

    def ge(x, t):
        return x is not None and x >= t

    def le(x, t):
        return x is not None and x <= t
    s += 40 if ge(cs, 750) else 20 if ge(cs, 650) else 5 if ge(cs, 550) else -20
    s += 25 if ge(inc, 80000) else 15 if ge(inc, 50000) else 5 if ge(inc, 30000) else -10
    s += 20 if le(dti, 0.2) else 10 if le(dti, 0.4) else -5 if le(dti, 0.6) else -20
    s += 15 if ge(emp, 5) else 10 if ge(emp, 2) else 5 if ge(emp, 1) else -5
    s += 15 if own == "OWN" else 10 if own == "MORTGAGE" else 0
    if inc is None or loan is None:
        r_ = math.nan
    elif inc == 0:
        r_ = math.inf if loan > 0 else (-math.inf if loan < 0 else math.nan)
    else:
        r_ = loan / inc
    s += 10 if r_ <= 0.3 else 5 if r_ <= 0.5 else -15 if r_ > 1.0 else 0
    return s


num = st.one_of(st.none(), st.floats(-10, 1000, allow_nan=False))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(num, st.one_of(st.none(), st.sampled_from([0.0, 1.0, 30000.0, 90000.0])),
                          st.one_of(st.none(), st.floats(0, 1)), num,
                          st.one_of(st.none(), st.sampled_from(["OWN", "RENT", "MORTGAGE"])),
                          st.one_of(st.none(), st.sampled_from([0.0, 5000.0, 40000.0, 200000.0]))),
                min_size=1, max_size=20))
def test_scorecard_matches_row_rule(spark, rows):
    names = ["credit_score", "income", "debt_to_income", "employment_length", "home_ownership", "loan_amount"]
    df = spark.createDataFrame(rows, "credit_score double, income double, debt_to_income double, "
                                     "employment_length double, home_ownership string, loan_amount double")
    got = [r[0] for r in df.select(score()).collect()]
    assert got == [_py_score(dict(zip(names, r))) for r in rows]
    lab = [r[0] for r in df.select(approval_label(F.lit(0.0))).collect()]
    assert lab == [int(s > 50) for s in got]
