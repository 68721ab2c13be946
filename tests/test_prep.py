"""Fit / transform operators: medians, scaler, dictionaries, exact split,
and the distributed running totals they rest on."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from credence.operators.cumulative import exact_percentiles, running_totals
from credence.operators.encode import Dictionary, encode, fit_dictionaries, mask_unseen
from credence.operators.impute import fit_medians, impute_by_group
from credence.operators.scale import fit_scaler, standardize
from credence.operators.split import class_quotas, stratified_split


def test_medians(spark):
    df = spark.createDataFrame([(1.0, 1.0, None), (2.0, 2.0, None), (3.0, None, None), (4.0, 4.0, None)],
                               "a double, b double, c double")
    assert fit_medians(df, ["a", "b", "c"]) == {"a": 2.5, "b": 2.0, "c": None}


def test_group_impute_single_row_gets_zero(spark):
    df = spark.createDataFrame([("p1", 1.0), ("p1", None), ("p1", 5.0), ("p2", None)], "g string, x double")
    got = sorted((r["g"], r["x"]) for r in impute_by_group(df, ["g"], ["x"]).collect())
    assert got == [("p1", 1.0), ("p1", 3.0), ("p1", 5.0), ("p2", 0.0)]


def test_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0), (4.0, 7.0)], "a double, k double")
    p = fit_scaler(df, ["a", "k"])
    assert p["a"][0] == 2.5 and math.isclose(p["a"][1], 1.118033988749895)
    assert p["k"] == (7.0, 1.0)
    out = standardize(df, p).collect()
    assert [r["k"] for r in out] == [0.0] * 4
    assert math.isclose(float(np.std([r["a"] for r in out])), 1.0)


def test_dictionary_unknown_present_and_absent(spark):
    df = spark.createDataFrame([("unknown", "b"), ("young", "a"), ("adult", "b")], "x string, y string")
    d = Dictionary(fit_dictionaries(df, ["x", "y"]))
    codes = {(r["feature"], r["category"]): r["code"] for r in d.table.collect()}
    assert codes == {("x", "adult"): 0, ("x", "unknown"): 1, ("x", "young"): 2,
                     ("y", "a"): 0, ("y", "b"): 1, ("y", "unknown"): 2}
    new = spark.createDataFrame([("elder", "z"), ("young", "a")], "x string, y string")
    got = [(r["x"], r["y"]) for r in encode(new, d, ["x", "y"]).collect()]
    assert sorted(got) == sorted([(1.0, 2.0), (2.0, 0.0)])
    masked = sorted(tuple(r) for r in mask_unseen(new, d, ["x", "y"]).collect())
    assert masked == [("unknown", "unknown"), ("young", "a")]


def test_split_exact_counts(spark):
    rows = [(i, 0) for i in range(700)] + [(700 + i, 1) for i in range(303)]
    df = spark.createDataFrame(rows, "k long, y int")
    q = {r["y"]: (r["train_c"], r["test_c"]) for r in class_quotas(df, "y", 0.2).collect()}
    assert q == {0: (560, 140), 1: (242, 61)}
    for method in ("xxhash64", "lehmer"):
        s = stratified_split(df, "y", "k", 0.2, 42, method=method).collect()
        assert len(s) == 1003 and len({r["k"] for r in s}) == 1003
        cnt = {}
        for r in s:
            cnt[(r["y"], r["split"])] = cnt.get((r["y"], r["split"]), 0) + 1
        assert cnt == {(0, "train"): 560, (0, "test"): 140, (1, "train"): 242, (1, "test"): 61}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=400), st.integers(0, 1000))
def test_split_is_exact_disjoint_and_ranked(spark, labels, seed):
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "k long, y int")
    s = stratified_split(df, "y", "k", 0.2, seed, method="lehmer").collect()
    assert sorted(r["k"] for r in s) == list(range(len(labels)))
    n_test = sum(r["split"] == "test" for r in s)
    assert n_test == math.ceil(0.2 * len(labels))
    p = 2147483647
    for y in set(labels):
        ks = sorted((((k + seed) % p) * 48271 % p, k) for k, yy in enumerate(labels) if yy == y)
        test = {r["k"] for r in s if r["y"] == y and r["split"] == "test"}
        assert test == {k for _, k in ks[:len(test)]}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                min_size=1, max_size=300), st.sampled_from([None, 1, 4, 9]))
def test_exact_percentiles_match_numpy(spark, values, parts):
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, v double")
    got = {r["g"]: (r["p25"], r["p50"], r["p75"]) for r in
           exact_percentiles(df, "g", "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], parts=parts).collect()}
    for g in range(3):
        vs = [v for i, v in enumerate(values) if i % 3 == g and v is not None]
        if not vs:
            assert g not in got
            continue
        want = np.percentile(vs, [25, 50, 75])
        assert np.allclose(got[g], want, rtol=1e-9, atol=1e-6)


@pytest.mark.parametrize("parts", [1, 5])
def test_percentiles_of_null_groups_infinities_and_counted_rows(spark, parts):
    inf = float("inf")
    rows = [(None, -inf, 2), (None, 5.0, 1), (None, 6.0, 1), ("a", 1.0, 10**10), ("a", 3.0, 10**10), ("b", None, 4),
            ("c", float("nan"), 1), ("c", 7.0, 1)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    got = {r["g"]: (r["p25"], r["p50"], r["p75"]) for r in exact_percentiles(
        df, "g", "v", [0.25, 0.5, 0.75], weight_col="w", parts=parts).collect()}
    assert got == {None: (-inf, -inf, 5.25), "a": (1.0, 2.0, 3.0), "c": (7.0, 7.0, 7.0)}
    empty = exact_percentiles(df.where("false"), "g", "v", [0.5], parts=parts)
    assert empty.columns == ["g", "p50"] and empty.count() == 0


def test_running_totals_over_many_parts_equal_window(spark):
    rows = [(i % 2, float(i * 7919 % 1000), 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, x double, w int").groupBy("g", "x").agg(F.sum("w").alias("w"))
    rt = running_totals(df, ["g"], "x", ["w"], parts=6).collect()
    by = {}
    for r in rt:
        by.setdefault(r["g"], []).append((r["x"], r["w"], r["w_cum"]))
    for g, lst in by.items():
        lst.sort()
        assert [c for _, _, c in lst] == list(np.cumsum([w for _, w, _ in lst]))
    ung = running_totals(df.where("g = 0").drop("g"), [], "x", ["w"], parts=5).collect()
    lst = sorted((r["x"], r["w"], r["w_cum"]) for r in ung)
    assert [c for _, _, c in lst] == list(np.cumsum([w for _, w, _ in lst]))


def test_group_impute_null_groups_infinities_and_hot_groups(spark):
    inf = float("inf")
    rows = [("a", 1.0), ("a", None), ("a", 4.0), ("b", None), ("c", 2.0), ("c", None), (None, 1.0), (None, None),
            (None, 3.0), ("d", None), ("d", None), ("e", -inf), ("e", -inf), ("e", 5.0), ("e", 6.0), ("e", None)]
    rows += [("hot", float(i)) for i in range(1001)] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    got = [tuple(r) for r in impute_by_group(df, ["g"], ["x"]).collect()]
    assert len(got) == len(rows)
    for want in [("a", 2.5), ("b", 0.0), ("c", 2.0), (None, 2.0), ("d", None), ("e", -inf)]:
        assert want in got
    assert got.count(("hot", 500.0)) == 2 and got.count(("d", None)) == 2


def test_dictionary_ranks_over_many_ranges_and_both_joins(spark):
    from credence.operators.encode import Dictionary, dictionary_from_distinct, encode, mask_unseen

    names = [f"c{i:04d}" for i in range(500)] + ["", "unknown", "é", "Z"]
    rows = [("f", n) for n in names] + [("g", n) for n in names[:7]]
    d = Dictionary(dictionary_from_distinct(
        spark.createDataFrame(rows, "feature string, category string").repartition(5)))
    codes = {(r["feature"], r["category"]): r["code"] for r in d.table.collect()}
    assert codes == {("f", n): i for i, n in enumerate(sorted(names))} | \
        {("g", n): i for i, n in enumerate(sorted(names[:7]))} | {("g", "unknown"): 7}
    df = spark.createDataFrame([("c0003", "c0009"), ("?", "c0001"), (None, None)], "f string, g string")
    out = []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            out.append((sorted(tuple(r) for r in encode(df, d, ["f", "g"]).collect()),
                        sorted(tuple(r) for r in mask_unseen(df, d, ["f", "g"]).collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    unknown = float(codes[("f", "unknown")])
    assert out[0] == out[1]
    assert out[0][0] == sorted([(float(codes[("f", "c0003")]), 7.0), (unknown, 1.0), (unknown, 7.0)])
    assert out[0][1] == sorted([("c0003", "unknown"), ("unknown", "c0001"), ("unknown", "unknown")])


def test_fit_scope_and_approx_options(spark, sf):
    from credence import spec
    from credence.fixtures import applications
    from credence.operators.profile import missing_profile
    from credence.plans.preprocess import preprocess

    apps = applications(spark, sf).withColumn("tr", F.col(spec.KEY) % 5 != 0)
    full, p_all = preprocess(apps.drop("tr"))
    part, p_tr = preprocess(apps, fit_rows=F.col("tr"))
    assert part.count() == full.count() == apps.count()
    assert p_all.scaler["income"] != p_tr.scaler["income"]
    _, p_apx = preprocess(apps.drop("tr"), median_method="approx")
    for c in spec.RAW_NUMERIC:
        assert abs(p_apx.medians[c] - p_all.medians[c]) <= 0.02 * abs(p_all.medians[c]) + 1e-9
    exact = {r["column"]: r["distinct_count"] for r in missing_profile(apps).collect()}
    approx = {r["column"]: r["distinct_count"] for r in missing_profile(apps, distinct="approx").collect()}
    assert all(abs(approx[c] - exact[c]) <= 0.05 * exact[c] + 1 for c in exact)


def test_split_exact_with_hot_key_and_copies(spark):
    # 1,200 exact copies of one row plus 600 rows sharing a hot key, and 400 unique rows
    rows = [(7, 1, 0.5)] * 1200 + [(9, 0, float(i)) for i in range(600)] + \
           [(1000 + i, i % 2, float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, y int, v double").repartition(5)
    q = {r["y"]: r["test_c"] for r in class_quotas(df, "y", 0.2).collect()}
    s = stratified_split(df, "y", "k", 0.2, 3)
    got = {}
    for r in s.groupBy("y", "split").count().collect():
        got[(r["y"], r["split"])] = r["count"]
    assert sum(got.values()) == len(rows)
    for y, t in q.items():
        assert got.get((y, "test"), 0) == t
    # the multiset of rows is preserved exactly
    assert s.drop("split").exceptAll(df).count() == 0 and df.exceptAll(s.drop("split")).count() == 0


def test_split_keeps_null_labels_and_depends_on_the_key_only(spark):
    from pyspark.sql import functions as F

    from credence.operators.split import stratified_split

    hot = [(1, None if i % 3 == 0 else i % 3, i) for i in range(1500)]
    rows = hot + [(10 + i, None if i % 3 == 0 else i % 3, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k long, y int, x int")
    out = stratified_split(df, "y", "k")
    assert out.count() == 3000
    shares = {r["y"]: r["n"] for r in out.where("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sum(shares.values()) == 600 and max(shares.values()) - min(shares.values()) <= 1
    other = stratified_split(df.withColumn("x", F.col("x") * 2.5), "y", "k")
    single = "k >= 10"
    assert out.where(single).select("k", "split").exceptAll(other.where(single).select("k", "split")).count() == 0


def test_large_dictionaries_share_one_look_up(spark):
    import random

    from pyspark.sql import functions as F

    from credence.operators.encode import Dictionary, encode, fit_dictionaries, mask_unseen

    rng = random.Random(2)
    cols = ["a", "b", "c", "d", "e"]
    rows = [(i, *["hot" if i % 3 == 0 else f"{c}{rng.randrange(300)}" for c in cols]) for i in range(3000)]
    df = spark.createDataFrame(rows, ["id", *cols])
    fitted = Dictionary(fit_dictionaries(df.where("id % 2 = 0"), cols))
    odd = df.unionByName(df.limit(5)).withColumn("b", F.when(F.col("id") % 11 > 0, F.col("b"))).withColumn("e", F.lit("never seen"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(key)
    want = [sorted(map(str, f(odd, fitted, cols).collect())) for f in (encode, mask_unseen)]
    try:
        spark.conf.set(key, "-1")
        got = [f(odd, fitted, cols) for f in (encode, mask_unseen)]
        assert [sorted(map(str, g.collect())) for g in got] == want
        plan = got[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # pairs and dictionary meet once, codes and rows meet once
        assert plan.count("SortMergeJoin") <= 2 and got[0].columns == odd.columns
        spark.conf.set(key, str(fitted.bytes["a"]))
        assert sorted(map(str, encode(odd, fitted, cols).collect())) == want[0]
        assert encode(odd.limit(0), fitted, cols).count() == 0
    finally:
        spark.conf.set(key, kept)


def test_split_moves_no_class_to_one_task(spark):
    """The per-class table comes to the rows by broadcast: no row is shuffled by its label."""
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 10 < 6).cast("int").alias("y"))
    s = stratified_split(df.unionByName(spark.range(7).select(F.col("id").alias("k"), F.lit(None).cast("int").alias("y"))), "y", "k")
    assert {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()} == {
        (0, "train"): 640, (0, "test"): 160, (1, "train"): 960, (1, "test"): 240, (None, "train"): 5, (None, "test"): 2}
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Union")[1].split("BroadcastHashJoin")[0]
