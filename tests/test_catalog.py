"""Commits of the catalog: versions under concurrent writers, writers that die,
compaction beside appends."""

import threading

import pytest
from pyspark.sql import functions as F

from credence.plans import commit_log
from credence.plans.catalog import Catalog, publish_dataset, read_dataset
from credence.session import work_dir


@pytest.fixture
def catalog(spark):
    return Catalog(spark, work_dir(spark, "catalog-test"))


def at_once(*calls):
    """Runs all calls at the same time and raises what any of them raised."""
    errors, gate = [], threading.Barrier(len(calls))

    def run(call):
        try:
            gate.wait()
            call()
        except Exception as e:  # noqa: BLE001 - raised below
            errors.append(e)
    threads = [threading.Thread(target=run, args=(c,)) for c in calls]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]


def test_concurrent_registrations_each_get_a_version(spark, catalog):
    at_once(*[lambda i=i: catalog.register_model("m", f"/m/{i}", tags={"writer": str(i)}) for i in range(8)])
    rows = catalog.model_versions().collect()
    assert sorted(r["version"] for r in rows) == list(range(1, 9))
    assert sorted(r["tags"]["writer"] for r in rows) == [str(i) for i in range(8)]
    assert all(r["id"] == f"m:{r['version']}" and r["path"] == f"/m/{r['tags']['writer']}" for r in rows)


def test_concurrent_tag_merges_all_hold(spark, catalog):
    catalog.register_model("m", "/m", tags={"k0": "old", "kept": "yes"})
    at_once(*[lambda i=i: catalog.add_model_tags("m", 1, {f"k{i}": str(i)}) for i in range(5)])
    [row] = catalog.model_versions().collect()
    assert row["tags"] == {"kept": "yes"} | {f"k{i}": str(i) for i in range(5)}
    with pytest.raises(KeyError):
        catalog.add_model_tags("m", 2, {"a": "b"})


def test_concurrent_sets_views_and_datasets(spark, catalog):
    data = work_dir(spark, "set-data")
    df = spark.range(4).select(F.col("id").cast("double").alias("age"), F.lit(1).alias("loan_approved"))
    df.write.parquet(data)
    at_once(*[lambda: catalog.create_feature_set("s", df, data_path=data) for _ in range(3)],
            *[lambda i=i: publish_dataset(catalog, "d", spark.range(i + 1)) for i in range(3)])
    assert sorted(r["version"] for r in catalog.feature_sets().collect()) == [1, 2, 3]
    assert sorted(read_dataset(catalog, "d", v).count() for v in (1, 2, 3)) == [1, 2, 3]
    at_once(*[lambda i=i: catalog.create_feature_view("v", ["age"], "s", 1, view=f"v{i}") for i in range(3)])
    assert sorted(r["version"] for r in catalog.read("feature_views").collect()) == [1, 2, 3]


def test_a_writer_that_dies_leaves_nothing(spark, catalog):
    catalog.register_model("m", "/m")
    log = catalog.log("model_versions")
    row = log.read().withColumn("version", F.lit(2).cast("long"))
    log._write(row, 2)                                             # dies before its commit
    log.files.fs.create(log.files.path(log._entry(2)[0], ".dead"), True).close()   # and while it writes the entry
    assert [r["version"] for r in catalog.model_versions().collect()] == [1]
    catalog.register_model("m", "/m")
    assert sorted(r["version"] for r in catalog.model_versions().collect()) == [1, 2]
    with pytest.raises(ZeroDivisionError):                         # dies while it builds its rows
        log.transact(lambda rows: 1 / 0)
    bad = spark.range(1).select(F.raise_error(F.lit("no data")).alias("x"))
    with pytest.raises(Exception, match="no data"):
        publish_dataset(catalog, "d", bad)
    assert publish_dataset(catalog, "d", spark.range(2)) == 1


def test_one_number_has_one_entry(spark, catalog):
    log = catalog.log("runs")
    won = []
    at_once(*[lambda i=i: won.append(log.commit(1, f"folder-{i}")) for i in range(8)])
    assert sorted(won) == [False] * 7 + [True]


def test_compaction_beside_appends_loses_nothing(spark, catalog, monkeypatch):
    monkeypatch.setattr(commit_log, "COMPACT_EVERY", 5)
    monkeypatch.setattr(commit_log, "BUCKET", 4)

    def writes(i):
        for n in range(6):
            catalog.log_run(f"run-{i}-{n}", {"n": n})
    at_once(*[lambda i=i: writes(i) for i in range(3)], lambda: [catalog.log("runs").compact() for _ in range(6)])
    log = catalog.log("runs")
    assert log.last() == 18 and log.snapshot() >= 15
    rows = catalog.read("runs").collect()
    assert sorted(r["run_id"] for r in rows) == sorted(f"run-{i}-{n}" for i in range(3) for n in range(6))
    # a read opens the snapshot and the tail alone
    opened = {f.split("/rows/")[1].split("/")[0] for f in log.read().inputFiles()}
    assert len(opened) == 1 + 18 - log.snapshot()
    assert log.read(7).count() == 7


def test_a_snapshot_keeps_the_current_versions(spark, catalog):
    for i in range(2):
        catalog.register_model("m", f"/{i}")
    for i in range(3):
        catalog.add_model_tags("m", 1, {"n": str(i)})
    before = sorted(catalog.model_versions().collect())
    log = catalog.log("model_versions")
    assert log.compact() == 5 and log.read().count() == 2
    assert sorted(catalog.model_versions().collect()) == before
    catalog.add_model_tags("m", 1, {"n": "last"})
    assert {r["version"]: r["tags"].get("n") for r in catalog.model_versions().collect()} == {1: "last", 2: None}


def test_a_time_range_opens_only_its_files(spark, catalog):
    import datetime as dt

    df = spark.range(4000).select(
        F.when(F.col("id") % 10 > 0, F.expr("TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(0, id)")).alias("application_ts"),
        F.col("id").cast("double").alias("income"), F.lit(1).alias("loan_approved")).repartition(3)
    catalog.write_feature_set("s", df, files=12)
    every = catalog.get_feature_data("s", 1)
    assert every.count() == 4000 and len(every.inputFiles()) >= 10
    start, end = dt.datetime(2020, 1, 10), dt.datetime(2020, 2, 1)
    some = catalog.get_feature_data("s", 1, start=start, end=end)
    inside = (F.col("application_ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("application_ts") < F.lit(end).cast("timestamp_ntz"))
    assert sorted(some.collect()) == sorted(df.where(inside).collect()) and some.count() > 400
    assert len(some.inputFiles()) <= 4
    # the same rows as without a manifest, for each kind of bound, also between two files' borders
    for a, b in ((start, None), (None, end), (dt.datetime(2031, 1, 1), None), (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 5))):
        cond = F.lit(True)
        for bound, op in ((a, "__ge__"), (b, "__lt__")):
            if bound is not None:
                cond = cond & getattr(F.col("application_ts"), op)(F.lit(bound).cast("timestamp_ntz"))
        assert sorted(catalog.get_feature_data("s", 1, start=a, end=b).collect()) == sorted(df.where(cond).collect())
    # a file that came later is read
    path = catalog.feature_sets().first()["data_path"]
    df.limit(50).withColumn("application_ts", F.lit(dt.datetime(2019, 1, 1)).cast("timestamp_ntz")).write.mode("append").parquet(path)
    assert catalog.get_feature_data("s", 1, end=dt.datetime(2019, 6, 1)).count() == 50


def test_profile_parts_merge(spark, catalog):
    import random

    from credence.operators.sketch import PARTS, profile_of, sketch

    rng = random.Random(4)
    rows = [(rng.gauss(0, 1) * 10 ** rng.randrange(-300, 300) if i % 7 else None, i % 1500, f"s{i % 40}" if i % 3 else None)
            for i in range(9000)]
    rows += [(float("inf"), 0, None), (-float("inf"), None, ""), (float("nan"), -5, None), (0.0, 1, "x"), (-0.0, 1, "x")]
    df = spark.createDataFrame(rows, "x double, n long, s string").repartition(5)
    for n in range(3):
        catalog.add_profile_part("p", str(n), df.where(F.pmod(F.hash("x", "n", "s"), F.lit(3)) == n))
    catalog.add_profile_part("p", "none", df.limit(0))
    with pytest.raises(ValueError, match="before"):
        catalog.add_profile_part("p", "1", df)
    whole = sketch(df.repartition(2))
    assert sorted(map(str, catalog.profile_sketch("p").collect())) == sorted(map(str, whole.collect()))
    p = {r["column"]: r for r in catalog.profile("p").collect()}
    assert [(p[c]["total_records"], p[c]["missing_count"]) for c in "xns"] == [
        (len(rows), sum(r[i] is None for r in rows)) for i in range(3)]
    for c, i in (("x", 0), ("n", 1)):
        v = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        assert (p[c]["min"], p[c]["max"]) == (v[0], v[-1])
        for q in (0.25, 0.5, 0.75):
            k = q * (len(v) - 1)
            lo, hi = v[int(k)], v[min(len(v) - 1, int(k) + 1)]
            got = p[c][f"p{int(100 * q)}"]
            assert min(lo - abs(lo) / (2 * PARTS), lo) <= got <= max(hi + abs(hi) / (2 * PARTS), hi)
        assert abs(p[c]["distinct_count"] - len(set(v))) <= 0.06 * len(set(v))
    assert (p["s"]["distinct_count"], p["s"]["min"], p["s"]["p50"]) == (42, None, None)
    empty = {r["column"]: r for r in profile_of(sketch(df.limit(0))).collect()}
    assert all(r["total_records"] == 0 and r["distinct_count"] == 0 and r["p50"] is None for r in empty.values())


def test_two_writers_of_one_profile_part(spark, catalog):
    df, errors = spark.range(10), []

    def add():
        try:
            catalog.add_profile_part("p", "1", df)
        except ValueError as e:
            errors.append(e)
    at_once(add, add, add)
    assert len(errors) == 2 and catalog.profile("p").first()["total_records"] == 10
