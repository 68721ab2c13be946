"""CSV files bound by header names; malformed lines and made keys."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credence import spec
from credence.session import work_dir
from credence.sources.csv_scan import scan_csv
from credence.sources.readers import RAW_SCHEMA, load_csv

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType()),
                       T.StructField("t", T.TimestampNTZType()), T.StructField("y", T.IntegerType())])


def files(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return f"file://{tmp_path}"


def test_columns_are_bound_by_name(spark, tmp_path):
    path = files(tmp_path, a="k,x,s,t,y\n1,1.5,a,2024-01-02 03:04:05,0\n", b="y,t,other,s,x,k\n1,2024-01-02,z,\"b,c\",2,2\n",
                 c="﻿ s ,x\nd,NaN\n\n ,\n", d="k\n9223372036854775807\n")
    scan = scan_csv(spark, path, SCHEMA)
    rows = sorted(((r["s"] or "", r["k"], str(r["x"]), str(r["t"]), r["y"]) for r in scan.rows.collect()), key=str)
    assert rows == [("", 2**63 - 1, "None", "None", None), ("", None, "None", "None", None), ("a", 1, "1.5", "2024-01-02 03:04:05", 0),
                    ("b,c", 2, "2.0", "2024-01-02 00:00:00", 1), ("d", None, "nan", "None", None)]
    assert scan.malformed.count() == 0


def test_the_usual_nine_columns_load(spark, tmp_path):
    """Names in the order in which raw files of this kind are written."""
    columns = [*spec.RAW_NUMERIC, *spec.RAW_CATEGORICAL, spec.TARGET]
    line = {"age": "30", "income": "50000", "loan_approved": "1", "home_ownership": "RENT", "loan_purpose": "other"}
    path = files(tmp_path, a=",".join(columns) + "\n" + ",".join(line.get(c, "2.5") for c in columns) + "\n")
    [r] = load_csv(spark, path).collect()
    assert (r["age"], r["income"], r["credit_score"], r["home_ownership"], r["loan_approved"]) == (30.0, 50000.0, 2.5, "RENT", 1)
    assert r[spec.KEY] is not None and r[spec.TS] is None
    assert list(r.asDict()) == RAW_SCHEMA.fieldNames()


def test_malformed_lines_are_kept_with_file_line_and_reason(spark, tmp_path):
    path = files(tmp_path, a="k,x,y\n1,1,1\n2,2\n\n3,three,1\n4,4,4,4\n5,,\n6,6,99999999999\n\"7,7,1\n", b="p,q\n1,2\n", c="k,x,y\n")
    quarantine = work_dir(spark, "quarantine")
    assert sorted(r["k"] for r in load_csv(spark, path, SCHEMA, quarantine).collect()) == [1, 5]
    bad = spark.read.parquet(quarantine).collect()
    found = sorted((os.path.basename(r["file"]), r["line"], r["record"], r["reason"]) for r in bad)
    split = "other number of values than the header"
    assert found == [("a.csv", 3, "2,2", split), ("a.csv", 5, "3,three,1", "values of another type in x"), ("a.csv", 6, "4,4,4,4", split),
                     ("a.csv", 8, "6,6,99999999999", "values of another type in y"), ("a.csv", 9, "\"7,7,1", split),
                     ("b.csv", 2, "1,2", "header names no column")]


def test_lines_are_numbered_over_splits(spark, tmp_path):
    text = "k,s\n" + "".join(f"{i},{'x' * (i % 50)}\n" if i % 7 else f"bad {i},,\n" for i in range(2, 2002))
    path = files(tmp_path, a=text, b=text)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scan = scan_csv(spark, path, SCHEMA)
        bad = scan.malformed.collect()
        good = scan.rows.groupBy("k").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert sorted((os.path.basename(r["file"]), r["line"]) for r in bad) == [(f, i) for f in ("a.csv", "b.csv") for i in range(2, 2002) if i % 7 == 0]
    assert {r["k"]: r["count"] for r in good} == {i: 2 for i in range(2, 2002) if i % 7}


def test_keys_come_from_content_and_occurrence(spark, tmp_path):
    rows = ["1,a"] * 900 + ["2,b"] * 3 + ["3,c"]
    one = files(tmp_path, a="x,s\n" + "\n".join(rows) + "\n")
    other = tmp_path / "more"
    other.mkdir()
    two = files(other, **{f"f{n}": "s,x\n" + "\n".join(",".join(reversed(r.split(","))) for r in rows[n::4]) + "\n" for n in range(4)})
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = [sorted(tuple(r) for r in scan_csv(spark, p, SCHEMA, "k").rows.select("s", "k").collect())
               for p in (f"{one}/a.csv", two)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert got[0] == got[1] and len({k for _, k in got[0]}) == 904
    # files that have the column keep it
    path = files(tmp_path, a="x,s\n1,a\n", b="k,x,s\n7,1,a\n")
    assert 7 in [r["k"] for r in scan_csv(spark, [f"{path}/a.csv", f"{path}/b.csv"], SCHEMA, "k").rows.collect()]


def test_what_cannot_be_read_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_csv(spark, f"file://{tmp_path}/none.csv", SCHEMA)
    with pytest.raises(ValueError, match="more than once"):
        scan_csv(spark, files(tmp_path, a="k,x,k\n1,2,3\n"), SCHEMA)
    empty = tmp_path / "empty"
    empty.mkdir()
    assert scan_csv(spark, files(empty, a="k,x\n", b=""), SCHEMA, "k").rows.select(F.max("k")).first()[0] is None


def test_training_sets_from_nine_raw_columns(spark, sf, tmp_path):
    """Raw files without key and time: preprocessed, split, written, read back."""
    from credence.fixtures import applications
    from credence.sources.readers import training_sets, write

    columns = [*spec.RAW_NUMERIC, *spec.RAW_CATEGORICAL, spec.TARGET]
    raw, root = work_dir(spark, "nine-raw"), work_dir(spark, "nine-root")
    df = applications(spark, sf).select(*columns)
    write(df, raw, "csv")
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(reversed(columns)) + "\n1,other\n")
    train, val, _ = training_sets(spark, root, [raw, f"file://{bad}"])
    n = df.count()
    assert train.count() + val.count() == n and val.count() == -(-n // 5)
    both = train.unionByName(val)
    assert both.select(spec.KEY).distinct().count() == n and both.where(F.col(spec.KEY).isNull()).count() == 0
    assert both.groupBy(spec.TARGET).count().orderBy(spec.TARGET).collect() == df.groupBy(spec.TARGET).count().orderBy(spec.TARGET).collect()
    [r] = spark.read.parquet(f"{root}/quarantine").collect()
    assert (r["line"], r["record"]) == (2, "1,other")


def test_a_line_is_cut_once(spark, tmp_path):
    path = files(tmp_path, a="k,x,s\n" + "".join(f"{i},{i}.5,v{i % 3}\n" for i in range(50)) + "bad,1,v\n")
    scan = scan_csv(spark, path, SCHEMA)
    for df, rows in ((scan.rows, 50), (scan.malformed, 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_csv(") == 1, plan
        assert df.count() == rows
