"""Data-quality, reconciliation and change-detection operators."""

import datetime as dt

from pyspark.sql import functions as F

from riskspark.operators import aggs as A
from riskspark.operators import quality as Q
from riskspark.sources import files as FS


def test_quality_checks_counts(spark):
    df = spark.createDataFrame([(1, 1, None, 1), (1, 1, "a", 9), (2, 1, "b", 2)], "k1 int, k2 int, c string, t int")
    out = {(r.check_name, r.column_name): r.failed_count for r in
           Q.quality_checks(df, ["c"], ["k1", "k2"], {"t": [1, 2]}).collect()}
    assert out == {("null_count", "c"): 1, ("invalid_value", "t"): 1, ("duplicate_key", "k1,k2"): 1}


def test_expectations_mostly(spark):
    df = spark.createDataFrame([(i, "H0001" if i < 9 else "bad") for i in range(10)], "id int, code string")
    rules = [{"name": "fmt", "kind": "regex", "column": "code", "pattern": "^H[0-9]{4}$", "mostly": 0.9},
             {"name": "fmt_strict", "kind": "regex", "column": "code", "pattern": "^H[0-9]{4}$"},
             {"name": "rows", "kind": "row_count_between", "min": 1, "max": 5}]
    out = {r.expectation: (r.success, r.unexpected_count) for r in Q.expectations(df, rules).collect()}
    assert out == {"fmt": (True, 1), "fmt_strict": (False, 1), "rows": (False, 0)}


def test_reconcile_and_relationships(spark):
    s = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k int, v double")
    t = spark.createDataFrame([(1, 10.0), (2, 20.5), (4, 40.0)], "k int, v double")
    r = Q.reconcile(s, t, ["k"], {"v": 0.1}).collect()[0]
    assert (r.source_count, r.target_count, r.matched, r.missing_in_target, r.extra_in_target, r.value_mismatches,
            r.status) == (3, 3, 2, 1, 1, 1, "FAIL")
    child = spark.createDataFrame([(1,), (None,), (5,)], "fk int")
    rel = Q.relationships(child, "fk", s, "k", "rule").collect()[0]
    assert (rel.child_rows, rel.null_fk, rel.orphan_count) == (3, 1, 1)


def test_incremental_new_and_changed(spark):
    prev = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 1))], "k int, upd date")
    cur = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 2, 1)), (3, dt.date(2020, 1, 1))],
                                "k int, upd date")
    out = {r.k: r.change_type for r in Q.incremental(cur, prev, ["k"], "upd").collect()}
    assert out == {2: "CHANGED", 3: "NEW"}


def test_profile_and_share(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "a int, b string")
    p = {r.column_name: (r.null_count, r.distinct_count, r.row_count) for r in A.profile(df).collect()}
    assert p == {"a": (0, 2, 3), "b": (1, 1, 3)}
    sh = {r.a: r.pct_of_total for r in A.share_of_total(df, "a").collect()}
    assert sh == {1: round(100 / 3, 4), 2: round(200 / 3, 4)}


def test_schema_from_mapping_and_fixed_width(spark, tmp_path):
    sch = FS.schema_from_mapping("k: integer\nname: string  # comment\nwhen: date\nodd: weird")
    assert [(f.name, f.dataType.simpleString()) for f in sch.fields] == [
        ("k", "int"), ("name", "string"), ("when", "date"), ("odd", "string")]
    layout = [("id", 1, 6, "int"), ("name", 6, 12, "string"), ("d", 12, 20, "date")]
    df = spark.createDataFrame([(7, "abc", dt.date(2021, 3, 4))], "id int, name string, d date")
    path = str(tmp_path / "fw")
    FS.to_fixed_width(df, layout, "D").unionByName(spark.createDataFrame([("H header",)], "value string")) \
        .write.text(path)
    back = FS.load_fixed_width(spark, path, layout, "D").collect()
    assert [tuple(r) for r in back] == [(7, "abc", dt.date(2021, 3, 4))]
