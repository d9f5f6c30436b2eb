"""Interval joins, record files, dealing, against brute force."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskspark.operators import intervals as I
from riskspark.operators import quality as Q
from riskspark.operators import rules as OR
from riskspark.operators.windows import number_within
from riskspark.plans import gaps as G
from riskspark.sources import records as RS

DAY0 = dt.date(1996, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def spans(rng, n, members):
    out = []
    for i in range(n):
        a = rng.randrange(-500, 1500)
        out.append((rng.choice(members), i, day(a), day(a + rng.choice([0, 0, 3, 15, 16, 63, 64, 130, 255, 399, rng.randrange(400)]))))
    return out + [("m0", n, None, day(3)), ("m0", n + 1, day(3), None), ("m0", n + 2, day(9), day(8)), (None, n + 3, day(0), day(9)),
                  ("m1", n + 4, dt.date(1, 1, 1), dt.date(9999, 12, 31))]


def test_interval_join_is_brute_force(spark):
    rng = random.Random(1)
    members = ["m0"] * 6 + [f"m{i}" for i in range(1, 9)]  # m0 holds nearly half
    claims = spans(rng, 400, members)
    points = [(rng.choice(members), rng.randrange(40), day(rng.randrange(-520, 2000))) for _ in range(500)] + [("m0", 1, None), (None, 2, day(3)), ("m3", 3, day(5)), ("m3", 3, day(5))]
    left = spark.createDataFrame(points, "member string, icn int, dos date")
    right = spark.createDataFrame(claims, "member string, claim int, first date, last date")

    def meets(p, c):
        return p[0] is not None and p[0] == c[0] and None not in (p[2], c[2], c[3]) and c[2] <= p[2] <= c[3]
    pairs = Counter((*p, c[1]) for p in points for c in claims if meets(p, c))
    got = I.interval_join(left, right, ["member"], "dos", "first", "last")
    assert Counter(map(tuple, got.select("member", "icn", "dos", "claim").collect())) == pairs and len(pairs) > 300
    for how, keep in (("left_semi", True), ("left_anti", False)):
        got = I.interval_join(left, right, ["member"], "dos", "first", "last", how)
        assert got.columns == left.columns
        assert Counter(map(tuple, got.collect())) == Counter(p for p in points if any(meets(p, c) for c in claims) == keep)


def test_merge_intervals(spark):
    rng = random.Random(2)
    claims = spans(rng, 200, [f"m{i}" for i in range(8)])[:200]
    got = I.merge_intervals(spark.createDataFrame(claims, "member string, claim int, first date, last date"), ["member"], "first", "last").collect()
    days = {}
    for m, _, a, b in claims:
        days.setdefault(m, set()).update((a - DAY0).days + i for i in range((b - a).days + 1))
    seen = {}
    for r in got:
        own = {(r["first"] - DAY0).days + i for i in range((r["last"] - r["first"]).days + 1)}
        assert not own & seen.setdefault(r["member"], set()) and min(own) - 1 not in days[r["member"]] and max(own) + 1 not in days[r["member"]]
        seen[r["member"]] |= own
    assert seen == days


def test_interval_join_empty(spark):
    left = spark.createDataFrame([("a", DAY0)], "member string, dos date")
    none = spark.createDataFrame([], "member string, first date, last date")
    assert I.interval_join(left, none, ["member"], "dos", "first", "last").count() == 0
    assert I.interval_join(left, none, ["member"], "dos", "first", "last", "left_anti").count() == 1
    assert I.interval_join(left.limit(0), none, ["member"], "dos", "first", "last", "left_semi").count() == 0


def test_number_within(spark):
    rng = random.Random(3)
    data = [(rng.choice(["hot"] * 5 + ["a", "b", None]), rng.randrange(50), i) for i in range(600)]
    got = number_within(spark.createDataFrame(data, "k string, o int, i int"), ["k"], ["o", "i"]).collect()
    for k in {d[0] for d in data}:
        want = sorted((d[1], d[2]) for d in data if d[0] == k)
        assert sorted((r["n"], r["o"], r["i"]) for r in got if r["k"] == k) == [(n + 1, *x) for n, x in enumerate(want)]


LINES = [("c1", "A1", "m1", i, f"D{i:03d}", "A" if i % 3 else "D") for i in range(100)] + [("c2", "A2", "m2", 0, "D9", "A"), ("c3", None, "m2", 0, "E119", None)]


def test_codes_are_dealt_over_records_and_come_back(spark, tmp_path):
    lines = spark.createDataFrame(LINES, "icn string, allowed_flag string, mbi string, n int, dx string, f string").withColumn("allowed_flag", F.substring("allowed_flag", 1, 1))
    wide = RS.deal_codes(lines, ["icn", "mbi", "allowed_flag"], "dx", "f", ["n"], RS.MAO_004)
    assert Counter((r["icn"], r["record"]) for r in wide.collect()) == Counter([("c1", 1), ("c1", 2), ("c1", 3), ("c2", 1), ("c3", 1)])
    path = f"{tmp_path}/mao"
    RS.write_records(wide, path, RS.MAO_004, {"report_id": F.lit("R1"), "contract_id": F.lit("H0001"), "report_date": F.lit(DAY0)})
    raw = [r["value"] for r in spark.read.text(path).collect()]
    assert Counter(x[0] for x in raw) == {"H": 1, "D": 5, "T": 1} and {len(x) for x in raw if x[0] == "D"} == {397}
    assert [x for x in raw if x[0] == "T"][0] == "TR1      H0001 " + "5".ljust(10) and {len(x) for x in raw if x[0] == "H"} == {118}
    back = RS.read_records(spark, path, RS.MAO_004)
    got = OR.unpivot_pairs(back, ["icn", "mbi"], RS.MAO_004.code, RS.MAO_004.flag, 38).select("icn", "mbi", "code", "flag")
    assert Counter(map(tuple, got.collect())) == Counter((x[0], x[2], x[4], x[5]) for x in LINES)
    # a lost detail, a line of no known kind and a value too long for its field are errors
    spark.createDataFrame([(x,) for x in raw if "c2" not in x], "value string").write.text(f"{tmp_path}/lost")
    spark.createDataFrame([(x,) for x in [*raw, "X?"]], "value string").write.text(f"{tmp_path}/odd")
    for bad in ("lost", "odd"):
        with pytest.raises(ValueError):
            RS.read_records(spark, f"{tmp_path}/{bad}", RS.MAO_004)
    with pytest.raises(Exception, match="icn has 17 characters"):
        RS.write_records(wide.withColumn("icn", F.lit("x" * 18)), f"{tmp_path}/long", RS.MAO_004, {})


def test_layout_has_38_pairs():
    ends = {f[0]: (f[1], f[2]) for f in RS.MAO_004.detail}
    assert ends["diag_code_01"] == (93, 100) and ends["diag_flag_06"] == (140, 141) and ends["diag_flag_38"] == (396, 397)


def test_entry_without_the_corpus_operators():
    """With the corpus folder gone, all other queries and their SQL are still there, the pipeline is not."""
    import subprocess
    import sys
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == 'riskspark.llm' or name.startswith('riskspark.llm.'):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
assert len(q) >= 197 and set(o) <= set(q) and len(o) >= 196
assert not [n for n in q if n == 'pipeline' or n.startswith('op')]
"""
    root = __file__.rsplit("/", 2)[0]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_snapshot_load_rewrites_touched_partitions_only(spark, tmp_path):
    from riskspark.operators.snapshots import Snapshot, key_range
    schema = "id bigint, v string, created_by string"
    snap = Snapshot(f"{tmp_path}/snap", ("id",), key_range("id", 100))
    assert snap.read(spark) is None
    first = [(i, f"old{i}", "one") for i in range(1000)] + [(None, "no key", "one")]
    assert snap.load(spark.createDataFrame(first, schema)) == [*[str(i) for i in range(10)], "none"]
    before = snap.manifest(spark)
    files = {p: sorted((f.name, f.stat().st_mtime_ns) for f in __import__("pathlib").Path(d).iterdir()) for p, d in before.items()}
    second = [(250, "new", "two"), (251, "new", "two"), (1234, "new", "two")]
    assert snap.load(spark.createDataFrame(second, schema)) == ["12", "2"]
    after = snap.manifest(spark)
    assert {p for p in after if after[p] != before.get(p)} == {"2", "12"}
    assert all(files[p] == sorted((f.name, f.stat().st_mtime_ns) for f in __import__("pathlib").Path(after[p]).iterdir()) for p in before if p != "2")
    want = {i: (f"old{i}", "one") for i in range(1000)} | {None: ("no key", "one"), 250: ("new", "one"), 251: ("new", "one"), 1234: ("new", "two")}
    assert {r["id"]: (r["v"], r["created_by"]) for r in snap.read(spark).collect()} == want and snap.read(spark).count() == len(want)
    assert snap.read(spark, 1).count() == 1001  # the load before is still whole
    assert snap.load(spark.createDataFrame([], schema)) == [] and snap.read(spark).count() == len(want)


def test_partitioned_write_splits_a_big_value(spark, tmp_path):
    import pathlib
    from riskspark.operators import sinks as SK
    df = spark.range(10_000).select("id", F.when(F.col("id") % 10 != 0, "big").when(F.col("id") % 100 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("v"), (F.col("id") % 70).cast("string"))).alias("p"), F.lit("x" * 20).alias("t"))
    path = SK.write_snapshot(df, f"{tmp_path}/out", ["p"], file_bytes=40_000)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in pathlib.Path(path).iterdir() if d.is_dir()}
    assert files["p=big"] >= 6 and all(n == 1 for d, n in files.items() if d != "p=big")
    back = spark.read.schema(df.schema).parquet(path)
    assert back.select("id", "p", "t").exceptAll(df.select("id", "p", "t")).count() == 0 and back.count() == 10_000
    assert spark.read.parquet(SK.write_snapshot(df.limit(0), f"{tmp_path}/none")).count() == 0


def test_profile(spark):
    from riskspark.operators import aggs as A
    df = spark.createDataFrame([(1, "a", None), (2, "a", 1.0), (None, "a", 1.0), (2, None, 2.5)], "`a.b` int, s string, d double")
    got = {r["column_name"]: (r["null_count"], r["null_pct"], r["distinct_count"], r["row_count"], r["column_count"]) for r in A.profile(df).collect()}
    assert got == {"a.b": (1, 25.0, 2, 4, 3), "s": (1, 25.0, 1, 4, 3), "d": (1, 25.0, 2, 4, 3)}
    assert "Expand" not in A.profile(df)._jdf.queryExecution().toString()
    assert {r["row_count"] for r in A.profile(df.limit(0)).collect()} == {0}


def test_quarantine_keeps_every_row(spark):
    from riskspark.operators.quality import quarantine
    df = spark.createDataFrame([(1, "D1"), (2, None), (None, "D1"), (None, "bad"), (1, "D1")], "m int, c string")
    good, bad = quarantine(df, {"NO_MEMBER": F.col("m").isNotNull(), "BAD_CODE": F.col("c").startswith("D")})
    assert sorted(map(tuple, good.collect())) == [(1, "D1"), (1, "D1")] and good.columns == df.columns
    assert {(r["m"], r["c"]): r["reasons"] for r in bad.collect()} == {(2, None): ["BAD_CODE"], (None, "D1"): ["NO_MEMBER"], (None, "bad"): ["BAD_CODE", "NO_MEMBER"]}


def test_step_log_counts_in_one_run(spark):
    from riskspark.operators.quality import StepLog
    log = StepLog()
    a = log.step("all", spark.range(100))
    b = log.step("even", a.where("id % 2 = 0"))
    log.step("none", b.where("id < 0")).write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in log.frame(spark).collect()] == [(0, "all", None, 100, None), (1, "even", 100, 50, -50.0), (2, "none", 50, 0, -100.0)]


def test_confidence_bounds_are_uneven_and_open(spark):
    from riskspark.plans import persistence as P
    table = spark.createDataFrame([(30, 1, 2, 0.9), (120, 1, 2, 0.8), (180, 1, 2, 0.7), (360, 1, 999, 0.6), (None, 1, 2, 0.5), (None, 3, 999, 0.4)],
                                  "last_bound int, freq_min int, freq_max int, weight double")
    asked = [(0, 1, 0.9), (30, 2, 0.9), (31, 1, 0.8), (125, 1, 0.7), (150, 2, 0.7), (181, 1, 0.6), (330, 50, 0.6), (361, 1, 0.5), (9000, 1000, 0.4), (125, 3, None), (None, 1, None)]
    got = P.confidence_lookup(spark.createDataFrame([x[:2] for x in asked], "duration int, frequency int"), table).collect()
    assert Counter((r["duration"], r["frequency"], r["confidence_factor"]) for r in got) == Counter(asked)


def test_gap_interactions(spark):
    gaps = spark.createDataFrame([("v28", 1, 1999, 5, 0.8), ("v28", 1, 1999, 17, 0.9), ("v24", 1, 1999, 5, 0.8), ("v28", 2, 1999, 9, 0.75)],
                                 "version string, member_bid int, risk_year int, cc_id int, combined_confidence double")
    coded = spark.createDataFrame([("v28", 1, 1999, 1), ("v28", 1, 1999, 1), ("v24", 1, 1998, 1), ("v28", 3, 1999, 1), ("v28", 3, 1999, 5), ("v28", 2, 1999, 9)],
                                  "version string, member_bid int, risk_year int, hcc int")
    rules = spark.createDataFrame([("A", 1, 5, 0.1), ("B", 5, 17, 0.2), ("C", 9, 20, 0.3)], "interaction_name string, hcc1 int, hcc2 int, score double")
    got = {(r["version"], r["member_bid"], r["interaction_name"], r["confidence"]) for r in G.gap_interactions(gaps, coded, rules).collect()}
    assert got == {("v28", 1, "A", 0.8), ("v28", 1, "B", 0.72)}  # member 3's pair is coded already


def test_merge_sources_takes_the_first_that_has_it(spark):
    from riskspark.operators.master import merge_sources
    a = spark.createDataFrame([(" p1 ", "n1", None), ("p2", "", "x"), ("", "lost", "lost")], "id string, name string, kind string")
    b = spark.createDataFrame([("p1", "other", "b2"), ("p1", "other", "b1"), ("p3", None, " "), (None, "lost", "lost")], "id string, name string, kind string")
    c = spark.createDataFrame([("p2", "c"), ("p3", "c")], "id string, name string")
    got = {r["id"]: (r["name"], r["kind"], r["first_source"], r["n_sources"]) for r in merge_sources({"a": a, "b": b, "c": c}, ["id"], ["name", "kind"]).collect()}
    assert got == {"p1": ("n1", "b1", "a", 2), "p2": ("c", "x", "a", 2), "p3": ("c", None, "b", 2)}


def test_a_new_model_is_a_row(spark):
    from riskspark.plans import models as MD
    pop = spark.createDataFrame([(1, 1999, "CNA", 70, "F"), (2, 1999, "INS", 80, "M")], "member_bid int, risk_year int, model_segment string, age_yr int, memb_gender_cd string")
    diag = spark.createDataFrame([(1, 1999, "X1"), (1, 1999, "X2"), (1, 1999, "X9"), (2, 1999, "X2")], "member_bid int, risk_year int, diag_cd string")
    icd = spark.createDataFrame([("mapA", "X1", 5), ("mapA", "X2", 6), ("mapB", "X2", 7)], "version string, diag_cd string, hcc int")
    hier = spark.createDataFrame([("hA", 5, 6)], "version string, parent int, child int")
    coef = spark.createDataFrame([("cA", "CNA_HCC5", 0.5), ("cA", "CNA_HCC6", 0.25), ("cB", "cna_hcc7", 0.125), ("cA", "CNA_F70", 1.0), ("cA", "CNA_D1", 2.0)], "version string, name string, score double")
    schema = "model_id string, family string, map_set string, hierarchy_set string, coefficient_set string, segments string, scores_count string"
    rows = [("one", "f", "mapA", "hA", "cA", "CNA", "Y"), ("two", "f", "mapA", "none", "cA", "CNA", "N"), ("new", "g", "mapB", "hA", "cB", "CNA,INS", "N")]
    got = {(r["model_id"], r["member_bid"]): (r["hcc_score"], r["hcc_count"], r["raw_score"]) for r in
           MD.score_models(pop, diag, spark.createDataFrame(rows, schema), icd, hier, coef).collect()}
    assert got == {("one", 1): (0.5, 1, 3.5), ("two", 1): (0.75, 2, 1.75), ("new", 1): (0.125, 1, 0.125), ("new", 2): (0.0, 1, 0.0)}


def test_lines_without_a_rule_code_go(spark):
    claims = spark.createDataFrame([(1, "D1", "P9"), (2, "D9", "P1"), (3, "D9", "P9"), (4, None, None), (5, "P1", "D1"), (6, "X1", "M1"),
                                    (1, "D1", "P9")], "claim_bid int, diag_cd string, cpt_cd string")
    rules = spark.createDataFrame([("DIAGNOSIS", "D1"), ("DIAGNOSIS", "D1"), ("CPT-HCPCS", "P1"), ("NDC", "D9")], "claim_cd_type string, claim_cd string")
    groups = spark.createDataFrame([("G", "DIAGNOSIS", "X1"), ("H", "CPT-HCPCS", "M1"), ("I", "CPT-HCPCS", "M1")], "group_cd string, claim_cd_type string, code string")
    kept = G.with_rule_code(claims, rules, groups)
    assert kept.columns == claims.columns
    assert sorted(r.claim_bid for r in kept.collect()) == [1, 1, 2, 6]


def test_create_or_upsert_by_a_path_with_a_scheme(spark, tmp_path):
    from riskspark.queries.q_sinks import create_or_upsert
    path = f"file://{tmp_path}/deep/er/t"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert create_or_upsert(spark, path, rows, ["k"]) == path
    second = create_or_upsert(spark, path, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert second != path
    assert sorted(map(tuple, spark.read.parquet(second).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b")]


def test_cached_frame_is_released(spark):
    df = spark.range(10)
    with Q.cached(df) as held:
        assert held.is_cached
        assert held.count() == 10
    assert not held.is_cached
    with pytest.raises(ZeroDivisionError):
        with Q.cached(df) as held:
            1 / 0
    assert not held.is_cached
