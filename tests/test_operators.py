"""Operator semantics against brute force on small inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import joins as J
from riskspark.operators import quality as Q
from riskspark.operators import sinks as SK


def test_window_join_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2020, 1, 1)
    left = [(rnd.randint(1, 4), base + dt.timedelta(days=rnd.randint(0, 900)), i) for i in range(300)]
    right = [(rnd.randint(1, 4), base + dt.timedelta(days=rnd.randint(0, 900)), j) for j in range(300)]
    L = spark.createDataFrame(left, "k int, ld date, lid int")
    R = spark.createDataFrame(right, "k int, rd date, rid int")
    got = {(r.lid, r.rid) for r in J.window_join(L, R, ["k"], "ld", "rd", -180, 0).collect()}
    want = {(a[2], b[2]) for a in left for b in right if a[0] == b[0] and -180 <= (b[1] - a[1]).days <= 0}
    assert got == want
    semi = {r.lid for r in J.window_join(L, R, ["k"], "ld", "rd", -180, 0, "left_semi").collect()}
    assert semi == {a for a, _ in want}
    anti = {r.lid for r in J.window_join(L, R, ["k"], "ld", "rd", -180, 0, "left_anti").collect()}
    assert anti == {a[2] for a in left} - semi


def test_assign_bid_is_dense_rank(spark):
    names = [f"n{random.Random(i).randint(0, 50):03d}" for i in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.bid for r in J.assign_bid(df, ["name"], 11, n_ranges=7).collect()}
    want = {n: 11 * 10 ** 12 + i + 1 for i, n in enumerate(sorted(set(names)))}
    assert got == want


def test_fuzzy_pairs_matches_brute_force(spark):
    rnd = random.Random(3)
    vals = ["small ring", "smal ring", "small rings", "red widget", "red widgets", "rod widget", "blue bolt", "mall ring", "a", ""]
    vals += sorted({"".join(rnd.choice("ab c") for _ in range(rnd.randint(1, 9))) for _ in range(80)} - set(vals))
    df = spark.createDataFrame([(v,) for v in vals * 3], "v string")

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            p, d[0] = d[0], i
            for j, cb in enumerate(b, 1):
                p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (ca != cb))
        return d[-1]
    near = {(a, b): 1.0 - lev(a, b) / max(len(a), len(b)) for a in vals for b in vals if a < b}
    for t in (0.8, 0.6, 1.0):
        got = {(r.value_a, r.value_b) for r in J.fuzzy_pairs(df, "v", t).collect()}
        assert got == {p for p, s in near.items() if s >= t}


def test_fuzzy_pairs_of_edited_values(spark):
    """Long values with edits bunched in one part or spread, at the number the threshold allows."""
    rnd, want, vals = random.Random(8), set(), set()
    for k in range(120):
        a = "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(12, 40)))
        b, edits = list(a), int(0.25 * len(a))
        at = [rnd.randrange(len(a)) for _ in range(edits)] if k % 2 else [rnd.randrange(min(edits + 1, len(a))) for _ in range(edits)]
        for p in at:
            p = min(p, len(b) - 1)
            kind = rnd.choice("ids") if k % 3 else "id"[k % 2]
            b[p:p + 1] = [] if kind == "d" else ["z"] if kind == "s" else [b[p], "z"]
        b = "".join(b)
        if a != b:
            vals |= {a, b}
            want.add((min(a, b), max(a, b)))
    df = spark.createDataFrame([(v,) for v in sorted(vals)], "v string")
    pairs = spark.createDataFrame(sorted(want), "a string, b string")
    exact = pairs.where(F.lit(1.0) - F.levenshtein("a", "b") / F.greatest(F.length("a"), F.length("b")) >= 0.75)
    near = {(r.a, r.b) for r in exact.collect()}
    assert len(near) > 60
    assert near <= {(r.value_a, r.value_b) for r in J.fuzzy_pairs(df, "v", 0.75).collect()}


def test_broadcast_size_check(spark):
    small = spark.range(10)
    assert J.estimated_bytes(small) < J.DEFAULT_BROADCAST_BYTES
    plan = J.checked_join(spark.range(1000), small, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_upsert_keeps_audit_and_rejects_duplicates(spark):
    tgt = spark.createDataFrame([(1, "a", "v1"), (2, "b", "v1")], "k int, val string, created_by string")
    src = spark.createDataFrame([(2, "B", "v2"), (3, "c", "v2")], "k int, val string, created_by string")
    out = sorted(tuple(r) for r in SK.upsert(tgt, src, ["k"]).collect())
    assert out == [(1, "a", "v1"), (2, "B", "v1"), (3, "c", "v2")]
    dup = spark.createDataFrame([(3, "c", "v2"), (3, "d", "v2")], "k int, val string, created_by string")
    with pytest.raises(Exception):
        SK.upsert(tgt, dup, ["k"]).collect()


def test_scoped_delete_and_insert_if_absent(spark):
    tgt = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "k int, grp string")
    src = spark.createDataFrame([(3, "x")], "k int, grp string")
    out = sorted(r.k for r in SK.upsert_scoped_delete(tgt, src, ["k"], F.col("grp") == "x", ()).collect())
    assert out == [2, 3]
    ins = sorted(r.k for r in SK.insert_if_absent(tgt, spark.createDataFrame([(3, "z"), (4, "z")], "k int, grp string"), ["k"]).collect())
    assert ins == [1, 2, 3, 4]


def test_salted_sum_equals_plain_sum(spark):
    rows = [(1 if i % 3 else i, float(i) / 7, i) for i in range(1000)]  # key 1 holds two thirds of the rows
    df = spark.createDataFrame(rows, "k long, v double, i long")
    got = {r.k: (round(r.sum_v, 2), r.n_rows) for r in Q.salted_sum(df, "k", "v", ["i"], 8).collect()}
    want = {}
    for k, v, _ in rows:
        s, n = want.get(k, (0.0, 0))
        want[k] = (s + round(v, 2), n + 1)
    assert {k: (round(s, 2), n) for k, (s, n) in want.items()} == got


def test_no_cross_joins_or_single_task_windows_in_library():
    import pathlib
    src = "\n".join(p.read_text() for p in pathlib.Path("riskspark").rglob("*.py"))
    assert "crossJoin" not in src
    assert "partitionBy()" not in src
    assert "localCheckpoint" not in src
    assert "monotonically_increasing_id()" not in src.replace("monotonically_increasing_id`", "")


def test_lookback_exclusion_matches_brute_force(spark):
    from riskspark.plans import gaps as G
    rnd = random.Random(11)
    base = dt.date(2019, 1, 1)
    ev = [(rnd.randint(1, 5), rnd.choice(["D030", "D031", "D001"]), base + dt.timedelta(days=rnd.randint(0, 700)))
          for _ in range(400)]
    trig = [(rnd.randint(1, 5), base + dt.timedelta(days=rnd.randint(0, 700)), rnd.choice(["EXA", "EXB"]), i)
            for i in range(200)]
    groups = spark.createDataFrame([("DIAGNOSIS", "EXA", "D030"), ("DIAGNOSIS", "EXB", "D031")],
                                   "claim_cd_type string, group_cd string, code string")
    claims = spark.createDataFrame(ev, "member_bid long, diag_cd string, claim_dt date")
    t = spark.createDataFrame(trig, "member_bid long, claim_dt date, exclusion_cd string, tid int")
    got = {r.tid: (r.excluded, r.excl_dt) for r in G.lookback_exclusion(t, claims, groups).collect()}
    code = {"EXA": "D030", "EXB": "D031"}
    want = {}
    for m, d, g, i in trig:
        hits = [e[2] for e in ev if e[0] == m and e[1] == code[g] and 0 <= (d - e[2]).days <= 180]
        want[i] = (1, min(hits)) if hits else (0, None)
    assert got == want


def test_period_filter_matches_brute_force(spark):
    from riskspark.operators import rules as OR
    from riskspark.sources import reference_data as R
    rnd = random.Random(5)
    days = [dt.date(1994, 6, 1) + dt.timedelta(days=rnd.randint(0, 3000)) for _ in range(300)]
    claims = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "claim_bid long, claim_dt date")
    rows = [*R.time_period_rows(), (9001, dt.date(1995, 3, 1), dt.date(1999, 2, 1), "LONG", 1999), (9002, dt.date(1996, 1, 1), dt.date(9999, 12, 31), "OPEN", 1996)]
    periods = spark.createDataFrame(rows,
                                    "time_period int, begin_date date, end_date date, period_type string, risk_year int")
    got = {(r.claim_bid, r.time_period) for r in OR.period_filter(claims, periods, "claim_dt").collect()}
    want = {(i, p[0]) for i, d in enumerate(days) for p in rows if p[1] <= d <= p[2]}
    assert got == want


def test_several_coverage_spans_do_not_multiply_claims(spark):
    import datetime as dt

    from riskspark.operators import rules
    d = dt.date
    claims = spark.createDataFrame([(1, 7, d(2000, 5, 1)), (2, 7, d(2003, 5, 1)), (3, 8, d(2000, 1, 1))], "claim_bid long, member_bid long, claim_dt date")
    spans = spark.createDataFrame([(7, d(1999, 1, 1), d(2000, 12, 31)), (7, d(2000, 1, 1), d(2001, 12, 31)), (7, d(2010, 1, 1), d(2011, 1, 1))],
                                  "member_bid long, covrg_begin_dt date, covrg_end_dt date")
    got = sorted((r["claim_bid"], r["date_status"]) for r in rules.claim_dates_valid(claims, spans).collect())
    assert got == [(1, "VALID"), (2, "OUT_OF_PERIOD"), (3, "OUT_OF_PERIOD")]


def test_percentiles_are_exact(spark):
    import math
    import random

    from riskspark.operators import aggs
    rng = random.Random(0)
    rows = [(g, float(rng.choice([rng.randrange(5), rng.randrange(10_000)]))) for g in "aab" for _ in range(4000)] + [("c", 1.0), ("d", None)]
    got = {r["g"]: tuple(r)[1:] for r in aggs.percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.1, 0.5, 0.9]).collect()}
    for g in "abc":
        v = sorted(x for k, x in rows if k == g)
        assert got[g] == tuple(v[max(1, math.ceil(round(len(v) * q, 6))) - 1] for q in (0.1, 0.5, 0.9))


def test_coverage_keeps_years_beyond_the_period_table(spark):
    import datetime as dt

    from riskspark.plans import scoring
    d = dt.date
    e = spark.createDataFrame([(1, d(1990, 3, 1), d(1991, 2, 1)), (2, d(2010, 1, 1), d(2011, 6, 1)), (3, d(2000, 1, 1), d(9999, 12, 31))],
                              "member_bid long, covrg_begin_dt date, covrg_end_dt date")
    got = sorted((r["member_bid"], r["risk_year"]) for r in scoring.enrollment_years(e, 2002).collect())
    assert got == [(1, 1990), (1, 1991), (2, 2010), (2, 2011), (3, 2000), (3, 2001), (3, 2002)]
