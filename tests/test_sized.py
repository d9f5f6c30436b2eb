"""Tasks of a bounded number of rows, and record files by runs of fields."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskspark.operators import joins as J
from riskspark.operators import rules as OR
from riskspark.operators.windows import number_within
from riskspark.plans import persistence as P
from riskspark.queries.common import Inputs
from riskspark.sources import domain as D
from riskspark.sources import records as RS
from riskspark.sources import reference as REF


def partitions(plan: str) -> set[str]:
    return {x.split("REPARTITION_BY_NUM")[0].split("hashpartitioning(")[1] for x in plan.splitlines() if "REPARTITION_BY_NUM" in x}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sized_grows_with_the_rows(spark):
    a, b = spark.range(100).toDF("k"), spark.range(50).toDF("k")
    assert J.sized([a, b], 10, ["k"], 10) == [a, b]
    assert {f.rdd.getNumPartitions() for f in J.sized([a, b], 1000, ["k"], 10)} == {100}
    x, y = J.sized([a, b], 1000, ["k"], 10)
    assert sorted(r["k"] for r in x.join(y, "k").collect()) == list(range(50))


@pytest.fixture
def claims(spark, tmp_path, monkeypatch):
    """400 claims of 40 members; a task takes so few rows that their join needs 25."""
    monkeypatch.setattr(J.sized, "__defaults__", (48,))
    n = spark.range(400)
    n.select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(10.0).alias("o_totalprice"),
             F.lit("1997-03-04").cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1200).select((F.col("id") % 400).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
                             F.lit(1.0).alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"), F.lit("1997-03-04").cast("timestamp_ntz").alias("l_shipdate"),
                             F.lit("R").alias("l_returnflag")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_claim_lines_are_dealt_by_their_number(spark, claims):
    assert D.table_rows(spark, claims, "lineitem") == 1200
    lines = D.claim_line(spark, claims)
    assert lines.count() == 1200
    dealt = partitions(plan_of(lines.select("claim_bid", "cpt_cd").distinct()))
    assert len(dealt) == 2 and all(int(x.split(", ")[1].rstrip(")")) >= 25 for x in dealt)


def test_the_population_is_never_broadcast(spark, claims):
    """Its files are far smaller than its hash table."""
    inp = Inputs(spark, claims, cut=False)
    plan = plan_of(inp.claim_hcc())
    assert "SortMergeJoin [member_bid" in plan and any(x.startswith("member_bid") for x in partitions(plan))


def member_shuffles(df) -> list[int]:
    """The partitions of each shuffle by members, among other keys."""
    keys = [x.split("hashpartitioning(")[1].split(")")[0].split(", ") for x in plan_of(df).splitlines() if "hashpartitioning(" in x]
    return [int(k[-1]) for k in keys if any(c.startswith("member_bid") for c in k)]


def test_coverage_becomes_years_in_dealt_tasks(spark, claims):
    """40 members of about 8 years: the years of a file are not made, nor grouped, in the task that reads it."""
    plan = plan_of(Inputs(spark, claims, cut=False).population())
    assert any(x.startswith("member_bid") for x in partitions(plan))
    assert len(member_shuffles(Inputs(spark, claims, cut=False).population())) == 2


@pytest.mark.parametrize("name", ["per_status", "per_duration", "per_confidence", "set_union_status", "per_prior_filter", "per_current_filter",
                                  "per_suppress_prior", "per_suppress_current", "per_year_flags", "jn_carryforward", "jn_backing_split",
                                  "jn_prior_current_priority", "jn_confidence_lookup", "win_frequency", "win_max_date"])
def test_steps_after_the_claims_are_dealt_by_their_number(spark, claims, monkeypatch, name):
    """1,200 lines at 48 a task: no shuffle by member has fewer than 25 partitions (the session's number is 8)."""
    from riskspark.registry import load_all
    ch = spark.createDataFrame([("v28", 1, 1996, 1, "D001", 18)], "version string, member_bid long, risk_year int, claim_bid long, diag_cd string, hcc int") \
        .withColumn("claim_dt", F.lit("1996-03-04").cast("date")).repartition(3)
    monkeypatch.setattr(Inputs, "CUT", ())
    monkeypatch.setattr(Inputs, "claim_hcc", lambda self: ch)
    found = member_shuffles(load_all()[name](spark, claims))
    assert found and min(found) >= 25


def test_dealt_statuses_are_the_plain_ones(spark, monkeypatch):
    """Several years, codes with parents and children, two versions, repeated rows and members without an id."""
    monkeypatch.setattr(J.sized, "__defaults__", (48,))
    pairs = [tuple(r) for r in REF.hierarchy_pairs(spark).select("version", "parent", "child").collect()]
    chronic = {r["hcc"] for r in REF.chronic(spark).collect()}
    linked = sorted({c for v, *pc in pairs if chronic & set(pc) for c in pc})
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        y = rnd.randrange(4, 9)
        rows.append((rnd.choice(["v28", "v24"]), rnd.choice([None, *range(9)]), 1990 + y, i // 3, f"199{y}-03-0{1 + i % 7}", f"D{i % 3}", rnd.choice(linked)))
    ch = spark.createDataFrame(rows + rows[:50], "version string, member_bid long, risk_year int, claim_bid long, d string, diag_cd string, hcc int") \
        .select("version", "member_bid", "risk_year", "claim_bid", F.col("d").cast("date").alias("claim_dt"), "diag_cd", "hcc")
    years = REF.time_periods(spark).where("period_type = 'C'").select("risk_year").distinct()
    plain, sized = [Counter(map(tuple, P.statuses(ch, REF.chronic(spark), REF.hierarchy_pairs(spark), REF.prior_year(spark), years, size=n).collect()))
                    for n in (0, 1200)]
    assert plain == sized and len(plain) > 100

    prior, coded = P.prior_filter(P.chronic_source(ch, REF.chronic(spark)), years), P.year_codes(ch)
    want: Counter = Counter()
    now = {tuple(r) for r in coded.collect()}
    for p in {tuple(r[k] for k in P.KEY) for r in prior.collect() if r["member_bid"] is not None}:
        links = [(p[3], "SAME")] + [(c, "CHILD_CODED") for v, a, c in pairs if (v, a) == (p[0], p[3])] \
            + [(a, "PARENT_CODED") for v, a, c in pairs if (v, c) == (p[0], p[3])]
        want.update((*p, c, how) for c, how in links if (*p[:3], c) in now)
    for n in (0, 1200):
        assert Counter(map(tuple, P.prior_current_relation(prior, coded, REF.hierarchy_pairs(spark), n).collect())) == want
    assert {k[-1] for k in want} == {"SAME", "CHILD_CODED", "PARENT_CODED"}


def test_ref_codes_read_the_lines_once(spark, claims):
    from riskspark.queries.q_joins import jn_ref_codes
    df = jn_ref_codes(spark, claims)
    assert plan_of(df).count("FileScan parquet") == 2
    lines = D.claim_line(spark, claims)
    want = {(r["claim_bid"], t, r[c]) for r in lines.collect() for t, c in (("CPT-HCPCS", "cpt_cd"), ("DIAGNOSIS", "diag_cd"))}
    assert {(r["claim_bid"], r["code_type"], r["code"]) for r in df.collect()} == want


def test_number_within_across_ranges(spark):
    """Keys that go on over many ranges, null keys, and keys inside one range, by two keys."""
    rows = [("hot" if i % 3 else None, i % 2, i) for i in range(900)] + [(f"k{i}", 0, i) for i in range(50)]
    df = spark.createDataFrame(rows, "a string, b int, i int").repartition(7)
    got = Counter((r["a"], r["b"], r["i"], r["n"]) for r in number_within(df, ["a", "b"], ["i"]).collect())
    want: Counter = Counter()
    for key in {r[:2] for r in rows}:
        want.update((*key, i, n + 1) for n, i in enumerate(sorted(r[2] for r in rows if r[:2] == key)))
    assert got == want


def test_offsets_have_no_row_of_a_key_inside_one_range(spark):
    """The only joins of numbering are with the ends of the ranges, by broadcast."""
    plan = plan_of(number_within(spark.range(100).select((F.col("id") % 9).alias("k"), "id"), ["k"], ["id"]))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_records_with_gaps_and_late_pairs(spark, tmp_path):
    """Blank pairs between and before filled ones, and letters beyond ASCII, keep their places."""
    layout = RS.MAO_004
    filled = {"a": {1: ("D1", "A")}, "b": {20: ("D20", None), 38: ("é😀", "D")}, "c": {}, "d": {i: (f"D{i}", "A") for i in range(1, 39)}}
    names = [n for i in range(1, 39) for n in (layout.code.format(i), layout.flag.format(i))]
    rows = [(k, *[x for i in range(1, 39) for x in v.get(i, (None, None))]) for k, v in filled.items()]
    wide = spark.createDataFrame(rows, "icn string, " + ", ".join(f"{n} string" for n in names))
    RS.write_records(wide, f"{tmp_path}/r", layout, {"report_id": F.lit("R"), "contract_id": F.lit("H")})
    assert {len(r["value"]) for r in spark.read.text(f"{tmp_path}/r").collect() if r["value"][0] == "D"} == {397}
    got = OR.unpivot_pairs(RS.read_records(spark, f"{tmp_path}/r", layout), ["icn"], layout.code, layout.flag, 38).collect()
    assert Counter(map(tuple, got)) == Counter((k, i, *p) for k, v in filled.items() for i, p in v.items())


def test_encounter_lines_are_shuffled_once(spark, claims):
    """Lines and orders are dealt out by the order in tasks of bounded size, and records are made there: no other shuffle, no copy of the lines."""
    from riskspark.plans import claims as C
    inp = Inputs(spark, claims)
    plan = plan_of(C.mao_records(C.mao_lines(inp.table("lineitem"), inp.table("orders"), inp.most_rows())))
    assert plan.count("Exchange hashpartitioning") == len(partitions(plan)) == 2 and "rangepartitioning" not in plan
    assert all(int(x.split(", ")[1].rstrip(")")) >= 25 for x in partitions(plan))


def test_records_made_in_place_are_those_of_numbered_lines(spark):
    """An order of many records, orders without an id or a customer, repeated rows, by both ways."""
    from riskspark.plans import claims as C
    rows = [(0 if i % 2 else i % 30, i % 7, i % 5, i % 3, 1.0, 1.0 + i % 2) for i in range(900)]
    li = spark.createDataFrame(rows + rows[:20] + [(None, 1, 1, 1, 1.0, 1.0), (3, None, None, None, None, None)],
                               "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_quantity double") \
        .withColumn("l_shipdate", F.expr("timestamp_ntz'1997-03-04' + make_dt_interval(l_linenumber)"))
    orders = spark.createDataFrame([(i, None if i == 4 else i) for i in range(30)] + [(5, 99)], "o_orderkey long, o_custkey long")
    lines = C.mao_lines(li, orders)
    plain = RS.deal_codes(lines, C.MAO_KEYS, "diag_cd", "diag_flag", C.MAO_ORDER, RS.MAO_004)
    placed = C.mao_records(lines)
    assert placed.columns == plain.columns
    assert Counter(map(tuple, placed.collect())) == Counter(map(tuple, plain.collect()))
    assert placed.agg(F.max("record")).first()[0] > 3


def test_records_are_small_on_disk(spark, tmp_path):
    """Lines are mostly blank; their files take a small part of the lines' characters."""
    wide = spark.range(5000).select(F.col("id").cast("string").alias("icn"), *[F.lit(v if i == 1 else None).cast("string").alias(n.format(i))
                                    for i in range(1, 39) for n, v in ((RS.MAO_004.code, "D001"), (RS.MAO_004.flag, "A"))])
    RS.write_records(wide, f"{tmp_path}/r", RS.MAO_004, {})
    assert sum(f.stat().st_size for f in (tmp_path / "r").glob("part-*")) < 5000 * 397 / 8
    assert RS.read_records(spark, f"{tmp_path}/r", RS.MAO_004).count() == 5000


def some_claims(spark, n=1500):
    linked = sorted({c for r in REF.hierarchy_pairs(spark).select("parent", "child").collect() for c in r})
    rnd = random.Random(5)
    rows = [(rnd.choice(["v28", "v24"]), rnd.choice([None, *range(20)]), 1990 + rnd.randrange(4, 9), i // 3, f"199{i % 9}-03-0{1 + i % 7}", f"D{i % 3}",
             rnd.choice(linked)) for i in range(n)]
    return spark.createDataFrame(rows + rows[:50], "version string, member_bid long, risk_year int, claim_bid long, d string, diag_cd string, hcc int") \
        .select("version", "member_bid", "risk_year", "claim_bid", F.col("d").cast("date").alias("claim_dt"), "diag_cd", "hcc")


def test_statuses_in_place_shuffle_the_states_only(spark, monkeypatch):
    """Only states are dealt out, by the member, and joined there by hash; the rows are the plain ones."""
    from riskspark.operators.sinks import in_place, is_in_place
    ch = some_claims(spark)
    states = P.code_years(ch)
    years = REF.time_periods(spark).where("period_type = 'C'").select("risk_year").distinct()

    def made(size):
        return P.statuses(states, REF.chronic(spark), REF.hierarchy_pairs(spark), REF.prior_year(spark), years, size=size)
    plain = Counter(map(tuple, made(0).collect()))
    monkeypatch.setattr(J, "PLACED_ROWS", 48)
    with in_place(spark):
        df = made(1200)
        got, plan = Counter(map(tuple, df.collect())), plan_of(df)
    assert not is_in_place(spark)
    assert got == plain and len(plain) > 100
    assert plan.count("ShuffledHashJoin") >= 3
    assert {x.split("#")[0] for x in partitions(plan)} == {"member_bid"}


def test_states_stand_for_their_claims(spark):
    """Steps that begin with states take them, and categories left by the hierarchy are those scored from the diagnoses."""
    ch = some_claims(spark)
    states = P.code_years(ch)
    assert Counter(map(tuple, P.code_years(states).collect())) == Counter(map(tuple, states.collect()))
    for f in (P.current_filter, P.year_codes, lambda x: P.prior_filter(P.chronic_source(x, REF.chronic(spark)), spark.range(1990, 2000).toDF("risk_year"))):
        assert Counter(map(str, f(ch).collect())) == Counter(map(str, f(states).collect()))


def test_coded_categories_are_the_scored_ones(spark, claims):
    inp = Inputs(spark, claims, cut=True, versions=("v24", "v28"))
    cols = ["version", "member_bid", "risk_year", "hcc"]
    want = {tuple(r) for r in inp.v28_hcc().select(cols).collect()}
    got = [tuple(r) for r in inp.coded().select(cols).collect()]
    assert set(got) == want and len(got) == len(want) > 10


def test_frequency_is_one_aggregate(spark):
    """Oldest row by date, claim and code, claims counted once, no row without a key; no window and no join of the draft with itself."""
    from riskspark.plans import gaps as G
    rnd = random.Random(2)
    rows = [("v28", rnd.choice([None, 1, 2]), 1996, rnd.choice([1, 2]), rnd.choice([None, *range(5)]), rnd.choice([None, "1996-01-01", "1996-02-01"]), 4, "DIAGNOSIS",
             rnd.choice(["D1", "D2"]), 18, rnd.choice([None, "CC018", "CC019"]), rnd.choice([0, 1]), rnd.choice(["Y", "N"])) for _ in range(300)]
    draft = spark.createDataFrame(rows, "version string, member_bid long, risk_year int, method_id int, claim_bid long, d string, claim_type int, claim_cd_type string, "
                                  "claim_cd string, cc_id int, cc_code string, qualified_claim int, qualify_claims string") \
        .withColumn("claim_dt", F.col("d").cast("date")).select(*G.DRAFT_COLS)
    df = G.frequency_confidence(draft, REF.method_frequency(spark), REF.method_default_weight(spark))
    assert "Window" not in plan_of(df) and "SortMergeJoin" not in plan_of(df)
    want = {}
    for r in rows:
        key = (r[1], r[3], r[10])
        if None not in key and (r[11] == 0 or r[12] == "Y"):
            want.setdefault(key, []).append((r[5] or "", -1 if r[4] is None else r[4], r[8]))
    got = {(r["member_bid"], r["method_id"], r["cc_code"]): (str(r["claim_dt"] or ""), -1 if r["claim_bid"] is None else r["claim_bid"], r["claim_cd"], r["frequency"])
           for r in df.collect()}
    assert got == {k: (*min(v), len({c for _, c, _ in v if c >= 0})) for k, v in want.items()}
