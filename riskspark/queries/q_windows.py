"""Registered window queries (§2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import base as B
from oracle import combined as OC
from oracle import gaps as OG
from oracle import persistence as OP
from oracle import scoring as OS
from riskspark.operators import windows as W
from riskspark.plans import claims as C
from riskspark.plans import gaps as G
from riskspark.plans import scoring as S
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources import reference as REF

_TIE = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "cpt_cd"]


@query("win_latest", B.typed(B.q(["claim_line"], [], """SELECT claim_bid, clm_ln_num, cpt_cd, updated_dt, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY claim_bid, clm_ln_num ORDER BY coalesce(updated_dt, claim_dt) DESC,
    l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, cpt_cd DESC) AS rn FROM claim_line) WHERE rn = 1"""),
    ["clm_ln_num"]))
def win_latest(spark, sf):
    li = Inputs(spark, sf).lines()
    return W.latest(li, ["claim_bid", "clm_ln_num"], "updated_dt", "claim_dt", _TIE).select(
        "claim_bid", "clm_ln_num", "cpt_cd", "updated_dt", "l_partkey")


@query("win_oldest", B.q(OG.BASE, OP.STEPS + OG.DRAFT_STEPS, B.typed(
    "SELECT member_bid, risk_year, method_id, cc_code, claim_bid, claim_dt FROM fr1 WHERE rn = 1", ["risk_year", "method_id"])))
def win_oldest(spark, sf):
    d = G.with_create_flag(Inputs(spark, sf).gap_draft()).where(F.col("draft_status") == "Create Gap")
    return W.pick_one(d, ["member_bid", "risk_year", "method_id", "cc_code"], ["claim_dt", "claim_bid", "claim_cd"],
                      desc=False).select("member_bid", "risk_year", "method_id", "cc_code", "claim_bid", "claim_dt")


@query("win_winner", B.q(OP.BASE, OP.STEPS, B.typed("""SELECT member_bid, hcc, risk_year, relation FROM (
  SELECT *, row_number() OVER (PARTITION BY member_bid, hcc ORDER BY CASE relation WHEN 'SAME' THEN 1 WHEN 'CHILD_CODED' THEN 2
    WHEN 'PARENT_CODED' THEN 3 WHEN 'PRIOR_SUPPRESSED' THEN 4 WHEN 'NONE' THEN 5 ELSE 6 END, risk_year DESC) AS rn FROM status)
WHERE rn = 1""", ["hcc", "risk_year"])))
def win_winner(spark, sf):
    """Best track per member and code: strongest evidence first (rule
    priority), then the latest year."""
    st = Inputs(spark, sf).persistence()
    pr = (F.when(F.col("relation") == "SAME", 1).when(F.col("relation") == "CHILD_CODED", 2)
          .when(F.col("relation") == "PARENT_CODED", 3).when(F.col("relation") == "PRIOR_SUPPRESSED", 4)
          .when(F.col("relation") == "NONE", 5).otherwise(6))
    return W.pick_one(st.withColumn("_pr", pr), ["member_bid", "hcc"], [F.col("_pr"), -F.col("risk_year")],
                      desc=False).select("member_bid", "hcc", "risk_year", "relation")


@query("win_dedupe_rank", B.q(OS.BASE, OS.SCORE_STEPS + OS.DETAIL_STEPS, B.typed("""SELECT member_bid, risk_year, version, claim_bid,
  hcc, diag_cd FROM (SELECT *, row_number() OVER (PARTITION BY member_bid, version, claim_bid, hcc ORDER BY diag_cd) AS rn FROM detail)
WHERE rn = 1""", ["risk_year", "hcc"])))
def win_dedupe_rank(spark, sf):
    inp = Inputs(spark, sf)
    claim_diag = inp.lines().where(F.col("clm_tp_cd").isin(1, 2, 3)).select(
        "member_bid", "risk_year", "claim_bid", "diag_cd").distinct()
    d = S.hcc_detail(claim_diag, inp.population(), REF.icd_hcc(spark), inp.member_hcc())
    return W.pick_one(d, ["member_bid", "version", "claim_bid", "hcc"], ["diag_cd"], desc=False).select(
        "member_bid", "risk_year", "version", "claim_bid", "hcc", "diag_cd")


@query("win_frequency", B.q(OP.BASE, OP.STEPS, B.typed("""SELECT member_bid, risk_year, hcc, claim_bid, diag_cd,
  count(DISTINCT claim_bid) OVER (PARTITION BY member_bid, risk_year, hcc) AS frequency FROM ch""", ["risk_year", "hcc"])))
def win_frequency(spark, sf):
    k = ["member_bid", "risk_year", "hcc"]
    ch = Inputs(spark, sf).keyed_claims(*k).select(*k, "claim_bid", "diag_cd")
    return W.distinct_count_over(ch, k, "claim_bid")


@query("win_max_date", B.q(OP.BASE, OP.STEPS, B.typed("""SELECT member_bid, risk_year, hcc, claim_bid, claim_dt, last_claim_dt FROM (
  SELECT *, max(claim_dt) OVER (PARTITION BY member_bid, risk_year, hcc) AS last_claim_dt,
    row_number() OVER (PARTITION BY member_bid, risk_year, hcc ORDER BY claim_dt, claim_bid, diag_cd) AS rn FROM ch) WHERE rn = 1""",
    ["risk_year", "hcc"])))
def win_max_date(spark, sf):
    """Latest claim date per key carried through a dedupe that keeps the oldest row."""
    k = ["member_bid", "risk_year", "hcc"]
    ch = Inputs(spark, sf).keyed_claims(*k)
    m = W.max_over(ch, k, "claim_dt", "last_claim_dt")
    return W.pick_one(m, k, ["claim_dt", "claim_bid", "diag_cd"], desc=False).select(
        "member_bid", "risk_year", "hcc", "claim_bid", "claim_dt", "last_claim_dt")


@query("win_claim_level_flag", B.q(["claim_line", "claim_header", "enrollment", "qualifying_procedures"], OG.QUAL_STEPS + [
    ("lq", """SELECT l.claim_bid, l.clm_ln_num, l.l_partkey, l.l_suppkey, l.l_quantity,
        CASE WHEN q.cpt_cd IS NOT NULL THEN 1 ELSE 0 END AS line_eligible
      FROM claim_line l LEFT JOIN qualifying_procedures q ON q.cpt_cd = l.cpt_cd AND l.claim_dt BETWEEN q.valid_from AND q.valid_to
      WHERE l.clm_tp_cd IN (2, 3)""")], B.typed("""SELECT claim_bid, clm_ln_num, l_partkey, l_suppkey, l_quantity, line_eligible,
  max(line_eligible) OVER (PARTITION BY claim_bid) AS claim_eligible FROM lq""", ["clm_ln_num", "line_eligible", "claim_eligible"])))
def win_claim_level_flag(spark, sf):
    li = Inputs(spark, sf).lines().where(F.col("clm_tp_cd").isin(2, 3))
    e = C.eligible_line(li, REF.qualifying_procedures(spark))
    return W.max_over(e, ["claim_bid"], "line_eligible", "claim_eligible").select(
        "claim_bid", "clm_ln_num", "l_partkey", "l_suppkey", "l_quantity", "line_eligible", "claim_eligible")


@query("win_latest_cycle", B.typed(B.q(["claim_line"], [], """SELECT source_load_month, claim_bid, clm_ln_num, updated_dt FROM (
  SELECT *, max(updated_dt) OVER (PARTITION BY source_load_month, clm_tp_cd) AS mx FROM claim_line) WHERE updated_dt = mx"""),
    ["clm_ln_num"]))
def win_latest_cycle(spark, sf):
    """Rows of the latest batch (max update date) per load month and claim type."""
    li = Inputs(spark, sf).lines()
    return W.at_max(li, ["source_load_month", "clm_tp_cd"], "updated_dt").select(
        "source_load_month", "claim_bid", "clm_ln_num", "updated_dt")


@query("win_lag_lead_rank", B.q(["claim_header"], [], """SELECT member_bid, claim_bid, claim_dt, allwd_amt,
  lag(allwd_amt) OVER w AS prev_allwd_amt, lead(allwd_amt) OVER w AS next_allwd_amt, rank() OVER w AS rank_allwd_amt
FROM claim_header WINDOW w AS (PARTITION BY member_bid ORDER BY claim_dt, claim_bid)"""))
def win_lag_lead_rank(spark, sf):
    h = Inputs(spark, sf).header().select("member_bid", "claim_bid", "claim_dt", "allwd_amt")
    return W.lag_lead_rank(h, ["member_bid"], ["claim_dt", "claim_bid"], "allwd_amt")


@query("win_codes_per_member", B.q(OS.BASE, OS.POP_STEPS, B.typed("""SELECT member_bid, risk_year, hcc,
  (SELECT string_agg(CAST(x.hcc AS VARCHAR), ',' ORDER BY CAST(x.hcc AS VARCHAR)) FROM mh x WHERE x.version = 'v28'
    AND x.member_bid = m.member_bid AND x.risk_year = m.risk_year) AS hcc_list,
  count(*) OVER (PARTITION BY member_bid, risk_year) AS hcc_count FROM mh m WHERE version = 'v28'""", ["risk_year", "hcc", "hcc_count"])))
def win_codes_per_member(spark, sf):
    mh = Inputs(spark, sf).v28_hcc().select("member_bid", "risk_year", "hcc")
    return W.list_over(mh, ["member_bid", "risk_year"], "hcc")
