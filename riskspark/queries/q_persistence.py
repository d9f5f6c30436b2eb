"""Registered persistence queries (§2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import base as B
from oracle import persistence as OP
from riskspark.plans import persistence as P
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources import reference as REF

PK = ["member_bid", "risk_year", "hcc"]


def _o(final: str, ints=(), steps=None) -> str:
    return B.q(OP.BASE, steps or OP.STEPS, B.typed(final, list(ints)))


_PL = "member_bid, risk_year, hcc, prior_year, claim_bid, claim_dt, diag_cd, frequency"


@query("per_prior_filter", _o(f"SELECT {_PL} FROM pl", ["risk_year", "hcc", "prior_year", "frequency"]))
def per_prior_filter(spark, sf):
    inp = Inputs(spark, sf)
    return P.prior_filter(P.chronic_source(inp.claim_hcc(), REF.chronic(spark)), inp.years(), size=inp.most_claims()).select(*_PL.split(", "))


@query("per_current_filter", _o("SELECT member_bid, risk_year, hcc, claim_bid, claim_dt, diag_cd, frequency FROM curl",
                                ["risk_year", "hcc", "frequency"]))
def per_current_filter(spark, sf):
    inp = Inputs(spark, sf)
    return P.current_filter(inp.claim_hcc(), inp.most_claims()).select(
        "member_bid", "risk_year", "hcc", "claim_bid", "claim_dt", "diag_cd", "frequency")


@query("per_chronic_source", _o("SELECT * FROM src", ["risk_year", "hcc"]))
def per_chronic_source(spark, sf):
    return P.chronic_source(Inputs(spark, sf).claim_hcc(), REF.chronic(spark)).select(
        "member_bid", "risk_year", "claim_bid", "claim_dt", "diag_cd", "hcc")


@query("per_suppress_prior", _o("""
SELECT p.member_bid, p.risk_year, p.hcc, p.prior_year, s.suppressed_by FROM pl p
JOIN supy s ON s.member_bid = p.member_bid AND s.risk_year = p.prior_year AND s.hcc = p.hcc""",
    ["risk_year", "hcc", "prior_year", "suppressed_by"]))
def per_suppress_prior(spark, sf):
    inp = Inputs(spark, sf)
    ch, n = inp.claim_hcc(), inp.most_claims()
    prior = P.prior_filter(P.chronic_source(ch, REF.chronic(spark)), inp.years(), size=n)
    _, removed = P.suppress_prior(prior, P.year_codes(ch, n), inp.hier28(), n)
    return removed.select("member_bid", "risk_year", "hcc", "prior_year", "suppressed_by")


@query("per_suppress_current", _o("""
SELECT c.member_bid, c.risk_year, c.hcc, CASE WHEN s.suppressed_by IS NULL THEN 'KEPT' ELSE 'SUPPRESSED' END AS outcome,
  s.suppressed_by FROM curl c LEFT JOIN supy s ON s.member_bid = c.member_bid AND s.risk_year = c.risk_year AND s.hcc = c.hcc""",
    ["risk_year", "hcc", "suppressed_by"]))
def per_suppress_current(spark, sf):
    inp = Inputs(spark, sf)
    ch, n = inp.claim_hcc(), inp.most_claims()
    kept, removed = P.suppress_current(P.current_filter(ch, n), P.year_codes(ch, n), inp.hier28(), n)
    return kept.select(*PK, F.lit("KEPT").alias("outcome"), F.lit(None).cast("int").alias("suppressed_by")) \
        .unionByName(removed.select(*PK, F.lit("SUPPRESSED").alias("outcome"), "suppressed_by"))


_ST = ["member_bid", "risk_year", "hcc", "prior_year", "relation", "persistent_status", "suspect_status",
       "persistent_status_reason"]


@query("per_status", _o(f"SELECT {', '.join(_ST)} FROM status", ["risk_year", "hcc", "prior_year"]))
def per_status(spark, sf):
    return Inputs(spark, sf).persistence().select(*_ST)


@query("per_duration", _o("SELECT member_bid, risk_year, hcc, claim_dt, duration FROM status", ["risk_year", "hcc", "duration"]))
def per_duration(spark, sf):
    return Inputs(spark, sf).persistence().select("member_bid", "risk_year", "hcc", "claim_dt", "duration")


@query("per_confidence", _o("""SELECT member_bid, risk_year, hcc, suspect_status, frequency, duration, confidence_factor
FROM status""", ["risk_year", "hcc", "frequency", "duration"]))
def per_confidence(spark, sf):
    return Inputs(spark, sf).persistence().select(
        "member_bid", "risk_year", "hcc", "suspect_status", "frequency", "duration", "confidence_factor")


@query("per_history_status", _o("""
SELECT member_bid, risk_year, hcc, persistent_status, coalesce(last_status, 'None') AS history_status,
  CASE WHEN persistent_status = 'Open Persistent' AND last_status IN ('Open Persistent', 'Actual Persistent')
       THEN last_status ELSE persistent_status END AS carried_status
FROM (SELECT *, max(persistent_status) OVER (PARTITION BY member_bid, hcc ORDER BY risk_year
  RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS last_status FROM status)""",
    ["risk_year", "hcc"]))
def per_history_status(spark, sf):
    st = Inputs(spark, sf).persistence().select(*PK, "persistent_status")
    return history_status(st)


def history_status(st):
    """per_history_status: left join to the previous cycle's status; an Open
    Persistent row carries a previous Open/Actual Persistent status."""
    prev = st.select("member_bid", "hcc", (F.col("risk_year") + 1).alias("risk_year"),
                     F.col("persistent_status").alias("_prev"))
    j = st.join(prev, PK, "left")
    carried = F.when((F.col("persistent_status") == "Open Persistent")
                     & F.col("_prev").isin("Open Persistent", "Actual Persistent"), F.col("_prev")) \
        .otherwise(F.col("persistent_status"))
    return j.select(*PK, "persistent_status", F.coalesce("_prev", F.lit("None")).alias("history_status"),
                    carried.alias("carried_status"))


@query("per_close", _o("""
SELECT member_bid, risk_year, hcc,
  CASE WHEN suspect_status = 'Open Suspect' AND closed IS NOT NULL THEN 'Closed Suspect' ELSE suspect_status END AS suspect_status,
  CASE WHEN suspect_status = 'Open Suspect' THEN closed END AS closed_in_year
FROM (SELECT *, max(CASE WHEN suspect_status = 'Closed Suspect' THEN risk_year END) OVER (PARTITION BY member_bid, hcc
  ORDER BY risk_year RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS closed FROM status)""", ["risk_year", "hcc", "closed_in_year"]))
def per_close(spark, sf):
    from riskspark.operators import sinks as SK
    st = Inputs(spark, sf).persistence().select(*PK, "suspect_status")
    closing = st.where(F.col("suspect_status") == "Closed Suspect").select(
        "member_bid", "hcc", (F.col("risk_year") - 1).alias("risk_year"), F.col("risk_year").alias("closed_in_year"))
    # previously open suspects now confirmed → update the prior snapshot
    target = st.withColumn("closed_in_year", F.lit(None).cast("int"))
    src = closing.join(st.where(F.col("suspect_status") == "Open Suspect").select(*PK), PK) \
        .withColumn("suspect_status", F.lit("Closed Suspect"))
    return SK.upsert(target, src.select(*PK, "suspect_status", "closed_in_year"), PK)


@query("per_year_loop", _o("""SELECT risk_year, persistent_status, count(*) AS n FROM status GROUP BY 1, 2""", ["risk_year"]))
def per_year_loop(spark, sf):
    """Every requested risk year in one plan (year is a column, no driver loop)."""
    return Inputs(spark, sf).persistence().groupBy("risk_year", "persistent_status").agg(F.count("*").alias("n"))


@query("per_year_flags", _o(f"""
SELECT c.member_bid, c.risk_year + o AS risk_year, c.hcc,
  max(CASE WHEN o = 0 THEN 1 ELSE 0 END) AS in_y0, max(CASE WHEN o = 1 THEN 1 ELSE 0 END) AS in_y1,
  max(CASE WHEN o = 2 THEN 1 ELSE 0 END) AS in_y2,
  CASE WHEN max(CASE WHEN o = 0 THEN 1 ELSE 0 END) + max(CASE WHEN o = 1 THEN 1 ELSE 0 END) + max(CASE WHEN o = 2 THEN 1 ELSE 0 END) = 3 THEN 1 ELSE 0 END AS persistent_flag,
  CASE WHEN max(CASE WHEN o = 1 THEN 1 ELSE 0 END) + max(CASE WHEN o = 2 THEN 1 ELSE 0 END) >= 2
        AND max(coalesce(ck.chronic, 0)) = 1 THEN 1 ELSE 0 END AS carry_forward_eligible
FROM codes c CROSS JOIN (SELECT unnest([0, 1, 2]) AS o) t LEFT JOIN chronic ck ON ck.hcc = c.hcc
WHERE c.risk_year + o IN (SELECT risk_year FROM time_periods WHERE period_type = 'C') GROUP BY 1, 2, 3""",
    ["risk_year", "hcc", "in_y0", "in_y1", "in_y2", "persistent_flag", "carry_forward_eligible"]))
def per_year_flags(spark, sf):
    inp = Inputs(spark, sf)
    n = inp.most_claims()
    return P.year_flags(P.year_codes(inp.claim_hcc(), n), REF.chronic(spark), inp.years(), n)
