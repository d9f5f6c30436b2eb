"""Registered sort / limit / set-operation queries (§2.7)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from oracle import base as B
from oracle import combined as OC
from oracle import gaps as OG
from oracle import persistence as OP
from oracle import scoring as OS
from riskspark.operators import sinks as SK
from riskspark.plans import gaps as G
from riskspark.plans import persistence as P
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources import reference as REF

_DR = ["member_bid", "risk_year", "method_id", "claim_bid", "claim_dt", "claim_type", "claim_cd_type", "claim_cd", "cc_code"]


@query("set_union_methods", B.q(OG.BASE, OP.STEPS + OG.DRAFT_STEPS, B.typed(
    f"SELECT {', '.join(_DR)} FROM draft", ["risk_year", "method_id", "claim_type"])))
def set_union_methods(spark, sf):
    return Inputs(spark, sf).gap_draft().select(*_DR)


@query("set_union_claims", B.typed(B.q(["claim_line"], [], """
SELECT claim_bid, clm_ln_num, clm_tp_cd, 'FACILITY' AS source FROM claim_line WHERE clm_tp_cd IN (1, 2)
UNION ALL SELECT claim_bid, clm_ln_num, clm_tp_cd, 'PROFESSIONAL' FROM claim_line WHERE clm_tp_cd = 3"""), ["clm_ln_num", "clm_tp_cd"]))
def set_union_claims(spark, sf):
    li = Inputs(spark, sf).lines().select("claim_bid", "clm_ln_num", "clm_tp_cd")
    fac = li.where(F.col("clm_tp_cd").isin(1, 2)).withColumn("source", F.lit("FACILITY"))
    prof = li.where(F.col("clm_tp_cd") == 3).select("clm_tp_cd", "claim_bid", "clm_ln_num").withColumn("source", F.lit("PROFESSIONAL"))
    return fac.unionByName(prof)


@query("set_union_status", B.q(OP.BASE, OP.STEPS, B.typed("""SELECT member_bid, risk_year, hcc, persistent_status FROM status""",
                                                          ["risk_year", "hcc"])))
def set_union_status(spark, sf):
    """The status tracks share no row, so their union is one pass over the frame."""
    st = Inputs(spark, sf).persistence().select("member_bid", "risk_year", "hcc", "persistent_status")
    return st.where(F.col("persistent_status").isin(
        "Actual Persistent", "Actual NS Persistent", "Open NS Persistent", "Open Persistent", "New"))


@query("set_distinct", B.typed(B.q(["claim_line"], [], """SELECT claim_bid, clm_ln_num, cpt_cd FROM (
  SELECT *, row_number() OVER (PARTITION BY claim_bid, clm_ln_num ORDER BY cpt_cd, l_partkey, l_suppkey) AS rn FROM claim_line) WHERE rn = 1"""),
    ["clm_ln_num"]))
def set_distinct(spark, sf):
    """dropDuplicates on keys where the other columns differ: a total order decides."""
    li = Inputs(spark, sf).lines()
    w = Window.partitionBy("claim_bid", "clm_ln_num").orderBy("cpt_cd", "l_partkey", "l_suppkey")
    return li.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("claim_bid", "clm_ln_num", "cpt_cd")


@query("set_difference", B.q(["claim_header", "pharmacy"], [], """SELECT DISTINCT member_bid FROM claim_header
WHERE member_bid NOT IN (SELECT member_bid FROM pharmacy)"""))
def set_difference(spark, sf):
    inp = Inputs(spark, sf)
    return inp.header().select("member_bid").distinct().join(inp.pharmacy().select("member_bid"), "member_bid", "left_anti")


@query("set_intersection", B.q(["claim_header", "pharmacy"], [], """SELECT member_bid FROM claim_header
INTERSECT SELECT member_bid FROM pharmacy"""))
def set_intersection(spark, sf):
    inp = Inputs(spark, sf)
    return inp.header().select("member_bid").intersect(inp.pharmacy().select("member_bid"))


@query("srt_order", B.typed(B.q(["time_periods", "claim_header"], [], """SELECT tp.time_period, tp.period_type, count(*) AS n_claims
FROM claim_header h JOIN time_periods tp ON h.claim_dt BETWEEN tp.begin_date AND tp.end_date GROUP BY 1, 2 ORDER BY 1"""),
    ["time_period"]))
def srt_order(spark, sf):
    from riskspark.operators.rules import period_filter
    h = Inputs(spark, sf).header().select("claim_bid", "claim_dt")
    return period_filter(h, REF.time_periods(spark), "claim_dt").groupBy("time_period", "period_type") \
        .agg(F.count("*").alias("n_claims")).orderBy("time_period")


@query("srt_rank_gaps", B.q(OC.BASE, OC.STEPS, B.typed("""SELECT member_bid, risk_year, cc_code, combined_confidence,
  row_number() OVER (PARTITION BY member_bid ORDER BY combined_confidence DESC, risk_year, cc_code) AS gap_rank
FROM cconf ORDER BY combined_confidence DESC, member_bid""", ["risk_year", "gap_rank"])))
def srt_rank_gaps(spark, sf):
    """Gaps ranked by confidence within each member (no global single-task
    rank); the report order is a distributed range sort."""
    inp = Inputs(spark, sf)
    fc = G.frequency_confidence(inp.gap_draft(), REF.method_frequency(spark), REF.method_default_weight(spark))
    c = G.combined_confidence(G.method_confidence(fc))
    w = Window.partitionBy("member_bid").orderBy(F.col("combined_confidence").desc(), "risk_year", "cc_code")
    return c.select("member_bid", "risk_year", "cc_code", "combined_confidence",
                    F.row_number().over(w).alias("gap_rank")).orderBy(F.col("combined_confidence").desc(), "member_bid")


@query("lim_head", """SELECT 'labels' AS table_name, (SELECT count(*) FROM (SELECT 1 FROM labels LIMIT 1)) = 0 AS is_empty
UNION ALL SELECT 'orders', (SELECT count(*) FROM (SELECT 1 FROM orders LIMIT 1)) = 0
UNION ALL SELECT 'pharmacy_2003', (SELECT count(*) FROM (SELECT 1 FROM lineitem WHERE year(l_shipdate) = 2003 AND l_returnflag = 'R' LIMIT 1)) = 0""")
def lim_head(spark, sf):
    """Emptiness tests as plans (``limit(1)`` + count), no driver round trip per table."""
    inp = Inputs(spark, sf)
    probes = [("labels", inp.table("labels")), ("orders", inp.table("orders")),
              ("pharmacy_2003", inp.pharmacy().where(F.year("serv_dt") == 2003))]
    parts = [df.limit(1).agg(F.count(F.lit(1)).alias("_n")).select(F.lit(n).alias("table_name"), (F.col("_n") == 0).alias("is_empty"))
             for n, df in probes]
    return SK.union_all(parts)
