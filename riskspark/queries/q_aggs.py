"""Registered aggregation queries (§2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import base as B
from oracle import combined as OC
from oracle import gaps as OG
from oracle import scoring as OS
from riskspark import functions as RF
from riskspark.operators import aggs as A
from riskspark.plans import gaps as G
from riskspark.plans import scoring as S
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources import reference as REF

MK = ["member_bid", "risk_year", "version"]


def _s(final, ints=(), steps=(), doubles=()):
    return B.q(OS.BASE + ["pair_rules", "multiplier_rules"], OS.SCORE_STEPS + list(steps),
               B.typed(final, list(ints), list(doubles)))


def _c(final, ints=(), steps=()):
    return B.q(OC.BASE, OC.STEPS + list(steps), B.typed(final, list(ints)))


@query("agg_member_hcc", _s("""
SELECT h.member_bid, h.risk_year, h.version, round(h.hcc_score, 6) AS hcc_score, h.hcc_list,
  round(coalesce(i.adj, 0.0), 6) AS interaction_adjustment
FROM (SELECT mh.member_bid, mh.risk_year, mh.version, sum(coalesce(cf.score, 0.0)) AS hcc_score,
        string_agg(CAST(mh.hcc AS VARCHAR), ',' ORDER BY mh.hcc) AS hcc_list
      FROM mh LEFT JOIN coefficients cf ON cf.version = mh.version AND upper(cf.name) = upper(mh.model_segment || '_HCC' || CAST(mh.hcc AS VARCHAR))
      GROUP BY 1, 2, 3) h
LEFT JOIN (SELECT a.member_bid, a.risk_year, a.version, sum(coalesce(m.multiplier, 1.0) - 1.0) AS adj
  FROM mh a JOIN mh b ON a.member_bid = b.member_bid AND a.risk_year = b.risk_year AND a.version = b.version AND a.hcc < b.hcc
  LEFT JOIN multiplier_rules m ON m.hcc1 = a.hcc AND m.hcc2 = b.hcc
  WHERE a.hcc IN (SELECT hcc1 FROM multiplier_rules UNION SELECT hcc2 FROM multiplier_rules)
    AND b.hcc IN (SELECT hcc1 FROM multiplier_rules UNION SELECT hcc2 FROM multiplier_rules) GROUP BY 1, 2, 3) i
  ON i.member_bid = h.member_bid AND i.risk_year = h.risk_year AND i.version = h.version""", ["risk_year"]))
def agg_member_hcc(spark, sf):
    inp = Inputs(spark, sf)
    hcc = inp.member_hcc()
    named = S.coefficient_lookup(hcc.withColumn("coeff_name", RF.hcc_coeff_name("model_segment", "hcc")),
                                 REF.coefficients(spark), "coeff_name", "coeff")
    # sort the collected (bounded) code list numerically before joining it
    h = named.groupBy(*MK).agg(
        F.round(F.sum(F.coalesce("coeff", F.lit(0.0))), 6).alias("hcc_score"),
        F.array_join(F.transform(F.array_sort(F.collect_list("hcc")), lambda x: x.cast("string")), ",").alias("hcc_list"))
    pairs = S.interaction_multiplier(S.hcc_pairs(hcc, REF.multiplier_rules(spark)), REF.multiplier_rules(spark))
    i = pairs.groupBy(*MK).agg(F.sum(F.col("multiplier") - 1.0).alias("adj"))
    return h.join(i, MK, "left").select(*MK, "hcc_score", "hcc_list",
                                        F.round(F.coalesce("adj", F.lit(0.0)), 6).alias("interaction_adjustment"))


@query("agg_scores", _s("""SELECT member_bid, round(sum(raw_score), 6) AS total_raw, round(sum(weighted_score), 6) AS total_weighted,
  string_agg(DISTINCT model_segment, ',' ORDER BY model_segment) AS segments FROM scores GROUP BY 1"""))
def agg_scores(spark, sf):
    s = Inputs(spark, sf).scores()
    return s.groupBy("member_bid").agg(F.round(F.sum("raw_score"), 6).alias("total_raw"),
                                       F.round(F.sum("weighted_score"), 6).alias("total_weighted"),
                                       F.array_join(F.array_sort(F.collect_set("model_segment")), ",").alias("segments"))


@query("agg_hcc_count", _s("""SELECT member_bid, risk_year, version, model_segment, hcc_count,
  model_segment || '_D' || CASE WHEN hcc_count >= 10 THEN '10P' ELSE CAST(hcc_count AS VARCHAR) END AS count_name,
  count_score FROM hsc""", ["risk_year"]))
def agg_hcc_count(spark, sf):
    h = S.hcc_scores(Inputs(spark, sf).member_hcc(), REF.coefficients(spark))
    return h.select(*MK, "model_segment", "hcc_count", RF.count_coeff_name("model_segment", "hcc_count").alias("count_name"),
                    "count_score")


@query("agg_hcc_tier", _s("""SELECT member_bid, risk_year, count(DISTINCT hcc) AS hcc_count,
  CASE WHEN count(DISTINCT hcc) >= 13 THEN 'HIGH_DENSITY' WHEN count(DISTINCT hcc) >= 5 THEN 'MID_DENSITY' ELSE 'LOW_DENSITY' END AS tier
FROM mh0 GROUP BY 1, 2""", ["risk_year"]))
def agg_hcc_tier(spark, sf):
    inp = Inputs(spark, sf)
    pop = inp.population()
    d = S.member_diagnoses(inp.lines()).join(pop.select("member_bid", "risk_year", "age_yr", "memb_gender_cd"),
                                             ["member_bid", "risk_year"])
    d = S.apply_sedits(S.map_icd_to_hcc(S.with_versions(d), REF.icd_hcc(spark)))
    d = d.where(F.col("hcc").isNotNull() & (F.col("hcc") != -1))
    g = d.groupBy("member_bid", "risk_year").agg(F.countDistinct("hcc").alias("hcc_count"))
    return g.withColumn("tier", A.hcc_tier(F.col("hcc_count")))


@query("agg_count_factor", _s("""SELECT member_bid, risk_year, count(DISTINCT hcc) AS hcc_count,
  CASE WHEN count(DISTINCT hcc) >= 10 THEN 1.25 WHEN count(DISTINCT hcc) >= 5 THEN 1.15 WHEN count(DISTINCT hcc) >= 1 THEN 1.05 ELSE 1.0 END AS count_factor
FROM mh WHERE version = 'v28' GROUP BY 1, 2""", ["risk_year"], doubles=["count_factor"]))
def agg_count_factor(spark, sf):
    g = Inputs(spark, sf).v28_hcc().groupBy("member_bid", "risk_year").agg(F.countDistinct("hcc").alias("hcc_count"))
    return g.withColumn("count_factor", A.count_factor(F.col("hcc_count")))


def _conf_inputs(inp: Inputs):
    sp = inp.spark
    return G.frequency_confidence(inp.gap_draft(), REF.method_frequency(sp), REF.method_default_weight(sp))


@query("agg_method_confidence", _c("SELECT * FROM mconf", ["risk_year", "method_id"]))
def agg_method_confidence(spark, sf):
    return G.method_confidence(_conf_inputs(Inputs(spark, sf))).drop("version")


@query("agg_combined_confidence", _c("SELECT * FROM cconf", ["risk_year", "n_methods"]))
def agg_combined_confidence(spark, sf):
    return G.combined_confidence(G.method_confidence(_conf_inputs(Inputs(spark, sf)))).drop("version")


@query("agg_method_consensus", _c("""
SELECT member_bid, risk_year, cc_code, n_methods, methods, primary_method, n_methods / 4.0 AS consensus FROM (
  SELECT x.member_bid, x.risk_year, x.cc_code, count(*) AS n_methods,
    string_agg(CAST(x.method_id AS VARCHAR), ',' ORDER BY CAST(x.method_id AS VARCHAR)) AS methods,
    arg_min(x.method_id, (p.priority, x.method_id)) AS primary_method
  FROM (SELECT DISTINCT member_bid, risk_year, cc_code, method_id FROM g0) x
  LEFT JOIN method_priority p ON p.method_id = x.method_id GROUP BY 1, 2, 3)
WHERE n_methods / 4.0 >= 0.75""", ["risk_year", "primary_method"]))
def agg_method_consensus(spark, sf):
    inp = Inputs(spark, sf)
    g = G.member_gaps(inp.gap_draft()).select("member_bid", "risk_year", "cc_code", "method_id")
    return G.method_consensus(g, REF.method_priority(spark)).select(
        "member_bid", "risk_year", "cc_code", "n_methods", "methods", "primary_method", "consensus")


@query("agg_gap_frequency", _c("""SELECT method_id, claim_cd_type, claim_cd, member_bid, 'v28' AS version, cc_code,
  count(DISTINCT claim_bid) AS n_claims FROM draft_f WHERE draft_status = 'Create Gap' GROUP BY 1, 2, 3, 4, 5, 6""", ["method_id"]))
def agg_gap_frequency(spark, sf):
    d = G.with_create_flag(Inputs(spark, sf).gap_draft()).where(F.col("draft_status") == "Create Gap")
    return d.withColumn("version", F.lit("v28")).groupBy(
        "method_id", "claim_cd_type", "claim_cd", "member_bid", "version", "cc_code").agg(
        F.countDistinct("claim_bid").alias("n_claims"))


@query("agg_claims_by_member", B.q(["claim_header"], [], """SELECT member_bid,
  CAST(sum(CAST(allwd_amt AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount, count(*) AS n_claims,
  CAST(sum(CAST(allwd_amt AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_amount, min(allwd_amt) AS min_amount,
  max(allwd_amt) AS max_amount FROM claim_header GROUP BY 1"""))
def agg_claims_by_member(spark, sf):
    h = Inputs(spark, sf).header()
    g = h.groupBy("member_bid").agg(A.exact_sum("allwd_amt").alias("total_amount"), F.count("*").alias("n_claims"),
                                    F.min("allwd_amt").alias("min_amount"), F.max("allwd_amt").alias("max_amount"))
    return g.withColumn("avg_amount", F.col("total_amount") / F.col("n_claims"))


@query("agg_multi", B.typed(B.q(["claim_line"], [], """SELECT risk_year, clm_tp_cd, CAST(sum(CAST(line_amt AS DECIMAL(18, 2))) AS DOUBLE) AS sum_line_amt,
  count(line_amt) AS count_line_amt, round(avg(l_quantity), 6) AS avg_l_quantity, max(l_quantity) AS max_l_quantity,
  min(l_quantity) AS min_l_quantity FROM claim_line GROUP BY 1, 2"""), ["risk_year", "clm_tp_cd"]))
def agg_multi(spark, sf):
    g = A.multi_aggregate(Inputs(spark, sf).lines(), ["risk_year", "clm_tp_cd"],
                          {"line_amt": ["sum", "count"], "l_quantity": ["avg", "max", "min"]})
    return g.withColumn("avg_l_quantity", F.round("avg_l_quantity", 6))


@query("agg_crosstab", B.typed(B.q(["claim_header"], [], """SELECT risk_year,
  CAST(sum(CASE WHEN clm_tp_cd = 1 THEN CAST(allwd_amt AS DECIMAL(18, 2)) END) AS DOUBLE) AS "1", CAST(sum(CASE WHEN clm_tp_cd = 2 THEN CAST(allwd_amt AS DECIMAL(18, 2)) END) AS DOUBLE) AS "2",
  CAST(sum(CASE WHEN clm_tp_cd = 3 THEN CAST(allwd_amt AS DECIMAL(18, 2)) END) AS DOUBLE) AS "3" FROM claim_header GROUP BY 1"""), ["risk_year"]))
def agg_crosstab(spark, sf):
    return A.crosstab(Inputs(spark, sf).header(), "risk_year", "clm_tp_cd", [1, 2, 3], "allwd_amt")


@query("agg_time_series", B.q(["claim_header"], [], """SELECT granularity, period,
  CAST(sum(CAST(allwd_amt AS DECIMAL(18, 2))) AS DOUBLE) AS total,
  CAST(sum(CAST(allwd_amt AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS average, count(*) AS n FROM (
  SELECT 'week' AS granularity, CAST(isoyear(claim_dt) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(claim_dt) AS VARCHAR), 2, '0') AS period, allwd_amt FROM claim_header
  UNION ALL SELECT 'month', strftime(claim_dt, '%Y-%m'), allwd_amt FROM claim_header
  UNION ALL SELECT 'quarter', CAST(year(claim_dt) AS VARCHAR) || '-Q' || CAST(quarter(claim_dt) AS VARCHAR), allwd_amt FROM claim_header
  UNION ALL SELECT 'year', CAST(year(claim_dt) AS VARCHAR), allwd_amt FROM claim_header) GROUP BY 1, 2"""))
def agg_time_series(spark, sf):
    return A.time_series(Inputs(spark, sf).header(), "claim_dt", "allwd_amt", ["week", "month", "quarter", "year"])


_SUMMARY_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("agg_summary_stats", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
  CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS q1,
  CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median, CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS q3 FROM lineitem""" for c in _SUMMARY_COLS))
def agg_summary_stats(spark, sf):
    s = A.summary_stats(Inputs(spark, sf).table("lineitem"), _SUMMARY_COLS)
    return s.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


@query("agg_percentiles", """SELECT l_returnflag, quantile_disc(l_extendedprice, 0.1) AS p10, quantile_disc(l_extendedprice, 0.25) AS p25,
  quantile_disc(l_extendedprice, 0.5) AS p50, quantile_disc(l_extendedprice, 0.75) AS p75, quantile_disc(l_extendedprice, 0.9) AS p90
FROM lineitem GROUP BY 1""")
def agg_percentiles(spark, sf):
    return A.percentiles(Inputs(spark, sf).table("lineitem"), ["l_returnflag"], "l_extendedprice",
                         [0.1, 0.25, 0.5, 0.75, 0.9])


def _profile_sql():
    cols = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
            ("c_mktsegment", "string")]
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count,
  round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct, count(DISTINCT {c}) AS distinct_count,
  count(*) AS row_count, 5 AS column_count FROM customer""" for c, t in cols)


@query("agg_profile", B.typed(_profile_sql(), ["null_count", "column_count"]))
def agg_profile(spark, sf):
    return A.profile(Inputs(spark, sf).table("customer"))


@query("agg_risk_distribution", _s("""SELECT version, model_segment, risk_year, count(*) AS n, round(avg(raw_score), 6) AS avg_score,
  round(stddev_samp(raw_score), 6) AS stddev_score FROM scores GROUP BY 1, 2, 3""", ["risk_year"]))
def agg_risk_distribution(spark, sf):
    s = Inputs(spark, sf).scores()
    return s.groupBy("version", "model_segment", "risk_year").agg(
        F.count("*").alias("n"), F.round(F.avg("raw_score"), 6).alias("avg_score"),
        F.round(F.stddev("raw_score"), 6).alias("stddev_score"))


@query("agg_method_share", _c("""SELECT method_id, count(*) AS n, round(avg(confidence_factor), 6) AS avg_confidence_factor,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct_of_total FROM freqconf GROUP BY 1""", ["method_id"]))
def agg_method_share(spark, sf):
    s = A.share_of_total(_conf_inputs(Inputs(spark, sf)), "method_id", "confidence_factor")
    return s.withColumn("avg_confidence_factor", F.round("avg_confidence_factor", 6))


@query("agg_claim_procedures", B.q(["claim_line"], [], """SELECT claim_bid,
  string_agg(DISTINCT cpt_cd, ',' ORDER BY cpt_cd) AS procedures, count(DISTINCT cpt_cd) AS n_procedures FROM claim_line GROUP BY 1"""))
def agg_claim_procedures(spark, sf):
    li = Inputs(spark, sf).lines()
    return li.groupBy("claim_bid").agg(F.array_join(F.array_sort(F.collect_set("cpt_cd")), ",").alias("procedures"),
                                       F.countDistinct("cpt_cd").alias("n_procedures"))
