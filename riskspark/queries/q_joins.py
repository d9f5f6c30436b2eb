"""Registered join queries (§2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import base as B
from oracle import gaps as OG
from oracle import persistence as OP
from oracle import scoring as OS
from riskspark import functions as RF
from riskspark.operators import joins as J
from riskspark.operators.joins import broadcast_if_small
from riskspark.plans import claims as C
from riskspark.plans import gaps as G
from riskspark.plans import persistence as P
from riskspark.plans import scoring as S
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources import reference as REF
from riskspark.sources import reference_data as R

MK = ["member_bid", "risk_year", "version"]


def _s(final, ints=(), extra_steps=(), extra_base=()):
    return B.q(OS.BASE + ["pair_rules", "multiplier_rules", "chronic"] + list(extra_base),
               OS.SCORE_STEPS + list(extra_steps), B.typed(final, list(ints)))


def _g(final, ints=(), extra_steps=()):
    return B.q(OG.BASE, OP.STEPS + OG.DRAFT_STEPS + list(extra_steps), B.typed(final, list(ints)))


def _p(final, ints=(), extra_steps=()):
    return B.q(OP.BASE, OP.STEPS + list(extra_steps), B.typed(final, list(ints)))


@query("jn_icd_hcc", _s("""SELECT d.member_bid, d.risk_year, v.version, d.diag_cd, i.hcc,
  CASE WHEN i.hcc IS NULL THEN 'UNMAPPED' ELSE 'MAPPED' END AS map_status
FROM diag d CROSS JOIN (SELECT unnest(['v24', 'v28']) AS version) v
LEFT JOIN icd_hcc i ON i.version = v.version AND i.diag_cd = d.diag_cd""", ["risk_year", "hcc"]))
def jn_icd_hcc(spark, sf):
    d = S.with_versions(S.member_diagnoses(Inputs(spark, sf).lines()))
    return S.map_icd_to_hcc(d, REF.icd_hcc(spark)).withColumn(
        "map_status", F.when(F.col("hcc").isNull(), "UNMAPPED").otherwise("MAPPED")).select(
        "member_bid", "risk_year", "version", "diag_cd", "hcc", "map_status")


@query("jn_coefficients", _s("""SELECT mh.member_bid, mh.risk_year, mh.version, mh.hcc,
  ' ' || lower(mh.model_segment) || '_hcc' || CAST(mh.hcc AS VARCHAR) AS coeff_name, cf.score AS coeff
FROM mh LEFT JOIN coefficients cf ON cf.version = mh.version
  AND upper(trim(cf.name)) = upper(trim(' ' || lower(mh.model_segment) || '_hcc' || CAST(mh.hcc AS VARCHAR)))""",
    ["risk_year", "hcc"]))
def jn_coefficients(spark, sf):
    mh = Inputs(spark, sf).member_hcc()
    # names arrive with different case and padding; the lookup normalises once
    mh = mh.withColumn("coeff_name", F.concat(F.lit(" "), F.lower("model_segment"), F.lit("_hcc"),
                                              F.col("hcc").cast("string")))
    return S.coefficient_lookup(mh, REF.coefficients(spark), "coeff_name", "coeff").select(
        *MK, "hcc", "coeff_name", "coeff")


@query("jn_method_cc", _g("""SELECT DISTINCT g.member_bid, g.risk_year, g.method_id, g.cc_code, 'v28' AS version,
  'Condition category ' || CAST(g.cc_id AS VARCHAR) AS cc_description,
  CASE WHEN ck.chronic = 1 THEN 'Y' ELSE 'N' END AS chronic_flag
FROM draft g LEFT JOIN chronic ck ON ck.hcc = g.cc_id""", ["risk_year", "method_id"]))
def jn_method_cc(spark, sf):
    d = Inputs(spark, sf).gap_draft()
    cc = REF.chronic(spark).select(F.col("hcc").alias("cc_id"), "chronic")
    return d.join(broadcast_if_small(cc), "cc_id", "left").select(
        "member_bid", "risk_year", "method_id", "cc_code", F.lit("v28").alias("version"),
        F.concat(F.lit("Condition category "), F.col("cc_id").cast("string")).alias("cc_description"),
        F.when(F.col("chronic") == 1, "Y").otherwise("N").alias("chronic_flag")).distinct()


@query("jn_pharmacy_method", _g("SELECT member_bid, claim_bid, claim_dt, claim_cd, cc_id, cc_code FROM m1", ["cc_id"]))
def jn_pharmacy_method(spark, sf):
    return G.m1_pharmacy(Inputs(spark, sf).pharmacy(), REF.method_rules(spark)).select(
        "member_bid", "claim_bid", "claim_dt", "claim_cd", "cc_id", "cc_code")


@query("jn_any_code_method", _g("""SELECT DISTINCT c.claim_bid, r.method_id, r.claim_cd_type, r.claim_cd, r.cc_id
FROM gc c JOIN method_rules r ON (r.claim_cd_type = 'DIAGNOSIS' AND c.diag_cd = r.claim_cd)
  OR (r.claim_cd_type = 'CPT-HCPCS' AND c.cpt_cd = r.claim_cd)""", ["method_id", "cc_id"]))
def jn_any_code_method(spark, sf):
    j = G.any_code_join(Inputs(spark, sf).gap_claims(), REF.method_rules(spark))
    return j.select("claim_bid", "method_id", "claim_cd_type", "claim_cd", "cc_id").distinct()


@query("jn_generic_candidates", _g("""SELECT c.member_bid, c.claim_bid, c.claim_dt, c.diag_cd, r.method_id, r.cc_id,
  'CMS' AS program, 'CLAIMS' AS candidate_source
FROM gc c JOIN method_rules r ON r.claim_cd_type = 'DIAGNOSIS' AND r.method_id IN (1, 2, 10) AND c.diag_cd = r.claim_cd""",
    ["method_id", "cc_id"]))
def jn_generic_candidates(spark, sf):
    r = REF.method_rules(spark).where((F.col("claim_cd_type") == "DIAGNOSIS") & F.col("method_id").isin(1, 2, 10))
    c = Inputs(spark, sf, cut=False).gap_claims()
    return c.join(broadcast_if_small(r), c["diag_cd"] == r["claim_cd"]).select(
        "member_bid", "claim_bid", "claim_dt", "diag_cd", "method_id", "cc_id",
        F.lit("CMS").alias("program"), F.lit("CLAIMS").alias("candidate_source"))


@query("jn_lookback_exclusion", _g("""SELECT member_bid, claim_bid, claim_dt, claim_cd, exclusion_cd, excl_diag_cd, excl_dt,
  CASE WHEN excl_dt IS NULL THEN 0 ELSE 1 END AS excluded FROM trig_x""", ["excluded"]))
def jn_lookback_exclusion(spark, sf):
    c = Inputs(spark, sf).gap_claims()
    rules, groups = REF.method_rules(spark), REF.code_groups(spark)
    t = G.m10_scenario_triggers(c, rules, True).unionByName(G.m10_scenario_triggers(c, rules, False))
    return G.lookback_exclusion(t, c, groups).select(
        "member_bid", "claim_bid", "claim_dt", "claim_cd", "exclusion_cd", "excl_diag_cd", "excl_dt", "excluded")


@query("jn_modifier_same_claim", _g("""SELECT t.member_bid, t.claim_bid, t.claim_dt, t.claim_cd, t.modifier_cd FROM trig t
WHERE t.modifier_cd IS NOT NULL AND EXISTS (SELECT 1 FROM gc m JOIN code_groups g ON g.group_cd = t.modifier_cd
  AND g.code = m.cpt_cd WHERE m.claim_bid = t.claim_bid)"""))
def jn_modifier_same_claim(spark, sf):
    c = Inputs(spark, sf).gap_claims()
    t = G.m10_scenario_triggers(c, REF.method_rules(spark), True)
    return G.modifier_same_claim(t, c, REF.code_groups(spark)).select(
        "member_bid", "claim_bid", "claim_dt", "claim_cd", "modifier_cd")


@query("jn_codegroup_expand", _g("""
SELECT x.claim_cd, x.role, x.code, count(DISTINCT c.claim_bid) AS n_claims FROM (
  SELECT r.claim_cd, 'MODIFIER' AS role, g.claim_cd_type, g.code FROM method_rules r JOIN code_groups g ON g.group_cd = r.modifier_cd
  UNION ALL
  SELECT r.claim_cd, 'EXCLUSION' AS role, g.claim_cd_type, g.code FROM method_rules r JOIN code_groups g ON g.group_cd = r.exclusion_cd) x
LEFT JOIN gc c ON (x.claim_cd_type = 'CPT-HCPCS' AND c.cpt_cd = x.code) OR (x.claim_cd_type = 'DIAGNOSIS' AND c.diag_cd = x.code)
GROUP BY 1, 2, 3"""))
def jn_codegroup_expand(spark, sf):
    rules, g = REF.method_rules(spark), REF.code_groups(spark)
    mod = rules.join(g, rules["modifier_cd"] == g["group_cd"]).select(
        "claim_cd", F.lit("MODIFIER").alias("role"), g["claim_cd_type"], "code")
    exc = rules.join(g, rules["exclusion_cd"] == g["group_cd"]).select(
        "claim_cd", F.lit("EXCLUSION").alias("role"), g["claim_cd_type"], "code")
    x = mod.unionByName(exc)
    c = Inputs(spark, sf).gap_claims()
    by_cpt = c.select("claim_bid", F.col("cpt_cd").alias("code"), F.lit("CPT-HCPCS").alias("claim_cd_type"))
    by_dx = c.select("claim_bid", F.col("diag_cd").alias("code"), F.lit("DIAGNOSIS").alias("claim_cd_type"))
    hits = by_cpt.unionByName(by_dx).join(broadcast_if_small(x), ["claim_cd_type", "code"])
    cnt = hits.groupBy("claim_cd", "role", "code").agg(F.countDistinct("claim_bid").alias("n_claims"))
    return x.select("claim_cd", "role", "code").join(cnt, ["claim_cd", "role", "code"], "left") \
        .withColumn("n_claims", F.coalesce("n_claims", F.lit(0)))


@query("jn_visit_type", B.typed(B.q(["claim_line", "qualifying_procedures"], [], f"""
SELECT l.claim_bid, l.clm_ln_num, l.l_partkey, l.l_suppkey, l.l_quantity, l.cpt_cd,
  CASE WHEN q.cpt_cd IS NOT NULL THEN '{R.VISIT_TYPE_MATCHED}' ELSE '{R.VISIT_TYPE_OTHER}' END AS visit_type
FROM claim_line l LEFT JOIN qualifying_procedures q ON q.cpt_cd = l.cpt_cd
  AND (CASE WHEN l.clm_tp_cd IN (1, 2) THEN l.claim_dt ELSE l.updated_dt END) BETWEEN q.valid_from AND q.valid_to"""),
    ["clm_ln_num"]))
def jn_visit_type(spark, sf):
    li = Inputs(spark, sf).lines()
    return C.with_visit_type(li, REF.qualifying_procedures(spark)).select(
        "claim_bid", "clm_ln_num", "l_partkey", "l_suppkey", "l_quantity", "cpt_cd", "visit_type")


@query("jn_place_of_service", B.q(["claim_header", "place_of_service"], [], """
SELECT h.claim_bid, h.tp_of_bill_cd, p.place_of_service FROM claim_header h
LEFT JOIN place_of_service p ON h.clm_tp_cd IN (1, 2) AND p.bill_prefix = substring(h.tp_of_bill_cd, 1, 2)"""))
def jn_place_of_service(spark, sf):
    h = Inputs(spark, sf).header().select(
        "claim_bid", "tp_of_bill_cd",
        F.when(F.col("clm_tp_cd").isin(1, 2), F.substring("tp_of_bill_cd", 1, 2)).alias("bill_prefix"))
    return h.join(broadcast_if_small(REF.place_of_service(spark)), "bill_prefix", "left").select(
        "claim_bid", "tp_of_bill_cd", "place_of_service")


@query("jn_enrollment", B.q(["claim_header", "enrollment"], [], """
SELECT h.claim_bid, h.member_bid, h.claim_dt, e.covrg_begin_dt, e.covrg_end_dt FROM claim_header h
JOIN enrollment e ON e.member_bid = h.member_bid AND h.claim_dt BETWEEN e.covrg_begin_dt AND e.covrg_end_dt"""))
def jn_enrollment(spark, sf):
    inp = Inputs(spark, sf)
    h = inp.header().select("claim_bid", "member_bid", "claim_dt")
    e = inp.enrollment().select("member_bid", "covrg_begin_dt", "covrg_end_dt")
    return h.join(e, (h["member_bid"] == e["member_bid"]) &
                  h["claim_dt"].between(e["covrg_begin_dt"], e["covrg_end_dt"])).select(
        h["claim_bid"], h["member_bid"], "claim_dt", "covrg_begin_dt", "covrg_end_dt")


@query("jn_member_claims", B.typed(B.q(["member", "claim_header", "time_periods"], [], """
SELECT m.member_bid, m.segment, h.claim_bid, tp.time_period FROM member m JOIN claim_header h ON h.member_bid = m.member_bid
JOIN time_periods tp ON tp.period_type = 'C' AND tp.risk_year = h.risk_year
WHERE tp.time_period IN (5, 7, 9)"""), ["time_period"]))
def jn_member_claims(spark, sf):
    inp = Inputs(spark, sf)
    periods = REF.time_periods(spark).where((F.col("period_type") == "C") & F.col("time_period").isin(5, 7, 9))
    h = inp.header().select("claim_bid", "member_bid", "risk_year").join(
        broadcast_if_small(periods.select("risk_year", "time_period")), "risk_year")
    return inp.member().select("member_bid", "segment").join(h, "member_bid").select(
        "member_bid", "segment", "claim_bid", "time_period")


@query("jn_member_existing_cc", B.q(OG.BASE, OP.STEPS + OG.DRAFT_STEPS, B.typed(
    "SELECT member_bid, risk_year, method_id, cc_code, matching_yn FROM g2", ["risk_year", "method_id"])))
def jn_member_existing_cc(spark, sf):
    inp = Inputs(spark, sf)
    g = G.member_gaps(inp.gap_draft())
    return G.match_existing(g, inp.v28_hcc()).select("member_bid", "risk_year", "method_id", "cc_code", "matching_yn")


_RC = "(SELECT hcc1 AS hcc FROM pair_rules UNION SELECT hcc2 FROM pair_rules)"


@query("jn_hcc_pairs", _s(f"""SELECT a.member_bid, a.risk_year, a.version, a.hcc AS hcc1, b.hcc AS hcc2
FROM mh a JOIN mh b ON a.member_bid = b.member_bid AND a.risk_year = b.risk_year AND a.version = b.version AND a.hcc < b.hcc
WHERE a.hcc IN {_RC} AND b.hcc IN {_RC}""", ["risk_year", "hcc1", "hcc2"]))
def jn_hcc_pairs(spark, sf):
    return S.hcc_pairs(Inputs(spark, sf).member_hcc(), REF.pair_rules(spark))


_PAIRS = [("pairs", """SELECT a.member_bid, a.risk_year, a.version, r.interaction_name, a.hcc AS hcc1, b.hcc AS hcc2, r.score
  FROM mh a JOIN mh b ON a.member_bid = b.member_bid AND a.risk_year = b.risk_year AND a.version = b.version AND a.hcc < b.hcc
  JOIN pair_rules r ON least(r.hcc1, r.hcc2) = a.hcc AND greatest(r.hcc1, r.hcc2) = b.hcc""")]


@query("jn_interaction_match", _s("SELECT * FROM pairs", ["risk_year", "hcc1", "hcc2"], _PAIRS))
def jn_interaction_match(spark, sf):
    return S.pair_interactions(Inputs(spark, sf).member_hcc(), REF.pair_rules(spark))


@query("jn_interaction_multiplier", _s("""SELECT p.member_bid, p.risk_year, p.version,
  round(sum(coalesce(m.multiplier, 1.0) - 1.0), 6) AS interaction_adjustment, count(*) AS n_pairs
FROM (SELECT a.member_bid, a.risk_year, a.version, a.hcc AS hcc1, b.hcc AS hcc2 FROM mh a JOIN mh b
  ON a.member_bid = b.member_bid AND a.risk_year = b.risk_year AND a.version = b.version AND a.hcc < b.hcc
  WHERE a.hcc IN (SELECT hcc1 FROM multiplier_rules UNION SELECT hcc2 FROM multiplier_rules)
    AND b.hcc IN (SELECT hcc1 FROM multiplier_rules UNION SELECT hcc2 FROM multiplier_rules)) p
LEFT JOIN multiplier_rules m ON m.hcc1 = p.hcc1 AND m.hcc2 = p.hcc2 GROUP BY 1, 2, 3""", ["risk_year"]))
def jn_interaction_multiplier(spark, sf):
    pairs = S.hcc_pairs(Inputs(spark, sf).member_hcc(), REF.multiplier_rules(spark))
    j = S.interaction_multiplier(pairs, REF.multiplier_rules(spark))
    return j.groupBy(*MK).agg(F.round(F.sum(F.col("multiplier") - 1.0), 6).alias("interaction_adjustment"),
                              F.count("*").alias("n_pairs"))


@query("jn_adjustment_factors", _s("""SELECT s.member_bid, s.risk_year, s.version, s.raw_score, af.normalization_factor,
  af.coding_pattern_adjustment FROM scores s JOIN adjustment_factors af ON lower(af.version) = lower(s.version)
  AND lower(af.model) = 'cms_hcc'""", ["risk_year"]))
def jn_adjustment_factors(spark, sf):
    s = Inputs(spark, sf).scores().select(*MK, "raw_score").withColumn("model", F.lit("CMS_HCC"))
    f = REF.adjustment_factors(spark).select(F.lower("version").alias("_v"), F.lower("model").alias("_m"),
                                             "normalization_factor", "coding_pattern_adjustment")
    return s.join(broadcast_if_small(f), (F.lower(s["version"]) == f["_v"]) & (F.lower(s["model"]) == f["_m"])).select(
        *MK, "raw_score", "normalization_factor", "coding_pattern_adjustment")


@query("jn_semi_members", B.q(OS.BASE + ["pharmacy"], OS.POP_STEPS, B.typed("""
SELECT mh.member_bid, mh.risk_year, mh.hcc FROM mh WHERE mh.version = 'v28'
  AND mh.member_bid IN (SELECT member_bid FROM pharmacy INTERSECT SELECT member_bid FROM mh)""", ["risk_year", "hcc"])))
def jn_semi_members(spark, sf):
    inp = Inputs(spark, sf)
    a = inp.v28_hcc().select("member_bid", "risk_year", "hcc")
    b = inp.pharmacy()
    both = a.select("member_bid").distinct().join(b.select("member_bid").distinct(), "member_bid")
    return a.join(both, "member_bid", "left_semi")


@query("jn_anti_existing", _s("""SELECT p.member_bid, p.risk_year, p.version, p.interaction_name FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM pairs q WHERE q.member_bid = p.member_bid AND q.version = p.version
  AND q.risk_year = p.risk_year - 1 AND q.interaction_name = p.interaction_name)""", ["risk_year"], _PAIRS))
def jn_anti_existing(spark, sf):
    p = S.pair_interactions(Inputs(spark, sf).member_hcc(), REF.pair_rules(spark)).select(*MK, "interaction_name")
    stored = p.select("member_bid", "version", (F.col("risk_year") + 1).alias("risk_year"), "interaction_name")
    return p.join(stored, MK + ["interaction_name"], "left_anti")


@query("jn_carryforward", _p("""
SELECT DISTINCT p.member_bid, m.home_plan_id_cd, m.contract_id, p.risk_year, 'CC' || lpad(CAST(p.hcc AS VARCHAR), 3, '0') AS cc_code
FROM (SELECT DISTINCT member_bid, hcc, CAST(unnest(generate_series(risk_year + 1, risk_year + 2)) AS INTEGER) AS risk_year FROM codes) p
JOIN member m ON m.member_bid = p.member_bid
WHERE p.risk_year IN (SELECT risk_year FROM time_periods WHERE period_type = 'C') AND NOT EXISTS (SELECT 1 FROM codes c WHERE c.member_bid = p.member_bid
  AND c.risk_year = p.risk_year AND c.hcc = p.hcc)""", ["risk_year"]))
def jn_carryforward(spark, sf):
    inp = Inputs(spark, sf)
    n = inp.most_claims()
    ch, plan = J.sized([inp.claim_hcc(), inp.member().select("member_bid", "home_plan_id_cd", "contract_id")], n, ["member_bid"])
    codes = P.year_codes(ch)
    prior = codes.withColumn("risk_year", F.explode(F.sequence(F.col("risk_year") + 1, F.col("risk_year") + 2))) \
        .join(broadcast_if_small(inp.years()), "risk_year", "left_semi").distinct()
    keys = ["member_bid", "home_plan_id_cd", "contract_id", "risk_year", "hcc"]
    prior, coded = J.sized([prior.join(plan, "member_bid"), codes.join(plan, "member_bid")], n, keys)
    out = prior.join(coded, keys, "left_anti").select(
        "member_bid", "home_plan_id_cd", "contract_id", "risk_year", RF.cc_code("hcc").alias("cc_code"))
    return J.dealt(out, out.columns, n).distinct()


@query("jn_backing_split", _p("""SELECT p.member_bid, p.risk_year, p.hcc,
  CASE WHEN EXISTS (SELECT 1 FROM codes c WHERE c.member_bid = p.member_bid AND c.risk_year = p.risk_year AND c.hcc = p.hcc)
       THEN 'BACKED' ELSE 'UNBACKED' END AS backing FROM pl p""", ["risk_year", "hcc"]))
def jn_backing_split(spark, sf):
    inp = Inputs(spark, sf)
    ch, n = inp.claim_hcc(), inp.most_claims()
    prior = P.prior_filter(P.chronic_source(ch, REF.chronic(spark)), inp.years(), size=n).select(*P.KEY)
    codes = P.year_codes(ch, n)
    backed = prior.join(codes, P.KEY, "left_semi").withColumn("backing", F.lit("BACKED"))
    unbacked = prior.join(codes, P.KEY, "left_anti").withColumn("backing", F.lit("UNBACKED"))
    return backed.unionByName(unbacked).drop("version")


@query("jn_prior_current_priority", _p("SELECT member_bid, risk_year, hcc, current_hcc, relation FROM rel",
                                       ["risk_year", "hcc", "current_hcc"]))
def jn_prior_current_priority(spark, sf):
    inp = Inputs(spark, sf)
    ch, n = inp.claim_hcc(), inp.most_claims()
    prior = P.prior_filter(P.chronic_source(ch, REF.chronic(spark)), inp.years(), size=n)
    return P.prior_current_relation(prior, P.year_codes(ch, n), inp.hier28(), n).drop("version")


@query("jn_confidence_lookup", _p("""SELECT p.member_bid, p.risk_year, p.hcc, p.frequency, p.duration, py.weight AS confidence_factor
FROM (SELECT *, abs(datediff('day', claim_dt, make_date(risk_year, 1, 1))) AS duration FROM pl) p
LEFT JOIN prior_year py ON py.last_bound IS NOT DISTINCT FROM (SELECT min(b.last_bound) FROM prior_year b WHERE b.last_bound >= p.duration)
  AND p.frequency >= py.freq_min AND (p.frequency <= py.freq_max OR py.freq_max = 999)""", ["risk_year", "hcc", "frequency", "duration"]))
def jn_confidence_lookup(spark, sf):
    inp = Inputs(spark, sf)
    prior = P.with_duration(P.prior_filter(P.chronic_source(inp.claim_hcc(), REF.chronic(spark)), inp.years(), size=inp.most_claims()))
    return P.confidence_lookup(prior, REF.prior_year(spark)).select(
        "member_bid", "risk_year", "hcc", "frequency", "duration", "confidence_factor")


@query("jn_scores", _s("""SELECT p.member_bid, p.risk_year, p.version, hsc.hcc_score, gi.interaction_score, hsc.count_score
FROM pv p LEFT JOIN hsc ON hsc.member_bid = p.member_bid AND hsc.risk_year = p.risk_year AND hsc.version = p.version
LEFT JOIN gi ON gi.member_bid = p.member_bid AND gi.risk_year = p.risk_year AND gi.version = p.version""", ["risk_year"]))
def jn_scores(spark, sf):
    inp = Inputs(spark, sf)
    pop = S.with_versions(inp.population()).select(*MK)
    hcc = inp.member_hcc()
    hs = S.hcc_scores(hcc, REF.coefficients(spark)).select(*MK, "hcc_score", "count_score")
    gi = S.group_interactions(hcc, REF.group_rules(spark)).groupBy(*MK).agg(F.sum("score").alias("interaction_score"))
    return J.join_scores([pop, hs.select(*MK, "hcc_score"), gi, hs.select(*MK, "count_score")], MK)


@query("jn_broadcast", B.q(["claim_header", "member"], [], """SELECT h.claim_bid, h.member_bid, m.segment, m.home_plan_id_cd
FROM claim_header h JOIN member m ON m.member_bid = h.member_bid"""))
def jn_broadcast(spark, sf):
    """Member attributes onto claims; the member side is broadcast only if
    its estimated size is under the threshold, else a shuffle join."""
    inp = Inputs(spark, sf)
    return J.checked_join(inp.header().select("claim_bid", "member_bid"),
                          inp.member().select("member_bid", "segment", "home_plan_id_cd"), "member_bid")


@query("jn_chronic", _s("""SELECT mh.member_bid, mh.risk_year, mh.version, mh.hcc,
  CASE WHEN ck.chronic = 1 THEN 'Y' ELSE 'N' END AS chronic_flag FROM mh LEFT JOIN chronic ck ON ck.hcc = mh.hcc""",
    ["risk_year", "hcc"]))
def jn_chronic(spark, sf):
    mh = Inputs(spark, sf).member_hcc().select(*MK, "hcc")
    return mh.join(broadcast_if_small(REF.chronic(spark)), "hcc", "left").select(
        *MK, "hcc", F.when(F.col("chronic") == 1, "Y").otherwise("N").alias("chronic_flag"))


@query("jn_claims_finalize", B.q(["claim_line", "claim_header"], [], """
SELECT d.member_bid, d.claim_dt, d.diag_cd, min(h.claim_bid) AS claim_bid, count(DISTINCT h.claim_bid) AS n_claims
FROM (SELECT DISTINCT member_bid, claim_dt, diag_cd FROM claim_line) d
LEFT JOIN claim_header h ON h.member_bid = d.member_bid AND h.claim_dt = d.claim_dt GROUP BY 1, 2, 3"""))
def jn_claims_finalize(spark, sf):
    inp = Inputs(spark, sf)
    d = inp.lines().select("member_bid", "claim_dt", "diag_cd").distinct()
    h = inp.header().select("member_bid", "claim_dt", "claim_bid")
    return d.join(h, ["member_bid", "claim_dt"], "left").groupBy("member_bid", "claim_dt", "diag_cd").agg(
        F.min("claim_bid").alias("claim_bid"), F.countDistinct("claim_bid").alias("n_claims"))


@query("jn_ref_codes", B.q(["claim_line", "code_groups"], [], """
SELECT c.claim_bid, c.code_type, c.code, g.group_cd FROM (
  SELECT DISTINCT claim_bid, 'CPT-HCPCS' AS code_type, cpt_cd AS code FROM claim_line
  UNION SELECT DISTINCT claim_bid, 'DIAGNOSIS', diag_cd FROM claim_line) c
LEFT JOIN code_groups g ON g.claim_cd_type = c.code_type AND g.code = c.code"""))
def jn_ref_codes(spark, sf):
    """Both codes of a line in one pass over the lines."""
    codes = F.array(*[F.struct(F.lit(t).alias("code_type"), F.col(c).alias("code"))
                      for t, c in (("CPT-HCPCS", "cpt_cd"), ("DIAGNOSIS", "diag_cd"))])
    c = Inputs(spark, sf).lines().select("claim_bid", F.inline(codes)).distinct()
    g = REF.code_groups(spark).select(F.col("claim_cd_type").alias("code_type"), "code", "group_cd")
    return c.join(broadcast_if_small(g), ["code_type", "code"], "left").select("claim_bid", "code_type", "code", "group_cd")


@query("jn_member_details", _g("""SELECT g.member_bid, g.risk_year, g.method_id, g.cc_code, m.memb_gender_cd, m.home_plan_id_cd,
  f.claim_bid AS first_claim_bid, f.claim_dt AS first_claim_dt
FROM gaps g LEFT JOIN member m ON m.member_bid = g.member_bid
LEFT JOIN (SELECT member_bid, risk_year, method_id, cc_code, claim_bid, claim_dt FROM fr1 WHERE rn = 1) f
  ON f.member_bid = g.member_bid AND f.risk_year = g.risk_year AND f.method_id = g.method_id AND f.cc_code = g.cc_code""",
    ["risk_year", "method_id"]))
def jn_member_details(spark, sf):
    inp = Inputs(spark, sf)
    g = inp.gaps().select("member_bid", "risk_year", "method_id", "cc_code")
    fc = G.frequency_confidence(inp.gap_draft(), REF.method_frequency(spark), REF.method_default_weight(spark)) \
        .select("member_bid", "risk_year", "method_id", "cc_code", F.col("claim_bid").alias("first_claim_bid"),
                F.col("claim_dt").alias("first_claim_dt"))
    m = inp.member().select("member_bid", "memb_gender_cd", "home_plan_id_cd")
    return g.join(m, "member_bid", "left").join(fc, ["member_bid", "risk_year", "method_id", "cc_code"], "left")


@query("jn_fuzzy", """
WITH v AS (SELECT DISTINCT p_name AS v FROM part WHERE p_name IS NOT NULL)
SELECT a.v AS value_a, b.v AS value_b,
  1.0 - levenshtein(a.v, b.v) / greatest(length(a.v), length(b.v)) AS similarity
FROM v a JOIN v b ON a.v < b.v
WHERE 1.0 - levenshtein(a.v, b.v) / greatest(length(a.v), length(b.v)) >= 0.6""")
def jn_fuzzy(spark, sf):
    p = Inputs(spark, sf).table("part")
    return J.fuzzy_pairs(p, "p_name", 0.6)


def _mao_oracle():
    from riskspark.queries.q_claims import _MAO
    return B.q(["claim_header", "claim_line"], _MAO, B.typed("SELECT * FROM mm", ["provider_type"]))


@query("jn_mao_claims", _mao_oracle())
def jn_mao_claims(spark, sf):
    from riskspark.queries.q_claims import mao_matches
    return mao_matches(Inputs(spark, sf))


@query("jn_bid_assign", """
SELECT DISTINCT c_name, 11 * 1000000000000 + dense_rank() OVER (ORDER BY c_name) AS bid FROM customer""")
def jn_bid_assign(spark, sf):
    c = Inputs(spark, sf).table("customer").select("c_name")
    return J.assign_bid(c, ["c_name"], R.BID_PREFIX["member"]).distinct()
