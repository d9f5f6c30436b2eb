"""Registered gap-suspecting queries (§2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import base as B
from oracle import combined as OC
from oracle import gaps as OG
from oracle import persistence as OP
from riskspark import functions as RF
from riskspark.operators.joins import broadcast_if_small, hashed, keys_first, placed
from riskspark.plans import gaps as G
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources import reference as REF
from riskspark.sources import reference_data as R

DRAFT_OUT = ["member_bid", "risk_year", "method_id", "claim_bid", "claim_dt", "claim_type", "claim_cd_type",
             "claim_cd", "cc_id", "cc_code", "qualified_claim", "qualify_claims", "draft_status"]
DRAFT_INTS = ["risk_year", "method_id", "claim_type", "cc_id", "qualified_claim"]


OS_STEPS = OP.STEPS + OG.DRAFT_STEPS


def _o(final: str, ints=()) -> str:
    return B.q(OG.BASE, OS_STEPS, B.typed(final, list(ints)))


def _draft_q(name: str) -> str:
    return _o(f"""SELECT {', '.join(DRAFT_OUT)} FROM (SELECT *, CASE WHEN qualified_claim = 0 OR coalesce(qualify_claims, 'N') = 'Y'
      THEN 'Create Gap' ELSE 'No Gap' END AS draft_status FROM {name})""", DRAFT_INTS)


def _flag(df):
    return G.with_create_flag(df).select(*DRAFT_OUT)


@query("gap_rules_inclusion", _o("""
SELECT r.method_id, r.claim_cd_type, r.claim_cd, r.cc_id, count(DISTINCT c.claim_bid) AS n_claims
FROM method_rules r LEFT JOIN gc c ON (r.claim_cd_type = 'DIAGNOSIS' AND c.diag_cd = r.claim_cd)
  OR (r.claim_cd_type = 'CPT-HCPCS' AND c.cpt_cd = r.claim_cd)
WHERE r.method_id IN (2, 10) AND r.program = 'CMS' AND r.exclusion_cd IS NULL AND r.modifier_cd IS NULL
GROUP BY 1, 2, 3, 4""", ["method_id", "cc_id"]))
def gap_rules_inclusion(spark, sf):
    inp = Inputs(spark, sf)
    rules = REF.method_rules(spark)
    incl = G.rules_inclusion(rules, 2).unionByName(G.rules_inclusion(rules, 10))
    hits = G.any_code_join(inp.gap_claims(), incl).select("method_id", "claim_cd_type", "claim_cd", "claim_bid")
    counts = hits.groupBy("method_id", "claim_cd_type", "claim_cd").agg(F.countDistinct("claim_bid").alias("n_claims"))
    return incl.select("method_id", "claim_cd_type", "claim_cd", "cc_id") \
        .join(counts, ["method_id", "claim_cd_type", "claim_cd"], "left") \
        .withColumn("n_claims", F.coalesce("n_claims", F.lit(0)))


@query("gap_m1_pharmacy", _draft_q("m1"))
def gap_m1_pharmacy(spark, sf):
    inp = Inputs(spark, sf)
    return _flag(G.m1_pharmacy(inp.pharmacy(), REF.method_rules(spark)))


@query("gap_m2_codes", _draft_q("m2"))
def gap_m2_codes(spark, sf):
    return _flag(G.m2_codes(Inputs(spark, sf, cut=False).gap_claims(), REF.method_rules(spark)))


@query("gap_m10_inclusion", _draft_q("m10i"))
def gap_m10_inclusion(spark, sf):
    return _flag(G.m10_inclusion(Inputs(spark, sf, cut=False).gap_claims(), REF.method_rules(spark)))


@query("gap_m10_scenario1", _draft_q("s1"))
def gap_m10_scenario1(spark, sf):
    return _flag(G.m10_scenario1(Inputs(spark, sf).gap_claims(), REF.method_rules(spark), REF.code_groups(spark)))


@query("gap_m10_scenario2", _draft_q("s2"))
def gap_m10_scenario2(spark, sf):
    return _flag(G.m10_scenario2(Inputs(spark, sf).gap_claims(), REF.method_rules(spark), REF.code_groups(spark)))


@query("gap_suppress1", _o("SELECT member_bid, risk_year, method_id, cc_id, cc_code, suppression1_yn, suppressed_by_parent FROM g1",
                           ["risk_year", "method_id", "cc_id"]))
def gap_suppress1(spark, sf):
    inp = Inputs(spark, sf)
    return G.suppression1(G.member_gaps(inp.gap_draft()), REF.hierarchy_pairs(spark)).drop("version")


_GAP_COLS = ["member_bid", "risk_year", "method_id", "cc_id", "cc_code", "suppression1_yn", "suppressed_by_parent",
             "matching_yn", "suppression2_yn", "suppressed_by_coded"]


@query("gap_suppress2", _o(f"SELECT {', '.join(_GAP_COLS)} FROM g3", ["risk_year", "method_id", "cc_id"]))
def gap_suppress2(spark, sf):
    inp = Inputs(spark, sf)
    g = G.suppression1(G.member_gaps(inp.gap_draft()), REF.hierarchy_pairs(spark))
    g = G.match_existing(g, inp.v28_hcc())
    return G.suppression2(g, inp.v28_hcc(), REF.hierarchy_pairs(spark)).select(*_GAP_COLS)


@query("gap_status", _o("SELECT * FROM gaps", ["risk_year", "method_id", "cc_id"]))
def gap_status(spark, sf):
    return Inputs(spark, sf, cut=True).gaps().select(*_GAP_COLS, "gap_status", "create_gap")


_FC = ["member_bid", "risk_year", "method_id", "claim_bid", "claim_dt", "claim_type", "claim_cd_type", "claim_cd",
       "cc_id", "cc_code", "frequency", "confidence_factor"]


@query("gap_frequency_confidence", _o(f"SELECT {', '.join(_FC)} FROM freqconf",
                                      ["risk_year", "method_id", "claim_type", "cc_id", "frequency"]))
def gap_frequency_confidence(spark, sf):
    inp = Inputs(spark, sf)
    return G.frequency_confidence(inp.gap_draft(), REF.method_frequency(spark),
                                  REF.method_default_weight(spark)).select(*_FC)


def _conf(inp: Inputs, only=None):
    """Combined confidences, of the methods' gaps in ``only`` where given."""
    sp = inp.spark
    draft = inp.gap_draft()
    if only is not None:  # whole groups of the draft go, so they go before it is grouped
        draft, only = placed([draft.drop("claim_type", "cc_id"), only], inp.most_claims(), ["member_bid", "risk_year"])
        draft = draft.join(hashed(only), keys_first(["version", "member_bid", "risk_year", "method_id", "cc_code"]), "left_semi")
    fc = G.frequency_confidence(draft, REF.method_frequency(sp), REF.method_default_weight(sp))
    return G.combined_confidence(G.method_confidence(fc))


def active_gaps(inp: Inputs):
    """Gaps that no other method's parent suppresses and the plan does not exclude."""
    gaps, member = placed([inp.gaps(), inp.member().select("member_bid", "home_plan_id_cd")], inp.most_claims(), ["member_bid"])
    g = G.cross_suppression(gaps, REF.hierarchy_pairs(inp.spark)).where(F.col("cross_suppressed") == "N")
    g = g.join(hashed(member), "member_bid")
    return plan_exclusion(g, REF.plan_exclusions(inp.spark))


_STATUS_BY_CODE = """SELECT member_bid, risk_year, cc_code,
    CASE WHEN bool_or(gap_status = 'Closed Suspect') THEN 'Closed Suspect'
         WHEN bool_or(gap_status = 'Open Suspect') THEN 'Open Suspect' ELSE 'Open Non Suspect' END AS gap_status
  FROM gaps GROUP BY 1, 2, 3"""


@query("gap_confidence", B.q(OG.BASE, OS_STEPS + [("sbc", _STATUS_BY_CODE)], B.typed(f"""
SELECT c.member_bid, c.risk_year, c.cc_code, c.combined_confidence, c.methods, c.n_methods, s.gap_status,
  (c.combined_confidence >= {R.CONFIDENCE_THRESHOLD} OR s.gap_status = 'Open Non Suspect') AS passes_threshold
FROM cconf c JOIN sbc s ON s.member_bid = c.member_bid AND s.risk_year = c.risk_year AND s.cc_code = c.cc_code""",
    ["risk_year", "n_methods"])))
def gap_confidence(spark, sf):
    inp = Inputs(spark, sf, cut=True)
    st = status_by_code(inp.gaps())
    c = _conf(inp).join(st, G.GAP_KEY).drop("version")
    return c.withColumn("passes_threshold", (F.col("combined_confidence") >= R.CONFIDENCE_THRESHOLD)
                        | (F.col("gap_status") == "Open Non Suspect"))


def status_by_code(gaps):
    """One status per version/member/year/code over methods: Closed wins, then Open Suspect."""
    return gaps.groupBy(*keys_first(G.GAP_KEY)).agg(
        F.when(F.max((F.col("gap_status") == "Closed Suspect").cast("int")) == 1, "Closed Suspect")
        .when(F.max((F.col("gap_status") == "Open Suspect").cast("int")) == 1, "Open Suspect")
        .otherwise("Open Non Suspect").alias("gap_status"))


_CROSS = """SELECT g.*, CASE WHEN g.gap_status = 'Open Suspect' AND EXISTS (SELECT 1 FROM gaps p JOIN hierarchy_pairs h
      ON h.version = 'v28' AND h.parent = p.cc_id
    WHERE p.member_bid = g.member_bid AND p.risk_year = g.risk_year AND h.child = g.cc_id
      AND p.gap_status <> 'Open Non Suspect') THEN 'Y' ELSE 'N' END AS cross_suppressed FROM gaps g"""


@query("gap_suppress_cross", B.q(OG.BASE, OS_STEPS + [("crossed", _CROSS)], B.typed("""
SELECT member_bid, risk_year, method_id, cc_code, gap_status, cross_suppressed,
  CASE WHEN cross_suppressed = 'Y' THEN 'AUDIT' ELSE 'ACTIVE' END AS output_split FROM crossed""", ["risk_year", "method_id"])))
def gap_suppress_cross(spark, sf):
    g = G.cross_suppression(Inputs(spark, sf, cut=True).gaps(), REF.hierarchy_pairs(spark))
    return g.select("member_bid", "risk_year", "method_id", "cc_code", "gap_status", "cross_suppressed",
                    F.when(F.col("cross_suppressed") == "Y", "AUDIT").otherwise("ACTIVE").alias("output_split"))


@query("gap_plan_exclusion", _o("""
SELECT g.member_bid, m.home_plan_id_cd, g.risk_year, g.method_id, g.cc_code, g.gap_status FROM gaps g
JOIN member m ON m.member_bid = g.member_bid
WHERE NOT EXISTS (SELECT 1 FROM plan_exclusions x WHERE x.home_plan_id_cd = m.home_plan_id_cd AND x.method_id = g.method_id)
  AND NOT EXISTS (SELECT 1 FROM plan_exclusions x WHERE x.home_plan_id_cd = m.home_plan_id_cd AND x.cc_id = g.cc_id)""",
    ["risk_year", "method_id"]))
def gap_plan_exclusion(spark, sf):
    inp = Inputs(spark, sf, cut=True)
    g = inp.gaps().join(inp.member().select("member_bid", "home_plan_id_cd"), "member_bid")
    return plan_exclusion(g, REF.plan_exclusions(spark)).select(
        "member_bid", "home_plan_id_cd", "risk_year", "method_id", "cc_code", "gap_status")


def plan_exclusion(gaps, excl):
    """Drop gaps whose plan excludes the method or the condition: two anti
    joins (one per rule kind) instead of one OR join."""
    by_m = excl.where(F.col("method_id").isNotNull()).select("home_plan_id_cd", "method_id")
    by_c = excl.where(F.col("cc_id").isNotNull()).select("home_plan_id_cd", "cc_id")
    return gaps.join(broadcast_if_small(by_m), ["home_plan_id_cd", "method_id"], "left_anti") \
        .join(broadcast_if_small(by_c), ["home_plan_id_cd", "cc_id"], "left_anti")


def gap_hcc_rows(inp: Inputs):
    """gap_to_hcc: gaps passing the threshold → member attributes, coefficient,
    adjusted score (coefficient × combined confidence), R/S indicator, for every
    model version of ``inp``; and the pair interactions that open gaps bring
    about, with the coded categories or each other."""
    from riskspark.operators.sinks import checkpoint, in_place
    from riskspark.plans import scoring as S
    sp, my = inp.spark, ["member_bid", "risk_year"]
    inp.gaps()  # written before the plans that are done in place
    with in_place(sp):
        active = checkpoint(active_gaps(inp), "active-gaps")  # read for the confidences and for the statuses
        c = _conf(inp, active).join(hashed(status_by_code(*placed([active], inp.most_claims(), my))), keys_first(G.GAP_KEY))
        c = checkpoint(c.where((F.col("combined_confidence") >= R.CONFIDENCE_THRESHOLD) | (F.col("gap_status") == "Open Non Suspect"))
                       .withColumn("cc_id", F.regexp_extract("cc_code", r"(\d+)$", 1).cast("int")), "gap-confidence")
    pop = inp.population().select(*my, "model_segment", "age_yr", "memb_gender_cd")
    j = c.join(pop, ["member_bid", "risk_year"]).withColumn("coeff_name", RF.hcc_coeff_name("model_segment", "cc_id"))
    j = S.coefficient_lookup(j, REF.coefficients(sp), "coeff_name", "coeff_score").withColumn("row_type", F.lit("HCC"))
    j = j.withColumns({"risk_type_detail_id": RF.hcc_detail_id("cc_code"), "coeff_score": F.coalesce("coeff_score", F.lit(0.0))})
    pairs = G.gap_interactions(c.where(F.col("gap_status") == "Open Suspect"), inp.coded(), REF.pair_rules(sp))
    i = pairs.join(pop, ["member_bid", "risk_year"]).select(
        "version", "member_bid", "risk_year", "model_segment", "age_yr", "memb_gender_cd", F.lit("INTERACTION").alias("row_type"),
        F.col("interaction_name").alias("risk_type_detail_id"), F.col("interaction_name").alias("cc_code"), F.lit(None).cast("string").alias("methods"),
        F.col("confidence").alias("combined_confidence"), F.col("score").alias("coeff_score"), F.lit("Open Suspect").alias("gap_status"))
    return j.select(*i.columns).unionByName(i).select(
        "member_bid", "risk_year", "version", "row_type", "model_segment", "age_yr", "memb_gender_cd", "risk_type_detail_id", "cc_code",
        "methods", "combined_confidence", F.round("coeff_score", 3).alias("coeff_score"),
        F.round(F.col("coeff_score") * F.col("combined_confidence"), 6).alias("adj_coeff_score"),
        F.when(F.col("gap_status") == "Open Non Suspect", "S").otherwise("R").alias("suppression_ind"), "gap_status")


_TO_HCC = f"""SELECT c.member_bid, c.risk_year, 'v28' AS version, 'HCC' AS row_type, p.model_segment, p.age_yr, p.memb_gender_cd,
  'HCC' || substring(c.cc_code, 3) AS risk_type_detail_id, c.cc_code, c.methods, c.combined_confidence,
  round(coalesce(cf.score, 0.0), 3) AS coeff_score, round(coalesce(cf.score, 0.0) * c.combined_confidence, 6) AS adj_coeff_score,
  CASE WHEN s.gap_status = 'Open Non Suspect' THEN 'S' ELSE 'R' END AS suppression_ind, s.gap_status
FROM cconf_active c JOIN sbc_active s ON s.member_bid = c.member_bid AND s.risk_year = c.risk_year AND s.cc_code = c.cc_code
JOIN pop p ON p.member_bid = c.member_bid AND p.risk_year = c.risk_year
LEFT JOIN coefficients cf ON cf.version = 'v28' AND upper(cf.name) = upper(p.model_segment || '_HCC' ||
  CAST(CAST(substring(c.cc_code, 3) AS INTEGER) AS VARCHAR))
WHERE c.combined_confidence >= {R.CONFIDENCE_THRESHOLD} OR s.gap_status = 'Open Non Suspect'"""

_MCONF_ACTIVE = """SELECT * FROM mconf c WHERE EXISTS (SELECT 1 FROM active a WHERE a.member_bid = c.member_bid
  AND a.risk_year = c.risk_year AND a.method_id = c.method_id AND a.cc_code = c.cc_code)"""
_ACTIVE = """SELECT g.* FROM crossed g JOIN member m ON m.member_bid = g.member_bid WHERE g.cross_suppressed = 'N'
  AND NOT EXISTS (SELECT 1 FROM plan_exclusions x WHERE x.home_plan_id_cd = m.home_plan_id_cd AND x.method_id = g.method_id)
  AND NOT EXISTS (SELECT 1 FROM plan_exclusions x WHERE x.home_plan_id_cd = m.home_plan_id_cd AND x.cc_id = g.cc_id)"""
_HCC_STEPS = OS_STEPS + [
    ("crossed", _CROSS), ("active", _ACTIVE), ("mconf_active", _MCONF_ACTIVE),
    ("cconf_active", dict(OG.DRAFT_STEPS)["cconf"].replace("FROM mconf", "FROM mconf_active")),
    ("sbc_active", _STATUS_BY_CODE.replace("FROM gaps", "FROM active")), ("hcc_rows", _TO_HCC),
    ("side", """SELECT member_bid, risk_year, hcc, 1.0 AS c, 0 AS gap FROM mh28 UNION ALL
  SELECT member_bid, risk_year, CAST(substring(cc_code, 3) AS INTEGER), combined_confidence, 1 FROM hcc_rows t WHERE gap_status = 'Open Suspect'
    AND NOT EXISTS (SELECT 1 FROM mh28 m WHERE m.member_bid = t.member_bid AND m.risk_year = t.risk_year AND m.hcc = CAST(substring(t.cc_code, 3) AS INTEGER))"""),
    ("pairs", """SELECT a.member_bid, a.risk_year, r.interaction_name, r.score, round(a.c * b.c, 6) AS confidence FROM pair_rules r
  JOIN side a ON a.hcc = r.hcc1 JOIN side b ON b.hcc = r.hcc2 AND b.member_bid = a.member_bid AND b.risk_year = a.risk_year
  WHERE a.gap = 1 OR b.gap = 1"""),
    ("to_hcc", """SELECT * FROM hcc_rows UNION ALL
  SELECT i.member_bid, i.risk_year, 'v28', 'INTERACTION', p.model_segment, p.age_yr, p.memb_gender_cd, i.interaction_name, i.interaction_name,
    NULL, i.confidence, round(i.score, 3), round(i.score * i.confidence, 6), 'R', 'Open Suspect'
  FROM pairs i JOIN pop p ON p.member_bid = i.member_bid AND p.risk_year = i.risk_year""")]


def _versions(final: str, ints) -> str:
    """The whole chain once for each model version: its own rules, hierarchy, map and coefficients."""
    common = len(OP.OS.POP_STEPS)  # population and scored categories have all versions
    parts = []
    for v, rules in (("v28", "method_rules"), ("v24", "method_rules_v24")):
        edits = OP.OS._sedits_case()  # names the version of each of its rules
        own = [(n, q.replace(edits, "@").replace("'v28'", f"'{v}'").replace("@", edits).replace("method_rules", rules)) for n, q in _HCC_STEPS[common:]]
        base = [rules if n == "method_rules" else n for n in OG.BASE] + ["pair_rules"]
        parts.append(B.q(base, _HCC_STEPS[:common] + own, B.typed(final, list(ints))))
    return " UNION ALL ".join(f"SELECT * FROM ({q})" for q in parts)


def _all_versions(spark, sf) -> Inputs:
    return Inputs(spark, sf, versions=R.VERSIONS)


@query("gap_to_hcc", _versions("SELECT * FROM to_hcc", ["risk_year", "age_yr"]))
def gap_to_hcc(spark, sf):
    return gap_hcc_rows(_all_versions(spark, sf))


@query("gap_final_output", _versions("""
SELECT t.member_bid, m.home_plan_id_cd, m.contract_id, t.version, t.row_type, t.risk_year, t.cc_code, t.risk_type_detail_id, t.methods,
  t.combined_confidence, t.adj_coeff_score
FROM to_hcc t JOIN member m ON m.member_bid = t.member_bid WHERE t.gap_status = 'Open Suspect'""", ["risk_year"]))
def gap_final_output(spark, sf):
    inp = _all_versions(spark, sf)
    t = gap_hcc_rows(inp).where(F.col("gap_status") == "Open Suspect")
    return t.join(inp.member().select("member_bid", "home_plan_id_cd", "contract_id"), "member_bid").select(
        "member_bid", "home_plan_id_cd", "contract_id", "version", "row_type", "risk_year", "cc_code", "risk_type_detail_id", "methods",
        "combined_confidence", "adj_coeff_score")


@query("gap_pipeline", _versions("""
SELECT member_bid, risk_year, version, sum(CASE WHEN row_type = 'HCC' THEN 1 ELSE 0 END) AS n_gap_codes,
  sum(CASE WHEN row_type = 'HCC' AND suppression_ind = 'R' THEN 1 ELSE 0 END) AS n_open,
  round(sum(CASE WHEN row_type = 'HCC' AND suppression_ind = 'R' THEN adj_coeff_score ELSE 0.0 END), 6) AS gap_score,
  round(sum(CASE WHEN row_type = 'INTERACTION' THEN adj_coeff_score ELSE 0.0 END), 6) AS interaction_score
FROM to_hcc GROUP BY 1, 2, 3""", ["risk_year", "n_gap_codes", "n_open"]))
def gap_pipeline(spark, sf):
    """Every model version in one plan: codes, open codes, their score, and the score of the interactions they bring about."""
    hcc, open_ = F.col("row_type") == "HCC", F.col("suppression_ind") == "R"
    return gap_hcc_rows(_all_versions(spark, sf)).groupBy("member_bid", "risk_year", "version").agg(
        F.sum(hcc.cast("int")).alias("n_gap_codes"), F.sum((hcc & open_).cast("int")).alias("n_open"),
        F.round(F.sum(F.when(hcc & open_, F.col("adj_coeff_score")).otherwise(0.0)), 6).alias("gap_score"),
        F.round(F.sum(F.when(~hcc, F.col("adj_coeff_score")).otherwise(0.0)), 6).alias("interaction_score"))


@query("gap_m4_persistent", B.q(OC.BASE, OC.STEPS, B.typed("SELECT * FROM m4", ["risk_year", "method_id", "claim_type", "cc_id",
                                                                                "qualified_claim"])))
def gap_m4_persistent(spark, sf):
    return G.m4_persistent(Inputs(spark, sf, cut=True).persistence()).drop("version")
