"""Registered risk-scoring queries (§2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import base as B
from oracle import scoring as OS
from riskspark.operators.joins import broadcast_if_small
from riskspark.operators.quality import quarantine
from riskspark.plans import models as MD
from riskspark.plans import scoring as S
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources import reference as REF

INTS = ["risk_year", "time_period", "age_yr"]
K = "member_bid, risk_year, version"


def _o(final: str, ints=(), steps=None) -> str:
    return B.q(OS.BASE + ["pair_rules", "sas_model_versions"], steps or OS.SCORE_STEPS, B.typed(final, list(ints)))


@query("rsk_raw", _o("SELECT * FROM scores", INTS))
def rsk_raw(spark, sf):
    return Inputs(spark, sf, cut=True).scores()


@query("rsk_hierarchy", _o("""
SELECT c.member_bid, c.risk_year, c.version, c.hcc, p.parent AS suppressed_by,
  CASE WHEN p.parent IS NULL THEN 0 ELSE 1 END AS suppressed
FROM mh0 c LEFT JOIN (SELECT a.member_bid, a.risk_year, a.version, h.child, min(h.parent) AS parent
  FROM mh0 a JOIN hierarchy_pairs h ON h.version = a.version AND h.parent = a.hcc GROUP BY 1, 2, 3, 4) p
  ON p.member_bid = c.member_bid AND p.risk_year = c.risk_year AND p.version = c.version AND p.child = c.hcc""",
    ["risk_year", "hcc", "suppressed_by", "suppressed"], OS.POP_STEPS))
def rsk_hierarchy(spark, sf):
    inp = Inputs(spark, sf)
    pop = inp.population()
    d = S.member_diagnoses(inp.lines()).join(
        pop.select("member_bid", "risk_year", "age_yr", "memb_gender_cd", "model_segment"), ["member_bid", "risk_year"])
    d = S.apply_sedits(S.map_icd_to_hcc(S.with_versions(d), REF.icd_hcc(spark)))
    h = d.where(F.col("hcc").isNotNull() & (F.col("hcc") != -1)).select(*S.MEMBER_KEYS, "hcc").distinct()
    return S.flag_hierarchy(h, REF.hierarchy_pairs(spark)).select(
        *S.MEMBER_KEYS, "hcc", "suppressed_by", "suppressed")


@query("rsk_scores", _o(f"SELECT {K}, demog_score, hcc_score, origds_score, count_score FROM scores", ["risk_year"]))
def rsk_scores(spark, sf):
    return Inputs(spark, sf).scores().select(*S.MEMBER_KEYS, "demog_score", "hcc_score", "origds_score", "count_score")


@query("rsk_interactions_group", _o(f"""
SELECT DISTINCT mh.member_bid, mh.risk_year, mh.version, gp.interaction_name, gp.score FROM mh JOIN gp ON gp.code = mh.hcc
WHERE EXISTS (SELECT 1 FROM mh m2 JOIN gs ON gs.code = m2.hcc WHERE m2.member_bid = mh.member_bid
  AND m2.risk_year = mh.risk_year AND m2.version = mh.version AND gs.interaction_name = gp.interaction_name)""", ["risk_year"]))
def rsk_interactions_group(spark, sf):
    inp = Inputs(spark, sf)
    return S.group_interactions(inp.member_hcc(), REF.group_rules(spark))


_PAIRS = [("pairs", """SELECT a.member_bid, a.risk_year, a.version, r.interaction_name, r.hcc1, r.hcc2, r.score
  FROM mh a JOIN mh b ON a.member_bid = b.member_bid AND a.risk_year = b.risk_year AND a.version = b.version
    AND a.hcc < b.hcc
  JOIN pair_rules r ON least(r.hcc1, r.hcc2) = a.hcc AND greatest(r.hcc1, r.hcc2) = b.hcc""")]


@query("rsk_interactions_pair", _o(f"""
SELECT p.member_bid, p.risk_year, p.version, p.interaction_name, p.score,
  round(p.score / af.normalization_factor, 3) AS adj_score,
  CASE WHEN EXISTS (SELECT 1 FROM pairs q WHERE q.member_bid = p.member_bid AND q.version = p.version
    AND q.risk_year = p.risk_year - 1 AND q.interaction_name = p.interaction_name) THEN 'Y' ELSE 'N' END AS already_stored
FROM pairs p JOIN adjustment_factors af ON af.version = p.version""", ["risk_year"], OS.SCORE_STEPS + _PAIRS))
def rsk_interactions_pair(spark, sf):
    inp = Inputs(spark, sf)
    p = S.pair_interactions(inp.member_hcc(), REF.pair_rules(spark))
    prev = p.select("member_bid", "version", (F.col("risk_year") + 1).alias("risk_year"), "interaction_name") \
        .withColumn("_s", F.lit("Y"))
    f = REF.adjustment_factors(spark).select("version", "normalization_factor")
    return p.join(broadcast_if_small(f), "version").join(prev, ["member_bid", "version", "risk_year", "interaction_name"], "left") \
        .select("member_bid", "risk_year", "version", "interaction_name", "score",
                F.round(F.col("score") / F.col("normalization_factor"), 3).alias("adj_score"),
                F.coalesce("_s", F.lit("N")).alias("already_stored"))


@query("rsk_normalized", _o(f"SELECT {K}, raw_score, normalized_score FROM scores", ["risk_year"]))
def rsk_normalized(spark, sf):
    return Inputs(spark, sf).scores().select(*S.MEMBER_KEYS, "raw_score", "normalized_score")


@query("rsk_payment", _o(f"SELECT {K}, normalized_score, payment_score FROM scores", ["risk_year"]))
def rsk_payment(spark, sf):
    return Inputs(spark, sf).scores().select(*S.MEMBER_KEYS, "normalized_score", "payment_score")


@query("rsk_weighted", _o(f"SELECT {K}, payment_score, weighted_score FROM scores", ["risk_year"]))
def rsk_weighted(spark, sf):
    return Inputs(spark, sf).scores().select(*S.MEMBER_KEYS, "payment_score", "weighted_score")


@query("rsk_blended", _o("""SELECT member_bid, risk_year, time_period, round(sum(weighted_score), 3) AS blended_score,
  count(*) AS n_versions FROM scores GROUP BY 1, 2, 3""", ["risk_year", "time_period"]))
def rsk_blended(spark, sf):
    return S.blended_scores(Inputs(spark, sf).scores())


@query("rsk_sas_version", _o(f"""
SELECT s.member_bid, s.risk_year, s.version, v.sas_model_version,
  'v' || regexp_extract(v.sas_model_version, 'V(24|28)', 1) AS model_version, s.raw_score
FROM scores s LEFT JOIN sas_model_versions v ON v.version = s.version
WHERE 'v' || regexp_extract(v.sas_model_version, 'V(24|28)', 1) <> 'v'""", ["risk_year"]))
def rsk_sas_version(spark, sf):
    s = Inputs(spark, sf).scores().select(*S.MEMBER_KEYS, "raw_score")
    j = s.join(broadcast_if_small(REF.sas_model_versions(spark)), "version", "left")
    mv = F.concat(F.lit("v"), F.regexp_extract("sas_model_version", "V(24|28)", 1))
    return j.withColumn("model_version", mv).where(F.col("model_version") != "v").select(
        *S.MEMBER_KEYS, "sas_model_version", "model_version", "raw_score")


_OUT = OS.SCORE_STEPS + OS.DETAIL_STEPS + [
    ("dl", """SELECT member_bid, risk_year, version, string_agg(diag_cd || ':' || CAST(hcc AS VARCHAR), ';'
        ORDER BY diag_cd || ':' || CAST(hcc AS VARCHAR)) AS diag_to_hcc_list
      FROM (SELECT DISTINCT member_bid, risk_year, version, diag_cd, hcc FROM detail) GROUP BY 1, 2, 3"""),
    ("hl", """SELECT r.member_bid, r.risk_year, r.version, string_agg(r.nm || ':' || printf('%.3f', coalesce(cf.score, 0.0)), ';'
        ORDER BY r.nm || ':' || printf('%.3f', coalesce(cf.score, 0.0))) AS hcc_to_score_list
      FROM (SELECT DISTINCT d.member_bid, d.risk_year, d.version, s.model_segment || '_HCC' || CAST(d.hcc AS VARCHAR) AS nm
            FROM detail d JOIN scores s ON s.member_bid = d.member_bid AND s.risk_year = d.risk_year AND s.version = d.version
            WHERE d.suppression_ind = 'R') r
      LEFT JOIN coefficients cf ON cf.version = r.version AND upper(cf.name) = upper(r.nm) GROUP BY 1, 2, 3"""),
    ("outp", """SELECT s.*, dl.diag_to_hcc_list, hl.hcc_to_score_list FROM scores s
      LEFT JOIN dl ON dl.member_bid = s.member_bid AND dl.risk_year = s.risk_year AND dl.version = s.version
      LEFT JOIN hl ON hl.member_bid = s.member_bid AND hl.risk_year = s.risk_year AND hl.version = s.version"""),
]


def _output(inp: Inputs):
    sp = inp.spark
    detail = S.hcc_detail(_claim_diag(inp), inp.population(), REF.icd_hcc(sp), inp.member_hcc())
    return S.member_output(inp.scores(), detail, REF.coefficients(sp))


def _claim_diag(inp: Inputs):
    return inp.claim_diag().select("member_bid", "risk_year", "claim_bid", "diag_cd").distinct()


@query("rsk_output", _o("SELECT * FROM outp", INTS, _OUT))
def rsk_output(spark, sf):
    return _output(Inputs(spark, sf, cut=True))


@query("rsk_hcc_detail", _o("SELECT * FROM detail", ["risk_year", "hcc"], _OUT))
def rsk_hcc_detail(spark, sf):
    inp = Inputs(spark, sf)
    return S.hcc_detail(_claim_diag(inp), inp.population(), REF.icd_hcc(spark), inp.member_hcc())


_CHECKED = [
    ("dx", f"""SELECT d.*, CASE WHEN NOT EXISTS (SELECT 1 FROM pop p WHERE p.member_bid = d.member_bid AND p.risk_year = d.risk_year) THEN 1 ELSE 0 END AS bad_member,
      CASE WHEN NOT EXISTS (SELECT 1 FROM icd_hcc i WHERE i.diag_cd = d.diag_cd) THEN 1 ELSE 0 END AS bad_code
      FROM (SELECT DISTINCT member_bid, risk_year, claim_bid, claim_dt, diag_cd FROM claim_line WHERE clm_tp_cd IN (1, 2, 3)) d"""),
    ("dxn", """SELECT member_bid, risk_year, sum(CASE WHEN bad_member + bad_code = 0 THEN 1 ELSE 0 END) AS n_accepted,
      sum(CASE WHEN bad_member + bad_code > 0 THEN 1 ELSE 0 END) AS n_rejected FROM dx GROUP BY 1, 2"""),
    ("chr", """SELECT mh.member_bid, mh.risk_year, mh.version, count(DISTINCT mh.hcc) AS n_chronic FROM mh JOIN chronic c ON c.hcc = mh.hcc GROUP BY 1, 2, 3"""),
    ("prs", "SELECT member_bid, risk_year, version, round(sum(score), 3) AS pair_score FROM pairs GROUP BY 1, 2, 3")]


@query("rsk_pipeline", B.q(OS.BASE + ["chronic", "pair_rules"], _OUT + _PAIRS + _CHECKED, B.typed("""
SELECT o.member_bid, o.risk_year, o.version, o.model_segment, o.raw_score, o.weighted_score, b.blended_score,
  coalesce(c.n_chronic, 0) AS n_chronic, coalesce(p.pair_score, 0.0) AS pair_score,
  coalesce(n.n_accepted, 0) AS n_accepted, coalesce(n.n_rejected, 0) AS n_rejected, o.diag_to_hcc_list, o.hcc_to_score_list
FROM outp o JOIN (SELECT member_bid, risk_year, round(sum(weighted_score), 3) AS blended_score FROM scores GROUP BY 1, 2) b
  ON b.member_bid = o.member_bid AND b.risk_year = o.risk_year
LEFT JOIN chr c ON c.member_bid = o.member_bid AND c.risk_year = o.risk_year AND c.version = o.version
LEFT JOIN prs p ON p.member_bid = o.member_bid AND p.risk_year = o.risk_year AND p.version = o.version
LEFT JOIN dxn n ON n.member_bid = o.member_bid AND n.risk_year = o.risk_year""", ["risk_year", "n_accepted", "n_rejected"])))
def rsk_pipeline(spark, sf):
    """Validate, score, chronic conditions, pair interactions, blending, trace
    lists. Diagnoses that fail a check go to quarantine with their reasons; the
    scores see the accepted ones only."""
    inp = Inputs(spark, sf, cut=True)
    accepted, rejected = validated(inp)
    inp.use("claim_diag", accepted)
    o, hcc = _output(inp), inp.member_hcc()
    b = S.blended_scores(o).drop("time_period", "n_versions")
    chronic = hcc.join(broadcast_if_small(REF.chronic(spark).select("hcc")), "hcc", "left_semi") \
        .groupBy(*S.MEMBER_KEYS).agg(F.countDistinct("hcc").alias("n_chronic"))
    pairs = S.pair_interactions(hcc, REF.pair_rules(spark)).groupBy(*S.MEMBER_KEYS).agg(F.round(F.sum("score"), 3).alias("pair_score"))
    checked = accepted.select("member_bid", "risk_year", F.lit(1).alias("a")).unionByName(rejected.select("member_bid", "risk_year", F.lit(0).alias("a"))) \
        .groupBy("member_bid", "risk_year").agg(F.sum("a").alias("n_accepted"), F.sum(1 - F.col("a")).alias("n_rejected"))
    j = o.join(b, ["member_bid", "risk_year"]).join(chronic, S.MEMBER_KEYS, "left").join(pairs, S.MEMBER_KEYS, "left") \
        .join(checked, ["member_bid", "risk_year"], "left")
    return j.select("member_bid", "risk_year", "version", "model_segment", "raw_score", "weighted_score", "blended_score",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_chronic", "n_accepted", "n_rejected")],
                    F.coalesce("pair_score", F.lit(0.0)).alias("pair_score"), "diag_to_hcc_list", "hcc_to_score_list")


def validated(inp: Inputs):
    """(accepted, rejected) coded diagnoses: the member is covered in the year, the code is mapped by a model."""
    pop = inp.population().select("member_bid", "risk_year", F.lit(True).alias("_member"))
    codes = REF.icd_hcc(inp.spark).select("diag_cd", F.lit(True).alias("_code")).distinct()
    rows = inp.claim_diag().join(pop, ["member_bid", "risk_year"], "left").join(broadcast_if_small(codes), "diag_cd", "left")
    accepted, rejected = quarantine(rows, {"MEMBER_NOT_COVERED": F.col("_member"), "CODE_NOT_MAPPED": F.col("_code")})
    return accepted.drop("_member", "_code"), rejected.drop("_member", "_code")


_MODELS = OS.POP_STEPS[:4] + [
    ("mm", """SELECT m.*, p.member_bid, p.risk_year, p.model_segment, p.age_yr, p.memb_gender_cd FROM models m
      JOIN pop p ON list_contains(string_split(m.segments, ','), p.model_segment)"""),
    ("md", """SELECT mm.*, mm.map_set AS version, d.diag_cd, i.hcc FROM mm JOIN diag d ON d.member_bid = mm.member_bid AND d.risk_year = mm.risk_year
      LEFT JOIN icd_hcc i ON i.version = mm.map_set AND i.diag_cd = d.diag_cd"""),
    ("me", f"SELECT DISTINCT model_id, member_bid, risk_year, hierarchy_set, coefficient_set, model_segment, hcc2 AS hcc FROM "
           f"(SELECT *, {OS._sedits_case()} AS hcc2 FROM md) WHERE hcc2 IS NOT NULL AND hcc2 <> -1"),
    ("mk", """SELECT * FROM me c WHERE NOT EXISTS (SELECT 1 FROM me p JOIN hierarchy_pairs h ON h.version = p.hierarchy_set AND h.parent = p.hcc
      WHERE p.model_id = c.model_id AND p.member_bid = c.member_bid AND p.risk_year = c.risk_year AND h.child = c.hcc)"""),
    ("ms", """SELECT k.model_id, k.member_bid, k.risk_year, sum(coalesce(cf.score, 0.0)) AS hcc_score, count(*) AS hcc_count FROM mk k
      LEFT JOIN coefficients cf ON cf.version = k.coefficient_set AND upper(cf.name) = upper(k.model_segment || '_HCC' || CAST(k.hcc AS VARCHAR))
      GROUP BY 1, 2, 3"""),
    ("mo", """SELECT mm.model_id, mm.member_bid, mm.risk_year, mm.family, mm.model_segment, coalesce(cd.score, 0.0) AS demog, coalesce(ms.hcc_score, 0.0) AS hcc,
        coalesce(cc.score, 0.0) AS cnt, coalesce(ms.hcc_count, 0) AS hcc_count FROM mm
      LEFT JOIN ms ON ms.model_id = mm.model_id AND ms.member_bid = mm.member_bid AND ms.risk_year = mm.risk_year
      LEFT JOIN coefficients cd ON cd.version = mm.coefficient_set AND upper(cd.name) = upper(mm.model_segment || '_' || mm.memb_gender_cd || CAST(mm.age_yr AS VARCHAR))
      LEFT JOIN coefficients cc ON mm.scores_count = 'Y' AND cc.version = mm.coefficient_set AND upper(cc.name) = upper(mm.model_segment || '_D' ||
        CASE WHEN ms.hcc_count >= 10 THEN '10P' ELSE CAST(ms.hcc_count AS VARCHAR) END)""")]


@query("rsk_models", B.q(OS.BASE + ["models"], _MODELS, B.typed("""
SELECT model_id, member_bid, risk_year, family, model_segment, round(demog, 3) AS demog_score, round(hcc, 3) AS hcc_score,
  round(cnt, 3) AS count_score, hcc_count, round(demog + hcc + cnt, 3) AS raw_score FROM mo""", ["risk_year", "hcc_count"])))
def rsk_models(spark, sf):
    """Every model of the registry, of two families, in one plan."""
    inp = Inputs(spark, sf)
    diagnoses = inp.claim_diag().select("member_bid", "risk_year", "diag_cd").distinct()
    return MD.score_models(inp.population(), diagnoses, REF.models(spark), REF.icd_hcc(spark), REF.hierarchy_pairs(spark), REF.coefficients(spark))
