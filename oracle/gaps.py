"""Oracle SQL for claim qualification and gap suspecting."""

from __future__ import annotations

from oracle import scoring as OS
from riskspark.sources import reference_data as R

BASE = OS.BASE + ["claim_header", "pharmacy", "method_rules", "code_groups", "qualifying_procedures",
                  "method_frequency", "method_default_weight", "plan_exclusions", "chronic", "prior_year"]

QUAL_STEPS = [
    ("hr", """SELECT h.claim_bid, CASE
        WHEN h.clm_tp_cd = 1 THEN CASE WHEN h.clm_pmt_sts_cd = 'P' AND substring(h.tp_of_bill_cd, 1, 2) IN ('11', '41') THEN 'Y' ELSE 'N' END
        WHEN h.clm_tp_cd = 2 THEN CASE WHEN h.allwd_amt > 0 AND h.clm_pmt_sts_cd = 'P' AND substring(h.tp_of_bill_cd, 1, 2) IN ('13', '85')
                                       AND EXISTS (SELECT 1 FROM enrollment e WHERE e.member_bid = h.member_bid
                                         AND h.claim_dt BETWEEN e.covrg_begin_dt AND e.covrg_end_dt) THEN 'Y' ELSE 'N' END
        WHEN h.clm_tp_cd = 3 THEN CASE WHEN h.clm_pmt_sts_cd = 'P' THEN 'Y' ELSE 'N' END
        ELSE 'N' END AS header_ok
      FROM claim_header h"""),
    ("el", """SELECT l.claim_bid, l.clm_tp_cd, CASE WHEN q.cpt_cd IS NOT NULL THEN 1 ELSE 0 END AS line_eligible
      FROM claim_line l LEFT JOIN qualifying_procedures q ON q.cpt_cd = l.cpt_cd AND l.claim_dt BETWEEN q.valid_from AND q.valid_to"""),
    ("cq", """SELECT el.claim_bid, CASE WHEN max(CASE WHEN hr.header_ok = 'Y' THEN 1 ELSE 0 END) = 1
        AND (max(el.clm_tp_cd) = 1 OR max(el.line_eligible) = 1) THEN 'Y' ELSE 'N' END AS qualify_claims
      FROM el JOIN hr ON hr.claim_bid = el.claim_bid GROUP BY el.claim_bid"""),
    ("gc", """SELECT l.member_bid, l.claim_bid, l.clm_tp_cd, l.claim_dt, l.risk_year, l.diag_cd, l.cpt_cd, cq.qualify_claims
      FROM claim_line l JOIN cq ON cq.claim_bid = l.claim_bid"""),
]

INCL = "r.program = 'CMS' AND r.exclusion_cd IS NULL AND r.modifier_cd IS NULL"
DRAFT = """member_bid, risk_year, method_id, claim_bid, claim_dt, claim_type, claim_cd_type, claim_cd, cc_id,
  'CC' || lpad(CAST(cc_id AS VARCHAR), 3, '0') AS cc_code, qualified_claim, qualify_claims"""

DRAFT_STEPS = QUAL_STEPS + [
    ("m1", f"""SELECT {DRAFT} FROM (SELECT p.member_bid, CAST(year(p.serv_dt) AS INTEGER) AS risk_year, r.method_id, p.claim_bid,
        p.serv_dt AS claim_dt, 4 AS claim_type, r.claim_cd_type, r.claim_cd, r.cc_id, r.qualified_claim, 'Y' AS qualify_claims
      FROM pharmacy p JOIN method_rules r ON r.method_id = 1 AND {INCL} AND r.claim_cd_type = 'NDC'
        AND p.prod_serv_id_cd = r.claim_cd)"""),
    ("m2", f"""SELECT DISTINCT {DRAFT} FROM (SELECT c.member_bid, c.risk_year, r.method_id, c.claim_bid, c.claim_dt,
        c.clm_tp_cd AS claim_type, r.claim_cd_type, r.claim_cd, r.cc_id, r.qualified_claim, c.qualify_claims
      FROM gc c JOIN method_rules r ON r.method_id = 2 AND {INCL}
        AND ((r.claim_cd_type = 'DIAGNOSIS' AND c.diag_cd = r.claim_cd) OR (r.claim_cd_type = 'CPT-HCPCS' AND c.cpt_cd = r.claim_cd)))"""),
    ("m10i", f"""SELECT DISTINCT {DRAFT} FROM (SELECT c.member_bid, c.risk_year, r.method_id, c.claim_bid, c.claim_dt,
        c.clm_tp_cd AS claim_type, r.claim_cd_type, r.claim_cd, r.cc_id, r.qualified_claim, c.qualify_claims
      FROM gc c JOIN method_rules r ON r.method_id = 10 AND {INCL} AND r.claim_cd_type = 'CPT-HCPCS' AND c.cpt_cd = r.claim_cd)"""),
    ("trig", """SELECT DISTINCT c.member_bid, c.risk_year, r.method_id, c.claim_bid, c.claim_dt, c.clm_tp_cd AS claim_type,
        r.claim_cd_type, r.claim_cd, r.cc_id, r.qualified_claim, c.qualify_claims, r.modifier_cd, r.exclusion_cd
      FROM gc c JOIN method_rules r ON r.method_id = 10 AND r.claim_cd_type = 'CPT-HCPCS' AND r.exclusion_cd IS NOT NULL
        AND c.cpt_cd = r.claim_cd"""),
    ("trig_x", f"""SELECT t.*, (SELECT min(x.diag_cd) FROM gc x JOIN code_groups g ON g.group_cd = t.exclusion_cd
          AND g.claim_cd_type = 'DIAGNOSIS' AND g.code = x.diag_cd
        WHERE x.member_bid = t.member_bid AND datediff('day', x.claim_dt, t.claim_dt) BETWEEN 0 AND {R.LOOKBACK_DAYS}) AS excl_diag_cd,
        (SELECT min(x.claim_dt) FROM gc x JOIN code_groups g ON g.group_cd = t.exclusion_cd
          AND g.claim_cd_type = 'DIAGNOSIS' AND g.code = x.diag_cd
        WHERE x.member_bid = t.member_bid AND datediff('day', x.claim_dt, t.claim_dt) BETWEEN 0 AND {R.LOOKBACK_DAYS}) AS excl_dt
      FROM trig t"""),
    ("s1", f"""SELECT {DRAFT} FROM trig_x t WHERE t.modifier_cd IS NOT NULL AND t.excl_dt IS NULL AND EXISTS (
        SELECT 1 FROM gc m JOIN code_groups g ON g.group_cd = t.modifier_cd AND g.code = m.cpt_cd
        WHERE m.claim_bid = t.claim_bid)"""),
    ("s2", f"""SELECT {DRAFT} FROM trig_x t WHERE t.modifier_cd IS NULL AND t.excl_dt IS NULL"""),
    # needs the persistence steps before it
    ("m4", """SELECT member_bid, risk_year, 4 AS method_id, claim_bid, claim_dt, CAST(NULL AS INTEGER) AS claim_type,
        'PERSISTENCE' AS claim_cd_type, diag_cd AS claim_cd, hcc AS cc_id, 'CC' || lpad(CAST(hcc AS VARCHAR), 3, '0') AS cc_code,
        0 AS qualified_claim, 'Y' AS qualify_claims, CASE WHEN suspect_status = 'Open Suspect' THEN 'Y' ELSE 'N' END AS create_gap,
        CASE WHEN suspect_status = 'Open Suspect' THEN coalesce(confidence_factor, 0.75) END AS confidence_factor
      FROM status WHERE suspect_status IN ('Open Suspect', 'Open Non Suspect', 'Closed Suspect')"""),
    ("draft", """SELECT *, CAST(NULL AS VARCHAR) AS m4_create, CAST(NULL AS DOUBLE) AS m4_confidence FROM (
        SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m10i
        UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2) UNION ALL SELECT * FROM m4"""),
    ("draft_f", """SELECT *, CASE WHEN (qualified_claim = 0 OR coalesce(qualify_claims, 'N') = 'Y') AND coalesce(m4_create, 'Y') = 'Y' THEN 'Create Gap' ELSE 'No Gap' END AS draft_status
      FROM draft"""),
    ("g0", """SELECT DISTINCT member_bid, risk_year, method_id, cc_id, cc_code FROM draft_f WHERE draft_status = 'Create Gap'"""),
    ("g1", """SELECT g.*, CASE WHEN p.parent IS NOT NULL THEN 'Y' ELSE 'N' END AS suppression1_yn,
        CASE WHEN p.parent IS NOT NULL THEN 'CC' || lpad(CAST(p.parent AS VARCHAR), 3, '0') END AS suppressed_by_parent
      FROM g0 g LEFT JOIN (SELECT a.member_bid, a.risk_year, a.method_id, h.child, min(h.parent) AS parent
        FROM g0 a JOIN hierarchy_pairs h ON h.version = 'v28' AND h.parent = a.cc_id GROUP BY 1, 2, 3, 4) p
        ON p.member_bid = g.member_bid AND p.risk_year = g.risk_year AND p.method_id = g.method_id AND p.child = g.cc_id"""),
    ("mh28", "SELECT DISTINCT member_bid, risk_year, hcc FROM mh WHERE version = 'v28'"),
    ("g2", """SELECT g1.*, CASE WHEN EXISTS (SELECT 1 FROM mh28 m WHERE m.member_bid = g1.member_bid
          AND m.risk_year = g1.risk_year AND m.hcc = g1.cc_id) THEN 'Y' ELSE 'N' END AS matching_yn,
        cp.parent AS _p2
      FROM g1 LEFT JOIN (SELECT m.member_bid, m.risk_year, h.child, min(h.parent) AS parent FROM mh28 m
          JOIN hierarchy_pairs h ON h.version = 'v28' AND h.parent = m.hcc GROUP BY 1, 2, 3) cp
        ON cp.member_bid = g1.member_bid AND cp.risk_year = g1.risk_year AND cp.child = g1.cc_id"""),
    ("g3", """SELECT member_bid, risk_year, method_id, cc_id, cc_code, suppression1_yn, suppressed_by_parent, matching_yn,
        CASE WHEN suppression1_yn = 'N' AND _p2 IS NOT NULL THEN 'Y' ELSE 'N' END AS suppression2_yn,
        CASE WHEN suppression1_yn = 'N' AND _p2 IS NOT NULL THEN 'CC' || lpad(CAST(_p2 AS VARCHAR), 3, '0') END AS suppressed_by_coded
      FROM g2"""),
    ("gaps", """SELECT *, CASE WHEN matching_yn = 'Y' THEN 'Closed Suspect'
          WHEN suppression1_yn = 'Y' OR suppression2_yn = 'Y' THEN 'Open Non Suspect' ELSE 'Open Suspect' END AS gap_status,
        CASE WHEN matching_yn = 'Y' OR suppression1_yn = 'Y' OR suppression2_yn = 'Y' THEN 'N' ELSE 'Y' END AS create_gap
      FROM g3"""),
    ("fr0", """SELECT * FROM draft_f WHERE draft_status = 'Create Gap'"""),
    ("fr1", """SELECT *, row_number() OVER (PARTITION BY member_bid, risk_year, method_id, cc_code
        ORDER BY claim_dt, claim_bid, claim_cd) AS rn,
        count(DISTINCT claim_bid) OVER (PARTITION BY member_bid, risk_year, method_id, cc_code) AS frequency FROM fr0"""),
    ("freqconf", """SELECT f.member_bid, f.risk_year, f.method_id, f.claim_bid, f.claim_dt, f.claim_type, f.claim_cd_type,
        f.claim_cd, f.cc_id, f.cc_code, f.qualified_claim, f.qualify_claims, f.frequency,
        coalesce(f.m4_confidence, CASE WHEN f.frequency = mf.frequency THEN mf.percent_weight ELSE dw.default_weight END) AS confidence_factor
      FROM fr1 f LEFT JOIN method_frequency mf ON mf.method_id = f.method_id AND mf.claim_cd_type = f.claim_cd_type
        AND mf.claim_cd = f.claim_cd
      LEFT JOIN method_default_weight dw ON dw.method_id = f.method_id WHERE f.rn = 1"""),
    ("mconf", """SELECT member_bid, risk_year, cc_code, method_id, max(confidence_factor) AS method_confidence,
        arg_min(claim_bid, (claim_dt, claim_bid)) AS claim_bid, min(claim_dt) AS claim_dt
      FROM freqconf GROUP BY 1, 2, 3, 4"""),
    ("cconf", """SELECT member_bid, risk_year, cc_code,
        round(1.0 - coalesce(product(1.0 - method_confidence) FILTER (WHERE method_confidence IS NOT NULL), 1.0), 6) AS combined_confidence,
        string_agg(DISTINCT CAST(method_id AS VARCHAR), ',' ORDER BY CAST(method_id AS VARCHAR)) AS methods,
        count(DISTINCT method_id) AS n_methods
      FROM mconf GROUP BY 1, 2, 3"""),
]
