"""Oracle SQL for persistence."""

from __future__ import annotations

from oracle import scoring as OS

BASE = OS.BASE + ["chronic", "prior_year"]
H = "(SELECT parent, child FROM hierarchy_pairs WHERE version = 'v28')"

STEPS = OS.POP_STEPS + [
    ("cd2", "SELECT DISTINCT member_bid, risk_year, claim_bid, claim_dt, diag_cd FROM claim_line WHERE clm_tp_cd IN (1, 2, 3)"),
    ("cm2", """SELECT d.*, 'v28' AS version, p.age_yr, p.memb_gender_cd, i.hcc FROM cd2 d JOIN pop p USING (member_bid, risk_year)
      LEFT JOIN icd_hcc i ON i.version = 'v28' AND i.diag_cd = d.diag_cd"""),
    ("ch", f"""SELECT member_bid, risk_year, claim_bid, claim_dt, diag_cd, hcc2 AS hcc FROM (
        SELECT *, {OS._sedits_case()} AS hcc2 FROM cm2) WHERE hcc2 IS NOT NULL AND hcc2 <> -1"""),
    ("codes", "SELECT DISTINCT member_bid, risk_year, hcc FROM ch"),
    ("src", "SELECT * FROM ch WHERE hcc IN (SELECT hcc FROM chronic)"),
    ("pe", f"""SELECT * FROM (SELECT member_bid, risk_year AS prior_year, claim_bid, claim_dt, diag_cd, hcc,
        CAST(unnest(generate_series(risk_year + 1, risk_year + 2)) AS INTEGER) AS risk_year FROM src) WHERE risk_year IN (SELECT risk_year FROM time_periods WHERE period_type = 'C')"""),
    ("pl", """SELECT * EXCLUDE (rn) FROM (SELECT *, count(DISTINCT claim_bid) OVER (PARTITION BY member_bid, risk_year, hcc) AS frequency,
        row_number() OVER (PARTITION BY member_bid, risk_year, hcc ORDER BY claim_dt DESC, claim_bid DESC, diag_cd DESC) AS rn
      FROM pe) WHERE rn = 1"""),
    ("curl", """SELECT * EXCLUDE (rn) FROM (SELECT *, count(DISTINCT claim_bid) OVER (PARTITION BY member_bid, risk_year, hcc) AS frequency,
        row_number() OVER (PARTITION BY member_bid, risk_year, hcc ORDER BY claim_dt DESC, claim_bid DESC, diag_cd DESC) AS rn
      FROM ch) WHERE rn = 1"""),
    ("rel", f"""SELECT p.member_bid, p.risk_year, p.hcc, c.hcc AS current_hcc, 'SAME' AS relation, 1 AS pr
        FROM pl p JOIN codes c ON c.member_bid = p.member_bid AND c.risk_year = p.risk_year AND c.hcc = p.hcc
      UNION ALL SELECT p.member_bid, p.risk_year, p.hcc, c.hcc, 'CHILD_CODED', 2 FROM pl p JOIN {H} h ON h.parent = p.hcc
        JOIN codes c ON c.member_bid = p.member_bid AND c.risk_year = p.risk_year AND c.hcc = h.child
      UNION ALL SELECT p.member_bid, p.risk_year, p.hcc, c.hcc, 'PARENT_CODED', 3 FROM pl p JOIN {H} h ON h.child = p.hcc
        JOIN codes c ON c.member_bid = p.member_bid AND c.risk_year = p.risk_year AND c.hcc = h.parent"""),
    ("best", """SELECT member_bid, risk_year, hcc, arg_min(relation, (pr, relation, current_hcc)) AS relation,
        arg_min(current_hcc, (pr, relation, current_hcc)) AS current_hcc FROM rel GROUP BY 1, 2, 3"""),
    ("supy", f"""SELECT c.member_bid, c.risk_year, h.child AS hcc, min(h.parent) AS suppressed_by FROM codes c
        JOIN {H} h ON h.parent = c.hcc GROUP BY 1, 2, 3"""),
    ("cls", f"""SELECT p.member_bid, p.risk_year, p.hcc, p.prior_year, p.claim_bid, p.claim_dt, p.diag_cd, p.frequency,
        coalesce(b.relation, CASE WHEN s.suppressed_by IS NOT NULL THEN 'PRIOR_SUPPRESSED' END, 'NONE') AS relation,
        abs(datediff('day', p.claim_dt, make_date(p.risk_year, 1, 1))) AS duration
      FROM pl p LEFT JOIN best b ON b.member_bid = p.member_bid AND b.risk_year = p.risk_year AND b.hcc = p.hcc
      LEFT JOIN supy s ON s.member_bid = p.member_bid AND s.risk_year = p.prior_year AND s.hcc = p.hcc"""),
    ("cls2", """SELECT *, CASE relation WHEN 'SAME' THEN 'Actual Persistent' WHEN 'CHILD_CODED' THEN 'Actual Persistent'
          WHEN 'PARENT_CODED' THEN 'Actual NS Persistent' WHEN 'PRIOR_SUPPRESSED' THEN 'Open NS Persistent' ELSE 'Open Persistent' END AS persistent_status,
        CASE relation WHEN 'SAME' THEN 'Closed Suspect' WHEN 'CHILD_CODED' THEN 'Closed Suspect'
          WHEN 'PARENT_CODED' THEN 'Open Non Suspect' WHEN 'PRIOR_SUPPRESSED' THEN 'Open Non Suspect' ELSE 'Open Suspect' END AS suspect_status,
        CASE relation WHEN 'SAME' THEN 'Same HCC coded in risk year' WHEN 'CHILD_CODED' THEN 'Lower severity HCC coded in risk year'
          WHEN 'PARENT_CODED' THEN 'Higher severity HCC coded in risk year' WHEN 'PRIOR_SUPPRESSED' THEN 'Suppressed by parent in prior year'
          ELSE 'Not coded in risk year' END AS persistent_status_reason FROM cls"""),
    ("newc", f"""SELECT c.member_bid, c.risk_year, c.hcc, CAST(NULL AS INTEGER) AS prior_year, c.claim_bid, c.claim_dt, c.diag_cd,
        c.frequency, 'NEW' AS relation, abs(datediff('day', c.claim_dt, make_date(c.risk_year, 1, 1))) AS duration,
        'New' AS persistent_status, CAST(NULL AS VARCHAR) AS suspect_status, 'New HCC' AS persistent_status_reason
      FROM curl c WHERE NOT EXISTS (SELECT 1 FROM pl p WHERE p.member_bid = c.member_bid AND p.risk_year = c.risk_year AND p.hcc = c.hcc)
        AND NOT EXISTS (SELECT 1 FROM pl p JOIN {H} h ON h.parent = p.hcc WHERE p.member_bid = c.member_bid
          AND p.risk_year = c.risk_year AND h.child = c.hcc)"""),
    ("status", """SELECT c.member_bid, c.risk_year, c.hcc, c.prior_year, c.claim_bid, c.claim_dt, c.diag_cd, c.frequency, c.relation,
        c.persistent_status, c.suspect_status, c.persistent_status_reason, c.duration,
        CASE WHEN c.suspect_status = 'Open Suspect' THEN py.weight END AS confidence_factor
      FROM cls2 c LEFT JOIN prior_year py ON c.suspect_status = 'Open Suspect'
        AND py.last_bound IS NOT DISTINCT FROM (SELECT min(b.last_bound) FROM prior_year b WHERE b.last_bound >= c.duration) AND c.frequency >= py.freq_min AND (c.frequency <= py.freq_max OR py.freq_max = 999)
      UNION ALL SELECT member_bid, risk_year, hcc, prior_year, claim_bid, claim_dt, diag_cd, frequency, relation,
        persistent_status, suspect_status, persistent_status_reason, duration, CAST(NULL AS DOUBLE) FROM newc"""),
]
