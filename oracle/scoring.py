"""Oracle SQL for the risk-scoring queries."""

from __future__ import annotations

from riskspark.sources import reference_data as R

BASE = ["member", "enrollment", "claim_line", "time_periods", "icd_hcc", "hierarchy_pairs",
        "coefficients", "adjustment_factors", "version_weights", "group_rules"]


def _segment_case() -> str:
    whens = " ".join(f"WHEN {c} THEN '{s}'" for _, c, s in sorted(R.SEGMENT_RULES))
    return f"CASE {whens} ELSE '{R.DEFAULT_SEGMENT}' END"


def _sedits_case() -> str:
    lists: dict[str, list[str]] = {}
    for n, c in R.SEDITS_LISTS:
        lists.setdefault(n, []).append(c)
    # later rule wins: test the last rule first
    whens = []
    for v, _, cond, ln, val in sorted(R.SEDITS_RULES, key=lambda r: (r[0], r[1]), reverse=True):
        codes = ", ".join(f"'{c}'" for c in lists[ln])
        whens.append(f"WHEN version = '{v}' AND ({cond}) AND diag_cd IN ({codes}) THEN {val}")
    return "CASE " + " ".join(whens) + " ELSE hcc END"


VERSIONS_SQL = "(SELECT unnest([" + ", ".join(f"'{v}'" for v in R.VERSIONS) + "]) AS version)"

POP_STEPS = [
    ("ey", f"""SELECT DISTINCT member_bid, CAST(unnest(generate_series(
        year(covrg_begin_dt), CASE WHEN year(covrg_end_dt) = 9999 THEN greatest(year(covrg_begin_dt), {R.CURRENT_YEAR})
          ELSE year(covrg_end_dt) END)) AS INTEGER) AS risk_year FROM enrollment"""),
    ("pop0", """SELECT ey.member_bid, ey.risk_year, tp.time_period, m.memb_gender_cd, m.orec, m.segment,
        CAST(date_sub('year', m.memb_brth_dt, make_date(CAST(year(tp.begin_date) AS INTEGER) + 1, 2, 1)) AS INTEGER) AS age_yr
      FROM ey JOIN time_periods tp ON tp.risk_year = ey.risk_year AND tp.period_type = 'C'
      JOIN member m ON m.member_bid = ey.member_bid"""),
    ("pop", f"""SELECT *, CASE WHEN age_yr < 65 AND orec <> '0' THEN 1 ELSE 0 END AS disabl,
        CASE WHEN orec = '1' AND NOT (age_yr < 65 AND orec <> '0') THEN 1 ELSE 0 END AS origds,
        {_segment_case()} AS model_segment FROM pop0"""),
    ("diag", "SELECT DISTINCT member_bid, risk_year, diag_cd FROM claim_line WHERE clm_tp_cd IN (1, 2, 3)"),
    ("dmap", f"""SELECT d.member_bid, d.risk_year, v.version, d.diag_cd, p.age_yr, p.memb_gender_cd, p.model_segment, i.hcc
      FROM diag d JOIN pop p USING (member_bid, risk_year) CROSS JOIN {VERSIONS_SQL} v
      LEFT JOIN icd_hcc i ON i.version = v.version AND i.diag_cd = d.diag_cd"""),
    ("dsed", f"SELECT *, {_sedits_case()} AS hcc2 FROM dmap"),
    ("mh0", """SELECT DISTINCT member_bid, risk_year, version, model_segment, hcc2 AS hcc FROM dsed
      WHERE hcc2 IS NOT NULL AND hcc2 <> -1"""),
    ("mh", """SELECT * FROM mh0 c WHERE NOT EXISTS (
        SELECT 1 FROM mh0 p JOIN hierarchy_pairs h ON h.version = p.version AND h.parent = p.hcc
        WHERE p.member_bid = c.member_bid AND p.risk_year = c.risk_year AND p.version = c.version
          AND h.child = c.hcc)"""),
]

SCORE_STEPS = POP_STEPS + [
    ("hs", """SELECT mh.member_bid, mh.risk_year, mh.version, sum(coalesce(cf.score, 0.0)) AS hcc_score,
        count(DISTINCT mh.hcc) AS hcc_count, min(mh.model_segment) AS model_segment
      FROM mh LEFT JOIN coefficients cf ON cf.version = mh.version
        AND upper(cf.name) = upper(mh.model_segment || '_HCC' || CAST(mh.hcc AS VARCHAR))
      GROUP BY 1, 2, 3"""),
    ("hsc", """SELECT hs.*, coalesce(cf.score, 0.0) AS count_score FROM hs LEFT JOIN coefficients cf
      ON cf.version = hs.version AND upper(cf.name) = upper(hs.model_segment || '_D' ||
         CASE WHEN hs.hcc_count >= 10 THEN '10P' ELSE CAST(hs.hcc_count AS VARCHAR) END)"""),
    ("gp", """SELECT interaction_name, score, CAST(trim(unnest(string_split(primary_group, ','))) AS INTEGER) AS code FROM group_rules"""),
    ("gs", """SELECT interaction_name, CAST(trim(unnest(string_split(secondary_group, ','))) AS INTEGER) AS code FROM group_rules"""),
    ("gi", """SELECT member_bid, risk_year, version, sum(score) AS interaction_score FROM (
        SELECT DISTINCT mh.member_bid, mh.risk_year, mh.version, gp.interaction_name, gp.score
        FROM mh JOIN gp ON gp.code = mh.hcc
        WHERE EXISTS (SELECT 1 FROM mh m2 JOIN gs ON gs.code = m2.hcc
                      WHERE m2.member_bid = mh.member_bid AND m2.risk_year = mh.risk_year
                        AND m2.version = mh.version AND gs.interaction_name = gp.interaction_name))
      GROUP BY 1, 2, 3"""),
    ("pv", f"""SELECT p.*, v.version FROM pop p CROSS JOIN {VERSIONS_SQL} v"""),
    ("sc0", """SELECT pv.member_bid, pv.risk_year, pv.version, pv.time_period, pv.model_segment, pv.age_yr,
        pv.memb_gender_cd,
        coalesce(cd.score, 0.0) AS demog_score,
        coalesce(hsc.hcc_score, 0.0) AS hcc_score,
        coalesce(hsc.hcc_count, 0) AS hcc_count,
        coalesce(hsc.count_score, 0.0) AS count_score,
        coalesce(gi.interaction_score, 0.0) AS interaction_score,
        CASE WHEN pv.origds = 1 THEN coalesce(co.score, 0.0) ELSE 0.0 END AS origds_score
      FROM pv
      LEFT JOIN coefficients cd ON cd.version = pv.version AND upper(cd.name) = upper(
        pv.model_segment || '_' || pv.memb_gender_cd || CAST(pv.age_yr AS VARCHAR))
      LEFT JOIN coefficients co ON co.version = pv.version AND upper(co.name) = upper(
        pv.model_segment || '_OriginallyDisabled_' || CASE WHEN pv.memb_gender_cd = 'F' THEN 'Female' ELSE 'Male' END)
      LEFT JOIN hsc ON hsc.member_bid = pv.member_bid AND hsc.risk_year = pv.risk_year AND hsc.version = pv.version
      LEFT JOIN gi ON gi.member_bid = pv.member_bid AND gi.risk_year = pv.risk_year AND gi.version = pv.version"""),
    ("sc1", """SELECT *, round(demog_score + hcc_score + count_score + interaction_score + origds_score, 3) AS raw_score
      FROM sc0"""),
    ("sc2", """SELECT sc1.*, round(raw_score / af.normalization_factor, 3) AS normalized_score,
        af.coding_pattern_adjustment, vw.weight
      FROM sc1 LEFT JOIN adjustment_factors af ON lower(af.version) = sc1.version
      LEFT JOIN version_weights vw ON vw.version = sc1.version"""),
    ("sc3", "SELECT *, round(normalized_score * (1.0 - coding_pattern_adjustment), 3) AS payment_score FROM sc2"),
    ("scores", """SELECT member_bid, risk_year, version, time_period, model_segment, age_yr, memb_gender_cd,
        round(demog_score, 3) AS demog_score, round(hcc_score, 3) AS hcc_score,
        CAST(hcc_count AS BIGINT) AS hcc_count, round(count_score, 3) AS count_score,
        round(interaction_score, 3) AS interaction_score, round(origds_score, 3) AS origds_score,
        raw_score, normalized_score, payment_score, round(payment_score * weight, 3) AS weighted_score
      FROM sc3"""),
]

DETAIL_STEPS = [
    ("cdiag", "SELECT DISTINCT member_bid, risk_year, claim_bid, diag_cd FROM claim_line WHERE clm_tp_cd IN (1, 2, 3)"),
    ("cmap", f"""SELECT d.member_bid, d.risk_year, v.version, d.claim_bid, d.diag_cd, p.age_yr, p.memb_gender_cd, i.hcc
      FROM cdiag d JOIN pop p USING (member_bid, risk_year) CROSS JOIN {VERSIONS_SQL} v
      LEFT JOIN icd_hcc i ON i.version = v.version AND i.diag_cd = d.diag_cd"""),
    ("csed", f"SELECT member_bid, risk_year, version, claim_bid, diag_cd, {_sedits_case()} AS hcc FROM cmap"),
    ("detail", """SELECT c.member_bid, c.risk_year, c.version, c.claim_bid, c.diag_cd, c.hcc,
        CASE WHEN c.hcc = -1 THEN 'HCC-1' ELSE 'HCC' || lpad(CAST(c.hcc AS VARCHAR), 3, '0') END AS risk_type_detail_id,
        CASE WHEN c.hcc = -1 THEN 'X' WHEN EXISTS (SELECT 1 FROM mh WHERE mh.member_bid = c.member_bid
          AND mh.risk_year = c.risk_year AND mh.version = c.version AND mh.hcc = c.hcc) THEN 'R' ELSE 'S' END AS suppression_ind
      FROM csed c WHERE c.hcc IS NOT NULL"""),
]
