"""Rule-table contents (plain Python, shared by the Spark side and the SQL oracle).

FIXED VALUES — these rows define the rule set the checked queries run with.
They are stated here plainly, in natural order; larger tables (coefficients,
confidence buckets) are generated from the rules written next to them.
"""

from __future__ import annotations

import datetime as _dt

MODEL = "cms_hcc"
VERSIONS = ("v24", "v28")
SEGMENTS = ("CNA", "CFA", "CPA", "INS")
#: Calendar years of the time-period table; open coverage ends in the current year.
FIRST_YEAR, LAST_YEAR = 1995, 2001
CURRENT_YEAR = LAST_YEAR

# --- fixed values: diagnosis -> condition category, by model version -------
# v28: D000..D029 -> 1..30; v24: D000..D019 -> 1..20; D030..D039 unmapped.
ICD_HCC = [("v28", f"D{i:03d}", i + 1) for i in range(30)] + \
          [("v24", f"D{i:03d}", i + 1) for i in range(20)]

# --- fixed values: hierarchy (parent keeps, children listed are dropped) ---
HIERARCHY = [(v, p, c) for v in VERSIONS for (p, c) in
             [(1, "2,3"), (5, "6,7,8"), (6, "7,8"), (17, "18,19"), (23, "24"), (26, "27,28")]]

# --- fixed values: normalisation and coding-pattern adjustment -------------
ADJUSTMENT_FACTORS = [("v28", MODEL, 1.015, 0.058), ("v24", MODEL, 1.146, 0.059)]

# --- fixed values: version blending weights --------------------------------
VERSION_WEIGHTS = [("v28", 0.67), ("v24", 0.33)]

# --- fixed values: pair interactions (code1 < code2), all segments ---------
PAIR_RULES = [("INT_1_5", 1, 5, 0.12), ("INT_5_17", 5, 17, 0.08), ("INT_9_20", 9, 20, 0.05)]

# --- fixed values: group interactions (>=1 primary AND >=1 secondary) -------
GROUP_RULES = [("GRP_A", "1,2", "5,6", 0.1), ("GRP_B", "17,18,19", "9", 0.07)]

# --- fixed values: sex/age edit diagnosis lists ----------------------------
SEDITS_LISTS = [("SEDITS_DIAG1", "D001"), ("SEDITS_DIAG2", "D002"), ("SEDITS_DIAG2", "D003"),
                ("SEDITS_DIAG3", "D004"), ("SEDITS_DIAG4", "D005"), ("SEDITS_DIAG5", "D006")]

# --- fixed values: sex/age edit rules, evaluated in order, later rule wins --
# (version, order, sql condition on AGE_YR / MEMB_GENDER_CD, list, result category)
SEDITS_RULES = [
    ("v28", 1, "memb_gender_cd = 'F'", "SEDITS_DIAG1", 112),
    ("v28", 2, "age_yr < 18", "SEDITS_DIAG2", -1),
    ("v28", 3, "age_yr < 50", "SEDITS_DIAG3", 22),
    ("v28", 4, "age_yr >= 2", "SEDITS_DIAG4", -1),
    ("v24", 1, "memb_gender_cd = 'F'", "SEDITS_DIAG1", 48),
    ("v24", 2, "age_yr < 18", "SEDITS_DIAG2", 112),
    ("v24", 3, "(age_yr < 6 OR age_yr > 18)", "SEDITS_DIAG5", -1),
]

# --- fixed values: community segment rules, first match by priority --------
SEGMENT_RULES = [
    (1, "segment = 'INS'", "INS"),
    (2, "segment = 'CFA' AND age_yr >= 65", "CFA"),
    (3, "segment = 'CPA' AND age_yr >= 65", "CPA"),
    (4, "age_yr >= 0", "CNA"),
]
DEFAULT_SEGMENT = "Unknown"

# --- fixed values: chronic condition categories ----------------------------
CHRONIC_HCC = [1, 5, 6, 9, 17, 18, 20]

# --- fixed values: gap-suspecting method rules -----------------------------
# (method_id, program, claim_cd_type, claim_cd, modifier_type, modifier_cd,
#  cc_id, exclusion_type, exclusion_cd, qualified_claim)
METHOD_RULES = [
    (1, "CMS", "NDC", "N003", None, None, 21, None, None, 0),
    (1, "CMS", "NDC", "N007", None, None, 23, None, None, 0),
    (2, "CMS", "DIAGNOSIS", "D030", None, None, 23, None, None, 0),
    (2, "CMS", "DIAGNOSIS", "D031", None, None, 24, None, None, 1),
    (2, "CMS", "CPT-HCPCS", "C050", None, None, 25, None, None, 0),
    (10, "CMS", "CPT-HCPCS", "C045", None, None, 23, None, None, 0),
    (10, "CMS", "CPT-HCPCS", "C007", "GROUP", "MODS", 27, "GROUP", "EXA", 0),
    (10, "CMS", "CPT-HCPCS", "C019", None, None, 28, "GROUP", "EXB", 0),
]

# The same rules' categories in the older version, in the order of the rules.
METHOD_RULES_V24 = [(*r[:6], cc, *r[7:]) for r, cc in zip(METHOD_RULES, (19, 18, 17, 18, 9, 6, 7, 8))]

# --- fixed values: code groups ---------------------------------------------
CODE_GROUPS = [("CPT-HCPCS", "MODS", "C003"), ("CPT-HCPCS", "MODS", "C011"),
               ("CPT-HCPCS", "MODS", "C023"), ("CPT-HCPCS", "MODS", "C041"),
               ("DIAGNOSIS", "EXA", "D030"), ("DIAGNOSIS", "EXB", "D031")]

# --- fixed values: frequency weights and default method weights ------------
METHOD_FREQUENCY = [(2, "DIAGNOSIS", "D030", 2, 0.8)]
METHOD_DEFAULT_WEIGHT = [(1, 0.6), (2, 0.6), (4, 0.75), (10, 0.55)]
# method priority for one-row-per-code picks: 4 > 10 > 1 > 2
METHOD_PRIORITY = [(4, 1), (10, 2), (1, 3), (2, 4)]
CONFIDENCE_THRESHOLD = 0.75
LOOKBACK_DAYS = 180

# --- fixed values: qualifying procedure window -----------------------------
QUALIFYING_PROC_RANGE = (0, 39)            # C000..C039
QUALIFYING_PROC_VALID = (_dt.date(1995, 1, 1), _dt.date(1999, 12, 31))

# --- fixed values: place of service by bill-type prefix (facility only) ----
PLACE_OF_SERVICE = [("11", "21"), ("13", "22"), ("41", "21"), ("85", "22"), ("72", "65")]

# --- fixed values: claim type labels -----------------------------------------
CLAIM_TYPE_LABELS = [(1, "facility-inpatient"), (2, "facility-outpatient"),
                     (3, "professional"), (4, "pharmacy")]


# --- generated by rule ------------------------------------------------------
def coefficient_rows() -> list[tuple]:
    """(version, model, name, score).

    HCC: ``{seg}_HCC{n}`` = round(0.05 + n/100, 3), +0.1 for INS, n = 1..130.
    Demographic: ``{seg}_{F|M}{age}`` = round(age/200, 3), age 0..95.
    ``{seg}_OriginallyDisabled_{Male|Female}`` = 0.05.
    Count: ``{seg}_D{n}`` = 0.01*(n-3) for n = 4..9, ``{seg}_D10P`` = 0.1.
    """
    rows = []
    for v in VERSIONS:
        for s in SEGMENTS:
            extra = 0.1 if s == "INS" else 0.0
            for n in range(1, 131):
                rows.append((v, MODEL, f"{s}_HCC{n}", round(round(0.05 + n / 100, 3) + extra, 3)))
            for g in ("F", "M"):
                for age in range(0, 96):
                    rows.append((v, MODEL, f"{s}_{g}{age}", round(age / 200, 3)))
            for g in ("Male", "Female"):
                rows.append((v, MODEL, f"{s}_OriginallyDisabled_{g}", 0.05))
            for n in range(4, 10):
                rows.append((v, MODEL, f"{s}_D{n}", round(0.01 * (n - 3), 2)))
            rows.append((v, MODEL, f"{s}_D10P", 0.1))
    return rows


def time_period_rows() -> list[tuple]:
    """(time_period, begin_date, end_date, type, risk_year): calendar period
    of each year, and the fiscal period July..June ending in the next year."""
    rows = []
    for i, y in enumerate(range(FIRST_YEAR, LAST_YEAR + 1)):
        rows.append((2 * i + 1, _dt.date(y, 1, 1), _dt.date(y, 12, 31), "C", y))
        rows.append((2 * i + 2, _dt.date(y, 7, 1), _dt.date(y + 1, 6, 30), "F", y + 1))
    return rows


PRIOR_YEAR_BOUNDS = (30, 60, 90, 120, 180, 360, None)  # None: above the last bound, open-ended
PRIOR_YEAR_FREQ_BANDS = ((1, 2), (3, 5), (6, 999))


def prior_year_rows() -> list[tuple]:
    """(last_occurrence_bound, freq_min, freq_max, weight): durations above the
    bound before and up to this one x frequency band; weight 0.80 at the shortest bound and
    highest band, minus 0.05 per longer bound and per lower band."""
    rows = []
    for li, b in enumerate(PRIOR_YEAR_BOUNDS):
        for fj, (lo, hi) in enumerate(PRIOR_YEAR_FREQ_BANDS):
            rows.append((b, lo, hi, round(0.80 - 0.05 * li - 0.05 * (2 - fj), 2)))
    return rows


# --- fixed values: plan-level gap exclusions (plan, method or null, cc or null) --
PLAN_EXCLUSIONS = [("007", 1, None), ("012", None, 25), ("003", 10, 27)]

# --- fixed values: SAS model version by model version -----------------------
SAS_MODEL_VERSIONS = [("v24", "V2419P1M"), ("v28", "V2825T1M")]

# --- fixed values: risk models: (id, family, code map, hierarchy, coefficients, segments, count scored) --
MODELS = [("CMS-HCC-V24", "cms_hcc", "v24", "v24", "v24", "CNA,CFA,CPA,INS", "Y"),
          ("CMS-HCC-V28", "cms_hcc", "v28", "v28", "v28", "CNA,CFA,CPA,INS", "Y"),
          ("RX-HCC-V08", "rx_hcc", "v28", "v24", "v24", "CNA,INS", "N")]

# --- fixed values: visit type of a qualifying procedure ---------------------
VISIT_TYPE_MATCHED, VISIT_TYPE_OTHER = "FACE_TO_FACE", "OTHER"

# --- fixed values: pair interaction multipliers (both codes must match) -------
MULTIPLIER_RULES = [(1, 5, 1.1), (5, 17, 1.2), (9, 20, 1.05)]

# --- fixed values: surrogate-key prefixes -------------------------------------
BID_PREFIX = {"member": 11, "claim": 33, "pharmacy": 44, "facility": 22, "provider": 66, "location": 77}
