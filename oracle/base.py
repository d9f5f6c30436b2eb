"""Common table expressions for the oracle: the domain projection (same
contract as ``riskspark.sources.domain``) and the rule tables as VALUES.

``q(names, steps, final)`` prepends the named CTEs (and their dependencies)
and the query-local steps to the final SELECT.
"""

from __future__ import annotations

import datetime as _dt
import re

from riskspark.sources import reference_data as R


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("'", "''") + "'"


def values(rows, cols: str, casts: dict | None = None) -> str:
    names = [c.strip() for c in cols.split(",")]
    casts = dict(casts or {})
    for i, n in enumerate(names):
        if n not in casts and any(isinstance(r[i], float) for r in rows):
            casts[n] = "DOUBLE"
    body = ",\n".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    sel = ", ".join(f"CAST({n} AS {casts[n]}) AS {n}" if casts and n in casts else n for n in names)
    return f"SELECT {sel} FROM (VALUES {body}) t({', '.join(names)})"


CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str] | None = None):
    def deco(fn):
        CTES[name] = (fn(), deps or [])
        return fn
    return deco


@cte("member")
def _member():
    return """SELECT 1100000000 + c_custkey AS member_bid,
  lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS home_plan_id_cd,
  CAST(DATE '1910-01-01' + CAST((c_custkey * 2917) % 31000 AS INTEGER) AS DATE) AS memb_brth_dt,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS memb_gender_cd,
  CAST(c_custkey % 3 AS VARCHAR) AS orec,
  CASE c_custkey % 4 WHEN 0 THEN 'CNA' WHEN 1 THEN 'CFA' WHEN 2 THEN 'CPA' ELSE 'INS' END AS segment,
  'H' || lpad(CAST(c_nationkey % 5 AS VARCHAR), 4, '0') AS contract_id
FROM customer"""


@cte("enrollment")
def _enrollment():
    return """SELECT 1100000000 + c_custkey AS member_bid,
  lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS home_plan_id_cd,
  'H' || lpad(CAST(c_nationkey % 5 AS VARCHAR), 4, '0') AS contract_id,
  CAST(DATE '1995-01-01' + CAST(c_custkey % 400 AS INTEGER) AS DATE) AS covrg_begin_dt,
  CASE WHEN c_custkey % 10 = 0 THEN DATE '9999-12-31'
       ELSE CAST(DATE '1997-12-31' + CAST((c_custkey * 13) % 1300 AS INTEGER) AS DATE) END AS covrg_end_dt
FROM customer"""


@cte("claim_header")
def _claim_header():
    return """SELECT 3300000000 + o_orderkey AS claim_bid,
  1100000000 + o_custkey AS member_bid,
  CAST(1 + o_orderkey % 3 AS INTEGER) AS clm_tp_cd,
  CASE WHEN o_orderstatus IN ('P', 'F') THEN 'P' ELSE 'D' END AS clm_pmt_sts_cd,
  o_totalprice AS allwd_amt,
  CAST(o_orderdate AS DATE) AS claim_dt,
  CAST(year(o_orderdate) AS INTEGER) AS risk_year,
  strftime(o_orderdate, '%Y_%m') AS source_load_month,
  CASE o_orderkey % 5 WHEN 0 THEN '110' WHEN 1 THEN '131' WHEN 2 THEN '850' WHEN 3 THEN '411' ELSE '720' END AS tp_of_bill_cd
FROM orders"""


@cte("claim_line", ["claim_header"])
def _claim_line():
    return """SELECT h.*, l.l_linenumber AS clm_ln_num,
  'C' || lpad(CAST(l.l_partkey % 60 AS VARCHAR), 3, '0') AS cpt_cd,
  'D' || lpad(CAST(l.l_partkey % 40 AS VARCHAR), 3, '0') AS diag_cd,
  l.l_extendedprice AS line_amt, CAST(l.l_shipdate AS DATE) AS updated_dt,
  l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity
FROM lineitem l JOIN claim_header h ON h.claim_bid = 3300000000 + l.l_orderkey"""


@cte("pharmacy")
def _pharmacy():
    return """SELECT 4400000000 + l.l_orderkey AS claim_bid, 1100000000 + o.o_custkey AS member_bid,
  l.l_linenumber AS clm_ln_num,
  'N' || lpad(CAST(l.l_suppkey % 25 AS VARCHAR), 3, '0') AS prod_serv_id_cd,
  CAST(l.l_shipdate AS DATE) AS serv_dt, l.l_extendedprice AS allwd_amt, l.l_partkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_returnflag = 'R'"""


@cte("icd_hcc")
def _icd():
    return values(R.ICD_HCC, "version, diag_cd, hcc")


@cte("hierarchy_pairs")
def _hier():
    return ("SELECT version, parent, CAST(trim(c) AS INTEGER) AS child FROM ("
            "SELECT version, parent, unnest(string_split(child, ',')) AS c FROM ("
            + values(R.HIERARCHY, "version, parent, child") + "))")


@cte("coefficients")
def _coef():
    return values(R.coefficient_rows(), "version, model, name, score", {"score": "DOUBLE"})


@cte("adjustment_factors")
def _adj():
    return values(R.ADJUSTMENT_FACTORS, "version, model, normalization_factor, coding_pattern_adjustment")


@cte("version_weights")
def _vw():
    return values(R.VERSION_WEIGHTS, "version, weight")


@cte("pair_rules")
def _pair():
    return values(R.PAIR_RULES, "interaction_name, hcc1, hcc2, score")


@cte("group_rules")
def _grp():
    return values(R.GROUP_RULES, "interaction_name, primary_group, secondary_group, score")


@cte("chronic")
def _chronic():
    return values([(h, 1) for h in R.CHRONIC_HCC], "hcc, chronic")


@cte("time_periods")
def _tp():
    return values(R.time_period_rows(), "time_period, begin_date, end_date, period_type, risk_year")


@cte("method_rules")
def _mr():
    return values(R.METHOD_RULES, "method_id, program, claim_cd_type, claim_cd, modifier_type, "
                  "modifier_cd, cc_id, exclusion_type, exclusion_cd, qualified_claim",
                  {"modifier_type": "VARCHAR", "modifier_cd": "VARCHAR", "exclusion_type": "VARCHAR",
                   "exclusion_cd": "VARCHAR"})


@cte("method_rules_v24")
def _mr24():
    return values(R.METHOD_RULES_V24, "method_id, program, claim_cd_type, claim_cd, modifier_type, "
                  "modifier_cd, cc_id, exclusion_type, exclusion_cd, qualified_claim",
                  {"modifier_type": "VARCHAR", "modifier_cd": "VARCHAR", "exclusion_type": "VARCHAR",
                   "exclusion_cd": "VARCHAR"})


@cte("code_groups")
def _cg():
    return values(R.CODE_GROUPS, "claim_cd_type, group_cd, code")


@cte("method_frequency")
def _mf():
    return values(R.METHOD_FREQUENCY, "method_id, claim_cd_type, claim_cd, frequency, percent_weight")


@cte("method_default_weight")
def _mdw():
    return values(R.METHOD_DEFAULT_WEIGHT, "method_id, default_weight")


@cte("method_priority")
def _mp():
    return values(R.METHOD_PRIORITY, "method_id, priority")


@cte("prior_year")
def _py():
    return values(R.prior_year_rows(), "last_bound, freq_min, freq_max, weight", {"last_bound": "INTEGER"})


@cte("qualifying_procedures")
def _qp():
    lo, hi = R.QUALIFYING_PROC_RANGE
    b, e = R.QUALIFYING_PROC_VALID
    return values([(f"C{i:03d}", b, e) for i in range(lo, hi + 1)], "cpt_cd, valid_from, valid_to")


@cte("place_of_service")
def _pos():
    return values(R.PLACE_OF_SERVICE, "bill_prefix, place_of_service")


def q(names, steps, final: str) -> str:
    """Base CTEs ``names`` + query-local ``steps`` [(name, sql)] + final SELECT."""
    order: list[str] = []

    def add(n):
        if n in order:
            return
        for d in CTES[n][1]:
            add(d)
        order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in order]
    rest = [s for _, s in steps] + [final]
    for i, (n, s) in enumerate(steps):
        reads = sum(len(re.findall(rf"\b{n}\b", later)) for later in rest[i + 1:])
        parts.append(f"{n} AS {'MATERIALIZED ' if reads > 1 else ''}(\n{s}\n)")
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def typed(select_sql: str, bigint=(), double=()) -> str:
    """Wrap a SELECT so the named columns come out as BIGINT / DOUBLE."""
    reps = [f"CAST({c} AS BIGINT) AS {c}" for c in bigint] + [f"CAST({c} AS DOUBLE) AS {c}" for c in double]
    if not reps:
        return select_sql
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM ({select_sql}) _t"


@cte("plan_exclusions")
def _pe():
    return values(R.PLAN_EXCLUSIONS, "home_plan_id_cd, method_id, cc_id",
                  {"method_id": "INTEGER", "cc_id": "INTEGER"})


@cte("sas_model_versions")
def _sas():
    return values(R.SAS_MODEL_VERSIONS, "version, sas_model_version")


@cte("multiplier_rules")
def _mult():
    return values(R.MULTIPLIER_RULES, "hcc1, hcc2, multiplier")


@cte("models")
def _models():
    return values(R.MODELS, "model_id, family, map_set, hierarchy_set, coefficient_set, segments, scores_count")
