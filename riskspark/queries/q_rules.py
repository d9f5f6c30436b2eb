"""Registered projection / row-rule queries (§2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import base as B
from oracle import scoring as OS
from riskspark import functions as RF
from riskspark.operators import rules as OR
from riskspark.plans import scoring as S
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources.records import MAO_004, deal_codes
from riskspark.sources import reference as REF


@query("prj_ensure_columns", B.q(["claim_header"], [], """
SELECT claim_bid, allwd_amt, CAST('N' AS VARCHAR) AS qualify_claims,
       CAST(NULL AS VARCHAR) AS invalid_cpt_hcpcs FROM claim_header"""))
def prj_ensure_columns(spark, sf):
    h = Inputs(spark, sf).header().select("claim_bid", "allwd_amt")
    h = OR.ensure_columns(h, {"qualify_claims": "string", "allwd_amt": "double"}, "N")
    return OR.ensure_columns(h, {"invalid_cpt_hcpcs": "string"}, None)


@query("prj_pipeline", B.q(["claim_line"], [], """
SELECT claim_bid, CAST(clm_ln_num AS VARCHAR) AS line_no, diag_cd, line_amt AS amount,
       CAST(floor(line_amt / 10) AS BIGINT) AS fee
FROM claim_line WHERE clm_tp_cd = 3 AND line_amt > 1000"""))
def prj_pipeline(spark, sf):
    steps = [
        {"op": "filter", "expr": "clm_tp_cd = 3"},
        {"op": "filter", "expr": "line_amt > 1000"},
        {"op": "select", "cols": ["claim_bid", "clm_ln_num", "diag_cd", "line_amt"]},
        {"op": "rename", "map": {"line_amt": "amount", "clm_ln_num": "line_no"}},
        {"op": "cast", "map": {"line_no": "string"}},
        {"op": "derive", "map": {"fee": "floor(amount / 10)"}},
    ]
    return OR.apply_pipeline(Inputs(spark, sf).lines(), steps)


@query("prj_business_rules", B.q(["claim_header"], [], """
SELECT claim_bid, CASE WHEN allwd_amt > 300000 THEN 'HIGH'
                       WHEN clm_pmt_sts_cd = 'D' THEN 'DENIED'
                       WHEN clm_pmt_sts_cd = 'P' THEN 'PAID' ELSE NULL END AS claim_status
FROM claim_header"""))
def prj_business_rules(spark, sf):
    h = Inputs(spark, sf).header().select("claim_bid", "clm_pmt_sts_cd", "allwd_amt")
    rules = [("claim_status", "clm_pmt_sts_cd = 'P'", "PAID"),
             ("claim_status", "clm_pmt_sts_cd = 'D'", "DENIED"),
             ("claim_status", "allwd_amt > 300000", "HIGH")]
    return OR.apply_business_rules(h, rules).select("claim_bid", "claim_status")


@query("prj_derived_metrics", B.typed(B.q(["claim_line"], [], """
SELECT claim_bid, clm_ln_num, l_partkey, l_suppkey, line_amt / l_quantity AS unit_amt,
       line_amt > 50000 AS is_high, year(updated_dt) - risk_year AS lag_years
FROM claim_line"""), ["clm_ln_num", "lag_years"]))
def prj_derived_metrics(spark, sf):
    li = Inputs(spark, sf).lines()
    out = OR.derived_metrics(li, {"unit_amt": "line_amt / l_quantity",
                                  "is_high": "line_amt > 50000",
                                  "lag_years": "year(updated_dt) - risk_year"})
    return out.select("claim_bid", "clm_ln_num", "l_partkey", "l_suppkey", "unit_amt", "is_high", "lag_years")


@query("prj_flatten_struct", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
       CAST(year(ts) AS BIGINT) AS ts_year
FROM events""")
def prj_flatten_struct(spark, sf):
    e = Inputs(spark, sf).table("events")
    e = e.select("event_id", "event_type", F.from_json("props", "k bigint").alias("props"),
                 F.year("ts").alias("ts_year"))
    return OR.flatten_struct(e, ["props"])


@query("prj_regex_extract", """
SELECT p_partkey, p_name, regexp_extract(p_name, '^[a-z]+', 0) AS p_name_extracted,
       p_brand, regexp_extract(p_brand, '[0-9]+', 0) AS p_brand_extracted FROM part""")
def prj_regex_extract(spark, sf):
    p = Inputs(spark, sf).table("part").select("p_partkey", "p_name", "p_brand")
    return OR.regex_extract(p, {"p_name": "^[a-z]+", "p_brand": "[0-9]+"})


@query("prj_summary", B.q(OS.BASE, OS.SCORE_STEPS + OS.DETAIL_STEPS, B.typed("""
SELECT DISTINCT member_bid, risk_year, version, hcc, risk_type_detail_id, suppression_ind FROM detail""", ["risk_year", "hcc"])))
def prj_summary(spark, sf):
    """Claim-level detail rows without their claim columns, one row per member, version and category."""
    inp = Inputs(spark, sf)
    claim_diag = inp.claim_diag().select("member_bid", "risk_year", "claim_bid", "diag_cd").distinct()
    detail = S.hcc_detail(claim_diag, inp.population(), REF.icd_hcc(spark), inp.member_hcc())
    return OR.summary_dedupe(detail, ["claim_bid", "diag_cd"], ["member_bid", "risk_year", "version", "hcc"])


@query("prj_trim_keys", """
SELECT p_partkey, trim(p_name) AS p_name, trim(p_brand) AS p_brand, trim(p_type) AS p_type
FROM part WHERE length(trim(p_type)) > 0 AND length(trim(p_brand)) > 0""")
def prj_trim_keys(spark, sf):
    p = Inputs(spark, sf).table("part").select("p_partkey", "p_name", "p_brand", "p_type")
    return OR.trim_strings(p, ["p_type", "p_brand"])


@query("prj_icd_parts", B.q(["claim_line"], [], """
SELECT DISTINCT icd, CAST(length(replace(icd, '.', '')) AS BIGINT) AS code_length,
  substring(replace(icd, '.', ''), 1, 3) AS category3, contains(icd, '.') AS has_dot
FROM (SELECT CASE WHEN clm_ln_num % 2 = 0 THEN substring(diag_cd, 1, 3) || '.' || CAST(clm_ln_num AS VARCHAR)
             ELSE diag_cd END AS icd FROM claim_line)"""))
def prj_icd_parts(spark, sf):
    li = Inputs(spark, sf).lines()
    icd = F.when(F.col("clm_ln_num") % 2 == 0,
                 F.concat(F.substring("diag_cd", 1, 3), F.lit("."), F.col("clm_ln_num").cast("string"))) \
        .otherwise(F.col("diag_cd"))
    return OR.with_icd_parts(li.select(icd.alias("icd")), "icd").distinct()


@query("prj_claim_type_label", B.typed(B.q(["claim_header"], [], """
SELECT claim_bid, clm_tp_cd, CASE clm_tp_cd WHEN 1 THEN 'facility-inpatient' WHEN 2 THEN 'facility-outpatient'
  WHEN 3 THEN 'professional' WHEN 4 THEN 'pharmacy' END AS claim_type
FROM claim_header"""), ["clm_tp_cd"]))
def prj_claim_type_label(spark, sf):
    return OR.with_claim_type_label(Inputs(spark, sf).header().select("claim_bid", "clm_tp_cd"))


@query("prj_program_pos", B.q(["claim_header", "place_of_service"], [], """
SELECT h.claim_bid,
  CASE WHEN h.clm_tp_cd IN (1, 2) THEN 'FACILITY' WHEN h.clm_tp_cd = 3 THEN 'PROFESSIONAL' ELSE 'OTHER' END AS program,
  coalesce(CASE WHEN h.clm_tp_cd IN (1, 2) THEN p.place_of_service END, '11') AS place_of_service
FROM claim_header h LEFT JOIN place_of_service p ON p.bill_prefix = substring(h.tp_of_bill_cd, 1, 2)"""))
def prj_program_pos(spark, sf):
    h = Inputs(spark, sf).header().select("claim_bid", "clm_tp_cd", "tp_of_bill_cd")
    return OR.with_program_pos(h, REF.place_of_service(spark)).select("claim_bid", "program", "place_of_service")


_POP_INTS = ["risk_year", "age_yr", "disabl", "origds"]


@query("prj_origds", B.q(OS.BASE, OS.POP_STEPS, B.typed(
    "SELECT member_bid, risk_year, age_yr, orec, disabl, origds FROM pop", _POP_INTS)))
def prj_origds(spark, sf):
    return Inputs(spark, sf).population().select("member_bid", "risk_year", "age_yr", "orec", "disabl", "origds")


@query("prj_age_as_of", B.q(OS.BASE, OS.POP_STEPS, B.typed(
    "SELECT member_bid, risk_year, time_period, age_yr FROM pop", ["risk_year", "time_period", "age_yr"])))
def prj_age_as_of(spark, sf):
    return Inputs(spark, sf).population().select("member_bid", "risk_year", "time_period", "age_yr")


@query("prj_age_at_service", B.q(["claim_header", "member"], [], """
SELECT h.claim_bid, h.member_bid, CAST(trunc(datediff('day', m.memb_brth_dt, h.claim_dt) / 365.25) AS BIGINT) AS age_at_service
FROM claim_header h JOIN member m ON m.member_bid = h.member_bid"""))
def prj_age_at_service(spark, sf):
    inp = Inputs(spark, sf)
    j = inp.header().select("claim_bid", "member_bid", "claim_dt").join(
        inp.member().select("member_bid", "memb_brth_dt"), "member_bid")
    return j.select("claim_bid", "member_bid", RF.age_at_service("memb_brth_dt", "claim_dt").alias("age_at_service"))


@query("prj_sedits", B.q(OS.BASE, OS.POP_STEPS, B.typed(
    """SELECT member_bid, risk_year, version, diag_cd, hcc AS mapped_hcc, hcc2 AS edited_hcc
       FROM dsed WHERE hcc IS DISTINCT FROM hcc2""", ["risk_year", "mapped_hcc", "edited_hcc"])))
def prj_sedits(spark, sf):
    inp = Inputs(spark, sf)
    pop = inp.population()
    d = S.member_diagnoses(inp.lines()).join(
        pop.select("member_bid", "risk_year", "age_yr", "memb_gender_cd"), ["member_bid", "risk_year"])
    d = S.map_icd_to_hcc(S.with_versions(d), REF.icd_hcc(spark)).withColumn("mapped_hcc", F.col("hcc"))
    d = S.apply_sedits(d)
    return d.where(~F.col("mapped_hcc").eqNullSafe(F.col("hcc"))).select(
        "member_bid", "risk_year", "version", "diag_cd", "mapped_hcc", F.col("hcc").alias("edited_hcc"))


@query("prj_community_model", B.q(OS.BASE, OS.POP_STEPS, B.typed(
    "SELECT member_bid, risk_year, segment, age_yr, model_segment FROM pop", ["risk_year", "age_yr"])))
def prj_community_model(spark, sf):
    return Inputs(spark, sf).population().select("member_bid", "risk_year", "segment", "age_yr", "model_segment")


@query("prj_coeff_keys", B.q(OS.BASE, OS.POP_STEPS, B.typed("""
SELECT p.member_bid, p.risk_year, p.model_segment || '_' || p.memb_gender_cd || CAST(p.age_yr AS VARCHAR) AS demog_name,
  p.model_segment || '_OriginallyDisabled_' || CASE WHEN p.memb_gender_cd = 'F' THEN 'Female' ELSE 'Male' END AS origds_name,
  string_agg(DISTINCT mh.model_segment || '_HCC' || CAST(mh.hcc AS VARCHAR), ',' ORDER BY mh.model_segment || '_HCC' || CAST(mh.hcc AS VARCHAR)) AS hcc_names
FROM pop p JOIN mh ON mh.member_bid = p.member_bid AND mh.risk_year = p.risk_year AND mh.version = 'v28'
GROUP BY 1, 2, 3, 4""", ["risk_year"])))
def prj_coeff_keys(spark, sf):
    inp = Inputs(spark, sf)
    pop = inp.population()
    mh = inp.member_hcc().where(F.col("version") == "v28")
    names = mh.groupBy("member_bid", "risk_year").agg(
        F.array_join(F.array_sort(F.collect_set(RF.hcc_coeff_name("model_segment", "hcc"))), ",").alias("hcc_names"))
    return pop.join(names, ["member_bid", "risk_year"]).select(
        "member_bid", "risk_year",
        RF.demog_coeff_name("model_segment", "memb_gender_cd", "age_yr").alias("demog_name"),
        RF.origds_coeff_name("model_segment", "memb_gender_cd").alias("origds_name"), "hcc_names")


@query("prj_claim_dates_valid", B.q(["claim_header", "enrollment"], [], """
SELECT claim_bid, date_valid, CASE WHEN date_valid THEN 'VALID' ELSE 'OUT_OF_PERIOD' END AS date_status FROM (
  SELECT h.claim_bid, EXISTS (SELECT 1 FROM enrollment e WHERE e.member_bid = h.member_bid
    AND h.claim_dt BETWEEN e.covrg_begin_dt AND e.covrg_end_dt) AS date_valid FROM claim_header h)"""))
def prj_claim_dates_valid(spark, sf):
    inp = Inputs(spark, sf)
    return OR.claim_dates_valid(inp.header().select("claim_bid", "member_bid", "claim_dt"), inp.enrollment()).select(
        "claim_bid", "date_valid", "date_status")


@query("prj_period_filter", B.typed(B.q(["claim_header", "time_periods"], [], """
SELECT h.claim_bid, h.claim_dt, p.time_period, p.period_type
FROM claim_header h JOIN time_periods p ON h.claim_dt BETWEEN p.begin_date AND p.end_date"""), ["time_period"]))
def prj_period_filter(spark, sf):
    h = Inputs(spark, sf).header().select("claim_bid", "claim_dt")
    return OR.period_filter(h, REF.time_periods(spark), "claim_dt").select(
        "claim_bid", "claim_dt", "time_period", "period_type")


@query("prj_pseudo_claims", B.typed(B.q(["pharmacy"], [], """
SELECT claim_bid, member_bid, clm_ln_num, 5 AS clm_tp_cd, 'P' AS clm_pmt_sts_cd, CAST(NULL AS VARCHAR) AS tp_of_bill_cd,
  serv_dt AS first_serv_dt, serv_dt AS last_serv_dt, year(serv_dt) AS risk_year, 'SUPPLEMENTAL' AS dx_source, allwd_amt
FROM pharmacy"""), ["clm_ln_num", "clm_tp_cd", "risk_year"]))
def prj_pseudo_claims(spark, sf):
    return OR.pseudo_claims(Inputs(spark, sf).pharmacy())


@query("prj_mmr_status", """
SELECT 1100000000 + c_custkey AS member_bid,
  CASE WHEN lower(trim(CASE WHEN c_mktsegment = 'MACHINERY' THEN 'y' ELSE 'n' END)) IN ('y','yes','1','true','t') THEN 'Y' ELSE 'N' END AS institutional_status,
  CASE WHEN lower(trim(CAST(c_acctbal < 0 AS VARCHAR))) IN ('y','yes','1','true','t') THEN 'Y' ELSE 'N' END AS medicaid_status,
  CASE WHEN lower(trim(CASE WHEN c_custkey % 50 = 0 THEN 'Yes' ELSE 'No' END)) IN ('y','yes','1','true','t') THEN 'Y' ELSE 'N' END AS esrd_status
FROM customer""")
def prj_mmr_status(spark, sf):
    c = Inputs(spark, sf).table("customer")
    c = c.select((F.lit(1100000000) + F.col("c_custkey")).alias("member_bid"), "c_mktsegment", "c_acctbal", "c_custkey")
    flags = {"inst_flag": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'y' ELSE 'n' END",
             "mcaid_flag": "CAST(c_acctbal < 0 AS STRING)",
             "esrd_flag": "CASE WHEN c_custkey % 50 = 0 THEN 'Yes' ELSE 'No' END"}
    out = OR.mmr_status(c, flags, {"inst_flag": "institutional_status", "mcaid_flag": "medicaid_status",
                                   "esrd_flag": "esrd_status"})
    return out.select("member_bid", "institutional_status", "medicaid_status", "esrd_status")


@query("prj_qualify_inpatient", B.q(["claim_header"], [], """
SELECT claim_bid, CASE WHEN clm_tp_cd = 1 AND clm_pmt_sts_cd = 'P' AND substring(tp_of_bill_cd, 1, 2) IN ('11', '41')
  THEN 'Y' ELSE 'N' END AS qualify_claims FROM claim_header WHERE clm_tp_cd = 1"""))
def prj_qualify_inpatient(spark, sf):
    h = Inputs(spark, sf).header().where(F.col("clm_tp_cd") == 1)
    return h.select("claim_bid", OR.qualify_inpatient(h).alias("qualify_claims"))


@query("prj_qualify_outpatient", B.q(["claim_header", "enrollment"], [], """
SELECT h.claim_bid, CASE WHEN h.clm_tp_cd = 2 AND h.allwd_amt > 0 AND h.clm_pmt_sts_cd = 'P'
  AND substring(h.tp_of_bill_cd, 1, 2) IN ('13', '85') AND EXISTS (SELECT 1 FROM enrollment e WHERE e.member_bid = h.member_bid
    AND h.claim_dt BETWEEN e.covrg_begin_dt AND e.covrg_end_dt) THEN 'Y' ELSE 'N' END AS qualify_claims
FROM claim_header h WHERE h.clm_tp_cd = 2"""))
def prj_qualify_outpatient(spark, sf):
    inp = Inputs(spark, sf)
    h = OR.with_coverage(inp.header().where(F.col("clm_tp_cd") == 2), inp.enrollment())
    return h.select("claim_bid", OR.qualify_outpatient(h).alias("qualify_claims"))


@query("prj_enrollment_split", B.q(["enrollment"], [], B.typed("""
SELECT member_bid, risk_year, greatest(covrg_begin_dt, make_date(risk_year, 1, 1)) AS year_begin_dt,
  least(covrg_end_dt, make_date(risk_year, 12, 31)) AS year_end_dt
FROM (SELECT member_bid, covrg_begin_dt, covrg_end_dt, CAST(unnest(generate_series(
        year(covrg_begin_dt), CASE WHEN year(covrg_end_dt) = 9999 THEN greatest(year(covrg_begin_dt), 2001)
          ELSE year(covrg_end_dt) END)) AS INTEGER) AS risk_year FROM enrollment)""",
    ["risk_year"])))
def prj_enrollment_split(spark, sf):
    return S.enrollment_years(Inputs(spark, sf).enrollment()).select(
        "member_bid", "risk_year", "year_begin_dt", "year_end_dt")


LINE_ORDER = ["clm_ln_num", "updated_dt", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@query("prj_unpivot_mao", B.q(["claim_line"], [], f"""
SELECT claim_bid, member_bid, n // {MAO_004.pairs} + 1 AS record, n % {MAO_004.pairs} + 1 AS pos, diag_cd AS code, flag FROM (
  SELECT claim_bid, member_bid, diag_cd, CASE WHEN l_quantity > 25 THEN 'A' ELSE 'D' END AS flag,
    row_number() OVER (PARTITION BY claim_bid ORDER BY {', '.join(LINE_ORDER)}) - 1 AS n FROM claim_line)"""))
def prj_unpivot_mao(spark, sf):
    """Every claim line into the wide layout (38 code/flag pairs a record, the rest in further records) and back."""
    lines = Inputs(spark, sf).lines().withColumn("flag", F.when(F.col("l_quantity") > 25, "A").otherwise("D"))
    wide = deal_codes(lines, ["claim_bid", "member_bid"], "diag_cd", "flag", LINE_ORDER, MAO_004)
    return OR.unpivot_pairs(wide, ["claim_bid", "member_bid", "record"], MAO_004.code, MAO_004.flag, MAO_004.pairs)


@query("prj_member_cc_array", B.q(OS.BASE, OS.POP_STEPS, B.typed("""
SELECT member_bid, risk_year, string_agg(DISTINCT 'CC' || lpad(CAST(hcc AS VARCHAR), 3, '0'), ','
  ORDER BY 'CC' || lpad(CAST(hcc AS VARCHAR), 3, '0')) AS cc_codes
FROM mh GROUP BY 1, 2""", ["risk_year"])))
def prj_member_cc_array(spark, sf):
    mh = Inputs(spark, sf).member_hcc()
    # the stored form: a list of JSON-like text per member (v28 and v24 entries)
    stored = mh.groupBy("member_bid", "risk_year").agg(
        F.collect_list(F.concat(F.lit('{"DIAG":"x","HCC":"'), F.col("hcc").cast("string"), F.lit('"}'))).alias("hcc_json"))
    out = OR.cc_array_from_json(stored, "hcc_json")
    return out.select("member_bid", "risk_year", F.array_join("cc_codes", ",").alias("cc_codes"))


@query("prj_json_detail", B.q(OS.BASE, OS.POP_STEPS, B.typed("""
SELECT member_bid, risk_year, version, diag_cd, hcc2 AS hcc FROM dsed""", ["risk_year", "hcc"])))
def prj_json_detail(spark, sf):
    inp = Inputs(spark, sf)
    pop = inp.population()
    d = S.member_diagnoses(inp.lines()).join(
        pop.select("member_bid", "risk_year", "age_yr", "memb_gender_cd"), ["member_bid", "risk_year"])
    d = S.apply_sedits(S.map_icd_to_hcc(S.with_versions(d), REF.icd_hcc(spark)))
    # stored as JSON text per member-year-version, parsed back with a declared schema
    j = d.groupBy("member_bid", "risk_year", "version").agg(
        F.to_json(F.collect_list(F.struct("diag_cd", "hcc"))).alias("diag_to_hcc_json"))
    parsed = j.select("member_bid", "risk_year", "version",
                      F.explode(F.from_json("diag_to_hcc_json", "array<struct<diag_cd:string,hcc:int>>")).alias("e"))
    return parsed.select("member_bid", "risk_year", "version", "e.diag_cd", "e.hcc")


@query("prj_explode_hcc", B.q(OS.BASE, OS.POP_STEPS, B.typed("""
SELECT DISTINCT member_bid, risk_year, 'CC' || lpad(CAST(hcc AS VARCHAR), 3, '0') AS cc_code FROM mh""", ["risk_year"])))
def prj_explode_hcc(spark, sf):
    mh = Inputs(spark, sf).member_hcc()
    lists = mh.groupBy("member_bid", "risk_year").agg(F.array_sort(F.collect_set(RF.cc_code("hcc"))).alias("codes"))
    return OR.explode_codes(lists, "codes", "cc_code")
