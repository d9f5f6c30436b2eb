"""Registered source queries (§2.1).

File sources write data Spark derives from the driver tables to a new path
in the shared folder, then read it back with the declared schema; the oracle
is the same projection in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle import base as B
from oracle import scoring as OS
from riskspark.operators.joins import broadcast_if_small
from riskspark.plans import scoring as S
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.session import scratch_path
from riskspark.sources import files as FS
from riskspark.sources import records as RS
from riskspark.sources.records import MAO_004
from riskspark.sources import reference as REF

MEMBER_SCHEMA = T.StructType([
    T.StructField("member_bid", T.LongType()), T.StructField("home_plan_id_cd", T.StringType()),
    T.StructField("memb_brth_dt", T.DateType()), T.StructField("memb_gender_cd", T.StringType()),
    T.StructField("orec", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("contract_id", T.StringType())])


@query("src_csv", B.q(["member"], [], "SELECT * FROM member"))
def src_csv(spark, sf):
    m = Inputs(spark, sf).member()
    path = scratch_path(spark, "member_csv")
    m.write.option("header", True).csv(path)
    return FS.load_csv(spark, path, MEMBER_SCHEMA, ",", True)


@query("src_pipe_txt", B.q(["enrollment"], [], "SELECT member_bid, home_plan_id_cd, contract_id, covrg_begin_dt, covrg_end_dt FROM enrollment"))
def src_pipe_txt(spark, sf):
    """Pipe-delimited plan extract with ``yyyyMMdd`` dates, read as strings
    and cast in one select."""
    e = Inputs(spark, sf).enrollment()
    path = scratch_path(spark, "enrollment_txt")
    e.select("member_bid", "home_plan_id_cd", "contract_id", F.date_format("covrg_begin_dt", "yyyyMMdd").alias("b"),
             F.date_format("covrg_end_dt", "yyyyMMdd").alias("e")) \
        .write.option("header", True).option("sep", "|").csv(path)
    raw = FS.load_csv(spark, path, "member_bid string, home_plan_id_cd string, contract_id string, b string, e string", "|")
    return raw.select(F.col("member_bid").cast("bigint").alias("member_bid"), "home_plan_id_cd", "contract_id",
                      F.to_date("b", "yyyyMMdd").alias("covrg_begin_dt"), F.to_date("e", "yyyyMMdd").alias("covrg_end_dt"))


def _fixed_oracle():
    from riskspark.queries.q_claims import mao_line_sql
    return B.q([], [("enc", mao_line_sql())], B.typed(f"""
SELECT icn, allowed_flag, dos_from, dos_thru, member_bid, provider_type, n % {MAO_004.pairs} + 1 AS pos, code, flag FROM enc""", ["provider_type"]))


@query("src_fixed_width", _fixed_oracle())
def src_fixed_width(spark, sf):
    """The encounter feed as a fixed-width file (header, details of 38 code/flag
    pairs, trailer with the count), read back by the layout: one row a pair."""
    from riskspark.plans import claims as C
    inp = Inputs(spark, sf)
    records = C.mao_records(C.mao_lines(inp.table("lineitem"), inp.table("orders"), inp.most_rows()))
    path = scratch_path(spark, "mao_fixed")
    RS.write_records(records, path, MAO_004, {"report_id": F.lit("MAO004"), "contract_id": F.lit("H0001")})
    return C.mao_pairs(RS.read_records(spark, path, MAO_004))


@query("src_table", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000""")
def src_table(spark, sf):
    return FS.read_table(spark, f"{sf.rstrip('/')}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"],
                         ["o_orderstatus = 'F'", "o_totalprice > 1000"], mandatory=True).drop("o_orderstatus")


@query("src_shared_rename", B.typed("""SELECT c_custkey AS memb_id, c_name AS memb_name, c_nationkey AS home_plan_key,
  c_mktsegment AS status_segment FROM customer""", ["home_plan_key"]))
def src_shared_rename(spark, sf):
    c = Inputs(spark, sf).table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return FS.rename_columns(c, {"c_custkey": "memb_id", "c_name": "memb_name", "c_nationkey": "home_plan_key",
                                 "c_mktsegment": "status_segment"})


PART_REF = T.StructType([T.StructField("p_partkey", T.LongType(), False), T.StructField("p_name", T.StringType()),
                         T.StructField("p_retailprice", T.DoubleType())])


@query("src_ref_csv", "SELECT p_partkey, p_name, p_retailprice FROM part")
def src_ref_csv(spark, sf):
    """Reference CSV with upper-case headers and an extra column → target
    layout (case-insensitive match, extras ignored, typed, NOT NULL checked)."""
    p = Inputs(spark, sf).table("part")
    path = scratch_path(spark, "part_ref_csv")
    p.select(F.col("p_retailprice").alias("P_RETAILPRICE"), F.col("p_name").alias("P_Name"),
             F.col("p_partkey").alias("P_PARTKEY"), F.col("p_brand").alias("EXTRA_BRAND")) \
        .write.option("header", True).csv(path)
    raw = spark.read.option("header", True).csv(path)  # strings; header gives the names
    return FS.align_reference(raw, PART_REF, not_null=["p_partkey"])


@query("src_checkpoint", B.typed(B.q(["claim_header"], [], "SELECT claim_bid, member_bid, risk_year, allwd_amt FROM claim_header"),
                                 ["risk_year"]))
def src_checkpoint(spark, sf):
    from riskspark.operators.sinks import write_snapshot
    h = Inputs(spark, sf).header().select("claim_bid", "member_bid", "risk_year", "allwd_amt")
    return spark.read.parquet(write_snapshot(h, name="header_ckpt"))


EVENT_PROPS_YAML = """
k: integer   # bucket number
missing: string
"""


@query("src_schema_yaml", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events""")
def src_schema_yaml(spark, sf):
    schema = FS.schema_from_mapping(EVENT_PROPS_YAML)
    e = Inputs(spark, sf).table("events")
    return e.select("event_id", F.from_json("props", schema).alias("p")).select("event_id", "p.k", "p.missing")


@query("src_reference_set", B.q(["member", "claim_line", "icd_hcc", "hierarchy_pairs", "coefficients"], [], """
SELECT 'member' AS table_name, count(*) AS n_rows FROM member UNION ALL SELECT 'diagnosis', count(*) FROM claim_line WHERE clm_tp_cd IN (1, 2, 3)
UNION ALL SELECT 'icd_hcc', count(*) FROM icd_hcc WHERE version = 'v28'
UNION ALL SELECT 'hierarchy', count(*) FROM hierarchy_pairs WHERE version = 'v28'
UNION ALL SELECT 'coefficients', count(*) FROM coefficients WHERE version = 'v28'"""))
def src_reference_set(spark, sf):
    """The named input set (members, diagnoses, version-filtered config) as a
    dict of lazy frames; the query reports their sizes in one plan."""
    from riskspark.operators.sinks import union_all
    s = load_reference_set(Inputs(spark, sf), "v28")
    return union_all([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
                      for n, df in s.items()])


def load_reference_set(inp: Inputs, version: str) -> dict:
    sp = inp.spark
    v = F.col("version") == version
    return {"member": inp.member(), "diagnosis": inp.lines().where(F.col("clm_tp_cd").isin(1, 2, 3)),
            "icd_hcc": REF.icd_hcc(sp).where(v), "hierarchy": REF.hierarchy_pairs(sp).where(v),
            "coefficients": REF.coefficients(sp).where(v)}


@query("src_hierarchy", B.q(OS.BASE, OS.POP_STEPS, B.typed("""
SELECT h.parent, h.child, count(DISTINCT p.member_bid || '-' || p.risk_year) AS n_parent_member_years,
  count(DISTINCT CASE WHEN c.hcc IS NOT NULL THEN p.member_bid || '-' || p.risk_year END) AS n_both
FROM hierarchy_pairs h JOIN mh0 p ON p.version = 'v28' AND p.hcc = h.parent
LEFT JOIN mh0 c ON c.member_bid = p.member_bid AND c.risk_year = p.risk_year AND c.version = 'v28' AND c.hcc = h.child
WHERE h.version = 'v28' GROUP BY 1, 2""", ["parent", "child"])))
def src_hierarchy(spark, sf):
    """Parent/child rules of one model (filter), with how often each rule
    applies in the data (member-years with the parent; with both)."""
    inp = Inputs(spark, sf)
    pop = inp.population()
    d = S.member_diagnoses(inp.lines()).join(pop.select("member_bid", "risk_year", "age_yr", "memb_gender_cd"),
                                             ["member_bid", "risk_year"]).withColumn("version", F.lit("v28"))
    d = S.apply_sedits(S.map_icd_to_hcc(d, REF.icd_hcc(spark)))
    codes = d.where(F.col("hcc").isNotNull() & (F.col("hcc") != -1)).select("member_bid", "risk_year", "hcc").distinct()
    h = REF.hierarchy_pairs(spark).where(F.col("version") == "v28").select("parent", "child")
    p = codes.withColumnRenamed("hcc", "parent").join(broadcast_if_small(h), "parent")
    c = codes.select("member_bid", "risk_year", F.col("hcc").alias("child"), F.lit(1).alias("_c"))
    j = p.join(c, ["member_bid", "risk_year", "child"], "left")
    my = F.concat_ws("-", F.col("member_bid").cast("string"), F.col("risk_year").cast("string"))
    return j.groupBy("parent", "child").agg(F.countDistinct(my).alias("n_parent_member_years"),
                                            F.countDistinct(F.when(F.col("_c") == 1, my)).alias("n_both"))


@query("src_plan_descriptions", """SELECT DISTINCT lpad(CAST(n.n_nationkey AS VARCHAR), 3, '0') AS plan_id, n.n_name AS plan_description
FROM nation n WHERE n.n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""")
def src_plan_descriptions(spark, sf):
    """Plan ids (here: plans of members in one segment) → distinct
    descriptions, as a semi join rather than an IN-list text."""
    inp = Inputs(spark, sf)
    ids = inp.table("customer").where(F.col("c_mktsegment") == "AUTOMOBILE").select(F.col("c_nationkey").alias("n_nationkey"))
    n = inp.table("nation").join(ids, "n_nationkey", "left_semi")
    return n.select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("plan_id"),
                    F.col("n_name").alias("plan_description")).distinct()


@query("src_latest_slice", B.typed(B.q(["claim_line"], [], """SELECT l.claim_bid, l.clm_ln_num, l.clm_tp_cd, l.source_load_month, l.updated_dt
FROM claim_line l JOIN (SELECT clm_tp_cd, max(updated_dt) AS mc FROM claim_line
    WHERE source_load_month = (SELECT max(source_load_month) FROM claim_line) GROUP BY 1) m
  ON m.clm_tp_cd = l.clm_tp_cd AND m.mc = l.updated_dt
WHERE l.source_load_month = (SELECT max(source_load_month) FROM claim_line)"""), ["clm_ln_num", "clm_tp_cd"]))
def src_latest_slice(spark, sf):
    li = Inputs(spark, sf).lines().select("claim_bid", "clm_ln_num", "clm_tp_cd", "source_load_month", "updated_dt")
    return FS.latest_slice(li, "source_load_month", "updated_dt", "clm_tp_cd").select(
        "claim_bid", "clm_ln_num", "clm_tp_cd", "source_load_month", "updated_dt")


PLANS, CONTRACTS, MONTHS = " 001, 002 ,007,", "H0001,H0002, H0003", "1998_01, 1998_02,1998_03"


@query("src_plan_contract", B.q(["claim_line", "member"], [], """SELECT l.member_bid, l.claim_bid, l.diag_cd, l.source_load_month
FROM claim_line l JOIN member m ON m.member_bid = l.member_bid
WHERE m.home_plan_id_cd IN ('001', '002', '007') AND m.contract_id IN ('H0001', 'H0002', 'H0003')
  AND l.source_load_month IN ('1998_01', '1998_02', '1998_03')"""))
def src_plan_contract(spark, sf):
    """Members and diagnoses filtered by plan, contract and month lists given
    as comma text (split and trimmed once, then ``isin``)."""
    inp = Inputs(spark, sf)
    m = inp.member().where(F.col("home_plan_id_cd").isin(*FS.parse_list(PLANS))
                           & F.col("contract_id").isin(*FS.parse_list(CONTRACTS))).select("member_bid")
    li = inp.lines().where(F.col("source_load_month").isin(*FS.parse_list(MONTHS)))
    return li.join(m, "member_bid", "left_semi").select("member_bid", "claim_bid", "diag_cd", "source_load_month")


RISK_YEAR, N_YEARS = 2001, 7


@query("src_medical_professional", B.typed(B.q(["claim_line"], [], f"""SELECT DISTINCT member_bid, claim_bid, risk_year, diag_cd,
  updated_dt AS claim_date FROM claim_line WHERE clm_tp_cd = 3 AND risk_year BETWEEN {RISK_YEAR - N_YEARS + 1} AND {RISK_YEAR}"""),
    ["risk_year"]))
def src_medical_professional(spark, sf):
    li = Inputs(spark, sf).lines()
    return li.where((F.col("clm_tp_cd") == 3) & F.col("risk_year").between(RISK_YEAR - N_YEARS + 1, RISK_YEAR)).select(
        "member_bid", "claim_bid", "risk_year", "diag_cd", F.col("updated_dt").alias("claim_date")).distinct()


@query("src_medical_facility", B.typed(B.q(["claim_line"], [("pp", """SELECT claim_bid, arg_min(cpt_cd, (clm_ln_num, cpt_cd)) AS princ_proc_cd
  FROM claim_line GROUP BY 1""")], f"""SELECT DISTINCT l.member_bid, l.claim_bid, l.risk_year, l.diag_cd, l.claim_dt AS claim_date, pp.princ_proc_cd
FROM claim_line l JOIN pp ON pp.claim_bid = l.claim_bid
WHERE l.clm_tp_cd IN (1, 2) AND l.risk_year BETWEEN {RISK_YEAR - N_YEARS + 1} AND {RISK_YEAR}"""), ["risk_year"]))
def src_medical_facility(spark, sf):
    """Facility lines ⋈ diagnoses ⋈ header, statement-through date as the claim
    date, principal procedure = the procedure of the lowest line."""
    li = Inputs(spark, sf).lines()
    pp = li.groupBy("claim_bid").agg(F.min(F.struct("clm_ln_num", "cpt_cd"))["cpt_cd"].alias("princ_proc_cd"))
    f = li.where(F.col("clm_tp_cd").isin(1, 2) & F.col("risk_year").between(RISK_YEAR - N_YEARS + 1, RISK_YEAR))
    return f.join(pp, "claim_bid").select("member_bid", "claim_bid", "risk_year", "diag_cd",
                                          F.col("claim_dt").alias("claim_date"), "princ_proc_cd").distinct()


@query("src_pharmacy", B.q(["pharmacy"], [], f"""SELECT member_bid, claim_bid, prod_serv_id_cd, serv_dt FROM pharmacy
WHERE member_bid > 0 AND year(serv_dt) BETWEEN {RISK_YEAR - N_YEARS + 1} AND {RISK_YEAR}"""))
def src_pharmacy(spark, sf):
    p = Inputs(spark, sf).pharmacy()
    # a date range (not year(...)) so the bound is pushed into the Parquet scan
    lo, hi = F.make_date(F.lit(RISK_YEAR - N_YEARS + 1), F.lit(1), F.lit(1)), F.make_date(F.lit(RISK_YEAR), F.lit(12), F.lit(31))
    return p.where((F.col("member_bid") > 0) & F.col("serv_dt").between(lo, hi)).select(
        "member_bid", "claim_bid", "prod_serv_id_cd", "serv_dt")


@query("src_time_period", B.typed(B.q(["claim_header", "time_periods"], [], f"""SELECT tp.time_period, count(h.claim_bid) AS n_claims
FROM time_periods tp LEFT JOIN claim_header h ON h.claim_dt BETWEEN tp.begin_date AND tp.end_date
WHERE tp.period_type = 'C' AND year(tp.begin_date) >= {RISK_YEAR - N_YEARS + 1} AND year(tp.end_date) <= {RISK_YEAR}
GROUP BY 1"""), ["time_period"]))
def src_time_period(spark, sf):
    """Calendar periods fully inside the year range, kept as a (broadcast)
    relation and joined — never collected into an IN-list."""
    from riskspark.operators.rules import period_filter
    tp = REF.time_periods(spark).where((F.col("period_type") == "C") & (F.year("begin_date") >= RISK_YEAR - N_YEARS + 1)
                                       & (F.year("end_date") <= RISK_YEAR))
    h = Inputs(spark, sf).header().select("claim_bid", "claim_dt")
    hits = period_filter(h, tp, "claim_dt").groupBy("time_period").agg(F.count("claim_bid").alias("n_claims"))
    return tp.select("time_period").join(hits, "time_period", "left").select(
        "time_period", F.coalesce("n_claims", F.lit(0)).alias("n_claims"))


@query("src_member_output", B.q(OS.BASE, OS.SCORE_STEPS, B.typed("""SELECT s.member_bid, s.version, s.time_period, tp.period_type,
  CAST(year(tp.begin_date) AS INTEGER) AS risk_year, s.raw_score
FROM scores s JOIN time_periods tp ON tp.time_period = s.time_period AND tp.period_type = 'C'
WHERE s.risk_year = year(tp.begin_date)""", ["time_period", "risk_year"])))
def src_member_output(spark, sf):
    s = Inputs(spark, sf).scores().select("member_bid", "version", "time_period", "risk_year", "raw_score")
    tp = REF.time_periods(spark).where(F.col("period_type") == "C").select(
        "time_period", "period_type", F.year("begin_date").alias("_y"))
    return s.join(broadcast_if_small(tp), "time_period").where(F.col("risk_year") == F.col("_y")).select(
        "member_bid", "version", "time_period", "period_type", "risk_year", "raw_score")


STANDARD = {"claim_bid": "bigint", "member_bid": "bigint", "clm_tp_cd": "int", "claim_dt": "date", "diag_cd": "string",
            "cpt_cd": "string", "prod_serv_id_cd": "string", "qualify_claims": "string"}


@query("src_claims_base", B.typed(B.q(["claim_line", "pharmacy"], [], """
SELECT claim_bid, member_bid, clm_tp_cd, claim_dt, diag_cd, cpt_cd, CAST(NULL AS VARCHAR) AS prod_serv_id_cd,
  CAST(NULL AS VARCHAR) AS qualify_claims FROM claim_line WHERE source_load_month >= '1996_01'
UNION ALL SELECT claim_bid, member_bid, 4, serv_dt, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), prod_serv_id_cd,
  CAST(NULL AS VARCHAR) FROM pharmacy WHERE year(serv_dt) >= 1996"""), ["clm_tp_cd"]))
def src_claims_base(spark, sf):
    """Several claim tables filtered by month/year, unioned by name, missing
    standard columns added — no per-table count."""
    inp = Inputs(spark, sf)
    med = inp.lines().where(F.col("source_load_month") >= "1996_01").select(
        "claim_bid", "member_bid", "clm_tp_cd", "claim_dt", "diag_cd", "cpt_cd")
    ph = inp.pharmacy().where(F.col("serv_dt") >= F.lit("1996-01-01").cast("date")).select(
        "claim_bid", "member_bid", F.lit(4).alias("clm_tp_cd"), F.col("serv_dt").alias("claim_dt"), "prod_serv_id_cd")
    return FS.union_claims([med, ph], STANDARD).select(*STANDARD.keys())


@query("src_rows", B.q(["claim_line"], [("sl", """SELECT * FROM (VALUES ('SEDITS_DIAG1', 'D001'), ('SEDITS_DIAG2', 'D002'),
  ('SEDITS_DIAG2', 'D003'), ('SEDITS_DIAG3', 'D004'), ('SEDITS_DIAG4', 'D005'), ('SEDITS_DIAG5', 'D006')) t(list_name, diag_cd)""")],
    """SELECT sl.list_name, count(l.claim_bid) AS n_lines FROM sl LEFT JOIN claim_line l ON l.diag_cd = sl.diag_cd GROUP BY 1"""))
def src_rows(spark, sf):
    """A rule table built from literal rows + schema, joined to the claims:
    lines per sex/age-edit list."""
    from riskspark.sources import reference_data as R
    rows = REF.create_dataframe(spark, "list_name string, diag_cd string", R.SEDITS_LISTS)
    li = Inputs(spark, sf).lines().select("claim_bid", "diag_cd")
    return rows.join(li, "diag_cd", "left").groupBy("list_name").agg(F.count("claim_bid").alias("n_lines"))
