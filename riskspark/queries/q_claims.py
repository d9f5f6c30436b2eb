"""Registered claim-preparation queries (§2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle import base as B
from oracle import gaps as OG
from riskspark.operators import rules as OR
from riskspark.operators import sinks as SK
from riskspark.operators.joins import broadcast_if_small
from riskspark.operators.master import merge_sources
from riskspark.operators.snapshots import Snapshot, key_range
from riskspark.plans import claims as C
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.session import scratch_path
from riskspark.sources import reference as REF
from riskspark.sources import reference_data as R

_QBASE = ["claim_line", "claim_header", "enrollment", "qualifying_procedures", "place_of_service"]


def _q(final, ints=(), steps=()):
    return B.q(_QBASE, OG.QUAL_STEPS + list(steps), B.typed(final, list(ints)))


_LINE_Q = [("lq", """SELECT l.claim_bid, l.clm_ln_num, l.l_partkey, l.l_suppkey, l.l_quantity, l.clm_tp_cd, l.cpt_cd,
    hr.header_ok, CASE WHEN q.cpt_cd IS NOT NULL THEN 1 ELSE 0 END AS line_eligible
  FROM claim_line l JOIN hr ON hr.claim_bid = l.claim_bid
  LEFT JOIN qualifying_procedures q ON q.cpt_cd = l.cpt_cd AND l.claim_dt BETWEEN q.valid_from AND q.valid_to"""),
    ("lq2", """SELECT *, CASE WHEN header_ok = 'Y' AND (clm_tp_cd = 1 OR max(line_eligible) OVER (PARTITION BY claim_bid) = 1)
      THEN 'Y' ELSE 'N' END AS qualify_claims,
      CASE WHEN line_eligible = 1 THEN 'N' ELSE 'Y' END AS invalid_cpt_hcpcs FROM lq""")]
_LQ_COLS = "claim_bid, clm_ln_num, l_partkey, l_suppkey, l_quantity, clm_tp_cd, cpt_cd, header_ok, qualify_claims, invalid_cpt_hcpcs"


def _qualified(inp: Inputs, types):
    h = C.header_rule(inp.header(), inp.enrollment()).select("claim_bid", "header_ok")
    li = inp.lines().select("claim_bid", "clm_ln_num", "l_partkey", "l_suppkey", "l_quantity", "clm_tp_cd",
                            "cpt_cd", "claim_dt", "updated_dt", "tp_of_bill_cd", "l_extendedprice").join(h, "claim_bid")
    return C.qualify_claims(li, REF.qualifying_procedures(inp.spark), types)


@query("clm_qualify_facility", _q(f"SELECT {_LQ_COLS} FROM lq2 WHERE clm_tp_cd IN (1, 2)", ["clm_ln_num", "clm_tp_cd"], _LINE_Q))
def clm_qualify_facility(spark, sf):
    return _qualified(Inputs(spark, sf), (1, 2)).select(*_LQ_COLS.split(", "))


@query("clm_qualify_professional", _q(f"SELECT {_LQ_COLS} FROM lq2 WHERE clm_tp_cd = 3", ["clm_ln_num", "clm_tp_cd"], _LINE_Q))
def clm_qualify_professional(spark, sf):
    return _qualified(Inputs(spark, sf), (3,)).select(*_LQ_COLS.split(", "))


@query("clm_medical_claims", _q(f"""
SELECT claim_bid, clm_ln_num, clm_tp_cd, cpt_cd, qualify_claims, invalid_cpt_hcpcs, visit_type, place_of_service, updated_dt
FROM (SELECT x.*, row_number() OVER (PARTITION BY claim_bid, clm_ln_num, clm_tp_cd ORDER BY updated_dt DESC, l_partkey DESC,
        l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, cpt_cd DESC) AS rn
  FROM (SELECT l.claim_bid, l.clm_ln_num, l.clm_tp_cd, l.cpt_cd, q.qualify_claims, q.invalid_cpt_hcpcs, l.updated_dt,
      l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity,
      CASE WHEN v.cpt_cd IS NOT NULL THEN '{R.VISIT_TYPE_MATCHED}' ELSE '{R.VISIT_TYPE_OTHER}' END AS visit_type,
      CASE WHEN l.clm_tp_cd IN (1, 2) THEN p.place_of_service END AS place_of_service
    FROM claim_line l JOIN lq2 q ON q.claim_bid = l.claim_bid AND q.clm_ln_num = l.clm_ln_num AND q.l_partkey = l.l_partkey
      AND q.l_suppkey = l.l_suppkey AND q.l_quantity = l.l_quantity
    LEFT JOIN qualifying_procedures v ON v.cpt_cd = l.cpt_cd
      AND (CASE WHEN l.clm_tp_cd IN (1, 2) THEN l.claim_dt ELSE l.updated_dt END) BETWEEN v.valid_from AND v.valid_to
    LEFT JOIN place_of_service p ON p.bill_prefix = substring(l.tp_of_bill_cd, 1, 2)) x) WHERE rn = 1""",
    ["clm_ln_num", "clm_tp_cd"], _LINE_Q))
def clm_medical_claims(spark, sf):
    inp = Inputs(spark, sf)
    procs = REF.qualifying_procedures(spark)
    u = C.with_visit_type(_qualified(inp, (1, 2, 3)), procs)  # facility and professional in one pass
    pos = REF.place_of_service(spark)
    u = u.join(broadcast_if_small(pos), F.substring(u["tp_of_bill_cd"], 1, 2) == pos["bill_prefix"], "left") \
        .withColumn("place_of_service", F.when(F.col("clm_tp_cd").isin(1, 2), F.col("place_of_service")))
    latest = C.latest_per_key(u, ["claim_bid", "clm_ln_num", "clm_tp_cd"],
                              ["updated_dt", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "cpt_cd"])
    rows = latest.select("claim_bid", "clm_ln_num", "clm_tp_cd", "cpt_cd", "qualify_claims", "invalid_cpt_hcpcs",
                         "visit_type", "place_of_service", "updated_dt", "claim_dt")
    month = F.date_format("claim_dt", "yyyy-MM")  # a claim's month never changes
    return _two_loads(rows, "medical-claims", ["claim_bid", "clm_ln_num", "clm_tp_cd"], month, F.col("claim_dt"), CUTOFF).drop("claim_dt")


CUTOFF, OVERLAP_DAYS = "1998-07-01", 90


def _two_loads(rows, name: str, keys, part, date, cutoff: str):
    """The table after two loads: rows dated before the cutoff, then those from 90 days
    before it on, which rewrite the partitions they touch and leave the others' files."""
    spark = rows.sparkSession
    snap = Snapshot(scratch_path(spark, name), tuple(keys), part)
    day = F.lit(cutoff).cast("date")
    snap.load(rows.where(date < day))
    snap.load(rows.where(date >= F.date_sub(day, OVERLAP_DAYS)))
    return snap.read(spark).select(*rows.columns)


@query("clm_risk_member", """
SELECT 1100000000 + c.c_custkey AS member_bid, lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') AS home_plan_id_cd,
  'H' || lpad(CAST(c.c_nationkey % 5 AS VARCHAR), 4, '0') AS contract_id,
  CAST(DATE '1910-01-01' + CAST((c.c_custkey * 2917) % 31000 AS INTEGER) AS DATE) AS memb_brth_dt,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS memb_gender_cd, CAST(c.c_custkey % 3 AS VARCHAR) AS orec,
  CAST(DATE '1995-01-01' + CAST(c.c_custkey % 400 AS INTEGER) AS DATE) AS covrg_begin_dt,
  CASE WHEN c.c_custkey % 10 = 0 THEN DATE '9999-12-31' ELSE CAST(DATE '1997-12-31' + CAST((c.c_custkey * 13) % 1300 AS INTEGER) AS DATE) END AS covrg_end_dt,
  CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'Y' ELSE 'N' END AS institutional_status,
  CASE WHEN c.c_acctbal < 0 THEN 'Y' ELSE 'N' END AS medicaid_status
FROM customer c""")
def clm_risk_member(spark, sf):
    inp = Inputs(spark, sf)
    mmr = inp.table("customer").select((F.lit(1100000000) + F.col("c_custkey")).alias("member_bid"),
                                       "c_mktsegment", "c_acctbal")
    mmr = OR.mmr_status(mmr, {"inst": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'y' ELSE 'n' END",
                              "mcaid": "CAST(c_acctbal < 0 AS STRING)"},
                        {"inst": "institutional_status", "mcaid": "medicaid_status"})
    m = inp.member().join(inp.enrollment().select("member_bid", "covrg_begin_dt", "covrg_end_dt"), "member_bid") \
        .join(mmr.select("member_bid", "institutional_status", "medicaid_status"), "member_bid")
    m = C.latest_per_key(m, ["member_bid"], ["covrg_end_dt", "covrg_begin_dt"])
    rows = m.select("member_bid", "home_plan_id_cd", "contract_id", "memb_brth_dt", "memb_gender_cd", "orec",
                    "covrg_begin_dt", "covrg_end_dt", "institutional_status", "medicaid_status")
    return _two_loads(rows, "risk-member", ["member_bid"], key_range("member_bid", 100_000), F.col("covrg_begin_dt"), "1995-10-01")


def mao_line_sql() -> str:
    """The encounter feed, one row a coded diagnosis, numbered within its encounter."""
    return """SELECT *, row_number() OVER (PARTITION BY icn ORDER BY l_linenumber, dos, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS n,
    min(dos) OVER (PARTITION BY icn) AS dos_from, max(dos) OVER (PARTITION BY icn) AS dos_thru FROM (
  SELECT 'E' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_suppkey % 3 AS VARCHAR) AS icn, 1100000000 + o.o_custkey AS member_bid,
    CAST(1 + l.l_suppkey % 3 AS INTEGER) AS provider_type, CASE WHEN l.l_orderkey % 10 = 0 THEN 'D' ELSE 'A' END AS allowed_flag,
    'D' || lpad(CAST((l.l_partkey + 7 * (l.l_linenumber % 2)) % 40 AS VARCHAR), 3, '0') AS code,
    CASE WHEN l.l_quantity > 10 THEN 'A' ELSE 'D' END AS flag, CAST(l.l_shipdate AS DATE) AS dos,
    l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""


_MAO = [("enc", mao_line_sql()),
        ("span", """SELECT claim_bid, member_bid, clm_tp_cd AS provider_type, min(updated_dt) AS first_dt, max(updated_dt) AS last_dt
          FROM claim_line GROUP BY claim_bid, member_bid, clm_tp_cd"""),
        ("mm", """SELECT e.icn, e.member_bid, e.provider_type, e.dos_thru, c.claim_bid, c.first_dt, c.last_dt
          FROM (SELECT DISTINCT icn, member_bid, provider_type, dos_thru FROM enc WHERE allowed_flag = 'A') e
          JOIN span c ON c.member_bid = e.member_bid AND c.provider_type = e.provider_type AND c.first_dt <= e.dos_thru AND c.last_dt >= e.dos_thru"""),
        ("pseudo", f"""SELECT d.icn, d.member_bid, 5 AS clm_tp_cd, d.dos_thru AS claim_dt, CAST(year(d.dos_thru) AS INTEGER) AS risk_year,
          d.code AS diag_cd, CASE WHEN EXISTS (SELECT 1 FROM mm WHERE mm.icn = d.icn) THEN '{C.VISIT_PROVIDER}' ELSE '{C.VISIT_HOME}' END AS encounter_type,
          'Pseudo claim' AS dx_source FROM (SELECT DISTINCT icn, member_bid, dos_thru, code FROM enc WHERE allowed_flag = 'A' AND flag = 'A') d
          WHERE NOT EXISTS (SELECT 1 FROM mm JOIN claim_line l ON l.claim_bid = mm.claim_bid WHERE mm.icn = d.icn AND l.diag_cd = d.code)""")]


def _mao(inp: Inputs):
    """The encounter feed as pairs (``src_fixed_width`` and ``prj_unpivot_mao`` run the wide layout), the claims' service dates."""
    return SK.checkpoint(C.line_pairs(C.mao_lines(inp.table("lineitem"), inp.table("orders"))), "mao-pairs"), C.claim_spans(inp.lines())


def mao_matches(inp: Inputs):
    return C.mao_matches(*_mao(inp))


def _pseudo(inp: Inputs):
    pairs, spans = _mao(inp)
    return C.pseudo_claims(pairs, SK.checkpoint(spans, "claim-spans"))


@query("clm_pseudo_claims", B.q(["claim_header", "claim_line"], _MAO, B.typed("SELECT * FROM pseudo", ["clm_tp_cd", "risk_year"])))
def clm_pseudo_claims(spark, sf):
    return _pseudo(Inputs(spark, sf))


@query("clm_risk_member_diag", B.q(["claim_header", "claim_line", "time_periods"], _MAO + [
    ("alld", """SELECT member_bid, CAST(claim_bid AS VARCHAR) AS claim_ref, clm_tp_cd, claim_dt, diag_cd, 'CLAIM' AS dx_source
      FROM claim_line WHERE clm_tp_cd IN (1, 2, 3)
      UNION ALL SELECT member_bid, icn, clm_tp_cd, claim_dt, diag_cd, dx_source FROM pseudo""")],
    B.typed("""SELECT DISTINCT a.member_bid, a.claim_ref, a.clm_tp_cd, a.claim_dt, a.diag_cd, a.dx_source, tp.time_period
FROM alld a JOIN time_periods tp ON tp.period_type = 'C' AND a.claim_dt BETWEEN tp.begin_date AND tp.end_date""",
            ["clm_tp_cd", "time_period"])))
def clm_risk_member_diag(spark, sf):
    inp = Inputs(spark, sf)
    claims = inp.lines().where(F.col("clm_tp_cd").isin(1, 2, 3)).select(
        "member_bid", F.col("claim_bid").cast("string").alias("claim_ref"), "clm_tp_cd", "claim_dt", "diag_cd",
        F.lit("CLAIM").alias("dx_source"))
    ps = _pseudo(inp).select("member_bid", F.col("icn").alias("claim_ref"), "clm_tp_cd", "claim_dt", "diag_cd", "dx_source")
    periods = REF.time_periods(spark).where(F.col("period_type") == "C")
    u = OR.period_filter(claims.unionByName(ps), periods, "claim_dt")
    rows = u.select("member_bid", "claim_ref", "clm_tp_cd", "claim_dt", "diag_cd", "dx_source", "time_period").distinct()
    return _two_loads(rows, "risk-member-diag", ["claim_ref", "diag_cd", "dx_source"], F.date_format("claim_dt", "yyyy-MM"), F.col("claim_dt"), CUTOFF)


def _merged_sql(parts: list[str], keys: str, attributes: list[str], names: list[str]) -> str:
    """The first source that has it, per attribute, over numbered source SELECTs."""
    rows = " UNION ALL ".join(f"SELECT {i} AS rk, * FROM ({q})" for i, q in enumerate(parts))
    def best(a: str) -> str:
        return f"min(lpad(CAST(rk AS VARCHAR), 2, '0') || trim({a})) FILTER (coalesce(trim({a}), '') <> '')"
    k = keys.split(", ")
    cols = ", ".join(f"substring({best(a)}, 3) AS {a}" for a in attributes)
    first = "CASE min(rk) " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"
    blank = " AND ".join(f"coalesce(trim({c}), '') <> ''" for c in k)
    return (f"SELECT {', '.join(f'trim({c}) AS {c}' for c in k)}, {cols}, {first} AS first_source, count(DISTINCT rk) AS n_sources "
            f"FROM ({rows}) WHERE {blank} GROUP BY {', '.join(f'trim({c})' for c in k)}")


_L = "(SELECT l.*, m.home_plan_id_cd FROM claim_line l JOIN member m ON m.member_bid = l.member_bid)"
_RX = "(SELECT p.*, m.home_plan_id_cd FROM pharmacy p JOIN member m ON m.member_bid = p.member_bid)"
PROVIDER_SOURCES = ["facility", "professional", "lab", "quality_events", "rx_prescriber", "rx_pharmacy", "rx_pcp"]


@query("clm_providers", B.q(["claim_line", "member", "pharmacy"], [], _merged_sql([
    f"SELECT home_plan_id_cd, ' S' || CAST(l_suppkey AS VARCHAR) AS prov_id_cd, NULL AS prov_name, 'BILL' || substring(tp_of_bill_cd, 1, 2) AS specialty FROM {_L} WHERE clm_tp_cd IN (1, 2)",
    f"SELECT home_plan_id_cd, 'S' || CAST(l_suppkey AS VARCHAR) || ' ', s_name, NULL FROM {_L} JOIN supplier ON s_suppkey = l_suppkey WHERE clm_tp_cd = 3",
    f"SELECT home_plan_id_cd, 'S' || CAST(l_partkey % 100 + 1 AS VARCHAR), NULL, 'LAB' FROM {_L} WHERE cpt_cd IN ('C050', 'C051')",
    f"SELECT home_plan_id_cd, CASE WHEN l_quantity > 49 THEN '' ELSE 'S' || CAST(l_suppkey AS VARCHAR) END, '', 'QUALITY' FROM {_L} WHERE l_quantity > 45",
    f"SELECT home_plan_id_cd, 'S' || CAST(l_partkey % 100 + 1 AS VARCHAR), 'RX ' || CAST(l_partkey % 100 + 1 AS VARCHAR), 'PRESCRIBER' FROM {_RX}",
    f"SELECT home_plan_id_cd, 'F' || CAST(l_partkey % 50 AS VARCHAR), NULL, 'PHARMACY' FROM {_RX}",
    f"SELECT home_plan_id_cd, 'S' || CAST(l_partkey % 70 + 1 AS VARCHAR), NULL, 'PCP' FROM {_RX}"],
    "home_plan_id_cd, prov_id_cd", ["prov_name", "specialty"], PROVIDER_SOURCES)))
def clm_providers(spark, sf):
    """Master provider list of seven sources, by plan and provider id."""
    inp = Inputs(spark, sf)
    plan = inp.member().select("member_bid", "home_plan_id_cd")
    li, rx = inp.lines().join(plan, "member_bid"), inp.pharmacy().join(plan, "member_bid")
    sup = inp.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("prov_name"))

    def src(df, prov, name=None, specialty=None):
        return df.select("home_plan_id_cd", prov.alias("prov_id_cd"), F.lit(name).cast("string").alias("prov_name"), F.lit(specialty).cast("string").alias("specialty"))

    def s(n):
        return F.concat(F.lit("S"), n.cast("string"))
    supp, part = F.col("l_suppkey"), F.col("l_partkey")
    frames = [
        src(li.where(F.col("clm_tp_cd").isin(1, 2)), F.concat(F.lit(" "), s(supp)), None, F.concat(F.lit("BILL"), F.substring("tp_of_bill_cd", 1, 2))),
        src(li.where(F.col("clm_tp_cd") == 3).join(sup, "l_suppkey"), F.concat(s(supp), F.lit(" ")), F.col("prov_name")),
        src(li.where(F.col("cpt_cd").isin("C050", "C051")), s(part % 100 + 1), None, "LAB"),
        src(li.where(F.col("l_quantity") > 45), F.when(F.col("l_quantity") > 49, "").otherwise(s(supp)), "", "QUALITY"),
        src(rx, s(part % 100 + 1), F.concat(F.lit("RX "), (part % 100 + 1).cast("string")), "PRESCRIBER"),
        src(rx, F.concat(F.lit("F"), (part % 50).cast("string")), None, "PHARMACY"),
        src(rx, s(part % 70 + 1), None, "PCP")]
    return merge_sources(dict(zip(PROVIDER_SOURCES, frames)), ["home_plan_id_cd", "prov_id_cd"], ["prov_name", "specialty"])


LOCATION_SOURCES = ["facility", "professional", "rx_retail", "rx_mail", "location"]


@query("clm_locations", B.q(["claim_line", "member", "pharmacy"], [], _merged_sql([
    f"SELECT home_plan_id_cd, 'L' || tp_of_bill_cd AS location_id, 'Facility ' || tp_of_bill_cd AS location_name, NULL AS region_name FROM {_L} WHERE clm_tp_cd IN (1, 2)",
    f"SELECT home_plan_id_cd, 'N' || CAST(l_suppkey % 30 AS VARCHAR), NULL, NULL FROM {_L} WHERE clm_tp_cd = 3",
    f"SELECT home_plan_id_cd, 'N' || CAST(l_partkey % 25 AS VARCHAR), 'Pharmacy ' || CAST(l_partkey % 25 AS VARCHAR), NULL FROM {_RX}",
    f"SELECT home_plan_id_cd, CASE WHEN l_partkey % 25 = 0 THEN ' ' ELSE 'M' || CAST(l_partkey % 25 AS VARCHAR) END, NULL, NULL FROM {_RX}",
    "SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0'), 'N' || CAST(n_nationkey AS VARCHAR), n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey"],
    "home_plan_id_cd, location_id", ["location_name", "region_name"], LOCATION_SOURCES)))
def clm_locations(spark, sf):
    """Master location list of five sources, by plan and location id."""
    inp = Inputs(spark, sf)
    plan = inp.member().select("member_bid", "home_plan_id_cd")
    li, rx = inp.lines().join(plan, "member_bid"), inp.pharmacy().join(plan, "member_bid")
    n = inp.table("nation").join(inp.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = (F.col("l_partkey") % 25).cast("string")
    frames = [
        li.where(F.col("clm_tp_cd").isin(1, 2)).select("home_plan_id_cd", F.concat(F.lit("L"), "tp_of_bill_cd").alias("location_id"),
                                                       F.concat(F.lit("Facility "), "tp_of_bill_cd").alias("location_name")),
        li.where(F.col("clm_tp_cd") == 3).select("home_plan_id_cd", F.concat(F.lit("N"), (F.col("l_suppkey") % 30).cast("string")).alias("location_id")),
        rx.select("home_plan_id_cd", F.concat(F.lit("N"), key).alias("location_id"), F.concat(F.lit("Pharmacy "), key).alias("location_name")),
        rx.select("home_plan_id_cd", F.when(F.col("l_partkey") % 25 == 0, " ").otherwise(F.concat(F.lit("M"), key)).alias("location_id")),
        n.select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("home_plan_id_cd"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("location_id"),
                 F.col("n_name").alias("location_name"), F.col("r_name").alias("region_name"))]
    return merge_sources(dict(zip(LOCATION_SOURCES, frames)), ["home_plan_id_cd", "location_id"], ["location_name", "region_name"])


@query("clm_load_status", """
SELECT table_name, n_rows, n_null_keys, CASE WHEN n_rows = 0 THEN 'FAILED' WHEN n_null_keys > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS status
FROM (SELECT 'orders' AS table_name, count(*) AS n_rows, count(*) - count(o_orderkey) AS n_null_keys FROM orders
  UNION ALL SELECT 'lineitem', count(*), count(*) - count(l_orderkey) FROM lineitem
  UNION ALL SELECT 'customer', count(*), count(*) - count(c_custkey) FROM customer
  UNION ALL SELECT 'labels', count(*), count(*) - count(doc_id) FROM labels)""")
def clm_load_status(spark, sf):
    """Per-table load summary in one plan: a count aggregate per table, unioned."""
    inp = Inputs(spark, sf)
    parts = []
    for t, k in [("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("customer", "c_custkey"), ("labels", "doc_id")]:
        parts.append(inp.table(t).agg(F.count(F.lit(1)).alias("n_rows"), F.count(k).alias("_nk"))
                     .select(F.lit(t).alias("table_name"), "n_rows", (F.col("n_rows") - F.col("_nk")).alias("n_null_keys")))
    u = SK.union_all(parts)
    return u.withColumn("status", F.when(F.col("n_rows") == 0, "FAILED").when(F.col("n_null_keys") > 0, "WARNING")
                        .otherwise("SUCCESS"))
