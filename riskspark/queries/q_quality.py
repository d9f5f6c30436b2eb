"""Registered data-quality / reconciliation / layout queries (§2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle import base as B
from oracle import combined as OC
from oracle import persistence as OP
from riskspark.operators import quality as Q
from riskspark.operators.joins import broadcast_if_small
from riskspark.plans import gaps as G
from riskspark.plans import persistence as P
from riskspark.operators.sinks import checkpoint
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.sources import reference as REF


@query("dq_checks", B.q(["claim_line"], [], """
SELECT 'null_count' AS check_name, 'diag_cd' AS column_name, count(*) - count(diag_cd) AS failed_count FROM claim_line
UNION ALL SELECT 'null_count', 'cpt_cd', count(*) - count(cpt_cd) FROM claim_line
UNION ALL SELECT 'null_count', 'claim_dt', count(*) - count(claim_dt) FROM claim_line
UNION ALL SELECT 'invalid_value', 'clm_tp_cd', count(*) FILTER (WHERE clm_tp_cd NOT IN (1, 2) OR clm_tp_cd IS NULL) FROM claim_line
UNION ALL SELECT 'duplicate_key', 'claim_bid,clm_ln_num', CAST(sum(n - 1) AS BIGINT) FROM (
  SELECT claim_bid, clm_ln_num, count(*) AS n FROM claim_line GROUP BY 1, 2)"""))
def dq_checks(spark, sf):
    li = Inputs(spark, sf).lines()
    return Q.quality_checks(li, ["diag_cd", "cpt_cd", "claim_dt"], ["claim_bid", "clm_ln_num"], {"clm_tp_cd": [1, 2]})


_EXP = [
    {"name": "row_count", "kind": "row_count_between", "min": 1, "max": 100_000_000},
    {"name": "member_not_null", "kind": "not_null", "column": "member_bid"},
    {"name": "contract_format", "kind": "regex", "column": "contract_id", "pattern": "^H[0-9]{4}$"},
    {"name": "begin_date_format", "kind": "regex", "column": "begin_txt", "pattern": "^199[5-6][0-9]{4}$", "mostly": 0.9,
     "severity": "WARNING"},
    {"name": "balance_range", "kind": "between", "column": "c_acctbal", "min": 0, "max": 9000, "mostly": 0.9,
     "severity": "WARNING"},
]


@query("dq_expectations", """
WITH e AS (SELECT 1100000000 + c_custkey AS member_bid, 'H' || lpad(CAST(c_nationkey % 5 AS VARCHAR), 4, '0') AS contract_id,
  strftime(CAST(DATE '1995-01-01' + CAST(c_custkey % 400 AS INTEGER) AS DATE), '%Y%m%d') AS begin_txt, c_acctbal FROM customer),
s AS (SELECT count(*) AS n, count(*) - count(member_bid) AS b1,
  count(*) FILTER (WHERE contract_id IS NOT NULL AND NOT regexp_matches(contract_id, '^H[0-9]{4}$')) AS b2,
  count(*) FILTER (WHERE begin_txt IS NOT NULL AND NOT regexp_matches(begin_txt, '^199[5-6][0-9]{4}$')) AS b3,
  count(*) FILTER (WHERE c_acctbal IS NOT NULL AND NOT (c_acctbal BETWEEN 0 AND 9000)) AS b4 FROM e)
SELECT 'row_count' AS expectation, CAST(NULL AS VARCHAR) AS column_name, n BETWEEN 1 AND 100000000 AS success,
  CAST(0 AS BIGINT) AS unexpected_count, 0.0 AS unexpected_pct, 'ERROR' AS severity FROM s
UNION ALL SELECT 'member_not_null', 'member_bid', 1.0 - b1 / n >= 1.0, b1, round(b1 * 100.0 / n, 4), 'ERROR' FROM s
UNION ALL SELECT 'contract_format', 'contract_id', 1.0 - b2 / n >= 1.0, b2, round(b2 * 100.0 / n, 4), 'ERROR' FROM s
UNION ALL SELECT 'begin_date_format', 'begin_txt', 1.0 - b3 / n >= 0.9, b3, round(b3 * 100.0 / n, 4), 'WARNING' FROM s
UNION ALL SELECT 'balance_range', 'c_acctbal', 1.0 - b4 / n >= 0.9, b4, round(b4 * 100.0 / n, 4), 'WARNING' FROM s""")
def dq_expectations(spark, sf):
    inp = Inputs(spark, sf)
    e = inp.enrollment().select("member_bid", "contract_id", F.date_format("covrg_begin_dt", "yyyyMMdd").alias("begin_txt"))
    c = inp.table("customer").select((F.lit(1100000000) + F.col("c_custkey")).alias("member_bid"), "c_acctbal")
    return Q.expectations(e.join(c, "member_bid", "left"), _EXP)


@query("dq_inputs", B.q(["member", "claim_line"], [], """
SELECT 'null_required' AS check_name, (SELECT count(*) - count(member_bid) FROM member) + (SELECT count(*) - count(memb_brth_dt) FROM member) AS value
UNION ALL SELECT 'duplicate_members', (SELECT count(*) - count(DISTINCT member_bid) FROM member)
UNION ALL SELECT 'diagnosis_rows_probe', (SELECT count(*) FROM (SELECT 1 FROM claim_line LIMIT 1))"""))
def dq_inputs(spark, sf):
    """Required columns non-null, member id unique, diagnosis table not empty
    (probe = 0) — one small aggregate per check, unioned."""
    from riskspark.operators.sinks import union_all
    inp = Inputs(spark, sf)
    m = inp.member()
    nulls = m.agg((F.sum(F.col("member_bid").isNull().cast("long")) + F.sum(F.col("memb_brth_dt").isNull().cast("long")))
                  .alias("value")).select(F.lit("null_required").alias("check_name"), "value")
    dups = m.groupBy("member_bid").agg(F.count(F.lit(1)).alias("_n")).agg(F.sum(F.col("_n") - 1).alias("value")) \
        .select(F.lit("duplicate_members").alias("check_name"), "value")
    probe = inp.lines().limit(1).agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("diagnosis_rows_probe").alias("check_name"), "value")
    return union_all([nulls, dups, probe])


@query("dq_relationships", B.q(["claim_header", "member", "pharmacy"], [], """
SELECT 'claim_member' AS rule, count(*) AS child_rows, count(*) - count(member_bid) AS null_fk,
  count(*) FILTER (WHERE member_bid IS NOT NULL AND member_bid NOT IN (SELECT member_bid FROM member)) AS orphan_count FROM claim_header
UNION ALL SELECT 'lineitem_part', count(*), count(*) - count(l_partkey),
  count(*) FILTER (WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem
UNION ALL SELECT 'pharmacy_member', count(*), count(*) - count(member_bid),
  count(*) FILTER (WHERE member_bid IS NOT NULL AND member_bid NOT IN (SELECT member_bid FROM member)) FROM pharmacy"""))
def dq_relationships(spark, sf):
    inp = Inputs(spark, sf)
    a = Q.relationships(inp.header(), "member_bid", inp.member(), "member_bid", "claim_member")
    b = Q.relationships(inp.table("lineitem"), "l_partkey", inp.table("part"), "p_partkey", "lineitem_part")
    c = Q.relationships(inp.pharmacy(), "member_bid", inp.member(), "member_bid", "pharmacy_member")
    return a.unionByName(b).unionByName(c)


@query("dq_schema")
def dq_schema(spark, sf):
    """Missing columns and type mismatches of the orders table against the
    expected claim-header schema (metadata only)."""
    expected = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                             T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DecimalType(10, 2)),
                             T.StructField("o_orderdate", T.DateType()), T.StructField("o_clerk", T.StringType())])
    rows = Q.schema_diff(Inputs(spark, sf).table("orders"), expected)
    return spark.createDataFrame(rows, "column_name string, issue string, expected_type string, actual_type string")


@query("dq_reconcile", B.q(["claim_header", "claim_line"], [("s", "SELECT claim_bid, member_bid FROM claim_header"),
                                                    ("t", "SELECT DISTINCT claim_bid, member_bid FROM claim_line")], """
SELECT count(s.claim_bid) AS source_count, count(t.claim_bid) AS target_count,
  count(*) FILTER (WHERE s.claim_bid IS NOT NULL AND t.claim_bid IS NOT NULL) AS matched,
  count(*) FILTER (WHERE t.claim_bid IS NULL) AS missing_in_target, count(*) FILTER (WHERE s.claim_bid IS NULL) AS extra_in_target,
  count(*) FILTER (WHERE s.claim_bid IS NOT NULL AND t.claim_bid IS NOT NULL AND s.member_bid IS DISTINCT FROM t.member_bid) AS value_mismatches,
  CASE WHEN count(*) FILTER (WHERE t.claim_bid IS NULL) = 0 AND count(*) FILTER (WHERE s.claim_bid IS NULL) = 0
    AND count(*) FILTER (WHERE s.claim_bid IS NOT NULL AND t.claim_bid IS NOT NULL AND s.member_bid IS DISTINCT FROM t.member_bid) = 0
    THEN 'PASS' ELSE 'FAIL' END AS status
FROM s FULL OUTER JOIN t ON s.claim_bid = t.claim_bid"""))
def dq_reconcile(spark, sf):
    inp = Inputs(spark, sf)
    s = inp.header().select("claim_bid", "member_bid")
    t = inp.lines().select("claim_bid", "member_bid").distinct()
    return Q.reconcile(s, t, ["claim_bid"], {"member_bid": None})


@query("dq_incremental", B.typed(B.q(["claim_line"], [
    ("cur", """SELECT claim_bid, clm_ln_num, cpt_cd, updated_dt FROM (SELECT *, row_number() OVER (PARTITION BY claim_bid, clm_ln_num
    ORDER BY updated_dt DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM claim_line) WHERE rn = 1"""),
    ("prev", "SELECT claim_bid, clm_ln_num, max(updated_dt) AS pu FROM claim_line WHERE updated_dt < DATE '1998-01-01' GROUP BY 1, 2")], """
SELECT c.claim_bid, c.clm_ln_num, c.cpt_cd, c.updated_dt, CASE WHEN p.pu IS NULL THEN 'NEW' ELSE 'CHANGED' END AS change_type
FROM cur c LEFT JOIN prev p ON p.claim_bid = c.claim_bid AND p.clm_ln_num = c.clm_ln_num WHERE p.pu IS NULL OR c.updated_dt > p.pu"""),
    ["clm_ln_num"]))
def dq_incremental(spark, sf):
    from riskspark.operators import windows as W
    li = Inputs(spark, sf).lines()
    k = ["claim_bid", "clm_ln_num"]
    cur = W.pick_one(li, k, ["updated_dt", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]).select(
        *k, "cpt_cd", "updated_dt")
    prev = li.where(F.col("updated_dt") < F.lit("1998-01-01").cast("date")).groupBy(*k).agg(F.max("updated_dt").alias("updated_dt"))
    return Q.incremental(cur, prev, k, "updated_dt")


@query("dq_outliers", B.typed(B.q(["claim_header"], [], """
SELECT h.claim_bid, h.clm_tp_cd, round((h.allwd_amt - s.m) / s.sd, 6) AS z_score, abs((h.allwd_amt - s.m) / s.sd) > 2.0 AS is_outlier
FROM claim_header h JOIN (SELECT clm_tp_cd, avg(allwd_amt) AS m, stddev_samp(allwd_amt) AS sd FROM claim_header GROUP BY 1) s
  ON s.clm_tp_cd = h.clm_tp_cd"""), ["clm_tp_cd"]))
def dq_outliers(spark, sf):
    h = Inputs(spark, sf).header().select("claim_bid", "clm_tp_cd", "allwd_amt")
    o = Q.outliers(h, "allwd_amt", ["clm_tp_cd"], 2.0)
    return o.select("claim_bid", "clm_tp_cd", F.round("z_score", 6).alias("z_score"), "is_outlier")


@query("dq_period_check", B.q(OP.BASE, OP.STEPS, B.typed("""
SELECT c.risk_year, min(c.claim_dt) AS min_dt, max(c.claim_dt) AS max_dt,
  CASE WHEN min(c.claim_dt) >= min(tp.begin_date) AND max(c.claim_dt) <= max(tp.end_date) THEN 'PASS' ELSE 'FAIL' END AS status
FROM ch c JOIN time_periods tp ON tp.period_type = 'C' AND tp.risk_year = c.risk_year GROUP BY 1""", ["risk_year"])))
def dq_period_check(spark, sf):
    ch = Inputs(spark, sf).claim_hcc()
    tp = REF.time_periods(spark).where(F.col("period_type") == "C").select("risk_year", "begin_date", "end_date")
    g = ch.join(broadcast_if_small(tp), "risk_year").groupBy("risk_year").agg(
        F.min("claim_dt").alias("min_dt"), F.max("claim_dt").alias("max_dt"),
        F.min("begin_date").alias("_b"), F.max("end_date").alias("_e"))
    return g.select("risk_year", "min_dt", "max_dt", F.when((F.col("min_dt") >= F.col("_b")) & (F.col("max_dt") <= F.col("_e")),
                                                            "PASS").otherwise("FAIL").alias("status"))


@query("dq_frequency_check", B.q(OP.BASE, OP.STEPS, B.typed("""
SELECT c.member_bid, c.risk_year, c.hcc, c.frequency AS stored_frequency, r.n AS distinct_claims, c.frequency = r.n AS ok
FROM curl c JOIN (SELECT member_bid, risk_year, hcc, count(DISTINCT claim_bid) AS n FROM ch GROUP BY 1, 2, 3) r
  ON r.member_bid = c.member_bid AND r.risk_year = c.risk_year AND r.hcc = c.hcc""", ["risk_year", "hcc", "stored_frequency"])))
def dq_frequency_check(spark, sf):
    """Stored frequency equals distinct claims (violations have ``ok`` false)."""
    inp = Inputs(spark, sf)
    ch = inp.keyed_claims("member_bid", "risk_year", "hcc")
    stored = P.current_filter(inp.claim_hcc(), inp.most_claims()).select("member_bid", "risk_year", "hcc", F.col("frequency").alias("stored_frequency"))
    recount = ch.groupBy("member_bid", "risk_year", "hcc").agg(F.countDistinct("claim_bid").alias("distinct_claims"))
    j = stored.join(recount, ["member_bid", "risk_year", "hcc"])
    return j.withColumn("ok", F.col("stored_frequency") == F.col("distinct_claims"))


@query("dq_step_log", B.q(OC.BASE, OC.STEPS, B.typed("""
WITH s AS (SELECT 0 AS step_no, 'draft' AS step, (SELECT count(*) FROM draft) AS rows_out
  UNION ALL SELECT 1, 'create_gap', (SELECT count(*) FROM draft_f WHERE draft_status = 'Create Gap')
  UNION ALL SELECT 2, 'member_gaps', (SELECT count(*) FROM g0)
  UNION ALL SELECT 3, 'open_suspect', (SELECT count(*) FROM gaps WHERE gap_status = 'Open Suspect'))
SELECT s.step_no, s.step, p.rows_out AS rows_in, s.rows_out, round((s.rows_out - p.rows_out) * 100.0 / p.rows_out, 4) AS change_pct
FROM s LEFT JOIN s p ON p.step_no = s.step_no - 1""", ["step_no", "rows_in", "rows_out"])))
def dq_step_log(spark, sf):
    """The gap steps run once; their counts are observed on the way, and the
    member gaps, which the suppression reads several times, are written once."""
    inp, log = Inputs(spark, sf), Q.StepLog()
    draft = log.step("draft", inp.gap_draft())
    created = log.step("create_gap", G.with_create_flag(draft).where(F.col("draft_status") == "Create Gap"))
    gaps = checkpoint(log.step("member_gaps", G.member_gaps(created)), "member-gaps")
    status = G.statuses_from_gaps(gaps, REF.hierarchy_pairs(spark), inp.v28_hcc())
    log.step("open_suspect", status.where(F.col("gap_status") == "Open Suspect")).write.format("noop").mode("overwrite").save()
    return log.frame(spark)


@query("lay_skew", B.q(["claim_line"], [], """SELECT member_bid, CAST(sum(CAST(line_amt AS DECIMAL(18, 2))) AS DOUBLE) AS sum_line_amt,
  count(*) AS n_rows FROM claim_line GROUP BY 1"""))
def lay_skew(spark, sf):
    li = Inputs(spark, sf).lines()
    return Q.salted_sum(li, "member_bid", "line_amt", ["claim_bid", "clm_ln_num", "l_partkey", "l_suppkey"], 16)


@query("lay_cache", B.q(OP.BASE, OP.STEPS, B.typed("""SELECT a.member_bid, a.risk_year, a.n_codes, b.n_claims FROM
  (SELECT member_bid, risk_year, count(DISTINCT hcc) AS n_codes FROM ch GROUP BY 1, 2) a JOIN
  (SELECT member_bid, risk_year, count(DISTINCT claim_bid) AS n_claims FROM ch GROUP BY 1, 2) b
  ON a.member_bid = b.member_bid AND a.risk_year = b.risk_year""", ["risk_year"])))
def lay_cache(spark, sf):
    """A frame used twice is persisted once (memory, spilling to disk) and
    released as soon as the result is written."""
    with Q.cached(Inputs(spark, sf).keyed_claims("member_bid", "risk_year")) as ch:
        a = ch.groupBy("member_bid", "risk_year").agg(F.countDistinct("hcc").alias("n_codes"))
        b = ch.groupBy("member_bid", "risk_year").agg(F.countDistinct("claim_bid").alias("n_claims"))
        return checkpoint(a.join(b, ["member_bid", "risk_year"]), "cached-use")
