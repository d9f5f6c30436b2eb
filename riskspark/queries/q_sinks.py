"""Registered sink / table-maintenance queries (§2.2).

Each query derives its input from the driver tables, applies the change as
a new snapshot, and (where the operator is a write) writes it to a new path
under the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle import base as B
from riskspark.operators import sinks as SK
from riskspark.operators import windows as W
from riskspark.queries.common import Inputs
from riskspark.registry import query
from riskspark.session import path_exists, scratch_path

K = ["claim_bid", "clm_ln_num"]
CUTOFF = "1998-01-01"


def _snap(inp: Inputs, before: bool | None, created_by: str):
    """Latest lines loaded before the cutoff, from it on, or (None) all."""
    li = inp.lines()
    cond = F.col("updated_dt") < F.lit(CUTOFF).cast("date")
    if before is not None:
        li = li.where(cond if before else ~cond)
    latest = W.pick_one(li, K, ["updated_dt", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "cpt_cd"])
    return latest.select(*K, "clm_tp_cd", "cpt_cd", "updated_dt", F.lit(created_by).alias("created_by"))


def _snap_sql(name, op, created_by, cutoff=CUTOFF):
    return (name, f"""SELECT claim_bid, clm_ln_num, clm_tp_cd, cpt_cd, updated_dt, '{created_by}' AS created_by FROM (
  SELECT *, row_number() OVER (PARTITION BY claim_bid, clm_ln_num ORDER BY updated_dt DESC, l_partkey DESC, l_suppkey DESC,
    l_extendedprice DESC, l_quantity DESC, cpt_cd DESC) AS rn FROM claim_line WHERE updated_dt {op} DATE '{cutoff}') WHERE rn = 1""")


_TS = [_snap_sql("tgt", "<", "loader_v1"), _snap_sql("src", ">=", "loader_v2"),
       _snap_sql("every", ">=", "loader_v1", "0001-01-01")]
_INTS = ["clm_ln_num", "clm_tp_cd"]
_COLS = "claim_bid, clm_ln_num, clm_tp_cd, cpt_cd, updated_dt, created_by"
_UPSERT = """SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.claim_bid = t.claim_bid AND s.clm_ln_num = t.clm_ln_num)
UNION ALL SELECT s.claim_bid, s.clm_ln_num, s.clm_tp_cd, s.cpt_cd, s.updated_dt, coalesce(t.created_by, s.created_by)
FROM src s LEFT JOIN tgt t ON t.claim_bid = s.claim_bid AND t.clm_ln_num = s.clm_ln_num"""


def _o(final, steps=()):
    return B.typed(B.q(["claim_line"], _TS + list(steps), final), _INTS)


@query("snk_upsert", _o(_UPSERT))
def snk_upsert(spark, sf):
    inp = Inputs(spark, sf)
    return SK.upsert(_snap(inp, True, "loader_v1"), _snap(inp, False, "loader_v2"), K)


@query("snk_upsert_scoped_delete", _o("""SELECT u.* FROM up u WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.claim_bid = u.claim_bid
  AND t.clm_ln_num = u.clm_ln_num AND t.clm_tp_cd = 3
  AND NOT EXISTS (SELECT 1 FROM src s WHERE s.claim_bid = t.claim_bid AND s.clm_ln_num = t.clm_ln_num))""", [("up", _UPSERT)]))
def snk_upsert_scoped_delete(spark, sf):
    inp = Inputs(spark, sf)
    return SK.upsert_scoped_delete(_snap(inp, True, "loader_v1"), _snap(inp, False, "loader_v2"), K,
                                   F.col("clm_tp_cd") == 3)


@query("snk_insert_if_absent", _o("""SELECT * FROM tgt UNION ALL SELECT s.* FROM src s WHERE NOT EXISTS (
  SELECT 1 FROM tgt t WHERE t.claim_bid = s.claim_bid AND t.clm_ln_num = s.clm_ln_num)"""))
def snk_insert_if_absent(spark, sf):
    inp = Inputs(spark, sf)
    return SK.insert_if_absent(_snap(inp, True, "loader_v1"), _snap(inp, False, "loader_v2"), K)


@query("snk_update", _o("""SELECT claim_bid, clm_ln_num, clm_tp_cd,
  CASE WHEN cpt_cd IN ('C003', 'C011', 'C023', 'C041') THEN 'MODIFIER' ELSE cpt_cd END AS cpt_cd, updated_dt,
  CASE WHEN cpt_cd IN ('C003', 'C011', 'C023', 'C041') THEN 'updater' ELSE created_by END AS created_by FROM every"""))
def snk_update(spark, sf):
    t = _snap(Inputs(spark, sf), None, "loader_v1")
    cond = F.col("cpt_cd").isin("C003", "C011", "C023", "C041")
    return SK.update_where(t, cond, {"created_by": F.lit("updater"), "cpt_cd": F.lit("MODIFIER")}).select(*_COLS.split(", "))


@query("snk_delete", _o("SELECT * FROM every WHERE NOT (clm_tp_cd = 2)"))
def snk_delete(spark, sf):
    return SK.delete_where(_snap(Inputs(spark, sf), None, "loader_v1"), F.col("clm_tp_cd") == 2)


@query("snk_member_erase", B.q(["claim_header", "claim_line", "pharmacy", "member"], [
    ("er", """SELECT 1100000000 + c_custkey AS member_bid FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0""")], """
SELECT 'claim_line' AS table_name, count(*) AS remaining_rows FROM claim_line WHERE member_bid NOT IN (SELECT member_bid FROM er)
UNION ALL SELECT 'pharmacy', count(*) FROM pharmacy WHERE member_bid NOT IN (SELECT member_bid FROM er)
UNION ALL SELECT 'member', count(*) FROM member WHERE member_bid NOT IN (SELECT member_bid FROM er)"""))
def snk_member_erase(spark, sf):
    """Erase the members who asked for it: children first (claim lines,
    pharmacy) via the parent key, then the member rows."""
    inp = Inputs(spark, sf)
    ids = inp.table("customer").where((F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") < 0)) \
        .select((F.lit(1100000000) + F.col("c_custkey")).alias("member_bid"))
    lines, pharm, member = SK.erase_members([(inp.lines(), "member_bid"), (inp.pharmacy(), "member_bid")],
                                            inp.member(), "member_bid", ids)
    counts = [df.agg(F.count(F.lit(1)).alias("remaining_rows")).select(F.lit(n).alias("table_name"), "remaining_rows")
              for n, df in [("claim_line", lines), ("pharmacy", pharm), ("member", member)]]
    return SK.union_all(counts)


_MEMBER_SQL = B.q(["member"], [], "SELECT * FROM member")


@query("snk_overwrite", _MEMBER_SQL)
def snk_overwrite(spark, sf):
    """Partitioned overwrite to a new path, read back with the same schema."""
    m = Inputs(spark, sf).member()
    path = SK.write_snapshot(m, partition_by=["home_plan_id_cd"], mode="overwrite", name="member")
    return spark.read.schema(m.schema).parquet(path).select(*m.columns)


_GAP_TARGET = T.StructType([
    T.StructField("member_bid", T.LongType()), T.StructField("risk_year", T.IntegerType()),
    T.StructField("method_id", T.IntegerType()), T.StructField("cc_code", T.StringType()),
    T.StructField("gap_status", T.StringType()), T.StructField("created_by", T.StringType())])


@query("snk_append_cast", B.typed(B.q(["claim_line"], [], """
SELECT member_bid, risk_year, 2 AS method_id, 'CC0' || substring(diag_cd, 3, 2) AS cc_code, CAST(NULL AS VARCHAR) AS gap_status,
  'riskspark' AS created_by FROM claim_line"""), ["risk_year", "method_id"]))
def snk_append_cast(spark, sf):
    """Cast every column to the target type in target order (missing → null),
    add the audit column, append to a target written with the target schema."""
    li = Inputs(spark, sf).lines()
    rows = li.select("member_bid", F.col("risk_year").cast("string").alias("risk_year"),
                     F.lit("2").alias("method_id"),
                     F.concat(F.lit("CC0"), F.substring("diag_cd", 3, 2)).alias("cc_code"),
                     F.lit("riskspark").alias("created_by"), F.lit("x").alias("extra_col"))
    path = scratch_path(spark, "gaps_target")
    spark.createDataFrame([], _GAP_TARGET).write.parquet(path)
    SK.align_to(rows, _GAP_TARGET).write.mode("append").parquet(path)
    return spark.read.schema(_GAP_TARGET).parquet(path)


def _unique_name(prefix: str) -> str:
    import uuid
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@query("snk_insert_select", B.q(["claim_header"], [], """SELECT claim_bid, member_bid, allwd_amt FROM claim_header WHERE clm_tp_cd = 3"""))
def snk_insert_select(spark, sf):
    """Temp view + ``INSERT INTO t(cols) SELECT`` into a Parquet table at a
    path in the shared folder."""
    h = Inputs(spark, sf).header().where(F.col("clm_tp_cd") == 3)
    view, table = _unique_name("v_prof"), _unique_name("t_prof")
    h.createOrReplaceTempView(view)
    path = scratch_path(spark, table)
    spark.sql(f"CREATE TABLE {table} (claim_bid BIGINT, member_bid BIGINT, allwd_amt DOUBLE) USING parquet LOCATION '{path}'")
    spark.sql(f"INSERT INTO {table} (claim_bid, member_bid, allwd_amt) SELECT claim_bid, member_bid, allwd_amt FROM {view}")
    return spark.table(table)


@query("snk_create_or_upsert", _o(_UPSERT))
def snk_create_or_upsert(spark, sf):
    """First call creates the table (path absent); the second upserts into a
    new snapshot path; the result is read back."""
    inp = Inputs(spark, sf)
    path = scratch_path(spark, "create_or_upsert")
    first = create_or_upsert(spark, path, _snap(inp, True, "loader_v1"), K)
    second = create_or_upsert(spark, first, _snap(inp, False, "loader_v2"), K)
    return spark.read.parquet(second)


def create_or_upsert(spark, path: str, df, keys) -> str:
    """snk_create_or_upsert: create when missing, else upsert into a new
    snapshot written next to it (never overwriting the path being read). The
    path's own file system says whether it exists."""
    if not path_exists(spark, path):
        df.write.parquet(path)
        return path
    cur = spark.read.parquet(path)
    return SK.write_snapshot(SK.upsert(cur, df, keys), spark=spark, name="snapshot")


@query("snk_table_from_view", B.typed(B.q(["claim_header"], [], """SELECT risk_year, clm_tp_cd, count(*) AS n_claims,
  CAST(sum(CAST(allwd_amt AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount FROM claim_header GROUP BY 1, 2"""),
    ["risk_year", "clm_tp_cd"]))
def snk_table_from_view(spark, sf):
    """Drop + CREATE TABLE AS SELECT from a view."""
    from riskspark.operators.aggs import exact_sum
    h = Inputs(spark, sf).header()
    view, table = _unique_name("v_sum"), _unique_name("t_sum")
    h.groupBy("risk_year", "clm_tp_cd").agg(F.count("*").alias("n_claims"), exact_sum("allwd_amt").alias("total_amount")) \
        .createOrReplaceTempView(view)
    path = scratch_path(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}' AS SELECT * FROM {view}")
    return spark.table(table)


@query("snk_checkpoint", B.q(["claim_header"], [], "SELECT claim_bid, member_bid, claim_dt, allwd_amt FROM claim_header"))
def snk_checkpoint(spark, sf):
    """Lineage cut that survives executor loss: Parquet in the shared folder."""
    h = Inputs(spark, sf).header().select("claim_bid", "member_bid", "claim_dt", "allwd_amt")
    return SK.checkpoint(h, "claims_ckpt")


@query("snk_audit_cols", B.q(["claim_header"], [], """SELECT claim_bid, 'UPSERT' AS audit_operation, 'orders' AS audit_source,
  'medical_claims' AS audit_target, 'riskspark' AS processed_by, 'riskspark' AS created_by, 'riskspark' AS updated_by
FROM claim_header"""))
def snk_audit_cols(spark, sf):
    h = Inputs(spark, sf).header().select("claim_bid")
    return SK.with_audit(h, "UPSERT", "orders", "medical_claims").drop("processed_ts")
