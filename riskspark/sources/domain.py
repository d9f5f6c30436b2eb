"""Domain tables (member, enrollment, claims, pharmacy) projected from the
driver's TPC-H-shaped Parquet tables.

The projection is fixed (it is the data contract shared with the SQL
oracle); each function returns a lazy DataFrame, so Catalyst prunes the
Parquet scan to the columns a query actually uses and pushes filters into it.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.joins import sized

MEMBER_BASE = 1100000000
CLAIM_BASE = 3300000000
PHARMACY_BASE = 4400000000


_READS: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table (one relation per session and path: the file listing
    and footer read happen once; the scan itself stays lazy)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per = _READS.setdefault(spark, {})
    if path not in per:
        per[path] = spark.read.parquet(path)
    return per[path]


_ROWS: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def table_rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    """The table's number of rows, from the file footers (once per session and path, as the read)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per = _ROWS.setdefault(spark, {})
    if path not in per:
        per[path] = table(spark, sf_dir, name).count()
    return per[path]


def _code(prefix: str, c: Column, width: int = 3) -> Column:
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), width, "0"))


def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        (F.lit(MEMBER_BASE) + k).alias("member_bid"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("home_plan_id_cd"),
        F.date_add(F.lit("1910-01-01").cast("date"), ((k * 2917) % 31000).cast("int")).alias("memb_brth_dt"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("memb_gender_cd"),
        (k % 3).cast("string").alias("orec"),
        F.when(k % 4 == 0, "CNA").when(k % 4 == 1, "CFA").when(k % 4 == 2, "CPA")
        .otherwise("INS").alias("segment"),
        _code("H", F.col("c_nationkey") % 5, 4).alias("contract_id"),
    )


def enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        (F.lit(MEMBER_BASE) + k).alias("member_bid"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("home_plan_id_cd"),
        _code("H", F.col("c_nationkey") % 5, 4).alias("contract_id"),
        F.date_add(F.lit("1995-01-01").cast("date"), (k % 400).cast("int")).alias("covrg_begin_dt"),
        F.when(k % 10 == 0, F.lit("9999-12-31").cast("date"))
        .otherwise(F.date_add(F.lit("1997-12-31").cast("date"), ((k * 13) % 1300).cast("int")))
        .alias("covrg_end_dt"),
    )


def _header_cols(o: DataFrame) -> list[Column]:
    k = F.col("o_orderkey")
    return [
        (F.lit(CLAIM_BASE) + k).alias("claim_bid"),
        (F.lit(MEMBER_BASE) + F.col("o_custkey")).alias("member_bid"),
        (F.lit(1) + k % 3).cast("int").alias("clm_tp_cd"),
        F.when(F.col("o_orderstatus").isin("P", "F"), "P").otherwise("D").alias("clm_pmt_sts_cd"),
        F.col("o_totalprice").alias("allwd_amt"),
        F.col("o_orderdate").cast("date").alias("claim_dt"),
        F.year("o_orderdate").alias("risk_year"),
        F.date_format("o_orderdate", "yyyy_MM").alias("source_load_month"),
        F.when(k % 5 == 0, "110").when(k % 5 == 1, "131").when(k % 5 == 2, "850")
        .when(k % 5 == 3, "411").otherwise("720").alias("tp_of_bill_cd"),
    ]


def claim_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*_header_cols(table(spark, sf_dir, "orders")))


def claim_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with its claim header columns.

    ``(claim_bid, clm_ln_num)`` repeats within a claim; the tie-breaker
    columns make every pick-one total. Lines and headers are dealt out by the
    claim over tasks of a bounded number of lines.
    """
    h = claim_header(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select(
        (F.lit(CLAIM_BASE) + F.col("l_orderkey")).alias("claim_bid"),
        F.col("l_linenumber").alias("clm_ln_num"),
        _code("C", F.col("l_partkey") % 60).alias("cpt_cd"),
        _code("D", F.col("l_partkey") % 40).alias("diag_cd"),
        F.col("l_extendedprice").alias("line_amt"),
        F.col("l_shipdate").cast("date").alias("updated_dt"),
        F.col("l_partkey").alias("l_partkey"),
        F.col("l_suppkey").alias("l_suppkey"),
        F.col("l_extendedprice").alias("l_extendedprice"),
        F.col("l_quantity").alias("l_quantity"),
    )
    li, h = sized([li, h], max(table_rows(spark, sf_dir, t) for t in ("lineitem", "orders")), ["claim_bid"])
    return li.join(h, "claim_bid")


def pharmacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        (F.lit(PHARMACY_BASE) + F.col("l_orderkey")).alias("claim_bid"),
        (F.lit(MEMBER_BASE) + F.col("o_custkey")).alias("member_bid"),
        F.col("l_linenumber").alias("clm_ln_num"),
        _code("N", F.col("l_suppkey") % 25).alias("prod_serv_id_cd"),
        F.col("l_shipdate").cast("date").alias("serv_dt"),
        F.col("l_extendedprice").alias("allwd_amt"),
        F.col("l_partkey").alias("l_partkey"),
    )
