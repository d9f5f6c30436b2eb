"""Claim preparation (§2.11): qualification, visit type, place of service,
latest-row dedupe and the master lists.

Scale notes: the only large joins are claim lines ⋈ headers (on claim id)
and claims ⋈ enrollment (on member id); every rule table is broadcast.
Claim-level flags are window maxima over the claim id, so lines of one
claim are processed in one partition without a second shuffle when the
input is already partitioned by claim.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators import rules as OR
from riskspark.operators.intervals import interval_join
from riskspark.operators.joins import broadcast_if_small, dealt
from riskspark.operators.sinks import checkpoint
from riskspark.sources.records import MAO_004, deal_codes
from riskspark.sources import reference_data as R


def header_rule(header: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Stage 1 (claim header): inpatient / outpatient / professional rules → ``header_ok`` Y/N."""
    h = OR.with_coverage(header, enrollment)
    ok = (F.when(F.col("clm_tp_cd") == 1, OR.qualify_inpatient(h))
          .when(F.col("clm_tp_cd") == 2, OR.qualify_outpatient(h))
          .when(F.col("clm_tp_cd") == 3, OR.qualify_professional())
          .otherwise("N"))
    return h.withColumn("header_ok", ok).drop("covered")


def eligible_line(lines: DataFrame, procs: DataFrame, date_col: str = "claim_dt") -> DataFrame:
    """jn_visit_type core: procedure code valid on the line's date (broadcast
    left join with a ``between`` residual on the equi key)."""
    p = procs.select(F.col("cpt_cd").alias("_pc"), "valid_from", "valid_to")
    j = lines.join(broadcast_if_small(p), (F.col("cpt_cd") == F.col("_pc")) &
                   F.col(date_col).between(F.col("valid_from"), F.col("valid_to")), "left")
    return j.withColumn("line_eligible", F.col("_pc").isNotNull().cast("int")) \
        .drop("_pc", "valid_from", "valid_to")


def qualify_claims(lines_with_header: DataFrame, procs: DataFrame, types=(1, 2, 3)) -> DataFrame:
    """clm_qualify_facility / clm_qualify_professional.

    Stage 1 header rule, stage 2: the claim has ≥1 line with an eligible
    procedure (outpatient and professional only; inpatient passes on the
    header). The flag is set at claim level on every line (D22: no line is
    dropped), ``invalid_cpt_hcpcs`` marks lines without an eligible code.
    """
    li = eligible_line(lines_with_header.where(F.col("clm_tp_cd").isin(*types)), procs)
    w = Window.partitionBy("claim_bid")
    any_ok = F.max("line_eligible").over(w)
    q = F.when((F.col("header_ok") == "Y") & ((F.col("clm_tp_cd") == 1) | (any_ok == 1)), "Y").otherwise("N")
    return li.withColumn("qualify_claims", q) \
        .withColumn("invalid_cpt_hcpcs", F.when(F.col("line_eligible") == 1, "N").otherwise("Y"))


def claim_qualification(header: DataFrame, lines: DataFrame, enrollment: DataFrame,
                        procs: DataFrame) -> DataFrame:
    """One row per claim: ``claim_bid, qualify_claims`` (for joins from gaps)."""
    hr = header_rule(header, enrollment).select("claim_bid", "header_ok")
    li = lines.select("claim_bid", "clm_tp_cd", "cpt_cd", "claim_dt").join(hr, "claim_bid")
    li = eligible_line(li, procs)
    return li.groupBy("claim_bid").agg(
        F.when((F.max(F.when(F.col("header_ok") == "Y", 1).otherwise(0)) == 1)
               & ((F.max("clm_tp_cd") == 1) | (F.max("line_eligible") == 1)), "Y").otherwise("N")
        .alias("qualify_claims"))


def with_visit_type(lines: DataFrame, procs: DataFrame) -> DataFrame:
    """jn_visit_type: the date compared is the claim date for facility claims
    and the line's service (update) date for professional claims."""
    d = F.when(F.col("clm_tp_cd").isin(1, 2), F.col("claim_dt")).otherwise(F.col("updated_dt"))
    li = eligible_line(lines.withColumn("_vdt", d), procs, "_vdt")
    return li.withColumn("visit_type", F.when(F.col("line_eligible") == 1, R.VISIT_TYPE_MATCHED)
                         .otherwise(R.VISIT_TYPE_OTHER)).drop("_vdt", "line_eligible")


def latest_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """win_latest: newest row per key; ``order_cols`` is a total order (desc)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


#: What a pseudo claim is called, by whether its encounter matches a claim.
VISIT_PROVIDER, VISIT_HOME = "Visit – Provider", "Visit – Home Assessment"


def mao_lines(lineitem: DataFrame, orders: DataFrame, size: int = 0) -> DataFrame:
    """Stand-in for the encounter feed, one row a coded diagnosis: encounters are
    the lines of an order by supplier group, with their first and last service date.
    The lines are dealt out by the order; ``size`` is about their number
    (``joins.sized``), 0 leaves the number of tasks to Spark."""
    encounter = Window.partitionBy("l_orderkey", F.col("l_suppkey") % 3)  # one encounter id each; dealt out with the join
    dos = F.col("l_shipdate").cast("date")
    rows = dealt(lineitem.where(F.col("l_suppkey").isNotNull()), ["l_orderkey"], size).join(
        dealt(orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], size), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        "l_orderkey",
        F.concat(F.lit("E"), F.col("l_orderkey").cast("string"), F.lit("-"), (F.col("l_suppkey") % 3).cast("string")).alias("icn"),
        (F.lit(1100000000) + F.col("o_custkey")).cast("string").alias("mbi"),
        F.lpad((1 + F.col("l_suppkey") % 3).cast("string"), 2, "0").alias("encounter_type"),
        F.when(F.col("l_orderkey") % 10 == 0, "D").otherwise("A").alias("allowed_flag"),
        F.concat(F.lit("D"), F.lpad(((F.col("l_partkey") + 7 * (F.col("l_linenumber") % 2)) % 40).cast("string"), 3, "0")).alias("diag_cd"),
        F.when(F.col("l_quantity") > 10, "A").otherwise("D").alias("diag_flag"),
        dos.alias("dos"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        F.min(dos).over(encounter).alias("dos_from"), F.max(dos).over(encounter).alias("dos_thru"))


MAO_KEYS = ["icn", "mbi", "encounter_type", "allowed_flag", "dos_from", "dos_thru"]
MAO_ORDER = ["l_linenumber", "dos", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def mao_records(lines: DataFrame) -> DataFrame:
    """The feed in its wide layout: an encounter's diagnoses in numbered records of 38 code/flag pairs."""
    return deal_codes(lines, MAO_KEYS, "diag_cd", "diag_flag", MAO_ORDER, MAO_004, placed=["l_orderkey"])


def _numbers(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({"member_bid": F.col("mbi").cast("bigint"), "provider_type": F.col("encounter_type").cast("int")}).drop("mbi", "encounter_type")


def mao_pairs(records: DataFrame) -> DataFrame:
    """One row a code/flag pair of the wide records: the encounter's columns, pos, code, flag."""
    ids = [*MAO_KEYS, *(["record"] if "record" in records.columns else [])]
    return _numbers(OR.unpivot_pairs(records, ids, MAO_004.code, MAO_004.flag, MAO_004.pairs))


def line_pairs(lines: DataFrame) -> DataFrame:
    """The same rows, without record and pos, from a feed that has one row a diagnosis."""
    return _numbers(lines.select(*MAO_KEYS, F.col("diag_cd").alias("code"), F.col("diag_flag").alias("flag")))


def claim_spans(lines: DataFrame) -> DataFrame:
    """Each claim's first and last service date, from its lines, and its diagnoses."""
    return lines.groupBy("claim_bid", "member_bid", F.col("clm_tp_cd").alias("provider_type")).agg(
        F.min("updated_dt").alias("first_dt"), F.max("updated_dt").alias("last_dt"), F.collect_set("diag_cd").alias("diags"))


def mao_matches(pairs: DataFrame, spans: DataFrame) -> DataFrame:
    """jn_mao_claims: allowed encounters with the claims of the same member and
    provider type whose service dates hold the encounter's last day."""
    enc = pairs.where(F.col("allowed_flag") == "A").select("icn", "member_bid", "provider_type", "dos_thru").distinct()
    return interval_join(enc, spans.drop("diags"), ["member_bid", "provider_type"], "dos_thru", "first_dt", "last_dt")


def pseudo_claims(pairs: DataFrame, spans: DataFrame) -> DataFrame:
    """clm_pseudo_claims: the accepted diagnoses (flag A) of allowed encounters
    that no matching claim has become pseudo claims (type 5), named by whether
    the encounter matches a claim at all. Both are questions of existence: the
    claims' dates are merged per member and type, and per diagnosis."""
    key = ["member_bid", "provider_type"]
    dx = pairs.where((F.col("allowed_flag") == "A") & (F.col("flag") == "A")).select(
        "icn", *key, "dos_thru", F.col("code").alias("diag_cd")).distinct()
    by_diag = spans.select(*key, "first_dt", "last_dt", F.explode("diags").alias("diag_cd"))
    left = checkpoint(interval_join(dx, by_diag, [*key, "diag_cd"], "dos_thru", "first_dt", "last_dt", "left_anti"), "pseudo-diagnoses")
    hit = interval_join(left.select(*key, "dos_thru").distinct(), spans, key, "dos_thru", "first_dt", "last_dt", "left_semi")
    p = left.join(hit.withColumn("_m", F.lit(1)), [*key, "dos_thru"], "left")
    return p.select("icn", "member_bid", F.lit(5).alias("clm_tp_cd"), F.col("dos_thru").alias("claim_dt"),
                    F.year("dos_thru").alias("risk_year"), "diag_cd",
                    F.when(F.col("_m") == 1, VISIT_PROVIDER).otherwise(VISIT_HOME).alias("encounter_type"),
                    F.lit("Pseudo claim").alias("dx_source"))
