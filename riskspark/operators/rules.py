"""Projection, filter and row-level rules (§2.3).

All of these are narrow transformations (no shuffle) except where a join to
a rule table is named; rule tables are broadcast.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import functions as RF
from riskspark.operators.joins import broadcast_if_small


def ensure_columns(df: DataFrame, columns: Mapping[str, str], default=None) -> DataFrame:
    """prj_ensure_columns: add each missing column as a typed default."""
    missing = {c: F.lit(default).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def apply_pipeline(df: DataFrame, steps: Sequence[Mapping]) -> DataFrame:
    """prj_pipeline: config list of filter / select / rename / cast / derive steps."""
    for s in steps:
        op = s["op"]
        if op == "filter":
            df = df.where(F.expr(s["expr"]))
        elif op == "select":
            df = df.select(*s["cols"])
        elif op == "rename":
            df = df.withColumnsRenamed(dict(s["map"]))
        elif op == "cast":
            df = df.withColumns({c: F.col(c).cast(t) for c, t in s["map"].items()})
        elif op == "derive":
            df = df.withColumns({c: F.expr(e) for c, e in s["map"].items()})
        else:
            raise ValueError(f"unknown pipeline step {op!r}")
    return df


def apply_business_rules(df: DataFrame, rules: Sequence[tuple[str, str, object]]) -> DataFrame:
    """prj_business_rules: for each (target, SQL condition, value) in order,
    ``target = when(cond, value).otherwise(target)``; later rules win."""
    for target, cond, value in rules:
        cur = F.col(target) if target in df.columns else F.lit(None)
        df = df.withColumn(target, F.when(F.expr(cond), F.lit(value)).otherwise(cur))
    return df


def derived_metrics(df: DataFrame, specs: Mapping[str, str]) -> DataFrame:
    """prj_derived_metrics: ``{name: SQL expression}`` columns."""
    return df.withColumns({k: F.expr(v) for k, v in specs.items()})


def flatten_struct(df: DataFrame, cols: Sequence[str], sep: str = "_") -> DataFrame:
    """prj_flatten_struct: expand struct columns to ``{struct}{sep}{field}`` and drop the struct."""
    out = []
    for f in df.schema.fields:
        if f.name in cols and isinstance(f.dataType, T.StructType):
            out += [F.col(f"{f.name}.{g.name}").alias(f"{f.name}{sep}{g.name}") for g in f.dataType.fields]
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def regex_extract(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """prj_regex_extract: ``{col}_extracted = regexp_extract(col, pattern, 0)``."""
    return df.withColumns({f"{c}_extracted": F.regexp_extract(c, p, 0) for c, p in patterns.items()})


def summary_dedupe(df: DataFrame, drop_cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """prj_summary: drop claim-level columns, one row per key (remaining
    columns must be constant per key)."""
    return df.drop(*drop_cols).dropDuplicates(list(keys))


def trim_strings(df: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """prj_trim_keys: trim every string column once; drop rows with a blank key."""
    out = df.select(*[F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                      else F.col(f.name) for f in df.schema.fields])
    conds = [F.coalesce(F.length(F.col(k)), F.lit(0)) > 0 for k in key_cols]
    return out.where(RF.and_all(conds)) if conds else out


def with_icd_parts(df: DataFrame, code_col: str) -> DataFrame:
    """prj_icd_parts: code length (without dot), 3-char category, has-dot flag."""
    return df.withColumns(RF.icd_parts(code_col))


def with_claim_type_label(df: DataFrame, tp_col: str = "clm_tp_cd") -> DataFrame:
    """prj_claim_type_label: 1/2/3/4 → facility-inpatient/-outpatient/professional/pharmacy."""
    return df.withColumn("claim_type", RF.claim_type_label(tp_col))


def with_program_pos(df: DataFrame, pos_map: DataFrame) -> DataFrame:
    """prj_program_pos: PROGRAM bucket; facility claims take the place of
    service of their bill-type prefix, others keep the professional default."""
    m = pos_map.select(F.col("bill_prefix").alias("_bp"), F.col("place_of_service").alias("_fpos"))
    j = df.join(broadcast_if_small(m), F.substring("tp_of_bill_cd", 1, 2) == F.col("_bp"), "left")
    program = F.when(F.col("clm_tp_cd").isin(1, 2), "FACILITY").when(F.col("clm_tp_cd") == 3, "PROFESSIONAL") \
        .otherwise("OTHER")
    fac = F.when(F.col("clm_tp_cd").isin(1, 2), F.col("_fpos"))
    return j.withColumn("program", program) \
        .withColumn("place_of_service", F.coalesce(fac, F.lit("11"))).drop("_bp", "_fpos")


def claim_dates_valid(claims: DataFrame, spans: DataFrame) -> DataFrame:
    """prj_claim_dates_valid: ``date_valid`` and VALID / OUT_OF_PERIOD, one row per claim."""
    return with_coverage(claims, spans).withColumnRenamed("covered", "date_valid") \
        .withColumn("date_status", F.when(F.col("date_valid"), "VALID").otherwise("OUT_OF_PERIOD"))


def period_filter(claims: DataFrame, periods: DataFrame, date_col: str) -> DataFrame:
    """prj_period_filter: keep claims whose date lies inside a period, one row
    per (claim, period). Range join made equi: a period is listed under every
    calendar year it reaches into and a claim probes its own year; the residual
    ``between`` filter is exact for periods of any length."""
    p = periods.select("time_period", "begin_date", "end_date", "period_type",
                       F.col("risk_year").alias("period_risk_year"),
                       F.explode(F.sequence(F.year("begin_date"), F.year("end_date"))).alias("_year"))
    c = claims.withColumn("_year", F.year(date_col))
    return c.join(broadcast_if_small(p), "_year").where(
        F.col(date_col).between(F.col("begin_date"), F.col("end_date"))).drop("_year")


def pseudo_claims(supp: DataFrame) -> DataFrame:
    """prj_pseudo_claims: supplemental rows in the medical-claims layout."""
    return supp.select(
        "claim_bid", "member_bid", "clm_ln_num",
        F.lit(5).alias("clm_tp_cd"), F.lit("P").alias("clm_pmt_sts_cd"),
        F.lit(None).cast("string").alias("tp_of_bill_cd"),
        F.col("serv_dt").alias("first_serv_dt"), F.col("serv_dt").alias("last_serv_dt"),
        F.year("serv_dt").alias("risk_year"), F.lit("SUPPLEMENTAL").alias("dx_source"),
        F.col("allwd_amt").alias("allwd_amt"))


def yn(c: Column) -> Column:
    """Y/N normalisation of a flag-like text."""
    v = F.lower(F.trim(c.cast("string")))
    return F.when(v.isin("y", "yes", "1", "true", "t"), "Y").otherwise("N")


def mmr_status(df: DataFrame, flags: Mapping[str, str], rename: Mapping[str, str]) -> DataFrame:
    """prj_mmr_status: Y/N member status flags from raw fields, renamed by a map."""
    return df.withColumns({k: yn(F.expr(v)) for k, v in flags.items()}).withColumnsRenamed(dict(rename))


def qualify_inpatient(df: DataFrame) -> Column:
    """prj_qualify_inpatient: type 1, status P, bill type 11x/41x."""
    return F.when((F.col("clm_tp_cd") == 1) & (F.col("clm_pmt_sts_cd") == "P")
                  & F.substring("tp_of_bill_cd", 1, 2).isin("11", "41"), "Y").otherwise("N")


def qualify_outpatient(df: DataFrame) -> Column:
    """prj_qualify_outpatient: type 2, allowed > 0, status P, bill type 13x/85x,
    service date within coverage (``covered``)."""
    return F.when((F.col("clm_tp_cd") == 2) & (F.col("allwd_amt") > 0) & (F.col("clm_pmt_sts_cd") == "P")
                  & F.substring("tp_of_bill_cd", 1, 2).isin("13", "85")
                  & F.col("covered"), "Y").otherwise("N")


def with_coverage(claims: DataFrame, spans: DataFrame, key: str = "claim_bid", svc: str = "claim_dt") -> DataFrame:
    """``covered``: whether the service date lies in any coverage span of the
    member. One flag per claim, so several spans never multiply a claim."""
    inside = claims.select(key, "member_bid", svc).join(spans.select("member_bid", "covrg_begin_dt", "covrg_end_dt"), "member_bid") \
        .where(F.col(svc).between(F.col("covrg_begin_dt"), F.col("covrg_end_dt")))
    return claims.join(inside.select(key).distinct().withColumn("covered", F.lit(True)), key, "left") \
        .withColumn("covered", F.coalesce("covered", F.lit(False)))


def qualify_professional() -> Column:
    """Header rule for professional claims: type 3, status P."""
    return F.when((F.col("clm_tp_cd") == 3) & (F.col("clm_pmt_sts_cd") == "P"), "Y").otherwise("N")


#: Pairs that are looked at together.
PAIR_RUN = 4


def unpivot_pairs(df: DataFrame, ids: Sequence[str], code_fmt: str, flag_fmt: str | None,
                  n: int) -> DataFrame:
    """prj_unpivot_mao: ``DIAG_CODE_nn`` / ``DIAG_FLAG_nn`` pairs → rows; empty codes dropped,
    runs of pairs without any code at one look."""
    structs = []
    for i in range(1, n + 1):
        fields = [F.lit(i).alias("pos"), F.col(code_fmt.format(i)).alias("code")]
        if flag_fmt:
            fields.append(F.col(flag_fmt.format(i)).alias("flag"))
        structs.append(F.struct(*fields))
    runs = []
    for at in range(0, n, PAIR_RUN):
        some = reduce(lambda a, b: a | b, [F.col(code_fmt.format(i + 1)).isNotNull() for i in range(at, min(at + PAIR_RUN, n))])
        filled = F.filter(F.array(*structs[at:at + PAIR_RUN]), lambda p: p["code"].isNotNull() & (F.trim(p["code"]) != ""))
        runs.append(F.when(some, filled))
    pairs = F.concat(*[F.coalesce(r, F.array()) for r in runs]) if len(runs) > 1 else runs[0]
    return df.select(*ids, F.explode(pairs).alias("_p")).select(*ids, "_p.*")


def cc_array_from_json(df: DataFrame, list_col: str, out: str = "cc_codes") -> DataFrame:
    """prj_member_cc_array: array of JSON-like text → distinct non-empty ``CC###`` codes,
    on the array itself (no per-element columns)."""
    codes = F.transform(F.col(list_col), lambda x: F.regexp_extract(x, r'"?(?:CC|HCC)?_?(\d+)"?\s*}', 1))
    padded = F.transform(codes, lambda d: F.when(d != "", F.concat(F.lit("CC"), F.lpad(d.cast("int").cast("string"), 3, "0"))))
    return df.withColumn(out, F.array_sort(F.array_distinct(F.filter(padded, lambda x: x.isNotNull()))))


def explode_codes(df: DataFrame, list_col: str, out: str = "code") -> DataFrame:
    """prj_explode_hcc: list column → one row per element."""
    return df.select(*[c for c in df.columns if c != list_col], F.explode(list_col).alias(out))
