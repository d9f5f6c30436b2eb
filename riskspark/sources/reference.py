"""Rule tables as small Spark DataFrames.

These are the only inputs built from literal rows; every checked query joins
them to data derived from the driver's tables. They are tiny and fixed in
size (they do not grow with the data), so operators hint them for broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime as _dt
import weakref

from riskspark.sources import reference_data as R

_CACHE: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    if isinstance(v, _dt.date):
        return f"DATE'{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _df(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A local relation from literal rows (``VALUES``): planned as a
    LocalTableScan with a known size, no RDD, no Python worker. Cached per
    session so repeated uses are the same relation (exchange reuse)."""
    per = _CACHE.setdefault(spark, {})
    key = (schema, tuple(map(tuple, rows)))
    if key in per:
        return per[key]
    fields = [f.strip().split(None, 1) for f in schema.split(",")]
    names = [n for n, _ in fields]
    body = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(c{i} AS {t}) AS {n}" for i, (n, t) in enumerate(fields))
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    df = spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({aliases})")
    per[key] = df
    return df


def icd_hcc(spark: SparkSession) -> DataFrame:
    return _df(spark, R.ICD_HCC, "version string, diag_cd string, hcc int")


def hierarchy(spark: SparkSession) -> DataFrame:
    """Raw hierarchy rows: (version, parent, child list text)."""
    return _df(spark, R.HIERARCHY, "version string, parent int, child string")


def hierarchy_pairs(spark: SparkSession) -> DataFrame:
    """Exploded hierarchy: one row per (version, parent, child)."""
    h = hierarchy(spark)
    return h.select(
        "version", "parent",
        F.explode(F.split("child", ",")).alias("child_txt"),
    ).select("version", "parent", F.trim("child_txt").cast("int").alias("child"))


def coefficients(spark: SparkSession) -> DataFrame:
    """Coefficient table generated from its rule (see ``reference_data.coefficient_rows``)
    as a union of small local relations."""
    return _df(spark, R.coefficient_rows(), "version string, model string, name string, score double")


def adjustment_factors(spark: SparkSession) -> DataFrame:
    return _df(spark, R.ADJUSTMENT_FACTORS,
               "version string, model string, normalization_factor double, coding_pattern_adjustment double")


def version_weights(spark: SparkSession) -> DataFrame:
    return _df(spark, R.VERSION_WEIGHTS, "version string, weight double")


def pair_rules(spark: SparkSession) -> DataFrame:
    return _df(spark, R.PAIR_RULES, "interaction_name string, hcc1 int, hcc2 int, score double")


def group_rules(spark: SparkSession) -> DataFrame:
    return _df(spark, R.GROUP_RULES,
               "interaction_name string, primary_group string, secondary_group string, score double")


def sedits_lists(spark: SparkSession) -> DataFrame:
    return _df(spark, R.SEDITS_LISTS, "list_name string, diag_cd string")


def chronic(spark: SparkSession) -> DataFrame:
    return _df(spark, [(h, 1) for h in R.CHRONIC_HCC], "hcc int, chronic int")


def method_rules(spark: SparkSession, versions=("v28",)) -> DataFrame:
    """The method rules with the model ``version`` of their categories."""
    rows = [(v, *r) for v, rules in (("v28", R.METHOD_RULES), ("v24", R.METHOD_RULES_V24)) if v in versions for r in rules]
    return _df(spark, rows,
               "version string, method_id int, program string, claim_cd_type string, claim_cd string, "
               "modifier_type string, modifier_cd string, cc_id int, exclusion_type string, "
               "exclusion_cd string, qualified_claim int")


def models(spark: SparkSession) -> DataFrame:
    return _df(spark, R.MODELS, "model_id string, family string, map_set string, hierarchy_set string, "
               "coefficient_set string, segments string, scores_count string")


def code_groups(spark: SparkSession) -> DataFrame:
    return _df(spark, R.CODE_GROUPS, "claim_cd_type string, group_cd string, code string")


def method_frequency(spark: SparkSession) -> DataFrame:
    return _df(spark, R.METHOD_FREQUENCY,
               "method_id int, claim_cd_type string, claim_cd string, frequency int, percent_weight double")


def method_default_weight(spark: SparkSession) -> DataFrame:
    return _df(spark, R.METHOD_DEFAULT_WEIGHT, "method_id int, default_weight double")


def method_priority(spark: SparkSession) -> DataFrame:
    return _df(spark, R.METHOD_PRIORITY, "method_id int, priority int")


def time_periods(spark: SparkSession) -> DataFrame:
    return _df(spark, R.time_period_rows(),
               "time_period int, begin_date date, end_date date, period_type string, risk_year int")


def prior_year(spark: SparkSession) -> DataFrame:
    return _df(spark, R.prior_year_rows(), "last_bound int, freq_min int, freq_max int, weight double")


def qualifying_procedures(spark: SparkSession) -> DataFrame:
    lo, hi = R.QUALIFYING_PROC_RANGE
    b, e = R.QUALIFYING_PROC_VALID
    return _df(spark, [(f"C{i:03d}", b, e) for i in range(lo, hi + 1)],
               "cpt_cd string, valid_from date, valid_to date")


def place_of_service(spark: SparkSession) -> DataFrame:
    return _df(spark, R.PLACE_OF_SERVICE, "bill_prefix string, place_of_service string")


def claim_type_labels(spark: SparkSession) -> DataFrame:
    return _df(spark, R.CLAIM_TYPE_LABELS, "clm_tp_cd int, claim_type string")


def plan_exclusions(spark: SparkSession) -> DataFrame:
    return _df(spark, R.PLAN_EXCLUSIONS, "home_plan_id_cd string, method_id int, cc_id int")


def sas_model_versions(spark: SparkSession) -> DataFrame:
    return _df(spark, R.SAS_MODEL_VERSIONS, "version string, sas_model_version string")


def multiplier_rules(spark: SparkSession) -> DataFrame:
    return _df(spark, R.MULTIPLIER_RULES, "hcc1 int, hcc2 int, multiplier double")


def create_dataframe(spark: SparkSession, schema: str, rows) -> DataFrame:
    """src_rows: DataFrame from literal rows and a schema (a local relation)."""
    return _df(spark, list(rows), schema)
