"""Risk models as rows: a registry names each model's rule sets, and one plan
scores every requested model.

A registry row has the model's id and family, the code map, hierarchy and
coefficient set it uses (each a key of its rule table), the segments it covers
and whether its number of conditions is scored. The sets are joined, never
coded: a new model, or a new family that shares sets with another, is a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark import functions as RF
from riskspark.operators.joins import broadcast_if_small
from riskspark.plans import scoring as S

KEY = ["model_id", "member_bid", "risk_year"]
SETS = ["map_set", "hierarchy_set", "coefficient_set", "scores_count"]


def model_population(population: DataFrame, registry: DataFrame) -> DataFrame:
    """The member-years that each model covers, by its segments."""
    covered = registry.withColumn("model_segment", F.explode(F.split("segments", ","))).drop("segments")
    return population.join(broadcast_if_small(covered), "model_segment")


def model_conditions(members: DataFrame, diagnoses: DataFrame, icd_map: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Each model's condition categories after its code map, edits and hierarchy."""
    d = diagnoses.join(members.select(*KEY, *SETS, "model_segment", "age_yr", "memb_gender_cd"), ["member_bid", "risk_year"])
    d = d.withColumn("version", F.col("map_set")).join(broadcast_if_small(icd_map), ["version", "diag_cd"], "left")
    hcc = S.apply_sedits(d).where(F.col("hcc").isNotNull() & (F.col("hcc") != -1)) \
        .select(*KEY, "hierarchy_set", "coefficient_set", "model_segment", "hcc").distinct()
    h = hierarchy.select(F.col("version").alias("hierarchy_set"), F.col("parent").alias("hcc"), "child")
    dropped = hcc.join(broadcast_if_small(h), ["hierarchy_set", "hcc"]).select(*KEY, F.col("child").alias("hcc"))
    return hcc.join(dropped, [*KEY, "hcc"], "left_anti")


def score_models(population: DataFrame, diagnoses: DataFrame, registry: DataFrame, icd_map: DataFrame,
                 hierarchy: DataFrame, coefficients: DataFrame) -> DataFrame:
    """rsk_models: one row per model and member-year it covers."""
    members = model_population(population, registry)
    hcc = model_conditions(members, diagnoses, icd_map, hierarchy).withColumn("version", F.col("coefficient_set"))
    named = hcc.withColumn("_name", RF.hcc_coeff_name("model_segment", "hcc"))
    per = S.coefficient_lookup(named, coefficients, "_name", "_c").groupBy(*KEY).agg(
        F.sum(F.coalesce("_c", F.lit(0.0))).alias("hcc_score"), F.count("*").alias("hcc_count"))
    out = members.withColumn("version", F.col("coefficient_set")).join(per, KEY, "left") \
        .withColumns({"_demog": RF.demog_coeff_name("model_segment", "memb_gender_cd", "age_yr"),
                      "_count": F.when(F.col("scores_count") == "Y", RF.count_coeff_name("model_segment", "hcc_count"))})
    out = S.coefficient_lookup(out, coefficients, "_demog", "demog_score")
    out = S.coefficient_lookup(out, coefficients, "_count", "count_score")
    zero = F.lit(0.0)
    scores = [F.coalesce(c, zero) for c in ("demog_score", "hcc_score", "count_score")]
    return out.select(
        *KEY, "family", "model_segment", *[F.round(s, 3).alias(n) for s, n in zip(scores, ("demog_score", "hcc_score", "count_score"))],
        F.coalesce("hcc_count", F.lit(0)).alias("hcc_count"), F.round(scores[0] + scores[1] + scores[2], 3).alias("raw_score"))
