"""Risk scoring: diagnoses → condition categories → scores, per member,
risk year and model version.

Shape of the plan (one shuffle on the member key per stage; every rule table
is broadcast — they are fixed-size config, not data):

  enrollment ──explode(bounded years)──┐
  member ─────────────────────────────┴─ population (member, year) ⋈ ages
  claim lines ─ diagnoses (distinct member, year, code)
      ⋈ population ─ explode(versions) ─⋈ⁿ icd map ─ SEDITS fold ─ distinct
      ─ hierarchy anti join ─ coefficient join ─ Σ per member
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark import functions as RF
from riskspark.operators.joins import broadcast_if_small, hashed
from riskspark.sources import reference_data as R

MEMBER_YEAR = ["member_bid", "risk_year"]
MEMBER_KEYS = ["member_bid", "risk_year", "version"]


def enrollment_years(enrollment: DataFrame, current_year: int = R.CURRENT_YEAR) -> DataFrame:
    """prj_enrollment_split: one row per calendar year of coverage.

    Only the open end date (9999-12-31) is capped, to ``current_year``, so one
    row cannot explode into thousands; genuine end dates keep their years.
    """
    y0 = F.year("covrg_begin_dt")
    y1 = F.when(F.year("covrg_end_dt") == 9999, F.greatest(y0, F.lit(current_year))).otherwise(F.year("covrg_end_dt"))
    e = enrollment.where(y0 <= y1)
    out = e.select("*", F.explode(F.sequence(y0, y1)).alias("risk_year"))
    return out.select(
        "*",
        F.greatest("covrg_begin_dt", F.make_date("risk_year", F.lit(1), F.lit(1))).alias("year_begin_dt"),
        F.least("covrg_end_dt", F.make_date("risk_year", F.lit(12), F.lit(31))).alias("year_end_dt"),
    )


def member_population(member: DataFrame, enrollment: DataFrame, periods: DataFrame) -> DataFrame:
    """Member-years in coverage with age (Feb 1 of the payment year),
    disability flags and the model segment inputs."""
    cal = periods.where(F.col("period_type") == "C").select(
        "risk_year", "time_period", "begin_date", "end_date", "period_type")
    ey = enrollment_years(enrollment).select("member_bid", "risk_year").distinct()
    pop = ey.join(broadcast_if_small(cal), "risk_year").join(member, "member_bid")
    ref = RF.payment_year_reference_date("period_type", "begin_date", "end_date")
    pop = pop.withColumn("age_yr", RF.age_as_of("memb_brth_dt", ref))
    return with_origds(pop)


def with_origds(df: DataFrame) -> DataFrame:
    """prj_origds: DISABL = age<65 and OREC<>'0'; ORIGDS = OREC='1' and not DISABL."""
    disabl = ((F.col("age_yr") < 65) & (F.col("orec") != "0")).cast("int")
    return df.withColumn("disabl", disabl).withColumn(
        "origds", ((F.col("orec") == "1") & (F.col("disabl") == 0)).cast("int"))


def with_segment(df: DataFrame, rules: Sequence[tuple] = R.SEGMENT_RULES,
                 default: str = R.DEFAULT_SEGMENT) -> DataFrame:
    """prj_community_model: first matching condition by priority, else default."""
    ordered = [(cond, seg) for _, cond, seg in sorted(rules, key=lambda r: r[0])]
    return df.withColumn("model_segment", RF.first_match(ordered, default))


def with_versions(df: DataFrame, versions: Sequence[str] = R.VERSIONS) -> DataFrame:
    return df.withColumn("version", F.explode(F.array(*[F.lit(v) for v in versions])))


def member_diagnoses(claim_lines: DataFrame, claim_types=(1, 2, 3)) -> DataFrame:
    """Distinct coded diagnoses per member and risk year (types 1–3)."""
    return (claim_lines.where(F.col("clm_tp_cd").isin(*claim_types))
            .select("member_bid", "risk_year", "diag_cd").distinct())


def map_icd_to_hcc(diag: DataFrame, icd_map: DataFrame) -> DataFrame:
    """jn_icd_hcc: left broadcast join on (version, code); unmapped keep a null hcc."""
    return diag.join(broadcast_if_small(icd_map), ["version", "diag_cd"], "left")


def apply_sedits(df: DataFrame, rules: Sequence[tuple] = R.SEDITS_RULES,
                 lists: Sequence[tuple] = R.SEDITS_LISTS) -> DataFrame:
    """prj_sedits: per version, ordered ``when`` fold; later rule wins; −1 = excluded."""
    codes: dict[str, list[str]] = {}
    for name, code in lists:
        codes.setdefault(name, []).append(code)
    folded = []
    for version, _, cond, list_name, value in sorted(rules, key=lambda r: (r[0], r[1])):
        folded.append(((F.col("version") == version) & F.expr(cond)
                       & F.col("diag_cd").isin(*codes.get(list_name, [])), value))
    return df.withColumn("hcc", RF.rule_fold(F.col("hcc"), folded))


def apply_hierarchy(member_hcc: DataFrame, hierarchy_pairs: DataFrame,
                    keys: Sequence[str] = MEMBER_KEYS) -> DataFrame:
    """rsk_hierarchy: drop a child category when its parent is present for the
    same member keys (left anti join on the exploded hierarchy)."""
    keys = list(keys)
    suppressed = (member_hcc.select(*keys, F.col("hcc").alias("parent"))
                  .join(broadcast_if_small(hierarchy_pairs), ["version", "parent"])
                  .select(*keys, F.col("child").alias("hcc")))
    return member_hcc.join(hashed(suppressed), keys + ["hcc"], "left_anti")


def flag_hierarchy(member_hcc: DataFrame, hierarchy_pairs: DataFrame,
                   keys: Sequence[str] = MEMBER_KEYS) -> DataFrame:
    """Flag form: every row kept, ``suppressed`` 1/0 and the lowest suppressing parent."""
    keys = list(keys)
    sup = (member_hcc.select(*keys, F.col("hcc").alias("parent"))
           .join(broadcast_if_small(hierarchy_pairs), ["version", "parent"])
           .groupBy(*keys, F.col("child").alias("hcc")).agg(F.min("parent").alias("suppressed_by")))
    return member_hcc.join(sup, keys + ["hcc"], "left").withColumn(
        "suppressed", F.col("suppressed_by").isNotNull().cast("int"))


def scored_hccs(population: DataFrame, diag: DataFrame, icd_map: DataFrame,
                hierarchy_pairs: DataFrame) -> DataFrame:
    """Member-year-version condition categories after SEDITS and hierarchy."""
    d = diag.join(population.select(*MEMBER_YEAR, "age_yr", "memb_gender_cd", "model_segment"), MEMBER_YEAR)
    d = with_versions(d)
    d = apply_sedits(map_icd_to_hcc(d, icd_map))
    hcc = (d.where(F.col("hcc").isNotNull() & (F.col("hcc") != -1))
           .select(*MEMBER_KEYS, "model_segment", "hcc").distinct())
    return apply_hierarchy(hcc, hierarchy_pairs)


def coefficient_lookup(df: DataFrame, coeffs: DataFrame, name_col: str, out: str) -> DataFrame:
    """jn_coefficients: broadcast left join on (version, upper(trim(name)))."""
    c = coeffs.select(F.col("version").alias("_cv"), F.upper(F.trim("name")).alias("_ck"),
                      F.col("score").alias(out))
    j = df.join(broadcast_if_small(c), (F.col("version") == F.col("_cv")) &
                (F.upper(F.trim(F.col(name_col))) == F.col("_ck")), "left")
    return j.drop("_cv", "_ck")


def hcc_scores(hcc: DataFrame, coeffs: DataFrame) -> DataFrame:
    """Σ HCC coefficients, distinct count and the count-payment score per member."""
    named = hcc.withColumn("coeff_name", RF.hcc_coeff_name("model_segment", "hcc"))
    s = coefficient_lookup(named, coeffs, "coeff_name", "coeff")
    per = s.groupBy(*MEMBER_KEYS, "model_segment").agg(
        F.sum(F.coalesce("coeff", F.lit(0.0))).alias("hcc_score"),
        F.countDistinct("hcc").alias("hcc_count"))
    per = per.withColumn("count_name", RF.count_coeff_name("model_segment", "hcc_count"))
    per = coefficient_lookup(per, coeffs, "count_name", "count_score")
    return per.withColumn("count_score", F.coalesce("count_score", F.lit(0.0))).drop("count_name")


def group_interactions(hcc: DataFrame, rules: DataFrame) -> DataFrame:
    """rsk_interactions_group: ≥1 code of the primary AND ≥1 of the secondary
    group → rule score. One broadcast join tags each member code with the
    (rule, side) pairs it belongs to, one aggregation per member and rule
    checks both sides — no cross product, no per-member list."""
    prim = rules.select("interaction_name", "score", F.explode(RF.split_codes("primary_group")).alias("code"),
                        F.lit(1).alias("_p"), F.lit(0).alias("_s"))
    sec = rules.select("interaction_name", "score", F.explode(RF.split_codes("secondary_group")).alias("code"),
                       F.lit(0).alias("_p"), F.lit(1).alias("_s"))
    sides = prim.unionByName(sec)
    h = hcc.select(*MEMBER_KEYS, F.col("hcc").cast("string").alias("code"))
    g = h.join(broadcast_if_small(sides), "code").groupBy(*MEMBER_KEYS, "interaction_name", "score") \
        .agg(F.max("_p").alias("_p"), F.max("_s").alias("_s"))
    return g.where((F.col("_p") == 1) & (F.col("_s") == 1)).select(*MEMBER_KEYS, "interaction_name", "score")


def risk_scores(population: DataFrame, hcc: DataFrame, coeffs: DataFrame,
                group_rules: DataFrame, factors: DataFrame, weights: DataFrame) -> DataFrame:
    """rsk_raw → rsk_normalized → rsk_payment → rsk_weighted, one row per
    member, year and version (members without codes keep demographics)."""
    pop = with_versions(population)
    pop = pop.withColumn("demog_name", RF.demog_coeff_name("model_segment", "memb_gender_cd", "age_yr"))
    pop = coefficient_lookup(pop, coeffs, "demog_name", "demog_score")
    pop = pop.withColumn("origds_name", RF.origds_coeff_name("model_segment", "memb_gender_cd"))
    pop = coefficient_lookup(pop, coeffs, "origds_name", "origds_coeff")
    pop = pop.withColumn("origds_score", F.when(F.col("origds") == 1, F.col("origds_coeff")).otherwise(0.0))

    hs = hcc_scores(hcc, coeffs).drop("model_segment")
    it = group_interactions(hcc, group_rules).groupBy(*MEMBER_KEYS).agg(
        F.sum("score").alias("interaction_score"))
    out = pop.join(hs, MEMBER_KEYS, "left").join(it, MEMBER_KEYS, "left")
    z = F.lit(0.0)
    raw = (F.coalesce("demog_score", z) + F.coalesce("hcc_score", z) + F.coalesce("count_score", z)
           + F.coalesce("interaction_score", z) + F.coalesce("origds_score", z))
    f = factors.select(F.lower("version").alias("version"), "normalization_factor", "coding_pattern_adjustment")
    out = (out.withColumn("raw_score", F.round(raw, 3))
           .join(broadcast_if_small(f), "version", "left")
           .join(broadcast_if_small(weights), "version", "left"))
    out = out.withColumn("normalized_score", F.round(F.col("raw_score") / F.col("normalization_factor"), 3))
    out = out.withColumn("payment_score",
                         F.round(F.col("normalized_score") * (F.lit(1.0) - F.col("coding_pattern_adjustment")), 3))
    out = out.withColumn("weighted_score", F.round(F.col("payment_score") * F.col("weight"), 3))
    return out.select(
        "member_bid", "risk_year", "version", "time_period", "model_segment", "age_yr",
        "memb_gender_cd",
        F.round(F.coalesce("demog_score", z), 3).alias("demog_score"),
        F.round(F.coalesce("hcc_score", z), 3).alias("hcc_score"),
        F.coalesce("hcc_count", F.lit(0)).cast("bigint").alias("hcc_count"),
        F.round(F.coalesce("count_score", z), 3).alias("count_score"),
        F.round(F.coalesce("interaction_score", z), 3).alias("interaction_score"),
        F.round(F.coalesce("origds_score", z), 3).alias("origds_score"),
        "raw_score", "normalized_score", "payment_score", "weighted_score",
    )


def blended_scores(scores: DataFrame) -> DataFrame:
    """rsk_blended: Σ weighted score over versions per member and period."""
    return scores.groupBy("member_bid", "risk_year", "time_period").agg(
        F.round(F.sum("weighted_score"), 3).alias("blended_score"),
        F.count("*").alias("n_versions"))


def hcc_pairs(hcc: DataFrame, pair_rules: DataFrame, keys: Sequence[str] = MEMBER_KEYS) -> DataFrame:
    """jn_hcc_pairs: unordered code pairs of one member (``l.hcc < r.hcc``).

    The codes are first semi-joined to the codes that occur in any rule, so
    the per-member self join only sees a bounded, distinct set (a member with
    tens of thousands of diagnosis rows still has at most K rule codes).
    """
    keys = list(keys)
    rc = pair_rules.select(F.col("hcc1").alias("hcc")).union(pair_rules.select(F.col("hcc2").alias("hcc"))).distinct()
    f = hcc.select(*keys, "hcc").distinct().join(broadcast_if_small(rc), "hcc", "left_semi")
    left = f.select(*keys, F.col("hcc").alias("hcc1"))
    right = f.select(*keys, F.col("hcc").alias("hcc2"))
    return left.join(right, keys).where(F.col("hcc1") < F.col("hcc2"))


def pair_interactions(hcc: DataFrame, pair_rules: DataFrame, keys: Sequence[str] = MEMBER_KEYS) -> DataFrame:
    """jn_interaction_match: pair ⋈ rule on (least, greatest) — one row per
    member and interaction name."""
    r = pair_rules.select(F.least("hcc1", "hcc2").alias("hcc1"), F.greatest("hcc1", "hcc2").alias("hcc2"),
                          "interaction_name", "score")
    return hcc_pairs(hcc, pair_rules, keys).join(broadcast_if_small(r), ["hcc1", "hcc2"]) \
        .select(*keys, "interaction_name", "hcc1", "hcc2", "score")


def interaction_multiplier(pairs: DataFrame, mult_rules: DataFrame, keys: Sequence[str] = MEMBER_KEYS) -> DataFrame:
    """jn_interaction_multiplier: pair ⋈ multiplier rule on **both** codes
    (AND, D5), ``coalesce(multiplier, 1.0)``; member adjustment Σ(mult − 1)."""
    m = mult_rules.select("hcc1", "hcc2", "multiplier")
    j = pairs.join(broadcast_if_small(m), ["hcc1", "hcc2"], "left").withColumn(
        "multiplier", F.coalesce("multiplier", F.lit(1.0)))
    return j


def hcc_detail(claim_diag: DataFrame, population: DataFrame, icd_map: DataFrame,
               retained: DataFrame) -> DataFrame:
    """rsk_hcc_detail: one row per member, version, code and claim with the
    R (retained) / S (suppressed by hierarchy) / X (excluded by SEDITS) flag."""
    d = claim_diag.join(population.select(*MEMBER_YEAR, "age_yr", "memb_gender_cd"), MEMBER_YEAR)
    d = apply_sedits(map_icd_to_hcc(with_versions(d), icd_map)).where(F.col("hcc").isNotNull())
    r = retained.select(*MEMBER_KEYS, "hcc").withColumn("_r", F.lit(1))
    j = d.join(r, MEMBER_KEYS + ["hcc"], "left")
    ind = F.when(F.col("hcc") == -1, "X").when(F.col("_r").isNotNull(), "R").otherwise("S")
    return j.select(*MEMBER_KEYS, "claim_bid", "diag_cd", "hcc",
                    F.when(F.col("hcc") == -1, F.lit("HCC-1")).otherwise(RF.hcc_detail_id(F.col("hcc").cast("string")))
                    .alias("risk_type_detail_id"), ind.alias("suppression_ind"))


def member_output(scores: DataFrame, detail: DataFrame, coeffs: DataFrame) -> DataFrame:
    """rsk_output: member-level scores with the two trace lists
    (diagnosis → category, category → score), each sorted for determinism."""
    d = detail.select(*MEMBER_KEYS, "diag_cd", "hcc").distinct()
    dl = d.groupBy(*MEMBER_KEYS).agg(F.array_join(F.array_sort(F.collect_list(
        F.concat_ws(":", "diag_cd", F.col("hcc").cast("string")))), ";").alias("diag_to_hcc_list"))
    seg = scores.select(*MEMBER_KEYS, "model_segment")
    hs = detail.where(F.col("suppression_ind") == "R").select(*MEMBER_KEYS, "hcc").distinct().join(seg, MEMBER_KEYS)
    hs = hs.withColumn("coeff_name", RF.hcc_coeff_name("model_segment", "hcc"))
    hs = coefficient_lookup(hs, coeffs, "coeff_name", "coeff")
    hl = hs.groupBy(*MEMBER_KEYS).agg(F.array_join(F.array_sort(F.collect_list(
        F.concat_ws(":", "coeff_name", F.format_number(F.coalesce("coeff", F.lit(0.0)), 3)))), ";")
        .alias("hcc_to_score_list"))
    return scores.join(dl, MEMBER_KEYS, "left").join(hl, MEMBER_KEYS, "left")
