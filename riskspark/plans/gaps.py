"""Gap suspecting (§2.10): conditions a member probably has but that are not
coded this year, from prescriptions, codes and procedures, with look-back
exclusions, hierarchy suppression and a combined confidence.

Plan shape and scale notes:
* every method rule / code group table is broadcast (fixed-size config);
* the OR join "diagnosis OR procedure OR principal procedure" is split into
  one equi join per code type + union (an OR condition would plan as a
  nested-loop join);
* the 180-day look-back is an equi join on (member, day bucket) with an
  exact ``datediff`` residual: exclusion evidence is first reduced to distinct
  (member, day), so a trigger meets at most 2 × 181 candidate days however
  many claims one member has — a hot member cannot blow up the join;
* per-member code lists are never collected: suppression and matching are
  semi/anti joins on (member, year, code).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark import functions as RF
from riskspark.operators.joins import broadcast_if_small, hashed, keys_first
from riskspark.sources import reference_data as R

#: Rules, codes and categories of several model versions go through one plan; the version is part of every key.
GAP_KEY = ["version", "member_bid", "risk_year", "cc_code"]
DRAFT_COLS = ["version", "member_bid", "risk_year", "method_id", "claim_bid", "claim_dt", "claim_type",
              "claim_cd_type", "claim_cd", "cc_id", "cc_code", "qualified_claim", "qualify_claims"]


def rules_inclusion(rules: DataFrame, method_id: int, program: str = "CMS") -> DataFrame:
    """gap_rules_inclusion: rules of one method without modifier or exclusion."""
    return rules.where((F.col("method_id") == method_id) & (F.col("program") == program)
                       & F.col("exclusion_cd").isNull() & F.col("modifier_cd").isNull())


def _draft(df: DataFrame) -> DataFrame:
    return df.withColumn("cc_code", RF.cc_code("cc_id")).select(*DRAFT_COLS)


def m1_pharmacy(pharmacy: DataFrame, rules: DataFrame) -> DataFrame:
    """gap_m1_pharmacy / jn_pharmacy_method: NDC rule ⋈ pharmacy claim; all
    rows create a gap, claim type 4. The type filter is on the rule side."""
    r = rules_inclusion(rules, 1).where(F.col("claim_cd_type") == "NDC")
    j = pharmacy.join(broadcast_if_small(r), pharmacy["prod_serv_id_cd"] == r["claim_cd"])
    return _draft(j.select(
        "version", "member_bid", F.year("serv_dt").alias("risk_year"), "method_id", "claim_bid",
        F.col("serv_dt").alias("claim_dt"), F.lit(4).alias("claim_type"), "claim_cd_type", "claim_cd",
        "cc_id", "qualified_claim", F.lit("Y").alias("qualify_claims")))


CODE_COLUMN = {"DIAGNOSIS": "diag_cd", "CPT-HCPCS": "cpt_cd", "ICD-PROC": "princ_proc_cd"}


def any_code_join(claims: DataFrame, rules: DataFrame) -> DataFrame:
    """jn_any_code_method: a rule matches the claim's diagnosis, procedure or
    principal procedure depending on its code type — one equi join per type,
    unioned (never an OR join)."""
    parts = []
    for cd_type, col in CODE_COLUMN.items():
        if col not in claims.columns:
            continue
        r = rules.where(F.col("claim_cd_type") == cd_type)
        parts.append(claims.join(broadcast_if_small(r), claims[col] == r["claim_cd"]))
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_rule_code(claims: DataFrame, rules: DataFrame, groups: DataFrame) -> DataFrame:
    """The claim lines that any rule, modifier or exclusion can match: those
    with a code of its type among the rules or the code groups."""
    codes = rules.select("claim_cd_type", F.col("claim_cd").alias("code")).unionByName(groups.select("claim_cd_type", "code")).distinct()
    out, found = claims, []
    for cd_type, col in CODE_COLUMN.items():
        if col in claims.columns:
            known = codes.where(F.col("claim_cd_type") == cd_type).select(F.col("code").alias(col), F.lit(True).alias(f"_{col}"))
            out = out.join(broadcast_if_small(known), col, "left")
            found.append(F.col(f"_{col}"))
    return out.where(F.coalesce(*found, F.lit(False))).select(*claims.columns)


def _claim_draft(j: DataFrame) -> DataFrame:
    return _draft(j.select(
        "version", "member_bid", "risk_year", "method_id", "claim_bid", "claim_dt",
        F.col("clm_tp_cd").alias("claim_type"), "claim_cd_type", "claim_cd", "cc_id",
        "qualified_claim", "qualify_claims"))


def m2_codes(claims: DataFrame, rules: DataFrame) -> DataFrame:
    """gap_m2_codes: any code → draft gap (distinct per claim and rule)."""
    return _claim_draft(any_code_join(claims, rules_inclusion(rules, 2))).distinct()


def m10_inclusion(claims: DataFrame, rules: DataFrame) -> DataFrame:
    """gap_m10_inclusion: procedure-only version of M2."""
    r = rules_inclusion(rules, 10).where(F.col("claim_cd_type") == "CPT-HCPCS")
    return _claim_draft(claims.join(broadcast_if_small(r), claims["cpt_cd"] == r["claim_cd"])).distinct()


def expand_groups(groups: DataFrame, group_col_alias: str = "group_cd") -> DataFrame:
    """jn_codegroup_expand: group name → member codes (broadcast side)."""
    return groups.select(F.col("group_cd").alias(group_col_alias), "claim_cd_type", "code")


def modifier_same_claim(triggers: DataFrame, claims: DataFrame, groups: DataFrame) -> DataFrame:
    """jn_modifier_same_claim: keep trigger rows whose claim carries a code of
    the rule's modifier group (semi join on (claim, group))."""
    g = expand_groups(groups, "modifier_cd").drop("claim_cd_type")
    mods = claims.select("claim_bid", F.col("cpt_cd").alias("code")).distinct() \
        .join(broadcast_if_small(g), "code").select("claim_bid", "modifier_cd").distinct()
    return triggers.join(mods, ["claim_bid", "modifier_cd"], "left_semi")


def _day(c):
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


def lookback_exclusion(triggers: DataFrame, claims: DataFrame, groups: DataFrame,
                       days: int = R.LOOKBACK_DAYS) -> DataFrame:
    """jn_lookback_exclusion: for each trigger row, does the member have a
    diagnosis of the rule's **own** exclusion group (D16) in the ``days`` days
    up to and including the claim date? Adds ``excluded`` (0/1),
    ``excl_diag_cd`` and ``excl_dt`` (the minimum matched code / date).

    Equi join on (member, group, bucket) where bucket = day // (days+1);
    the trigger probes its own bucket and the one before, the residual
    ``0 <= datediff <= days`` is exact.
    """
    width = days + 1
    g = expand_groups(groups, "exclusion_cd").where(F.col("claim_cd_type") == "DIAGNOSIS").drop("claim_cd_type")
    ev = (claims.select("member_bid", F.col("diag_cd").alias("code"), F.col("claim_dt").alias("excl_dt"))
          .join(broadcast_if_small(g), "code")
          .select("member_bid", "exclusion_cd", F.col("code").alias("excl_diag_cd"), "excl_dt").distinct()
          .withColumn("_b", F.floor(_day("excl_dt") / width)))
    asked = ["member_bid", "exclusion_cd", "claim_dt"]  # all that the answer depends on
    probe = triggers.select(*asked).distinct().withColumn(
        "_b", F.explode(F.array(F.floor(_day("claim_dt") / width), F.floor(_day("claim_dt") / width) - 1)))
    hits = (probe.join(ev, ["member_bid", "exclusion_cd", "_b"])
            .where(F.datediff("claim_dt", "excl_dt").between(0, days))
            .groupBy(*asked).agg(F.min("excl_diag_cd").alias("excl_diag_cd"), F.min("excl_dt").alias("excl_dt")))
    return triggers.join(hits, asked, "left").withColumn("excluded", F.col("excl_dt").isNotNull().cast("int"))


def m10_scenario_triggers(claims: DataFrame, rules: DataFrame, with_modifier: bool) -> DataFrame:
    r = rules.where((F.col("method_id") == 10) & (F.col("claim_cd_type") == "CPT-HCPCS")
                    & F.col("exclusion_cd").isNotNull())
    r = r.where(F.col("modifier_cd").isNotNull() if with_modifier else F.col("modifier_cd").isNull())
    return claims.join(broadcast_if_small(r), claims["cpt_cd"] == r["claim_cd"]).select(
        "version", "member_bid", "risk_year", "method_id", "claim_bid", "claim_dt",
        F.col("clm_tp_cd").alias("claim_type"), "claim_cd_type", "claim_cd", "cc_id",
        "qualified_claim", "qualify_claims", "modifier_cd", "exclusion_cd").distinct()


def m10_scenario1(claims: DataFrame, rules: DataFrame, groups: DataFrame) -> DataFrame:
    """gap_m10_scenario1: trigger + modifier on the same claim + no exclusion
    diagnosis of its own group in the 180 days up to the claim."""
    t = modifier_same_claim(m10_scenario_triggers(claims, rules, True), claims, groups)
    x = lookback_exclusion(t, claims, groups)
    return _draft(x.where(F.col("excluded") == 0))


def m10_scenario2(claims: DataFrame, rules: DataFrame, groups: DataFrame) -> DataFrame:
    """gap_m10_scenario2: trigger without modifier + look-back exclusion."""
    x = lookback_exclusion(m10_scenario_triggers(claims, rules, False), claims, groups)
    return _draft(x.where(F.col("excluded") == 0))


def code_matches(claims: DataFrame, rules: DataFrame, method_ids=(2, 10)) -> DataFrame:
    """One pass over the claims for every code rule: each line contributes its
    (type, code) pairs — diagnosis, procedure (and principal procedure when
    present) — and one broadcast equi join on (type, code) matches all rules
    of the given methods at once."""
    pairs = [F.struct(F.lit(t).alias("claim_cd_type"), F.col(c).alias("code")) for t, c in CODE_COLUMN.items()
             if c in claims.columns]
    exploded = claims.select("member_bid", "risk_year", "claim_bid", "claim_dt", "clm_tp_cd", "qualify_claims",
                             F.explode(F.array(*pairs)).alias("_p")).select("*", "_p.*").drop("_p")
    r = rules.where(F.col("method_id").isin(*method_ids) & (F.col("program") == "CMS"))
    r = r.select("version", "method_id", "claim_cd_type", F.col("claim_cd").alias("code"), "claim_cd", "cc_id", "qualified_claim",
                 "modifier_cd", "exclusion_cd")
    return exploded.join(broadcast_if_small(r), ["claim_cd_type", "code"]).drop("code")


def all_methods(claims: DataFrame, pharmacy: DataFrame, rules: DataFrame, groups: DataFrame,
                extra: Sequence[DataFrame] = ()) -> DataFrame:
    """set_union_methods: every method's draft rows, ``unionByName``.

    Codes are matched once (``code_matches``); inclusion rules (no modifier,
    no exclusion) give M2 / M10-inclusion rows; M10 triggers of both
    scenarios go through one modifier semi join (scenario 1 only) and one
    look-back exclusion."""
    m = code_matches(claims, rules)
    draft_cols = ["version", "member_bid", "risk_year", "method_id", "claim_bid", "claim_dt", F.col("clm_tp_cd").alias("claim_type"),
                  "claim_cd_type", "claim_cd", "cc_id", "qualified_claim", "qualify_claims"]
    incl = m.where(F.col("modifier_cd").isNull() & F.col("exclusion_cd").isNull())
    m2 = _draft(incl.where(F.col("method_id") == 2).select(*draft_cols)).distinct()
    m10i = _draft(incl.where((F.col("method_id") == 10) & (F.col("claim_cd_type") == "CPT-HCPCS"))
                  .select(*draft_cols)).distinct()
    trig = m.where((F.col("method_id") == 10) & (F.col("claim_cd_type") == "CPT-HCPCS") & F.col("exclusion_cd").isNotNull()) \
        .select(*draft_cols, "modifier_cd", "exclusion_cd").distinct()
    with_mod = modifier_same_claim(trig.where(F.col("modifier_cd").isNotNull()), claims, groups)
    t = with_mod.unionByName(trig.where(F.col("modifier_cd").isNull()))
    scen = _draft(lookback_exclusion(t, claims, groups).where(F.col("excluded") == 0))
    frames = [m1_pharmacy(pharmacy, rules), m2, m10i, scen, *extra]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_create_flag(draft: DataFrame) -> DataFrame:
    """Qualified-claim rule: a rule that demands a qualified claim creates a gap
    only on one (null qualification counts as not qualified)."""
    ok = (F.col("qualified_claim") == 0) | (F.coalesce(F.col("qualify_claims"), F.lit("N")) == "Y")
    if "create_gap" in draft.columns:  # method 4 says itself which rows are gaps
        ok = ok & (F.coalesce("create_gap", F.lit("Y")) == "Y")
    return draft.withColumn("draft_status", F.when(ok, "Create Gap").otherwise("No Gap")) \
        .withColumn("draft_reason", F.when(ok, F.lit(None).cast("string")).otherwise("Claim not qualified"))


def member_gaps(draft: DataFrame) -> DataFrame:
    """Distinct "Create Gap" rows per member, year, method and code."""
    return (with_create_flag(draft).where(F.col("draft_status") == "Create Gap")
            .select("version", "member_bid", "risk_year", "method_id", "cc_id", "cc_code").distinct())


def suppression1(gaps: DataFrame, hierarchy_pairs: DataFrame) -> DataFrame:
    """gap_suppress1: a child is suppressed by a parent gap **in the same
    method**; ``suppressed_by_parent`` = min parent code."""
    h = hierarchy_pairs.select("version", "parent", "child")
    par = gaps.select("version", "member_bid", "risk_year", "method_id", F.col("cc_id").alias("parent")) \
        .join(broadcast_if_small(h), ["version", "parent"]) \
        .groupBy("member_bid", "risk_year", F.col("child").alias("cc_id"), "method_id", "version") \
        .agg(F.min("parent").alias("_p"))
    out = gaps.join(hashed(par), ["member_bid", "risk_year", "cc_id", "method_id", "version"], "left")
    return out.withColumn("suppression1_yn", F.when(F.col("_p").isNotNull(), "Y").otherwise("N")) \
        .withColumn("suppressed_by_parent", F.when(F.col("_p").isNotNull(), RF.cc_code("_p"))).drop("_p")


def match_existing(gaps: DataFrame, member_hcc: DataFrame) -> DataFrame:
    """jn_member_existing_cc: ``matching_yn`` = the code is already coded for
    the member in the year (left join on a distinct right side + flag)."""
    m = member_hcc.select("version", "member_bid", "risk_year", F.col("hcc").alias("cc_id"), F.lit("Y").alias("_m")).distinct()
    return gaps.join(hashed(m), ["member_bid", "risk_year", "cc_id", "version"], "left") \
        .withColumn("matching_yn", F.coalesce("_m", F.lit("N"))).drop("_m")


def suppression2(gaps: DataFrame, member_hcc: DataFrame, hierarchy_pairs: DataFrame) -> DataFrame:
    """gap_suppress2: a not-yet-suppressed gap whose parent is among the
    member's coded conditions (left semi on member, year, parent)."""
    h = hierarchy_pairs.select("version", "parent", "child")
    coded_parent = member_hcc.select("version", "member_bid", "risk_year", F.col("hcc").alias("parent")).distinct() \
        .join(broadcast_if_small(h), ["version", "parent"]).select("version", "member_bid", "risk_year", F.col("child").alias("cc_id"), "parent") \
        .groupBy("version", "member_bid", "risk_year", "cc_id").agg(F.min("parent").alias("_p2"))
    out = gaps.join(hashed(coded_parent), ["member_bid", "risk_year", "cc_id", "version"], "left")
    s2 = (F.col("suppression1_yn") == "N") & F.col("_p2").isNotNull()
    return out.withColumn("suppression2_yn", F.when(s2, "Y").otherwise("N")) \
        .withColumn("suppressed_by_coded", F.when(s2, RF.cc_code("_p2"))).drop("_p2")


def cross_suppression(gaps: DataFrame, hierarchy_pairs: DataFrame) -> DataFrame:
    """gap_suppress_cross: an Open Suspect gap is suppressed by a parent gap of
    any method that is not itself Open Non Suspect; other rows pass."""
    h = hierarchy_pairs.select("version", "parent", "child")
    par = gaps.where(F.col("gap_status") != "Open Non Suspect").select("version", "member_bid", "risk_year", F.col("cc_id").alias("parent")) \
        .join(broadcast_if_small(h), ["version", "parent"]).select("version", "member_bid", "risk_year", F.col("child").alias("cc_id")).distinct()
    j = gaps.join(hashed(par.withColumn("_x", F.lit(1))), ["member_bid", "risk_year", "cc_id", "version"], "left")
    return j.withColumn("cross_suppressed", F.when((F.col("gap_status") == "Open Suspect") & F.col("_x").isNotNull(), "Y").otherwise("N")).drop("_x")


def gap_status(gaps: DataFrame) -> DataFrame:
    """gap_status (D14): matched → Closed Suspect; any suppression → Open Non
    Suspect; else Open Suspect. ``create_gap`` = Y for Open Suspect only."""
    st = (F.when(F.col("matching_yn") == "Y", "Closed Suspect")
          .when((F.col("suppression1_yn") == "Y") | (F.col("suppression2_yn") == "Y"), "Open Non Suspect")
          .otherwise("Open Suspect"))
    return gaps.withColumn("gap_status", st) \
        .withColumn("create_gap", F.when(F.col("gap_status") == "Open Suspect", "Y").otherwise("N"))


def suppressed_gaps(claims, pharmacy, rules, groups, hierarchy_pairs, member_hcc, extra=()) -> DataFrame:
    """All methods → member gaps → suppression 1 → matching → suppression 2 → status."""
    return statuses_from_draft(all_methods(claims, pharmacy, rules, groups, extra), hierarchy_pairs, member_hcc)


def statuses_from_draft(draft: DataFrame, hierarchy_pairs: DataFrame, member_hcc: DataFrame) -> DataFrame:
    return statuses_from_gaps(member_gaps(draft), hierarchy_pairs, member_hcc)


def statuses_from_gaps(g: DataFrame, hierarchy_pairs: DataFrame, member_hcc: DataFrame) -> DataFrame:
    g = suppression1(g, hierarchy_pairs)
    g = match_existing(g, member_hcc)
    g = suppression2(g, member_hcc, hierarchy_pairs)
    return gap_status(g)


def frequency_confidence(draft: DataFrame, freq: DataFrame, default_w: DataFrame) -> DataFrame:
    """gap_frequency_confidence: oldest claim per (member, year, method, code)
    (ties by claim id) + distinct-claim count; if the count equals the
    reference frequency of the rule use its weight, else the method default.
    Rows without a member, year, method or code have no frequency and go."""
    d = with_create_flag(draft).where(F.col("draft_status") == "Create Gap")
    key = ["version", "member_bid", "risk_year", "method_id", "cc_code"]
    d = d.dropna(subset=key)
    same = ["draft_status", "draft_reason"]  # of all rows left
    rest = [c for c in d.columns if c not in key and c not in same]
    by = [*keys_first(GAP_KEY), "method_id"]
    order = ["claim_dt", "claim_bid", "claim_cd"]
    # the oldest row and the number of claims are one aggregate: rows of a claim first, then claims
    row = F.struct(*order, *[c for c in rest if c not in order])
    claims = d.groupBy(*by, F.col("claim_bid").alias("_claim")).agg(F.min(row).alias("_row"))
    one = claims.groupBy(*by).agg(F.min("_row").alias("_row"), F.count("_claim").alias("frequency"))
    first = one.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest], F.lit("Create Gap").alias("draft_status"),
                       F.lit(None).cast("string").alias("draft_reason"), "frequency")
    f = freq.select("method_id", "claim_cd_type", "claim_cd", F.col("frequency").alias("_rf"), "percent_weight")
    out = first.join(broadcast_if_small(f), ["method_id", "claim_cd_type", "claim_cd"], "left") \
        .join(broadcast_if_small(default_w), "method_id", "left")
    conf = F.when(F.col("frequency") == F.col("_rf"), F.col("percent_weight")).otherwise(F.col("default_weight"))
    if "confidence_factor" in d.columns:  # method 4 brings its own
        conf = F.coalesce("confidence_factor", conf)
    return out.withColumn("confidence_factor", conf).drop("_rf", "percent_weight", "default_weight")


def method_confidence(scored: DataFrame) -> DataFrame:
    """agg_method_confidence: max confidence per member/year/code/method with
    the representative (oldest) claim picked by a total order."""
    key = ["version", "member_bid", "risk_year", "cc_code", "method_id"]
    return scored.groupBy(*keys_first(key[:-1]), "method_id").agg(
        F.max("confidence_factor").alias("method_confidence"),
        F.min_by("claim_bid", F.struct("claim_dt", "claim_bid")).alias("claim_bid"),
        F.min("claim_dt").alias("claim_dt"))


def combined_confidence(method_conf: DataFrame) -> DataFrame:
    """agg_combined_confidence: 1 − Π(1 − c) over distinct methods (noisy-OR);
    nulls dropped, all-null → 0.0 (D9)."""
    key = [k for k in GAP_KEY if k in method_conf.columns]  # a frame of one version may leave it out
    lists = method_conf.groupBy(*keys_first(key)).agg(F.collect_list("method_confidence").alias("_c"), F.collect_set("method_id").alias("_m"))
    return lists.select(
        *key, F.round(RF.noisy_or(F.col("_c")), 6).alias("combined_confidence"),
        F.array_join(F.sort_array(F.col("_m").cast("array<string>")), ",").alias("methods"),
        F.size("_m").cast("bigint").alias("n_methods"))


def m4_persistent(status: DataFrame, default_weight: float = 0.75) -> DataFrame:
    """gap_m4_persistent: persistence rows of the cycle (Open Suspect, Open Non
    Suspect, Closed Suspect) → the gap layout (method 4) with padded code;
    ``create_gap`` is Y for Open Suspect rows, which also get the confidence
    (lookup weight or the method default)."""
    s = status.where(F.col("suspect_status").isNotNull())
    is_open = F.col("suspect_status") == "Open Suspect"
    return s.select(
        "version", "member_bid", "risk_year", F.lit(4).alias("method_id"), "claim_bid", F.col("claim_dt"),
        F.lit(None).cast("int").alias("claim_type"), F.lit("PERSISTENCE").alias("claim_cd_type"),
        F.col("diag_cd").alias("claim_cd"), F.col("hcc").alias("cc_id"), RF.cc_code("hcc").alias("cc_code"),
        F.lit(0).alias("qualified_claim"), F.lit("Y").alias("qualify_claims"),
        F.when(is_open, "Y").otherwise("N").alias("create_gap"),
        F.when(is_open, F.coalesce("confidence_factor", F.lit(default_weight))).alias("confidence_factor"))


def method_consensus(method_gaps: DataFrame, priority: DataFrame, n_methods_total: int = 4,
                     keep_at: float = 0.75) -> DataFrame:
    """agg_method_consensus: distinct methods per member/year/code, share of
    all methods, kept at ≥ ``keep_at``; the representative method by priority
    (4 > 10 > 1 > 2)."""
    g = method_gaps.select("member_bid", "risk_year", "cc_code", "method_id").distinct() \
        .join(broadcast_if_small(priority), "method_id", "left")
    agg = g.groupBy("member_bid", "risk_year", "cc_code").agg(
        F.count("method_id").alias("n_methods"),
        F.array_join(F.array_sort(F.collect_list(F.col("method_id").cast("string"))), ",").alias("methods"),
        F.min(F.struct("priority", "method_id"))["method_id"].alias("primary_method"))
    agg = agg.withColumn("consensus", F.col("n_methods") / F.lit(float(n_methods_total)))
    return agg.where(F.col("consensus") >= keep_at)


def gap_interactions(gaps: DataFrame, coded: DataFrame, pair_rules: DataFrame) -> DataFrame:
    """Pair interactions that open gaps bring about: both codes of a rule are
    among the member's open gaps and coded categories of a version and year, at
    least one of them a gap. A gap counts with its confidence, a coded category
    with 1 (it wins where a code is both). One aggregate per member and rule,
    no self join: the codes a rule does not name never leave the first join, and
    repeated codes meet in the aggregate.

    ``gaps``: version, member_bid, risk_year, cc_id, combined_confidence;
    ``coded``: version, member_bid, risk_year, hcc."""
    key = ["version", "member_bid", "risk_year"]
    both = gaps.select(*key, F.col("cc_id").alias("hcc"), F.col("combined_confidence").alias("_c"), F.lit(1).alias("_gap")) \
        .unionByName(coded.select(*key, "hcc").withColumns({"_c": F.lit(1.0), "_gap": F.lit(0)}))
    side = [pair_rules.select("interaction_name", "score", F.col(c).alias("hcc"), F.lit(i).alias("_side")) for i, c in ((1, "hcc1"), (2, "hcc2"))]
    tagged = both.join(broadcast_if_small(side[0].unionByName(side[1])), "hcc")
    one = tagged.groupBy(*key, "interaction_name", "score", "_side").agg(F.min_by(F.struct("_c", "_gap"), F.struct("_gap", (-F.col("_c")).alias("c"))).alias("_b"))
    pair = one.groupBy(*key, "interaction_name", "score").agg(
        F.count("*").alias("_n"), F.max("_b._gap").alias("_any"), F.min(F.when(F.col("_side") == 1, F.col("_b._c"))).alias("_c1"),
        F.min(F.when(F.col("_side") == 2, F.col("_b._c"))).alias("_c2"))
    return pair.where("_n = 2 AND _any = 1").select(
        *key, "interaction_name", "score", F.round(F.col("_c1") * F.col("_c2"), 6).alias("confidence"))
