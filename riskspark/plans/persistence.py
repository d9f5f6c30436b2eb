"""Chronic-condition persistence (§2.9): which conditions of the last n
years are coded again this year, which are suspected, and with which
confidence.

All risk years are processed at once — the year is a join column, never a
driver loop: each prior state is expanded to the ≤ n target years it informs.
Frequencies are distinct claims of the raw rows, newest claims a total order
(D11); both are kept as one mergeable state per member, year and code. Hierarchy relations are equi joins through the
broadcast (parent, child) table, never a prior × current cross product.

``size`` is about the number of rows of the claims: groupings and joins are dealt
out over as many tasks as it needs (``joins.sized``), 0 leaves that to Spark.
States (``code_years``) are few for any member, so ``statuses`` may deal them
out once, by the member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.joins import broadcast_if_small, dealt, hashed, keys_first, placed
from riskspark.operators.sinks import is_in_place

PRIOR_YEARS = 2
OPEN_BOUND = 2 ** 31 - 1
OPEN_FREQUENCY = 999  # the highest band of the lookup has no upper bound
#: The model version is part of every key: several versions go through one plan.
M = ["version", "member_bid", "risk_year"]
KEY = [*M, "hcc"]


def chronic_source(claim_hcc: DataFrame, chronic: DataFrame) -> DataFrame:
    """per_chronic_source: rows of chronic categories only (broadcast semi join)."""
    return claim_hcc.join(broadcast_if_small(chronic.select("hcc")), "hcc", "left_semi")


def code_years(rows: DataFrame, size: int = 0) -> DataFrame:
    """The state of a code in a year, one row per member, year and code: the
    number of its claims and the newest of them (claim date, claim id, code: a
    total order). States merge: counts add up (a claim has one risk year, its
    header's) and the newest of the newest is the newest. ``rows`` may be states
    already, here and in all steps that begin with them."""
    key = [k for k in KEY if k in rows.columns]  # a frame of one version may leave it out
    if "latest" in rows.columns:  # states already
        return rows.select(*key, "frequency", "latest")
    claims = dealt(rows, key, size).groupBy(*keys_first(key), "claim_bid").agg(F.max(F.struct("claim_dt", "diag_cd")).alias("c"))
    return claims.groupBy(*keys_first(key)).agg(
        F.count("*").alias("frequency"), F.max(F.struct("c.claim_dt", "claim_bid", "c.diag_cd")).alias("latest")).select(*key, "frequency", "latest")


def _newest(state: DataFrame) -> DataFrame:
    return state.select("*", "latest.*").drop("latest")


def prior_filter(src: DataFrame, years: DataFrame, n: int = PRIOR_YEARS, size: int = 0) -> DataFrame:
    """per_prior_filter: what the last n years before each target year of
    ``years`` (risk_year: one row per year of the time-period table) say of a
    code. Claims are reduced to one state a year first; only states are
    expanded to the target years and merged there."""
    state = code_years(src, size).withColumnRenamed("risk_year", "prior_year").withColumn(
        "risk_year", F.explode(F.sequence(F.col("prior_year") + 1, F.col("prior_year") + n)))
    state = state.join(broadcast_if_small(years.select("risk_year").distinct()), "risk_year", "left_semi")
    newest = F.struct("latest.claim_dt", "latest.claim_bid", "latest.diag_cd", "prior_year")
    key = [k for k in KEY if k in state.columns]
    return _newest(dealt(state, key, size).groupBy(*keys_first(key)).agg(F.sum("frequency").alias("frequency"), F.max(newest).alias("latest"))
                   .select(*key, "frequency", "latest"))


def current_filter(claim_hcc: DataFrame, size: int = 0) -> DataFrame:
    """per_current_filter: the newest claim per member, year and code of the year itself."""
    return _newest(code_years(claim_hcc, size))


def year_codes(claim_hcc: DataFrame, size: int = 0) -> DataFrame:
    return dealt(claim_hcc.select(*KEY), KEY, size).distinct()


def suppressed_in_year(codes: DataFrame, hier: DataFrame, size: int = 0) -> DataFrame:
    """(member, year, child) whose parent is coded in the same year; min parent."""
    h = hier.select("version", "parent", "child")
    children = codes.withColumnRenamed("hcc", "parent").join(broadcast_if_small(h), ["version", "parent"]).withColumnRenamed("child", "hcc")
    return dealt(children, KEY, size).groupBy(*keys_first(KEY)).agg(F.min("parent").alias("suppressed_by")).select(*KEY, "suppressed_by")


def suppress_prior(prior: DataFrame, codes: DataFrame, hier: DataFrame, size: int = 0):
    """per_suppress_prior: (kept, removed) — a prior row is removed when its
    parent is coded in the same prior year it comes from."""
    sup = suppressed_in_year(codes, hier, size).withColumnRenamed("risk_year", "prior_year")
    j = prior.join(sup, ["version", "member_bid", "prior_year", "hcc"], "left")
    return j.where(F.col("suppressed_by").isNull()).drop("suppressed_by"), j.where(F.col("suppressed_by").isNotNull())


def suppress_current(current: DataFrame, codes: DataFrame, hier: DataFrame, size: int = 0):
    """per_suppress_current: (kept, removed) for the current year."""
    sup = suppressed_in_year(codes, hier, size)
    j = current.join(sup, KEY, "left")
    return j.where(F.col("suppressed_by").isNull()).drop("suppressed_by"), j.where(F.col("suppressed_by").isNotNull())


def prior_current_relation(prior: DataFrame, codes: DataFrame, hier: DataFrame, size: int = 0) -> DataFrame:
    """jn_prior_current_priority: for each prior (member, year, code) the
    relation to the current year's codes — SAME, CHILD_CODED (a child of the
    prior code is coded), PARENT_CODED. The broadcast hierarchy turns each code
    of the year into the prior codes it relates to; one semi join finds those."""
    h = hier.select("version", "parent", "child")
    near = h.select("version", F.col("child").alias("current_hcc"), F.col("parent").alias("hcc"), F.lit("CHILD_CODED").alias("relation")) \
        .unionByName(h.select("version", F.col("parent").alias("current_hcc"), F.col("child").alias("hcc"), F.lit("PARENT_CODED").alias("relation")))
    c = codes.select(*M, F.col("hcc").alias("current_hcc"))
    cols = [*KEY, "current_hcc", "relation"]
    related = c.withColumn("hcc", F.col("current_hcc")).withColumn("relation", F.lit("SAME")).select(*cols) \
        .unionByName(c.join(broadcast_if_small(near), ["version", "current_hcc"]).select(*cols))
    return dealt(related, KEY, size).join(hashed(prior.select(*KEY)), keys_first(KEY), "left_semi").select(*cols)


STATUS = {
    "SAME": ("Actual Persistent", "Closed Suspect", "Same HCC coded in risk year"),
    "CHILD_CODED": ("Actual Persistent", "Closed Suspect", "Lower severity HCC coded in risk year"),
    "PARENT_CODED": ("Actual NS Persistent", "Open Non Suspect", "Higher severity HCC coded in risk year"),
    "PRIOR_SUPPRESSED": ("Open NS Persistent", "Open Non Suspect", "Suppressed by parent in prior year"),
    "NONE": ("Open Persistent", "Open Suspect", "Not coded in risk year"),
}
PRIORITY = {"SAME": 1, "CHILD_CODED": 2, "PARENT_CODED": 3, "PRIOR_SUPPRESSED": 4, "NONE": 5}


def _from_map(col: str, idx: int):
    expr = None
    for k, v in STATUS.items():
        expr = (F.when(F.col(col) == k, v[idx]) if expr is None else expr.when(F.col(col) == k, v[idx]))
    return expr


def classify(prior: DataFrame, codes: DataFrame, hier: DataFrame, size: int = 0) -> DataFrame:
    """per_status (D13): one status per prior chronic (member, year, code) by
    rule priority SAME > CHILD_CODED > PARENT_CODED > PRIOR_SUPPRESSED > NONE."""
    rel = prior_current_relation(prior, codes, hier, size)
    pr = F.when(F.col("relation") == "SAME", 1).when(F.col("relation") == "CHILD_CODED", 2).otherwise(3)
    # the lowest rule, then the lowest code, in one number: groups are hashed, not sorted
    rank = F.shiftleft(pr.cast("bigint"), 32) + F.col("current_hcc") + F.lit(2 ** 31)
    best = rel.groupBy(*keys_first(KEY)).agg(F.min(rank).alias("b")).select(
        *KEY, F.element_at(F.array(F.lit("SAME"), F.lit("CHILD_CODED"), F.lit("PARENT_CODED")), F.shiftright("b", 32).cast("int")).alias("relation"),
        (F.col("b") % F.lit(2 ** 32) - F.lit(2 ** 31)).cast("int").alias("current_hcc"))
    sup = suppressed_in_year(codes, hier, size).withColumnRenamed("risk_year", "prior_year").select(
        "version", "member_bid", "prior_year", "hcc", F.lit(1).alias("_ps"))
    j = prior.join(hashed(best), keys_first(KEY), "left").join(hashed(sup), keys_first(["version", "member_bid", "prior_year", "hcc"]), "left")
    rel_final = F.coalesce(F.col("relation"), F.when(F.col("_ps") == 1, "PRIOR_SUPPRESSED"), F.lit("NONE"))
    j = j.withColumn("relation", rel_final).drop("_ps")
    return j.withColumn("persistent_status", _from_map("relation", 0)) \
        .withColumn("suspect_status", _from_map("relation", 1)) \
        .withColumn("persistent_status_reason", _from_map("relation", 2))


def new_codes(current: DataFrame, prior_codes: DataFrame, hier: DataFrame) -> DataFrame:
    """Rule 6: current code never seen in the prior years, nor any parent of it."""
    h = broadcast_if_small(hier.select("version", "parent", "child"))
    seen = prior_codes.select(*KEY)
    seen_parent = prior_codes.select(*M, F.col("hcc").alias("parent")).join(h, ["version", "parent"]) \
        .select(*M, F.col("child").alias("hcc"))
    return current.join(hashed(seen), keys_first(KEY), "left_anti").join(hashed(seen_parent), keys_first(KEY), "left_anti") \
        .withColumn("persistent_status", F.lit("New")).withColumn("suspect_status", F.lit(None).cast("string")) \
        .withColumn("persistent_status_reason", F.lit("New HCC"))


def with_duration(df: DataFrame) -> DataFrame:
    """per_duration: |days| between Jan 1 of the risk year and the claim date."""
    return df.withColumn("duration", F.abs(F.datediff(F.make_date("risk_year", F.lit(1), F.lit(1)), F.col("claim_dt"))))


def confidence_lookup(df: DataFrame, table: DataFrame) -> DataFrame:
    """jn_confidence_lookup: the weight at the least bound that the duration does
    not exceed, by frequency band; a null bound is open-ended and takes every
    longer duration. The bounds may be uneven: they are one sorted array
    (a scalar subquery), searched in each row, then an equi join on the bound
    found with the frequency band as condition; no band → null (D23)."""
    bound = F.coalesce("last_bound", F.lit(OPEN_BOUND))
    t = table.select(bound.alias("_L"), "freq_min", "freq_max", F.col("weight").alias("confidence_factor"))
    bounds = table.agg(F.array_sort(F.collect_set(bound))).scalar()
    j = df.withColumn("_bounds", bounds).withColumn("_L", F.array_min(F.filter("_bounds", lambda b: b >= F.col("duration")))).drop("_bounds")
    j = j.join(broadcast_if_small(t), (j["_L"] == t["_L"]) & (F.col("frequency") >= F.col("freq_min"))
               & ((F.col("frequency") <= F.col("freq_max")) | (F.col("freq_max") == OPEN_FREQUENCY)), "left")
    return j.drop("_L", "freq_min", "freq_max")


def statuses(claim_hcc: DataFrame, chronic: DataFrame, hier: DataFrame, lookup: DataFrame,
             years: DataFrame, n: int = PRIOR_YEARS, size: int = 0) -> DataFrame:
    """Full classification for every target year: prior-based rows plus new
    codes; Open Suspect rows carry duration and confidence (per_confidence).
    The claims (or their states) are reduced to states once. In a plan done in
    place (``sinks.in_place``) these are dealt out by the member, and all later
    steps are done there; else each step deals them out by its own keys."""
    states = code_years(claim_hcc, size)
    if size and is_in_place(states.sparkSession):
        (states,), size = placed([states], size, ["member_bid"]), 0
    codes = year_codes(states, size)
    prior = prior_filter(chronic_source(states, chronic), years, n, size)
    cls = with_duration(classify(prior, codes, hier, size))
    # only open suspects look for a band: a null duration finds none
    is_open = F.col("suspect_status") == "Open Suspect"
    asked = cls.withColumn("_days", F.col("duration")).withColumn("duration", F.when(is_open, F.col("duration")))
    found = confidence_lookup(asked, lookup).withColumn("duration", F.col("_days"))
    cur = current_filter(states, size).withColumn("prior_year", F.lit(None).cast("int")) \
        .withColumn("relation", F.lit("NEW")).withColumn("current_hcc", F.col("hcc"))
    new = with_duration(new_codes(cur, prior.select(*KEY), hier)).withColumn(
        "confidence_factor", F.lit(None).cast("double"))
    cols = ["version", "member_bid", "risk_year", "hcc", "prior_year", "claim_bid", "claim_dt", "diag_cd", "frequency",
            "relation", "persistent_status", "suspect_status", "persistent_status_reason", "duration",
            "confidence_factor"]
    return found.select(*cols).unionByName(new.select(*cols))


def year_flags(codes: DataFrame, chronic: DataFrame, years: DataFrame, size: int = 0) -> DataFrame:
    """per_year_flags: presence in the year and the two before, persistence
    flag (all three), carry-forward eligible (≥ 2 prior years and chronic)."""
    e = codes.withColumn("_off", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))) \
        .withColumn("target_year", F.col("risk_year") + F.col("_off")) \
        .join(broadcast_if_small(years.select(F.col("risk_year").alias("target_year")).distinct()), "target_year", "left_semi")
    key = ["version", "member_bid", "target_year", "hcc"]
    g = dealt(e, key, size).groupBy(*key).agg(
        *[F.max(F.when(F.col("_off") == i, 1).otherwise(0)).alias(f"in_y{i}") for i in range(3)])
    g = g.join(broadcast_if_small(chronic.select("hcc", "chronic")), "hcc", "left")
    return g.select(
        "member_bid", F.col("target_year").alias("risk_year"), "hcc", "in_y0", "in_y1", "in_y2",
        ((F.col("in_y0") + F.col("in_y1") + F.col("in_y2")) == 3).cast("int").alias("persistent_flag"),
        (((F.col("in_y1") + F.col("in_y2")) >= 2) & (F.coalesce("chronic", F.lit(0)) == 1)).cast("int")
        .alias("carry_forward_eligible"))
