"""Shared inputs for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.operators.joins import dealt, keys_first, placed, sized
from riskspark.plans import scoring as S
from riskspark.sources import domain as D
from riskspark.sources import reference as REF


#: Calendar years that an enrollment covers, about (only the number of tasks depends on it).
COVERED_YEARS = 8


class Inputs:
    """Lazy domain tables and rule tables for one (spark, sf_dir)."""

    # expensive frames read by several consumers; with ``cut=True`` they are
    # written once to the shared folder and read back (a lineage cut that
    # also survives executor loss: recomputation restarts from the files)
    CUT = ("population", "member_hcc", "scores", "gap_claims", "gap_draft", "gaps", "claim_hcc", "code_states", "coded", "persistence")
    #: of these, the frames whose joins are done where their sides were dealt out to
    IN_PLACE = ("gap_draft", "gaps", "coded", "persistence")

    def __init__(self, spark: SparkSession, sf_dir: str, cut: bool = True, versions: tuple[str, ...] = ("v28",)):
        """``versions``: the model versions of the gap and persistence frames (one plan for all)."""
        self.spark, self.sf, self.cut, self.versions = spark, sf_dir, cut, versions

    def use(self, name: str, frame: DataFrame) -> None:
        """From now on ``name`` is ``frame``, for every frame built on it."""
        self.__dict__.setdefault("_memo", {})[name] = frame

    def member(self) -> DataFrame:
        return D.member(self.spark, self.sf)

    def enrollment(self) -> DataFrame:
        return D.enrollment(self.spark, self.sf)

    def header(self) -> DataFrame:
        return D.claim_header(self.spark, self.sf)

    def lines(self) -> DataFrame:
        return D.claim_line(self.spark, self.sf)

    def pharmacy(self) -> DataFrame:
        return D.pharmacy(self.spark, self.sf)

    def years(self) -> DataFrame:
        """The requested risk years: calendar years of the time-period table."""
        from pyspark.sql import functions as F
        return REF.time_periods(self.spark).where(F.col("period_type") == "C").select("risk_year").distinct()

    def table(self, name: str) -> DataFrame:
        return D.table(self.spark, self.sf, name)

    def most_rows(self) -> int:
        """Rows of the largest table that claims are built of."""
        return max(D.table_rows(self.spark, self.sf, t) for t in ("lineitem", "orders", "customer"))

    def most_claims(self) -> int:
        """Rows of the claim categories of all requested versions, about."""
        return self.most_rows() * len(self.versions)

    def keyed_claims(self, *keys: str) -> DataFrame:
        """The claim categories, dealt out by ``keys`` over tasks of a bounded number of rows."""
        return dealt(self.claim_hcc(), keys, self.most_claims())

    def population(self) -> DataFrame:
        """Members and enrollments are dealt out before coverage becomes years, so no task holds the years of a whole file."""
        m, e = sized([self.member(), self.enrollment()], COVERED_YEARS * D.table_rows(self.spark, self.sf, "customer"), ["member_bid"])
        pop = S.member_population(m, e, REF.time_periods(self.spark))
        return S.with_segment(pop)

    def claim_diag(self) -> DataFrame:
        """Distinct coded diagnoses per claim (types 1–3) — the one pass over
        the claim lines that scoring, detail and persistence share."""
        from pyspark.sql import functions as F
        return self.lines().where(F.col("clm_tp_cd").isin(1, 2, 3)).select(
            "member_bid", "risk_year", "claim_bid", "claim_dt", "diag_cd").distinct()

    def member_hcc(self) -> DataFrame:
        """Scored condition categories per member, year, version."""
        diag = self.claim_diag().select("member_bid", "risk_year", "diag_cd").distinct()
        return S.scored_hccs(self.population(), diag, REF.icd_hcc(self.spark), REF.hierarchy_pairs(self.spark))

    def scores(self) -> DataFrame:
        sp = self.spark
        return S.risk_scores(self.population(), self.member_hcc(), REF.coefficients(sp),
                             REF.group_rules(sp), REF.adjustment_factors(sp), REF.version_weights(sp))


def _gap_claims(self) -> DataFrame:
    """Claim lines with a code of some gap rule or code group, with the
    claim-level qualification flag (gap input). Lines without such a code go
    before the join with the flag."""
    from riskspark.plans import claims as C
    from riskspark.plans import gaps as G
    q = C.claim_qualification(self.header(), self.lines(), self.enrollment(),
                              REF.qualifying_procedures(self.spark))
    li = self.lines().select("member_bid", "claim_bid", "clm_tp_cd", "claim_dt", "risk_year", "diag_cd", "cpt_cd")
    return G.with_rule_code(li, REF.method_rules(self.spark, self.versions), REF.code_groups(self.spark)).join(q, "claim_bid")


def _v28_hcc(self) -> DataFrame:
    from pyspark.sql import functions as F
    return self.member_hcc().where(F.col("version").isin(*self.versions))


def _coded(self) -> DataFrame:
    """The categories that ``v28_hcc`` has, once a member, year and version: the claim
    categories of the requested versions, mapped and edited once for persistence and
    gaps, less those below a coded parent. States are few for any member."""
    codes, = placed([self.code_states().select("member_bid", "risk_year", "version", "hcc")], self.most_claims(), ["member_bid"])
    return S.apply_hierarchy(codes, REF.hierarchy_pairs(self.spark), keys_first(S.MEMBER_KEYS))


def _gaps(self) -> DataFrame:
    """The draft and the coded categories are dealt out by member and year once; all steps are done there."""
    from riskspark.plans import gaps as G
    draft, coded = placed([self.gap_draft(), self.coded()], self.most_claims(), ["member_bid", "risk_year"])
    return G.statuses_from_draft(draft, REF.hierarchy_pairs(self.spark), coded)


def _gap_draft(self) -> DataFrame:
    from riskspark.plans import gaps as G
    sp = self.spark
    # persistence is not cut here: no other frame reads it, and method 4 takes no new codes
    found = self.__dict__.get("_memo", {}).get("persistence")
    m4 = G.m4_persistent(_persistence(self) if found is None else found)
    return G.all_methods(self.gap_claims(), self.pharmacy(), REF.method_rules(sp, self.versions), REF.code_groups(sp), [m4])


Inputs.gap_claims = _gap_claims
Inputs.v28_hcc = _v28_hcc
Inputs.gaps = _gaps
Inputs.gap_draft = _gap_draft


def _claim_hcc(self) -> DataFrame:
    """Claim-level categories of the requested versions after SEDITS (persistence input)."""
    from pyspark.sql import functions as F
    pop = self.population().select("member_bid", "risk_year", "age_yr", "memb_gender_cd")
    d, pop = sized([self.claim_diag(), pop], self.most_claims(), ["member_bid", "risk_year"])
    # never broadcast: as files the population is many times smaller than as a hash table, and it grows with the members
    d = d.join(pop.hint("merge"), ["member_bid", "risk_year"]).withColumn("version", F.explode(F.array(*[F.lit(v) for v in self.versions])))
    d = S.apply_sedits(S.map_icd_to_hcc(d, REF.icd_hcc(self.spark)))
    return d.where(F.col("hcc").isNotNull() & (F.col("hcc") != -1)).select(
        "version", "member_bid", "risk_year", "claim_bid", "claim_dt", "diag_cd", "hcc")


def _code_states(self) -> DataFrame:
    """One state a member, year, version and code. Where the states are cut, the claim
    categories are not (unless another frame has had them written): they lie dealt out
    by member and year and are reduced there."""
    from riskspark.plans import persistence as P
    if self.cut and "code_states" in self.CUT and "claim_hcc" not in self.__dict__.get("_memo", {}):
        return P.code_years(_claim_hcc(self))
    return P.code_years(self.claim_hcc(), self.most_claims())


def _hier28(self) -> DataFrame:
    from pyspark.sql import functions as F
    return REF.hierarchy_pairs(self.spark).where(F.col("version").isin(*self.versions))


def _persistence(self) -> DataFrame:
    from riskspark.plans import persistence as P
    return P.statuses(self.code_states(), REF.chronic(self.spark), self.hier28(), REF.prior_year(self.spark), self.years(), size=self.most_claims())


Inputs.claim_hcc = _claim_hcc
Inputs.code_states = _code_states
Inputs.coded = _coded
Inputs.hier28 = _hier28
Inputs.persistence = _persistence


def _memoize(cls) -> None:
    """Each input frame is built once per Inputs instance: the same DataFrame
    object is shared by every consumer, which saves driver-side analysis and
    lets Spark reuse identical exchanges instead of recomputing them."""
    import functools

    for name, fn in list(vars(cls).items()):
        if name.startswith("_") or not callable(fn) or name in ("table", "use", "keyed_claims"):
            continue

        def wrap(f, key):
            @functools.wraps(f)
            def inner(self):
                cache = self.__dict__.setdefault("_memo", {})
                if key not in cache:
                    if self.cut and key in self.CUT:
                        from riskspark.operators.sinks import checkpoint, in_place
                        with in_place(self.spark, key in self.IN_PLACE):
                            cache[key] = checkpoint(f(self), key)
                    else:
                        cache[key] = f(self)
                return cache[key]
            return inner
        setattr(cls, name, wrap(fn, name))


_memoize(Inputs)
