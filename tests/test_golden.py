"""Golden values stated in the reference's requirement documents."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark import functions as RF
from riskspark.operators import rules as OR
from riskspark.plans import gaps as G
from riskspark.plans import persistence as P
from riskspark.plans import scoring as S


def test_score_chain_sample(spark):
    # demog 0.298 + HCC 0.368 + 0.104 = 0.770 → /1.015 = 0.759 → ×(1−0.058) = 0.715 → ×0.67 = 0.479
    pop = spark.createDataFrame([(1, 2025, 9, "CNA_X", 72, "M", 0)],
                                "member_bid long, risk_year int, time_period int, model_segment string, age_yr int, "
                                "memb_gender_cd string, origds int")
    hcc = spark.createDataFrame([(1, 2025, "v28", "CNA_X", 85), (1, 2025, "v28", "CNA_X", 19)],
                                "member_bid long, risk_year int, version string, model_segment string, hcc int")
    coeffs = spark.createDataFrame([("v28", "cms_hcc", "CNA_X_M72", 0.298), ("v28", "cms_hcc", "CNA_X_HCC85", 0.368),
                                    ("v28", "cms_hcc", "CNA_X_HCC19", 0.104)],
                                   "version string, model string, name string, score double")
    rules = spark.createDataFrame([], "interaction_name string, primary_group string, secondary_group string, score double")
    factors = spark.createDataFrame([("v28", "cms_hcc", 1.015, 0.058)],
                                    "version string, model string, normalization_factor double, coding_pattern_adjustment double")
    weights = spark.createDataFrame([("v28", 0.67)], "version string, weight double")
    r = S.risk_scores(pop, hcc, coeffs, rules, factors, weights).where("version = 'v28'").collect()[0]
    assert (r.raw_score, r.normalized_score, r.payment_score, r.weighted_score) == (0.770, 0.759, 0.715, 0.479)


def test_noisy_or(spark):
    df = spark.createDataFrame([(1, 1, "CC001", 1, 0.75), (1, 1, "CC001", 2, 0.55), (2, 1, "CC001", 1, None)],
                               "member_bid long, risk_year int, cc_code string, method_id int, method_confidence double")
    out = {r.member_bid: r.combined_confidence for r in G.combined_confidence(df).collect()}
    assert out == {1: 0.8875, 2: 0.0}  # all-null group → 0.0 (nulls dropped)


def test_hierarchy_drops_children(spark):
    hcc = spark.createDataFrame([(1, 2025, "v28", 8), (1, 2025, "v28", 9), (1, 2025, "v28", 10)],
                                "member_bid long, risk_year int, version string, hcc int")
    h = spark.createDataFrame([("v28", 8, c) for c in (9, 10, 11, 12)], "version string, parent int, child int")
    assert [r.hcc for r in S.apply_hierarchy(hcc, h).collect()] == [8]


def test_sedits_perinatal_excluded(spark):
    df = spark.createDataFrame([("v28", "D005", 213, 25, "F")],
                               "version string, diag_cd string, hcc int, age_yr int, memb_gender_cd string")
    assert S.apply_sedits(df).collect()[0].hcc == -1


def test_lookback_bounds(spark):
    claims = spark.createDataFrame(
        [(1, "D030", dt.date(2020, 1, 1)), (2, "D030", dt.date(2020, 6, 29)), (3, "D030", dt.date(2020, 7, 1))],
        "member_bid long, diag_cd string, claim_dt date")
    groups = spark.createDataFrame([("DIAGNOSIS", "EXA", "D030")], "claim_cd_type string, group_cd string, code string")
    trig = spark.createDataFrame([(1, dt.date(2020, 1, 1), "EXA"), (2, dt.date(2020, 12, 26), "EXA"),
                                  (3, dt.date(2020, 12, 29), "EXA")],
                                 "member_bid long, claim_dt date, exclusion_cd string")
    out = {r.member_bid: r.excluded for r in G.lookback_exclusion(trig, claims, groups).collect()}
    assert out == {1: 1, 2: 1, 3: 0}  # day 0 and day 180 count, day 181 does not


def test_count_names_and_padding(spark):
    df = spark.createDataFrame([("CNA", 3, "CC17"), ("CNA", 12, "17"), ("CNA", 10, "HCC017")],
                               "seg string, n int, code string")
    r = df.select(RF.count_coeff_name("seg", "n").alias("name"), RF.normalize_cc_code("code").alias("cc"),
                  RF.hcc_detail_id("code").alias("hid")).collect()
    assert [x.name for x in r] == ["CNA_D3", "CNA_D10P", "CNA_D10P"]
    assert {x.cc for x in r} == {"CC017"} and {x.hid for x in r} == {"HCC017"}


def test_period_filter_drops_wrong_year(spark):
    claims = spark.createDataFrame([(1, dt.date(2024, 9, 26))], "claim_bid long, claim_dt date")
    periods = spark.createDataFrame([(5, dt.date(2023, 1, 1), dt.date(2023, 12, 31), "C", 2023)],
                                    "time_period int, begin_date date, end_date date, period_type string, risk_year int")
    assert OR.period_filter(claims, periods, "claim_dt").count() == 0


def test_frequency_is_distinct_claims(spark):
    rows = [(1, 2020, 17, 10, dt.date(2020, 1, 1), "D1"), (1, 2020, 17, 10, dt.date(2020, 1, 1), "D2"),
            (1, 2020, 17, 11, dt.date(2020, 2, 1), "D1"), (1, 2020, 17, 12, dt.date(2020, 3, 1), "D1")]
    df = spark.createDataFrame(rows, "member_bid long, risk_year int, hcc int, claim_bid long, claim_dt date, diag_cd string")
    out = P.current_filter(df).collect()
    assert len(out) == 1 and out[0].frequency == 3 and out[0].claim_bid == 12


def test_consensus_three_of_four(spark):
    g = spark.createDataFrame([(1, 2020, "CC023", m) for m in (1, 2, 10)], "member_bid long, risk_year int, cc_code string, method_id int")
    pr = spark.createDataFrame([(4, 1), (10, 2), (1, 3), (2, 4)], "method_id int, priority int")
    r = G.method_consensus(g, pr).collect()[0]
    assert r.consensus == 0.75 and r.primary_method == 10 and r.methods == "1,10,2"
