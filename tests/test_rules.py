"""Rule and scoring tests: each rule alone, at its boundaries, and the sum."""

import pytest
from pyspark.sql import functions as F

from pumpguard.config import RuleConfig
from pumpguard.operators.aggregates import rule_breakdown, score_aggregates

SCHEMA = ("requests long, verifications long, distinct_ip long, msisdn_max_count long, "
          "mcc string, mnc string")
#: A quiet sender: no rule has anything to say about it.
BASE = dict(requests=40, verifications=31, distinct_ip=33, msisdn_max_count=4, mcc="208", mnc="15")


def score_rows(spark, *overrides, cfg=RuleConfig()):
    rows = [{**BASE, **o} for o in overrides]
    df = spark.createDataFrame([tuple(r[c] for c in BASE) for r in rows], SCHEMA)
    return rule_breakdown(df, cfg).collect()


def test_quiet_sender_scores_nothing(spark):
    (r,) = score_rows(spark, {})
    assert [r[c] for c in r.__fields__ if c.endswith("_points")] == [0.0] * 4


@pytest.mark.parametrize("mx,points", [(30, 0.0), (31, 0.5), (60, 15.0), (130, 50.0),
                                       (131, 50.0), (10_000, 50.0)])
def test_velocity_boundaries(spark, mx, points):
    (r,) = score_rows(spark, {"msisdn_max_count": mx})
    assert r["velocity_points"] == points


@pytest.mark.parametrize("req,ver,expected", [
    (99, 0, 0.0),             # below the volume threshold
    (100, 0, 200.0),          # at the threshold (>=): deficit 1.0 * 100 * 2
    (101, 0, 202.0),
    (100, 10, 0.0),           # rate exactly at the ceiling does not fire
    (1000, 99, ((0.10 - 0.099) / 0.10) * 1000 * 2.0),   # just under the ceiling
    (0, 0, 0.0),              # zero requests
])
def test_ait_signature_boundaries(spark, req, ver, expected):
    (r,) = score_rows(spark, {"requests": req, "verifications": ver})
    assert r["ait_signature_points"] == expected


@pytest.mark.parametrize("requests,verifications,points", [
    (49, 0, 0.0), (50, 0, 40.0), (50, 1, 0.0), (5_000, 0, 40.0), (5_000, 4_999, 0.0)])
def test_never_verified_needs_volume_and_silence(spark, requests, verifications, points):
    (r,) = score_rows(spark, {"requests": requests, "verifications": verifications})
    assert r["never_verified_points"] == points


@pytest.mark.parametrize("mcc,mnc,points", [
    ("247", "1", 25.0), ("88", "0", 25.0), ("881", "0", 25.0),
    ("247", "0", 0.0), ("8", "80", 0.0), ("208", "15", 0.0),       # both parts must belong together
    (None, "0", 0.0), ("881", None, 0.0)])                          # a missing part is no member
def test_risky_route_is_a_pair(spark, mcc, mnc, points):
    (r,) = score_rows(spark, {"mcc": mcc, "mnc": mnc})
    assert r["risky_route_points"] == points


def test_score_is_the_sum_of_all_rules(spark):
    (r,) = score_rows(spark, {"requests": 120, "verifications": 0, "msisdn_max_count": 90,
                              "mcc": "881", "mnc": "0"})
    assert r["score"] == 30.0 + 240.0 + 40.0 + 25.0 and r["severity"] == "high"
    (r,) = score_rows(spark, {"mcc": "881", "mnc": "0"})
    assert (r["score"], r["severity"]) == (25.0, "medium")


@pytest.mark.parametrize("score,band", [(0, "low"), (19.5, "low"), (20, "medium"), (30, "medium"),
                                        (99.5, "medium"), (100, "high"), (150, "high")])
def test_severity_bands(spark, score, band):
    from pumpguard.functions.rules import severity
    (r,) = spark.range(1).select(severity(F.lit(float(score))).alias("s")).collect()
    assert r["s"] == band


def test_missing_inputs_count_as_zero(spark):
    df = spark.createDataFrame([(500, "247", "1")], "requests long, mcc string, mnc string")
    (r,) = score_aggregates(df).collect()
    # no verifications column -> 0 verifications: full deficit, never-verified, route
    assert r["score"] == 500 * 2.0 + 40.0 + 25.0
    df2 = spark.createDataFrame([(None, None, "x", "y")],
                                "requests long, verifications long, mcc string, mnc string")
    (r2,) = score_aggregates(df2).collect()
    assert r2["score"] == 0 and r2["severity"] == "low"


def test_scoring_keeps_input_columns_and_orders_rows(spark):
    df = spark.createDataFrame(
        [("ent_3", "550199", 500, 3, 5, 2, "247", "1"),
         ("ent_1", "447700", 20, 15, 2, 18, "310", "260")],
        "enterprise_id string, number_range string, requests long, verifications long, "
        "msisdn_max_count long, distinct_ip long, mcc string, mnc string")
    out = {r["enterprise_id"]: r for r in score_aggregates(df).collect()}
    assert out["ent_3"]["severity"] == "high" and out["ent_1"]["severity"] == "low"
    assert out["ent_3"]["score"] > out["ent_1"]["score"]
    assert out["ent_3"]["distinct_ip"] == 2


def test_custom_rule_and_config(spark):
    from pumpguard.functions import rules as R
    R.register_rule("ip_spread", lambda cfg, i, present: F.when(
        F.col("distinct_ip") > 5, F.lit(7.0)).otherwise(F.lit(0.0)))
    try:
        cfg = RuleConfig().replace(rules=("risky_route", "ip_spread"),
                                   high_risk_routes=(("208", "15"),))
        (r,) = score_rows(spark, {}, cfg=cfg)
        assert r["score"] == 25.0 + 7.0
    finally:
        R.RULES.pop("ip_spread")


def test_scoring_plan_stays_in_jvm(spark):
    df = spark.createDataFrame([tuple(BASE.values())], SCHEMA)
    plan = score_aggregates(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
