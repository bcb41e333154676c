"""The observed values documented for the test-data binding, pinned at every scale factor."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pumpguard.operators.aggregates import fraud_aggregate
from pumpguard.operators.marts import ait_loss, delivery_funnel
from pumpguard.plans.registry import scored_aggregate, silver

# The documented facts per scale factor.
FACTS = {
    "0.001": dict(silver=1000, verified=495, delivered=926, no_delivery=13, no_verification=74,
                  latency_sum=1787397, funnel_groups=17, groups=18, severity=(16, 1, 1),
                  hot_score=247.00000000000003, loss_positive=1,
                  win5=(991, 2), win1d=(412, 12, 0), fires=(0, 1, 0, 2)),
    "0.01": dict(silver=10000, verified=5145, delivered=9435, no_delivery=91, no_verification=565,
                 latency_sum=17574534, funnel_groups=22, groups=168, severity=(150, 16, 2),
                 hot_score=2014.0000000000002, loss_positive=1,
                 win5=(9748, 4), win1d=(3881, 82, 0), fires=(1, 2, 2, 16)),
    "0.1": dict(silver=100000, verified=50870, delivered=93928, no_delivery=1024,
                no_verification=6072, latency_sum=175781392, funnel_groups=22, groups=1653,
                severity=(1500, 150, 3), hot_score=21055.000000000004, loss_positive=1,
                win5=(87554, 10), win1d=(38288, 718, 30), fires=(1, 3, 2, 151)),
}


@pytest.mark.parametrize("sf", sorted(FACTS))
def test_documented_facts(spark, sf):
    f = FACTS[sf]
    d = f"/root/testdata/sf{sf}"
    s = silver(spark, d)
    tot = s.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_verified").alias("v"),
                F.count_if(F.col("delivery_status") == "delivered").alias("dl"),
                F.count_if(F.col("delivery_status").isNull()).alias("nd"),
                F.count_if(F.col("verification_outcome").isNull()).alias("nv"),
                F.sum("operator_latency_ms").alias("lat")).first()
    assert (tot["n"], tot["v"], tot["dl"], tot["nd"], tot["nv"], tot["lat"]) == (
        f["silver"], f["verified"], f["delivered"], f["no_delivery"], f["no_verification"],
        f["latency_sum"])
    funnel = delivery_funnel(s)
    assert funnel.count() == f["funnel_groups"]
    assert ait_loss(funnel).filter("estimated_ait_loss_usd > 0").count() == f["loss_positive"]
    rows = scored_aggregate(spark, d).collect()
    sev = Counter(r["severity"] for r in rows)
    assert len(rows) == f["groups"]
    assert (sev["low"], sev["medium"], sev["high"]) == f["severity"]
    (hot,) = [r["score"] for r in rows if (r["enterprise_id"], r["number_range"], r["mcc"],
                                            r["mnc"]) == ("ent_3", "550199", "247", "1")]
    assert hot == f["hot_score"]                       # bit-exact
    # groups where each rule fires: velocity, AIT signature, never verified, risky route
    fires = tuple(sum(1 for r in rows if r[c] > 0) for c in
                  ("velocity_points", "ait_signature_points", "never_verified_points",
                   "risky_route_points"))
    assert fires == f["fires"]
    w5 = fraud_aggregate(s, window=("5 minutes", None)).agg(
        F.count(F.lit(1)), F.max("requests")).first()
    assert tuple(w5) == f["win5"]
    w1 = fraud_aggregate(s, window=("1 day", None)).agg(
        F.count(F.lit(1)), F.max("requests"), F.count_if(F.col("requests") >= 100)).first()
    assert tuple(w1) == f["win1d"]
