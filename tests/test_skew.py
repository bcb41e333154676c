"""Hot keys: one request id / number range / msisdn holding a third of all rows."""

import pytest
from pyspark.sql import functions as F

from pumpguard.operators.aggregates import fraud_aggregate, mark_verified
from pumpguard.operators.marts import discrete_percentiles, operator_performance
from pumpguard.operators.silver import build_silver, dedupe

N = 60_000


def _requests(spark):
    # a third of the rows share request id 'hot' (exact copies), number range 550199 and
    # msisdn 5501990000; the rest are distinct
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("request_id"),
        F.when(F.col("id") % 3 == 0, F.lit("5501990000"))
        .otherwise(F.concat(F.lit("44"), F.lpad(F.col("id").cast("string"), 8, "0")))
        .alias("msisdn"),
        F.lit("ent_1").alias("enterprise_id"), F.lit("247").alias("mcc"), F.lit("1").alias("mnc"),
        F.when(F.col("id") % 3 == 0, F.lit("10.0.0.1"))
        .otherwise(F.concat(F.lit("10.1."), (F.col("id") % 200).cast("string"))).alias("ip"),
    ).repartition(8)


def test_dedupe_and_silver_with_a_hot_request_id(spark):
    req = _requests(spark)
    d = spark.range(N).select(F.col("id").cast("string").alias("request_id"),
                              F.lit("delivered").alias("status"),
                              (F.col("id") % 1000).cast("int").alias("operator_latency_ms"))
    v = spark.createDataFrame([("hot", "verified", 1)], "request_id string, outcome string, "
                                                        "attempts int")
    assert dedupe(req, ["request_id"]).count() == N - N // 3 + 1
    s = build_silver(req, d, v)
    assert s.count() == N - N // 3 + 1
    assert s.filter("request_id = 'hot' AND is_verified").count() == 1
    plan = dedupe(req, ["request_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_first" in plan            # duplicates collapse on the map side


def test_verified_membership_with_a_hot_id(spark):
    req = _requests(spark)
    ver = spark.range(1000).select(F.lit("hot").alias("request_id"),
                                   F.lit("verified").alias("outcome"))
    out = mark_verified(req, ver)
    assert out.count() == N
    assert out.filter("is_verified").count() == N // 3


def test_fraud_aggregate_with_a_hot_range_and_msisdn(spark):
    req = _requests(spark).withColumn("is_verified", F.col("request_id") == "hot")
    got = {r["number_range"]: r for r in
           fraud_aggregate(req, msisdn_max=True, distinct_ip=True).collect()}
    hot = got["550199"]
    assert hot["requests"] == N // 3 and hot["msisdn_max_count"] == N // 3
    assert hot["verifications"] == N // 3 and hot["distinct_ip"] == 1
    assert sum(r["requests"] for r in got.values()) == N
    plan = fraud_aggregate(req, msisdn_max=True, distinct_ip=True)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "partial_count" in plan


def test_percentiles_and_route_performance_with_a_hot_route(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("247")).otherwise((F.col("id") % 50).cast("string"))
        .alias("mcc"), F.lit("1").alias("mnc"),
        (F.col("id") % 997).cast("int").alias("operator_latency_ms"),
        F.lit("delivered").alias("delivery_status"))
    p = {r["mcc"]: r for r in discrete_percentiles(
        df, "operator_latency_ms", ["mcc", "mnc"], [0.5], ["p50"]).collect()}
    hot = sorted(r[0] for r in df.filter("mcc = '247'").select("operator_latency_ms").collect())
    import math
    assert p["247"]["p50"] == hot[math.ceil(0.5 * len(hot)) - 1]
    perf = {r["mcc"]: r for r in operator_performance(df).collect()}
    assert perf["247"]["requested"] == N // 3 and perf["247"]["delivery_rate"] == 1.0


def test_velocity_of_odd_window_lengths_and_missing_values(spark):
    """Windows whose slide does not divide their size, against counting every window alone."""
    import datetime as dt
    from pumpguard.operators.aggregates import velocity_by
    start = dt.datetime(2024, 1, 1, 10, 0)
    rows = [(None if i % 7 == 0 else f"ip{i % 3}", start + dt.timedelta(seconds=37 * i))
            for i in range(60)]
    df = spark.createDataFrame(rows, "ip string, event_ts timestamp_ntz").withColumn(
        "number_range", F.lit("x"))
    got = {(r["value"], r["window_start"]): r["requests"]
           for r in velocity_by(df, "ip", "5 minutes", "2 minutes", 3).collect()}
    want = {}
    for value, ts in rows:
        at = ts - dt.timedelta(seconds=ts.timestamp() % 120, microseconds=ts.microsecond)
        while value is not None and at > ts - dt.timedelta(minutes=5):
            want[value, at] = want.get((value, at), 0) + 1
            at -= dt.timedelta(minutes=2)
    assert got == want
    over = velocity_by(df, "ip", "5 minutes", "2 minutes", 3, over_only=True)
    assert over.columns == ["dimension", "value", "window_start", "window_end", "requests"]
    assert {(r["value"], r["window_start"]) for r in over.collect()} == {
        k for k, n in want.items() if n > 3}


@pytest.mark.parametrize("size,slide", [("5 minutes", "1 minute"), ("5 minutes", "2 minutes"), ("1 minute", "1 minute")])
def test_velocity_by_blocks_equals_single_windows_with_one_aggregate(spark, size, slide):
    """One row of pane counts a value and block, where each window had a row of its own; times on
    the edges of panes and blocks, a hot value, missing values and times."""
    import datetime as dt
    from pumpguard.operators.aggregates import velocity_by
    start = dt.datetime(2024, 1, 1, 9, 55)
    rows = [(None if i % 7 == 0 else f"ip{i % 3}", f"e{i % 2}", start + dt.timedelta(seconds=30 * (i // 2)))
            for i in range(90)] + [("hot", None, start + dt.timedelta(minutes=5))] * 50 + [("ip0", "e0", None)]
    df = spark.createDataFrame(rows, "ip string, enterprise_id string, event_ts timestamp").withColumn(
        "number_range", F.lit("x"))
    dims = ("ip", "enterprise_id", "number_range")
    plain, blocks = (velocity_by(df, dims, size, slide, 3, blocks=b) for b in (False, True))
    assert plain.dtypes == blocks.dtypes
    assert sorted(map(repr, blocks.collect())) == sorted(map(repr, plain.collect()))
    logical = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Aggregate [") == 1
