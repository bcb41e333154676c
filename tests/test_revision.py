"""Revision of streamed alerts: change feed, what stands, repeats, failures, open windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pumpguard.config import RuleConfig
from pumpguard.operators import revision as R
from pumpguard.sinks.writers import AlertSink

DAY = dt.datetime(2024, 1, 1)
SCORED = ("window_start timestamp, window_end timestamp, enterprise_id string, number_range string, "
          "mcc string, mnc string, requests long, verifications long, msisdn_max_count long, "
          "score double, severity string")


def row(name, severity, verifications=0, minute=0, score=None, mcc="247"):
    start = DAY + dt.timedelta(minutes=minute)
    score = {"low": 0.0, "medium": 40.0, "high": 80.0}[severity] if score is None else score
    return (start, start + dt.timedelta(minutes=5), name, "550199", mcc, "1", 100, verifications, 3,
            score, severity)


def told(spark, path, *batches):
    for i, rows in enumerate(batches):
        AlertSink("parquet", path=path).write(spark.createDataFrame(rows, SCORED), i)


def feed(df):
    return {(r["enterprise_id"], r["mcc"]): (r["change"], r["told_severity"], r["severity"]) for r in df.collect()}


def stands(spark, a, r):
    return {(x["enterprise_id"], x["mcc"]): (x["severity"], x["verifications"])
            for x in R.current_alerts(spark, a, r).collect()}


def test_every_kind_of_change_and_a_second_run_changes_nothing(spark, scratch):
    a, r = f"{scratch}/alerts", f"{scratch}/revisions"
    told(spark, a, [row("same", "high"), row("lower", "high"), row("falls", "medium"), row("gone", "high"),
                    row("null", "high", mcc=None)])
    final = spark.createDataFrame([row("same", "high"), row("lower", "medium", 20), row("falls", "low", 60),
                                   row("missed", "high"), row("quiet", "low"),
                                   row("null", "high", mcc=None)], SCORED)
    got = feed(R.revise_alerts(spark, a, r, final))
    assert got == {("same", "247"): ("kept", "high", "high"), ("lower", "247"): ("changed", "high", "medium"),
                   ("falls", "247"): ("withdrawn", "medium", "low"), ("gone", "247"): ("withdrawn", "high", "low"),
                   ("missed", "247"): ("new", None, "high"), ("null", None): ("kept", "high", "high")}
    want = {("same", "247"): ("high", 0), ("lower", "247"): ("medium", 20), ("missed", "247"): ("high", 0),
            ("null", None): ("high", 0)}
    assert stands(spark, a, r) == want
    again = R.revise_alerts(spark, a, r, final)
    assert {c for c, _, _ in feed(again).values()} == {"kept"} and again.count() == len(want)
    assert stands(spark, a, r) == want
    # an alert that was withdrawn comes back
    back = spark.createDataFrame([row("falls", "high", 1)], SCORED).unionByName(final.filter("enterprise_id <> 'falls'"))
    assert feed(R.revise_alerts(spark, a, r, back))[("falls", "247")] == ("new", None, "high")
    assert stands(spark, a, r) == want | {("falls", "247"): ("high", 1)}


def test_a_repeated_revision_replaces_itself(spark, scratch):
    a, r = f"{scratch}/alerts", f"{scratch}/revisions"
    told(spark, a, [row("x", "high"), row("y", "high")], [row("x", "medium", 5)])  # two versions of x
    assert {k: v for k, v in stands(spark, a, r).items()} == {("x", "247"): ("medium", 5), ("y", "247"): ("high", 0)}
    wrong = spark.createDataFrame([row("x", "low", 90), row("y", "low", 90)], SCORED)
    right = spark.createDataFrame([row("x", "medium", 5), row("y", "medium", 30)], SCORED)
    R.revise_alerts(spark, a, r, wrong, revision=0)
    assert stands(spark, a, r) == {}
    got = feed(R.revise_alerts(spark, a, r, right, revision=0))
    assert got == {("x", "247"): ("kept", "medium", "medium"), ("y", "247"): ("changed", "high", "medium")}
    assert stands(spark, a, r) == {("x", "247"): ("medium", 5), ("y", "247"): ("medium", 30)}


def test_a_failing_revision_leaves_the_alerts(spark, scratch):
    a, r = f"{scratch}/alerts", f"{scratch}/revisions"
    told(spark, a, [row("x", "high")])
    final = spark.createDataFrame([row("x", "low", 90)], SCORED)
    broken = final.withColumn("score", F.expr("if(score >= 0, raise_error('stop'), score)").cast("double"))
    with pytest.raises(Exception, match="stop"):
        R.revise_alerts(spark, a, r, broken)
    assert stands(spark, a, r) == {("x", "247"): ("high", 0)}
    R.revise_alerts(spark, a, r, final)
    assert stands(spark, a, r) == {}


def test_open_windows_and_later_batches_are_left_alone(spark, scratch):
    a, r = f"{scratch}/alerts", f"{scratch}/revisions"
    told(spark, a, [row("x", "high"), row("x", "high", minute=60)])
    none = spark.createDataFrame([], SCORED)
    got = R.revise_alerts(spark, a, r, none, closed_before=DAY + dt.timedelta(minutes=5)).collect()
    assert [(g["change"], g["window_start"], g["score"]) for g in got] == [("withdrawn", DAY, 0.0)]
    AlertSink("parquet", path=a).write(spark.createDataFrame([row("z", "high", minute=90)], SCORED), 1)
    assert stands(spark, a, r) == {("x", "247"): ("high", 0), ("z", "247"): ("high", 0)}


def test_a_verification_after_the_bound_lowers_the_final_score(spark):
    requests = spark.createDataFrame(
        [(f"r{i}", "5501990001", "e", "247", "1", "10.0.0.1", DAY) for i in range(120)] * 2,
        "request_id string, msisdn string, enterprise_id string, mcc string, mnc string, ip string, event_ts timestamp")
    late = spark.createDataFrame([(f"r{i}", "verified") for i in range(120)] * 2, "request_id string, outcome string")
    cfg = RuleConfig()
    few, = R.final_scores(requests, late.filter("false"), "5 minutes", cfg=cfg).collect()
    all_, = R.final_scores(requests, late, "5 minutes", cfg=cfg).collect()
    assert (few["requests"], few["verifications"], all_["verifications"]) == (120, 0, 120)
    assert all_["score"] < few["score"]
