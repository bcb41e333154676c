"""Streaming: restart from checkpoint, late data, update mode, stream equals batch."""

import json

from pyspark.sql import functions as F

from pumpguard.sources.readers import read_stream
from pumpguard.streaming.pipelines import (dedupe_stream, land_stream, late_rows, parse_events,
                                           windowed_aggregate)


def _write_msgs(spark, path, rows):
    """rows: (request_id, msisdn, ts_text) -> JSON message files (one file)."""
    msgs = [(rid, json.dumps({"request_id": rid, "msisdn": ms, "enterprise_id": "e",
                              "mcc": "247", "mnc": "1", "event_ts": ts}), None)
            for rid, ms, ts in rows]
    (spark.createDataFrame(msgs, "key string, value string, arrival_ts timestamp")
     .coalesce(1).write.mode("append").json(path))


def test_restart_resumes_without_loss_or_repeat(spark, scratch):
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    _write_msgs(spark, src, [(f"a{i}", "5501990001", "2024-01-01T00:00:00+00:00")
                             for i in range(5)])

    def run():
        raw = read_stream(spark, "otp.requests", path=src, fmt="json")
        parsed, _ = parse_events(raw, "requests")
        land_stream(parsed, ck, out).awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 5
    _write_msgs(spark, src, [(f"b{i}", "5501990001", "2024-01-01T00:01:00+00:00")
                             for i in range(3)])
    run()                                    # same checkpoint: only the new file is read
    ids = [r["request_id"] for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == sorted([f"a{i}" for i in range(5)] + [f"b{i}" for i in range(3)])


def test_late_rows_are_dropped_and_counted(spark, scratch):
    src, ck = f"{scratch}/in", f"{scratch}/ck"
    _write_msgs(spark, src, [("r1", "5501990001", "2024-01-01T12:00:00+00:00")])
    _write_msgs(spark, src, [("r2", "5501990001", "2024-01-01T13:00:00+00:00")])
    _write_msgs(spark, src, [("late", "5501990001", "2024-01-01T11:00:00+00:00")])
    raw = read_stream(spark, "otp.requests", path=src, fmt="json", max_per_trigger=1)
    parsed, _ = parse_events(raw, "requests")
    agg = windowed_aggregate(parsed, "5 minutes")
    q = (agg.writeStream.outputMode("update").format("memory").queryName("late_test")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["window_start"].hour for r in spark.table("late_test").collect()}
    assert 11 not in got and {12, 13} <= got
    assert late_rows(q) == 1


def test_update_mode_emits_changed_groups(spark, scratch):
    src, ck = f"{scratch}/in", f"{scratch}/ck"
    _write_msgs(spark, src, [("r1", "5501990001", "2024-01-01T12:00:00+00:00"),
                             ("r2", "5501990002", "2024-01-01T12:01:00+00:00")])
    raw = read_stream(spark, "otp.requests", path=src, fmt="json")
    parsed, _ = parse_events(raw, "requests")
    q = (windowed_aggregate(parsed, "5 minutes").writeStream.outputMode("update")
         .format("memory").queryName("upd_test").option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    (row,) = spark.table("upd_test").collect()
    assert row["requests"] == 2 and row["number_range"] == "550199"


def test_dedupe_stream_drops_repeats(spark, scratch):
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    _write_msgs(spark, src, [("r1", "1", "2024-01-01T12:00:00+00:00"),
                             ("r1", "1", "2024-01-01T12:00:00+00:00"),
                             ("r2", "1", "2024-01-01T12:00:01+00:00")])
    raw = read_stream(spark, "otp.requests", path=src, fmt="json")
    parsed, _ = parse_events(raw, "requests")
    land_stream(dedupe_stream(parsed), ck, out).awaitTermination()
    assert sorted(r["request_id"] for r in spark.read.parquet(out).collect()) == ["r1", "r2"]


def test_stream_equals_batch_for_fraud_alerts(spark):
    """The streamed chain (dedupe, join, two-level window, score) equals the batch chain."""
    from pumpguard.plans.registry import QUERIES, DAILY_CFG
    from pumpguard.operators.aggregates import alerts_only, fraud_aggregate, score_aggregates
    from pumpguard.operators.silver import build_silver
    from pumpguard.sources import fixtures as FX
    sf = "/root/testdata/sf0.001"
    streamed = QUERIES["stream_fraud_alerts"](spark, sf)
    ev = FX.read_events(spark, sf)
    # the stream never sees malformed request messages (they are quarantined)
    req = FX.requests_raw(ev).filter(F.col("event_id") % 97 != 0).drop("event_id")
    s = build_silver(req, FX.delivery(ev), FX.verification(ev))
    batch = alerts_only(score_aggregates(
        fraud_aggregate(s, msisdn_max=True, window=("1 day", None)), DAILY_CFG))
    cols = sorted(batch.columns)
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b and len(a) > 0


def _write_ver(spark, path, rows):
    msgs = [(rid, json.dumps({"request_id": rid, "outcome": out, "event_ts": ts}), None)
            for rid, out, ts in rows]
    (spark.createDataFrame(msgs, "key string, value string, arrival_ts timestamp")
     .coalesce(1).write.mode("append").json(path))


def test_late_verification_outside_the_bound_does_not_count(spark, scratch):
    from pumpguard.streaming.pipelines import fraud_stream
    _write_msgs(spark, f"{scratch}/req", [("r1", "5501990001", "2024-01-01T12:00:00+00:00"),
                                          ("r2", "5501990002", "2024-01-01T12:00:00+00:00")])
    _write_ver(spark, f"{scratch}/ver", [("r1", "verified", "2024-01-01T12:05:00+00:00"),
                                         ("r2", "verified", "2024-01-01T12:11:00+00:00")])
    # end-of-input markers far in the future close the windows and the join bound
    _write_msgs(spark, f"{scratch}/req", [("end", "0", "2100-01-01T00:00:00+00:00")])
    _write_ver(spark, f"{scratch}/ver", [("end", "verified", "2100-01-01T00:00:00+00:00")])
    req, _ = parse_events(read_stream(spark, "otp.requests", path=f"{scratch}/req",
                                      fmt="json"), "requests")
    ver, _ = parse_events(read_stream(spark, "otp.verification", path=f"{scratch}/ver",
                                      fmt="json"), "verification")
    scored = fraud_stream(req, ver, size="1 hour", bound="10 minutes")
    land_stream(scored, f"{scratch}/ck", f"{scratch}/out").awaitTermination()
    (row,) = spark.read.parquet(f"{scratch}/out").filter("number_range = '550199'").collect()
    assert row["requests"] == 2 and row["verifications"] == 1    # r2 verified too late


def test_stream_alerts_through_jdbc_foreach_batch(spark, scratch):
    import uuid
    from pumpguard.sinks.writers import AlertSink
    from pumpguard.sources.readers import read_jdbc
    from pumpguard.streaming.pipelines import fraud_stream, start_alerts
    rows = [(f"r{i}", "5501990001", "2024-01-01T12:00:00+00:00") for i in range(120)]
    _write_msgs(spark, f"{scratch}/req", rows)
    _write_msgs(spark, f"{scratch}/req", [("end", "0", "2100-01-01T00:00:00+00:00")])
    req, _ = parse_events(read_stream(spark, "otp.requests", path=f"{scratch}/req",
                                      fmt="json"), "requests")
    url = f"jdbc:derby:memory:s{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    sink = AlertSink("jdbc", url=url, table="FRAUD_ALERTS", properties=props)
    start_alerts(fraud_stream(req, None, size="1 hour"), sink, f"{scratch}/ck").awaitTermination()
    back = read_jdbc(spark, url, "FRAUD_ALERTS", props).collect()
    assert len(back) == 1
    assert back[0]["severity"] == "high" and back[0]["requests"] == 120


def test_streaming_distinct_ips_are_approximate_counts(spark, scratch):
    rows = [(f"r{i}", "5501990001", "2024-01-01T12:00:00+00:00") for i in range(30)]
    msgs = [(rid, json.dumps({"request_id": rid, "msisdn": ms, "enterprise_id": "e",
                              "mcc": "247", "mnc": "1", "ip": f"10.0.0.{i % 7}",
                              "event_ts": ts}), None)
            for i, (rid, ms, ts) in enumerate(rows)]
    (spark.createDataFrame(msgs, "key string, value string, arrival_ts timestamp")
     .coalesce(1).write.json(f"{scratch}/in"))
    raw = read_stream(spark, "otp.requests", path=f"{scratch}/in", fmt="json")
    parsed, _ = parse_events(raw, "requests")
    q = (windowed_aggregate(parsed, "5 minutes", approx_distinct_ip=True).writeStream
         .outputMode("update").format("memory").queryName("approx_ip")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    (row,) = spark.table("approx_ip").collect()
    assert row["requests"] == 30 and row["distinct_ip"] == 7
