"""Jobs end to end on sf0.001: batch chain, anomaly scan, fraud stream, Bronze landing."""

from pyspark.sql import functions as F

from pumpguard.plans.jobs import Layout, run_anomaly, run_batch, run_fraud_stream
from pumpguard.plans.registry import LANDING_FORMAT
from pumpguard.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_run_batch_writes_every_layer(spark, scratch):
    ev = FX.read_events(spark, SF)
    out = run_batch(spark, FX.requests(ev), FX.delivery(ev), FX.verification(ev),
                    Layout(out_root=scratch))
    assert out["silver"].count() == 1000
    assert out["delivery_funnel"].count() == 17
    assert out["ait_loss"].filter("estimated_ait_loss_usd > 0").count() == 1
    assert spark.read.parquet(f"{scratch}/latency_pct").count() == 6


def test_run_anomaly_appends_flagged(spark, scratch):
    from pumpguard.plans.registry import silver
    scored = run_anomaly(spark, silver(spark, SF), keys=("enterprise_id", "number_range"),
                         path=f"{scratch}/anomalies")
    flagged = spark.read.parquet(f"{scratch}/anomalies")
    assert flagged.count() == scored.filter("is_anomaly").count() > 0
    assert {"scored_at", "anomaly_score"} <= set(flagged.columns)


def test_run_fraud_stream_from_landing(spark, scratch):
    from pumpguard.config import RuleConfig
    from pumpguard.plans.registry import land_messages
    from pumpguard.sinks.writers import AlertSink
    from pumpguard.streaming.pipelines import latest_alerts
    land_messages(spark, SF, f"{scratch}/landing")
    q = run_fraud_stream(spark, f"{scratch}/ck", AlertSink("parquet", path=f"{scratch}/alerts"),
                         landing_root=f"{scratch}/landing", size="30 days",
                         cfg=RuleConfig(), trigger="available_now")
    q.awaitTermination()
    alerts = latest_alerts(spark, f"{scratch}/alerts")
    sev = {r["severity"] for r in alerts.collect()}
    assert "high" in sev                      # the AIT range is caught in the stream
    assert alerts.filter(F.col("enterprise_id") == "ent_3").count() >= 1


def test_rocksdb_state_store(spark, scratch):
    from pumpguard.session import ROCKSDB_PROVIDER
    from pumpguard.sources.readers import read_stream
    from pumpguard.streaming.pipelines import dedupe_stream, land_stream, parse_events
    from pumpguard.plans.registry import land_messages
    land_messages(spark, SF, f"{scratch}/landing")
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        raw = read_stream(spark, "otp.requests", path=f"{scratch}/landing/requests", fmt=LANDING_FORMAT)
        parsed, _ = parse_events(raw, "requests")
        land_stream(dedupe_stream(parsed), f"{scratch}/ck", f"{scratch}/out").awaitTermination()
    finally:
        spark.conf.unset(key)
    assert spark.read.parquet(f"{scratch}/out").filter(
        F.col("request_id") != "__end_of_replay__").count() == 1000 - 11


def test_alerts_published_as_messages(spark, scratch):
    from pumpguard.plans.registry import land_messages
    from pumpguard.sources.readers import read_stream
    from pumpguard.streaming.pipelines import fraud_stream, parse_events, publish_stream
    land_messages(spark, SF, f"{scratch}/landing")
    raw = read_stream(spark, "otp.requests", path=f"{scratch}/landing/requests", fmt=LANDING_FORMAT)
    parsed, _ = parse_events(raw, "requests")
    scored = fraud_stream(parsed, None, size="30 days")
    alerts = scored.filter(F.col("severity") != "low")
    publish_stream(alerts, f"{scratch}/ck", path=f"{scratch}/pub").awaitTermination()
    msgs = spark.read.json(f"{scratch}/pub/otp.alerts")
    assert msgs.count() >= 1 and set(msgs.columns) == {"key", "value"}


def test_silver_checks_ride_on_the_write(spark, scratch):
    from pumpguard.operators import quality as Q
    df = spark.createDataFrame([("r1", True), (None, False), ("r3", None)],
                               "request_id string, is_verified boolean")
    observed, obs = Q.observe_silver(df)
    observed.write.parquet(scratch)
    assert Q.observed_result(obs) == {"ok": False, "failures": ["request_id", "is_verified"]}


def test_run_silver_stops_on_failed_checks(spark, scratch):
    import pytest
    req = spark.createDataFrame([(None, "5501990001")], "request_id string, msisdn string")
    d = spark.createDataFrame([], "request_id string, status string")
    v = spark.createDataFrame([], "request_id string, outcome string")
    from pumpguard.plans.jobs import run_silver
    with pytest.raises(AssertionError):
        run_silver(spark, req, d, v, Layout(out_root=scratch))


def test_e2e_normal_traffic_gives_no_high_alert(spark):
    """AIT traffic gives a high alert, normal traffic none."""
    from pumpguard.operators.aggregates import fraud_aggregate, score_aggregates
    from pumpguard.operators.silver import build_silver
    ev = FX.read_events(spark, SF)
    normal = ev.filter(F.col("event_type") != "error")       # no AIT burst
    for data, expect_high in ((ev, True), (normal, False)):
        s = build_silver(FX.requests(data), FX.delivery(data), FX.verification(data))
        sev = {r["severity"] for r in score_aggregates(
            fraud_aggregate(s, msisdn_max=True)).collect()}
        assert ("high" in sev) is expect_high


def test_cli_runs_every_job(spark, scratch):
    from pumpguard.plans.cli import main
    from pumpguard.plans.registry import land_messages
    # Bronze landing is stateless: no end-of-replay marker (a NULL-enterprise request would
    # fail the funnel's not-null gate and stop the batch, as it should)
    land_messages(spark, SF, f"{scratch}/landing", end_marker=False)
    main(["bronze", "--landing", f"{scratch}/landing", "--out-root", f"{scratch}/lake",
          "--checkpoint", f"{scratch}/ck"])
    res = main(["batch", "--bronze-root", f"{scratch}/lake/bronze", "--out-root",
                f"{scratch}/lake/gold"])
    assert res["silver_rows"] == 1000 - 11          # malformed messages are quarantined
    assert "delivery_funnel" in res["marts"]
    res = main(["anomaly", "--silver", f"{scratch}/lake/gold/silver", "--out",
                f"{scratch}/anomalies", "--keys", "enterprise_id,number_range"])
    assert res["flagged"] >= 1
    land_messages(spark, SF, f"{scratch}/replay")          # with end-of-input markers
    res = main(["fraud-stream", "--landing", f"{scratch}/replay", "--checkpoint",
                f"{scratch}/ck2", "--alerts", f"{scratch}/alerts", "--window", "30 days",
                "--trigger", "available_now", "--publish"])
    n = spark.read.parquet(f"{scratch}/alerts").count()
    assert n >= 1
    assert spark.read.json(f"{scratch}/alerts_topics/otp.alerts").count() == n


def test_incremental_silver_replaces_only_its_days(spark, scratch):
    from pumpguard.plans.jobs import run_silver
    from pumpguard.plans.registry import land_messages
    from pumpguard.streaming.pipelines import run_bronze
    land_messages(spark, SF, f"{scratch}/landing", end_marker=False)
    for q in run_bronze(spark, f"{scratch}/lake", f"{scratch}/ck",
                        landing_root=f"{scratch}/landing", fmt=LANDING_FORMAT):
        q.awaitTermination()
    req, dlv, ver = (spark.read.parquet(f"{scratch}/lake/bronze/{t}")
                     for t in ("requests", "delivery", "verification"))
    layout = Layout(out_root=f"{scratch}/gold")
    first = run_silver(spark, req, dlv, ver, layout, days=("2024-01-01", "2024-01-10"))
    n_first = first.count()
    second = run_silver(spark, req, dlv, ver, layout, days=("2024-01-11", "2024-01-30"))
    full = run_silver(spark, req, dlv, ver, Layout(out_root=f"{scratch}/full"))
    assert second.count() == full.count() == 1000 - 11 and 0 < n_first < 1000
    cols = sorted(c for c in full.columns)
    a = sorted(map(tuple, second.select(*cols).collect()), key=repr)
    b = sorted(map(tuple, full.select(*cols).collect()), key=repr)
    assert a == b                     # two incremental runs == one full build


def test_run_anomaly_appends_to_jdbc(spark):
    import uuid
    from pumpguard.plans.registry import silver
    from pumpguard.sources.readers import read_jdbc
    url = f"jdbc:derby:memory:a{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    scored = run_anomaly(spark, silver(spark, SF), keys=("enterprise_id", "number_range"),
                         jdbc_url=url, jdbc_properties=props)
    back = read_jdbc(spark, url, "fraud_anomalies", props)
    assert back.count() == scored.filter("is_anomaly").count() > 0
    assert {c.lower() for c in back.columns} >= {"enterprise_id", "requests", "verify_rate",
                                                 "anomaly_score", "scored_at"}


def _dated_inputs(spark):
    req = spark.createDataFrame(
        [("a", "5501990001", "2024-01-04 23:59:00"), ("b", "5501990002", "2024-01-05 10:00:00"),
         ("a", "5501990001", "2024-01-05 00:01:00"), ("c", "5501990003", "2024-01-06 10:00:00"),
         ("d", "5501990004", None)], "request_id string, msisdn string, event_ts string")
    dlv = spark.createDataFrame([("b", "delivered", 5, "2024-01-05 10:00:01")],
                                "request_id string, status string, operator_latency_ms int, event_ts string")
    ver = spark.createDataFrame([("b", "verified", 1, "2024-01-09 10:00:00")],   # days later
                                "request_id string, outcome string, attempts int, event_ts string")
    return [d.withColumn("event_ts", F.to_timestamp("event_ts")) for d in (req, dlv, ver)]


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def test_days_after_a_full_run_keep_the_layer(spark, scratch):
    from pumpguard.plans.jobs import run_silver
    layout, inputs = Layout(out_root=scratch), _dated_inputs(spark)
    full = _rows(run_silver(spark, *inputs, layout))
    assert len(full) == 3                                  # a once, b, c; d has no day
    assert spark.read.parquet(f"{scratch}/silver_quarantine").count() == 1
    for day in ("2024-01-05", "2024-01-04", "2024-01-07"):
        assert _rows(run_silver(spark, *inputs, layout, days=(day, day))) == full


def test_a_failing_rebuild_leaves_the_old_layer(spark, scratch):
    import pytest
    from pumpguard.plans.jobs import run_silver
    layout, inputs = Layout(out_root=scratch), _dated_inputs(spark)
    before = _rows(run_silver(spark, *inputs, layout))
    broken = inputs[0].withColumn("msisdn", F.raise_error(F.lit("lost input")))
    with pytest.raises(Exception, match="lost input"):
        run_silver(spark, broken, *inputs[1:], layout)
    unchecked = [inputs[0].withColumn("request_id", F.lit(None).cast("string")), *inputs[1:]]
    with pytest.raises(AssertionError):
        run_silver(spark, *unchecked, layout)
    assert _rows(layout.read(spark, "silver")) == before


def test_replace_table_keeps_the_old_table_when_the_write_fails(spark):
    import pytest
    from pumpguard.sinks.writers import replace_table
    replace_table(spark.range(3), "pg_replaced")
    with pytest.raises(Exception, match="no good"):
        replace_table(spark.range(2).select(F.raise_error(F.lit("no good")).alias("id")), "pg_replaced")
    assert spark.table("pg_replaced").count() == 3
    replace_table(spark.range(5), "pg_replaced")
    assert spark.table("pg_replaced").count() == 5
    spark.sql("DROP TABLE pg_replaced")


def test_a_streamed_folder_is_not_compacted_in_place(spark, scratch):
    import pytest
    from pumpguard.plans.registry import land_messages
    from pumpguard.sinks.writers import compact
    from pumpguard.streaming.pipelines import run_bronze
    land_messages(spark, SF, f"{scratch}/landing", only=("requests",))
    for q in run_bronze(spark, f"{scratch}/out", f"{scratch}/ck", topics=("requests",),
                        landing_root=f"{scratch}/landing", fmt=LANDING_FORMAT):
        q.awaitTermination()
    path = f"{scratch}/out/bronze/requests"
    n = spark.read.parquet(path).count()
    with pytest.raises(ValueError):
        compact(spark, path)
    assert spark.read.parquet(compact(spark, path, target_path=f"{scratch}/c")).count() == n
    assert spark.read.parquet(path).count() == n


def test_state_partitions_do_not_follow_the_cluster(spark, scratch, monkeypatch):
    from pumpguard.streaming.pipelines import state_partitions
    key = "spark.sql.shuffle.partitions"
    monkeypatch.setenv("PG_STATE_PARTITIONS", "24")
    before = spark.conf.get(key)
    with state_partitions(spark):
        assert spark.conf.get(key) == "24"
    assert spark.conf.get(key) == before


def test_private_checkpoint_folder_only_in_local_mode():
    from pumpguard.session import is_local
    assert is_local("local") and is_local("local[8]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("spark://h:7077")


def test_alert_that_falls_back_to_low_is_withdrawn(spark, scratch):
    from pumpguard.sinks.writers import AlertSink, write_alerts
    from pumpguard.streaming.pipelines import latest_alerts
    cols = ("window_start timestamp, window_end timestamp, enterprise_id string, number_range string, "
            "mcc string, mnc string, requests long, score double, severity string")

    def rows(severity, who="e"):
        return spark.createDataFrame([(None, None, who, "550199", "1", "1", 5, 1.0, severity)], cols)
    fn = write_alerts(AlertSink("parquet", path=scratch, all_versions=True))
    fn(rows("high").union(rows("high", "f")), 0)
    fn(rows("low"), 1)
    fn(rows("low"), 1)                                     # replayed
    assert [r["enterprise_id"] for r in latest_alerts(spark, scratch).collect()] == ["f"]


def test_a_replayed_batch_is_in_the_alerts_table_once(spark):
    from pumpguard.sinks.writers import AlertSink, write_alerts
    url = "jdbc:derby:memory:pgreplay;create=true"
    fn = write_alerts(AlertSink("jdbc", url=url, table="fraud_alerts"))
    rows = spark.createDataFrame([("e", "high"), ("f", "low")], "enterprise_id string, severity string")
    for batch in (0, 1, 1):
        fn(rows, batch)
    got = spark.read.jdbc(url, "fraud_alerts").collect()
    assert sorted(r["batch_id"] for r in got) == [0, 1]


def test_a_daily_run_keeps_undated_and_early_children_and_undated_requests(spark, scratch):
    from pumpguard.plans.jobs import run_silver
    ts = "CAST(event_ts AS TIMESTAMP) AS event_ts"

    def bronze(rows, columns, name):
        df = spark.createDataFrame(rows, f"{columns}, event_ts string").selectExpr(
            *[c.split()[0] for c in columns.split(", ")], ts, "to_date(event_ts) AS event_date")
        df.write.partitionBy("event_date").parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")
    days = "2024-01-01 10:00:00", "2024-01-02 00:00:01", "2024-01-01 23:59:59"
    old = [("r1", "5501990001", days[0]), ("r2", "5501990002", days[1]), ("r3", "5501990003", days[1]),
           ("r4", "5501990004", None), ("r4", "5501990004", None)]
    req, more = (bronze(rows, "request_id string, msisdn string", name) for rows, name in (
        (old, "req"), ([*old, ("r5", "5501990005", None), ("r4", "5501990004", None)], "more")))
    dlv = bronze([("r1", "delivered", days[0]), ("r2", "delivered", days[2]), ("r3", "failed", None)],
                 "request_id string, status string", "dlv")
    ver = bronze([("r2", "verified", None), ("r3", "verified", days[2])],
                 "request_id string, outcome string", "ver")
    layout, fresh = Layout(out_root=f"{scratch}/out"), Layout(out_root=f"{scratch}/fresh")
    full = sorted(map(str, run_silver(spark, req, dlv, ver, layout).collect()))
    assert len(full) == 3 and "delivery_status=None" not in "".join(full)
    for _ in range(2):
        daily = run_silver(spark, more, dlv, ver, layout, days=("2024-01-02", "2024-01-02"))
        assert sorted(map(str, daily.collect())) == full
        lost = layout.read(spark, "silver_quarantine").collect()
        assert sorted(r["request_id"] for r in lost) == ["r4", "r4", "r4", "r5"]
    run_silver(spark, more, dlv, ver, fresh, days=("2024-01-02", "2024-01-02"))
    assert fresh.read(spark, "silver_quarantine").count() == 4
