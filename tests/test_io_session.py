"""Readers, table writers and the session builder."""

import uuid

from pyspark.sql import functions as F

from pumpguard.plans.registry import LANDING_FORMAT


def test_read_batch_and_stream_share_the_message_shape(spark, scratch):
    from pumpguard.sources.readers import MESSAGE_SCHEMA, read_batch, read_stream
    (spark.createDataFrame([("k1", '{"request_id":"r1"}', None)],
                           "key string, value string, arrival_ts timestamp")
     .write.json(f"{scratch}/otp.requests"))
    from pumpguard.config import Settings
    s = Settings(source_format="json", landing_dir=scratch)
    b = read_batch(spark, "otp.requests", s)
    assert b.schema == MESSAGE_SCHEMA and b.count() == 1
    st = read_stream(spark, "otp.requests", s, starting="latest")
    assert st.isStreaming and st.schema == MESSAGE_SCHEMA


def test_namespace_replace_and_pruned_table_read(spark):
    from pumpguard.sinks.writers import ensure_namespace, replace_table
    from pumpguard.sources.readers import read_table
    ns = f"pg_{uuid.uuid4().hex[:8]}"
    ensure_namespace(spark, ns)
    ensure_namespace(spark, ns)                       # no-op when present
    t = f"{ns}.events_small"
    replace_table(spark.range(10).withColumn("x", F.col("id") * 2), t)
    replace_table(spark.range(3).withColumn("x", F.col("id") * 3), t)   # full rebuild
    df = read_table(spark, t, ["x"])
    assert sorted(r["x"] for r in df.collect()) == [0, 3, 6]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:bigint>" in plan     # only the needed column is read
    spark.sql(f"DROP TABLE {t}")
    spark.sql(f"DROP NAMESPACE {ns}")


def test_build_session_defaults(spark):
    from pumpguard.session import build_session, checkpoint_root, scratch_path
    s = build_session("t")                            # returns the active session
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"
    root = checkpoint_root(s)
    a, b = scratch_path(s, "x"), scratch_path(s, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_bucketed_bronze_builds_silver_without_shuffle(spark):
    from pumpguard.operators.silver import build_silver
    from pumpguard.sinks.writers import ensure_namespace, write_bucketed
    from pumpguard.sources import fixtures as FX
    ns = f"pgb_{uuid.uuid4().hex[:8]}"
    ensure_namespace(spark, ns)
    ev = FX.read_events(spark, "/root/testdata/sf0.001")
    for name, df in (("requests", FX.requests(ev)), ("delivery", FX.delivery(ev)),
                     ("verification", FX.verification(ev))):
        write_bucketed(df, f"{ns}.{name}", "request_id", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = build_silver(spark.table(f"{ns}.requests"), spark.table(f"{ns}.delivery"),
                         spark.table(f"{ns}.verification"))
        plan = s._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
        assert s.count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("requests", "delivery", "verification"):
            spark.sql(f"DROP TABLE IF EXISTS {ns}.{name}")
        spark.sql(f"DROP NAMESPACE IF EXISTS {ns}")


def test_stream_lands_into_catalog_table(spark, scratch):
    from pumpguard.plans.registry import END_OF_REPLAY, land_messages
    from pumpguard.sources.readers import read_stream
    from pumpguard.streaming.pipelines import land_stream, parse_events
    land_messages(spark, "/root/testdata/sf0.001", f"{scratch}/landing", only=("requests",))
    raw = read_stream(spark, "otp.requests", path=f"{scratch}/landing/requests", fmt=LANDING_FORMAT)
    parsed, _ = parse_events(raw, "requests")
    t = f"bronze_requests_{uuid.uuid4().hex[:8]}"
    land_stream(parsed, f"{scratch}/ck", table=t).awaitTermination()
    n = spark.table(t).filter(F.col("request_id") != END_OF_REPLAY).count()
    spark.sql(f"DROP TABLE {t}")
    from pumpguard.sources import fixtures as FX
    ev = FX.read_events(spark, "/root/testdata/sf0.001")
    want = FX.requests_raw(ev).filter(F.col("event_id") % 97 != 0).count()
    assert n == want == 1008         # raw requests minus the malformed messages


def test_catalog_options_only_when_configured():
    from pumpguard.config import Settings
    from pumpguard.session import catalog_conf
    assert catalog_conf(Settings()) == {}
    conf = catalog_conf(Settings(catalog="lake", catalog_impl="x.SparkCatalog",
                                 catalog_type="rest", catalog_uri="http://cat",
                                 warehouse="s3a://wh"))
    assert conf["spark.sql.catalog.lake"] == "x.SparkCatalog"
    assert conf["spark.sql.catalog.lake.type"] == "rest"
    assert conf["spark.sql.catalog.lake.warehouse"] == "s3a://wh"
    assert conf["spark.sql.defaultCatalog"] == "lake"


def test_bad_event_time_becomes_null_and_drops_out_of_windows(spark):
    from pumpguard.operators.aggregates import fraud_aggregate
    from pumpguard.schemas import REQUEST_SCHEMA
    from pumpguard.streaming.pipelines import parse_events
    msgs = spark.createDataFrame(
        [("r1", '{"request_id":"r1","msisdn":"5501990001","event_ts":"garbage"}'),
         ("r2", '{"request_id":"r2","msisdn":"5501990001",'
                '"event_ts":"2024-01-01T10:00:00.000001+00:00"}')],
        "key string, value string")
    parsed, bad = parse_events(msgs, "requests")
    rows = {r["request_id"]: r["event_ts"] for r in parsed.collect()}
    assert rows["r1"] is None and rows["r2"] is not None and bad.count() == 0
    agg = fraud_aggregate(parsed.withColumn("enterprise_id", F.lit("e"))
                          .withColumn("mcc", F.lit("1")).withColumn("mnc", F.lit("1")),
                          window=("1 hour", None))
    assert [r["requests"] for r in agg.collect()] == [1]


def test_bronze_is_day_partitioned_and_silver_reads_it(spark, scratch):
    from pumpguard.operators.silver import build_silver
    from pumpguard.plans.registry import land_messages
    from pumpguard.streaming.pipelines import run_bronze
    land_messages(spark, "/root/testdata/sf0.001", f"{scratch}/landing", end_marker=False)
    for q in run_bronze(spark, f"{scratch}/lake", f"{scratch}/ck",
                        landing_root=f"{scratch}/landing", fmt=LANDING_FORMAT):
        q.awaitTermination()
    req, dlv, ver = (spark.read.parquet(f"{scratch}/lake/bronze/{t}")
                     for t in ("requests", "delivery", "verification"))
    day = req.filter(F.col("event_date") == F.lit("2024-01-15").cast("date"))
    assert "PartitionFilters: [isnotnull(event_date" in \
        day._jdf.queryExecution().executedPlan().toString()
    s = build_silver(req, dlv, ver)
    assert {"event_date", "delivery_date", "verification_date"} <= set(s.columns)
    assert s.count() == 1000 - 11
