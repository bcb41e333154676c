"""Named queries over the provided tables: each is ``(spark, sf_dir) -> DataFrame``.

Every query reads ``events`` (through the fixture binding) and runs over the whole table.
Timestamps in results are TIMESTAMP_NTZ so they compare equal across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpguard.config import RuleConfig
from pumpguard.operators import aggregates as A
from pumpguard.operators import marts as M
from pumpguard.operators import quality as Q
from pumpguard.operators.features import entity_features
from pumpguard.operators.silver import build_silver, dedupe
from pumpguard.sources import fixtures as FX
from pumpguard.sources.readers import parse_json
from pumpguard.schemas import REQUEST_SCHEMA
from pumpguard.functions.columns import to_event_time

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CFG = RuleConfig()
# Daily windows at sf0.01 peak at 82 requests per group, so the daily alert queries use a
# lower AIT volume threshold (same value on the Spark and the SQL side).
DAILY_CFG = CFG.replace(ait_min_requests=50)
# Per-number rule: the provided data has at most ~20 requests per number at sf0.01.
MSISDN_CFG = CFG.replace(never_verified_min_requests=10)
# Hourly windows of one entity at sf0.01: a few of them hold more requests than this.
VELOCITY_CEILING = 3


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def prepare(spark: SparkSession) -> None:
    # The pipeline's convention: event time is UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return FX.read_events(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return build_silver(FX.requests(ev), FX.delivery(ev), FX.verification(ev))


def scored_aggregate(spark: SparkSession, sf_dir: str, cfg: RuleConfig = CFG) -> DataFrame:
    agg = A.fraud_aggregate(silver(spark, sf_dir), msisdn_max=True, distinct_ip=True)
    return A.rule_breakdown(agg, cfg)


def daily_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = A.fraud_aggregate(silver(spark, sf_dir), msisdn_max=True, distinct_ip=True,
                            window=("1 day", None))
    return A.score_aggregates(agg, DAILY_CFG)


def daily_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily-window alerts; ``created_at`` is the window start (no wall clock in a replay)."""
    return (A.alerts_only(daily_scored(spark, sf_dir))
            .withColumn("created_at", F.col("window_start")))


# --------------------------------------------------------------------------- ingest / silver

@query("parse_requests")
def q_parse_requests(spark, sf_dir):
    payloads = FX.request_payloads(events(spark, sf_dir))
    parsed, _ = parse_json(payloads, REQUEST_SCHEMA)
    return parsed.withColumn("event_ts", to_event_time("event_ts").cast("timestamp_ntz"))


@query("quarantine_requests")
def q_quarantine_requests(spark, sf_dir):
    payloads = FX.request_payloads(events(spark, sf_dir))
    _, bad = parse_json(payloads, REQUEST_SCHEMA)
    return bad.select("key", "value")


@query("dedupe_requests")
def q_dedupe_requests(spark, sf_dir):
    return dedupe(FX.requests(events(spark, sf_dir)), ["request_id"])


@query("dedupe_latest_delivery")
def q_dedupe_latest_delivery(spark, sf_dir):
    ev = events(spark, sf_dir)
    both = FX.delivery(ev).unionByName(
        FX.delivery(ev).filter(F.col("request_id").endswith("3"))
        .withColumn("event_ts", F.timestamp_add("SECOND", F.lit(1), F.col("event_ts")))
        .withColumn("status", F.lit("expired")))
    return dedupe(both, ["request_id"], ["event_ts"], latest=True)


@query("silver_events")
def q_silver_events(spark, sf_dir):
    return silver(spark, sf_dir)


@query("silver_job_full_then_days")
def q_silver_job_full_then_days(spark, sf_dir):
    """The Silver job on Bronze partitioned by day: a full run, then a rerun of its last day; the
    layer as it is read back, without the days of the children."""
    from pumpguard.plans.jobs import Layout, run_silver
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import write_partitioned
    ev = events(spark, sf_dir)
    inputs = []
    for name, df in (("requests", FX.requests(ev)), ("delivery", FX.delivery(ev)),
                     ("verification", FX.verification(ev))):
        bronze = scratch_path(spark, f"bronze-{name}")
        write_partitioned(df, path=bronze)
        inputs.append(spark.read.parquet(bronze))
    layout = Layout(out_root=scratch_path(spark, "silver-job"))
    full = run_silver(spark, *inputs, layout)
    day = str(full.agg(F.max("event_date")).first()[0])
    return (run_silver(spark, *inputs, layout, days=(day, day))
            .drop("delivery_date", "verification_date"))


@query("verified_membership")
def q_verified_membership(spark, sf_dir):
    ev = events(spark, sf_dir)
    return A.mark_verified(FX.requests(ev), FX.verification(ev))


# --------------------------------------------------------------------------- marts

@query("delivery_funnel")
def q_delivery_funnel(spark, sf_dir):
    return M.delivery_funnel(silver(spark, sf_dir))


@query("latency_pct")
def q_latency_pct(spark, sf_dir):
    return M.latency_percentiles(silver(spark, sf_dir))


@query("ait_loss")
def q_ait_loss(spark, sf_dir):
    return M.ait_loss(M.delivery_funnel(silver(spark, sf_dir)), CFG)


@query("ait_loss_top")
def q_ait_loss_top(spark, sf_dir):
    return M.top_loss(M.ait_loss(M.delivery_funnel(silver(spark, sf_dir)), CFG), 10)


@query("ait_loss_by_route")
def q_ait_loss_by_route(spark, sf_dir):
    return M.ait_loss_by_route(M.ait_loss(M.delivery_funnel(silver(spark, sf_dir)), CFG))


@query("funnel_by_country_day")
def q_funnel_by_country_day(spark, sf_dir):
    return M.delivery_funnel(silver(spark, sf_dir), ("country_iso",), bucket="day")


@query("verify_latency_pct")
def q_verify_latency_pct(spark, sf_dir):
    return M.verify_latency_percentiles(silver(spark, sf_dir))


@query("operator_performance")
def q_operator_performance(spark, sf_dir):
    return M.operator_performance(silver(spark, sf_dir))


def _partials(spark, sf_dir, name: str) -> DataFrame:
    """Partials by day: all days at first, from a Silver that lacks the verifications of its last
    day and holds strays of a later one; then the last day again, with the strays gone."""
    from pumpguard.operators.daily import update_partials
    from pumpguard.plans.jobs import Layout
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import write_partitioned
    path = scratch_path(spark, "silver-by-day")
    write_partitioned(silver(spark, sf_dir), path=path)
    whole = spark.read.parquet(path)
    last = whole.agg(F.max("event_date")).first()[0]
    on_last = F.col("event_date") == F.lit(last)
    early = whole.withColumns({c: F.when(~on_last, F.col(c)) for c in
                               ("verification_ts", "delivery_ts", "operator_latency_ms", "delivery_status")})
    early = early.withColumn("is_verified", F.col("is_verified") & ~on_last).filter(
        ~on_last | (F.pmod(F.xxhash64("request_id"), F.lit(3)) > 0))
    layout = Layout(out_root=scratch_path(spark, "partials"))
    update_partials(spark, early, layout)
    return update_partials(spark, whole, layout, (str(last), str(last)))[name]


@query("delivery_funnel_by_day")
def q_delivery_funnel_by_day(spark, sf_dir):
    from pumpguard.operators.daily import merged_funnel
    return merged_funnel(_partials(spark, sf_dir, "funnel_days"))


@query("latency_pct_by_day")
def q_latency_pct_by_day(spark, sf_dir):
    from pumpguard.operators.daily import merged_latency
    return merged_latency(_partials(spark, sf_dir, "latency_days"))


@query("verify_latency_pct_by_day")
def q_verify_latency_pct_by_day(spark, sf_dir):
    from pumpguard.operators.daily import merged_verify_latency
    return merged_verify_latency(_partials(spark, sf_dir, "verify_days"))


@query("operator_performance_by_day")
def q_operator_performance_by_day(spark, sf_dir):
    from pumpguard.operators.daily import merged_performance
    return merged_performance(_partials(spark, sf_dir, "latency_days"))


# --------------------------------------------------------------------------- fraud aggregates

@query("fraud_aggregate_batch")
def q_fraud_aggregate_batch(spark, sf_dir):
    return A.fraud_aggregate(FX.requests(events(spark, sf_dir)))


@query("fraud_aggregate_verified")
def q_fraud_aggregate_verified(spark, sf_dir):
    ev = events(spark, sf_dir)
    return A.fraud_aggregate(FX.requests(ev), verification=FX.verification(ev),
                             msisdn_max=True, distinct_ip=True)


@query("rule_scores")
def q_rule_scores(spark, sf_dir):
    return scored_aggregate(spark, sf_dir)


@query("fraud_alerts")
def q_fraud_alerts(spark, sf_dir):
    return A.alerts_only(scored_aggregate(spark, sf_dir))


@query("alerts_by_severity")
def q_alerts_by_severity(spark, sf_dir):
    return M.alerts_by_severity(A.alerts_only(scored_aggregate(spark, sf_dir)))


@query("windowed_aggregate_tumbling")
def q_windowed_aggregate_tumbling(spark, sf_dir):
    return A.fraud_aggregate(silver(spark, sf_dir), msisdn_max=True,
                             window=("5 minutes", None))


@query("windowed_alerts_daily")
def q_windowed_alerts_daily(spark, sf_dir):
    return A.alerts_only(daily_scored(spark, sf_dir))


@query("fraud_daily")
def q_fraud_daily(spark, sf_dir):
    return M.fraud_daily(daily_alerts(spark, sf_dir))


@query("fraud_daily_by_dimension")
def q_fraud_daily_by_dimension(spark, sf_dir):
    return M.fraud_daily(daily_alerts(spark, sf_dir), ("enterprise_id", "mcc", "mnc"))


@query("sliding_velocity_by_dimension")
def q_sliding_velocity(spark, sf_dir):
    return A.velocity_by(silver(spark, sf_dir), ("msisdn", "ip", "enterprise_id", "number_range"),
                         "5 minutes", "1 minute", CFG.velocity_msisdn_ceiling)


@query("velocity_alerts_by_dimension")
def q_velocity_alerts(spark, sf_dir):
    """Only the windows over the ceiling. The provided data has at most a few requests per value
    in five minutes at sf0.01, so hourly windows and a lower ceiling are used."""
    return A.velocity_by(silver(spark, sf_dir), ("msisdn", "ip", "enterprise_id", "number_range"),
                         "1 hour", "10 minutes", VELOCITY_CEILING, over_only=True)


@query("never_verified_msisdn")
def q_never_verified_msisdn(spark, sf_dir):
    return A.never_verified_msisdns(silver(spark, sf_dir), MSISDN_CFG)


# --------------------------------------------------------------------------- features / quality

@query("entity_features")
def q_entity_features(spark, sf_dir):
    return entity_features(silver(spark, sf_dir))


@query("entity_features_by_range")
def q_entity_features_by_range(spark, sf_dir):
    return entity_features(silver(spark, sf_dir), ("enterprise_id", "number_range"))


@query("quality_silver")
def q_quality_silver(spark, sf_dir):
    return Q.silver_checks(silver(spark, sf_dir))


@query("quality_marts")
def q_quality_marts(spark, sf_dir):
    from pumpguard.session import scratch_path
    layer = scratch_path(spark, "silver-for-marts")     # written once, as the batch job does
    silver(spark, sf_dir).select("enterprise_id", "mcc", "mnc", "delivery_status", "is_verified",
                                 "operator_latency_ms").write.parquet(layer)
    s = spark.read.parquet(layer)
    mart = scratch_path(spark, "funnel-mart")
    M.delivery_funnel(s).write.parquet(mart)
    funnel = spark.read.parquet(mart)
    return Q.mart_checks(funnel, M.latency_percentiles(s), M.ait_loss(funnel, CFG))


@query("quality_relations")
def q_quality_relations(spark, sf_dir):
    ev = events(spark, sf_dir)
    req, dlv, ver = FX.requests(ev), FX.delivery(ev), FX.verification(ev)
    return Q.table_checks(
        ("requests", req), [("delivery", dlv), ("verification", ver)], "request_id",
        unique=("requests", "delivery"), related=("delivery", "verification"),
        values=[("delivery", "status", ("delivered", "failed", "expired")),
                ("verification", "outcome", ("verified", "failed", "timeout")),
                ("requests", "channel", ("sms", "voice", "whatsapp"))])


@query("layer_reconciliation")
def q_layer_reconciliation(spark, sf_dir):
    ev = events(spark, sf_dir)
    req = FX.requests(ev)
    s = build_silver(req, FX.delivery(ev), FX.verification(ev))
    return Q.reconcile([
        ("source", ev, None),
        ("bronze_requests", req, None),
        ("silver", s, req.select("request_id").distinct()),
    ])


def _message_layers(spark, sf_dir):
    messages = FX.request_payloads(events(spark, sf_dir))
    parsed, bad = parse_json(messages, REQUEST_SCHEMA)
    return messages, parsed, bad


def _ids(df):
    return df.select("request_id").distinct()


@query("bronze_reconciliation")
def q_bronze_reconciliation(spark, sf_dir):
    """Every layer against an expectation: messages = Bronze + quarantine, Bronze = messages that
    are no malformed text, Silver = distinct request ids of Bronze."""
    messages, parsed, bad = _message_layers(spark, sf_dir)
    return Q.reconcile([
        ("messages", messages, parsed.select("request_id").union(bad.select("key"))),
        ("bronze_requests", parsed, messages.filter(F.col("value") != "not-json")),
        ("silver", dedupe(parsed, ["request_id"]), _ids(parsed)),
    ])


@query("bronze_reconciliation_broken")
def q_bronze_reconciliation_broken(spark, sf_dir):
    """The same with a Bronze that kept no quarantine and a Silver that was not deduplicated:
    both layers must fail."""
    messages, parsed, _ = _message_layers(spark, sf_dir)
    return Q.reconcile([
        ("messages", messages, parsed),
        ("bronze_requests", parsed, messages.filter(F.col("value") != "not-json")),
        ("silver", parsed, _ids(parsed)),
    ])


# --------------------------------------------------------------------------- anomaly detection
@query("anomaly_scores")
def q_anomaly_scores(spark, sf_dir):
    from pumpguard.operators.forest import fit_and_score
    return fit_and_score(entity_features(silver(spark, sf_dir)))


@query("anomaly_scores_by_range")
def q_anomaly_scores_by_range(spark, sf_dir):
    from pumpguard.operators.forest import fit_and_score
    keys = ("enterprise_id", "number_range")
    return fit_and_score(entity_features(silver(spark, sf_dir), keys), keys)


@query("anomaly_scores_sampled")
def q_anomaly_scores_sampled(spark, sf_dir):
    """Per msisdn: more entities than a tree takes, so every tree is grown over a sample."""
    from pumpguard.operators.forest import fit_and_score
    return fit_and_score(entity_features(silver(spark, sf_dir), ("msisdn",)), ("msisdn",), psi=64, trees=25)


@query("anomaly_saved_model")
def q_anomaly_saved_model(spark, sf_dir):
    """A forest fitted on the requests of all days but the last, saved, read again, and applied to
    the entities of the last day without a fit."""
    from pumpguard.operators import forest
    from pumpguard.session import scratch_path
    keys = ("enterprise_id", "number_range")
    days = silver(spark, sf_dir).withColumn("day", F.to_date("event_ts"))
    last = days.agg(F.max("day")).first()[0]
    path = scratch_path(spark, "forest-model")
    model, _ = forest.fit(entity_features(days.filter(F.col("day") < F.lit(last)), keys), keys)
    forest.save_model(model, path)
    return forest.score(entity_features(days.filter(F.col("day") == F.lit(last)), keys),
                        forest.load_model(spark, path))


# --------------------------------------------------------------------------- streaming
# Each streaming query replays messages derived from ``events`` through a landing directory in
# the shared checkpoint folder, runs with ``availableNow`` and returns a batch read of its sink.
# Append-mode windows close only when the watermark passes them, so the replay ends with one
# far-future end-of-input message per topic (its own group is never emitted; stateless
# outputs filter it by key).

END_OF_REPLAY = "__end_of_replay__"
REPLAY_STATE = 8               # state partitions of a replay
LANDING_FORMAT = "json"        # message files (key, JSON value, arrival time) of a replay
END_TS = "2100-01-01T00:00:00.000000+00:00"


def land_messages(spark: SparkSession, sf_dir: str, root: str, end_marker: bool = True,
                  only: tuple[str, ...] = ("requests", "delivery", "verification"),
                  part: Column | None = None) -> str:
    """Write the topics in ``only`` as JSON message files under ``root`` (the stream's source).
    ``part`` lands only the messages it selects, beside what has landed before."""
    ev = events(spark, sf_dir)
    builders = {"requests": FX.request_payloads, "delivery": FX.delivery_payloads,
                "verification": FX.verification_payloads}
    topics = {t: builders[t](ev) for t in only}
    end_body = {
        "requests": F.to_json(F.struct(F.lit(END_OF_REPLAY).alias("request_id"),
                                       F.lit(END_TS).alias("event_ts"))),
        "delivery": F.to_json(F.struct(F.lit(END_OF_REPLAY).alias("request_id"),
                                       F.lit("delivered").alias("status"),
                                       F.lit(END_TS).alias("event_ts"))),
        "verification": F.to_json(F.struct(F.lit(END_OF_REPLAY).alias("request_id"),
                                           F.lit("verified").alias("outcome"),
                                           F.lit(END_TS).alias("event_ts"))),
    }
    for t, df in topics.items():
        df = df if part is None else df.filter(part)
        df.select("key", "value", F.col("arrival_ts").cast("timestamp")).write \
            .mode("overwrite" if part is None else "append").format(LANDING_FORMAT) \
            .save(f"{root}/{t}")
        if end_marker:
            (spark.range(1).select(F.lit(END_OF_REPLAY).alias("key"),
                                   end_body[t].alias("value"),
                                   F.lit(None).cast("timestamp").alias("arrival_ts"))
             .coalesce(1).write.mode("append").format(LANDING_FORMAT).save(f"{root}/{t}"))
    return root


def _stream_source(spark, root: str, topic: str):
    from pumpguard.sources.readers import read_stream
    from pumpguard.streaming.pipelines import parse_events
    raw = read_stream(spark, topic, path=f"{root}/{topic}", fmt=LANDING_FORMAT)
    return parse_events(raw, topic)


def _ntz(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
                           if f.dataType.typeName() == "timestamp"})


def _await(queries) -> None:
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()
        if q.exception():
            raise q.exception()


@query("stream_bronze_landing")
def q_stream_bronze_landing(spark, sf_dir):
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import run_bronze
    root = scratch_path(spark, "bronze-replay")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    _await(run_bronze(spark, f"{root}/out", f"{root}/ckpt", topics=("requests",),
                      landing_root=f"{root}/landing", fmt=LANDING_FORMAT))
    out = spark.read.parquet(f"{root}/out/bronze/requests")      # day-partitioned
    return _ntz(out.filter(F.col("request_id") != END_OF_REPLAY).drop("event_date"))


@query("stream_bronze_quarantine")
def q_stream_bronze_quarantine(spark, sf_dir):
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import run_bronze
    root = scratch_path(spark, "quarantine-replay")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    _await(run_bronze(spark, f"{root}/out", f"{root}/ckpt", topics=("requests",),
                      landing_root=f"{root}/landing", fmt=LANDING_FORMAT))
    return spark.read.parquet(f"{root}/out/quarantine/requests").select("key", "value")


@query("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import dedupe_stream, land_stream
    root = scratch_path(spark, "dedupe-replay")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    req, _ = _stream_source(spark, f"{root}/landing", "requests")
    _await(land_stream(dedupe_stream(req, ["request_id"]), f"{root}/ckpt", f"{root}/out",
                       n_state=REPLAY_STATE))
    out = spark.read.parquet(f"{root}/out")
    return _ntz(out.filter(F.col("request_id") != END_OF_REPLAY))


@query("stream_windowed_aggregate")
def q_stream_windowed_aggregate(spark, sf_dir):
    """5-minute tumbling requests per (enterprise, range, mcc, mnc), watermark 10 minutes."""
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import land_stream, windowed_aggregate
    root = scratch_path(spark, "window-replay")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    req, _ = _stream_source(spark, f"{root}/landing", "requests")
    agg = windowed_aggregate(req, "5 minutes")
    _await(land_stream(agg, f"{root}/ckpt", f"{root}/out",
                       n_state=REPLAY_STATE))
    return _ntz(spark.read.parquet(f"{root}/out"))


@query("stream_sliding_msisdn_max")
def q_stream_sliding_msisdn_max(spark, sf_dir):
    """Sliding (1 hour / 30 minutes) two-level aggregate: requests and per-msisdn maximum."""
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import land_stream, windowed_aggregate
    root = scratch_path(spark, "sliding-replay")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    req, _ = _stream_source(spark, f"{root}/landing", "requests")
    agg = windowed_aggregate(req, "1 hour", "30 minutes", msisdn_max=True)
    _await(land_stream(agg, f"{root}/ckpt", f"{root}/out",
                       n_state=REPLAY_STATE))
    return _ntz(spark.read.parquet(f"{root}/out"))


@query("stream_fraud_alerts")
def q_stream_fraud_alerts(spark, sf_dir):
    """dedupe -> stream-stream join to verifications -> daily two-level window -> score ->
    alerts through foreachBatch (idempotent per batch id)."""
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import AlertSink
    from pumpguard.streaming.pipelines import fraud_stream, start_alerts
    root = scratch_path(spark, "alerts-replay")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests", "verification"))
    req, _ = _stream_source(spark, f"{root}/landing", "requests")
    ver, _ = _stream_source(spark, f"{root}/landing", "verification")
    scored = fraud_stream(req, ver, size="1 day", cfg=DAILY_CFG)
    _await(start_alerts(scored, AlertSink("parquet", path=f"{root}/alerts"), f"{root}/ckpt",
                        n_state=REPLAY_STATE))
    return _ntz(spark.read.parquet(f"{root}/alerts").drop("batch_id", "created_at"))


@query("stream_distinct_ip_panes")
def q_stream_distinct_ip_panes(spark, sf_dir):
    """Distinct IPs of sliding windows (1 hour / 30 minutes) from registers that a stream keeps per
    pane of 10 minutes, with the exact count beside the estimate."""
    from pumpguard.functions.columns import number_range
    from pumpguard.operators import sketches as S
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import land_stream, parse_events
    root = scratch_path(spark, "ip-panes")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    requests, _ = _stream_source(spark, f"{root}/landing", "requests")
    ranged = requests.withColumn("number_range", number_range("msisdn"))
    panes = S.distinct_panes(ranged, pane="10 minutes", delay="10 minutes")
    _await(land_stream(panes, f"{root}/ckpt", path=f"{root}/panes", n_state=REPLAY_STATE))
    told = S.distinct_windows(spark.read.parquet(f"{root}/panes"), "estimate", slide="30 minutes")
    batch, _ = parse_events(FX.request_payloads(events(spark, sf_dir)), "requests")
    exact = A.fraud_aggregate(batch.withColumn("number_range", number_range("msisdn")),
                              distinct_ip=True, window=("1 hour", "30 minutes"))
    keys = ["window_start", "window_end", *A.FRAUD_KEYS]
    both = exact.join(told, keys, "left")
    return _ntz(both.select(*keys, "distinct_ip", "estimate"))


def _revised(spark, sf_dir):
    """Daily alerts streamed with a bound of 30 seconds, which many verifications miss, then two
    revisions by the batch result over all messages: the folders and both change feeds."""
    from pumpguard.operators.revision import final_scores, revise_alerts
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import AlertSink
    from pumpguard.streaming.pipelines import fraud_stream, parse_events, start_alerts
    root = scratch_path(spark, "alerts-revised")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests", "verification"))
    req, _ = _stream_source(spark, f"{root}/landing", "requests")
    ver, _ = _stream_source(spark, f"{root}/landing", "verification")
    scored = fraud_stream(req, ver, size="1 day", bound="30 seconds", cfg=DAILY_CFG)
    _await(start_alerts(scored, AlertSink("parquet", path=f"{root}/alerts"), f"{root}/ckpt",
                        n_state=REPLAY_STATE))
    ev = events(spark, sf_dir)
    requests, _ = parse_events(FX.request_payloads(ev), "requests")
    verification, _ = parse_events(FX.verification_payloads(ev), "verification")
    final = final_scores(requests, verification, "1 day", cfg=DAILY_CFG)
    feeds = [revise_alerts(spark, f"{root}/alerts", f"{root}/revisions", final) for _ in range(2)]
    return f"{root}/alerts", f"{root}/revisions", feeds


@query("stream_alerts_revised")
def q_stream_alerts_revised(spark, sf_dir):
    """The alerts that stand after the revisions: those of the batch result."""
    from pumpguard.operators.revision import current_alerts
    alerts, revisions, _ = _revised(spark, sf_dir)
    return _ntz(current_alerts(spark, alerts, revisions))


@query("alert_revision_changes")
def q_alert_revision_changes(spark, sf_dir):
    """The change feed of the first revision, and of the second, which must keep all."""
    _, _, (first, second) = _revised(spark, sf_dir)
    columns = ["window_start", "window_end", "enterprise_id", "number_range", "mcc", "mnc", "change",
               "requests", "verifications", "score", "severity", "told_verifications", "told_score",
               "told_severity"]
    return _ntz(first.select(F.lit(0).alias("revision"), *columns)
                .union(second.select(F.lit(1), *columns)))


@query("stream_micro_batch_scoring")
def q_stream_micro_batch_scoring(spark, sf_dir):
    """Per-micro-batch aggregate + score (no state across batches); one batch per replay."""
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import for_each_batch, score_micro_batch
    root = scratch_path(spark, "microbatch-replay")
    land_messages(spark, sf_dir, f"{root}/landing", end_marker=False, only=("requests",))
    req, _ = _stream_source(spark, f"{root}/landing", "requests")
    _await(for_each_batch(req, score_micro_batch(f"{root}/out"), f"{root}/ckpt",
                          n_state=REPLAY_STATE))
    return spark.read.parquet(f"{root}/out").drop("batch_id")


# --------------------------------------------------------------------------- enrichment / sinks

@query("route_enrichment")
def q_route_enrichment(spark, sf_dir):
    from pumpguard.sources.routes import route_dimension
    return M.route_enrichment(silver(spark, sf_dir), route_dimension(spark))


@query("alert_payload")
def q_alert_payload(spark, sf_dir):
    from pumpguard.sinks.writers import to_alert_messages
    return to_alert_messages(A.alerts_only(daily_scored(spark, sf_dir)))


@query("partitioned_layout")
def q_partitioned_layout(spark, sf_dir):
    """Silver written day-partitioned (rebalanced by day) and read back whole: the layout round
    trip is lossless. Partition pruning on ``event_date`` is pinned by a plan test."""
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import write_partitioned
    path = scratch_path(spark, "silver-by-day")
    write_partitioned(silver(spark, sf_dir), path=path)
    return spark.read.parquet(path)


@query("compact_preserves_rows")
def q_compact_preserves_rows(spark, sf_dir):
    """Many small files per day -> compacted to one file per day; same rows."""
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import compact, with_event_date
    src = scratch_path(spark, "small-files")
    (with_event_date(silver(spark, sf_dir)).repartition(32).write
     .partitionBy("event_date").parquet(src))
    dest = compact(spark, src, target_path=scratch_path(spark, "compacted"))
    return spark.read.parquet(dest)


@query("compact_streamed_bronze")
def q_compact_streamed_bronze(spark, sf_dir):
    """Bronze landed by a stream, compacted into another folder and read back."""
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import compact
    from pumpguard.streaming.pipelines import run_bronze
    root = scratch_path(spark, "bronze-compact")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    _await(run_bronze(spark, f"{root}/out", f"{root}/ckpt", topics=("requests",),
                      landing_root=f"{root}/landing", fmt=LANDING_FORMAT))
    dest = compact(spark, f"{root}/out/bronze/requests", target_path=f"{root}/compacted")
    out = spark.read.parquet(dest)
    return _ntz(out.filter(F.col("request_id") != END_OF_REPLAY).drop("event_date"))


@query("alerts_jdbc_roundtrip")
def q_alerts_jdbc_roundtrip(spark, sf_dir):
    """Local only (an in-memory database that one process sees).

    Alerts written through the JDBC sink and read back with a partitioned JDBC scan
    (embedded in-memory Derby: in-process, no server)."""
    import uuid
    from pumpguard.sinks.writers import write_jdbc
    from pumpguard.sources.readers import read_jdbc
    url = f"jdbc:derby:memory:pg{uuid.uuid4().hex[:10]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    alerts = A.alerts_only(scored_aggregate(spark, sf_dir)).select(
        "enterprise_id", "number_range", "mcc", "mnc", "requests", "score", "severity")
    write_jdbc(alerts, url, "FRAUD_ALERTS", props)
    back = read_jdbc(spark, url, "FRAUD_ALERTS", props, partition_column="requests",
                     lower=0, upper=100_000, num_partitions=4)
    return back.select(*[F.col(c).alias(c.lower()) for c in back.columns])


@query("anomaly_worst")
def q_anomaly_worst(spark, sf_dir):
    from pumpguard.operators.forest import fit_and_score
    from pumpguard.operators.iforest import worst
    keys = ("enterprise_id", "number_range")
    return worst(fit_and_score(entity_features(silver(spark, sf_dir), keys), keys), 5, keys)


@query("stream_update_alerts")
def q_stream_update_alerts(spark, sf_dir):
    """The requests-only shape of the fraud job: single-level daily window in *update* mode
    (each changed group every batch), scored with verifications = 0, written per batch id and
    reduced to the latest version of each alert key (the keyed merge of update output)."""
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import AlertSink
    from pumpguard.streaming.pipelines import (latest_alerts, score_stream, start_alerts,
                                               windowed_aggregate)
    root = scratch_path(spark, "update-replay")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    req, _ = _stream_source(spark, f"{root}/landing", "requests")
    scored = score_stream(windowed_aggregate(req, "1 day"), CFG)
    _await(start_alerts(scored, AlertSink("parquet", path=f"{root}/alerts"), f"{root}/ckpt",
                        n_state=REPLAY_STATE,
                        mode="update"))
    return _ntz(latest_alerts(spark, f"{root}/alerts").drop("batch_id", "created_at"))


@query("stream_velocity_by_dimension")
def q_stream_velocity_by_dimension(spark, sf_dir):
    """Streaming velocity per msisdn / ip / enterprise / number range in sliding windows:
    dedupe within the watermark, then one expand-and-count aggregate (append mode), whose state of
    pane counts per value lies in RocksDB."""
    from pumpguard.session import scratch_path
    from pumpguard.streaming.keyed import rocksdb_state
    from pumpguard.streaming.pipelines import dedupe_stream, land_stream
    root = scratch_path(spark, "velocity-replay")
    land_messages(spark, sf_dir, f"{root}/landing", only=("requests",))
    req, _ = _stream_source(spark, f"{root}/landing", "requests")
    vel = A.velocity_by(dedupe_stream(req), ("msisdn", "ip", "enterprise_id", "number_range"),
                        "5 minutes", "1 minute", CFG.velocity_msisdn_ceiling, blocks=True)
    with rocksdb_state(spark):
        _await(land_stream(vel, f"{root}/ckpt", f"{root}/out",
                           n_state=REPLAY_STATE))
    # the end-of-input message's windows never close, so nothing of it is emitted
    return _ntz(spark.read.parquet(f"{root}/out"))


def time_slices(spark: SparkSession, sf_dir: str, n: int = 4) -> list[Column]:
    """Conditions that cut the request messages into ``n`` stretches of arrival time."""
    at = F.col("arrival_ts")
    shares = [i / n for i in range(1, n)]
    cuts = (FX.request_payloads(events(spark, sf_dir))
            .agg(F.percentile_approx(at, shares).alias("c")).first()["c"]) or []
    low = [F.lit(True), *[at > F.lit(c).cast("timestamp_ntz") for c in cuts]]
    high = [*[at <= F.lit(c).cast("timestamp_ntz") for c in cuts], F.lit(True)]
    return [a & b for a, b in zip(low, high)]


@query("stream_window_restarts")
def q_stream_window_restarts(spark, sf_dir):
    """The windowed aggregate over messages that land in four stretches of time; the query is
    stopped and restarted from its checkpoint after each, so windows that span two stretches
    are kept in state across batches and restarts."""
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import land_stream, windowed_aggregate
    root = scratch_path(spark, "restart-replay")
    slices = time_slices(spark, sf_dir)
    for i, part in enumerate(slices):
        land_messages(spark, sf_dir, f"{root}/landing", i == len(slices) - 1, ("requests",), part)
        req, _ = _stream_source(spark, f"{root}/landing", "requests")
        _await(land_stream(windowed_aggregate(req, "5 minutes"), f"{root}/ckpt", f"{root}/out",
                           n_state=REPLAY_STATE))
    return _ntz(spark.read.parquet(f"{root}/out"))


@query("stream_update_batches")
def q_stream_update_batches(spark, sf_dir):
    """Update mode over the same four stretches: a day's group is emitted again with every
    stretch that adds to it, and the keyed merge leaves the last version of each alert."""
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import AlertSink
    from pumpguard.streaming.pipelines import (latest_alerts, score_stream, start_alerts,
                                               windowed_aggregate)
    root = scratch_path(spark, "update-batches")
    for part in time_slices(spark, sf_dir):
        land_messages(spark, sf_dir, f"{root}/landing", False, ("requests",), part)
        req, _ = _stream_source(spark, f"{root}/landing", "requests")
        scored = score_stream(windowed_aggregate(req, "1 day"), CFG)
        _await(start_alerts(scored, AlertSink("parquet", path=f"{root}/alerts"), f"{root}/ckpt",
                            n_state=REPLAY_STATE, mode="update"))
    return _ntz(latest_alerts(spark, f"{root}/alerts").drop("batch_id", "created_at"))


LATE_EVERY = 53                # every 53rd request of the late replay arrives after the others


@query("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """Requests that land when all others have been read: those whose window the watermark has
    closed are dropped, the others still count."""
    from pumpguard.session import scratch_path
    from pumpguard.streaming.pipelines import land_stream, windowed_aggregate
    root = scratch_path(spark, "late-replay")
    late = F.col("key").cast("long") % LATE_EVERY == 0
    for part, last in ((~late, False), (late, False), (F.lit(False), True)):
        land_messages(spark, sf_dir, f"{root}/landing", last, ("requests",), part)
        req, _ = _stream_source(spark, f"{root}/landing", "requests")
        _await(land_stream(windowed_aggregate(req, "5 minutes"), f"{root}/ckpt", f"{root}/out",
                           n_state=REPLAY_STATE))
    return _ntz(spark.read.parquet(f"{root}/out"))


def _early(spark, root: str, size: str, slide: str | None = None) -> DataFrame:
    from pumpguard.streaming.keyed import early_aggregate
    return early_aggregate(_stream_source(spark, f"{root}/landing", "requests")[0], size, slide)


@query("stream_update_msisdn_max")
def q_stream_update_msisdn_max(spark, sf_dir):
    """Sliding windows with the per-msisdn maximum, told before they are final: keyed state over
    four stretches with a restart after each; the last version of every group. No end-of-input
    message is needed, as no window has to close first."""
    from pumpguard.session import scratch_path
    from pumpguard.streaming.keyed import latest_versions, rocksdb_state, write_versions
    from pumpguard.streaming.pipelines import for_each_batch
    root = scratch_path(spark, "early-replay")
    for part in time_slices(spark, sf_dir):
        land_messages(spark, sf_dir, f"{root}/landing", False, ("requests",), part)
        with rocksdb_state(spark):
            _await(for_each_batch(_early(spark, root, "1 hour", "30 minutes"),
                                  write_versions(f"{root}/out"), f"{root}/ckpt", n_state=REPLAY_STATE))
    return _ntz(latest_versions(spark, f"{root}/out").drop("batch_id"))


@query("stream_update_msisdn_late")
def q_stream_update_msisdn_late(spark, sf_dir):
    """The same for five-minute windows, scored, with every 53rd request landing when all others
    have been read: it changes the windows that are still open and no closed one."""
    from pumpguard.session import scratch_path
    from pumpguard.sinks.writers import AlertSink
    from pumpguard.streaming.keyed import latest_versions, rocksdb_state
    from pumpguard.streaming.pipelines import score_stream, start_alerts
    root = scratch_path(spark, "early-late")
    late = F.col("key").cast("long") % LATE_EVERY == 0
    sink = AlertSink("parquet", path=f"{root}/alerts", all_versions=True)
    for part in (~late, late):
        land_messages(spark, sf_dir, f"{root}/landing", False, ("requests",), part)
        with rocksdb_state(spark):
            _await(start_alerts(score_stream(_early(spark, root, "5 minutes"), CFG), sink, f"{root}/ckpt",
                                n_state=REPLAY_STATE))
    return _ntz(latest_versions(spark, f"{root}/alerts").drop("batch_id", "created_at"))
