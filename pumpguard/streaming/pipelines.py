"""Structured Streaming pipelines: Bronze landing, windowed fraud aggregates, alerting.

Every query takes a checkpoint location (mandatory: restart resumes from committed offsets)
and a trigger (``available_now`` for bounded replays, a processing-time interval otherwise).
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pumpguard.config import RuleConfig, Settings
from pumpguard.functions.columns import number_range, to_event_time
from pumpguard.operators.aggregates import FRAUD_KEYS, score_aggregates
from pumpguard.schemas import SCHEMAS, TOPICS
from pumpguard.sinks.writers import AlertSink, alerts_only, write_alerts
from pumpguard.sources.readers import parse_json, read_stream


_STARTING = threading.Lock()


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Number of state-store partitions for stateful queries started inside the block.

    A stateful stream fixes its partition count in the checkpoint at the first batch and AQE
    cannot coalesce it, so it is a setting of its own (``Settings.state_partitions``, a stated
    default, whatever executors happen to be there at the start). The query clones the session
    conf at ``start()``, so the setting is restored right after; starts wait for each other."""
    key = "spark.sql.shuffle.partitions"
    n = n or Settings.from_env().state_partitions
    with _STARTING:
        old = spark.conf.get(key)
        spark.conf.set(key, str(n))
        try:
            yield
        finally:
            spark.conf.set(key, old)


def _start(writer, spark: SparkSession, n: int | None, path: str | None = None,
           table: str | None = None) -> StreamingQuery:
    with state_partitions(spark, n):
        if table:
            return writer.toTable(table)
        return writer.start(path) if path else writer.start()


def _trigger(writer, trigger: str | None):
    """``available_now`` (or None): process what is there, then stop; ``default``: micro-batches
    back to back; anything else: a processing-time interval such as ``"1 minute"``."""
    if trigger in (None, "", "available_now"):
        return writer.trigger(availableNow=True)
    if trigger == "default":
        return writer
    return writer.trigger(processingTime=trigger)


def parse_events(messages: DataFrame, topic: str) -> tuple[DataFrame, DataFrame]:
    """Parsed rows with ``event_ts`` as TIMESTAMP (unparsable time -> NULL), and quarantine."""
    parsed, bad = parse_json(messages, SCHEMAS[topic])
    return parsed.withColumn("event_ts", to_event_time("event_ts")), bad


def land_stream(df: DataFrame, checkpoint: str, path: str | None = None,
                table: str | None = None, fmt: str = "parquet",
                trigger: str | None = "available_now",
                partition_by: Sequence[str] = (), n_state: int | None = None) -> StreamingQuery:
    """Append a stream to a table or a directory (exactly-once through the sink's log)."""
    w = (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .format(fmt))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = _trigger(w, trigger)
    return _start(w, df.sparkSession, n_state, path=path, table=table)


def run_bronze(spark: SparkSession, out_root: str, checkpoint_root: str,
               settings: Settings | None = None, topics: Sequence[str] = tuple(TOPICS),
               landing_root: str | None = None, trigger: str | None = "available_now",
               fmt: str | None = None, partition_by_day: bool = True) -> list[StreamingQuery]:
    """Land all three topics (and their quarantines), one query per output.

    Bronze is partitioned by ``event_date`` (day of the event time) so later reads prune by
    day; the many small files a stream writes are merged by ``sinks.writers.compact``."""
    s = settings or Settings.from_env()
    queries = []
    for t in topics:
        src = f"{landing_root.rstrip('/')}/{t}" if landing_root else None
        raw = read_stream(spark, TOPICS[t], s, starting="earliest", path=src, fmt=fmt)
        parsed, bad = parse_events(raw, t)
        parts: tuple[str, ...] = ()
        if partition_by_day:
            parsed = parsed.withColumn("event_date", F.to_date("event_ts"))
            parts = ("event_date",)
        queries.append(land_stream(parsed, f"{checkpoint_root}/bronze_{t}",
                                   path=f"{out_root}/bronze/{t}", trigger=trigger,
                                   partition_by=parts))
        queries.append(land_stream(bad, f"{checkpoint_root}/quarantine_{t}",
                                   path=f"{out_root}/quarantine/{t}", trigger=trigger))
    return queries


def dedupe_stream(events: DataFrame, keys: Sequence[str] = ("request_id",),
                  delay: str = "10 minutes", ts_col: str = "event_ts") -> DataFrame:
    """Drop repeats of a key that arrive within the watermark delay."""
    return (events.withWatermark(ts_col, delay)
            .dropDuplicatesWithinWatermark(list(keys)))


def join_verifications_stream(requests: DataFrame, verification: DataFrame,
                              bound: str = "10 minutes", delay: str = "10 minutes",
                              dedupe: bool = True,
                              requests_watermarked: bool = False) -> DataFrame:
    """Requests left-joined to *verified* verifications arriving within ``bound`` of the request.

    Both sides carry watermarks, so join state is dropped once a request is older than the
    bound; a verification later than the bound does not count (the latency/accuracy trade).
    The output has ``v`` = 1 for a verified request, else 0 (emitted once the bound expires).
    ``delay`` is the watermark delay of both sides; ``requests_watermarked=True`` when
    ``requests`` already carries its watermark (e.g. from ``dedupe_stream``).
    Repeated verified events of one request count once (dedupe within the watermark)."""
    r = (requests if requests_watermarked
         else requests.withWatermark("event_ts", delay)).alias("r")
    v = (verification.filter(F.col("outcome") == "verified")
         .select(F.col("request_id").alias("v_request_id"), F.col("event_ts").alias("v_ts"))
         .withWatermark("v_ts", delay))
    if dedupe:
        v = v.dropDuplicatesWithinWatermark(["v_request_id"])
    v = v.alias("v")
    cond = ((F.col("r.request_id") == F.col("v.v_request_id"))
            & (F.col("v.v_ts") >= F.col("r.event_ts"))
            & (F.col("v.v_ts") <= F.col("r.event_ts") + F.expr(f"INTERVAL {bound}")))
    joined = r.join(v, cond, "leftOuter")
    return joined.select("r.*", F.when(F.col("v_request_id").isNotNull(), 1).otherwise(0)
                         .cast("long").alias("v"))


def windowed_aggregate(events: DataFrame, size: str = "5 minutes", slide: str | None = None,
                       keys: Sequence[str] = FRAUD_KEYS, delay: str | None = "10 minutes",
                       msisdn_max: bool = False, approx_distinct_ip: bool = False,
                       verified_col: str | None = None) -> DataFrame:
    """Streaming fraud aggregate per (window, keys).

    Single level (requests [, verifications] [, approximate distinct IPs]) runs in update or
    append mode. ``msisdn_max`` chains a second aggregate over the per-msisdn counts, grouped
    by the first level's ``window`` (which carries the event time, so each row stays in its own
    window even when windows slide): append mode only. ``delay=None`` when the input already
    carries its watermark."""
    ev = events if "number_range" in events.columns else events.withColumn(
        "number_range", number_range("msisdn"))
    if delay:
        ev = ev.withWatermark("event_ts", delay)
    win = F.window("event_ts", size, slide) if slide else F.window("event_ts", size)
    v = F.col(verified_col).cast("long") if verified_col else F.lit(0).cast("long")
    keys = list(keys)
    if not msisdn_max:
        aggs = [F.count(F.lit(1)).alias("requests")]
        if verified_col:
            aggs.append(F.sum(v).alias("verifications"))
        if approx_distinct_ip:
            aggs.append(F.approx_count_distinct("ip").alias("distinct_ip"))
        out = ev.groupBy(win.alias("window"), *keys).agg(*aggs)
    else:
        lvl1 = (ev.groupBy(win.alias("window"), *keys, "msisdn")
                .agg(F.count(F.lit(1)).alias("_n"), F.sum(v).alias("_v")))
        aggs = [F.sum("_n").alias("requests")]
        if verified_col:
            aggs.append(F.sum("_v").alias("verifications"))
        aggs.append(F.max("_n").alias("msisdn_max_count"))
        out = lvl1.groupBy("window", *keys).agg(*aggs)
    return out.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"),
                      *[c for c in out.columns if c != "window"])


def score_stream(agg: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Rules as columns inside the streaming plan (no collect, no UDF)."""
    return score_aggregates(agg, cfg)


def fraud_stream(requests_raw: DataFrame, verification_raw: DataFrame | None = None,
                 size: str = "5 minutes", slide: str | None = None,
                 delay: str = "10 minutes", bound: str = "10 minutes",
                 cfg: RuleConfig = RuleConfig(), keys: Sequence[str] = FRAUD_KEYS) -> DataFrame:
    """Parsed request (and verification) streams -> scored windowed aggregates.

    dedupe within watermark -> left join to verifications within ``bound`` -> two-level window
    aggregate (per-msisdn maximum) -> rule columns. Append mode: each window once, final.
    ``verification_raw=None`` is the requests-only mode (verifications count as 0)."""
    req = dedupe_stream(requests_raw, ["request_id"], delay)
    if verification_raw is not None:
        req = join_verifications_stream(req, verification_raw, bound, delay,
                                        requests_watermarked=True)
        vcol = "v"
    else:
        vcol = None
    agg = windowed_aggregate(req, size, slide, keys, None, msisdn_max=True, verified_col=vcol)
    return score_stream(agg, cfg)


def start_alerts(scored: DataFrame, sink: AlertSink, checkpoint: str,
                 trigger: str | None = "available_now", mode: str = "append",
                 n_state: int | None = None) -> StreamingQuery:
    """Alerts (severity <> low) through ``foreachBatch``: executor-side writes, idempotent per
    batch id for file sinks."""
    w = (scored.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(write_alerts(sink)))
    return _start(_trigger(w, trigger), scored.sparkSession, n_state)


def score_micro_batch(sink_path: str, cfg: RuleConfig = RuleConfig(),
                      keys: Sequence[str] = FRAUD_KEYS):
    """``foreachBatch`` function: aggregate and score inside one micro-batch (no state across
    batches), then write the batch's scored rows, idempotently by batch id."""
    from pumpguard.operators.aggregates import fraud_aggregate

    def fn(df: DataFrame, batch_id: int) -> None:
        scored = score_aggregates(fraud_aggregate(df, keys), cfg)
        (scored.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_path))
    return fn


class LateRows(StreamingQueryListener):
    """Counts rows dropped behind the watermark, by query id, over a query's whole life (a query
    itself remembers its last batches only). ``spark.streams.addListener(LateRows())`` before
    the query starts."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + _dropped(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def _dropped(progress) -> int:
    ops = progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators
    return sum(int((op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict)
                    else op.numRowsDroppedByWatermark) or 0) for op in ops)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark in the batches that the query still remembers (the
    last hundred by default); ``LateRows`` counts all."""
    return sum(_dropped(p) for p in query.recentProgress)


def for_each_batch(df: DataFrame, fn, checkpoint: str, trigger: str | None = "available_now",
                   mode: str = "append", n_state: int | None = None) -> StreamingQuery:
    """Call ``fn(batch_df, batch_id)`` for every micro-batch; ``fn`` should use ``batch_id`` to
    stay idempotent when a batch is replayed after a failure."""
    w = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(fn))
    return _start(_trigger(w, trigger), df.sparkSession, n_state)


def publish_stream(alerts: DataFrame, checkpoint: str, topic: str = "otp.alerts",
                   bootstrap: str | None = None, path: str | None = None,
                   trigger: str | None = "available_now") -> StreamingQuery:
    """Alerts as (key, JSON value) messages: to a Kafka topic, or to JSON files offline."""
    from pumpguard.sinks.writers import to_alert_messages
    msgs = to_alert_messages(alerts)
    w = msgs.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if bootstrap:
        w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        return _start(_trigger(w, trigger), alerts.sparkSession, None)
    return _start(_trigger(w.format("json"), trigger), alerts.sparkSession, None,
                  path=f"{path.rstrip('/')}/{topic}")


def latest_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts written in update mode (one row per changed window and batch) reduced to the latest
    version per alert key: the keyed merge that keeps repeated updates from double counting. An
    alert whose latest version is low is gone (a sink with ``all_versions`` keeps that one)."""
    from pumpguard.operators.silver import dedupe
    from pumpguard.schemas import ALERT_KEY
    df = spark.read.parquet(path)
    keys = [k for k in ALERT_KEY if k in df.columns]
    return alerts_only(dedupe(df, keys, ["batch_id"], latest=True))
