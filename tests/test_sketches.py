"""Distinct counts by pane: error bound, panes = events, stream = batch, hot groups and nulls."""

import datetime as dt
import json

from pyspark.sql import functions as F

from pumpguard.operators import sketches as S
from pumpguard.sources.readers import read_stream
from pumpguard.streaming.pipelines import land_stream, parse_events

KEYS = ["enterprise_id"]


def calls(spark, n):
    """A third of the rows in one group; 20,000 addresses there, up to 300 in the others."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 50)).alias("enterprise_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 20_000).otherwise(F.col("id") % 300).cast("string").alias("ip"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 7200)).alias("event_ts"))


def test_windows_from_panes_are_within_the_bound(spark):
    df = calls(spark, 200_000)
    panes = S.distinct_panes(df, keys=KEYS, pane="5 minutes")
    told = S.distinct_windows(panes, keys=KEYS, size="1 hour", slide="15 minutes").collect()
    exact = {(r["w"], r["enterprise_id"]): r["n"] for r in df.groupBy(
        F.window("event_ts", "1 hour", "15 minutes").getField("start").alias("w"), "enterprise_id")
        .agg(F.count_distinct("ip").alias("n")).collect()}
    assert len(told) == len(exact) > 300 and max(exact.values()) > 5000
    for r in told:
        n = exact[r["window_start"], r["enterprise_id"]]
        assert abs(r["distinct_ip"] - n) <= S.error_bound(n)


def test_a_pane_twice_nulls_and_no_rows(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", "1", at), ("a", "1", at), ("a", None, at), (None, "2", at), ("b", None, at),
                                ("c", "3", None)], "enterprise_id string, ip string, event_ts timestamp")
    panes = S.distinct_panes(df, keys=KEYS)
    got = {r["enterprise_id"]: r["distinct_ip"]
           for r in S.distinct_windows(panes.union(panes), keys=KEYS).collect()}
    assert got == {"a": 1, None: 1, "b": 0}
    assert S.distinct_windows(S.distinct_panes(df.filter("false"), keys=KEYS), keys=KEYS).count() == 0


def test_stream_panes_give_the_batch_estimates(spark, scratch):
    rows = [(str(i), f"10.0.{i % 900 // 30}.{i % 30}", 60 * (i % 40)) for i in range(3000)]
    end = [("end", "0.0.0.0", 10 ** 7)]
    msgs = [(k, json.dumps({"request_id": k, "enterprise_id": "e", "ip": ip, "event_ts":
             (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)).isoformat() + "+00:00"}), None)
            for k, ip, s in rows + end]
    spark.createDataFrame(msgs, "key string, value string, arrival_ts timestamp").write.json(f"{scratch}/in")
    parsed, _ = parse_events(read_stream(spark, "otp.requests", path=f"{scratch}/in", fmt="json"), "requests")
    land_stream(S.distinct_panes(parsed, keys=KEYS, pane="5 minutes", delay="1 minute"), f"{scratch}/ck",
                f"{scratch}/panes").awaitTermination()
    batch, _ = parse_events(spark.read.schema("key string, value string, arrival_ts timestamp")
                            .json(f"{scratch}/in"), "requests")

    def told(panes):
        return sorted(tuple(r) for r in S.distinct_windows(panes, keys=KEYS, slide="10 minutes").collect())
    want = told(S.distinct_panes(batch.filter("request_id <> 'end'"), keys=KEYS, pane="5 minutes"))
    assert told(spark.read.parquet(f"{scratch}/panes")) == want and len(want) >= 8
