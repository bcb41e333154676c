"""Windowed aggregates in early versions: keyed state against the batch aggregate."""

import json

import pytest
from pyspark.sql import functions as F

from pumpguard.operators.aggregates import FRAUD_KEYS, fraud_aggregate
from pumpguard.sources.readers import read_stream
from pumpguard.streaming.keyed import (early_aggregate, latest_versions, rocksdb_state, state_rows,
                                       write_versions)
from pumpguard.streaming.pipelines import for_each_batch, parse_events

ROWS = "request_id string, msisdn string, enterprise_id string, mcc string, mnc string, event_ts timestamp"


def land(spark, path, rows):
    """(id, msisdn, enterprise, time of day) -> one message file."""
    names = ("request_id", "msisdn", "enterprise_id", "mcc", "mnc", "event_ts")
    msgs = [(r[0], json.dumps(dict(zip(names, (*r[:3], "247", "1", r[3] and f"2024-01-01T{r[3]}:00+00:00")))), None)
            for r in rows]
    (spark.createDataFrame(msgs, "key string, value string, arrival_ts timestamp")
     .coalesce(1).write.mode("append").json(path))


def run(spark, root, size="10 minutes", slide=None):
    parsed, _ = parse_events(read_stream(spark, "otp.requests", path=f"{root}/in", fmt="json"), "requests")
    with rocksdb_state(spark):
        q = for_each_batch(early_aggregate(parsed, size, slide), write_versions(f"{root}/out"), f"{root}/ck", n_state=3)
    q.awaitTermination()


def batch(spark, rows, size="10 minutes", slide=None):
    df = spark.createDataFrame([(*r[:3], "247", "1", r[3] and f"2024-01-01 {r[3]}:00") for r in rows],
                               ROWS.replace("timestamp", "string"))
    df = df.withColumns({"event_ts": F.col("event_ts").cast("timestamp"), "ip": F.lit(None).cast("string")})
    return as_rows(fraud_aggregate(df, msisdn_max=True, window=(size, slide)))


def as_rows(df):
    cols = ["window_start", "window_end", *FRAUD_KEYS, "requests", "msisdn_max_count"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


STRETCHES = [
    [(f"a{i}", "5501990001", "e1", "12:01") for i in range(40)] + [("b", "5501990002", "e1", "12:02")],
    [(f"c{i}", f"550199{i % 7:04d}", "e1", "12:0" + str(3 + i % 5)) for i in range(30)]
    + [("d", "4477000001", None, "12:09"), ("n", "4477000001", "e2", None)],
    [("e", "5501990001", "e1", "12:04"), ("f", None, "e2", "12:13"), ("g", "", "e2", "12:13")],
]


@pytest.mark.parametrize("size,slide", [("10 minutes", None), ("10 minutes", "4 minutes")])
def test_versions_equal_the_batch_after_every_stretch(spark, scratch, size, slide):
    """Through a restart after each stretch; a number that dominates a stretch; nulls."""
    seen = []
    for rows in STRETCHES:
        land(spark, f"{scratch}/in", rows)
        seen += rows
        run(spark, scratch, size, slide)
        assert as_rows(latest_versions(spark, f"{scratch}/out")) == batch(spark, seen, size, slide)


def test_a_batch_emits_only_the_groups_it_touched(spark, scratch):
    for rows in STRETCHES[:1] + [[("z", "4477000009", "e9", "12:01")]]:
        land(spark, f"{scratch}/in", rows)
        run(spark, scratch)
    out = spark.read.parquet(f"{scratch}/out")
    last = out.agg(F.max("batch_id")).first()[0]
    assert [r["enterprise_id"] for r in out.filter(F.col("batch_id") == last).collect()] == ["e9"]
    assert out.filter("enterprise_id = 'e1'").count() == 1


def test_late_rows_count_until_their_window_closes_and_state_goes(spark, scratch):
    first = [("a", "5501990001", "e1", "12:01"), ("b", "5501990001", "e1", "12:24")]  # watermark 12:14
    land(spark, f"{scratch}/in", first)
    run(spark, scratch)
    late = [("c", "5501990001", "e1", "12:02"), ("d", "5501990001", "e1", "12:11")]
    land(spark, f"{scratch}/in", late)
    run(spark, scratch)
    got = as_rows(latest_versions(spark, f"{scratch}/out"))
    assert got == batch(spark, first + late[1:])       # 12:00-12:10 is closed, 12:10-12:20 is not
    ends = {r["key"]["end_ms"] // 60000 % 60 for r in state_rows(spark, f"{scratch}/ck", "numbers").collect()}
    assert ends == {20, 30}
    assert state_rows(spark, f"{scratch}/ck", "groups").count() == 2
    land(spark, f"{scratch}/in", [("e", "1", "e9", "13:30")])
    run(spark, scratch)
    for level in ("numbers", "groups"):                 # everything before 13:20 is dropped
        assert [r["key"]["end_ms"] // 60000 % 60 for r in state_rows(spark, f"{scratch}/ck", level).collect()] == [40]


def test_rows_are_combined_before_the_shuffle():
    import pyarrow as pa
    from pumpguard.streaming.keyed import _combined
    schema = pa.schema([("pane", pa.timestamp("us", tz="UTC")), ("k", pa.string()), ("n", pa.int64()),
                        ("v", pa.int64()), ("ts", pa.timestamp("us", tz="UTC"))])
    rows = [(0, "a", 1, 0, 5), (0, "a", 1, 1, 9), (60, "a", 1, 0, 61), (0, None, 1, 0, 1), (0, None, 1, 0, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    out = pa.Table.from_batches(list(_combined(["pane", "k"])(iter([batch])))).to_pylist()
    assert sorted((r["k"] or "", r["n"], r["v"]) for r in out) == [("", 2, 0), ("a", 1, 0), ("a", 2, 1)]
    assert list(_combined(["pane", "k"])(iter([batch.slice(0, 0)]))) == []


MANY = [(f"m{i}", f"44770{i % 60:05d}", f"e\u00e9{i % 4}" if i % 5 else None, f"12:0{i % 10}") for i in range(200)]


def test_many_numbers_of_a_window_share_few_state_keys(spark, scratch):
    """Tumbling: the calls into the state follow the windows and buckets, not the numbers."""
    for rows in (MANY, STRETCHES[0]):
        land(spark, f"{scratch}/in", rows)
        run(spark, scratch)
    assert as_rows(latest_versions(spark, f"{scratch}/out")) == batch(spark, MANY + STRETCHES[0])
    for level in ("numbers", "groups"):
        assert 1 < state_rows(spark, f"{scratch}/ck", level).count() <= 8


def test_sliding_windows_of_many_numbers_share_few_state_keys(spark, scratch):
    """12:00 to 12:09 lies in five windows; each has its buckets and no more."""
    for rows in (MANY[::2], MANY[1::2]):
        land(spark, f"{scratch}/in", rows)
        run(spark, scratch, "10 minutes", "4 minutes")
    assert as_rows(latest_versions(spark, f"{scratch}/out")) == batch(spark, MANY, "10 minutes", "4 minutes")
    for level in ("numbers", "groups"):
        keys = [r["key"]["end_ms"] for r in state_rows(spark, f"{scratch}/ck", level).collect()]
        assert max(map(keys.count, keys)) <= 8


def test_rows_of_a_pane_and_bucket_travel_as_one():
    """Also when they come in several Arrow batches; null numbers and the latest time are kept."""
    import pyarrow as pa
    from pumpguard.streaming.keyed import _packed
    ts = pa.timestamp("us", tz="UTC")
    schema = pa.schema([("pane", ts), ("g", pa.string()), ("msisdn", pa.string()), ("n", pa.int64()),
                        ("v", pa.int64()), ("ts", ts), ("bucket", pa.int64())])
    rows = [[(0, "a", "1", 1, 0, 5, 3), (0, "a", None, 1, 1, 9, 3), (60, "a", "1", 1, 0, 61, 3)],
            [(0, "b", '"\n', 1, 0, 7, 3), (0, "a", "1", 1, 1, 2, 3), (0, "a", "2", 1, 0, 4, 5)]]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
               for part in rows]
    out = pa.Table.from_batches(list(_packed(iter([*batches, batches[0].slice(0, 0)]))))
    out = out.set_column(2, "ts", out["ts"].cast("int64")).to_pylist()
    got = {(r["bucket"], r["ts"]): {(g, *e) for g, entries in json.loads(r["entries"]) for e in entries} for r in out}
    assert len(out) == 3 and got == {
        (3, 9): {("a", "1", 2, 1), ("a", None, 1, 1), ("b", '"\n', 1, 0)},
        (3, 61): {("a", "1", 1, 0)}, (5, 4): {("a", "2", 1, 0)}}
    assert list(_packed(iter([]))) == []
