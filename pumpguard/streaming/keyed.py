"""Windowed fraud aggregates that speak before the window is final: keyed state with timers.

``windowed_aggregate`` finds the per-msisdn maximum by two chained aggregates, which Spark runs in
append mode only: a group appears when its window is closed. Here the two levels are two keyed
states instead. The first keeps the counts of the numbers, the second the groups' sums and their
largest number, and emits a new version of a group for every batch that touched it. Both drop
their state by a timer at the window's end, when the watermark passes it.

A call into Python state costs far more than a row, so a key of either state is a window and one
of ``BUCKETS`` buckets, and its value holds all entries of that bucket as JSON. The
first state is dealt by group and msisdn, so that a burst on one group is spread over its numbers;
the second by group. A batch reads and writes the buckets that it touched, whole, so the buckets of
a window should hold thousands of numbers each, not millions: give ``buckets`` for such windows.

Rows are combined before the first shuffle: ``COMBINED_ROWS`` rows at a time are reduced to one
entry for each (pane, group, msisdn), the pane being the longest interval that divides size and
slide, and the entries of a pane and bucket are sent as one row, so that the calls into the state
get few rows. A single number that sends a third of all rows costs an entry a pane each time.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType, TimestampType

from pumpguard.operators.aggregates import FRAUD_KEYS, pane, with_number_range
from pumpguard.operators.silver import dedupe

# workers need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Buckets of a window in each state: fixed for the life of a checkpoint.
BUCKETS = 8
#: Rows that are combined at a time before the first shuffle.
COMBINED_ROWS = 100_000


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside the block keep their state in RocksDB, which keyed state needs. (A
    query copies the settings when it starts.)"""
    old = spark.conf.get(STATE_PROVIDER, None)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(STATE_PROVIDER)
        else:
            spark.conf.set(STATE_PROVIDER, old)


def _combined(by: list[str], rows: int = COMBINED_ROWS):
    """Sums of ``n`` and ``v`` and the latest ``ts`` for each value of ``by``, over Arrow batches
    of ``rows`` rows together."""
    def sums(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = held[0].schema
        out = pa.Table.from_batches(held).group_by(by).aggregate([("n", "sum"), ("v", "sum"), ("ts", "max")])
        out = out.rename_columns([*by, "n", "v", "ts"])
        yield from out.select(schema.names).cast(schema).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= rows:
                yield from sums(held)
                held, n = [], 0
        if held:
            yield from sums(held)
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each pane and bucket of combined rows: its entries as JSON, and the latest ``ts``
    (a time within the pane, so it lies in the windows of all of them)."""
    for batch in _combined(["pane", "bucket", "g", "msisdn"])(batches):
        ts_type = batch.schema.field("ts").type
        columns = [batch[c].cast("int64") for c in ("pane", "ts")] + [
            batch[c] for c in ("bucket", "g", "msisdn", "n", "v")]
        dealt: dict[tuple, tuple[list[int], dict[str, list]]] = {}
        for pane_, ts, bucket, g, msisdn, n, v in zip(*[c.to_numpy(zero_copy_only=False).tolist() for c in columns]):
            at = dealt.get((pane_, bucket))
            if at is None:
                at = dealt[pane_, bucket] = ([ts], {})
            elif ts > at[0][0]:
                at[0][0] = ts
            numbers = at[1].get(g)
            if numbers is None:
                numbers = at[1][g] = []
            numbers.append((msisdn, n, v))
        yield pa.RecordBatch.from_arrays(
            [pa.array([bucket for _, bucket in dealt], pa.int64()),
             pa.array([_text([*groups.items()]) for _, groups in dealt.values()], pa.string()),
             pa.array([latest[0] for latest, _ in dealt.values()], pa.int64()).cast(ts_type)],
            names=["bucket", "entries", "ts"])


def _text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


class _NumberCounts(StatefulProcessor):
    """The counts of the numbers in one window and bucket; passes on what changed by group."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "held string")

    def handleInputRows(self, key, rows, timerValues):
        start_ms, end_ms, _ = key
        old = self.counts.get()
        if old is None:
            self.handle.registerTimer(end_ms)
        totals = {g: dict(numbers) for g, numbers in json.loads(old[0])} if old else {}
        told: dict[str, list[int]] = {}
        for r in rows:
            for g, entries in json.loads(r.entries):
                numbers = totals.setdefault(g, {})
                t = told.setdefault(g, [0, 0, 0])
                for msisdn, n, v in entries:
                    numbers[msisdn] = total = numbers.get(msisdn, 0) + n
                    t[0], t[1], t[2] = t[0] + n, t[1] + v, max(t[2], total)
        self.counts.update((_text([[g, [*numbers.items()]] for g, numbers in totals.items()]),))
        closes = datetime.fromtimestamp(end_ms / 1000, timezone.utc)
        dealt: dict[int, list] = {}
        for g, t in told.items():
            dealt.setdefault(zlib.crc32(g.encode("utf-8", "surrogatepass")) % self.buckets, []).append([g, *t])
        for bucket, changed in dealt.items():
            yield Row(start_ms=start_ms, end_ms=end_ms, bucket=bucket, closes=closes, changed=_text(changed))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.counts.clear()
        return iter(())

    def close(self) -> None:
        pass


class _GroupVersions(StatefulProcessor):
    """The sums and the largest msisdn of the groups in one window and bucket; a version for every
    group that changed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.group = handle.getValueState("group", "held string")

    def handleInputRows(self, key, rows, timerValues):
        start_ms, end_ms, _ = key
        old = self.group.get()
        if old is None:
            self.handle.registerTimer(end_ms)
        groups = json.loads(old[0]) if old else {}
        told = {}
        for r in rows:
            for g, n, v, total in json.loads(r.changed):
                requests, verifications, most = groups.get(g, (0, 0, 0))
                groups[g] = told[g] = (requests + n, verifications + v, max(most, total))
        self.group.update((_text(groups),))
        requests, verifications, most = map(list, zip(*told.values()))
        yield Row(start_ms=start_ms, end_ms=end_ms, g=[*told], requests=requests,
                  verifications=verifications, msisdn_max_count=most)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.group.clear()
        return iter(())

    def close(self) -> None:
        pass


def early_aggregate(events: DataFrame, size: str = "5 minutes", slide: str | None = None,
                    keys: Sequence[str] = FRAUD_KEYS, delay: str = "10 minutes",
                    verified_col: str | None = None, ts_col: str = "event_ts",
                    buckets: int = BUCKETS) -> DataFrame:
    """Versions of (window, keys): requests, verifications and msisdn_max_count so far.

    ``events`` is a stream without a watermark. Each micro-batch emits one row, its newest version,
    for every group it touched; ``latest_versions`` keeps the last of each. A row counts until the
    watermark (the latest time seen less ``delay``) has reached the end of its window, as in
    ``windowed_aggregate``; rows without a time drop out. Null keys and numbers are values like
    any other. Runs in append mode (versions are new rows, none is revised in place); start it
    inside ``rocksdb_state``. ``buckets`` bounds the tasks that share one window, and stays as it
    is for the life of a checkpoint; windows of very many numbers want more."""
    keys = list(keys)
    v: Column = F.col(verified_col).cast("long") if verified_col else F.lit(0).cast("long")
    rows = with_number_range(events).filter(F.col(ts_col).isNotNull())
    first = F.window(F.col(ts_col), pane(size, slide)) if slide else F.window(F.col(ts_col), size)
    group = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]))  # without null keys
    rows = rows.select(first["start"].alias("pane"), group.alias("g"),
                       F.col("msisdn").cast("string").alias("msisdn"), F.lit(1).cast("long").alias("n"),
                       F.coalesce(v, F.lit(0)).alias("v"), F.col(ts_col).alias("ts"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("g", "msisdn"), F.lit(buckets)).cast("long"))
    rows = rows.mapInArrow(_packed, "bucket long, entries string, ts timestamp").withWatermark("ts", delay)
    # the window column carries the watermark, so a row is late when its window is closed
    win = F.window("ts", size, slide) if slide else F.window("ts", size)
    rows = rows.select(win.alias("window"), "bucket", "entries").withColumns({
        "start_ms": F.unix_millis("window.start"), "end_ms": F.unix_millis("window.end")})
    at = ["start_ms", "end_ms"]
    plain = [StructField(c, LongType()) for c in at]
    counted = rows.groupBy(*at, "bucket").transformWithState(
        _NumberCounts(buckets),
        StructType([*plain, StructField("bucket", LongType()), StructField("closes", TimestampType()),
                    StructField("changed", StringType())]),
        "Append", "EventTime", eventTimeColumnName="closes")
    sums = ["requests", "verifications", "msisdn_max_count"]
    versions = counted.groupBy(*at, "bucket").transformWithState(
        _GroupVersions(),
        StructType([*plain, StructField("g", ArrayType(StringType())),
                    *[StructField(c, ArrayType(LongType())) for c in sums]]), "Append", "EventTime")
    versions = versions.select(*at, F.inline(F.arrays_zip("g", *sums)))
    names = StructType([StructField(k, StringType()) for k in keys])
    versions = versions.withColumn("k", F.from_json("g", names))
    out = ["requests", *(["verifications"] if verified_col else []), "msisdn_max_count"]
    return versions.select(F.timestamp_millis("start_ms").alias("window_start"),
                           F.timestamp_millis("end_ms").alias("window_end"),
                           *[F.col("k").getField(k).alias(k) for k in keys], *out)


def write_versions(path: str):
    """A ``foreachBatch`` function: a batch's versions, under its ``batch_id`` (a replayed batch
    replaces its own)."""
    def fn(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    return fn


def latest_versions(spark: SparkSession, path: str, keys: Sequence[str] = FRAUD_KEYS) -> DataFrame:
    """The last version of every (window, keys) that was written with its ``batch_id``."""
    return dedupe(spark.read.parquet(path), ["window_start", "window_end", *keys], ["batch_id"], latest=True)


def state_rows(spark: SparkSession, checkpoint: str, level: str) -> DataFrame:
    """What a query of ``early_aggregate`` holds, read from its checkpoint by Spark's state data
    source: ``level`` is ``numbers`` (the first keyed state) or ``groups``. One row for each window
    and bucket, its entries as JSON, with the state partition it lies in."""
    names = {"numbers": "counts", "groups": "group"}
    # operators are numbered from the sink's side of the plan in the order they run
    for operator in (0, 1):
        try:
            return (spark.read.format("statestore").option("operatorId", operator)
                    .option("stateVarName", names[level]).load(checkpoint))
        except Exception as e:  # the variable belongs to the other operator
            if operator or names[level] not in str(e):
                raise
    raise AssertionError("unreachable")
