"""Stream and batch readers over a topic source (Kafka) or a landing directory, JSON parsing,
table and JDBC scans. The source is a parameter, so the same pipeline runs on Kafka in
production and on a directory of files in tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpguard.config import Settings

# Landing-directory message schema: what a Kafka record carries that the pipeline uses.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("arrival_ts", T.TimestampType()),
])


def read_stream(spark: SparkSession, topic: str, settings: Settings | None = None,
                starting: str = "earliest", path: str | None = None,
                fmt: str | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of messages with at least ``key`` and ``value`` columns.

    ``fmt='kafka'`` subscribes to ``topic`` (``startingOffsets`` = ``starting``); ``json`` or
    ``parquet`` read a landing directory (``path``), each file exactly once."""
    s = settings or Settings()
    fmt = fmt or s.source_format
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", s.kafka_bootstrap)
             .option("subscribe", topic)
             .option("startingOffsets", starting))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        if s.kafka_min_partitions:
            r = r.option("minPartitions", s.kafka_min_partitions)
        return r.load().select(F.col("key").cast("string").alias("key"),
                               F.col("value").cast("string").alias("value"),
                               F.col("timestamp").alias("arrival_ts"))
    src = path or f"{s.landing_dir.rstrip('/')}/{topic}"
    r = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    return r.load(src)


def read_batch(spark: SparkSession, topic: str, settings: Settings | None = None,
               path: str | None = None, fmt: str | None = None) -> DataFrame:
    """Everything currently in a topic (or landing directory), as a bounded DataFrame."""
    s = settings or Settings()
    fmt = fmt or s.source_format
    if fmt == "kafka":
        return (spark.read.format("kafka")
                .option("kafka.bootstrap.servers", s.kafka_bootstrap)
                .option("subscribe", topic)
                .option("startingOffsets", "earliest").load()
                .select(F.col("key").cast("string").alias("key"),
                        F.col("value").cast("string").alias("value"),
                        F.col("timestamp").alias("arrival_ts")))
    src = path or f"{s.landing_dir.rstrip('/')}/{topic}"
    return spark.read.schema(MESSAGE_SCHEMA).format(fmt).load(src)


def parse_json(messages: DataFrame, schema: T.StructType, value_col: str = "value",
               key_field: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(parsed, quarantine).

    ``from_json`` turns unparsable text into a struct of NULLs (not a NULL struct), so a row is
    quarantined when its key field (default: the schema's first field) is NULL; the quarantine
    keeps the original message columns. Missing fields become NULL, unknown fields are ignored."""
    key_field = key_field or schema.fields[0].name
    d = F.from_json(F.col(value_col).cast("string"), schema)
    msg = {c: f"_msg_{c}" for c in messages.columns}
    # One parse per message: ``inline`` expands the parsed struct in a Generate node, and a
    # filter on generated columns is not pushed beneath it. (With a plain projection the
    # optimizer inlines the alias into the pushed-down filter and parses every message twice.)
    expanded = messages.select(*[F.col(c).alias(a) for c, a in msg.items()],
                               F.inline(F.array(d)))
    ok = F.col(key_field).isNotNull()
    parsed = expanded.filter(ok).select(*[f.name for f in schema.fields])
    quarantine = expanded.filter(~ok).select(*[F.col(a).alias(c) for c, a in msg.items()])
    return parsed, quarantine


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, pruned to ``columns`` (the pruning reaches the file scan)."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int = 8) -> DataFrame:
    """A database table; with ``partition_column`` the read is split into range predicates so
    several tasks read in parallel."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)
