"""One place to build a SparkSession and to find the shared scratch/checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from pumpguard.config import Settings


ROCKSDB_PROVIDER = ("org.apache.spark.sql.execution.streaming.state."
                    "RocksDBStateStoreProvider")


def build_session(app: str = "pumpguard", settings: Settings | None = None,
                  master: str | None = None, extra: dict | None = None,
                  rocksdb_state: bool = True) -> SparkSession:
    """AQE on (with skew-join splitting), UTC session time zone, UI off, RocksDB state store for
    large windowed / join / dedupe state; a v2 catalog only when one is configured."""
    s = settings or Settings.from_env()
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    # size shuffle partitions by bytes, not by parallelism: a large job keeps its many
    # partitions, a small one is coalesced
    conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    if s.advisory_partition_bytes:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = s.advisory_partition_bytes
    if s.max_partition_bytes:
        conf["spark.sql.files.maxPartitionBytes"] = s.max_partition_bytes
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
        conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if s.shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(s.shuffle_partitions)
    if s.checkpoint_root:
        conf["spark.checkpoint.dir"] = s.checkpoint_root
    if s.warehouse:
        conf["spark.sql.warehouse.dir"] = s.warehouse
    conf.update(catalog_conf(s))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def catalog_conf(s: Settings) -> dict:
    """Session options for a v2 catalog (only when one is configured): implementation class,
    type, URI and warehouse; it also becomes the default catalog."""
    if not (s.catalog and s.catalog_impl):
        return {}
    key = f"spark.sql.catalog.{s.catalog}"
    conf = {key: s.catalog_impl, "spark.sql.defaultCatalog": s.catalog}
    for opt, val in (("type", s.catalog_type), ("uri", s.catalog_uri),
                     ("warehouse", s.warehouse)):
        if val:
            conf[f"{key}.{opt}"] = val
    return conf


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only in local mode, where one machine is everything, is a private folder made when the
    session names none; on a cluster that is an error, because executors would not share it.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not is_local(sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="pumpguard-ckpt-")
            spark.conf.set("spark.checkpoint.dir", d)
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
