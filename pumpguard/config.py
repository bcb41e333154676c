"""Typed settings (read from the environment) and the fraud-rule configuration."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Deployment settings. Every field has a default so local runs need no env."""

    source_format: str = "kafka"            # kafka | json | parquet
    kafka_bootstrap: str = "localhost:9092"
    landing_dir: str = ""                   # directory source when source_format != kafka
    warehouse: str = ""                     # table location root; "" = session catalog default
    catalog: str = ""                       # v2 catalog name (e.g. an Iceberg catalog); "" = session
    catalog_impl: str = ""                  # its class, e.g. an Iceberg SparkCatalog
    catalog_type: str = ""                  # e.g. rest / hadoop / hive
    catalog_uri: str = ""                   # catalog service URI (rest)
    jdbc_url: str = ""                      # alert / anomaly serving database
    jdbc_user: str = ""
    jdbc_password: str = ""
    checkpoint_root: str = ""               # "" = use spark.checkpoint.dir of the session
    shuffle_partitions: int = 0             # 0 = leave the session's value
    max_partition_bytes: str = ""           # file split size, e.g. "256m" ("" = Spark default)
    advisory_partition_bytes: str = "256m"  # AQE target size of a shuffle partition
    state_partitions: int = 64              # state-store partitions, fixed at a stream's first start
    kafka_min_partitions: int = 0           # split Kafka partitions over more tasks (0 = 1:1)

    @classmethod
    def from_env(cls) -> "Settings":
        env = os.environ
        return cls(
            source_format=env.get("PG_SOURCE_FORMAT", cls.source_format),
            kafka_bootstrap=env.get("KAFKA_BOOTSTRAP", cls.kafka_bootstrap),
            landing_dir=env.get("PG_LANDING_DIR", cls.landing_dir),
            warehouse=env.get("PG_WAREHOUSE", cls.warehouse),
            catalog=env.get("PG_CATALOG", cls.catalog),
            catalog_impl=env.get("PG_CATALOG_IMPL", cls.catalog_impl),
            catalog_type=env.get("PG_CATALOG_TYPE", cls.catalog_type),
            catalog_uri=env.get("PG_CATALOG_URI", cls.catalog_uri),
            jdbc_url=env.get("PG_JDBC_URL", cls.jdbc_url),
            jdbc_user=env.get("PG_JDBC_USER", cls.jdbc_user),
            jdbc_password=env.get("PG_JDBC_PASSWORD", cls.jdbc_password),
            checkpoint_root=env.get("PG_CHECKPOINT_ROOT", cls.checkpoint_root),
            shuffle_partitions=int(env.get("PG_SHUFFLE_PARTITIONS", cls.shuffle_partitions)),
            max_partition_bytes=env.get("PG_MAX_PARTITION_BYTES", cls.max_partition_bytes),
            advisory_partition_bytes=env.get("PG_ADVISORY_PARTITION_BYTES",
                                             cls.advisory_partition_bytes),
            state_partitions=int(env.get("PG_STATE_PARTITIONS", cls.state_partitions)),
            kafka_min_partitions=int(env.get("PG_KAFKA_MIN_PARTITIONS",
                                             cls.kafka_min_partitions)),
        )


# Fixed values that must equal the reference's for identical scores:
# high-risk (mcc, mnc) routes; AIT thresholds 100 requests / 0.10 verify rate / weight 2.0;
# velocity ceiling 30 per msisdn, excess capped at 100, 0.5 points each;
# never-verified at 50 requests for 40 points; risky route 25 points;
# severity high >= 100, medium >= 20; loss mart: > 100 requests, rate < 0.10, 0.03 USD per message.
HIGH_RISK_ROUTES = (("247", "1"), ("88", "0"), ("881", "0"))


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds of the additive fraud score and the loss mart.

    The rule engine's AIT test is ``requests >= ait_min_requests`` while the loss mart uses
    ``requested > loss_min_requests``; both are kept, under distinct names.
    """

    high_risk_routes: tuple[tuple[str, str], ...] = HIGH_RISK_ROUTES
    ait_min_requests: int = 100
    ait_verify_rate_ceiling: float = 0.10
    ait_volume_weight: float = 2.0
    velocity_msisdn_ceiling: int = 30
    velocity_excess_cap: int = 100
    velocity_points_per_request: float = 0.5
    never_verified_min_requests: int = 50
    never_verified_points: float = 40.0
    risky_route_points: float = 25.0
    severity_high: float = 100.0
    severity_medium: float = 20.0
    loss_min_requests: int = 100
    loss_verify_rate_ceiling: float = 0.10
    loss_cost_per_message: float = 0.03
    rules: tuple[str, ...] = field(
        default=("velocity", "ait_signature", "never_verified", "risky_route"))

    def replace(self, **kw) -> "RuleConfig":
        from dataclasses import replace
        return replace(self, **kw)
