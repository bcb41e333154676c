"""Per-entity behavioural features for the anomaly scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURE_COLS = ("requests", "verify_rate", "avg_latency", "range_spread")


def entity_features(silver: DataFrame, keys: Sequence[str] = ("enterprise_id",)) -> DataFrame:
    """requests = rows, verify_rate = mean(is_verified), avg_latency = mean latency (NULLs
    skipped), range_spread = distinct non-NULL number ranges. Rows with a NULL entity are
    dropped. One distributed aggregate (count-distinct via Spark's expand rewrite)."""
    keys = list(keys)
    not_null = None
    for k in keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else not_null & c
    return (silver.filter(not_null).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg(F.col("is_verified").cast("double")).alias("verify_rate"),
        F.avg(F.col("operator_latency_ms").cast("double")).alias("avg_latency"),
        F.count_distinct("number_range").alias("range_spread"),
    ))
