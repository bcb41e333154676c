"""pumpguard: OTP messaging fraud and delivery analytics on Spark.

Layers:

* ``sources``    - stream/batch readers, JSON parsing, the fixture binding
* ``functions``  - ``Column`` builders (scalar helpers and the fraud rules)
* ``operators``  - ``DataFrame -> DataFrame`` transforms (silver, marts,
                   aggregates, features, isolation forest, quality)
* ``sinks``      - table / JDBC / file writers
* ``streaming``  - Structured Streaming pipelines
* ``plans``      - job entry points that compose the above (and a CLI)

The most used entry points are re-exported here.
"""

from pumpguard.config import RuleConfig, Settings
from pumpguard.operators.aggregates import (alerts_only, fraud_aggregate, rule_breakdown,
                                            score_aggregates, velocity_by)
from pumpguard.operators.features import entity_features
from pumpguard.operators.iforest import score_anomalies, worst
from pumpguard.operators.marts import (ait_loss, delivery_funnel, fraud_daily,
                                       latency_percentiles, operator_performance)
from pumpguard.operators.quality import validate_silver
from pumpguard.operators.silver import build_silver, dedupe
from pumpguard.session import build_session
from pumpguard.streaming.pipelines import fraud_stream, run_bronze

__all__ = [
    "RuleConfig", "Settings", "build_session",
    "build_silver", "dedupe", "fraud_aggregate", "score_aggregates", "rule_breakdown",
    "alerts_only", "velocity_by", "delivery_funnel", "latency_percentiles", "ait_loss",
    "fraud_daily", "operator_performance", "entity_features", "score_anomalies", "worst",
    "validate_silver", "fraud_stream", "run_bronze",
]
