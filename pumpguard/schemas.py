"""Topic names and event schemas (declared once, used by every reader)."""

from pyspark.sql import types as T

# Topic names of the event model.
TOPICS = {
    "requests": "otp.requests",
    "delivery": "otp.delivery",
    "verification": "otp.verification",
}
ALERTS_TOPIC = "otp.alerts"

REQUEST_FIELDS = [
    "request_id", "msisdn", "enterprise_id", "country_iso",
    "mcc", "mnc", "ip", "channel", "event_ts",
]
DELIVERY_FIELDS = ["request_id", "status", "operator_latency_ms", "event_ts"]
VERIFICATION_FIELDS = ["request_id", "outcome", "attempts", "event_ts"]

# Ingest schemas: strings for identifiers and for event_ts (converted with
# ``to_event_time`` so a bad timestamp becomes NULL instead of failing the batch).
REQUEST_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in REQUEST_FIELDS])
DELIVERY_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("operator_latency_ms", T.IntegerType()),
    T.StructField("event_ts", T.StringType()),
])
VERIFICATION_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("event_ts", T.StringType()),
])

SCHEMAS = {
    "requests": REQUEST_SCHEMA,
    "delivery": DELIVERY_SCHEMA,
    "verification": VERIFICATION_SCHEMA,
}

ALERT_KEY = ["window_start", "enterprise_id", "number_range", "mcc", "mnc"]

# Domains
CHANNELS = ("sms", "voice", "whatsapp")
DELIVERY_STATUSES = ("delivered", "failed", "expired")
VERIFICATION_OUTCOMES = ("verified", "failed", "timeout")
SEVERITIES = ("low", "medium", "high")
