"""Binding of the provided ``events`` table to the three OTP event tables.

The provided tables hold no OTP traffic, so requests, deliveries and verifications are derived
from ``events`` row by row (narrow projections only: no shuffle, so the binding scales with the
input). The same derivation is written in DuckDB SQL in ``__spark_entry__.oracle_sql``.

Fixed values of the binding (they define the test data, they are not tuning knobs):
scenario by event type: error -> 'ait'; signup with user_id % 10 = 7 -> 'risky';
purchase with user_id % 10 = 8 -> 'dead'; otherwise 'normal'.
AIT traffic: range 550199, enterprise ent_3, LV, route 247/1. Risky: XS, route 881/0.
Dead ranges: 447700. Normal routes by user_id % 4: US 310/260, IN 404/45, GB 234/10, BR 724/5.
Exact duplicate request rows for event_id % 50 = 0; no delivery when k = 50; failed delivery when
k % 20 = 0; no verification when k % 20 = 0 or k = 50; malformed JSON when event_id % 97 = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "events"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{EVENTS}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# The binding as Spark SQL expressions: one parsed expression per column (cheap to build,
# evaluated in whole-stage codegen like any Column).
_BASE = {
    # props is documented as {"k": n}: an anchored pattern reads that form directly and any
    # other text falls back to the JSON path (coalesce evaluates it only when needed), so the
    # value is exactly get_json_object's, at a fraction of the per-row cost
    "k": r"""coalesce(
        CAST(nullif(regexp_extract(props, '^\\{\\s*"k"\\s*:\\s*(-?[0-9]+)\\s*\\}$', 1), '') AS INT),
        CAST(get_json_object(props, '$.k') AS INT))""",
    "scen": """CASE WHEN event_type = 'error' THEN 'ait'
                    WHEN event_type = 'signup' AND user_id % 10 = 7 THEN 'risky'
                    WHEN event_type = 'purchase' AND user_id % 10 = 8 THEN 'dead'
                    ELSE 'normal' END""",
}


def _route(ait: str, risky: str, us: str, in_: str, gb: str, br: str) -> str:
    return (f"CASE WHEN scen = 'ait' THEN '{ait}' WHEN scen = 'risky' THEN '{risky}' "
            f"WHEN user_id % 4 = 0 THEN '{us}' WHEN user_id % 4 = 1 THEN '{in_}' "
            f"WHEN user_id % 4 = 2 THEN '{gb}' ELSE '{br}' END")


_REQUEST = {
    "request_id": "CAST(event_id AS STRING)",
    "msisdn": """CASE scen WHEN 'ait' THEN concat('550199', lpad(CAST(k AS STRING), 4, '0'))
                           WHEN 'dead' THEN concat('447700', lpad(CAST(k AS STRING), 4, '0'))
                 ELSE concat(CAST(100000 + (user_id * 7919) % 900000 AS STRING),
                             lpad(CAST(event_id % 10000 AS STRING), 4, '0')) END""",
    "enterprise_id": "CASE scen WHEN 'ait' THEN 'ent_3' "
                     "ELSE concat('ent_', CAST(1 + user_id % 10 AS STRING)) END",
    "country_iso": _route("LV", "XS", "US", "IN", "GB", "BR"),
    "mcc": _route("247", "881", "310", "404", "234", "724"),
    "mnc": _route("1", "0", "260", "45", "10", "5"),
    "ip": "concat('10.0.', CAST(user_id % 256 AS STRING), '.', CAST(k AS STRING))",
    "channel": "CASE event_type WHEN 'click' THEN 'voice' WHEN 'view' THEN 'whatsapp' "
               "ELSE 'sms' END",
    "event_ts": "ts",
}
_LATENCY = "CAST(50 + CAST(round(value * 100) AS BIGINT) % 3951 AS INT)"


def base_events(events: DataFrame) -> DataFrame:
    """events + ``k`` (from the JSON props) + scenario label."""
    return events.select("event_id", "ts", "user_id", "event_type", "value",
                         *[F.expr(e).alias(n) for n, e in _BASE.items()])


def _request_columns(with_event_id: bool) -> list[Column]:
    """The request fields as expressions over ``base_events`` (``req0`` of the binding)."""
    cols = [F.expr(e).alias(n) for n, e in _REQUEST.items()]
    return cols + [F.col("event_id")] if with_event_id else cols


def _with_copies(events: DataFrame, with_event_id: bool) -> DataFrame:
    """Every request once, plus an exact copy when event_id % 50 = 0, in one projection over
    one scan: ``inline`` of a 1- or 2-element array of empty structs repeats the row and adds no
    column, and the request columns stay outer columns of the Generate (prunable when unused)."""
    copies = F.expr("CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END")
    return base_events(events).select(*_request_columns(with_event_id),
                                      F.inline(F.array_repeat(F.struct(), copies)))


def requests_with_id(e: DataFrame) -> DataFrame:
    """One request per event (``req0``), keeping ``event_id`` as a helper column."""
    return e.select(*_request_columns(True))


def requests_raw(events: DataFrame) -> DataFrame:
    """Requests as they arrive (with duplicates), keeping ``event_id`` as a helper column."""
    return _with_copies(events, True)


def requests(events: DataFrame) -> DataFrame:
    """Requests as they arrive (with duplicates): the Bronze requests table."""
    return _with_copies(events, False)


def _keyed(events: DataFrame, cols: list[str], scen: bool = False) -> DataFrame:
    """``cols`` + ``k`` (+ ``scen``). ``k`` comes out of a Generate, so a filter on it is not
    pushed beneath the parse (the props JSON is parsed once per row); ``cols`` pass through
    as the Generate's outer columns, which column pruning can still drop when unused."""
    derived = [F.expr(_BASE["k"]).alias("k")]
    if scen:
        derived.append(F.expr(_BASE["scen"]).alias("scen"))
    return events.select(*[F.col(c) for c in cols], F.inline(F.array(F.struct(*derived))))


def delivery(events: DataFrame) -> DataFrame:
    return _keyed(events, ["event_id", "ts", "value"]).filter("k <> 50").select(
        F.expr("CAST(event_id AS STRING)").alias("request_id"),
        F.expr("CASE WHEN k % 20 = 0 THEN 'failed' ELSE 'delivered' END").alias("status"),
        F.expr(_LATENCY).alias("operator_latency_ms"),
        F.expr(f"timestampadd(MILLISECOND, {_LATENCY}, ts)").alias("event_ts"),
    )


def verification(events: DataFrame) -> DataFrame:
    cols = ["event_id", "ts", "value", "event_type", "user_id"]
    return _keyed(events, cols, scen=True).filter("k % 20 <> 0 AND k <> 50").select(
        F.expr("CAST(event_id AS STRING)").alias("request_id"),
        F.expr("""CASE WHEN scen = 'ait' THEN (CASE WHEN k % 20 = 1 THEN 'verified'
                                                    ELSE 'timeout' END)
                       WHEN scen = 'dead' THEN 'timeout'
                       WHEN k % 10 < 7 THEN 'verified' ELSE 'timeout' END""").alias("outcome"),
        F.expr("CAST(1 + k % 3 AS INT)").alias("attempts"),
        F.expr(f"timestampadd(SECOND, k, timestampadd(MILLISECOND, {_LATENCY}, ts))")
        .alias("event_ts"),
    )


ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def request_payloads(events: DataFrame) -> DataFrame:
    """Requests as (key, value) JSON messages, the way they arrive on the requests topic.

    ``event_ts`` is written as ISO-8601 with six fractional digits and a +00:00 offset
    (``to_json`` alone would keep milliseconds only). event_id % 97 = 0 carries broken text.
    """
    r = requests_raw(events)
    cols = [c for c in r.columns if c not in ("event_id", "event_ts")]
    ts_text = F.concat(F.date_format("event_ts", ISO_MICROS), F.lit("+00:00"))
    body = F.to_json(F.struct(*[F.col(c) for c in cols], ts_text.alias("event_ts")))
    value = F.when(F.col("event_id") % 97 == 0, F.lit("not-json")).otherwise(body)
    return r.select(F.col("request_id").alias("key"), value.alias("value"),
                    F.col("event_ts").alias("arrival_ts"))


def _child_payloads(df: DataFrame, fields: list[str]) -> DataFrame:
    ts_text = F.concat(F.date_format("event_ts", ISO_MICROS), F.lit("+00:00"))
    body = F.to_json(F.struct(*[F.col(c) for c in fields], ts_text.alias("event_ts")))
    return df.select(F.col("request_id").alias("key"), body.alias("value"),
                     F.col("event_ts").alias("arrival_ts"))


def delivery_payloads(events: DataFrame) -> DataFrame:
    return _child_payloads(delivery(events), ["request_id", "status", "operator_latency_ms"])


def verification_payloads(events: DataFrame) -> DataFrame:
    return _child_payloads(verification(events), ["request_id", "outcome", "attempts"])


def event_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(requests with duplicates, delivery, verification) read from ``sf_dir``."""
    ev = read_events(spark, sf_dir)
    return requests(ev), delivery(ev), verification(ev)
