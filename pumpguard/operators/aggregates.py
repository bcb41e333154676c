"""Fraud aggregates over requests (optionally windowed) and the scoring of aggregate rows.

Scale notes: every aggregate here is a hash aggregate with a map-side partial step, so a hot
group (one number range under an AIT burst may hold a third of all rows) is collapsed per map
task before the shuffle. Per-msisdn maxima are two-level aggregates, never a collected list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pumpguard.config import RuleConfig
from pumpguard.functions import rules as R
from pumpguard.functions.columns import number_range

FRAUD_KEYS = ("enterprise_id", "number_range", "mcc", "mnc")


def with_number_range(df: DataFrame) -> DataFrame:
    return df if "number_range" in df.columns else df.withColumn(
        "number_range", number_range("msisdn"))


def verified_ids(verification: DataFrame) -> DataFrame:
    """The *set* of verified request ids (duplicates count once)."""
    return (verification.filter(F.col("outcome") == "verified")
            .select("request_id").distinct())


def mark_verified(requests: DataFrame, verification: DataFrame,
                  flag: str = "is_verified") -> DataFrame:
    """Requests + a flag telling whether the request id is in the verified set.

    Left join against the distinct ids: both sides shuffle on request_id once; the distinct on
    the verification side is a partial aggregate, so a request verified a million times costs
    one row after the map side."""
    ids = verified_ids(verification).withColumn("_hit", F.lit(True))
    return (requests.join(ids, "request_id", "left")
            .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def _window_col(ts: str, size: str, slide: str | None) -> Column:
    return F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)


def fraud_aggregate(requests: DataFrame, keys: Sequence[str] = FRAUD_KEYS,
                    verification: DataFrame | None = None,
                    msisdn_max: bool = False, distinct_ip: bool = False,
                    window: tuple[str, str | None] | None = None,
                    ts_col: str = "event_ts") -> DataFrame:
    """Requests per group, plus optional verifications, msisdn maximum and distinct IPs.

    * ``verification``: count requests whose id is in the verified set; without it an
      ``is_verified`` column of the input is used when present.
    * ``msisdn_max``: largest per-msisdn request count in the group (two-level aggregate).
    * ``distinct_ip``: number of distinct non-NULL IPs.
    * ``window=(size, slide)``: event-time windows (slide None = tumbling); the output gets
      ``window_start`` / ``window_end``; rows with a NULL time drop out.

    With both ``msisdn_max`` and ``distinct_ip`` the first level is one aggregate over two
    grouping sets, (keys, msisdn) and (keys, ip), so the input is shuffled once, not twice.
    """
    df = requests
    if verification is not None:
        df = mark_verified(df, verification, "_v")
        vcol = F.col("_v").cast("long")
    elif "is_verified" in df.columns:
        vcol = F.col("is_verified").cast("long")
    else:
        vcol = None
    keys = list(keys)
    proj = {k: F.col(k) for k in keys}
    if "number_range" in keys and "number_range" not in df.columns:
        proj["number_range"] = number_range("msisdn")
    if window is not None:
        proj = {"window": _window_col(ts_col, window[0], window[1]), **proj}
        keys = ["window"] + keys
    proj.update({"msisdn": F.col("msisdn"), "ip": F.col("ip"),
                 "_v": vcol if vcol is not None else F.lit(0).cast("long")})
    df = df.select(*[c.alias(n) for n, c in proj.items()])   # one projection

    if msisdn_max and distinct_ip:
        lvl1 = (df.groupingSets([[*keys, "msisdn"], [*keys, "ip"]], *keys, "msisdn", "ip")
                .agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_sv"),
                     F.grouping("msisdn").alias("_gm")))
        by_msisdn = F.col("_gm") == 0
        out = lvl1.groupBy(*keys).agg(
            F.sum(F.when(by_msisdn, F.col("_n"))).alias("requests"),
            F.sum(F.when(by_msisdn, F.col("_sv"))).alias("verifications"),
            F.max(F.when(by_msisdn, F.col("_n"))).alias("msisdn_max_count"),
            F.count(F.when(~by_msisdn & F.col("ip").isNotNull(), F.lit(1))).alias("distinct_ip"),
        )
    elif msisdn_max:
        lvl1 = df.groupBy(*keys, "msisdn").agg(F.count(F.lit(1)).alias("_n"),
                                               F.sum("_v").alias("_sv"))
        out = lvl1.groupBy(*keys).agg(F.sum("_n").alias("requests"),
                                      F.sum("_sv").alias("verifications"),
                                      F.max("_n").alias("msisdn_max_count"))
    else:
        aggs = [F.count(F.lit(1)).alias("requests"), F.sum("_v").alias("verifications")]
        if distinct_ip:
            aggs.append(F.count_distinct("ip").alias("distinct_ip"))
        out = df.groupBy(*keys).agg(*aggs)
    final = [c for c in out.columns if c != "window" and (vcol is not None or c != "verifications")]
    if window is not None:
        return out.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), *final)
    return out.select(*final) if vcol is None else out


def score_aggregates(df: DataFrame, cfg: RuleConfig = RuleConfig(),
                     inputs: R.Inputs = R.DEFAULT_INPUTS) -> DataFrame:
    """Adds ``score`` and ``severity`` to every aggregate row; input columns are kept.

    Missing inputs count as 0 (so a requests-only aggregate scores with verifications = 0)."""
    present = set(df.columns)
    s = R.score(cfg, inputs, present)
    # one projection; codegen's subexpression elimination evaluates the score once
    return df.withColumns({"score": s, "severity": R.severity(s, cfg)})


def rule_breakdown(df: DataFrame, cfg: RuleConfig = RuleConfig(),
                   inputs: R.Inputs = R.DEFAULT_INPUTS) -> DataFrame:
    """Every rule's contribution as its own column, then score and severity."""
    present = set(df.columns)
    parts = {f"{name}_points": R.RULES[name](cfg, inputs, present) for name in cfg.rules}
    total = None
    for term in parts.values():              # same left-to-right sum as ``score``
        total = term if total is None else total + term
    total = total if total is not None else F.lit(0.0)
    # one projection; codegen's subexpression elimination evaluates each rule once
    return df.withColumns({**parts, "score": total, "severity": R.severity(total, cfg)})


def alerts_only(scored: DataFrame) -> DataFrame:
    """Rows worth an alert: severity other than 'low'."""
    return scored.filter(F.col("severity") != "low")


def anomalies_only(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("is_anomaly"))


def pane(size: str, slide: str) -> str:
    """The longest interval that divides both ``size`` and ``slide``."""
    micros = [pd.Timedelta(x).value // 1000 for x in (size, slide)]
    return f"{math.gcd(*micros)} microseconds"


def _block_windows(pairs: DataFrame, ts_col: str, size: str, slide: str) -> DataFrame:
    """Requests per (window, dimension, value). A block is the windows that start within ``size``
    (rounded up to slides); a row falls into one or two blocks, whatever the number of windows."""
    size_us, slide_us, pane_us = (pd.Timedelta(x).value // 1000 for x in (size, slide, pane(size, slide)))
    n = -(-size_us // slide_us)                                 # windows of a block
    length = size_us + (n - 1) * slide_us
    block = F.window(ts_col, f"{length} microseconds", f"{n * slide_us} microseconds")
    rows = pairs.select(F.col(ts_col), block.alias("window"), "dimension", "value")
    start = F.unix_micros(F.col("window.start").cast("timestamp"))
    place = F.floor((F.unix_micros(F.col(ts_col).cast("timestamp")) - start) / F.lit(pane_us))
    rows = rows.select("window", "dimension", "value", place.alias("_at"))
    panes = [F.count(F.when(F.col("_at") == i, True)).alias(f"_{i}") for i in range(length // pane_us)]
    held = rows.groupBy("window", "dimension", "value").agg(*panes)
    shift = lambda us: (F.timestamp_micros(start + F.lit(us))
                        .cast(pairs.schema[ts_col].dataType))
    told = F.array(*[F.struct(
        F.struct(shift(i * slide_us).alias("start"), shift(i * slide_us + size_us).alias("end")).alias("window"),
        sum((F.col(f"_{j}") for j in range(i * slide_us // pane_us, (i * slide_us + size_us) // pane_us)),
            F.lit(0).cast("long")).alias("requests")) for i in range(n)])
    return held.select("dimension", "value", F.inline(told)).filter("requests > 0")


def velocity_by(events: DataFrame, dims: str | Sequence[str], size: str = "5 minutes",
                slide: str | None = "1 minute", ceiling: int = 30,
                ts_col: str = "event_ts", delay: str | None = None,
                over_only: bool = False, blocks: bool = False) -> DataFrame:
    """Requests per value of each dimension (msisdn, ip, enterprise_id, number_range) in
    sliding windows; rows above ``ceiling`` are flagged, or with ``over_only`` alone returned.

    All dimensions are counted in one pass: each row is expanded to one (dimension, value) pair
    per dimension inside the scan stage, then counted per pane (the longest interval that
    divides size and slide; partial on the map side). Only the counted panes are expanded to
    the windows that hold them and summed, so a hot value costs one row per pane and window, not
    one per request and window. ``delay`` (streams, append mode) sets the watermark; a stream
    whose input already carries one passes None.

    ``blocks`` (needs ``slide``) keeps one row of pane counts per value and block of windows, in one
    aggregate, and adds the panes up to windows behind it: a stream then keeps no state row per
    window, and tells a window when its whole block has closed, at most ``size`` later."""
    dims = [dims] if isinstance(dims, str) else list(dims)
    df = with_number_range(events)
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"),
                                         F.col(d).cast("string").alias("value"))
                                for d in dims])).alias("_p")
    ex = (df.select(F.col(ts_col), pairs).select(ts_col, "_p.dimension", "_p.value")
          .filter(F.col("value").isNotNull()))     # a missing value is no entity
    if delay:                                # streaming: event-time watermark for the windows
        ex = ex.withWatermark(ts_col, delay)
    first = pane(size, slide) if slide else size
    if slide and blocks:
        out = _block_windows(ex, ts_col, size, slide)
    else:
        out = (ex.groupBy(F.window(ts_col, first).alias("window"), "dimension", "value")
               .agg(F.count(F.lit(1)).alias("requests")))
    if slide and not blocks:
        out = (out.groupBy(F.window("window", size, slide).alias("window"), "dimension", "value")
               .agg(F.sum("requests").alias("requests")))
    over = F.col("requests") > F.lit(ceiling)
    if over_only:
        out = out.filter(over)
    return out.select("dimension", "value",
                      F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "requests",
                      *([] if over_only else [over.alias("over_ceiling")]))


def never_verified_msisdns(silver: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Per msisdn: many requests and not one verification (the per-number form of the rule)."""
    return (silver.groupBy("msisdn")
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.sum(F.col("is_verified").cast("long")).alias("verifications"))
            .filter((F.col("requests") >= F.lit(cfg.never_verified_min_requests))
                    & (F.col("verifications") == 0)))
