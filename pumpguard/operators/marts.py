"""Gold marts: delivery funnel, latency percentiles, AIT loss, fraud daily, route performance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pumpguard.config import RuleConfig
from pumpguard.functions.columns import ait_loss_amount, millis_between, safe_rate, to_day

FUNNEL_DIMS = ("enterprise_id", "mcc", "mnc")
ROUTE_DIMS = ("mcc", "mnc")
PERCENTILES = (0.50, 0.90, 0.99)


def _bucketed(df: DataFrame, dims: Sequence[str], bucket: str | None,
              ts_col: str) -> tuple[DataFrame, list[str]]:
    dims = list(dims)
    if bucket:
        # date_trunc yields a zoned TIMESTAMP; keep the input's timestamp flavour
        ts_type = df.schema[ts_col].dataType.simpleString()
        df = df.withColumn("bucket_start", F.date_trunc(bucket, F.col(ts_col)).cast(ts_type))
        dims = dims + ["bucket_start"]
    return df, dims


def delivery_funnel(silver: DataFrame, dims: Sequence[str] = FUNNEL_DIMS,
                    bucket: str | None = None, ts_col: str = "event_ts") -> DataFrame:
    """requested -> delivered -> verified per group, verify_rate = verified/requested (4 dp).

    ``bucket`` ('day', 'hour', ...) adds a ``bucket_start`` time dimension.
    Rates are DOUBLE (an integer-decimal division would round the rate to one digit)."""
    df, dims = _bucketed(silver, dims, bucket, ts_col)
    out = df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("delivery_status") == "delivered").alias("delivered"),
        F.count_if(F.col("is_verified")).alias("verified"),
    )
    return out.withColumn("verify_rate", safe_rate("verified", "requested", 4))


def discrete_percentiles(df: DataFrame, value: str, dims: Sequence[str],
                         ps: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact discrete percentiles (smallest value whose cumulative share >= p) per group.

    Built from a value histogram: count per (group, value) first (map-side partial aggregate,
    so a hot group shrinks to its number of *distinct* values), then a running count over the
    histogram of each group. Memory per group is bounded by the value domain (milliseconds),
    not by the row count. NULL values are ignored."""
    return percentiles_of_counts(df, value, None, dims, ps, names)


def percentiles_of_counts(df: DataFrame, value: str, count: str | None, dims: Sequence[str],
                          ps: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``discrete_percentiles`` of rows that each stand for ``count`` of them (None: for one), such
    as the value histograms of days."""
    dims = list(dims)
    rows = F.count(F.lit(1)) if count is None else F.sum(count)
    hist = (df.filter(F.col(value).isNotNull())
            .groupBy(*dims, value).agg(rows.alias("_cnt")))
    w_all = Window.partitionBy(*dims)
    w_run = w_all.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (hist.withColumn("_cum", F.sum("_cnt").over(w_run))
              .withColumn("_tot", F.sum("_cnt").over(w_all)))
    picks = [F.min(F.when(F.col("_cum") >= F.lit(float(p)) * F.col("_tot"), F.col(value)))
             .alias(n) for p, n in zip(ps, names)]
    return ranked.groupBy(*dims).agg(*picks)


def approx_percentiles(df: DataFrame, value: str, dims: Sequence[str], ps: Sequence[float],
                       names: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """Approximate percentiles from one mergeable sketch per group (for continuous values)."""
    arr = F.percentile_approx(F.col(value), list(ps), accuracy).alias("_q")
    out = df.filter(F.col(value).isNotNull()).groupBy(*dims).agg(arr)
    return out.select(*dims, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def latency_percentiles(silver: DataFrame, dims: Sequence[str] = ROUTE_DIMS,
                        ps: Sequence[float] = PERCENTILES, col: str = "operator_latency_ms",
                        prefix: str = "", method: str = "exact") -> DataFrame:
    """p50/p90/p99 of request->delivery latency per route, NULL latencies filtered.

    ``method='exact'`` (integer milliseconds: histogram, see ``discrete_percentiles``) or
    ``'approx'`` (``percentile_approx`` sketch)."""
    names = [f"{prefix}p{int(round(p * 100))}_latency_ms" for p in ps]
    if method == "approx":
        return approx_percentiles(silver, col, dims, ps, names)
    return discrete_percentiles(silver, col, dims, ps, names)


def verify_latency_percentiles(silver: DataFrame, dims: Sequence[str] = ROUTE_DIMS,
                               ps: Sequence[float] = PERCENTILES) -> DataFrame:
    """delivery -> verification latency (ms) percentiles; needs delivery_ts/verification_ts."""
    df = silver.withColumn("_verify_ms", millis_between("delivery_ts", "verification_ts"))
    names = [f"p{int(round(p * 100))}_verify_ms" for p in ps]
    return discrete_percentiles(df, "_verify_ms", dims, ps, names)


def ait_loss(funnel: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Suspected AIT volume x per-message cost, on top of the funnel mart."""
    keys = [c for c in funnel.columns if c not in ("requested", "delivered", "verified",
                                                     "verify_rate")]
    return funnel.select(*keys, "requested", "verify_rate",
                         ait_loss_amount("requested", "verify_rate", cfg)
                         .alias("estimated_ait_loss_usd"))


def ait_loss_by_route(loss: DataFrame) -> DataFrame:
    return loss.groupBy("mcc", "mnc").agg(
        F.sum("requested").alias("requested"),
        F.sum("estimated_ait_loss_usd").alias("estimated_ait_loss_usd"))


def top_loss(loss: DataFrame, k: int = 10) -> DataFrame:
    """The k largest estimated losses (a top-k report; ties by the group key for stability)."""
    keys = [c for c in ("enterprise_id", "mcc", "mnc") if c in loss.columns]
    return loss.orderBy(F.col("estimated_ait_loss_usd").desc(),
                        *[F.col(c).asc_nulls_last() for c in keys]).limit(k)


def fraud_daily(alerts: DataFrame, dims: Sequence[str] = (),
                ts_col: str = "created_at") -> DataFrame:
    """Alert count by day x severity (x optional dimensions)."""
    return (alerts.groupBy(to_day(ts_col).alias("day"), F.col("severity"), *dims)
            .agg(F.count(F.lit(1)).alias("alert_count")))


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("alert_count"))


def operator_performance(silver: DataFrame, dims: Sequence[str] = ROUTE_DIMS,
                         ps: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Delivery success rate, mean and percentile latency per route, in one pass.

    A histogram per (route, latency, status) is the only aggregate over Silver (partial on the
    map side); a window over each route's histogram gives running counts, and the final
    per-route aggregate (no further shuffle: already partitioned by route) derives every
    metric from it. Mean = sum(latency x count) / latency count, the same value ``avg`` gives."""
    dims = list(dims)
    lat, st = "operator_latency_ms", "delivery_status"
    hist = silver.groupBy(*dims, lat, st).agg(F.count(F.lit(1)).alias("_cnt"))
    has_lat = F.col(lat).isNotNull()
    lat_cnt = F.when(has_lat, F.col("_cnt")).otherwise(F.lit(0))
    w_all = Window.partitionBy(*dims)
    w_run = w_all.orderBy(F.col(lat).asc_nulls_last()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (hist.withColumn("_cum", F.sum(lat_cnt).over(w_run))
              .withColumn("_tot", F.sum(lat_cnt).over(w_all)))
    names = [f"p{int(round(p * 100))}_latency_ms" for p in ps]
    picks = [F.min(F.when(has_lat & (F.col("_cum") >= F.lit(float(p)) * F.col("_tot")),
                          F.col(lat))).alias(n) for p, n in zip(ps, names)]
    out = ranked.groupBy(*dims).agg(
        F.sum("_cnt").alias("requested"),
        F.sum(F.when(F.col(st) == "delivered", F.col("_cnt")).otherwise(0)).alias("delivered"),
        F.sum(F.when(F.col(st).isNull(), F.col("_cnt")).otherwise(0)).alias("undelivered"),
        (F.sum(F.col(lat).cast("long") * F.col("_cnt")).cast("double")
         / F.nullif(F.sum(lat_cnt), F.lit(0)).cast("double")).alias("avg_latency_ms"),
        *picks)
    return out.withColumn("delivery_rate", safe_rate("delivered", "requested", 4))


def route_enrichment(df: DataFrame, route_dim: DataFrame) -> DataFrame:
    """Left join to a (mcc, mnc, ...) route dimension; Catalyst broadcasts it if its bytes are
    under the session's threshold."""
    return df.join(route_dim, ["mcc", "mnc"], "left")
