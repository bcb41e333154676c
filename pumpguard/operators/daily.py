"""Marts kept as partial aggregates by day: counts that add up, merged when a mart is read.

A day's partials are what the marts need and nothing else:

* ``funnel_days``: requested, delivered and verified per (enterprise, route);
* ``latency_days``: rows per (route, delivery status, operator latency in ms), NULLs included;
* ``verify_days``: rows per (route, delivery to verification in ms).

Sums of counts over days are the counts over all days, and percentiles come from the summed value
histogram, so a merged mart equals the one built in full, exactly. A run for some days reads these
days of Silver and rewrites these partitions only; a late day costs one partition. The partials'
size is bounded by days, groups and the value domain (milliseconds), not by rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpguard.functions.columns import millis_between, safe_rate
from pumpguard.operators.marts import FUNNEL_DIMS, PERCENTILES, ROUTE_DIMS, percentiles_of_counts

DAY = "event_date"


def funnel_days(silver: DataFrame, dims: Sequence[str] = FUNNEL_DIMS) -> DataFrame:
    return silver.groupBy(DAY, *dims).agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("delivery_status") == "delivered").alias("delivered"),
        F.count_if(F.col("is_verified")).alias("verified"))


def latency_days(silver: DataFrame, dims: Sequence[str] = ROUTE_DIMS) -> DataFrame:
    return (silver.groupBy(DAY, *dims, "delivery_status", "operator_latency_ms")
            .agg(F.count(F.lit(1)).alias("n")))


def verify_days(silver: DataFrame, dims: Sequence[str] = ROUTE_DIMS) -> DataFrame:
    took = millis_between("delivery_ts", "verification_ts").alias("verify_ms")
    return (silver.select(DAY, *dims, took).filter("verify_ms is not null")
            .groupBy(DAY, *dims, "verify_ms").agg(F.count(F.lit(1)).alias("n")))


PARTIALS = {"funnel_days": funnel_days, "latency_days": latency_days, "verify_days": verify_days}


def update_partials(spark, silver: DataFrame, layout, days: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """Write the partials of all days, or of ``days`` (first, last; ISO dates) beside the others.
    ``silver`` needs its ``event_date``; a layer is written beside the old one, then switched."""
    if days is not None:
        first, last = (F.lit(d).cast("date") for d in days)
        silver = silver.filter(F.col(DAY).between(first, last))     # pruned to these partitions
    out = {}
    for name, build in PARTIALS.items():
        if not {"delivery_ts", "verification_ts"} <= set(silver.columns) and name == "verify_days":
            continue
        part = build(silver).hint("rebalance", DAY)
        out[name] = (layout.write(spark, part, name, partition_by=(DAY,)) if days is None
                     else layout.write_days(spark, part, name, days))
    return out


def merged_funnel(partials: DataFrame, dims: Sequence[str] = FUNNEL_DIMS) -> DataFrame:
    """``delivery_funnel`` from its days."""
    out = partials.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in ("requested", "delivered", "verified")])
    return out.withColumn("verify_rate", safe_rate("verified", "requested", 4))


def merged_latency(partials: DataFrame, dims: Sequence[str] = ROUTE_DIMS,
                   ps: Sequence[float] = PERCENTILES) -> DataFrame:
    """``latency_percentiles`` from its days."""
    names = [f"p{int(round(p * 100))}_latency_ms" for p in ps]
    return percentiles_of_counts(partials, "operator_latency_ms", "n", dims, ps, names)


def merged_verify_latency(partials: DataFrame, dims: Sequence[str] = ROUTE_DIMS,
                          ps: Sequence[float] = PERCENTILES) -> DataFrame:
    """``verify_latency_percentiles`` from its days."""
    names = [f"p{int(round(p * 100))}_verify_ms" for p in ps]
    return percentiles_of_counts(partials, "verify_ms", "n", dims, ps, names).select(
        *dims, *names)


def merged_performance(partials: DataFrame, dims: Sequence[str] = ROUTE_DIMS,
                       ps: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """``operator_performance`` from its days."""
    n, status, ms = F.col("n"), F.col("delivery_status"), F.col("operator_latency_ms")
    known = F.when(ms.isNotNull(), n)
    sums = partials.groupBy(*dims).agg(
        F.sum("n").alias("requested"),
        F.coalesce(F.sum(F.when(status == "delivered", n)), F.lit(0)).alias("delivered"),
        F.coalesce(F.sum(F.when(status.isNull(), n)), F.lit(0)).alias("undelivered"),
        (F.sum(known * ms).cast("double") / F.sum(known)).alias("avg_latency_ms"))
    sums = sums.withColumn("delivery_rate", safe_rate("delivered", "requested", 4))
    names = [f"p{int(round(p * 100))}_latency_ms" for p in ps]
    some = percentiles_of_counts(partials, "operator_latency_ms", "n", dims, ps, names)
    same = [F.col(f"s.{d}").eqNullSafe(F.col(f"p.{d}")) for d in dims]
    joined = sums.alias("s").join(some.alias("p"), same, "left")
    return joined.select("s.*", *[F.col(f"p.{c}") for c in names])
