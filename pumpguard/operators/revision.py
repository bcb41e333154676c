"""Revision of streamed alerts: what a stream told, compared with the final batch result.

A stream scores a window with the verifications that came within its bound and the requests that were
not late. Once the window is closed, the batch aggregate over all that has arrived is the truth:
the change feed between the two says which alerts stand, changed, fell or were missing, and is kept
as numbered revisions beside the streamed alerts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpguard.config import RuleConfig
from pumpguard.functions.columns import number_range
from pumpguard.operators.aggregates import FRAUD_KEYS, fraud_aggregate, score_aggregates
from pumpguard.operators.silver import dedupe
from pumpguard.schemas import ALERT_KEY
from pumpguard.sinks.writers import alerts_only, folder_exists

KEPT, CHANGED, WITHDRAWN, NEW = "kept", "changed", "withdrawn", "new"


def final_scores(requests: DataFrame, verification: DataFrame, size: str, slide: str | None = None,
                 cfg: RuleConfig = RuleConfig(), keys: Sequence[str] = FRAUD_KEYS) -> DataFrame:
    """The scored windows of all requests and verifications, severity low included. A request
    counts once, and as verified whenever its verification came."""
    once = requests.dropDuplicates(["request_id"])
    if "number_range" not in once.columns:
        once = once.withColumn("number_range", number_range("msisdn"))
    agg = fraud_aggregate(once, keys, verification=verification, msisdn_max=True, window=(size, slide))
    return score_aggregates(agg, cfg)


def alert_changes(told: DataFrame, final: DataFrame, keys: Sequence[str] = ALERT_KEY) -> DataFrame:
    """The change feed: one row per alert that was told or should have been.

    ``told`` has one row per alert, ``final`` one scored row per group, severity low included. The
    result has ``keys``, ``change`` (kept; changed: any value differs; withdrawn: low or gone; new:
    not told), the final values, and the told ones as ``told_<name>`` (null if new). A withdrawn
    alert whose group is gone keeps the told values with score 0 and severity low. Null keys
    match null keys. Columns that only one side has are left out. No rows on a side: all is new, or
    all withdrawn.
    """
    values = [c for c in final.columns if c in told.columns and c not in keys]
    was = alerts_only(told).select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                                   F.struct(*values).alias("_told"))
    now = final.select(*keys, F.struct(*values).alias("_final"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    both = now.join(was, same, "full_outer")
    gone, alert = F.col("_final").isNull(), F.col("_final.severity") != "low"
    change = (F.when(F.col("_told").isNull(), F.when(alert, NEW))
              .when(gone | ~alert, WITHDRAWN)
              .when(F.col("_told").eqNullSafe(F.col("_final")), KEPT).otherwise(CHANGED))
    left = {"score": F.lit(0.0), "severity": F.lit("low")}
    return both.withColumn("change", change).filter("change is not null").select(
        *[F.when(gone, F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in keys], "change",
        *[F.when(gone, left.get(c, F.col(f"_told.{c}"))).otherwise(F.col(f"_final.{c}")).alias(c)
          for c in values],
        *[F.col(f"_told.{c}").alias(f"told_{c}") for c in values])


def _revisions(spark: SparkSession, path: str, before: int | None) -> DataFrame | None:
    if not folder_exists(spark, path):
        return None
    rows = spark.read.parquet(path)
    return rows if before is None else rows.filter(F.col("revision") < before)


def current_alerts(spark: SparkSession, alerts_path: str, revisions_path: str,
                   before: int | None = None) -> DataFrame:
    """The alerts that stand: of each alert the last revision's version (``before``: of revisions
    with a lower number), else the version that the stream wrote last. Withdrawn ones are out."""
    told = spark.read.parquet(alerts_path)
    keys = [k for k in ALERT_KEY if k in told.columns]
    values = [c for c in told.columns if c not in ("batch_id", "created_at")]
    versions = told.select(*values, F.lit(-1).alias("revision"), F.col("batch_id").cast("long"))
    revised = _revisions(spark, revisions_path, before)
    if revised is not None:
        versions = versions.unionByName(revised.select(
            *values, F.col("revision").cast("int"), F.lit(0).cast("long").alias("batch_id")))
    return alerts_only(dedupe(versions, keys, ["revision", "batch_id"], latest=True)).select(*values)


def revise_alerts(spark: SparkSession, alerts_path: str, revisions_path: str, final: DataFrame,
                  closed_before=None, revision: int | None = None) -> DataFrame:
    """Compare the alerts that stand with ``final`` (``final_scores``), write what differs as the
    next revision and return the whole change feed, the kept ones included.

    ``closed_before``: only windows that end by then, so that a running stream's open windows are
    left alone. ``revision``: its number, to repeat one that failed; the repeat replaces it and
    does not see it. Each revision is a folder of its own, written whole: a failed run leaves the
    earlier alerts, a second run over the same data finds nothing to change. The streamed alerts
    are never rewritten, so a stream can go on writing its batches."""
    if revision is None:
        known = _revisions(spark, revisions_path, None)
        last = None if known is None else known.agg(F.max("revision")).first()[0]
        revision = 0 if last is None else int(last) + 1
    told = current_alerts(spark, alerts_path, revisions_path, before=revision)
    if closed_before is not None:
        closed = F.col("window_end") <= F.lit(closed_before)
        told, final = told.filter(closed), final.filter(closed)
    changes = alert_changes(told, final, [k for k in ALERT_KEY if k in told.columns])
    # the feed is read from what was written: a later run changes what stands, not this feed
    feed = f"{revisions_path.rstrip('/')}_feed/revision={revision}"
    changes.write.mode("overwrite").parquet(feed)
    changes = spark.read.schema(changes.schema).parquet(feed)
    (changes.filter(F.col("change") != KEPT).withColumn("created_at", F.current_timestamp())
     .write.mode("overwrite").parquet(f"{revisions_path.rstrip('/')}/revision={revision}"))
    spark.catalog.refreshByPath(revisions_path)
    return changes
