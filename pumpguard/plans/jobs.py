"""Job entry points: Silver build, mart build, ordered batch run, anomaly scan, streams.

Each step writes its output (a table in the configured catalog, or Parquet under ``out_root``)
and the next step reads it back: lineage is cut at every layer, so a lost executor costs a
recomputation of one step, never of the whole chain. Scheduling is left to the caller.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpguard.config import RuleConfig, Settings
from pumpguard.operators import daily as D
from pumpguard.operators import marts as M
from pumpguard.operators import quality as Q
from pumpguard.operators.features import entity_features
from pumpguard.operators import forest
from pumpguard.operators.silver import build_silver, dedupe
from pumpguard.sinks.writers import (ensure_namespace, folder_exists, switch_days, switch_folder,
                                     with_event_date, write_anomalies)

#: Days by which a child may be stamped before the first day of its request.
CHILD_SKEW_DAYS = 1


@dataclass
class Layout:
    """Where layers live: catalog tables (``catalog`` set) or Parquet directories."""

    out_root: str = ""
    catalog: str = ""
    tables: dict = field(default_factory=lambda: {
        "silver": "silver.events", "silver_quarantine": "silver.quarantine",
        "delivery_funnel": "gold.delivery_funnel",
        "latency_pct": "gold.latency_pct", "ait_loss": "gold.ait_loss",
        "fraud_daily": "gold.fraud_daily", "operator_performance": "gold.operator_performance",
        "funnel_days": "gold.funnel_days", "latency_days": "gold.latency_days",
        "verify_days": "gold.verify_days",
    })

    def table(self, name: str) -> str:
        return f"{self.catalog}.{self.tables[name]}"

    def path(self, name: str) -> str:
        return f"{self.out_root.rstrip('/')}/{name}"

    def exists(self, spark: SparkSession, name: str) -> bool:
        return (spark.catalog.tableExists(self.table(name)) if self.catalog
                else folder_exists(spark, self.path(name)))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(self.table(name)) if self.catalog else spark.read.parquet(self.path(name))

    def write(self, spark: SparkSession, df: DataFrame, name: str, check=None,
              partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Rebuild a layer: write it beside the old one, run ``check`` (it raises on a failure),
        then switch. The old layer stays readable until the switch, whatever fails before."""
        if self.catalog:
            t = self.table(name)
            ensure_namespace(spark, t.rsplit(".", 1)[0])
            staged = f"{t}__staging"
            w = df.writeTo(staged)
            (w.partitionedBy(*[F.col(c) for c in partition_by]) if partition_by else w).createOrReplace()
            if check:
                check()
            # atomic on a v2 catalog, and read from what was checked
            w = spark.table(staged).writeTo(t)
            (w.partitionedBy(*[F.col(c) for c in partition_by]) if partition_by else w).createOrReplace()
            spark.sql(f"DROP TABLE {staged}")
        else:
            staged = f"{self.path(name)}__staging"
            w = df.write.mode("overwrite")
            (w.partitionBy(*partition_by) if partition_by else w).parquet(staged)
            if check:
                check()
            switch_folder(spark, staged, self.path(name))
        return self.read(spark, name)

    def append_new(self, spark: SparkSession, df: DataFrame, name: str) -> None:
        """Append the rows of ``df`` that the layer does not hold yet, as often as they are new."""
        if self.catalog:
            t = self.table(name)
            ensure_namespace(spark, t.rsplit(".", 1)[0])
            if spark.catalog.tableExists(t):
                df.exceptAll(spark.table(t).select(df.columns)).writeTo(t).append()
            else:
                df.writeTo(t).create()
        else:
            if folder_exists(spark, self.path(name)):
                df = df.exceptAll(self.read(spark, name).select(df.columns))
            df.write.mode("append").parquet(self.path(name))

    def write_days(self, spark: SparkSession, df: DataFrame, name: str, days: tuple[str, str],
                   check=None) -> DataFrame:
        """Replace the ``event_date`` partitions from the first to the last of ``days``, staged
        and checked as in ``write``; a day without rows becomes empty, other days are kept."""
        if self.catalog:
            t = self.table(name)
            staged = f"{t}__staging"
            df.writeTo(staged).createOrReplace()
            if check:
                check()
            first, last = (F.lit(d).cast("date") for d in days)
            spark.table(staged).writeTo(t).overwrite(F.col("event_date").between(first, last))
            spark.sql(f"DROP TABLE {staged}")
        else:
            staged = f"{self.path(name)}__staging"
            df.write.mode("overwrite").partitionBy("event_date").parquet(staged)
            if check:
                check()
            switch_days(spark, staged, self.path(name), "event_date", days)
        return self.read(spark, name)


def run_silver(spark: SparkSession, requests: DataFrame, delivery: DataFrame,
               verification: DataFrame, layout: Layout,
               dedupe_children: bool = True, days: tuple[str, str] | None = None) -> DataFrame:
    """Bronze -> Silver, written partitioned by ``event_date`` (in full and daily runs alike)
    and read back. The expectations ride on the staged write as an ``Observation``; a failure
    raises before the old Silver is replaced.

    A request belongs to the day it was first seen (earliest ``event_ts``, then the smallest
    row); the latest child per request counts. Requests without a usable event time have no day:
    a full run writes them to the layer ``silver_quarantine``, a daily run appends those to it that
    are not there yet.

    ``days=(first, last)`` (ISO dates, inclusive) rebuilds only these days, with the result a
    full run has for them: requests already seen on an earlier day are left to that day (the ids
    of earlier days are read for it, one column), and children are read from
    ``CHILD_SKEW_DAYS`` before the first day on, without an end, since a delivery or verification
    may come late, and those without a day as well. A child stamped still earlier than that before
    its request is found by a full run only."""
    dated = "event_ts" in requests.columns or "event_date" in requests.columns
    if "event_ts" in requests.columns and "event_date" not in requests.columns:
        requests = with_event_date(requests)
    lost = requests.filter(F.col("event_date").isNull()) if dated else None
    if days is not None:
        first, last = (F.lit(d).cast("date") for d in days)
        before = requests.filter(F.col("event_date") < first).select("request_id")
        requests = (requests.filter(F.col("event_date").between(first, last))
                    .join(before, "request_id", "left_anti"))
        delivery, verification = (
            d.filter(F.col("event_date").isNull()
                     | (F.col("event_date") >= F.date_sub(first, CHILD_SKEW_DAYS))) if "event_date" in d.columns else d
            for d in (delivery, verification))
    elif dated:
        requests = requests.filter(F.col("event_date").isNotNull())
    if "event_ts" in requests.columns:
        requests = dedupe(requests, ["request_id"], ["event_ts"], latest=False)
    silver = build_silver(requests, delivery, verification, dedupe_children=dedupe_children)
    observed, obs = Q.observe_silver(silver)

    def check():
        res = Q.observed_result(obs)
        if not res["ok"]:
            raise AssertionError(f"silver checks failed: {res['failures']}")
    if dated:  # a day's rows are dealt over tasks by AQE, and written by few of them
        observed = observed.hint("rebalance", "event_date")
    if days is not None:
        out = layout.write_days(spark, observed, "silver", days, check)
        if dated:  # only behind a Silver that passed its checks
            layout.append_new(spark, lost, "silver_quarantine")
        return out
    out = layout.write(spark, observed, "silver", check, ("event_date",) if dated else ())
    if dated:
        layout.write(spark, lost, "silver_quarantine")
    return out


def build_marts(spark: SparkSession, silver: DataFrame, layout: Layout,
                alerts: DataFrame | None = None, cfg: RuleConfig = RuleConfig(),
                days: tuple[str, str] | None = None) -> dict:
    """Marts in dependency order; ait_loss reads the *written* funnel.

    A Silver with ``event_date`` goes through partial aggregates by day (``operators.daily``):
    ``days=(first, last)`` reads and rewrites these days alone, and the marts are merged from the
    days, with the result of a full build."""
    out = {}
    if D.DAY in silver.columns:
        parts = D.update_partials(spark, silver, layout, days)
        funnel, latency = D.merged_funnel(parts["funnel_days"]), D.merged_latency(parts["latency_days"])
        performance = D.merged_performance(parts["latency_days"])
    else:
        funnel, latency = M.delivery_funnel(silver), M.latency_percentiles(silver)
        performance = M.operator_performance(silver)
    out["delivery_funnel"] = layout.write(spark, funnel, "delivery_funnel")
    out["latency_pct"] = layout.write(spark, latency, "latency_pct")
    out["ait_loss"] = layout.write(spark, M.ait_loss(out["delivery_funnel"], cfg), "ait_loss")
    out["operator_performance"] = layout.write(spark, performance, "operator_performance")
    if alerts is not None:
        out["fraud_daily"] = layout.write(spark, M.fraud_daily(alerts), "fraud_daily")
    return out


def run_batch(spark: SparkSession, requests: DataFrame, delivery: DataFrame,
              verification: DataFrame, layout: Layout, alerts: DataFrame | None = None,
              cfg: RuleConfig = RuleConfig(), days: tuple[str, str] | None = None) -> dict:
    """silver (+ its checks, observed during the write) -> marts -> mart checks. A failing
    step raises and stops the rest (no mart is built from a Silver that failed its checks)."""
    silver = run_silver(spark, requests, delivery, verification, layout, days=days)
    # the first daily run finds no partials to add to: it builds all days
    known = days is not None and layout.exists(spark, "funnel_days") and layout.exists(spark, "latency_days")
    marts = build_marts(spark, silver, layout, alerts, cfg, days if known else None)
    Q.raise_on_failure(Q.mart_checks(marts["delivery_funnel"], marts["latency_pct"],
                                     marts["ait_loss"]))
    return {"silver": silver, **marts}


def run_anomaly(spark: SparkSession, silver: DataFrame, keys=("enterprise_id",),
                jdbc_url: str = "", jdbc_properties: dict | None = None, path: str = "",
                contamination: float = 0.1, model_path: str = "", refit: bool = True,
                scan_date: str | None = None) -> DataFrame:
    """Daily scan: column-pruned Silver -> features -> forest -> flagged entities of the scan date
    (a rerun replaces them).

    With ``model_path`` the fitted forest is kept there as a new version; ``refit=False`` scores by
    the version that counts there and fits nothing."""
    cols = list(keys) + ["number_range", "is_verified", "operator_latency_ms"]
    feats = entity_features(silver.select(*dict.fromkeys(cols)), keys)
    if model_path and not refit:
        scored = forest.score(feats, forest.load_model(spark, model_path))
    elif feats.isEmpty():
        scored = forest.fit_and_score(feats)
    else:
        model, scored = forest.fit(feats, keys, contamination=contamination)
        if model_path:
            forest.save_model(model, model_path)
    write_anomalies(scored, url=jdbc_url, properties=jdbc_properties, path=path, keys=keys,
                    scan_date=scan_date)
    return scored


def run_fraud_stream(spark: SparkSession, checkpoint_root: str, alert_sink,
                     settings: Settings | None = None, landing_root: str | None = None,
                     size: str = "5 minutes", slide: str | None = None,
                     cfg: RuleConfig = RuleConfig(), trigger: str | None = "1 minute",
                     with_verifications: bool = True, landing_format: str = "json"):
    """Requests (+ verifications) -> parse -> dedupe -> join -> window -> score -> alerts."""
    from pumpguard.schemas import TOPICS
    from pumpguard.sources.readers import read_stream
    from pumpguard.streaming.pipelines import fraud_stream, parse_events, start_alerts
    s = settings or Settings.from_env()
    fmt = None if not landing_root else landing_format

    def src(t):
        path = f"{landing_root}/{t}" if landing_root else None
        raw = read_stream(spark, TOPICS[t], s, starting="latest" if not landing_root
                          else "earliest", path=path, fmt=fmt)
        return parse_events(raw, t)[0]

    req = src("requests")
    ver = src("verification") if with_verifications else None
    scored = fraud_stream(req, ver, size, slide, cfg=cfg)
    return start_alerts(scored, alert_sink, f"{checkpoint_root}/fraud_alerts", trigger)
