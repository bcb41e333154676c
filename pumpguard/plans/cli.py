"""Command-line entry points for the jobs (what a scheduler task runs).

    python -m pumpguard.plans.cli bronze  --landing DIR --out-root DIR --checkpoint DIR
    python -m pumpguard.plans.cli batch   --bronze-root DIR --out-root DIR [--days FIRST,LAST]
    python -m pumpguard.plans.cli anomaly --silver DIR --out DIR [--keys enterprise_id,...]
    python -m pumpguard.plans.cli fraud-stream --checkpoint DIR --alerts DIR [--landing DIR]

Deployment settings (Kafka, catalog, JDBC, checkpoint root) come from ``Settings.from_env``;
without ``--landing`` the streams read Kafka. Each command prints one JSON summary line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pumpguard.config import RuleConfig, Settings


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pumpguard")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze", help="land the three topics (and quarantines)")
    b.add_argument("--landing", default=None)
    b.add_argument("--out-root", required=True)
    b.add_argument("--checkpoint", required=True)
    b.add_argument("--trigger", default="available_now")
    b.add_argument("--landing-format", default="json")
    s = sub.add_parser("batch", help="Silver -> marts -> checks")
    s.add_argument("--bronze-root", required=True)
    s.add_argument("--out-root", required=True)
    s.add_argument("--days", default=None, help="first,last (ISO dates): incremental Silver")
    a = sub.add_parser("anomaly", help="daily isolation-forest scan")
    a.add_argument("--silver", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--keys", default="enterprise_id")
    a.add_argument("--contamination", type=float, default=0.1)
    a.add_argument("--model", default="", help="keep the fitted forest in this folder of versions")
    a.add_argument("--keep-model", action="store_true", help="score by the forest in --model, fit nothing")
    a.add_argument("--scan-date", default="", help="ISO date whose rows are replaced (default: today)")
    f = sub.add_parser("fraud-stream", help="windowed fraud scoring -> alerts")
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--alerts", required=True)
    f.add_argument("--landing", default=None)
    f.add_argument("--window", default="5 minutes")
    f.add_argument("--slide", default=None)
    f.add_argument("--trigger", default="1 minute")
    f.add_argument("--landing-format", default="json")
    f.add_argument("--publish", action="store_true",
                   help="also publish alerts to the alerts topic (Kafka, or JSON files)")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    from pumpguard.session import build_session
    settings = Settings.from_env()
    spark = build_session(f"pumpguard-{args.cmd}", settings)
    if args.cmd == "bronze":
        from pumpguard.streaming.pipelines import run_bronze
        qs = run_bronze(spark, args.out_root, args.checkpoint, settings,
                        landing_root=args.landing, trigger=args.trigger,
                        fmt=args.landing_format if args.landing else None)
        for q in qs:
            q.awaitTermination()
        out = {"queries": len(qs)}
    elif args.cmd == "batch":
        from pumpguard.plans.jobs import Layout, run_batch
        root = args.bronze_root.rstrip("/")
        tables = [spark.read.parquet(f"{root}/{t}")
                  for t in ("requests", "delivery", "verification")]
        days = tuple(args.days.split(",")) if args.days else None
        res = run_batch(spark, *tables, Layout(out_root=args.out_root, catalog=settings.catalog),
                        days=days)
        out = {"silver_rows": res["silver"].count(), "marts": sorted(k for k in res if k != "silver")}
    elif args.cmd == "anomaly":
        from pumpguard.plans.jobs import run_anomaly
        keys = tuple(k for k in args.keys.split(",") if k)
        scored = run_anomaly(spark, spark.read.parquet(args.silver), keys, path=args.out,
                             contamination=args.contamination, model_path=args.model,
                             refit=not args.keep_model, scan_date=args.scan_date or None)
        out = {"entities": scored.count(), "flagged": scored.filter("is_anomaly").count()}
    else:
        from pumpguard.plans.jobs import run_fraud_stream
        from pumpguard.sinks.writers import AlertSink
        from pumpguard.schemas import ALERTS_TOPIC
        sink = (AlertSink("jdbc", url=settings.jdbc_url,
                          properties={"user": settings.jdbc_user,
                                      "password": settings.jdbc_password})
                if settings.jdbc_url else AlertSink("parquet", path=args.alerts))
        if args.publish:
            sink.topic = ALERTS_TOPIC
            if args.landing:                       # offline replay: JSON files
                sink.topic_path = f"{args.alerts.rstrip('/')}_topics"
            else:
                sink.topic_bootstrap = settings.kafka_bootstrap
        q = run_fraud_stream(spark, args.checkpoint, sink, settings, args.landing,
                             args.window, args.slide, RuleConfig(), args.trigger,
                             landing_format=args.landing_format)
        q.awaitTermination()
        out = {"stream": q.name or q.id}
    out = {"command": args.cmd, **out}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":  # pragma: no cover
    main(sys.argv[1:])
    sys.exit(0)
